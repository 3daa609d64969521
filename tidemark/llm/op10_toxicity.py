"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams (word ends included); each bucket has a vector, a word the mean of
its buckets, a window of words the mean of its words, and a linear softmax over that mean gives the window's class.
Buckets and softmax are trained together in numpy (Adam on whole passes). A label belongs to a document: first every
window learns its document's label, then only the window that scores highest.

A document's average is taken over the words that speak most for the toxic class, SHARE of its words and LEAST_WORDS at
least: the mean over all words drowns the few that matter in the noise of the rest (held out at sf0.1 it told apart no
better than precision and recall of 0.6).

At scoring the softmax folds into one number a bucket, so a text costs a few gathers a byte and no model but that
table is sent out.

Defined results: a null or wordless text scores as the model's prior without any word; ties and repeated rows score
alike; with no labels of both classes every score is the share of toxic labels. Other columns are not read.
The training sample is bounded by PER_CLASS documents of each class and SAMPLE_BYTES of text.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, ngrams, sampling

PER_CLASS = 1500
SAMPLE_BYTES = 12 << 20
#: A bucket is learnt only if so many documents of the sample have it: rarer ones would just name their document.
LEAST_DOCS = 6
BITS = 18
SIZES = (3, 4, 5, 6)
#: Words of a training window.
TRAIN_WINDOW = 5
DIMENSIONS = 5
#: The strongest words of a document that its average takes: a share of all, and so many at least.
SHARE = 0.01
LEAST_WORDS = 2
THRESHOLD = 0.7


def word_scores(data: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The mean of the table over the n-grams of each word; 0 for a word that its own text has just before."""
    starts = np.flatnonzero(data == 32)[:-1]
    reach = ngrams.until_space(data)
    total, count = np.zeros(len(data), np.float32), np.zeros(len(data), np.float32)
    for n, bucket in ngrams.gram_buckets(data, SIZES, BITS):
        fits = (reach[: len(bucket)] >= n - 1).astype(np.float32)
        total[: len(bucket)] += table[bucket] * fits
        count[: len(bucket)] += fits
    scores = np.add.reduceat(total, starts) / np.maximum(np.add.reduceat(count, starts), 1)
    key = np.add.reduceat(_hashes(data, reach), starts)
    text = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (text[1:] == text[:-1])
    return np.where(again, 0.0, scores)


def _hashes(data: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """One number a place; those of a word's trigrams add up to a key of the word."""
    out = np.zeros(len(data), np.uint64)
    for n, bucket in ngrams.gram_buckets(data, (3,), 32):
        out[: len(bucket)] = np.where(reach[: len(bucket)] >= n - 1, bucket, 0)
    return out


def strongest(scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The mean over the strongest words of each text, SHARE of them and LEAST_WORDS at least; 0 without words."""
    out = np.zeros(len(counts))
    at = 0
    for i, n in enumerate(counts.tolist()):
        if n:
            k = min(n, max(LEAST_WORDS, math.ceil(SHARE * n)))
            out[i] = np.partition(scores[at : at + n], n - k)[n - k :].mean()
        at += n
    return out


class Bags:
    """Training windows as word ids, and the buckets of every distinct word."""

    def __init__(self, texts: list[bytes]):
        ids: dict[bytes, int] = {}
        parts, counts = [], []
        for i in range(0, len(texts), 100):  # few words at a time as objects
            data, n = ngrams.spaced_words(texts[i : i + 100])
            words = data.tobytes().split()
            parts.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
            counts.append(n)
        self.words, counts = np.concatenate(parts), np.concatenate(counts)
        seen = np.unique(self.words.astype(np.int64) * len(counts) + np.repeat(np.arange(len(counts)), counts))
        docs_of_word = np.bincount(seen // len(counts), minlength=len(ids))  # each word and document once
        del seen
        owner, bucket, often, grams = [], [], np.zeros(1 << BITS), np.zeros(len(ids), np.int64)
        spelled, first = list(ids), 0
        ids.clear()
        while first < len(spelled):
            plain = np.frombuffer(b" " + b" ".join(spelled[first : first + 20_000]) + b" ", np.uint8)
            reach = ngrams.until_space(plain)
            word_at = (np.cumsum(plain == 32) - 1 + first).astype(np.int32)
            for n, b in ngrams.gram_buckets(plain, SIZES, BITS):
                fits = reach[: len(b)] >= n - 1
                owner.append(word_at[: len(b)][fits])
                bucket.append(b[fits].astype(np.int32))
                grams += np.bincount(owner[-1], minlength=len(grams))
                pairs = np.unique((bucket[-1].astype(np.int64) << 32) | owner[-1])
                often += np.bincount(pairs >> 32, weights=docs_of_word[pairs & 0xFFFFFFFF], minlength=1 << BITS)
            first += 20_000
        known = [often[b] >= LEAST_DOCS for b in bucket]
        owner = np.concatenate([o[k] for o, k in zip(owner, known, strict=True)])
        bucket = np.concatenate([b[k] for b, k in zip(bucket, known, strict=True)])
        self.share = 1.0 / np.maximum(grams, 1)
        used = np.unique(bucket)
        place = np.zeros(1 << BITS, np.int32)
        place[used] = np.arange(len(used))
        self.bucket = place[bucket]
        self.used, self.owner, self.n_words = used, owner, len(spelled)
        windows, docs = [], []
        at = 0
        for d, n in enumerate(counts.tolist()):
            k = max(1, round(n / TRAIN_WINDOW)) if n else 0
            windows += [a.size for a in np.array_split(np.empty(n), k)] if k else []
            docs += [d] * k
            at += n
        self.sizes, self.doc = np.array(windows, np.int64), np.array(docs, np.int64)
        self.opens = np.cumsum(self.sizes) - self.sizes
        # Sums go over runs: pairs of word and bucket by word and by bucket, places of a word by word, windows as they are.
        order = np.argsort(self.owner, kind="stable")
        self.bucket_by_word = self.bucket[order]
        self.with_buckets, self.word_opens = np.unique(self.owner[order], return_index=True)
        order = np.argsort(self.bucket, kind="stable")
        self.word_by_bucket = self.owner[order]
        self.bucket_opens = np.flatnonzero(np.diff(self.bucket[order], prepend=-1))
        del self.bucket, self.owner
        order = np.argsort(self.words, kind="stable").astype(np.int32)
        self.window_by_word = np.repeat(np.arange(len(windows), dtype=np.int32), self.sizes)[order]
        self.place_opens = np.searchsorted(self.words[order], np.arange(self.n_words))

    def up(self, vectors: np.ndarray) -> np.ndarray:
        """Window means, one column a dimension, from bucket vectors."""
        out = np.empty((len(self.sizes), vectors.shape[1]))
        word = np.zeros(self.n_words)
        for k in range(vectors.shape[1]):
            word[self.with_buckets] = np.add.reduceat(vectors[:, k][self.bucket_by_word], self.word_opens)
            out[:, k] = np.add.reduceat((word * self.share)[self.words], self.opens) / self.sizes
        return out

    def down(self, grad: np.ndarray) -> np.ndarray:
        """Gradient of the bucket vectors from that of the window means."""
        out = np.empty((len(self.used), grad.shape[1]))
        for k in range(grad.shape[1]):
            word = np.add.reduceat((grad[:, k] / self.sizes)[self.window_by_word], self.place_opens) * self.share
            out[:, k] = np.add.reduceat(word[self.word_by_bucket], self.bucket_opens)
        return out


def train(sample: list[tuple[bytes, int]], steps: int = 40, warm: int = 24, rate: float = 0.3) -> dict[str, Any]:
    """{"table": one number a bucket, "bias": number}; the logit of words is the mean of their buckets' means, plus the bias."""
    y_doc = np.array([y for _, y in sample], np.float64)
    prior = float(np.clip(y_doc.mean() if len(y_doc) else 0.0, 0.01, 0.99))
    flat = {"table": np.zeros(1 << BITS, np.float32), "bias": float(np.log(prior / (1 - prior)))}
    if len(set(y_doc.tolist())) < 2:
        return flat
    check = np.arange(len(sample)) % 5 == 4  # kept apart for the threshold
    y_train = y_doc[~check]
    bags = Bags([t for (t, _), c in zip(sample, check, strict=True) if not c])
    if len(set(y_train.tolist())) < 2 or not len(bags.sizes) or not len(bags.used):
        return flat
    rng = np.random.default_rng(7)
    params = [rng.normal(0, 0.1, (len(bags.used), DIMENSIONS)), rng.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    y = y_train[bags.doc].astype(np.int64)
    onehot = np.eye(2)[y]
    order = np.argsort(bags.doc, kind="stable")
    edges = np.flatnonzero(np.diff(bags.doc[order], prepend=-1))
    for step in range(1, steps + 1):
        mean = bags.up(params[0])
        logits = mean @ params[1] + params[2]
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        toxic = p[:, 1]
        weight = np.ones(len(y))
        if step > warm:  # in a toxic document only the most toxic window answers for the label
            top = np.repeat(np.maximum.reduceat(toxic[order], edges), np.diff(edges, append=len(order)))
            weight = np.where((y == 0) | (toxic >= top[np.argsort(order)] - 1e-12), 1.0, 0.0)
        for v in (0, 1):  # both classes count alike
            weight[y == v] *= 0.5 / max(weight[y == v].sum(), 1e-9)
        g = (p - onehot) * weight[:, None]
        grads = [bags.down(g @ params[1].T), mean.T @ g, g.sum(0)]
        for q, grad, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (0.2 if q is not params[0] else 1.0)
        params[0] *= 1 - 2e-3
    table = np.zeros(1 << BITS, np.float32)
    table[bags.used] = params[0] @ (params[1][:, 1] - params[1][:, 0])
    model = {"table": table, "bias": float(params[2][1] - params[2][0])}
    own = check if len(set(y_doc[check].tolist())) == 2 else np.ones(len(sample), bool)
    return calibrated(model, [t for (t, _), c in zip(sample, own, strict=True) if c], y_doc[own])


def calibrated(model: dict[str, Any], texts: list[bytes], y: np.ndarray) -> dict[str, Any]:
    """Moves the place where these documents are told apart best to the threshold."""
    z = np.concatenate([logits_of(texts[i : i + 200], model) for i in range(0, len(texts), 200)])
    order = np.argsort(z)
    missed = np.cumsum(y[order] == 1) / max((y == 1).sum(), 1)
    alarms = 1 - np.cumsum(y[order] == 0) / max((y == 0).sum(), 1)
    cost = missed + 8 * alarms  # clean documents are some ten times as many
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    cut = (z[order[best[0]]] + z[order[min(best[-1] + 1, len(z) - 1)]]) / 2
    return model | {"bias": model["bias"] - cut + float(np.log(THRESHOLD / (1 - THRESHOLD)))}


def logits_of(texts: list[bytes | None], model: dict[str, Any]) -> np.ndarray:
    data, counts = ngrams.spaced_words(texts)
    if not len(data):
        return np.full(len(texts), model["bias"])
    return strongest(word_scores(data, counts, model["table"]), counts) + model["bias"]


def scored(docs: DataFrame, model: dict[str, Any], columns: list[str], score: str = "score") -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 1 MiB, whatever the corpus

    def make():
        return lambda texts: {score: (1 / (1 + np.exp(-np.clip(logits_of(texts, sent.value), -40, 40)))).tolist()}

    return common.map_texts(docs, columns, "text", f"{score} double", make)


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> dict[str, Any]:
    return sampling.trained(sampling.labelled_sample(docs, labels, "toxic", 3, 1, per_class, most_bytes), train)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fitted(docs, common.table(spark, sf_dir, "labels"))
    out = scored(docs, model, ["doc_id"])
    return out.select("doc_id", (common.fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the others stay as they are."""
    model = fitted(docs, common.table(spark, sf_dir, "labels"))
    held = docs.select(F.struct(*docs.columns).alias("own"), "text")
    return scored(held, model, ["own"], "tidemark_score").where(F.col("tidemark_score") < THRESHOLD).select("own.*")
