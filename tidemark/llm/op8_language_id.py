"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of SIZES characters of the lower-case words (a space at either end) are hashed into 2**BITS buckets. Counts by
language, smoothed, give a matrix of log-probabilities that is broadcast; a text's log-likelihoods are sums of its
n-grams' rows, taken sparsely in numpy.

Defined results: a null text, or one without a letter, is `und` with score 0; with nothing learnt every text is; ties
go to the language that is first in order; repeated rows are judged alike; other columns are not read. The training
sample is bounded by SAMPLE_ROWS documents of each language and SAMPLE_BYTES of text in all, so rare languages are learnt.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, ngrams, sampling

SAMPLE_ROWS = 1000
SAMPLE_BYTES = 16 << 20
BITS = 16
SIZES = (1, 2, 3, 4)
SMOOTHING = 0.5
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def gram_counts(texts: list[bytes | None], counts: np.ndarray) -> None:
    """Adds the n-grams of the texts to one row of the count matrix."""
    data = ngrams.code_points(ngrams.spaced_words(texts)[0])
    for _, bucket in ngrams.gram_buckets(data, SIZES, BITS):
        counts += np.bincount(bucket, minlength=1 << BITS)


def train(sample: list[tuple[bytes, str]]) -> dict[str, Any]:
    languages = sorted({lang for _, lang in sample})
    counts = np.zeros((len(languages), 1 << BITS))
    prior = np.zeros(len(languages))
    for k, lang in enumerate(languages):
        own = [t for t, v in sample if v == lang]
        prior[k] = np.log(len(own) / len(sample))
        for i in range(0, len(own), 500):
            gram_counts(own[i : i + 500], counts[k])
    logs = np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True))
    return {"languages": languages, "logs": logs.astype(np.float32), "prior": prior}


def likelihoods(texts: list[bytes | None], model: dict[str, Any]) -> np.ndarray:
    """Log-likelihood of every language (row) for every text (column)."""
    data, words = ngrams.spaced_words(texts)
    data = ngrams.code_points(data)
    spaces = np.append(np.flatnonzero(data == 32), [len(data)]) if len(data) else np.zeros(1, np.int64)
    ends = spaces[np.minimum(np.cumsum(words), len(spaces) - 1)]  # a text's n-grams start before the next text's first space
    sizes = np.diff(ends, prepend=0)
    out = np.repeat(model["prior"][:, None], len(texts), 1)
    starts = ends - sizes
    for n, bucket in ngrams.gram_buckets(data, SIZES, BITS):
        stops = starts + np.maximum(sizes - max(n - 2, 0), 0)  # the last n-gram ends with the text's last space
        bounds = np.column_stack((starts, stops)).ravel()
        for k in range(len(out)):
            rows = np.append(model["logs"][k][bucket], np.zeros(n, np.float32)).astype(np.float64)
            out[k] += np.where(stops > starts, np.add.reduceat(rows, bounds)[::2], 0.0)
    return out


def predict(texts: list[bytes | None], model: dict[str, Any]) -> dict[str, list]:
    if not model["languages"]:
        return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
    z = likelihoods(texts, model)
    best = z.argmax(0)
    score = 1 / np.exp(np.clip(z - z.max(0), -700, 0)).sum(0)
    known = [LETTER.search(ngrams.decoded(t)) is not None for t in texts]
    return {
        "lang_pred": [model["languages"][b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)],
        "score": [float(s) if k else 0.0 for s, k in zip(score.tolist(), known, strict=True)],
    }


def sample_texts(docs: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(text, y) of the first `rows` documents of each language in the order of a hash of the id, up to most_bytes; y: the language."""
    usable = docs.select("doc_id", "text", F.col("lang").alias("y")).where("doc_id IS NOT NULL AND lang IS NOT NULL")
    ids = sampling.first_of_each(usable.select("doc_id", "y").where(common.fold("doc_id", 4) != 2), rows)
    return sampling.texts_of(usable, ids.select("doc_id").distinct(), most_bytes)


def identified(docs: DataFrame, model: dict[str, Any], columns: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 256 KiB a language

    def make():
        return lambda texts: predict(texts, sent.value)

    return common.map_texts(docs, columns, "text", "lang_pred string, score double", make)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = identified(docs, sampling.trained(sample_texts(docs), train), ["doc_id"])
    return out.select("doc_id", (common.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
