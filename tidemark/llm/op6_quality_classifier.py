"""Quality: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and digits, and runs of symbols. A text's features are its tokens and pairs of neighbours,
hashed into 2**BITS buckets, each by its share in the text; a token that follows itself makes one pair whatever the
token is. A score is the sparse dot product of these shares with the weights.

Defined results: null and empty texts have no features and score as the bias alone; ties and repeated rows score alike;
with no labels of both classes every score is that of the bias. Other columns are not read. The training sample is
bounded by PER_CLASS documents of each class and SAMPLE_BYTES of text.
"""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, ngrams, sampling

PER_CLASS = 3000
SAMPLE_BYTES = 24 << 20
BITS = 20
#: Shares are small numbers; scaled, their weights are of the order of one.
SCALE = 20.0
THRESHOLD = 0.7
_REPEAT = np.uint64(0x5851F42D4C957F2D)


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all texts, and the number of features of each text."""
    h, counts = ngrams.token_hashes(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    same = text[1:] == text[:-1]
    pair = np.where(h[1:] == h[:-1], _REPEAT, h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:])[same]
    both = np.concatenate((h, pair))
    at = np.argsort(np.concatenate((text, text[1:][same])), kind="stable")
    bucket = ((both * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))[at].astype(np.int64)
    return bucket, np.where(counts > 0, 2 * counts - 1, 0)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with proximal terms."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-4):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    @property
    def bias(self) -> float:
        return -self.bias_z / ((self.beta + np.sqrt(self.bias_n)) / self.alpha)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int, weight: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x + self.bias, -35, 35)))
        err = weight * (p - y)
        g = err * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        step = (np.sqrt(self.bias_n + err * err) - np.sqrt(self.bias_n)) / self.alpha
        self.bias_z += err - step * self.bias
        self.bias_n += err * err


def train(sample: list[tuple[bytes, int]], passes: int = 3) -> dict[str, Any]:
    y = np.array([v for _, v in sample], np.int64)
    prior = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    if len(set(y.tolist())) < 2:
        return {"weights": np.zeros(1 << BITS, np.float32), "bias": float(np.log(prior / (1 - prior)))}
    rows = []
    for text, v in sample:
        bucket, _ = features([text])
        at, count = np.unique(bucket, return_counts=True)
        rows.append((at, SCALE * count / max(1, count.sum()), v))
    share = {v: 0.5 * len(y) / (y == v).sum() for v in (0, 1)}  # both classes count alike
    model = Ftrl()
    order = np.random.default_rng(11)
    for _ in range(passes):
        for i in order.permutation(len(rows)).tolist():
            at, x, v = rows[i]
            model.learn(at, x, v, share[v])
    return {"weights": model.weights(slice(None)).astype(np.float32), "bias": float(model.bias)}


def logits_of(texts: list[bytes | None], model: dict[str, Any]) -> np.ndarray:
    bucket, counts = features(texts)
    return SCALE * ngrams.sums(model["weights"][bucket], counts) / np.maximum(counts, 1) + model["bias"]


def scored(docs: DataFrame, model: dict[str, Any], columns: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MiB, whatever the corpus

    def make():
        return lambda texts: {"score": (1 / (1 + np.exp(-np.clip(logits_of(texts, sent.value), -40, 40)))).tolist()}

    return common.map_texts(docs, columns, "text", "score double", make)


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> dict[str, Any]:
    return sampling.trained(sampling.labelled_sample(docs, labels, "quality", 4, 2, per_class, most_bytes), train)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = scored(docs, fitted(docs, common.table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", (common.fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
