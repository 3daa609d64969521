"""A bounded, repeatable sample of labelled texts, and training on it in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common


#: Rows of a table of classes and counts up to which it is sent to all tasks.
MOST_BROADCAST = 10_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int, most_bytes: int, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(text, label) of at most per_class labelled documents of each class and most_bytes of text in all, as fitting() says.

    Rows whose fold is held out are never read as labels. The order is that of a hash of the id, so the sample is the
    same in every run and at every number of partitions. Null ids, labels and texts aren't learnt from.
    """
    open_rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & (common.fold("doc_id", modulus) != held_out))
    ids = None
    for v in classes:
        part = first_by_hash(open_rows.where(F.col("y") == v), per_class)
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.groupBy("doc_id").agg(F.min("y").alias("y"))
    return texts_of(docs.select("doc_id", "text"), ids, most_bytes)


def first_by_hash(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows in the order of a hash of doc_id.

    Rows whose hash lies in the lowest part, of 4 n rows or so, are all that is ordered; whole if they are fewer than n.
    """
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    total = rows.count()
    if total > 8 * n:
        low = rows.where(F.xxhash64("doc_id") < F.lit(-(1 << 63) + (1 << 64) * 4 * n // total))
        if low.count() >= n:
            rows = low
    return rows.orderBy(*order).limit(n)


def first_of_each(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows of each y in the order of a hash of doc_id; of a frequent y only the lowest hashes, some 4 n, are ordered."""
    h = F.xxhash64("doc_id")
    share = (F.lit(4.0 * n) / F.col("total")) * F.lit(float(1 << 64)) - F.lit(float(1 << 63))
    totals = common.checkpointed(rows.groupBy("y").agg(F.count(F.lit(1)).alias("total")))
    low = rows.join(F.broadcast(totals) if totals.count() <= MOST_BROADCAST else totals, "y").where((F.col("total") <= 8 * n) | (h.cast("double") < share))
    nth = F.row_number().over(Window.partitionBy("y").orderBy(h, "doc_id"))
    return low.withColumn("nth", nth).where(F.col("nth") <= n).select("doc_id", "y")


def texts_of(docs: DataFrame, ids: DataFrame, most_bytes: int) -> DataFrame:
    """(text, y) of a bounded table of ids with y, or of rows that have y themselves; one text an id, up to most_bytes in all."""
    own = "y" in docs.columns
    rows = docs.withColumn("text", F.col("text").cast("binary")).where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("t")).select("doc_id", "t.text", "t.y") if own else rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return within(one, most_bytes)


def within(rows: DataFrame, most_bytes: int) -> DataFrame:
    """(text, y) of a bounded table with doc_id, in one partition and in the order of a hash of the id: the texts that fitting() takes."""
    held = common.checkpointed(rows.select("doc_id", "y", F.octet_length("text").cast("long").alias("n"), F.substring("text", 1, most_bytes).alias("text")))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sizes = held.select("doc_id", "y", "n").orderBy(*order).collect()  # ids and numbers of a bounded sample, no texts
    taken = fitting([(r.y, r.n) for r in sizes], most_bytes)
    schema = held.select(F.col("doc_id"), F.col("n").alias("upto")).schema
    chosen = rows.sparkSession.createDataFrame([(r.doc_id, n) for r, n in zip(sizes, taken, strict=True) if n is not None], schema)
    kept = held.join(F.broadcast(chosen), "doc_id").repartition(1).sortWithinPartitions(*order)
    return kept.select(F.expr("substring(text, 1, CAST(upto AS INT))").alias("text"), "y")


def fitting(sizes: Sequence[tuple[Any, int]], most_bytes: int) -> list[int | None]:
    """The bytes to take of each text, given (class, bytes) in order; None for a text that isn't taken.

    Classes share the bytes evenly, and what one doesn't need goes to the others. A text larger than what is left to its
    class is passed over alone; those after it that fit are taken. Of a class none of whose texts fits, the beginning of
    the shortest is taken.
    """
    totals: dict[Any, int] = {}
    for y, n in sizes:
        totals[y] = totals.get(y, 0) + n
    left, rest = {}, most_bytes
    for i, y in enumerate(sorted(totals, key=lambda y: (totals[y], str(y)))):
        left[y] = min(totals[y], rest // (len(totals) - i))
        rest -= left[y]
    least: dict[Any, int] = {}
    for at, (y, n) in enumerate(sizes):
        if y not in least or n < sizes[least[y]][1]:
            least[y] = at
    out: list[int | None] = [None] * len(sizes)
    for y, at in least.items():
        if sizes[at][1] > left[y]:
            out[at], left[y] = left[y], 0
    for at, (y, n) in enumerate(sizes):
        if out[at] is None and n <= left[y]:
            out[at] = n
            left[y] -= n
    return out


def trained(sample: DataFrame, train: Callable[[list[tuple[bytes, Any]]], Any]) -> Any:
    """What train makes of the (text, label) rows of a bounded sample; it runs in one task, and the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, Any]] = []
        for b in batches:
            rows += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        model = pickle.dumps(train(rows))
        rows.clear()
        common.release()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    made = common.arrow_map(sample.coalesce(1), run, "model binary").collect()
    return pickle.loads(made[0].model) if made else train([])
