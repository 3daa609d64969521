"""Shipping as a stream: buffer files in, owned records out, packed by day."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import timefmt
from tidemark.operators import quota, records, shipping


def buffer_stream(spark: SparkSession, folder: str, files_a_batch: int = shipping.FILES_A_RUN, clean: str | None = None) -> DataFrame:
    """(path, modified, size, line) of closed files as they come; a line ends with \\n alone."""
    reader = spark.readStream.format("text").option("lineSep", "\n").option("maxFilesPerTrigger", files_a_batch).option("pathGlobFilter", "events-*.jsonl.closed")
    if clean:
        reader = reader.option("cleanSource", clean)
    meta = F.col("_metadata")
    return reader.load(folder).select(meta["file_path"].alias("path"), meta["file_modification_time"].alias("modified"), meta["file_size"].alias("size"), F.col("value").alias("line"))


def packed(lines: DataFrame, site_id: str, prefix: str = "events", most: int = shipping.BATCH_BYTES) -> DataFrame:
    """(object_key, path, line): owned lines under the name of the object that their file goes into.

    A file without a time in its name has the day of its last change.
    """
    kept, _ = records.owned(lines, site_id)
    parsed = timefmt.parsed_file_name(F.col("path"))
    us = F.coalesce(parsed["created_us"], F.unix_micros("modified"))
    files = lines.groupBy("path").agg(F.max("size").alias("size"), F.max("modified").alias("modified"))
    files = files.select("path", "size", us.alias("us"), F.struct("modified", "path").alias("ord")).withColumn("datebucket", timefmt.date_bucket(F.col("us")))
    plan = shipping.planned(files, most)
    each = plan.select("datebucket", "batch_no", F.explode("paths").alias("path")).join(files.select("path", "us"), "path")
    keyed = each.groupBy("datebucket", "batch_no").agg(F.collect_list("path").alias("paths"), F.collect_list("us").alias("times"))
    keys = keyed.select(shipping.object_key(prefix, site_id, F.col("datebucket"), F.col("paths"), F.col("times")).alias("object_key"), F.explode("paths").alias("path"))
    return kept.join(keys, "path").select("object_key", "path", "line")


def write_objects(batch: DataFrame, folder: str) -> list[str]:
    """Each object as one gzip file at its key below the folder; the same files make the same keys, so a retry overwrites.

    The objects of a run, FILES_A_RUN at most, are written beside each other and renamed to their keys one by one, so
    that a key never holds part of an object.
    """
    spark = batch.sparkSession
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    held = batch.select(F.sha2("object_key", 256).alias("tag"), "object_key", "line").persist()
    try:
        keys = {r.tag: r.object_key for r in held.select("tag", "object_key").distinct().collect()}
        held.select("tag", "line").repartition("tag").write.partitionBy("tag").option("compression", "gzip").text(staging)
    finally:
        held.unpersist()
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    for tag, key in keys.items():
        (part,) = [s.getPath() for s in files.listStatus(path(f"{staging}/tag={tag}")) if s.getPath().getName().startswith("part-")]
        to = path(f"{folder.rstrip('/')}/{key}")
        files.mkdirs(to.getParent())
        files.delete(to, False)
        if not files.rename(part, to):
            raise OSError(f"{key} couldn't be put in its place")
    files.delete(path(staging), True)
    return sorted(keys.values())


def _shipped(lines: DataFrame, site_id: str, target: str) -> None:
    """One batch: read once, packed and written."""
    lines = lines.persist()
    try:
        write_objects(packed(lines, site_id), target)
    finally:
        lines.unpersist()


def ship(spark: SparkSession, source: str, target: str, checkpoint: str, site_id: str, gates: Callable[[], bool] = lambda: True, once: bool = True, clean: str | None = None) -> StreamingQuery | None:
    """The shipping loop; None where a gate (store set up, not encrypted, paired, load) is closed.

    Files count as shipped when their batch is written; a crash before that repeats the batch under the same names.
    """
    if not site_id or not gates():
        return None
    stream = buffer_stream(spark, source, clean=clean)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: _shipped(df, site_id, target))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def once_each(messages: DataFrame, key: str = "id", at: str = "at", seconds: int = 900) -> DataFrame:
    """Messages without those seen before within a time: the guard against replays."""
    return messages.withWatermark(at, f"{seconds} seconds").dropDuplicatesWithinWatermark([key])


def limited(events: DataFrame, key: str, at: str, most: int, seconds: int = 60) -> DataFrame:
    """Rate limit on a stream by key, in tumbling windows: the first `most` rows of a key in each, as they come.

    The state counts by window, so late rows are held against the window they belong to; a count goes when the watermark
    has passed its window. Keys that name nobody aren't limited, nor is anything if most is 0.
    """
    from collections.abc import Iterator

    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    if most <= 0:
        return events

    def allow(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs() // 1000
        used = dict(zip(*state.get, strict=True)) if state.exists else {}
        for pdf in [] if state.hasTimedOut else parts:
            pdf = pdf.sort_values(at, kind="stable")
            keep = []
            for w in pdf[at].map(lambda t: int(t.timestamp()) // seconds).tolist():
                keep.append(used.get(w, 0) < most)
                used[w] = used.get(w, 0) + keep[-1]
            yield pdf[keep]
        used = {w: n for w, n in used.items() if (w + 1) * seconds > passed}
        if not used:
            if state.exists:
                state.remove()
            return
        state.update((list(used), list(used.values())))
        state.setTimeoutTimestamp(max((min(used) + 1) * seconds * 1000, state.getCurrentWatermarkMs() + 1))

    nobody = quota.named_by_nobody(events, key)
    some = events.where(~nobody).withWatermark(at, f"{seconds} seconds").groupBy(key)
    few = some.applyInPandasWithState(allow, events.schema, "windows array<long>, used array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return few.unionByName(events.where(nobody))


def day_of(path: Column) -> Column:
    return timefmt.date_bucket(timefmt.parsed_file_name(path)["created_us"])
