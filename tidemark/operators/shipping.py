"""Shipping: which files go together into which object, and what is given up when the buffer is over its cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity, timefmt
from tidemark.operators import numbering

BATCH_BYTES = 8 << 20
FILES_A_RUN = 2000


def occupied(files: DataFrame) -> DataFrame:
    """Bytes and entries of a listing with path and size."""
    return files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count_distinct("path").alias("entries"))


def line_count(body: Column) -> Column:
    """Events in a file: its newlines."""
    return (F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit("")))).cast("long")


def evicted(files: DataFrame, cap: int, bucket: Column | None = None) -> DataFrame:
    """Closed files to give up, oldest first, until the listing (path, size, modified, closed) is within the cap.

    Open files count but are never given up. bucket groups files by age; a day by default, for modified in seconds.
    """
    needed = F.greatest((files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"))).select(F.col("s") - cap).scalar(), F.lit(0))
    bucket = F.floor(F.col("modified") / 86_400) if bucket is None else bucket
    summed = numbering.running(files.where("closed"), bucket, [F.col("modified"), F.col("path")], F.col("size"))
    return summed.where(F.col("upto") - F.col("size") < needed)


def planned(files: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """(datebucket, batch_no, paths) for files (datebucket, path, size, ord): filled in order, each batch up to `most` bytes.

    A file that alone is larger has a batch of its own. The fold runs over the files of one day, of which a run takes
    FILES_A_RUN at most.
    """
    most = max(1, most)
    listed = files.groupBy("datebucket").agg(F.array_sort(F.collect_list(F.struct("ord", "path", F.col("size").cast("long").alias("size")))).alias("fs"))
    start = F.struct(F.lit(0).cast("long").alias("no"), F.lit(0).cast("long").alias("used"), F.array().cast("array<bigint>").alias("nos"))

    def add(state: Column, f: Column) -> Column:
        # Every batch that is open has a file, so the first file alone opens one without regard to the size.
        opens = (state["no"] == 0) | (state["used"] + f["size"] > most)
        no = F.when(opens, state["no"] + 1).otherwise(state["no"])
        return F.struct(no.alias("no"), F.when(opens, f["size"]).otherwise(state["used"] + f["size"]).alias("used"), F.concat(state["nos"], F.array(no)).alias("nos"))

    dealt = F.arrays_zip(F.transform("fs", lambda f: f["path"]).alias("path"), F.aggregate("fs", start, add, lambda s: s["nos"]).alias("no"))
    each = listed.select("datebucket", F.posexplode(dealt).alias("at", "o")).select("datebucket", F.col("o.no").alias("batch_no"), "at", F.col("o.path").alias("path"))
    return each.groupBy("datebucket", "batch_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "path"))), lambda x: x["path"]).alias("paths"))


def object_key(prefix: str, site_id: str, datebucket: Column, names: Column, created_us: Column) -> Column:
    """The object's name: decided by the set of files, whatever their order. names and created_us are arrays."""
    base = F.transform(names, lambda n: F.regexp_replace(F.substring_index(n, "/", -1), r"\.closed$", ""))
    digest = identity.short_sha256(F.array_join(F.array_sort(base), "\n"), 8)
    return F.concat(F.concat_ws("/", F.lit(prefix), F.lit(site_id), datebucket), F.lit("/batch-"), F.array_min(created_us).cast("string"), F.lit("-"), F.size(names).cast("string"), F.lit("-"), digest, F.lit(".jsonl.gz"))


def foreign_hosts(files: DataFrame, host: str) -> DataFrame:
    """How many other hosts have files in a listing with path."""
    parsed = timefmt.parsed_file_name(F.col("path"))
    return files.select(parsed["hostid"].alias("h")).where((F.col("h") != host)).agg(F.count_distinct("h").alias("hosts"))


def tracked_folders(current: DataFrame, previous: DataFrame, drained: DataFrame) -> DataFrame:
    """Folders to look into: the current one and earlier ones that aren't drained yet."""
    return current.select("folder").union(previous.select("folder").join(drained, "folder", "left_anti")).distinct()
