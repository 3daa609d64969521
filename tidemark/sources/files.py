"""Buffer files: which are safe, what they hold, and how they are written and packed."""

from __future__ import annotations

import os
import stat
from collections.abc import Iterable
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESIDUE_SECONDS = 900


def safe_files(folders: Iterable[str], patterns: Iterable[str] = ("*.jsonl", "*.closed", "*.pulled")) -> list[str]:
    """Regular files with a single name (no links) in local folders of the driver, each once, in order."""
    found = set()
    for folder in folders:
        if os.path.isdir(folder):
            for name in os.listdir(folder):
                path = os.path.join(folder, name)
                info = os.lstat(path)
                if stat.S_ISREG(info.st_mode) and info.st_nlink == 1 and any(fnmatch(name, p) for p in patterns):
                    found.add(os.path.realpath(path))
    return sorted(found)


def unsafe_files(folder: str) -> list[str]:
    known = set(safe_files([folder], ["*"]))
    return sorted(n for n in os.listdir(folder) if os.path.realpath(os.path.join(folder, n)) not in known or os.path.islink(os.path.join(folder, n)))


def purge_residue(folder: str, now: float, least_age: int = RESIDUE_SECONDS, pattern: str = "*.tmp") -> int:
    """Removes what unfinished rewrites left behind; links at any age."""
    gone = 0
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        if fnmatch(name, pattern) and (os.path.islink(path) or now - os.lstat(path).st_mtime >= least_age):
            os.unlink(path)
            gone += 1
    return gone


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, modified, line_no, line) of the files; lines end with \\n alone, so other separators stay inside a record.

    A file is read by one task, which gives line numbers without a shuffle; files are small by rotation.
    """
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    lines = whole.select("path", "modified", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return lines.select("path", "modified", "line_no", F.trim("line").alias("line")).where("line <> ''")


def parsed(line: Column) -> Column:
    """The record, or null where a line isn't JSON of an object."""
    return F.when(F.json_object_keys(line).isNotNull(), F.try_parse_json(line))


def write_batch(records: DataFrame, path: str) -> None:
    """JSON lines, gzip, at a path that depends on the batch alone: written again it is the same object."""
    records.select("line").coalesce(1).write.mode("overwrite").option("compression", "gzip").text(path)


def validated_folder(path: str, root: str, reserved: Iterable[str] = ()) -> str:
    """An absolute, canonical folder inside the root that isn't reserved; ValueError otherwise."""
    if not os.path.isabs(path) or os.path.normpath(path) != path.rstrip("/"):
        raise ValueError("the folder must be absolute and canonical")
    real, top = os.path.realpath(path), os.path.realpath(root)
    if real == top or os.path.commonpath([real, top]) != top:
        raise ValueError("the folder must be inside the root")
    if any(os.path.commonpath([real, os.path.realpath(r)]) == os.path.realpath(r) for r in reserved):
        raise ValueError("the folder is reserved")
    return real


def purge(folder: str, pattern: str = "events-*.jsonl*") -> int:
    """Removes all buffer files of our own pattern; others stay."""
    gone = safe_files([folder], [pattern])
    for path in gone:
        os.unlink(path)
    return len(gone)


def append(rows: DataFrame, path: str) -> None:
    """Rows at the end of a log of Parquet files."""
    rows.write.mode("append").parquet(path)


def rotated(rows: DataFrame, path: str, most_records: int) -> None:
    """JSON lines, appended, no file longer than a number of records."""
    rows.select("line").write.mode("append").option("maxRecordsPerFile", most_records).text(path)
