"""Pull: a bounded, destructive read of the record stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import RECORD_TYPES

MOST, DEFAULT = 10_000, 1_000


def clamped(limit: int | None) -> int:
    return DEFAULT if limit is None else min(max(limit, 1), MOST)


def wanted_types(asked: list[str] | None) -> list[str]:
    """Asked and allowed; all that are allowed if none is asked for."""
    return [t for t in RECORD_TYPES if t in asked] if asked else list(RECORD_TYPES)


def not_before(captured_at: Column, bound: str | None, as_time: bool = True) -> Column:
    """Inclusive lower bound. As strings, an empty time passes and a whole second sorts after its fractions."""
    if not bound:
        return F.lit(True)
    if not as_time:
        text = F.coalesce(captured_at, F.lit(""))
        return (text == "") | (text >= bound)
    time = F.try_to_timestamp(captured_at)
    return time.isNull() | (time >= F.to_timestamp(F.lit(bound)))


def rows(records: DataFrame) -> DataFrame:
    """The shape that is served: id, captured_at, record_type, entity (or event name, or nothing) and the raw line."""
    get = lambda k: F.get_json_object("line", f"$.{k}")
    entity = F.coalesce(get("entity"), get("event_name"), F.lit(""))
    return records.select(*[c for c in records.columns if c != "line"], get("id").alias("id"), get("captured_at").alias("captured_at"), get("record_type").alias("record_type"), entity.alias("entity"), F.col("line").alias("data"))


def drained(lines: DataFrame, types: list[str] | None = None, since: str | None = None, limit: int | None = None, as_time: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(delivered, survivors, malformed) of lines (modified, path, line_no, line).

    Delivered are the first `limit` wanted lines in the order of files and lines; malformed ones up to there go too;
    all else survives, verbatim. Without anything delivered from a file, only its malformed lines change it. The limit
    is a top-k, and the boundary one row that is joined, so nothing is ordered as a whole.
    """
    at = F.struct("modified", "path", "line_no")
    told = lines.withColumn("at", at).withColumn("ok", F.coalesce(F.json_object_keys("line").isNotNull(), F.lit(False)))
    want = F.coalesce(F.get_json_object("line", "$.record_type").isin(*wanted_types(types)), F.lit(False)) & not_before(F.get_json_object("line", "$.captured_at"), since, as_time)
    told = told.withColumn("want", F.col("ok") & want)
    most = clamped(limit)
    first = told.where("want").orderBy("at").limit(most)
    edge = first.agg(F.max("at").alias("edge"), (F.count(F.lit(1)) == most).alias("full"))
    placed = told.crossJoin(F.broadcast(edge))  # one row
    reached = ~F.col("full") | (F.col("at") <= F.col("edge"))
    given = F.col("want") & reached
    bad = ~F.col("ok") & reached
    keep = lambda c: placed.where(F.coalesce(c, F.lit(False))).select(*lines.columns)
    return rows(keep(given)), keep(~given & ~bad), keep(bad)
