"""Records: envelopes, size and ownership gates, latest versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import identity, text
from tidemark.schemas import MAX_RECORD

JSON_OPTIONS = {"ignoreNullFields": "false"}


def as_json(columns: list[str] | list[Column]) -> Column:
    """A JSON object; nulls stay, as absent and null differ."""
    return F.to_json(F.struct(*columns), JSON_OPTIONS)


def snapshot_envelope(rows: DataFrame, entity: str, site_id: str, batch: str, captured_at: str, key: str = "id", versions: tuple[int, int | None] = (0, None)) -> DataFrame:
    """One record a row, with an id that the site, the entity and the key alone decide. An unpaired site has none."""
    if not site_id:
        rows = rows.limit(0)
    return rows.select(
        identity.entity_id(site_id, entity, F.col(key)).alias("id"),
        F.lit(site_id).alias("site_id"),
        F.lit(captured_at).alias("captured_at"),
        F.lit("entity_snapshot").alias("record_type"),
        F.lit(versions[0]).cast("long").alias("plugin_version"),
        F.lit(versions[1]).cast("long").alias("moodle_version"),
        F.lit(entity).alias("entity"),
        F.lit(batch).alias("snapshot_batch"),
        as_json(rows.columns).alias("entity_data"),
    )


def event_envelope(events: DataFrame, site_id: str, most: int = MAX_RECORD) -> DataFrame:
    """Events with id, captured_at, event_name, event_data (JSON) and user_agent; a body over the limit goes, and is marked.

    The limit is on the bytes of the whole record.
    """
    if not site_id:
        events = events.limit(0)
    out = events.withColumn("site_id", F.lit(site_id)).withColumn("record_type", F.lit("event")).withColumn("user_agent", text.user_agent(F.col("user_agent")))
    size = F.octet_length(as_json(out.columns))
    return out.withColumn("truncated", size > most).withColumn("event_data", F.when(size <= most, F.col("event_data")))


def gate(records: DataFrame, most: int = MAX_RECORD) -> tuple[DataFrame, DataFrame]:
    """(records within the limit, refused ones) by the bytes of their JSON line."""
    fits = F.octet_length("line") <= most
    return records.where(fits), records.where(~F.coalesce(fits, F.lit(False)))


def foreign(line: Column, site_id: str) -> Column:
    """Whether a line is an object that has a site_id other than ours; a null one is other, an absent one is not."""
    has = F.array_contains(F.json_object_keys(line), "site_id")
    own = F.get_json_object(line, "$.site_id")
    own = F.regexp_replace(F.coalesce(own, F.lit("")), r"^(-?\d+)\.0+$", "$1")
    return F.coalesce(has & (own != site_id), F.lit(False))


def owned(lines: DataFrame, site_id: str, column: str = "line") -> tuple[DataFrame, DataFrame]:
    """(lines that stay, lines of other sites); what can't be read stays."""
    theirs = foreign(F.col(column), site_id)
    return lines.where(~theirs), lines.where(theirs)


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row a key: the last in the given (descending) order."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def upserted(old: DataFrame, new: DataFrame, key: str, defaults: dict[str, Column], preserved: tuple[str, ...] = ("timecreated",)) -> DataFrame:
    """Rows of either side by key: new values over old ones, defaults for new rows only, preserved columns from the old."""
    a, b = old.alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    joined = a.withColumn("_old", F.lit(True)).alias("a").join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    out = []
    for c in old.columns:
        was = F.col(f"a.{c}")
        if c == key:
            out.append(F.coalesce(F.col(f"b.{c}"), was).alias(c))
        elif c not in new.columns:
            out.append(F.when(F.col("a._old"), was).otherwise(defaults.get(c, F.lit(None))).alias(c))
        elif c in preserved:
            out.append(F.when(F.col("a._old"), was).otherwise(F.coalesce(F.col(f"b.{c}"), defaults.get(c, F.lit(None)))).alias(c))
        else:
            fresh = F.when(F.col("a._old"), F.coalesce(F.col(f"b.{c}"), was)).otherwise(F.coalesce(F.col(f"b.{c}"), defaults.get(c, F.lit(None))))
            out.append(F.when(F.col("b._new"), fresh).otherwise(was).alias(c))
    return joined.select(*out)
