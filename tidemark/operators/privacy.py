"""Data subjects in the record stream: who they are, what there is about them, and its erasure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import loose_int


def subject_ids(line: Column) -> Column:
    """Distinct positive user ids that a record is about, by its kind; empty for what can't be read."""
    get = lambda path: loose_int(F.get_json_object(line, path))
    kind = F.get_json_object(line, "$.record_type")
    ids = (
        F.when(kind == "event", F.array(get("$.event_data.userid"), get("$.event_data.relateduserid")))
        .when(kind.isin("page_dwell", "media_segment"), F.array(get("$.dwell.userid")))
        .when(kind == "entity_snapshot", F.array(get("$.entity_data.userid")))
        .when(kind == "exception", F.array(get("$.userid")))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return F.array_distinct(F.filter(ids, lambda x: x > 0))


#: Targets of an erasure up to which they are listed in the plan.
MOST_LISTED = 1000


def about(records: DataFrame, user_id: int, line: str = "line") -> DataFrame:
    """All records about a user."""
    return records.where(F.array_contains(subject_ids(F.col(line)), F.lit(user_id).cast("long")))


def known(records: DataFrame, user_id: int, line: str = "line") -> bool:
    """Whether there is any; stops at the first."""
    return not about(records, user_id, line).isEmpty()


def subjects(records: DataFrame, line: str = "line") -> DataFrame:
    return records.select(F.explode(subject_ids(F.col(line))).alias("userid")).distinct()


def erased(records: DataFrame, targets: DataFrame, line: str = "line", rewritable: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records that stay, counts by path: removed, kept, skipped); targets has userid.

    What can't be read stays verbatim, as do records of files that can't be rewritten (live, or of another host).
    Up to MOST_LISTED targets go along with the plan, and records are told without a shuffle. More are joined to the
    records' ids, so that the list of targets may be of any size.
    """
    may = F.lit(True) if rewritable is None else rewritable
    few = [r.userid for r in targets.select(F.col("userid").cast("long").alias("userid")).where("userid IS NOT NULL").distinct().limit(MOST_LISTED + 1).collect()]
    if len(few) <= MOST_LISTED:
        about_any = F.exists(subject_ids(F.col(line)), lambda i: i.isin(few)) if few else F.lit(False)
        told = records.withColumn("_may", may).withColumn("_gone", F.col("_may") & F.coalesce(about_any, F.lit(False)))
        return told.where("NOT _gone").select(*records.columns), _counts(told)
    marked = records.withColumn("_row", F.xxhash64(*records.columns)).withColumn("_may", may)
    ids = marked.select("_row", line, F.explode(subject_ids(F.col(line))).alias("userid"))
    hit = ids.join(targets.select("userid").distinct(), "userid", "left_semi").select("_row", line).distinct().withColumn("_hit", F.lit(True))
    told = marked.join(hit, ["_row", line], "left").withColumn("_gone", F.col("_may") & F.coalesce("_hit", F.lit(False)))
    return told.where("NOT _gone").select(*records.columns), _counts(told)


def _counts(told: DataFrame) -> DataFrame:
    return told.groupBy("path").agg(F.count_if("_gone").alias("removed"), F.count_if(~F.col("_gone")).alias("kept"), F.count_if(~F.col("_may")).alias("skipped"))
