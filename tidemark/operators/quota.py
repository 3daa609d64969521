"""Rate limits in tumbling windows, and throttles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

GLOBAL_FACTOR = 10


def per_key(rows: DataFrame, key: str, window: Column, order: list[str], most: int) -> DataFrame:
    """The first `most` rows of a key in each window; all of them if most is 0. Spark limits before it shuffles.

    A key that names nobody, null or a number of 0 or less, isn't limited.
    """
    if most <= 0:
        return rows
    nobody = named_by_nobody(rows, key)
    nth = F.row_number().over(Window.partitionBy(key, "_window").orderBy(*order))
    few = rows.where(~nobody).withColumn("_window", window).withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_nth", "_window")
    return few.unionByName(rows.where(nobody))


def named_by_nobody(rows: DataFrame, key: str) -> Column:
    """Whether a row's key is null or, for numbers, 0 or less."""
    none = F.col(key).isNull()
    return none | (F.col(key) <= 0) if isinstance(rows.schema[key].dataType, NumericType) else none


def two_levels(rows: DataFrame, key: str, window: Column, order: list[str], most: int, factor: int = GLOBAL_FACTOR) -> DataFrame:
    """Accepted rows where a key may have `most` and all keys together factor * most in a window, and only accepted rows count.

    While the common limit isn't reached, a row is accepted if it is among its key's first; from then on nothing is. So
    the accepted rows are the first factor * most among those.
    """
    if most <= 0:
        return rows
    rows = rows.withColumn("_window", window)
    own = F.row_number().over(Window.partitionBy("_window", key).orderBy(*order))
    few = rows.withColumn("_own", own).where(F.col("_own") <= most).drop("_own")
    all_ = F.row_number().over(Window.partitionBy("_window").orderBy(*order))
    return few.withColumn("_all", all_).where(F.col("_all") <= factor * most).drop("_all", "_window")


def throttled(rows: DataFrame, key: str, at: str, gap: int) -> DataFrame:
    """Markers that are let through: at least `gap` after the last that was, by key. at: a number."""
    listed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.col(at).cast("long"))).alias("ts"))
    start = F.array().cast("array<bigint>")
    passed = F.aggregate("ts", start, lambda out, t: F.when((F.size(out) == 0) | (t - F.element_at(out, -1) >= gap), F.concat(out, F.array(t))).otherwise(out))
    # element_at of an empty array isn't reached, as the first condition holds there.
    return listed.select(key, F.explode(passed).alias(at))
