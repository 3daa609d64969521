"""Row numbers and running sums over a whole table without gathering it in one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(rows: DataFrame, bucket: Column, order: list[Column], value: Column, name: str = "upto") -> DataFrame:
    """The sum of `value` up to and with each row, in the order of bucket, then order.

    bucket must not fall as the order rises. The sums of the buckets, one row each, are the only thing that is gathered.
    """
    rows = rows.withColumn("_bucket", bucket).withColumn("_value", value)
    totals = rows.groupBy("_bucket").agg(F.sum("_value").alias("_total"))
    before = F.coalesce(F.sum("_total").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(F.col("_bucket").alias("_b"), before.alias("_before"))
    within = F.sum("_value").over(Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.join(totals, F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumn(name, (F.col("_before") + within)).drop("_bucket", "_value", "_b", "_before")


def numbered(rows: DataFrame, key: str, width: int, name: str = "nth") -> DataFrame:
    """Numbers from 1 in the order of an integer key; width: keys in a bucket."""
    out = running(rows, F.floor(F.col(key) / width), [F.col(key)], F.lit(1).cast("long"), name)
    return out.withColumn(name, F.col(name).cast("long"))
