"""Primary-key census: which rows there are, in pages, so that deletes can be told downstream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import numbering

PAGE = 50_000


def pages(rows: DataFrame, key: str, size: int = PAGE, width: int = 1_000_000) -> DataFrame:
    """(page, pks): keys as strings in key order, `size` on a page. Pages are made where their keys are."""
    at = numbering.numbered(rows.select(F.col(key).alias("pk")), "pk", width)
    paged = at.withColumn("page", F.floor((F.col("nth") - 1) / size).cast("int") + 1)
    listed = F.transform(F.array_sort(F.collect_list("pk")), lambda x: x.cast("string"))
    return paged.groupBy("page").agg(listed.alias("pks"))


def manifest(rows: DataFrame, size: int = PAGE) -> DataFrame:
    """One row: whether the census is a single record, its number of pages, and the count. Exactly one full page has a manifest."""
    count = F.count(F.lit(1))
    return rows.agg(count.alias("count"), (count < size).alias("is_single"), F.when(count < size, 0).otherwise(F.ceil(count / size)).cast("int").alias("page_count"))


def single(rows: DataFrame, key: str) -> DataFrame:
    """The census of a small table as one record."""
    return rows.agg(F.count(F.lit(1)).alias("count"), F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")).alias("pks"))


def deleted(warehouse: DataFrame, key: str, census: DataFrame, complete: bool = True) -> DataFrame:
    """Warehouse rows that a complete census doesn't have; none if the census isn't complete."""
    if not complete:
        return warehouse.limit(0)
    present = census.select(F.explode("pks").alias("_pk"))
    return warehouse.join(present, F.col(key).cast("string") == F.col("_pk"), "left_anti")
