"""Change capture: closed windows between high-water marks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water(rows: DataFrame, mark: str) -> Any:
    """The highest mark, read before the scan; one value."""
    return rows.agg(F.max(mark)).first()[0]


def high_waters(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(entity, high_water) of all tables in one job."""
    parts = [rows.agg(F.max(mark).alias("high_water")).select(F.lit(name).alias("entity"), "high_water") for name, (rows, mark) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def window(rows: DataFrame, mark: str, since: Any, upto: Any) -> DataFrame:
    """Rows with since < mark <= upto; nothing if the mark is unknown or hasn't moved."""
    values = not isinstance(upto, Column) and not isinstance(since, Column)
    if upto is None or (values and since is not None and upto <= since):
        return rows.limit(0)
    within = F.col(mark) <= F.lit(upto)
    return rows.where(within if since is None else (F.col(mark) > F.lit(since)) & within)


def between(rows: DataFrame, mark: str | None, first: Any, last: Any) -> DataFrame:
    """Both ends included; the whole table without a mark or an end."""
    if mark is None or first is None or last is None:
        return rows
    return rows.where(F.col(mark).between(F.lit(first), F.lit(last)))


def requested(names: list[str], known: set[str], first: int, last: int) -> tuple[list[str], list[str]]:
    """(entities to fetch again, unknown ones); ValueError for a window that isn't one."""
    if not 0 < first < last:
        raise ValueError("the window must be positive and end after it starts")
    return [n for n in names if n in known], [n for n in names if n not in known]
