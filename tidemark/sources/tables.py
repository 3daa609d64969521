"""Tables by name, and scans of entities over them. Every scan goes through `scan`, which no forbidden column passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import registry as reg


class Tables:
    """Readable tables: Parquet files in a folder, or DataFrames by name.

    by_table: further columns by table that no scan of these tables lets out, beside those of the registry.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, frames: Mapping[str, DataFrame] | None = None, by_table: Mapping[str, Iterable[str]] | None = None):
        self.spark, self.folder, self.frames = spark, folder, dict(frames or {})
        self.by_table = {**reg.FORBIDDEN_TABLE_COLUMNS, **{t: (*reg.FORBIDDEN_TABLE_COLUMNS.get(t, ()), *cs) for t, cs in (by_table or {}).items()}}
        self._live: dict[str, list[str] | None] = {}

    def read(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def live(self, name: str) -> list[str] | None:
        """Columns of a table, None where there is none; looked up once."""
        if name not in self._live:
            try:
                self._live[name] = self.read(name).columns
            except Exception as missing:
                if "PATH_NOT_FOUND" not in str(missing):
                    raise
                self._live[name] = None
        return self._live[name]

    def forget(self) -> None:
        """After a change of the tables or their settings."""
        self._live.clear()


def scan(tables: Tables, entity: reg.Entity, where: Column | None = None, bodies: bool = False, key: str = "id") -> DataFrame | None:
    """The entity's rows; None where the table or the key is missing. Filter and columns reach the files."""
    if tables.live(entity.table) is None:
        return None
    safe = reg.stripped({entity.name: entity}, tables.live, bodies, tables.by_table)[entity.name]
    columns = safe.columns if safe.columns is not None else tuple(tables.live(entity.table) or ())
    have, _ = reg.intersected(columns, tables.live(entity.table) or [])
    if key.lower() not in {c.lower() for c in have}:
        return None
    rows = tables.read(entity.table)
    rows = rows if where is None else rows.where(where)
    return rows.select(*have)


def without_forbidden(rows: DataFrame, entity: reg.Entity, bodies: bool = False, by_table: Mapping[str, Iterable[str]] = reg.FORBIDDEN_TABLE_COLUMNS) -> DataFrame:
    """The same guard for whole rows fetched elsewhere."""
    never = reg.forbidden_for(entity, bodies, by_table)
    return rows.select(*[c for c in rows.columns if c.lower() not in never])


def matching(rows: DataFrame, conditions: Mapping[str, Any]) -> DataFrame:
    """Rows that equal a map of values; no row for an empty map."""
    if not conditions:
        return rows.limit(0)
    return rows.where(reduce(lambda a, b: a & b, [F.col(k).isNull() if v is None else F.col(k) == v for k, v in conditions.items()]))


def changed(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a feed of changes."""
    return rows.join(keys.select(on).distinct(), on, "left_semi")


def after(rows: DataFrame, key: str, last: Any, most: int | None = None) -> DataFrame:
    """The keyset page after a key: in order, limited where a limit is given."""
    page = rows.where(F.col(key) > F.lit(last)).orderBy(key)
    return page if most is None else page.limit(most)


def of_component(tasks: DataFrame, component: str) -> DataFrame:
    """Task rows of one component only: the filter is part of the scan."""
    return tasks.where(F.col("component") == component)


def user_logins(log: DataFrame, event: str, site_context: int = 1) -> DataFrame:
    """Derived entity: logins a user, from the log."""
    own = log.where((F.col("eventname") == event) & (F.col("contextid") == site_context) & (F.col("userid") > 0))
    return own.groupBy(F.col("userid").alias("id")).agg(F.count(F.lit(1)).alias("logins"))


DERIVED: dict[str, Callable[..., DataFrame]] = {"userlogins": user_logins}


def export_all(tables: Tables, registry: Mapping[str, reg.Entity], envelope: Callable[[DataFrame, reg.Entity], DataFrame]) -> DataFrame | None:
    """The rows of every table-backed entity as one stream of records."""
    parts = [envelope(rows, e) for e in registry.values() if not e.derived and (rows := scan(tables, e)) is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def sessions_in(column: Column, ids: Iterable[Any]) -> Column:
    return column.isin(*ids)
