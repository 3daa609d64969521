"""How queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SITE, BATCH, AT = "site-abc-123", "00000000-0000-4000-8000-000000000001", "2024-02-01T00:00:00.000000Z"


def query(sql: str | None = None):
    """Registers a function of Tables under its name, and its SQL."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def uuid5_sql(name: str, namespace: str = "6f1b2c3d4e5a4b6c8d7e9f0a1b2c3d4e") -> str:
    """SQL of a version-5 id."""
    h = f"sha1(unhex('{namespace}') || encode({name}))"
    variant = f"substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({h}, 17, 1)), 1)"
    return f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-5', substr({h}, 14, 3), '-', {variant}, substr({h}, 18, 3), '-', substr({h}, 21, 12))"
