"""Descriptions of what is exported: catalog, settings of datatypes, drift, status."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import MAX_RECORD
from tidemark.sources import registry as reg

# Kinds of tables.
REQUIRED, OPTIONAL, LOGS = 0, 1, 2
LOG_DATATYPES = ("exceptions", "syslogs")

CONFIG = "datatype string, tabletype int, status int, exportenabled int, timemodified_field string, rewritable int, filterbyid int, events_tracking int, columns_missing string"


def datatype_config(spark: SparkSession, registry: Mapping[str, reg.Entity], overrides: Iterable[reg.Override], live: reg.Live, required: int = REQUIRED, optional: int = OPTIONAL, logs: int = LOGS) -> DataFrame:
    """One row a datatype, those switched off included; columns as built in, not as overridden."""
    by_name = {o.datatype: o for o in overrides}
    names = [*registry, *(n for n, o in by_name.items() if n not in registry and o.custom_table)]
    rows = []
    for name in names:
        e, o = registry.get(name), by_name.get(name)
        derived = bool(e and e.derived)
        own = e
        if e is None and o and o.custom_table and live(o.custom_table.strip()):
            own = reg.Entity(name, o.custom_table.strip(), tuple(reg.names_in(o.custom_columns)) or None)
        found = reg.resolved(own, live) if own and not derived else None
        mark = found.watermark if found else None
        on = 0 if o and not o.enabled else 1
        kind = o.tabletype if o and o.tabletype is not None else required if e else optional
        rows.append((name, kind, on, on, mark or "", int(mark is None), int(not derived), 0, ",".join(found.missing) if e and found else ""))
    rows += [(name, logs, int(by_name[name].enabled) if name in by_name else 1, int(by_name[name].enabled) if name in by_name else 1, "", 0, 0, 1, "") for name in LOG_DATATYPES]
    return spark.createDataFrame(rows, CONFIG)


def schema_catalog(spark: SparkSession, tables: Mapping[str, DataFrame], allowed: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """(datatype, field, type, nullable, primary_key) of every table's columns; a table without any is left out."""
    allowed = {k: {c.lower() for c in v} for k, v in (allowed or {}).items()}
    rows = [
        (name, f.name, f.dataType.simpleString(), f.nullable, bool(f.metadata.get("primary_key", False)))
        for name, df in tables.items()
        for f in df.schema.fields
        if name not in allowed or f.name.lower() in allowed[name]
    ]
    return spark.createDataFrame(rows, "datatype string, field string, type string, nullable boolean, primary_key boolean")


def catalog_record(catalog: DataFrame, most: int = MAX_RECORD) -> DataFrame:
    """The catalog as one JSON map; no row if it is over the limit. A catalog is as long as the schema, not the data."""
    field = F.struct("type", F.col("field").alias("name"), F.col("field").alias("original_name"), F.col("nullable").alias("null"), "primary_key")
    by_type = catalog.groupBy("datatype").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", field.alias("d"))))).alias("fields"))
    by_name = lambda a, b: F.when(a["datatype"] < b["datatype"], -1).otherwise(1)
    whole = by_type.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("datatype", F.struct(F.col("datatype").alias("name"), "fields").alias("d"))), by_name)).alias("m"))
    return whole.select(F.to_json("m").alias("catalog")).where(F.octet_length("catalog") <= most)


def drift(declared: DataFrame) -> DataFrame:
    """Per entity what is missing, of (entity, declared, live, optional) arrays of names."""
    lower = lambda c: F.transform(c, lambda x: F.lower(x))
    gone = F.array_except(lower("declared"), F.array_union(lower("live"), lower(F.coalesce("optional", F.array().cast("array<string>")))))
    return declared.select("entity", F.array_join(F.array_sort(gone), ",").alias("missing"), F.size(gone).cast("long").alias("n_missing"))


def drift_totals(found: DataFrame) -> DataFrame:
    return found.agg(F.count_if(F.col("n_missing") > 0).alias("entities"), F.coalesce(F.sum("n_missing"), F.lit(0)).alias("columns"))


def backfill_status(state: DataFrame) -> DataFrame:
    """Totals of (entity, watermark, done)."""
    return state.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("done") == 1).alias("done"), F.count_if(F.col("watermark") > 0).alias("started"))


def settings_pages(settings: DataFrame) -> DataFrame:
    """Settings (page, section, position, name) as one ordered list a page."""
    return settings.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "section", "name"))), lambda s: F.concat_ws(":", s["section"], s["name"])).alias("settings"))


def newest_revision(*columns: str):
    """The greatest of several revisions, 0 without any."""
    return F.coalesce(F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in columns]), F.lit(0))


def cleaned_setting(kind: str, value: str, choices: Iterable[str] = (), secret: bool = False) -> str:
    """A setting's value as it is stored; ValueError if it may not be written or doesn't fit."""
    if secret:
        raise ValueError("this setting is local")
    if kind == "checkbox":
        return "1" if value.strip().lower() in ("1", "true", "yes", "on") else "0"
    if kind == "select" and value not in set(choices):
        raise ValueError("not among the choices")
    if kind == "int" and str(int(value)) != value.strip():
        raise ValueError("not a whole number")
    return value


def as_document(registry: Mapping[str, reg.Entity]) -> str:
    return json.dumps({k: asdict(v) for k, v in registry.items()}, sort_keys=True)


def status(spark: SparkSession, **fields) -> DataFrame:
    """One row of named values: what the status call returns."""
    return spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in fields.items()))
