"""Scans, capture, identity, census and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text, timefmt
from tidemark.operators import capture, census, logs, numbering, records, settings
from tidemark.plans.base import AT, BATCH, SITE, query, uuid5_sql
from tidemark.sources import registry as reg
from tidemark.sources import tables as src
from tidemark.sources.tables import Tables

SINCE, UPTO = "1996-01-01", "1997-01-01"


def _ntz(text_: str):
    return F.expr(f"TIMESTAMP_NTZ'{text_}'")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_projected(t: Tables) -> DataFrame:
    entity = reg.Entity("customer", "customer", ("c_custkey", "C_NAME", "c_mktsegment", "c_ghost"))
    return src.scan(t, entity, key="c_custkey")


@query("SELECT doc_id, quality FROM labels")
def scan_forbidden_stripped(t: Tables) -> DataFrame:
    frames = {"sessions": t.read("labels").withColumn("sid", F.lit("s")).withColumn("Password", F.lit("p")).drop("toxic")}
    return src.scan(Tables(t.spark, frames=frames), reg.Entity("sessions", "sessions"), key="doc_id")


@query("SELECT conv_id, turn, role FROM conversations")
def scan_body_gated(t: Tables) -> DataFrame:
    frames = {"messages": t.read("conversations").withColumnRenamed("text", "fullmessage")}
    return src.scan(Tables(t.spark, frames=frames), reg.Entity("messages", "messages"), key="conv_id")


@query("SELECT * FROM (VALUES ('orders', 'o_ghost,o_other', 2::BIGINT), ('nation', '', 0::BIGINT)) v(entity, missing, n_missing)")
def column_drift(t: Tables) -> DataFrame:
    declared = {"orders": ["o_orderkey", "o_ghost", "O_CUSTKEY", "o_other"], "nation": ["n_nationkey", "n_later"]}
    optional = {"nation": ["n_later"]}
    rows = [(k, v, t.live(k), optional.get(k)) for k, v in declared.items()]
    return settings.drift(t.spark.createDataFrame(rows, "entity string, declared array<string>, live array<string>, optional array<string>"))


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}' AND o_orderdate <= TIMESTAMP '{UPTO}'")
def cdc_window(t: Tables) -> DataFrame:
    return capture.window(t.read("orders"), "o_orderdate", _ntz(SINCE), _ntz(UPTO)).select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    f"""
    SELECT {uuid5_sql(f"'{SITE}|orders|' || o_orderkey")} AS id, 'orders' AS entity, '{BATCH}' AS snapshot_batch, '{AT}' AS captured_at,
      to_json(struct_pack(o_orderkey := o_orderkey, o_custkey := o_custkey, o_orderstatus := o_orderstatus, o_orderpriority := o_orderpriority)) AS entity_data
    FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}' AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)
    """
)
def cdc_envelope(t: Tables) -> DataFrame:
    """Change-capture window over orders up to the mark read before the scan, as identified records."""
    orders = t.read("orders")
    upto = orders.agg(F.max("o_orderdate").alias("m")).scalar()
    entity = reg.Entity("orders", "orders", ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_password"))
    rows = src.scan(t, entity, (F.col("o_orderdate") > _ntz(SINCE)) & (F.col("o_orderdate") <= upto), key="o_orderkey")
    return records.snapshot_envelope(rows, "orders", SITE, BATCH, AT, "o_orderkey").select("id", "entity", "snapshot_batch", "captured_at", "entity_data")


@query(
    """
    SELECT 'orders' AS entity, epoch_us(max(o_orderdate))::BIGINT AS high_water FROM orders
    UNION ALL SELECT 'lineitem', epoch_us(max(l_shipdate))::BIGINT FROM lineitem
    UNION ALL SELECT 'events', epoch_us(max(ts))::BIGINT FROM events
    """
)
def cdc_high_water(t: Tables) -> DataFrame:
    marks = {n: (t.read(n), timefmt.micros(F.col(c))) for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))}
    return capture.high_waters(marks)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def range_refetch(t: Tables) -> DataFrame:
    return capture.between(t.read("lineitem"), "l_shipdate", _ntz("1997-01-01"), _ntz("1997-06-30")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 500")
def keyset_page(t: Tables) -> DataFrame:
    return src.after(t.read("orders").select("o_orderkey", "o_custkey"), "o_orderkey", 700, 500)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')")
def row_capture(t: Tables) -> DataFrame:
    rows = src.matching(t.read("orders"), {"o_orderstatus": "F"})
    keys = t.read("events").where("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    return src.changed(rows, keys, "o_custkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def task_scan(t: Tables) -> DataFrame:
    tasks = t.read("orders").select("o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("component"))
    return src.of_component(tasks, "O").drop("component")


@query("SELECT user_id AS id, count(*)::BIGINT AS logins FROM events WHERE event_type = 'signup' AND user_id > 0 GROUP BY user_id")
def user_logins(t: Tables) -> DataFrame:
    log = t.read("events").select(F.col("event_type").alias("eventname"), F.lit(1).alias("contextid"), F.col("user_id").alias("userid"))
    return src.user_logins(log, "signup")


@query(
    f"""
    SELECT {uuid5_sql(f"'{SITE}|nation|' || n_nationkey")} AS id, '{SITE}' AS site_id, '{AT}' AS captured_at, 'entity_snapshot' AS record_type,
      7::BIGINT AS plugin_version, NULL::BIGINT AS moodle_version, 'nation' AS entity, '{BATCH}' AS snapshot_batch,
      to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey, n_note := NULL)) AS entity_data
    FROM nation
    """
)
def snapshot_envelope(t: Tables) -> DataFrame:
    rows = t.read("nation").withColumn("n_note", F.lit(None).cast("string"))
    return records.snapshot_envelope(rows, "nation", SITE, BATCH, AT, "n_nationkey", (7, None))


@query(
    f"""
    SELECT {uuid5_sql(f"'{SITE}|region|' || r_regionkey")} AS id, 'region' AS entity, to_json(struct_pack(r_regionkey := r_regionkey, r_name := r_name)) AS entity_data FROM region
    UNION ALL
    SELECT {uuid5_sql(f"'{SITE}|nation|' || n_nationkey")}, 'nation', to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey)) FROM nation
    UNION ALL
    SELECT {uuid5_sql(f"'{SITE}|labels|' || doc_id")}, 'labels', to_json(struct_pack(doc_id := doc_id, quality := quality, toxic := toxic)) FROM labels
    """
)
def full_snapshot(t: Tables) -> DataFrame:
    """All entities of a registry as one stream of records."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "labels": "doc_id"}
    parts = None
    for name, key in keys.items():
        rows = src.scan(t, reg.Entity(name, name), key=key)
        part = records.snapshot_envelope(rows, name, SITE, BATCH, AT, key).select("id", "entity", "entity_data")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    f"""
    SELECT event_id, event_type AS event_name, site_id, record_type, strlen(j) > 125 AS truncated, CASE WHEN strlen(j) <= 125 THEN props END AS event_data
    FROM (SELECT *, '{SITE}' AS site_id, 'event' AS record_type, to_json(struct_pack(event_id := event_id, event_name := event_type, event_data := props, user_agent := NULL, site_id := '{SITE}', record_type := 'event')) AS j FROM events)
    """
)
def event_envelope(t: Tables) -> DataFrame:
    rows = t.read("events").select("event_id", F.col("event_type").alias("event_name"), F.col("props").alias("event_data"), F.lit("").alias("user_agent"))
    return records.event_envelope(rows, SITE, most=125).drop("user_agent")


@query("SELECT count(*)::BIGINT AS refused, (SELECT count(*) FROM documents WHERE strlen(text) <= 2000)::BIGINT AS taken FROM documents WHERE strlen(text) > 2000 OR text IS NULL")
def size_gate(t: Tables) -> DataFrame:
    taken, refused = records.gate(t.read("documents").select(F.col("text").alias("line")), 2000)
    return refused.agg(F.count(F.lit(1)).alias("refused")).crossJoin(taken.agg(F.count(F.lit(1)).alias("taken")))


@query("SELECT count(*)::BIGINT AS count, string_agg(r_regionkey::VARCHAR, ',' ORDER BY r_regionkey) AS pks FROM region")
def census_single(t: Tables) -> DataFrame:
    return census.single(t.read("region"), "r_regionkey").select("count", F.array_join("pks", ",").alias("pks"))


@query(
    """
    SELECT page, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS pks
    FROM (SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1)::INTEGER AS page FROM orders) GROUP BY page
    """
)
def census_paged(t: Tables) -> DataFrame:
    return census.pages(t.read("orders"), "o_orderkey", 1000, 512).select("page", F.array_join("pks", ",").alias("pks"))


@query("SELECT count(*)::BIGINT AS count, count(*) < 1000 AS is_single, CASE WHEN count(*) < 1000 THEN 0 ELSE ceil(count(*) / 1000.0) END::INTEGER AS page_count FROM orders")
def census_manifest(t: Tables) -> DataFrame:
    return census.manifest(t.read("orders"), 1000)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 7 = 0")
def reconcile_deletes(t: Tables) -> DataFrame:
    """Rows that a census of the rest doesn't have any more."""
    left = census.pages(t.read("orders").where("o_orderkey % 7 <> 0"), "o_orderkey", 1000, 512)
    return census.deleted(t.read("orders").select("o_orderkey", "o_custkey"), "o_orderkey", left)


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def upsert_latest(t: Tables) -> DataFrame:
    return records.latest(t.read("events"), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query(
    """
    SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN a.name ELSE coalesce(b.name, a.name) END AS name,
      CASE WHEN a.k IS NULL THEN 1 ELSE a.enabled END AS enabled, CASE WHEN a.k IS NULL THEN b.timecreated ELSE a.timecreated END AS timecreated
    FROM (SELECT s_suppkey AS k, s_name AS name, 0 AS enabled, 5::BIGINT AS timecreated FROM supplier WHERE s_suppkey % 3 <> 0) a
    FULL JOIN (SELECT s_suppkey AS k, 'new ' || s_name AS name, 9::BIGINT AS timecreated FROM supplier WHERE s_suppkey % 2 = 0) b ON a.k = b.k
    """
)
def upsert_settings(t: Tables) -> DataFrame:
    s = t.read("supplier")
    old = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit(0).alias("enabled"), F.lit(5).cast("long").alias("timecreated"))
    new = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("new "), "s_name").alias("name"), F.lit(9).cast("long").alias("timecreated"))
    return records.upserted(old, new, "k", {"enabled": F.lit(1)})


def _overrides() -> list[reg.Override]:
    return [
        reg.Override("customer", enabled=False),
        reg.Override("orders", custom_columns="o_orderkey, O_CUSTKEY\nno_such"),
        reg.Override("part", custom_columns="no_such"),
        reg.Override("mine", custom_table="supplier", custom_columns="s_suppkey s_name"),
        reg.Override("ghost", custom_table="no_such_table"),
    ]


def _registry() -> dict[str, reg.Entity]:
    declared = {"customer": ("c_custkey",), "orders": ("o_orderkey", "o_orderdate"), "part": ("p_partkey", "p_name", "p_ghost")}
    return {k: reg.Entity(k, k, v) for k, v in declared.items()} | {"region": reg.Entity("region", "region")}


@query(
    """
    SELECT * FROM (VALUES ('mine', 'supplier', 's_suppkey,s_name'), ('orders', 'orders', 'o_orderkey,o_custkey'),
      ('part', 'part', 'p_partkey,p_name,p_ghost'), ('region', 'region', '*')) v(entity, source, columns)
    """
)
def override_merge(t: Tables) -> DataFrame:
    merged = reg.effective(_registry(), _overrides(), t.live)
    return t.spark.createDataFrame([(e.name, e.table, ",".join(e.columns) if e.columns else "*") for e in merged.values()], "entity string, source string, columns string")


@query(
    """
    SELECT * FROM (VALUES
      ('customer', 0, 0, 0, '', 1, 1, 0, ''), ('orders', 0, 1, 1, '', 1, 1, 0, ''), ('part', 0, 1, 1, '', 1, 1, 0, ''), ('region', 0, 1, 1, '', 1, 1, 0, ''),
      ('logins', 0, 1, 1, '', 1, 0, 0, ''), ('mine', 1, 1, 1, '', 1, 1, 0, ''), ('ghost', 1, 1, 1, '', 1, 1, 0, ''), ('marked', 0, 1, 1, 'timemodified', 0, 1, 0, 'gone'),
      ('exceptions', 2, 1, 1, '', 0, 0, 1, ''), ('syslogs', 2, 1, 1, '', 0, 0, 1, ''))
      v(datatype, tabletype, status, exportenabled, timemodified_field, rewritable, filterbyid, events_tracking, columns_missing)
    """
)
def datatype_config(t: Tables) -> DataFrame:
    frames = {"marked": t.spark.createDataFrame([], "id long, timecreated long, timemodified long")}
    both = Tables(t.spark, t.folder, frames)
    registry = _registry() | {"logins": reg.Entity("logins", "events", derived=True), "marked": reg.Entity("marked", "marked", ("id", "timemodified", "gone"))}
    return settings.datatype_config(t.spark, registry, _overrides(), both.live)


@query(
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{d}', '{f}', '{k}', true, false)"
        for d, fs in {"region": {"r_regionkey": "int", "r_name": "string"}, "labels": {"doc_id": "bigint", "quality": "bigint"}}.items()
        for f, k in fs.items()
    )
    + ") v(datatype, field, type, nullable, primary_key)"
)
def schema_catalog(t: Tables) -> DataFrame:
    return settings.schema_catalog(t.spark, {"region": t.read("region"), "labels": t.read("labels").withColumn("quality", F.col("quality").cast("long"))}, {"labels": ["doc_id", "QUALITY"]})


@query("SELECT * FROM (VALUES ('local_a_one'), ('local_a_two'), ('local_b')) v(name)")
def discover_tables(t: Tables) -> DataFrame:
    names = reg.discovered(["local_a_two", "local_b", "other_a", "local_a_one", "local_c"], ["local_a_", "other_", "local_b"])
    return t.spark.createDataFrame([(n,) for n in names], "name string")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey DESC LIMIT 100 OFFSET 200")
def oplog_page(t: Tables) -> DataFrame:
    log = logs.filtered(t.read("orders").withColumn("type", F.col("o_orderstatus")), type="O", action=None)
    return logs.page(log, "o_orderkey", 2).select("o_orderkey", "o_custkey")


@query("SELECT count(*) FILTER (CASE WHEN value > 50 THEN value END IS NULL)::BIGINT AS pending FROM events")
def pending_count(t: Tables) -> DataFrame:
    return logs.pending(t.read("events").select(F.when(F.col("value") > 50, F.col("value")).alias("timestarted")))


@query("SELECT count(*)::BIGINT AS total, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS done, count(*) FILTER (o_custkey > 0)::BIGINT AS started FROM orders")
def backfill_status(t: Tables) -> DataFrame:
    return settings.backfill_status(t.read("orders").select(F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("watermark"), (F.col("o_orderstatus") == "F").cast("int").alias("done")))


@query("SELECT p_brand AS page, string_agg(p_type || ':' || p_name, '|' ORDER BY p_partkey) AS settings FROM part GROUP BY p_brand")
def settings_pages(t: Tables) -> DataFrame:
    rows = t.read("part").select(F.col("p_brand").alias("page"), F.col("p_type").alias("section"), F.col("p_partkey").alias("position"), F.col("p_name").alias("name"))
    return settings.settings_pages(rows).select("page", F.array_join("settings", "|").alias("settings"))


@query("SELECT c_custkey, greatest(coalesce(c_nationkey, 0), coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_custkey END, 0))::BIGINT AS revision FROM customer")
def newest_revision(t: Tables) -> DataFrame:
    rows = t.read("customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("a"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("b"))
    return rows.select("c_custkey", settings.newest_revision("a", "b").alias("revision"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)::BIGINT AS nth FROM lineitem")
def numbered_rows(t: Tables) -> DataFrame:
    """Row numbers over a whole table, bucket by bucket."""
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    out = numbering.running(t.read("lineitem"), F.floor(F.col("l_orderkey") / 1000), order, F.lit(1).cast("long"), "nth")
    return out.select("l_orderkey", "l_linenumber", "nth")


@query("SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name || ' ' END), ''), nullif(trim(c_mktsegment), ''), 'short') AS name FROM customer")
def role_names(t: Tables) -> DataFrame:
    resolved = F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.concat("c_name", F.lit(" ")))
    return t.read("customer").select("c_custkey", text.display_name(resolved, F.col("c_mktsegment"), F.lit("short")).alias("name"))
