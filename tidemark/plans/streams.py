"""The record stream: shipping, pull, privacy, dwell, quotas, logs and attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify, identity, text, timefmt
from tidemark.operators import attendance, dwell, logs, privacy, pull, quota, records, shipping
from tidemark.plans.base import SITE, query
from tidemark.schemas import ATTENDEES
from tidemark.sources.tables import Tables

_LINE_SQL = f"""
  SELECT event_id, CASE event_id % 5
    WHEN 0 THEN '{{"id":"' || event_id || '","site_id":"{SITE}"}}'
    WHEN 1 THEN '{{"id":"' || event_id || '","site_id":"other"}}'
    WHEN 2 THEN '{{"id":"' || event_id || '","site_id":null}}'
    WHEN 3 THEN '{{"id":"' || event_id || '"}}'
    ELSE 'not json ' || event_id END AS line
  FROM events
"""


def _site_lines(t: Tables) -> DataFrame:
    n, kind = F.col("event_id").cast("string"), F.col("event_id") % 5
    made = lambda tail: F.concat(F.lit('{"id":"'), n, F.lit(tail))
    line = F.when(kind == 0, made(f'","site_id":"{SITE}"}}')).when(kind == 1, made('","site_id":"other"}')).when(kind == 2, made('","site_id":null}')).when(kind == 3, made('"}')).otherwise(F.concat(F.lit("not json "), n))
    return t.read("events").select("event_id", line.alias("line"))


@query(f"SELECT event_id, line FROM ({_LINE_SQL}) WHERE event_id % 5 NOT IN (1, 2)")
def ownership_filter(t: Tables) -> DataFrame:
    return records.owned(_site_lines(t), SITE)[0]


@query("SELECT count(*)::BIGINT AS dropped FROM events WHERE event_id % 5 IN (1, 2)")
def ownership_dropped(t: Tables) -> DataFrame:
    return records.owned(_site_lines(t), SITE)[1].agg(F.count(F.lit(1)).alias("dropped"))


_NAME_SQL = """
  SELECT event_id, epoch_us(ts) AS us,
    'events-' || user_id || '-' || epoch_us(ts) || CASE WHEN event_id % 3 = 0 THEN '' ELSE '-' || substr(md5(event_id::VARCHAR), 1, 8) END
    || CASE WHEN event_id % 4 = 0 THEN '' ELSE '-h' || substr(sha256(user_id::VARCHAR), 1, 8) END
    || CASE WHEN event_id % 7 = 0 THEN '.json' ELSE '.jsonl' END || CASE event_id % 5 WHEN 0 THEN '.closed' WHEN 1 THEN '.pulled' ELSE '' END AS name
  FROM events
"""


def _names(t: Tables) -> DataFrame:
    e = F.col("event_id")
    us = timefmt.micros(F.col("ts"))
    name = F.concat(
        F.lit("events-"),
        F.col("user_id").cast("string"),
        F.lit("-"),
        us.cast("string"),
        F.when(e % 3 == 0, "").otherwise(F.concat(F.lit("-"), F.substring(F.md5(e.cast("string").cast("binary")), 1, 8))),
        F.when(e % 4 == 0, "").otherwise(F.concat(F.lit("-h"), identity.short_sha256(F.col("user_id").cast("string"), 8))),
        F.when(e % 7 == 0, ".json").otherwise(".jsonl"),
        F.when(e % 5 == 0, ".closed").when(e % 5 == 1, ".pulled").otherwise(""),
    )
    return t.read("events").select("event_id", us.alias("us"), name.alias("name"))


_GRAMMAR = r"^events-(\d+)-(\d+)(?:-([0-9a-z]+))?(?:-h([0-9a-f]+))?\.jsonl(?:\.closed|\.pulled)?$"


@query(
    rf"""
    SELECT event_id, name, CASE WHEN ok THEN regexp_extract(name, '{_GRAMMAR}', 1)::BIGINT END AS pid, CASE WHEN ok THEN regexp_extract(name, '{_GRAMMAR}', 2)::BIGINT END AS created_us,
      CASE WHEN ok THEN nullif(regexp_extract(name, '{_GRAMMAR}', 3), '') END AS token, CASE WHEN ok THEN nullif(regexp_extract(name, '{_GRAMMAR}', 4), '') END AS hostid
    FROM (SELECT *, regexp_matches(name, '{_GRAMMAR}') AS ok FROM ({_NAME_SQL}))
    """
)
def file_name_parse(t: Tables) -> DataFrame:
    return _names(t).withColumn("p", timefmt.parsed_file_name(F.concat(F.lit("/any/dir/"), "name"))).select("event_id", "name", "p.pid", "p.created_us", "p.token", "p.hostid")


@query(
    rf"""
    SELECT event_id, CASE WHEN NOT ok AND NOT starts_with(name, 'events-') THEN 'unowned'
      WHEN CASE WHEN ok AND regexp_extract(name, '{_GRAMMAR}', 4) = substr(sha256('7'), 1, 8) THEN event_id % 2 = 0 OR idle >= 120 ELSE idle >= 180 END THEN 'stale' ELSE 'active' END AS state
    FROM (SELECT event_id, event_id % 300 AS idle, name, regexp_matches(name, '{_GRAMMAR}') AS ok
      FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'x' ELSE '' END || name AS name FROM ({_NAME_SQL})))
    """
)
def stale_files(t: Tables) -> DataFrame:
    import hashlib

    host = hashlib.sha256(b"7").hexdigest()[:8]
    rows = _names(t).withColumn("name", F.concat(F.when(F.col("event_id") % 11 == 0, "x").otherwise(""), "name"))
    state = classify.stale_class(F.col("name"), timefmt.parsed_file_name(F.col("name")), F.col("event_id") % 300, F.col("event_id") % 2 != 0, host)
    return rows.select("event_id", state.alias("state"))


_FILES_SQL = "SELECT doc_id, strftime(DATE '2026-08-03' + (doc_id % 40)::INTEGER, '%Y/%m/%d') AS datebucket, 'f' || doc_id AS path, n_chars AS size FROM documents"


def _files(t: Tables) -> DataFrame:
    day = F.date_format(F.date_add(F.lit("2026-08-03").cast("date"), (F.col("doc_id") % 40).cast("int")), "yyyy/MM/dd")
    return t.read("documents").select(day.alias("datebucket"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size"), F.col("doc_id").alias("ord"))


_PLAN_SQL = f"""
  WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY datebucket ORDER BY doc_id) AS i FROM ({_FILES_SQL})),
  r AS (
    SELECT datebucket, i, path, size AS used, 1::BIGINT AS no FROM f WHERE i = 1
    UNION ALL
    SELECT f.datebucket, f.i, f.path, CASE WHEN r.used + f.size > 20000 THEN f.size ELSE r.used + f.size END, CASE WHEN r.used + f.size > 20000 THEN r.no + 1 ELSE r.no END
    FROM r JOIN f ON f.datebucket = r.datebucket AND f.i = r.i + 1
  )
  SELECT datebucket, no, string_agg(path, ',' ORDER BY i) AS paths, list(path) AS names FROM r GROUP BY ALL
"""


@query(f"SELECT datebucket, no AS batch_no, paths FROM (SELECT datebucket, no, string_agg(paths, '') AS paths FROM ({_PLAN_SQL.replace(', list(path) AS names', '')}) GROUP BY ALL)")
def plan_batches(t: Tables) -> DataFrame:
    return shipping.planned(_files(t), 20_000).select("datebucket", "batch_no", F.array_join("paths", ",").alias("paths"))


@query(
    f"""
    SELECT 'events/{SITE}/' || datebucket || '/batch-' || min(doc_id) || '-' || count(*) || '-' || substr(sha256(string_agg(path, chr(10) ORDER BY path)), 1, 8) || '.jsonl.gz' AS object_key
    FROM ({_FILES_SQL}) GROUP BY datebucket
    """
)
def object_key(t: Tables) -> DataFrame:
    groups = _files(t).groupBy("datebucket").agg(F.collect_list(F.concat(F.lit("/buffer/"), "path", F.lit(".closed"))).alias("names"), F.collect_list("ord").alias("times"))
    return groups.select(shipping.object_key("events", SITE, F.col("datebucket"), F.col("names"), F.col("times")).alias("object_key"))


@query(
    """
    SELECT path, size FROM (
      SELECT 'f' || doc_id AS path, n_chars AS size, sum(n_chars) OVER (ORDER BY (doc_id * 37) % 1000, 'f' || doc_id) AS upto FROM documents WHERE doc_id % 10 <> 0)
    WHERE upto - size < (SELECT sum(n_chars) - 200000 FROM documents)
    """
)
def evict_oldest(t: Tables) -> DataFrame:
    d = t.read("documents")
    files = d.select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size"), (F.col("doc_id") * 37 % 1000).alias("modified"), (F.col("doc_id") % 10 != 0).alias("closed"))
    return shipping.evicted(files, 200_000, F.floor(F.col("modified") / 50)).select("path", "size")


@query("SELECT doc_id, (strlen(text) - strlen(replace(text, chr(10), '')))::BIGINT AS events FROM documents")
def file_events(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", shipping.line_count(F.col("text")).alias("events"))


@query("SELECT count(DISTINCT doc_id)::BIGINT AS entries, sum(n_chars)::BIGINT AS bytes FROM documents")
def buffer_occupied(t: Tables) -> DataFrame:
    return shipping.occupied(t.read("documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size")))


@query(f"SELECT count(DISTINCT regexp_extract(name, '{_GRAMMAR}', 4))::BIGINT AS hosts FROM ({_NAME_SQL}) WHERE regexp_matches(name, '{_GRAMMAR}') AND regexp_extract(name, '{_GRAMMAR}', 4) NOT IN ('', substr(sha256('7'), 1, 8))")
def foreign_hosts(t: Tables) -> DataFrame:
    import hashlib

    return shipping.foreign_hosts(_names(t).select(F.col("name").alias("path")), hashlib.sha256(b"7").hexdigest()[:8])


_TYPE_SQL = "CASE event_id % 4 WHEN 0 THEN 'event' WHEN 1 THEN 'page_dwell' WHEN 2 THEN 'syslog' ELSE 'exception' END"
_PULL_SQL = f"""
  SELECT event_id, user_id, event_id // 500 AS file_no, event_id % 13 <> 0 AS ok, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000Z' AS taken, {_TYPE_SQL} AS kind FROM events
"""


def _stream(t: Tables) -> DataFrame:
    """Records of several kinds, every 13th line broken, in files of 500."""
    e = F.col("event_id")
    kind = F.when(e % 4 == 0, "event").when(e % 4 == 1, "page_dwell").when(e % 4 == 2, "syslog").otherwise("exception")
    at = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000000Z"))
    body = F.to_json(F.struct(e.cast("string").alias("id"), at.alias("captured_at"), kind.alias("record_type"), F.col("event_type").alias("event_name")))
    return t.read("events").select(F.floor(e / 500).alias("modified"), F.concat(F.lit("f"), F.floor(e / 500).cast("string")).alias("path"), e.alias("line_no"), F.when(e % 13 != 0, body).otherwise(F.concat(F.lit("{broken"), e.cast("string"))).alias("line"))


_WANT = "ok AND kind IN ('event', 'exception') AND taken >= '2024-01-10T00:00:00.000000Z'"


@query(f"SELECT event_id::VARCHAR AS id, kind AS record_type, taken AS captured_at, (SELECT event_type FROM events e WHERE e.event_id = p.event_id) AS entity FROM ({_PULL_SQL}) p WHERE {_WANT} ORDER BY file_no, event_id LIMIT 700")
def pull_drain(t: Tables) -> DataFrame:
    out, _, _ = pull.drained(_stream(t), ["event", "exception", "nonsense"], "2024-01-10T00:00:00Z", 700)
    return out.select("id", "record_type", "captured_at", "entity")


@query(
    f"""
    WITH p AS ({_PULL_SQL}), w AS (SELECT event_id, row_number() OVER (ORDER BY file_no, event_id) AS n FROM p WHERE {_WANT}),
      edge AS (SELECT CASE WHEN (SELECT count(*) FROM w) >= 700 THEN (SELECT event_id FROM w WHERE n = 700) ELSE 9223372036854775807 END AS e)
    SELECT event_id AS line_no FROM p WHERE event_id NOT IN (SELECT event_id FROM w WHERE n <= 700) AND NOT (NOT ok AND event_id <= (SELECT e FROM edge))
    """
)
def pull_survivors(t: Tables) -> DataFrame:
    _, left, _ = pull.drained(_stream(t), ["event", "exception"], "2024-01-10T00:00:00.000000Z", 700, as_time=False)
    return left.select("line_no")


_SUBJECT_SQL = """
  SELECT event_id AS n, CASE event_id % 5 WHEN 0 THEN list_distinct([x for x in [user_id, event_id % 50] if x > 0]) WHEN 1 THEN [x for x in [user_id] if x > 0]
    WHEN 2 THEN [x for x in [user_id] if x > 0] WHEN 3 THEN [x for x in [user_id] if x > 0] ELSE [] END AS ids
  FROM events
"""


def _personal(t: Tables) -> DataFrame:
    u, n = F.col("user_id").cast("string"), F.col("event_id")
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    made = (
        F.when(n % 5 == 0, line('{"record_type":"event","event_data":{"userid":', u, ',"relateduserid":"', (n % 50).cast("string"), '"}}'))
        .when(n % 5 == 1, line('{"record_type":"page_dwell","dwell":{"userid":', u, "}}"))
        .when(n % 5 == 2, line('{"record_type":"entity_snapshot","entity_data":{"id":1,"userid":"', u, '"}}'))
        .when(n % 5 == 3, line('{"record_type":"exception","userid":', u, "}"))
        .otherwise(line("{undecodable ", u))
    )
    return t.read("events").select(n.alias("n"), F.concat(F.lit("f"), (n % 9).cast("string")).alias("path"), made.alias("line"))


@query(f"SELECT n, array_to_string(list_sort(ids), ',') AS ids FROM ({_SUBJECT_SQL})")
def subject_ids(t: Tables) -> DataFrame:
    return _personal(t).select("n", F.array_join(F.array_sort(privacy.subject_ids(F.col("line"))), ",").alias("ids"))


@query(f"SELECT n FROM ({_SUBJECT_SQL}) WHERE list_contains(ids, 17)")
def subject_access(t: Tables) -> DataFrame:
    return privacy.about(_personal(t), 17).select("n")


@query(f"SELECT DISTINCT unnest(ids)::BIGINT AS userid FROM ({_SUBJECT_SQL})")
def subjects(t: Tables) -> DataFrame:
    return privacy.subjects(_personal(t))


@query(f"SELECT n FROM ({_SUBJECT_SQL}) WHERE NOT list_has_any(ids, (SELECT list(c_custkey) FROM customer WHERE c_custkey % 4 = 0)) OR n % 9 = 3")
def erase_subjects(t: Tables) -> DataFrame:
    targets = t.read("customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("userid"))
    return privacy.erased(_personal(t), targets, rewritable=F.col("path") != "f3")[0].select("n")


@query(
    f"""
    SELECT 'f' || (n % 9) AS path, count_if(gone)::BIGINT AS removed, count_if(NOT gone)::BIGINT AS kept, count_if(n % 9 = 3)::BIGINT AS skipped
    FROM (SELECT n, list_has_any(ids, (SELECT list(c_custkey) FROM customer WHERE c_custkey % 4 = 0)) AND n % 9 <> 3 AS gone FROM ({_SUBJECT_SQL})) GROUP BY 1
    """
)
def erasure_counts(t: Tables) -> DataFrame:
    targets = t.read("customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("userid"))
    return privacy.erased(_personal(t), targets, rewritable=F.col("path") != "f3")[1]


@query(
    """
    WITH d AS (SELECT event_id, user_id, event_id % 400 AS cid, CASE WHEN event_id % 3 = 0 THEN event_id % 30 END AS claimed FROM events),
    c AS (SELECT c_custkey AS id, 50 AS lvl, c_custkey * 2 AS inst, CASE WHEN c_nationkey % 4 = 0 THEN 1 WHEN c_nationkey % 4 = 1 THEN NULL ELSE c_nationkey END AS course FROM customer WHERE c_custkey % 10 <> 3),
    j AS (SELECT d.*, c.id IS NOT NULL AS found, lvl, inst, coalesce(CASE WHEN course <> 1 THEN course END, CASE WHEN claimed > 0 AND claimed <> 1 THEN claimed END) AS want FROM d LEFT JOIN c ON d.cid = c.id AND d.cid > 0),
    k AS (SELECT *, want IS NULL OR (want < 25 AND (want + user_id) % 3 <> 0) AS keeps FROM j)
    SELECT event_id, CASE WHEN keeps THEN want END::BIGINT AS courseid, CASE WHEN keeps AND found THEN cid ELSE 0 END::BIGINT AS contextid,
      CASE WHEN keeps AND found THEN lvl ELSE 0 END::INTEGER AS contextlevel, CASE WHEN keeps AND found THEN inst ELSE 0 END::BIGINT AS contextinstanceid
    FROM k
    """
)
def context_attribution(t: Tables) -> DataFrame:
    n = F.col("c_nationkey").cast("long")
    rows = t.read("events").select("event_id", F.col("user_id").alias("userid"), (F.col("event_id") % 400).alias("contextid"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 30).alias("courseid"))
    contexts = t.read("customer").where("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("id"), F.lit(50).alias("contextlevel"), (F.col("c_custkey") * 2).alias("instanceid"), F.when(n % 4 == 0, 1).when(n % 4 == 1, None).otherwise(n).cast("long").alias("courseid"))
    people = t.read("events").select(F.col("user_id").alias("userid")).distinct()
    access = people.select("userid", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(24).cast("long"))).alias("courseid")).where("(courseid + userid) % 3 <> 0")
    return dwell.attributed(rows, contexts, access).drop("userid")


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'media_segment' ELSE 'page_dwell' END AS record_type,
      CASE WHEN event_type IN ('course', 'error') THEN 'course' ELSE 'other' END AS page,
      least(greatest(((value - 20) * 300000)::BIGINT, 0), 14400000)::BIGINT AS timespent_ms,
      CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE 'NOW' END AS started_at,
      CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'audio' ELSE 'video' END END AS media_kind,
      CASE WHEN event_type = 'view' THEN greatest(event_id - 100, 0) END::BIGINT AS media_pos_sec,
      CASE WHEN event_type = 'view' THEN greatest(coalesce(CASE WHEN event_id % 4 > 0 THEN event_id % 4 - 1 END, 30), 1) END::BIGINT AS bucket_sec
    FROM events
    """
)
def dwell_clamped(t: Tables) -> DataFrame:
    e = F.col("event_id")
    beacons = t.read("events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "media_segment").otherwise(F.col("event_type")).alias("record_type"),
        F.when(F.col("event_type") == "error", "course").otherwise(F.col("event_type")).alias("page"),
        F.round((F.col("value") - 20) * 300000).cast("long").alias("timespent_ms"),
        F.when(e % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("yesterday").alias("started_at"),
        F.lit(None).cast("string").alias("url"),
        F.lit("m").alias("media_id"),
        F.when(e % 3 == 0, "audio").otherwise("film").alias("media_kind"),
        (e - 100).alias("media_pos_sec"),
        F.when(e % 4 > 0, e % 4 - 1).alias("bucket_sec"),
    )
    return dwell.validated(beacons, "NOW", media=True).select("event_id", "record_type", "page", "timespent_ms", "started_at", "media_kind", "media_pos_sec", "bucket_sec")


@query(
    """
    SELECT event_id, bucket, previous FROM (
      SELECT event_id, floor(value / 30)::BIGINT AS bucket, lag(floor(value / 30)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    WHERE previous IS NOT NULL AND previous <> bucket
    """
)
def media_buckets(t: Tables) -> DataFrame:
    return dwell.media_changes(t.read("events"), ["user_id"], ["ts", "event_id"], F.col("value"), 30).select("event_id", "bucket", "previous")


_DAY = "date_trunc('day', ts)"


@query(f"SELECT event_id, user_id FROM events QUALIFY user_id IS NULL OR user_id <= 0 OR row_number() OVER (PARTITION BY user_id, {_DAY} ORDER BY ts, event_id) <= 2")
def rate_limit_user(t: Tables) -> DataFrame:
    return quota.per_key(t.read("events"), "user_id", F.to_date("ts"), ["ts", "event_id"], 2).select("event_id", "user_id")


@query(
    f"""
    SELECT event_id FROM (SELECT event_id, ts, {_DAY} AS d, row_number() OVER (PARTITION BY {_DAY}, user_id ORDER BY ts, event_id) AS own FROM events)
    WHERE own <= 2 QUALIFY row_number() OVER (PARTITION BY d ORDER BY ts, event_id) <= 20
    """
)
def rate_limit_two_level(t: Tables) -> DataFrame:
    return quota.two_levels(t.read("events"), "user_id", F.to_date("ts"), ["ts", "event_id"], 2, 10).select("event_id")


@query(
    """
    WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) // 1000000 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE event_type = 'error'),
    r AS (SELECT user_id, i, s, s AS last, true AS sent FROM e WHERE i = 1
      UNION ALL SELECT e.user_id, e.i, e.s, CASE WHEN e.s - r.last >= 86400 THEN e.s ELSE r.last END, e.s - r.last >= 86400 FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
    SELECT user_id, s::BIGINT AS at FROM r WHERE sent
    """
)
def marker_throttle(t: Tables) -> DataFrame:
    rows = t.read("events").where("event_type = 'error'").select("user_id", timefmt.seconds(timefmt.micros(F.col("ts"))).alias("at"))
    return quota.throttled(rows, "user_id", "at", 86_400)


_EVENT_NAMES = {"click": r"\core\event\role_assigned", "error": r"\core\event\roleXassigned", "purchase": r"\core\event\user_created", "signup": r"\core\event\course_category_updated", "view": r"\mod\event\user_created"}


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase', 'signup')")
def admin_action_view(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in _EVENT_NAMES.items() for x in pair])
    return t.read("events").where(logs.is_admin_action(names[F.col("event_type")])).select("event_id", "event_type")


@query(
    """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'failed: ' || user_id WHEN 1 THEN 'text ' || user_id WHEN 2 THEN 'Web service exception' END AS error_message
    FROM events WHERE event_type = 'error' AND event_id % 6 < 3
    """
)
def exception_records(t: Tables) -> DataFrame:
    e, u = F.col("event_id") % 6, F.col("user_id").cast("string")
    other = (
        F.when(e == 0, F.concat(F.lit('{"exception":{"message":"failed: '), u, F.lit('"}}')))
        .when(e == 1, F.concat(F.lit('{"exception":"text '), u, F.lit('"}')))
        .when(e == 2, F.lit('{"exception":{"code":3}}'))
        .when(e == 3, F.lit('{"exception":""}'))
        .when(e == 4, F.lit('{"exception":[]}'))
        .otherwise(F.lit('{"k":1}'))
    )
    return logs.exceptions(t.read("events").where("event_type = 'error'").withColumn("other", other)).select("event_id", "error_message")


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (3, 5)")
def admin_actors(t: Tables) -> DataFrame:
    return logs.without_admins(t.read("events"), "3, 5,x,0", user="user_id").select("event_id", "user_id")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click')")
def datatype_switch(t: Tables) -> DataFrame:
    switches = t.spark.createDataFrame([("click", 0), ("view", 1), ("none", 0)], "datatype string, enabled int")
    return logs.switched_on(t.read("events"), switches, "event_type").select("event_id", "event_type")


@query(
    """
    SELECT page_id, split_part(plain, '?', 1) || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END || anchor AS url
    FROM (SELECT *, array_to_string(list_filter(string_split(CASE WHEN contains(plain, '?') THEN substr(plain, instr(plain, '?') + 1) ELSE '' END, '&'),
        lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ('utm_source', 'ref', 'token')), '&') AS kept
      FROM (SELECT page_id, regexp_extract(u, '(#.*)$', 1) AS anchor, split_part(u, '#', 1) AS plain
        FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN split_part(url, '#', 1) || '&token=abc&x=token' ELSE url END AS u FROM pages)))
    """
)
def url_scrub(t: Tables) -> DataFrame:
    more = F.concat(F.substring_index("url", "#", 1), F.lit("&token=abc&x=token"))
    return t.read("pages").select("page_id", text.scrubbed_url(F.when(F.col("page_id") % 3 == 0, more).otherwise(F.col("url")), ("utm_source", "ref", "token")).alias("url"))


@query("SELECT event_id, 'ip' || sha1('10.0.0.' || user_id) AS address_key, substr(sha256(event_type), 1, 12) AS fingerprint FROM events")
def address_keys(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", identity.address_key(F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))).alias("address_key"), identity.short_sha256(F.col("event_type"), 12).alias("fingerprint"))


@query("SELECT event_id, strftime(ts, '%Y/%m/%d') AS day, strftime(ts + INTERVAL 7 MICROSECOND, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS whole, epoch_us(ts) // 1000000 AS seconds FROM events")
def time_formats(t: Tables) -> DataFrame:
    us = timefmt.micros(F.col("ts"))
    whole = timefmt.rfc3339_whole(us)
    return t.read("events").select("event_id", timefmt.date_bucket(us).alias("day"), timefmt.rfc3339(us + 7).alias("at"), whole.alias("whole"), timefmt.iso_seconds(whole).alias("seconds"))


@query(
    """
    SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'site' WHEN 1 THEN 'user' WHEN 2 THEN 'course' WHEN 3 THEN 'module' ELSE 'other' END AS page,
      CASE WHEN c_custkey % 7 = 0 THEN 'problem' WHEN c_custkey % 3 = 0 THEN 'norun' WHEN c_custkey % 3 = 1 THEN 'healthy' ELSE 'problem' END AS run,
      CASE c_custkey % 5 WHEN 0 THEN 's3_credential_invalid' WHEN 1 THEN 's3_quota_exceeded' WHEN 2 THEN 's3_5xx' WHEN 3 THEN 's3_quota_exceeded' ELSE 's3_other_4xx' END AS answer
    FROM customer
    """
)
def classifications(t: Tables) -> DataFrame:
    n, k = F.col("c_nationkey") % 5, F.col("c_custkey")
    level = F.when(n == 0, 10).when(n == 1, 30).when(n == 2, 50).when(n == 3, 70).otherwise(80)
    state = F.when(k % 3 == 0, "unknown").when(k % 3 == 1, "ok").otherwise("s3_5xx")
    code = F.when(k % 5 == 0, 403).when(k % 5 == 1, 429).when(k % 5 == 2, 503).otherwise(400)
    return t.read("customer").select("c_custkey", classify.page_kind(level).alias("page"), classify.run_class(state, (k % 7 == 0).cast("int")).alias("run"), classify.store_answer(code, F.when(k % 5 == 3, "SlowDown please").otherwise("no")).alias("answer"))


@query(
    """
    SELECT p_partkey, array_to_string(list_filter(regexp_split_to_array(p_name || ', x ' || p_brand, '[\\s,]+'), lambda x: x <> ''), '|') AS names,
      coalesce(try_cast(regexp_extract(p_partkey || 'abc', '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0) AS loose, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS label
    FROM part
    """
)
def text_functions(t: Tables) -> DataFrame:
    names = F.array_join(text.column_names(F.concat_ws(", x ", "p_name", "p_brand")), "|")
    html = F.concat(F.lit("<b>"), "p_name", F.lit("</b>\n "))
    return t.read("part").select("p_partkey", names.alias("names"), text.loose_int(F.concat(F.col("p_partkey").cast("string"), F.lit("abc"))).alias("loose"), text.plain_label(html).alias("label"))


@query("SELECT doc_id, CASE WHEN strlen(text) > 300 THEN 1 ELSE 0 END AS cut, CASE WHEN strlen(text) <= 300 THEN text END AS whole FROM documents")
def byte_limits(t: Tables) -> DataFrame:
    short = text.cut_bytes(F.col("text"), 300)
    fits = (F.octet_length(short) <= 300) & F.startswith(F.col("text"), short) & (F.octet_length(short) >= F.least(F.octet_length("text"), F.lit(297)))
    return t.read("documents").select("doc_id", F.when(fits, (short != F.col("text")).cast("int")).alias("cut"), F.when(short == F.col("text"), short).alias("whole"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_acctbal > 0 AND c_acctbal <= 9000 ORDER BY c_acctbal, c_custkey LIMIT 50")
def unsynced_sessions(t: Tables) -> DataFrame:
    sessions = t.read("customer").select(F.col("c_custkey").alias("uid"), "c_name", F.col("c_acctbal").alias("timeend"), F.col("c_custkey").alias("id"))
    sessions = sessions.withColumn("uid", F.col("uid").cast("string"))
    markers = t.read("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").cast("string").alias("sessionuid"))
    return attendance.unsynced(sessions, markers, 9000).select(F.col("id").alias("c_custkey"), "c_name")


@query(
    """
    SELECT 's' || l_orderkey AS sessionuid, l_suppkey AS external_user_id, sum(l_partkey)::BIGINT AS duration, min(epoch_us(l_shipdate) // 1000000)::BIGINT AS first_join_time,
      max(epoch_us(l_shipdate) // 1000000)::BIGINT AS last_left_time, greatest(count(*) - 1, 0)::BIGINT AS rejoins
    FROM lineitem WHERE l_linenumber = (SELECT max(m.l_linenumber) FROM lineitem m WHERE m.l_orderkey = lineitem.l_orderkey AND m.l_suppkey = lineitem.l_suppkey) GROUP BY l_orderkey, l_suppkey, l_linenumber
    """
)
def attendance_fold(t: Tables) -> DataFrame:
    """Lines of an order as instances of a session: a person's last instance holds."""
    at = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    join = F.struct(at.alias("joined"), at.alias("left"), F.col("l_partkey").alias("duration"))
    rows = t.read("lineitem").groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.collect_list(join).alias("attendance"))
    person = F.struct(F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("userId"), F.col("l_suppkey").cast("string").alias("externalUserId"), F.lit(None).cast("string").alias("role"), F.lit("x").alias("displayName"), "attendance")
    instances = rows.groupBy("l_orderkey", "l_linenumber").agg(F.collect_list(person).cast(ATTENDEES).alias("attendees")).select(F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("sessionuid"), F.col("l_linenumber").alias("instance_no"), "attendees")
    return attendance.folded(instances).select("sessionuid", "external_user_id", "duration", "first_join_time", "last_left_time", "rejoins")


@query(
    """
    WITH want AS (SELECT c_custkey AS u FROM customer WHERE c_custkey % 5 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F'))),
      have AS (SELECT DISTINCT user_id AS u FROM events)
    SELECT u AS userid, 'assign' AS action FROM want WHERE u NOT IN (SELECT u FROM have) UNION ALL SELECT u, 'unassign' FROM have WHERE u NOT IN (SELECT u FROM want)
    """
)
def role_reconcile(t: Tables) -> DataFrame:
    users = t.read("customer").select(F.col("c_custkey").alias("id"))
    assignments = t.read("orders").select(F.col("o_custkey").alias("userid"), F.when(F.col("o_orderstatus") == "F", 3).otherwise(9).alias("roleid"))
    wanted = users.where("id % 5 = 0").select(F.col("id").alias("userid")).union(attendance.holders(assignments, [3, 4], users))
    return attendance.reconciled(wanted, t.read("events").select(F.col("user_id").alias("userid")))


@query("SELECT DISTINCT user_id AS userid FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def token_adoption(t: Tables) -> DataFrame:
    return attendance.adopted(t.read("events").select(F.col("user_id").alias("userid")), t.read("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("userid")))


@query("SELECT DISTINCT folder FROM (SELECT 'current' AS folder UNION ALL SELECT 'd' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 1)")
def tracked_folders(t: Tables) -> DataFrame:
    folder = F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("folder")
    current = t.spark.range(1).select(F.lit("current").alias("folder"))
    return shipping.tracked_folders(current, t.read("supplier").select(folder).union(current), t.read("supplier").where("s_suppkey % 2 = 0").select(folder))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey > 0 AND o_custkey % 3 > 0")
def completion_scope(t: Tables) -> DataFrame:
    rows = t.read("orders").select("o_orderkey", "o_custkey", F.col("o_custkey").alias("courseid"), (F.col("o_custkey") % 3).alias("relateduserid"))
    return logs.scoped_completions(rows).select("o_orderkey", "o_custkey")


@query("SELECT event_id, event_id % 3 = 0 AS valid FROM events")
def cron_fields(t: Tables) -> DataFrame:
    value = F.when(F.col("event_id") % 3 == 0, "*/5,0-10").when(F.col("event_id") % 3 == 1, "5 minutes").otherwise("")
    return t.read("events").select("event_id", logs.is_cron_field(value).alias("valid"))
