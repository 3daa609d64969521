"""Every query of the catalog against its SQL at the smallest size, and invariants of operators."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import attendance, census, dwell, numbering, privacy, pull, quota, records
from tidemark.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(str([canonical(r[c]) for c in columns]) for r in df.collect())
    made = duck.execute(ORACLES[name])
    names = [d[0] for d in made.description]
    assert sorted(names) == columns
    want = sorted(str([canonical(r[names.index(c)]) for c in columns]) for r in made.fetchall())
    assert got == want


def test_plans_prune_and_push(spark, sf_dir):
    """Columns and filters reach the files, and nothing runs in Python."""
    plan = QUERIES["cdc_window"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan and "o_totalprice" not in plan
    for name, make in QUERIES.items():
        text = make(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "InArrow" not in text and "Cartesian" not in text, name


@pytest.mark.parametrize(("n", "size"), [(0, 5), (4, 5), (5, 5), (6, 5), (10, 5)])
def test_census_pages(spark, n, size):
    df = spark.range(n).select((F.col("id") * 3).alias("id"))
    m = census.manifest(df, size).first()
    pages = census.pages(df, "id", size, 7).collect()
    assert m.is_single == (n < size) and m.count_ if hasattr(m, "count_") else m["count"] == n
    assert sorted(int(x) for p in pages for x in p.pks) == [3 * i for i in range(n)]
    assert all(len(p.pks) <= size for p in pages)
    if not m.is_single:
        assert m.page_count == len(pages)
    assert census.deleted(df, "id", census.pages(df.where("id > 3"), "id", size, 7)).count() == min(n, 2)
    assert census.deleted(df, "id", census.pages(df.where("id > 3"), "id", size, 7), complete=False).count() == 0


def test_drain_conserves_lines(spark):
    rng = random.Random(2)
    rows = []
    for f in range(6):
        for i in range(rng.randint(0, 12)):
            kind = rng.choice(["event", "exception", "syslog"])
            rows.append((f // 2, f"p{f}", i, rng.choice(["{bad", f'{{"id":"{f}-{i}","record_type":"{kind}","captured_at":"2024-01-0{rng.randint(1, 9)}T00:00:00.5Z"}}'])))
    df = spark.createDataFrame(rows, "modified long, path string, line_no int, line string")
    for limit in (1, 3, 500):
        given, left, bad = (x.collect() for x in pull.drained(df, ["event"], "2024-01-04T00:00:00Z", limit))
        assert len(given) + len(left) + len(bad) == len(rows)
        assert len(given) <= limit and all(r.record_type == "event" for r in given)
        last = max(((r.modified, r.path, r.line_no) for r in given), default=None)
        full = len(given) == limit
        assert all(not full or (r.modified, r.path, r.line_no) <= last for r in bad)


def test_string_bounds_differ_from_times(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.500000Z",), ("2024-01-01T00:00:00Z",), ("",)], "c string")
    bound = "2024-01-01T00:00:00Z"
    assert [r.x for r in df.select(pull.not_before(F.col("c"), bound, as_time=False).alias("x")).collect()] == [False, True, True]
    assert [r.x for r in df.select(pull.not_before(F.col("c"), bound).alias("x")).collect()] == [True, True, True]


def test_two_levels_as_a_fold(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("abcdefgh"), rng.randint(0, 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, w int")
    got = sorted(r.i for r in quota.two_levels(df, "k", F.col("w"), ["i"], 4, 5).collect())
    used, want = {}, []
    for i, k, w in rows:
        if used.get((w, k), 0) < 4 and used.get(w, 0) < 20:
            want.append(i)
            used[(w, k)] = used.get((w, k), 0) + 1
            used[w] = used.get(w, 0) + 1
    assert got == want
    assert quota.two_levels(df, "k", F.col("w"), ["i"], 0).count() == 300


def test_running_sums(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, v int").repartition(5)
    got = {r.i: r.upto for r in numbering.running(df, F.floor(F.col("i") / 16), [F.col("i")], F.col("v")).collect()}
    total = 0
    for i, v in rows:
        total += v
        assert got[i] == total


def test_erasure_keeps_what_it_cannot_read(spark):
    lines = ["{broken", '{"record_type":"event","event_data":{"userid":"7","relateduserid":8}}', '{"record_type":"event","event_data":null}', '{"record_type":"exception","userid":7}', '{"record_type":"other","userid":7}']
    df = spark.createDataFrame([("p", x) for x in lines] + [("live", lines[1])], "path string, line string")
    left, counts = privacy.erased(df, spark.createDataFrame([(7,), (7,)], "userid long"), rewritable=F.col("path") != "live")
    assert sorted(r.line for r in left.where("path = 'p'").collect()) == sorted([lines[0], lines[2], lines[4]])
    assert {(r.path, r.removed, r.kept, r.skipped) for r in counts.collect()} == {("p", 2, 3, 0), ("live", 0, 1, 1)}
    assert privacy.known(df, 8) and not privacy.known(df, 9)


def test_attendance(spark):
    from tidemark.schemas import ATTENDEES

    def person(user, ext, joins, **more):
        return {"userId": user, "externalUserId": ext, "attendance": joins, **more}

    join = lambda a, b, d: {"joined": a, "left": b, "duration": d}
    t = lambda m: f"2024-01-01T00:{m:02d}:00Z"
    first = [person("u", "5", [join(t(5), t(9), 10), join(t(1), t(2), None), join("bad", None, 4)]), person("v", "6", None), person(None, "7", []), person("w", None, [])]
    second = [person("u", "5", [join(t(20), t(30), 600)])]
    df = spark.createDataFrame([("s", 1, first), ("s", 2, second)], f"sessionuid string, instance_no int, attendees {ATTENDEES}")
    zero = 1704067200
    got = {r.external_user_id: (r.duration, r.first_join_time, r.last_left_time, r.rejoins) for r in attendance.folded(df).collect()}
    assert got == {5: (600, zero + 1200, zero + 1800, 0), 6: (0, 0, 0, 0)}
    got = {r.external_user_id: (r.duration, r.first_join_time, r.last_left_time, r.rejoins) for r in attendance.folded(df, summed=True).collect()}
    assert got == {5: (614, zero + 60, zero + 1800, 3), 6: (0, 0, 0, 0)}


def test_null_and_absent_differ(spark):
    df = spark.createDataFrame([(1, None)], "id long, x string")
    assert records.snapshot_envelope(df, "e", "s", "b", "t").first().entity_data == '{"id":1,"x":null}'
    assert records.snapshot_envelope(df, "e", "", "b", "t").count() == 0


def test_ids_are_version_five(spark):
    import uuid

    from tidemark.functions.identity import NAMESPACE, entity_id

    rows = [(i, uuid.uuid5(uuid.UUID(NAMESPACE), f"site é|e|{i}")) for i in range(50)]
    df = spark.createDataFrame([(i,) for i, _ in rows], "id long")
    assert [r.u for r in df.orderBy("id").select(entity_id("site é", "e", F.col("id")).alias("u")).collect()] == [str(u) for _, u in rows]


def test_media_off_drops_beacons(spark):
    df = spark.createDataFrame([("media_segment", "x", -5, None, "é" * 1500, "m", "film", -1, 0), (None, "course", 10**9, "2024-01-01T00:00:00Z", None, None, None, None, None)], "record_type string, page string, timespent_ms long, started_at string, url string, media_id string, media_kind string, media_pos_sec int, bucket_sec int")
    assert dwell.validated(df, "now").count() == 1
    m, p = dwell.validated(df, "now", media=True).orderBy("record_type").collect()
    assert (m.page, m.timespent_ms, m.started_at, len(m.url), m.media_kind, m.media_pos_sec, m.bucket_sec) == ("other", 0, "now", 1024, "video", 0, 1)
    assert (p.record_type, p.timespent_ms, p.url, p.media_kind) == ("page_dwell", 14_400_000, "", None)


def test_nobody_is_not_limited(spark):
    df = spark.createDataFrame([(k, i) for k in (0, -1, None, 5) for i in range(4)], "k long, i long")
    got = sorted(((r.k is None), r.k or 0, r.i) for r in quota.per_key(df, "k", F.lit(1), ["i"], 2).collect())
    assert [x[:2] for x in got] == [(False, -1)] * 4 + [(False, 0)] * 4 + [(False, 5)] * 2 + [(True, 0)] * 4


def test_erasure_by_list_and_by_join(spark, monkeypatch):
    lines = [(f"/b/events-{i % 3}.jsonl", json.dumps({"record_type": "event", "event_data": {"userid": i % 7, "relateduserid": (i * 5) % 11}})) for i in range(60)] + [("/b/x.jsonl", "not json"), ("/b/x.jsonl", "not json")]
    df = spark.createDataFrame(lines, "path string, line string")
    targets = spark.createDataFrame([(3,), (9,), (3,), (None,)], "userid long")
    got = {}
    for most in (1000, 1):
        monkeypatch.setattr(privacy, "MOST_LISTED", most)
        stay, counts = privacy.erased(df, targets)
        got[most] = (sorted(map(tuple, stay.collect())), sorted(map(tuple, counts.collect())))
    assert got[1000] == got[1] and 0 < len(got[1][0]) < len(lines)
    assert "Exchange" not in privacy.erased(df, targets.limit(0))[0]._jdf.queryExecution().executedPlan().toString()
