"""Expressions at their edges."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import classify, identity, text, timefmt
from tidemark.operators import logs, settings
from tidemark.sources import calls, files
from tidemark.streaming import cadence


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("most", range(1, 9))
def test_bytes_are_cut_between_characters(spark, most):
    for t in ("abcdefghij", "ééééé", "日本語日本語", "😀😀😀", "a😀é日", "", None):
        want = None if t is None else t.encode()[:most].decode("utf-8", "ignore")
        assert one(spark, t, lambda c: text.cut_bytes(c, most)) == want


@pytest.mark.parametrize(("raw", "want"), [("12abc", 12), (" -7x", -7), ("+3", 3), ("abc", 0), ("", 0), (None, 0), ("99999999999999999999", 0)])
def test_loose_int(spark, raw, want):
    assert one(spark, raw, text.loose_int) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://a/b?token=1&c=2#d", "http://a/b?c=2#d"),
        ("http://a/b?token=1", "http://a/b"),
        ("http://a/b", "http://a/b"),
        ("/x?a=token&b=&c", "/x?a=token&b=&c"),
        (None, ""),
    ],
)
def test_urls(spark, url, want):
    assert one(spark, url, text.scrubbed_url) == want


def test_times(spark):
    assert one(spark, 1785801600000007, timefmt.rfc3339, "long") == "2026-08-04T00:00:00.000007Z"
    assert one(spark, -1, timefmt.rfc3339, "long") == "1969-12-31T23:59:59.999999Z"
    assert one(spark, 1785801599999999, timefmt.date_bucket, "long") == "2026/08/03"
    assert one(spark, "2026-08-04T00:00:00.25Z", timefmt.iso_seconds) == 1785801600
    assert one(spark, "soon", timefmt.iso_seconds) == 0 and one(spark, None, timefmt.iso_seconds) == 0
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, 1785801600000007, timefmt.rfc3339, "long") == "2026-08-04T00:00:00.000007Z"
        assert one(spark, "2026-08-04T00:00:00Z", timefmt.iso_seconds) == 1785801600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_details(spark):
    templates = {"shipped": "{files} files as {objects} objects"}
    f = lambda c: text.rendered_detail(c, templates)
    assert one(spark, '{"key":"shipped","params":{"files":3}}', f) == "3 files as ? objects"
    assert one(spark, '{"key":"newer","params":{}}', f) == '{"key":"newer","params":{}}'
    assert one(spark, " plain ", f) == "plain"


def test_names(spark):
    assert one(spark, ["a", "b", "c", "d", "e"], text.name_sample, "array<string>") == "a, b, c (+2 more)"
    assert one(spark, ["a"], text.name_sample, "array<string>") == "a"
    assert one(spark, "a, b\n c,,", text.column_names) == ["a", "b", "c"]
    assert one(spark, "<b>A</b>  c\n", text.plain_label) == "A c"


def test_patterns_are_literal(spark):
    names = [r"\core\event\role_x", r"\core\event\roleyx", r"\core\event\course_category_", r"\core\event\user_created", r"\core\event\user_created2", "core"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.where(logs.is_admin_action(F.col("n"))).collect()] == [names[0], names[2], names[3]]


def test_classes(spark):
    assert [one(spark, v, classify.page_kind, "int") for v in (10, 30, 40, 50, 70, 80, None)] == ["site", "user", "site", "course", "module", "other", "other"]
    for state, dropped, want in (("ok", 1, "problem"), ("", 0, "norun"), (None, 0, "norun"), ("ok", 0, "healthy"), ("s3_5xx", 0, "problem")):
        assert one(spark, state, lambda c, d=dropped: classify.run_class(c, F.lit(d))) == want


def test_settings_are_checked():
    assert settings.cleaned_setting("checkbox", "yes") == "1" and settings.cleaned_setting("int", "7") == "7"
    for kind, value, more in (("select", "x", {"choices": ["a"]}), ("int", "7.0", {}), ("text", "x", {"secret": True})):
        with pytest.raises(ValueError):
            settings.cleaned_setting(kind, value, **more)


def test_catalog_record_has_a_limit(spark):
    catalog = settings.schema_catalog(spark, {"t": spark.createDataFrame([(1, "x")], "id long, name string")}, {"t": ["ID"]})
    assert '"id"' in settings.catalog_record(catalog).first().catalog and "name string" not in settings.catalog_record(catalog).first().catalog
    assert settings.catalog_record(catalog, most=5).count() == 0


def test_drift(spark):
    df = spark.createDataFrame([("e", ["id", "Old", "later"], ["ID"], ["later"]), ("f", ["id"], ["id"], None)], "entity string, declared array<string>, live array<string>, optional array<string>")
    found = settings.drift(df)
    assert {(r.entity, r.missing) for r in found.collect()} == {("e", "old"), ("f", "")}
    assert settings.drift_totals(found).first() == (1, 1)


def test_beacons(spark):
    rows = ['{"userid":1,"timespent_ms":"x","page":"course"}', "nonsense", '{"url":"' + "x" * 9000 + '"}', "[]"]
    out = calls.beacons(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert len(out) == 1 and out[0].userid == 1 and out[0].timespent_ms is None


def test_tokens(spark):
    import base64

    got = spark.range(1).select(calls.claims(F.lit('{"a":"??>"}'), F.lit("é")).alias("t")).first().t
    want = ".".join(base64.urlsafe_b64encode(x.encode()).decode().rstrip("=") for x in ('{"a":"??>"}', "é"))
    assert got == want and identity.hmac_sha256(b"k", b"m") == __import__("hmac").new(b"k", b"m", "sha256").hexdigest()


def test_cadence():
    by = {j.name: j for j in cadence.JOBS}
    assert cadence.due(by["ship"], 60, 0) and not cadence.due(by["ship"], 59, 0) and not cadence.due(by["backfill"], 9**9, None)
    day = 86_400 * 10
    assert cadence.due(by["full_snapshot"], day + 3 * 3600, day) and not cadence.due(by["full_snapshot"], day + 3 * 3600 - 1, day - 1)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(f"l{i}",) for i in range(7)], "line string").coalesce(1)
    files.rotated(df, f"file://{tmp_path}/r", 3)
    assert len(list((tmp_path / "r").glob("part-*"))) == 3
    files.write_batch(df, f"file://{tmp_path}/b.jsonl.gz")
    files.write_batch(df, f"file://{tmp_path}/b.jsonl.gz")
    assert spark.read.text(f"file://{tmp_path}/b.jsonl.gz").count() == 7
    files.append(df, f"file://{tmp_path}/log")
    files.append(df, f"file://{tmp_path}/log")
    assert spark.read.parquet(f"file://{tmp_path}/log").count() == 14
    (tmp_path / "events-1-2.jsonl").write_text("x")
    (tmp_path / "mine.jsonl").write_text("x")
    assert files.purge(str(tmp_path)) == 1 and (tmp_path / "mine.jsonl").exists()
