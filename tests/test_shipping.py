"""File names, batches, object keys, ownership: the cases that fail silently."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import timefmt
from tidemark.operators import records, shipping

LATE, MIDNIGHT, NOON = 1785801599000000, 1785801600000000, 1785844800000000


def parsed(spark, name):
    row = spark.createDataFrame([(name,)], "n string").select(timefmt.parsed_file_name(F.col("n")).alias("p")).first()
    return row.p and tuple(row.p)


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("events-1234-1785801600000000-6ba907de-h9f8e7d6.jsonl", (1234, MIDNIGHT, "6ba907de", "9f8e7d6")),
        ("/any/dir/events-1-2-abc-hff.jsonl", (1, 2, "abc", "ff")),
        ("events-42-1785801600000000-6ba907de.jsonl", (42, MIDNIGHT, "6ba907de", None)),
        ("events-42-1785801600000000.jsonl", (42, MIDNIGHT, None, None)),
        ("events-1234-1785801600000000-303402d3.jsonl", (1234, MIDNIGHT, "303402d3", None)),
        ("events-7-1785801600000000-abc-hdef.jsonl.closed", (7, MIDNIGHT, "abc", "def")),
        ("events-7-1785801600000000-abc-hdef.jsonl.pulled", (7, MIDNIGHT, "abc", "def")),
        ("events-1-2.json", None),
        ("logs-1-2.jsonl", None),
        ("events-x-2.jsonl", None),
        ("events-1.jsonl", None),
        ("events-1-2.jsonl.tmp", None),
        ("xevents-1-2.jsonl", None),
        ("events-1-2.jsonl.closed.bak", None),
        ("", None),
    ],
)
def test_file_names(spark, name, want):
    assert parsed(spark, name) == want


def plan(spark, files, most):
    rows = [(i, f"events-1-{us}-t{i}.jsonl.closed", us, size) for i, (us, size) in enumerate(files)]
    df = spark.createDataFrame(rows, "ord long, path string, us long, size long").withColumn("datebucket", timefmt.date_bucket(F.col("us")))
    got = shipping.planned(df, most).orderBy("datebucket", "batch_no").collect()
    return [(r.datebucket, [int(p.split("-t")[1].split(".")[0]) for p in r.paths]) for r in got]


def test_batches(spark):
    assert plan(spark, [(NOON, 100), (NOON, 200)], 1000) == [("2026/08/04", [0, 1])]
    assert plan(spark, [(LATE, 10), (MIDNIGHT, 10), (LATE, 10)], 1000) == [("2026/08/03", [0, 2]), ("2026/08/04", [1])]
    assert plan(spark, [(NOON, 60)] * 3, 100) == [("2026/08/04", [0]), ("2026/08/04", [1]), ("2026/08/04", [2])]
    assert plan(spark, [(NOON, 5000), (NOON, 10)], 100) == [("2026/08/04", [0]), ("2026/08/04", [1])]
    for cap in (0, -5):
        assert plan(spark, [(NOON, 10)], cap) == [("2026/08/04", [0])]
    assert plan(spark, [(NOON, 0), (NOON, 0), (NOON, 7)], 5) == [("2026/08/04", [0, 1]), ("2026/08/04", [2])]
    assert plan(spark, [], 100) == []


def key(spark, names):
    row = spark.createDataFrame([(names, [int(n.split("-")[2]) for n in names])], "n array<string>, us array<long>")
    return row.select(shipping.object_key("events", "site-abc-123", F.lit("2026/08/04"), F.col("n"), F.col("us")).alias("k")).first().k


def test_object_keys(spark):
    a, b = f"/d/events-1-{MIDNIGHT}-a.jsonl.closed", f"/d/events-2-{NOON}-b.jsonl.closed"
    made = key(spark, [a, b])
    assert made == key(spark, [b, a])
    assert made.startswith(f"events/site-abc-123/2026/08/04/batch-{MIDNIGHT}-2-") and made.endswith(".jsonl.gz")
    assert made != key(spark, [a, b.replace("-b.", "-c.")])


@pytest.mark.parametrize(
    ("lines", "kept"),
    [
        (['{"id":1,"site_id":"me"}', '{"id":2,"site_id":"x"}', '{"id":3,"site_id":"me"}'], [0, 2]),
        (["not json at all", '{"id":1}', '{"site_id":"me"}'], [0, 1, 2]),
        (['{"site_id":"x"}', '{"site_id":"y"}'], []),
        (['{"site_id":null}', "[1]", '"text"', "", "{"], [1, 2, 3, 4]),
    ],
)
def test_ownership(spark, lines, kept):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    stay, gone = records.owned(df, "me")
    assert sorted(r.i for r in stay.collect()) == kept
    assert gone.count() == len(lines) - len(kept)


def test_ownership_of_numbers(spark):
    df = spark.createDataFrame([('{"site_id":123}',), ('{"site_id":123.0}',)], "line string")
    assert records.owned(df, "123")[0].count() == 2
    assert records.owned(df, "1234")[0].count() == 0


def test_eviction(spark):
    files = [(f"f{i}", 10, i, i != 0) for i in range(10)]
    df = spark.createDataFrame(files, "path string, size long, modified long, closed boolean")
    assert sorted(r.path for r in shipping.evicted(df, 75).collect()) == ["f1", "f2", "f3"]
    assert shipping.evicted(df, 100).count() == 0
    assert shipping.evicted(df, 0).count() == 9  # the open file stays
