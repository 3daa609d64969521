"""Repeated windows against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op9_suffix_array as op9

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def covered(texts, length=op9.LENGTH):
    """For each text, which bytes a window covers that starts anywhere else too."""
    seen = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(hashlib.md5(t[i : i + length]).digest(), []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + length] = True
    return gone


def slow(texts, length=op9.LENGTH):
    """(bytes, removed, spans, digest of the rest) of each text."""
    out = []
    for t, g in zip(texts, covered(texts, length)):
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        out.append((len(t), int(g.sum()), int((np.diff(g.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randint(70, 300)) for _ in range(4)]
    texts = [text(rng.randint(1, 300)) for _ in range(12)]
    for p in passages:
        for _ in range(4):
            a = rng.randint(0, 60)
            texts.append(text(rng.randint(0, 50)) + p[a : len(p) - rng.randint(0, 60)] + text(rng.randint(0, 50)))
    base = texts[0] + text(400)
    for _ in range(5):
        cut = rng.randint(0, len(base))
        texts.append(base[:cut] + word() + base[cut:])
    texts += [texts[3], texts[3], base, base, "x" * 900, "ab " * 400, "", passages[0][:410] + passages[0][5:420], "y" * 399]
    return texts


def check(spark, texts, **more):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op9.without_repeats(docs, ["doc_id"], **more).select("own.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    want = slow([(t or "").encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    check(spark, corpus(seed))


def test_hot_anchors_take_the_other_way(spark):
    check(spark, corpus(3), hot=2)


def test_many_anchors_are_joined_to_their_texts(spark):
    check(spark, corpus(4), most_anchors=0)
    check(spark, corpus(4), most_anchors=0, hot=2)


@pytest.mark.parametrize("more", [{}, {"hot": 2}, {"most_anchors": 0}, {"most_anchors": 0, "hot": 2}])
def test_long_windows_are_looked_for_where_short_ones_are(spark, more):
    check(spark, corpus(5), by="both", **more)
    check(spark, ["a" * 500, "b" * 300, "b" * 300, "", None], by="both", **more)


def test_long_windows_of_texts_without_short_ones(spark):
    rng = random.Random(8)
    check(spark, ["".join(rng.choice("abcdefgh ") for _ in range(700)) for _ in range(3)], by="both")


def test_many_windows_by_ranges_of_the_anchor(spark, monkeypatch):
    texts = [t.encode() for t in corpus(6)]
    contexts = sorted({t[at : at + 450 + at % 90] for t in texts for at in range(0, len(t) - 560, 37)})
    group, left = np.zeros(len(contexts), np.int64), np.array([60 + i % 3 for i in range(len(contexts))])
    whole = op9.repeated_windows(group, left, contexts)
    monkeypatch.setattr(op9, "BATCH_WINDOWS", 500)
    assert all((a == b).all() for a, b in zip(whole, op9.repeated_windows(group, left, contexts), strict=True)) and any(a.any() for a in whole)


def test_long_texts_go_by_segments(spark, monkeypatch):
    import random

    rng = random.Random(12)
    monkeypatch.setattr(op9, "SEGMENT", 3000)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    long = "".join(rng.choice("ijklmnop ") for _ in range(20_000))
    texts = [(long[:9000] + passage + long[9000:]).encode(), passage.encode(), (long[3000:4000] + passage[100:700]).encode()]
    gone = []
    for t in texts:  # the scans as tasks call them
        h, place, first, last = op9.runs(t)
        assert sorted(x for a, b in zip(first, last) for x in range(a, b + 1)) == list(range(len(t) - op9.LENGTH + 1))
        gone.append(dict(zip(place.tolist(), h.tolist())))
    shared = set(gone[0].values()) & set(gone[1].values())
    assert shared and set(gone[2].values()) & set(gone[0].values())


def test_runs_of_many_texts_as_of_each():
    texts = [t.encode() for t in corpus(11)]
    own, *rest = op9.batched_runs(texts)
    for i, t in enumerate(texts):
        assert all((x[own == i] == y).all() and (own == i).sum() == len(y) for x, y in zip(rest, op9.runs(t), strict=True))


def slow_passages(texts):
    """Number of passages of each text, and its bytes without them."""
    out = []
    for t, gone in zip(texts, covered(texts, op9.PASSAGE)):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        spans = [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if len(t[a:b].split()) > op9.PASSAGE_WORDS]
        keep = np.ones(len(t), bool)
        for a, b in spans:
            while 0 < a < len(t) and t[a] & 0xC0 == 0x80:
                a -= 1
            while 0 < b < len(t) and t[b] & 0xC0 == 0x80:
                b += 1
            keep[a:b] = False
        out.append((len(spans), bytes(np.frombuffer(t, np.uint8)[keep]).decode()))
    return out


def test_stage_cuts_passages_of_over_fifty_words(spark):
    rng = random.Random(21)
    word = lambda n=5: "".join(rng.choice("abcdefghijklmé") for _ in range(n))
    text = lambda k: " ".join(word() for _ in range(k))
    short, passage = text(45), text(55)
    texts = [text(40) + " " + passage + " " + text(30), passage + " " + text(9), text(20) + " " + short, short + " " + text(33), text(60), "", " ".join(word(20) for _ in range(40))]
    texts += [texts[-1] + " x"]  # many bytes, few words
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    want = slow_passages([t.encode() for t in texts])
    assert [n for n, _ in want] == [1, 1, 0, 0, 0, 0, 0, 0]
    got = {r.doc_id: r for r in op9.stage(spark, docs, "").collect()}
    assert [got[i].text for i in range(len(texts))] == [t for _, t in want]
    assert all(got[i].n_chars == len(got[i].text) for i in got)
    counted = {r.doc_id: r.n_passages for r in op9.without_repeats(docs, ["doc_id"], by="both").select("own.doc_id", "n_passages").collect()}
    assert [counted[i] for i in range(len(texts))] == [n for n, _ in want]


def test_segments(monkeypatch):
    monkeypatch.setattr(op9, "SEGMENT", 1000)
    text = " ".join(corpus(5)[:6]).encode()
    h, place, first, last = op9.runs(text)
    assert sorted(x for a, b in zip(first, last) for x in range(a, b + 1)) == list(range(len(text) - op9.LENGTH + 1))
    monkeypatch.setattr(op9, "SEGMENT", 1 << 22)
    whole = op9.runs(text)
    assert dict(zip(place.tolist(), h.tolist())) == dict(zip(whole[1].tolist(), whole[0].tolist()))


def test_small_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, corpus(7))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op9.op9_suffix_array(spark, sf_dir).collect()}
    assert [got[r.doc_id] for r in docs] == slow([(r.text or "").encode() for r in docs])


def test_odd_rows_and_stage(spark):
    long = "é é " * 100
    rows = [(1, None, "en", "s", 7), (2, "", None, None, None), (3, "a" + long, "en", "s", 401), (None, "bc" + long, "en", "s", 402), (3, "a" + long, "en", "s", 401)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("k", F.lit(1)).withColumn("own", F.lit("x")).withColumn("spans", F.lit(2))
    out = op9.stage(spark, docs, "").collect()
    assert out[0].asDict().keys() == set(docs.columns)
    assert sorted((r.doc_id or 0, r.text or "", r.n_chars or 0, r.text is None) for r in out) == [(0, "bc", 2, False), (1, "", 7, True), (2, "", 0, False), (3, "", 0, False), (3, "", 0, False)]
    assert op9.stage(spark, docs.where("false"), "").count() == 0


def test_query_against_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages FROM ({op9.ORACLE_SQL})").fetchall())
    assert sorted(map(tuple, op9.op9_suffix_array(spark, sf_dir).collect())) == want
