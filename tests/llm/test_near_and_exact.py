"""SimHash against all pairs, the covering code, and repeated windows against a dictionary."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import op4_simhash as op4

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    """{id: component} over (id, fingerprint) by all pairs."""
    parent = {i: i for i, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if i < j and (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in prints}


def test_perfect_codes_cover():
    for length, generator, radius in op4.BLOCKS:
        code = op4.Perfect(length, generator, radius)
        v = np.random.default_rng(1).integers(0, 1 << length, 5000, dtype=np.uint64)
        near = code.nearest(v)
        assert (np.bitwise_count(v ^ near) <= radius).all()
        assert (code.nearest(near) == near).all()


def test_links_meet_at_an_anchor():
    rng = random.Random(3)
    anchors = op4.Anchors()
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 2):
            b ^= 1 << bit
        who, where = anchors.of(np.array([a, b], np.uint64))
        assert set(where[who == 0].tolist()) & set(where[who == 1].tolist())


def test_every_two_bit_pair_meets():
    """All differences of up to two bits, at the anchors that the narrowed replication goes to; they lie within radius and threshold."""
    rng = random.Random(4)
    anchors = op4.Anchors()
    pairs = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i in range(64) for j in range(i))]
    for _ in range(6):
        a = rng.getrandbits(64)
        bits = np.array([a ^ p for p in pairs], np.uint64)
        who, where = anchors.of(bits)
        own = where[who == 0]
        assert len(np.unique(who[np.isin(where, own)])) == len(pairs)
        far = np.bitwise_count((where ^ bits[who]) & np.uint64((1 << 61) - 1))
        assert far.max() <= sum(r for _, _, r in op4.BLOCKS) + op4.THRESHOLD


def test_every_two_bit_pair_of_a_block_has_a_common_home():
    """For every word of the short block and every two of its bits."""
    code = op4.Perfect(*op4.BLOCKS[2])
    v = np.arange(1 << 15, dtype=np.uint64)
    points = np.concatenate(([0], 1 << np.arange(15))).astype(np.uint64)
    homes = np.sort(code.nearest(v[:, None] ^ points[None, :]), axis=1)
    for i in range(15):
        for j in range(i):
            other = homes[(v ^ np.uint64(1 << i | 1 << j)).astype(np.int64)]
            assert (homes[:, :, None] == other[:, None, :]).any((1, 2)).all()


@pytest.mark.parametrize("crowd", [3, 4096])
def test_forest_connects_as_all_pairs_do(crowd, monkeypatch):
    monkeypatch.setattr(op4, "CROWD", crowd)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    fp = sorted({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(12)})
    ids = list(range(len(fp)))
    got = op4.forest(np.array(fp, np.uint64), np.array(ids), 2)
    slow = slow_components(list(zip(ids, fp)))
    parent = {i: {i} for i in ids}
    for a, b in got:
        assert (fp[a] ^ fp[b]).bit_count() <= 2
        joined = parent[a] | parent[b]
        for x in joined:
            parent[x] = joined
    assert {i: min(parent[i]) for i in ids} == slow


def test_simhash_query_against_all_pairs(spark, sf_dir):
    rows = op4.op4_simhash(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == dict(prints)
    assert {r.doc_id: r.component_id for r in rows} == slow_components(prints)


def test_simhash_odd_rows(spark):
    text = "One two three four five six seven eight"
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \t\n", None, None, None), (5, text, "en", "s", 1), (4, text.upper(), "en", "s", 1), (5, text, "en", "s", 1), (None, "x y", "en", "s", 1), (6, "a " * 50_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("mine")).withColumn("component", F.lit(9))
    got = {(r.doc_id, r.component) for r in op4.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, None), (6, 6)}
    kept = op4.stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 4, 6] and kept[0].fp == "mine" and len(kept[0]) == 7
    empty = op4.near_duplicates(docs.where("false"))
    assert empty.columns == ["doc_id", "fp", "component"] and empty.count() == 0


def test_components_of_a_long_chain(spark):
    pairs = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.component) for r in op4.components(pairs).collect()} == {(i, 0) for i in range(1, 201)}


def slow_near(texts, similarity=0.8):
    """Indices that go, in order, by all pairs of sets of runs of five words."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for t in texts]
    kept, gone = [], set()
    for i, s in enumerate(sets):
        if s and any(len(s & sets[k]) >= similarity * len(s | sets[k]) for k in kept):
            gone.add(i)
        elif s:
            kept.append(i)
    return gone


def test_stage_removes_near_copies(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(30):
        base = [rng.choice(["sea", "tide", "moon", "salt", "rope", "gull", "mast", "oar"]) + str(rng.randint(0, 300)) for _ in range(200)]
        texts.append(" ".join(base))
        for changes in (1, 2, 3, 12):  # similarities of about 0.95, 0.90, 0.86 and 0.54
            other = list(base)
            for at in rng.sample(range(200), changes):
                other[at] = "new" + str(rng.randint(0, 10**6))
            texts.append(" ".join(other))
    texts += ["", "one two", "one two three four five"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in op4.stage(spark, docs, "").collect()}
    assert set(range(len(texts))) - kept == slow_near(texts) and len(kept) == 63


def test_large_clusters_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(op4, "HEADS", 4)
    monkeypatch.setattr(op4, "PART", 3)
    rng = random.Random(18)
    texts = []
    for _ in range(3):  # groups that share most of a text, so that their clusters hang together
        base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
        for _ in range(14):
            other = list(base)
            for at in rng.sample(range(120), rng.choice((1, 2, 4, 6))):
                other[at] = f"x{rng.randint(0, 10**6)}"
            texts.append(" ".join(other))
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in op4.stage(spark, docs, "").collect()}
    assert set(range(len(texts))) - kept == slow_near(texts) and len(kept) > 3


def test_stage_of_odd_rows(spark):
    long = "sea tide " * 60_000
    rows = [(1, long, "en", "s", 1), (2, long + "x", "en", "s", 1), (2, long + "x", "en", "s", 1), (None, None, None, None, None), (None, "", "en", "s", 0), (7, "a b", "en", "s", 1), (7, "a b", "en", "s", 1), (7, "c d", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"r1": F.lit(1), "id": F.lit("x")})
    kept = op4.stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in kept) == [(0, ""), (1, "sea"), (2, "sea"), (7, "a b"), (7, "c d")] and kept[0].id == "x"
    assert op4.stage(spark, docs.where("false"), "").count() == 0


def test_near_of_kept_as_all_pairs():
    rng = random.Random(9)
    for _ in range(50):
        base = [str(rng.randint(0, 9)) for _ in range(30)]
        texts = [" ".join(w if rng.random() > 0.03 else "x" for w in base[: rng.randint(0, 30)]) for _ in range(12)]
        assert set(op4.near_of_kept([op4.shingles(t.encode()) for t in texts])) == slow_near(texts)
