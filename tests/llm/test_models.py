"""Classifiers by their accuracy on texts they haven't seen, and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, ngrams, sampling
from tidemark.llm import op6_quality_classifier as op6
from tidemark.llm import op8_language_id as op8
from tidemark.llm import op10_toxicity as op10

BIG = "/root/testdata/sf0.1"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def area(scores, truth):
    pos, neg = [s for s, t in zip(scores, truth) if t], [s for s, t in zip(scores, truth) if not t]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def held_out(spark, query, label, modulus, rest):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = query(spark, BIG).collect()
    assert all(r.held_out == (fold(r.doc_id, modulus) == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_on_held_out(spark):
    rows = held_out(spark, op6.op6_quality_classifier, "quality", 4, 2)
    assert area([r.score for r, _ in rows], [y for _, y in rows]) > 0.98
    assert np.mean([r.predicted == y for r, y in rows]) > 0.95


def test_toxicity_on_held_out(spark):
    rows = held_out(spark, op10.op10_toxicity, "toxic", 3, 1)
    assert area([r.score for r, _ in rows], [y for _, y in rows]) > 0.9  # some hundred toxic documents in four languages to learn from
    flagged = [y for r, y in rows if r.predicted]
    assert np.mean(flagged) > 0.9 and sum(flagged) > 0.9 * sum(y for _, y in rows)


def test_language_on_held_out(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op8.op8_language_id(spark, BIG).collect() if fold(r.doc_id, 4) == 2]
    assert all(r.held_out for r in rows) and np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.97


def test_unseen_spellings_share_vectors():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioutnsr") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(40)]
        if i % 2:
            words[rng.randrange(40)] = "grobble" + rng.choice(["x", "q", "zz", "kk", "yw"])
        rows.append((" ".join(words).encode(), i % 2))
    model = op10.train(rows)
    clean = [" ".join(word() for _ in range(60)).encode() for _ in range(100)]
    toxic = [c + b" grobblev " + c for c in clean]
    assert (op10.logits_of(toxic, model) > np.log(7 / 3)).mean() > 0.75
    assert (op10.logits_of(clean, model) > np.log(7 / 3)).mean() < 0.1


def test_scores_do_not_depend_on_neighbours():
    rng = random.Random(2)
    texts = [None, b"", b"...", "é ü".encode(), b"one"] + [" ".join(rng.choice(["alpha", "beta", "Gamma!!", "%%", "ñu"]) for _ in range(rng.randint(1, 50))).encode() for _ in range(40)]
    quality = op6.train([(t, i % 2) for i, t in enumerate(texts[4:])])
    toxic = {"table": rng_table(op10.BITS), "bias": -0.5}
    lang = op8.train([(t, "xy"[i % 2]) for i, t in enumerate(texts[3:])])
    for alone, together in (
        (lambda t: op6.logits_of([t], quality), op6.logits_of(texts, quality)),
        (lambda t: op10.logits_of([t], toxic), op10.logits_of(texts, toxic)),
    ):
        assert np.allclose([alone(t)[0] for t in texts], together, rtol=0, atol=1e-5)
    both = op8.predict(texts, lang)
    single = [op8.predict([t], lang) for t in texts]
    assert both["lang_pred"] == [s["lang_pred"][0] for s in single] and both["lang_pred"][:3] == ["und"] * 3
    assert np.allclose(both["score"], [s["score"][0] for s in single])


def rng_table(bits):
    return np.random.default_rng(3).normal(size=1 << bits).astype(np.float32)


def test_language_likelihood_is_a_sum_of_n_grams():
    model = op8.train([(b"abc abd", "x"), (b"xyz xyw xxx", "y")])
    text = "ab xyé".encode()
    data = np.array([ord(c) for c in " ab xyé "], np.uint32)  # n-grams of characters, not of bytes
    want = model["prior"].copy()
    counts = {}
    for n in op8.SIZES:
        grams = [b for _, b in ngrams.gram_buckets(data, (n,), op8.BITS)][0]
        for i in range(len(data) - 1 if n == 1 else len(data) - n + 1):
            counts[(n, int(grams[i]))] = counts.get((n, int(grams[i])), 0) + 1
    for (_, b), c in counts.items():
        want += c * model["logs"][:, b]
    assert np.allclose(op8.likelihoods([text], model)[:, 0], want, atol=1e-4)


def test_ftrl_learns_a_simple_rule():
    rows = [((b"good " if y else b"bad ") * 3 + b"word%d" % i, y) for i, y in enumerate([0, 1] * 200)]
    model = op6.train(rows)
    z = op6.logits_of([b"good good good other", b"bad bad bad other", None, b""], model)
    assert z[0] > 1 > -1 > z[1] and z[2] == z[3] == model["bias"]


def test_sample_is_bounded_and_held_out_rows_are_not_read(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic")).union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    read = lambda *a: [(bytes(r.text), r.y) for r in sampling.labelled_sample(*a).collect()]
    got = read(docs, labels, "toxic", 3, 1, 20, 10**6)
    assert len(got) == 40 and sum(y for _, y in got) == 20
    ids = [int(t.split()[1]) for t, _ in got]
    assert all(fold(i, 3) != 1 for i in ids) and all((i % 3 == 0) == bool(y) for i, (_, y) in zip(ids, got))
    assert sorted(got) == sorted(read(docs.repartition(7), labels.repartition(5), "toxic", 3, 1, 20, 10**6))
    assert 0 < len(read(docs, labels, "toxic", 3, 1, 20, 80)) < 40


def test_one_long_text_does_not_end_the_sample(spark):
    assert sampling.fitting([(0, 900), (1, 10), (0, 20), (1, 30)], 100) == [None, 10, 20, 30]
    assert sampling.fitting([(0, 60), (0, 60), (1, 10)], 100) == [60, None, 10]  # what class 1 leaves goes to class 0
    assert sampling.fitting([(0, 500), (0, 400), (1, 10)], 100) == [None, 90, 10]
    assert sampling.fitting([], 100) == []
    first = spark.range(60).where(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) != 1).orderBy(F.xxhash64("id")).first().id
    text = F.when(F.col("id") == first, F.repeat(F.lit("long "), 1000)).otherwise(F.lit("short"))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    got = sampling.labelled_sample(docs, labels, "toxic", 3, 1, 50, 1000).collect()
    assert len(got) == sum(fold(i, 3) != 1 for i in range(60)) - 1 and {r.y for r in got} == {0, 1}
    assert {bytes(r.text) for r in got} == {b"short"}


def test_models_on_odd_tables(spark, tmp_path):
    rows = [(1, None, None, "s", 0), (2, "", "en", "s", 0), (3, "123 ...", "en", "s", 7), (3, "123 ...", "en", "s", 7), (None, "word " * 30_000, "fr", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("mine")).withColumn("own", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, labels in (("none", []), ("one", [(1, 1, 1), (9, None, 1)])):
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        assert op6.op6_quality_classifier(spark, str(tmp_path)).count() == 5
        assert op10.op10_toxicity(spark, str(tmp_path)).count() == 5
        kept = op10.stage(spark, docs, str(tmp_path)).collect()
        assert len(kept) == 5 and kept[0].score == "mine" and len(kept[0]) == 7
    got = {(r.doc_id, r.lang_pred) for r in op8.op8_language_id(spark, str(tmp_path)).collect()}
    assert (1, "und") in got and (2, "und") in got and (3, "und") in got
    empty = docs.where("false")
    assert op8.identified(empty, sampling.trained(op8.sample_texts(empty), op8.train), ["doc_id"]).count() == 0


def test_pipeline(spark, sf_dir, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "encoding"]
    docs = common.table(spark, sf_dir, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(left) == len(set(left)) and set(left) <= ids and len(left) > len(ids) // 2
        ids = set(left)
        if i < 4:
            assert docs.columns == columns
    end = {r.doc_id: r.ids_sha256 for r in docs.collect()}
    assert end == {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_and_odd_tables(spark, sf_dir, stage):
    import corpus_pipeline

    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("fp", F.lit(1)).withColumn("name", F.lit("n"))
    f = corpus_pipeline.STAGES[stage][1]
    out = f(spark, docs, sf_dir)
    assert out.count() >= 2 and (stage == 4 or out.columns == docs.columns)
    assert f(spark, docs.where("false"), sf_dir).count() == 0


def test_rare_languages_are_learnt(spark):
    rows = [(i, f"the sea and the tide {i}", "en") for i in range(3000)] + [(10_000 + i, f"ðær þæt wæs ꝥ {i}", "ang") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = op8.sample_texts(docs, rows=100)
    count = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    open_rare = sum(fold(10_000 + i, 4) != 2 for i in range(12))
    assert count == {"en": 100, "ang": open_rare}
    model = sampling.trained(sample, op8.train)
    assert {r.lang_pred for r in op8.identified(docs.where("lang = 'ang'"), model, ["doc_id"]).collect()} == {"ang"}


def test_classifiers_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    for op in (op6, op10):
        model = op.fitted(docs, labels)
        assert op.scored(docs, model, ["doc_id"]).count() == 0
        one = spark.createDataFrame([(5, None)], "doc_id long, text string")
        assert 0 <= op.scored(one, model, ["doc_id"]).first().score <= 1
    assert op8.identified(docs, sampling.trained(op8.sample_texts(docs), op8.train), ["doc_id"]).count() == 0


def test_quality_score_is_a_sparse_dot_product():
    """Against tokens, pairs and weights taken one by one."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["sea", "tide", "!!", "7up", "é", "sea sea"]) for _ in range(rng.randint(1, 30))).encode() for _ in range(60)]
    model = op6.train([(t, i % 2) for i, t in enumerate(texts)])
    for text in [*texts[:20], b""]:
        h = ngrams.token_hashes([text])[0].tolist()
        assert len(h) == len(re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\r\x0b\x0c]+", text))
        pairs = [int(op6._REPEAT) if a == b else (a * 0x9FB21C651E98DF25 + b) % 2**64 for a, b in zip(h, h[1:])]
        buckets = [(x * 0x9E3779B97F4A7C15 % 2**64) >> (64 - op6.BITS) for x in h + pairs]
        want = model["bias"] + sum(op6.SCALE / len(buckets) * float(model["weights"][b]) for b in buckets)
        assert op6.logits_of([text], model)[0] == pytest.approx(want, abs=1e-4)


def test_ftrl_as_by_hand():
    """One coordinate, updates written out."""
    m = op6.Ftrl(alpha=0.5, beta=1.0, l1=0.02, l2=1e-4)
    z = n = bz = bn = 0.0
    at, x = np.array([3]), np.array([0.7])
    for y in (1, 0, 1, 1):
        w = 0.0 if abs(z) <= 0.02 else (math.copysign(0.02, z) - z) / ((1 + math.sqrt(n)) / 0.5 + 1e-4)
        b = -bz / ((1 + math.sqrt(bn)) / 0.5)
        err = 1 / (1 + math.exp(-(w * 0.7 + b))) - y
        g = err * 0.7
        z += g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w
        n += g * g
        bz += err - (math.sqrt(bn + err * err) - math.sqrt(bn)) / 0.5 * b
        bn += err * err
        m.learn(at, x, y, 1.0)
    assert m.z[3] == pytest.approx(z) and m.n[3] == pytest.approx(n) and m.bias == pytest.approx(-bz / ((1 + math.sqrt(bn)) / 0.5))


def test_toxicity_score_by_hand():
    """Against n-grams, words and the strongest words taken one by one."""
    table = rng_table(op10.BITS)
    model = {"table": table, "bias": -0.5}
    rng = random.Random(9)
    for n in (0, 1, 2, 5, 250):
        words = [rng.choice(["alpha", "bé", "x", "gamma", "delta7"]) for _ in range(n)]
        scores = []
        for i, w in enumerate(words):
            raw = f" {w} ".encode().translate(ngrams.WORD_TABLE)
            grams = [raw[a : a + k] for k in op10.SIZES for a in range(len(raw) - k + 1)]
            found = [float(table[[b for _, b in ngrams.gram_buckets(np.frombuffer(g, np.uint8), (len(g),), op10.BITS)][0][0]]) for g in grams]
            scores.append(0.0 if i and words[i - 1] == w else sum(found) / max(1, len(found)))
        k = min(n, max(op10.LEAST_WORDS, math.ceil(op10.SHARE * n)))
        want = -0.5 + (sum(sorted(scores)[n - k :]) / k if n else 0.0)
        assert op10.logits_of([" ".join(words).encode()], model)[0] == pytest.approx(want, abs=1e-4)


def test_bags_sums_as_loops():
    rng = random.Random(13)
    texts = [" ".join(rng.choice(["sea", "tide", "moon", "mooned", "salt"]) for _ in range(rng.randint(1, 23))).encode() for _ in range(30)]
    bags = op10.Bags(texts)
    v = np.random.default_rng(1).normal(size=(len(bags.used), 2))
    column = {int(b): i for i, b in enumerate(bags.used)}

    def word(w):
        raw = np.frombuffer(b" " + w + b" ", np.uint8)
        grams = [int(b) for k in op10.SIZES if k <= len(raw) for b in [x for _, x in ngrams.gram_buckets(raw, (k,), op10.BITS)][0]]
        return sum((v[column[g]] for g in grams if g in column), np.zeros(2)) / max(1, len(grams))

    words = [w for t in texts for w in t.split()]
    ends = np.cumsum(bags.sizes)
    want = np.array([np.mean([word(w) for w in words[e - n : e]], axis=0) for e, n in zip(ends, bags.sizes)])
    up = bags.up(v)
    assert np.allclose(up, want)
    grad = np.random.default_rng(2).normal(size=up.shape)
    assert np.isclose((bags.down(grad) * v).sum(), (grad * up).sum())  # the adjoint


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    word = random.Random(31)
    prose = lambda k: " ".join("".join(word.choice("abcdefghij") for _ in range(6)) for _ in range(k))
    item, passage, long = prose(20), prose(60), prose(250_000)
    texts = [(1, None), (2, ""), (3, long), (4, long), (5, prose(80) + " " + passage), (6, passage + " " + prose(90)), (7, item), (8, prose(400) + " " + item.upper()), (9, prose(50)), (9, None), (None, "alone"), (None, "alone")]
    rows = [(i, t, "en", "s", len(t or ""), "x", 1, 2, "v") for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, own string, fp int, spans int, verdict string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("q", item), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [x.split()[0] for x in schema.split(", ")], name
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == {1, 3, 5, 6, 8, 9, None}  # one wordless text, one copy; the item itself goes
    assert passage not in kept[5].text and passage not in kept[6].text and kept[5].n_chars == len(kept[5].text)
    assert item.upper() not in kept[8].text and kept[3].text == long and kept[1].text is None and kept[9].verdict == "v"
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(kept) and out[1].n_tokens == 1 and len(out[3].ids) == len(out[3].starts) == out[3].n_tokens
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
