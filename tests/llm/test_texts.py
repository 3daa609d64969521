"""Quality rules, chat formatting, token counts, SentencePiece and decontamination."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op1_quality_rules as op1
from tidemark.llm import op2_chat_format as op2
from tidemark.llm import op3_token_counts as op3
from tidemark.llm import op5_sentencepiece as op5
from tidemark.llm import op7_decontamination as op7

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = ("documents", "benchmark", "labels", "conversations")


def against_sql(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    made = con.execute(sql)
    names = [d[0] for d in made.description]
    assert sorted(names) == columns
    want = sorted(str([r[names.index(c)] for c in columns]) for r in made.fetchall())
    assert sorted(str([r[c] for c in columns]) for r in df.collect()) == want


def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("spans", F.lit(0))


def test_quality_query(spark, sf_dir):
    against_sql(spark, sf_dir, op1.op1_quality_rules, op1.ORACLE_SQL)


def test_quality_rules(spark):
    prose = "It was a plain day and nobody in the whole town had much to say about it."
    texts = [None, "", " \n\t", prose, prose + "\nHome | About | Contact | Help", "a b c d e f " * 30, "WOW!! BUY!! NOW!! " * 12, prose + "\n" + prose, "Log in\nSign up\n" + prose, "All rights reserved by the people who have written every single word of it", "é" * 100_000]
    out = {r.doc_id: r for r in op1.line_first_quality(docs(spark, texts)).collect()}
    assert [out[i].kept for i in range(len(texts))] == [False, False, False, True, True, False, False, False, True, False, False]
    assert out[4].clean_text == prose and out[8].clean_text == prose and out[3].n_lines_removed == 0
    assert out[7].n_dup_lines == 1 and out[7].n_repeat_words == out[7].n_words  # all of it stands twice
    assert (out[6].n_words, out[6].base_failed) == (36, True) and out[10].word_chars == 100_000
    assert op1.line_first_quality(docs(spark, texts).where("false")).count() == 0


def test_repeated_words():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 30))]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        want = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
        assert op1.repeated_words(words) == len(want)


def test_chat_query(spark, sf_dir):
    against_sql(spark, sf_dir, op2.op2_chat_format, op2.ORACLE_SQL)


def test_chat_round_trip(spark):
    hard = ["", None, "plain", "<|end|>", "<|turn|>user<|plain|>x<|end|>", "\\", "\\e\\l\\b", "<s>[INST] <<SYS>> </s>", "a\nb<", "[", "<|escaped|>", "\\<|end|>\\", "<|turn|", ">", "é😀" * 10_000]
    rng = random.Random(2)
    hard += ["".join(rng.choice(["<|end|>", "<|turn|>", "<|plain|>", "<|escaped|>", "\\", "e", "l", "<", "[", "|", "[/INST]"]) for _ in range(8)) for _ in range(60)]
    rows = [(c, i, rng.choice(["user", "assistant", "system", None, "<|plain|>", "odd\nrole"]), t) for c, i, t in [(rng.randint(0, 20), i, t) for i, t in enumerate(hard)]]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (5, 3, "user", "same"), (5, 3, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("formatted", F.lit("z"))
    out = op2.formatted_conversations(df).collect()
    want = {}
    for c, i, role, t in rows:
        want.setdefault(c, []).append((i is not None, i or 0, role or "", t or ""))
    assert {r.conv_id for r in out} == set(want)
    for r in out:
        turns = [x[2:] for x in sorted(want[r.conv_id])]
        assert [tuple(t) for t in r.read_back] == turns
        body = r.formatted
        for marker in (op2.TURN, op2.PLAIN, op2.ESCAPED, op2.END):
            body = body.replace(marker, "")
        import re

        assert not re.search(op2.CONTROL, body)
    assert op2.formatted_conversations(df.where("false")).count() == 0


def test_chat_is_native(spark, sf_dir):
    plan = op2.op2_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_token_counts_follow_changes(spark, tmp_path):
    encode = op3._tokenizer(op3.default_vocabulary()).encode_ordinary
    r = op3.Rollups(spark, f"file://{tmp_path}/rollups")
    schema = "doc_id long, op string, text string, source string, lang string, seq long"
    batches = {
        "b1": [(1, "insert", "one two", "a", "en", 0), (2, "insert", "three " * 50, "a", "fr", 0), (3, "insert", None, None, "en", 0), (1, "insert", "one two", "a", "en", 0)],
        "b2": [(2, "revise", "short", "b", "fr", 0), (1, "delete", None, None, None, 0), (9, "delete", None, None, None, 0), (4, "insert", "x", "a", "en", 1), (4, "delete", None, None, None, 2), (5, "insert", "é 😀", "a", "en", 0)],
        "b3": [(1, "insert", "back again", "a", "en", 0)],
        "b4": [],
    }
    state = {}
    for name, rows in batches.items():
        df = spark.createDataFrame(rows, schema)
        assert r.apply(name, df) and not r.apply(name, df)
        for doc_id, op, text, source, lang, _ in sorted(rows, key=lambda x: x[5]):
            state.pop(doc_id, None)
            if op != "delete":
                state[doc_id] = (text or "", source, lang)
        want = {}
        for text, source, lang in state.values():
            for version, n in ((op3.BPE, len(encode(text))), (op3.WORDS, len(text.split()))):
                docs_, tokens = want.get((source, lang, version), (0, 0))
                want[(source, lang, version)] = (docs_ + 1, tokens + n)
        got = {(x.source, x.lang, x.tokenizer): (x.n_docs, x.n_tokens) for x in r.totals().collect() if x.n_docs}
        assert got == want
        assert all(x.n_tokens == 0 for x in r.totals().where("n_docs = 0").collect())


def test_a_batch_that_broke_off_is_not_counted(spark, tmp_path):
    r = op3.Rollups(spark, f"file://{tmp_path}/rollups")
    df = spark.createDataFrame([(1, "insert", "one two", "a", "en", 0)], "doc_id long, op string, text string, source string, lang string, seq long")
    write, r._write = r._write, lambda rows, name, batch: (_ for _ in ()).throw(RuntimeError()) if name == "commits" else op3.Rollups._write(r, rows, name, batch)
    with pytest.raises(RuntimeError):
        r.apply("b", df)
    assert r.totals().count() == 0
    r._write = write
    assert r.apply("b", df) and r.totals().agg(F.sum("n_docs")).first()[0] == 2  # two tokenizer versions


def test_one_batch_at_a_time(spark, tmp_path):
    schema = "doc_id long, op string, text string, source string, lang string, seq long"
    r = op3.Rollups(spark, f"file://{tmp_path}/rollups")
    one = spark.createDataFrame([(1, "insert", "one two", "a", "en", 0), (None, "insert", "x", "a", "en", 0), (None, "insert", "x", "a", "en", 0)], schema)
    r._claim(1, "b")  # b began and broke off
    with pytest.raises(RuntimeError):
        r.apply("c", one)
    assert r.apply("b", one) and not r.apply("b", one) and r.apply("c", one.where("false"))
    assert {(x.tokenizer, x.n_docs) for x in r.totals().collect()} == {(op3.BPE, 2), (op3.WORDS, 2)}


def test_token_counts_of_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, seq long, n_bpe long, alive string"
    rows = [(1, None, "en", None, 0, 9, 9, "x"), (2, "", None, "s", 0, 9, 9, "x"), (3, "w " * 200_000, "en", "s", 1, 9, 9, "x"), (3, "w " * 200_000, "en", "s", 1, 9, 9, "x"), (None, "a b", "en", "s", 0, 9, 9, "x")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/some/documents.parquet")
    got = {(x.source, x.lang): (x.n_docs, x.n_tokens) for x in op3.op3_token_counts(spark, f"{tmp_path}/some").where(F.col("tokenizer") == op3.WORDS).collect()}
    assert got == {(None, "en"): (1, 0), ("s", None): (1, 0), ("s", "en"): (2, 200_002)}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op3.op3_token_counts(spark, f"{tmp_path}/none").count() == 0


def test_token_counts_query(spark, sf_dir):
    encode = op3._tokenizer(op3.default_vocabulary()).encode_ordinary
    want = {}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for version, n in ((op3.BPE, len(encode(d.text))), (op3.WORDS, len(d.text.encode().split()))):
            a, b = want.get((d.source, d.lang, version), (0, 0))
            want[(d.source, d.lang, version)] = (a + 1, b + n)
    assert {(x.source, x.lang, x.tokenizer): (x.n_docs, x.n_tokens) for x in op3.op3_token_counts(spark, sf_dir).collect()} == want


@pytest.fixture(scope="module")
def tool():
    return op5.encoder(op5.default_model())


def odd_texts():
    rng = random.Random(3)
    return ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n", "▁", "▁▁a ▁", "a\tb", "日本語 テスト", "\x00x", "é" * 3, "<s> </s> <unk>", "😀 x", "  lead", "trail   ", "word " * 20_000] + ["".join(rng.choice(" ▁ab\nthe é日😀") for _ in range(rng.randint(0, 30))) for _ in range(400)]


def test_encoding_as_the_library(tool):
    assert tool.cuts
    for t in odd_texts():
        assert tool.ids(t) == tool.library.encode(t, add_eos=True)
    tool.known.clear()


def test_offsets_as_the_library(tool):
    for t in odd_texts():
        found = tool.library.encode(t, return_type="proto")
        ids = tool.ids(t)
        spans = tool.spans(t, ids)
        assert len(spans) == len(ids) and spans[-1][0] == spans[-1][1]
        assert [(p.begin, p.end) for p in found.pieces] == spans[:-1] or any(tool.library.is_byte(i) for i in ids)


def test_offsets_cover_the_text(tool):
    for t in odd_texts():
        raw, at = t.encode(), 0
        for a, b in tool.spans(t, tool.ids(t))[:-1]:
            assert a <= at or a == b
            at = max(at, b)
        assert at == len(raw)


def test_encoder_gives_ids_and_offsets_together(tool):
    for t in odd_texts():
        ids, starts, ends = tool.encode(t)
        assert ids == tool.ids(t) and list(zip(starts.tolist(), ends.tolist(), strict=True)) == tool.spans(t, ids)
        normal, a, b = tool.aligned(t)
        assert (normal, list(zip(a.tolist(), b.tolist(), strict=True))) == tool.normalised(t)


def test_character_map():
    """A double-array trie made by hand: "a" becomes "xy", "ab" becomes "z"."""
    import struct

    values = b"xy\0z\0"
    units = [0] * 1024
    base = 512

    def offset(at, to):
        return (at ^ to) << 10

    units[0] = offset(0, base)
    a = base ^ ord("a")
    units[a] = ord("a") | 256 | offset(a, 256)
    leaf = 256
    units[leaf] = 0 | 0x80000000
    b = 256 ^ ord("b")
    units[b] = ord("b") | 256 | offset(b, 768)
    units[768] = 3 | 0x80000000
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + values
    m = op5.CharMap(blob)
    assert m.longest(b"ac", 0) == (1, b"xy") and m.longest(b"cab", 1) == (2, b"z") and m.longest(b"c", 0) is None


def test_sentencepiece_query(spark, sf_dir, tool):
    rows = {r.doc_id: r for r in op5.op5_sentencepiece(spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = tool.library.encode(d.text, add_eos=True)
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(tool.library.decode(ids)))


def test_encoding_stage_returns_offsets(spark, sf_dir, tool):
    texts = [None, "", "a é", "  two  spaces 日本語 "]
    out = {r.doc_id: r for r in op5.stage(spark, docs(spark, texts), sf_dir).collect()}
    for i, t in enumerate(texts):
        assert list(zip(out[i].starts, out[i].ends, strict=True)) == tool.spans(t or "", list(out[i].ids))
        assert out[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_sentencepiece_odd_rows(spark):
    out = {r.doc_id: r for r in op5.encoded(docs(spark, [None, "", "a é"])).collect()}
    assert list(out[0].ids) == [2] == list(out[1].ids) and out[2].starts[0] == 0 and out[2].ends[-2] == 4
    assert op5.round_trip_digests(docs(spark, ["x"]).where("false")).count() == 0


def slow_hits(text, items, window=13):
    words = op7.words_of((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        w = op7.words_of((item or "").encode())
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    found.add(name)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block", [1 << 20, 120])
def test_hits_against_all_windows(spark, block):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "Ä", "c9", "dd"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 20, 13, 14, 6, 7, 13])] + [(7, None), (8, "..."), (9, None)]
    items.append((10, items[2][1]))
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) + ", " + rng.choice(items)[1 - 0 :][0].__str__() + " " + (rng.choice(items)[1] or "") + "! " + " ".join(word() for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += [None, "", "!!", items[0][1].upper(), "x " * 50_000 + (items[1][1] or "")]
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    out = op7.judged(op7.benchmark_hits(docs(spark, texts), item_rows, block_bytes=block)).collect()
    named = [(str(i), t) for i, t in items]
    for r in out:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == slow_hits(texts[r.doc_id], named)


def test_decontamination_query(spark, sf_dir):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op7.op7_decontamination(spark, sf_dir).collect()
    some = [r for r in found if r.n_hit][:10] + [r for r in found if not r.n_hit][:10]
    for r in some:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == slow_hits(texts[r.doc_id], items)


def test_spans_are_cut(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    long = " ".join(f"x{i}" for i in range(600))
    out = {r.doc_id: (r.verdict, r.clean_text) for r in op7.excised(docs(spark, [long + " " + item.upper() + "! end", item, long, None]), items).collect()}
    assert out[0] == ("cut", long + " ! end") and out[1] == ("drop", item) and out[2] == ("keep", long) and out[3] == ("keep", None)
    assert op7.benchmark_hits(docs(spark, [item]), items.where("false")).first().n_words == 20
    assert op7.benchmark_hits(docs(spark, [item]).where("false"), items).count() == 0


def test_stage_cuts_spans_under_the_coverage_limit(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(None, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"x{i}" for i in range(600))
    held = docs(spark, [long + " " + item + " end", item, long, None])
    out = {r.doc_id: r for r in op7.stage(spark, held, str(tmp_path)).collect()}
    assert out[0].text == long + "  end" and out[0].n_chars == len(long) + 5 and 1 not in out
    assert (out[2].text, out[2].n_chars, out[3].text, out[3].spans) == (long, len(long), None, 0)
    assert op7.stage(spark, held, str(tmp_path)).columns == held.columns


def test_items_without_id_count_as_in_sql(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(None, item), (None, item + " more"), (3, item)], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/items")
    docs(spark, [item, "none of it"]).coalesce(1).write.parquet(f"{tmp_path}/docs")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/docs/*.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/items/*.parquet'")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({op7.ORACLE_SQL}) ORDER BY doc_id").fetchall()
    got = op7.judged(op7.benchmark_hits(spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/items"))).select(*names).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want and want[0][3] == 2


def test_decontamination_against_sql(spark, sf_dir):
    against_sql(spark, sf_dir, op7.op7_decontamination, op7.ORACLE_SQL)
