"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the words of every test item. The words of each document are streamed through it; where the
longest match reaches a window (13 words of an item, or all of a shorter item) the words of that window are hit.
A document is contaminated if a twentieth of its words or more are hit.

The items are dealt into blocks of bounded size, and each block's automaton goes over all documents in turn: no join,
no shuffle. Words that no item has break a match, so only runs of known words that are as long as the shortest window
are walked.

Defined results: null or wordless texts have no words and no hits; a null or wordless item has no window; equal items
under different ids all count; repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

WINDOW = 13
#: What an item without id is called within; it counts as one item, and no list of items names it.
NO_ID = "\0"
#: Bytes of items in one block; its automaton takes some hundred times as many.
BLOCK_BYTES = 1 << 20

#: Bytes that end a word become spaces, A-Z become a-z; digits, letters and all bytes beyond ASCII stay.
TABLE = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

HITS = "n_words long, spans array<struct<first:int,last:int>>, longest int, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


class Automaton:
    """Suffix automaton of many word sequences; knows which items have the window that ends at a state."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        items = [(name, words) for name, words in items if words]
        self.window = window
        self.least = min((min(window, len(words)) for _, words in items), default=0)
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self.whole: list[int] = [0] * len(self.next)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for v in order:  # the state of the last `window` words
            above = self.link[v]
            self.whole[v] = 0 if self.length[v] < window else self.whole[above] if self.length[above] >= window else v
        self.items: dict[int, set[str]] = {}
        own: dict[int, list[tuple[int, str]]] = {}
        for name, codes in coded:
            v = 0
            for i, c in enumerate(codes):
                v = self.next[v][c]
                if i + 1 >= window:
                    self.items.setdefault(self.whole[v], set()).add(name)
            if len(codes) < window:
                own.setdefault(v, []).append((len(codes), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for v in order if own else ():
            if found := own.get(v, []) + self.short.get(self.link[v], []):
                self.short[v] = found

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], int, set[str]]:
        """Hit spans (first and last word, merged), the longest match in words, and the items that occur."""
        spans: list[tuple[int, int]] = []
        longest, found = 0, set()
        if len(words) < self.least or not self.ids:
            return spans, longest, found
        codes = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False]))))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            v = matched = 0
            for i, c in enumerate(codes[start:end].tolist(), start):
                while v and c not in self.next[v]:
                    v = self.link[v]
                    matched = self.length[v]
                if c in self.next[v]:
                    v = self.next[v][c]
                    matched += 1
                reach = 0
                if matched >= self.window:
                    reach = self.window
                    found |= self.items[self.whole[v]]
                for n, name in self.short.get(v, ()):
                    if n <= matched:
                        reach = max(reach, n)
                        found.add(name)
                if reach:
                    longest = max(longest, matched)
                    first = i - reach + 1
                    while spans and spans[-1][1] >= first - 1:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return spans, longest, found


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list[tuple[str, bytes]], window: int) -> Automaton:
    """One automaton is kept in a worker; tasks of the same block share it."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton([(name, words_of(text)) for name, text in items], window)
    return _BUILT[key]


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _pass(docs: DataFrame, key: str, block, window: int, judge: Callable | None = None) -> DataFrame:
    """Adds one block's hits to those that the rows carry; with judge, the last pass, the text becomes what it returns."""
    schema = docs.drop("text").schema.add("verdict", "string").add("clean_text", "string") if judge else docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, block.value, window)
        for whole in batches:
            texts = whole.column(whole.schema.get_field_index("text"))
            for start, stop in common.chunks(texts):
                batch = whole.slice(start, stop - start)
                col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                raw, n, spans, longest, items = col["text"].to_pylist(), [], [], [], []
                for text, s0, l0, i0 in zip(raw, col["spans"].to_pylist(), col["longest"].to_pylist(), col["items"].to_pylist(), strict=True):
                    words = words_of(text)
                    s, most, found = automaton.scan(words)
                    n.append(len(words))
                    spans.append(merged([*((x["first"], x["last"]) for x in s0), *s]))
                    longest.append(max(l0, most))
                    items.append(sorted({*i0, *found}))
                kinds = {f.name: f.type for f in batch.schema}
                if judge:
                    told = [judge(*row) for row in zip(raw, n, spans, strict=True)]
                    col |= {"verdict": [v for v, _ in told], "clean_text": [t for _, t in told]}
                    del col["text"]
                    kinds = {k: t for k, t in kinds.items() if k != "text"} | {"verdict": pa.string(), "clean_text": pa.string()}
                col |= {"n_words": n, "spans": [[{"first": a, "last": b} for a, b in s] for s in spans], "longest": longest, "items": items}
                yield pa.RecordBatch.from_arrays([pa.array(col[k], type=t) if isinstance(col[k], list) else col[k] for k, t in kinds.items()], names=list(kinds))

    return common.arrow_map(docs, run, schema)


def benchmark_hits(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, judge: Callable | None = None) -> DataFrame:
    """Every document with n_words, the hit spans in words, the longest match and the ids of the items found.

    keep: columns of the documents that the result carries, the id by default. judge: of text, words and spans makes
    the columns verdict and clean_text, which the result has then too.
    """
    spark = docs.sparkSession
    known = items.select(F.coalesce(F.col(item_column).cast("string"), F.lit(NO_ID)).alias("name"), F.col(item_text).cast("binary").alias("text")).where("text IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    own = keep or [id_column]
    rows = docs.select(F.struct(*own).alias("own"), F.col(text_column).cast("binary").alias("text"), *[F.expr(e) for e in ("CAST(0 AS LONG) AS n_words", "CAST(array() AS array<struct<first:int,last:int>>) AS spans", "0 AS longest", "CAST(array() AS array<string>) AS items")])
    for k in range(blocks):
        part = known.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == k).collect()  # about block_bytes of text
        pairs = sorted((r.name, bytes(r.text)) for r in part)
        key = hashlib.sha256(repr((window, pairs)).encode()).hexdigest()
        rows = _pass(rows, key, spark.sparkContext.broadcast(pairs), window, judge if k + 1 == blocks else None)
        if k + 1 < blocks:
            rows = common.checkpointed(rows)
    named = F.transform("items", lambda x: F.when(x != NO_ID, x))
    return rows.select("own.*", "n_words", "spans", "longest", named.alias("items"), *(["verdict", "clean_text"] if judge else []))


def judged(hits: DataFrame) -> DataFrame:
    """The digest columns and the verdict."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return (
        hits.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )


def excised(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", span_words: int = WINDOW, coverage: float = 0.05, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """The id (or the columns of keep, which doesn't name the text), `verdict` and `clean_text` of every document.

    `drop` where at least `coverage` of the words are hit; `cut` where the hit spans of span_words words or more were
    taken out, from the first byte of the first word to the last of the last; `keep`, with the text as it is, else.
    """
    keep = keep or [id_column]
    held = docs.select(F.struct(*keep).alias("held"), F.col(text_column).alias("whole"))

    def judge(raw: bytes | None, n: int, spans: list[tuple[int, int]]) -> tuple[str, str | None]:
        hit = sum(b - a + 1 for a, b in spans)
        if hit and hit >= coverage * n - 1e-9:
            return "drop", raw.decode("utf-8", "replace")
        long = [s for s in spans if s[1] - s[0] + 1 >= span_words]
        if not long:
            return "keep", None if raw is None else raw.decode("utf-8", "replace")
        places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(TABLE))]
        edges = [0, *[x for a, b in long for x in (places[a][0], places[b][1])], len(raw)]
        return "cut", b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode("utf-8", "replace")

    hits = benchmark_hits(held, items, "held", "whole", keep=["held"], window=window, judge=judge)
    return hits.select("held.*", "verdict", "clean_text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return judged(hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS_SQL}, []) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS ws FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT item, ws, least({WINDOW}, len(ws)) AS k, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM bs),
ds AS (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k),
hits AS (SELECT r, i, k, item FROM (SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM ds) JOIN bw USING (k, w)),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM (SELECT DISTINCT r, i, unnest(range(k)) AS j FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AND 20 * coalesce(cov.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the hit spans are cut. n_chars follows."""
    others = [c for c in docs.columns if c != "text"]
    held = docs.select(F.struct(*others).alias("tidemark_own"), "text")
    out = excised(held, common.table(spark, sf_dir, "benchmark"), keep=["tidemark_own"]).where("verdict != 'drop'")
    cut = F.col("verdict") == "cut"
    made = {"text": F.col("clean_text")}
    if "n_chars" in others:
        made["n_chars"] = F.when(cut, F.char_length("clean_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("tidemark_own.n_chars"))
    return out.select(*[made.get(c, F.col("tidemark_own")[c]).alias(c) for c in docs.columns])
