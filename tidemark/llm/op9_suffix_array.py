"""Exact repeated passages by a depth-limited radix sort of suffixes.

A suffix is looked at through its first LENGTH bytes only (its window); windows that end up in one group after all
digits are the repeated ones, and every byte that a repeated window covers is removed. Two windows can only be equal if
they have the same anchor: the GRAM bytes in them whose hash is least (the leftmost of equals), at the same place. So
the most significant digit is the anchor's hash, and all windows with one anchor, a run of neighbouring suffixes, pass
through the first digit as one row:

1. Every run is written with its anchor and a hash of its bytes; anchors that occur once drop out, with all their
   suffixes.
2. Runs left that are equal as a whole form a class. A class that occurs at two places is repeated throughout.
3. Of anchors with several classes, a task tells each of its classes once, with its bytes, and the classes are dealt by
   anchor. Their windows are sorted by place of the anchor, then by one digit of DIGIT bytes after another; groups of
   one drop out at each pass. What is left after the last digit is repeated, and goes back by a join to the places of
   the class, however many they are.

The first digit's survivors go to the second scan as a bitmap of some sixteen bits for each (a false positive there
costs a row, not the result), or, beyond MOST_ANCHORS of them, by a join on the anchor's hash that hands every text its
own. The windows of anchors with more than HOT classes aren't gathered anywhere: they are counted one by one, by 128-bit
hash, with map-side combining. Texts that occur twice as a whole are repeated throughout from their first to their last
byte (if a window fits in) and count as one place in the steps above.

Digits are 64-bit hashes. Texts are known by two 64-bit hashes and their length.

Passages of over PASSAGE_WORDS words are mostly shorter than LENGTH bytes. They are found by the same sort through
PASSAGE bytes, of whose covered runs only those of more words count: the query tells their number, the stage cuts them.
Where both lengths are asked for, the shorter goes first: a repeated window consists of repeated shorter ones, so the
longer is looked for only in texts whose shorter ones cover as much from the first to the last.

Defined results: a null text counts as empty; texts shorter than LENGTH keep everything; repeated rows are copies of
each other, so both lose everything; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

LENGTH = 400
GRAM = 64
DIGIT = 80
#: Bytes of the windows that passages are found by, of their anchors, and the words that a passage has more than.
PASSAGE = 240
PASSAGE_GRAM = 48
PASSAGE_WORDS = 50
#: Occurrences of an anchor beyond which its classes are put together before they are gathered, and classes of an
#: anchor beyond which its windows are counted one by one.
HOT = 200_000
#: Anchors that occur twice, beyond which they are joined to their texts instead of sent out as a bitmap (32 MiB then).
MOST_ANCHORS = 1 << 24
HOT_BITS = 20
#: Bytes of a text that are looked at at a time, and of texts that are looked at together.
SEGMENT = 4 << 20
TOGETHER = 1 << 19
#: Windows sorted at a time, and classes that a task puts together before it tells them.
BATCH_WINDOWS = 400_000
REMEMBERED = 100_000

_MIXES = np.random.default_rng(400).integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BASE = _BASES[0]
_MASK = (1 << 64) - 1
_PLACE = np.uint64((1 << 28) - 1)


def rolling(data: np.ndarray, *lengths: int, kind: int = 0) -> list[np.ndarray]:
    """For each length, a 64-bit hash of so many bytes from every place; by doubling. There are two kinds."""
    base = _BASES[kind]
    powers = {1: _MIXES[kind][data]}
    n = 1
    while 2 * n <= max(lengths):
        h = powers[n]
        powers[2 * n] = h[:-n] * np.uint64(pow(base, n, 1 << 64)) + h[n:] if len(h) > n else h[:0]
        n *= 2
    out = []
    for length in lengths:
        h, done = None, 0
        for n in sorted(powers, reverse=True):
            if length - done >= n:
                part = powers[n][done:]
                if h is None:
                    h = part
                else:
                    m = min(len(h), len(part))
                    h = h[:m] * np.uint64(pow(base, n, 1 << 64)) + part[:m]
                done += n
        out.append(h[: max(0, len(data) - length + 1)])
    return out


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` neighbours from every place."""
    rows = -(-len(v) // width)
    a = np.full(rows * width, np.uint64(_MASK))
    a[: len(v)] = v
    a = a.reshape(rows, width)
    upto = np.minimum.accumulate(a, axis=1).ravel()
    since = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(v) - width + 1
    return np.minimum(since[:n], upto[width - 1 : width - 1 + n])


def runs(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of windows with one anchor: the anchor's hash and place, the first and the last window's start."""
    none = np.zeros(0, np.int64)
    if len(text) < length:
        return none.view(np.uint64), none, none, none
    if len(text) > SEGMENT + length:  # windows in segments, so that memory is bounded; a run that is cut is two
        parts = [(at, runs(text[at : at + SEGMENT + length - 1], length, gram)) for at in range(0, len(text) - length + 1, SEGMENT)]
        return np.concatenate([r[0] for _, r in parts]), *(np.concatenate([r[i] + at for at, r in parts]) for i in (1, 2, 3))
    (h,) = rolling(np.frombuffer(text, np.uint8), gram)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    least = sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    place = (least & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return h[place[first]], place[first], first, last


def repeated_windows(group: np.ndarray, left: np.ndarray, contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context (the bytes of a class's run), which of its windows another class of its group has too.

    group: the anchor's number, left: bytes before the anchor. Contexts of a group are all different. Windows whose
    anchors lie at different places in them are never equal, so many windows are taken by ranges of that place.
    """
    counts = np.array([len(c) for c in contexts], np.int64) - length + 1
    if counts.sum() <= BATCH_WINDOWS:
        return _sorted_windows(group, left, contexts, length)
    hits = [np.zeros(n, bool) for n in counts.tolist()]
    width = max(1, BATCH_WINDOWS // len(contexts))
    for least in range(int((left - counts).min()) + 1, int(left.max()) + 1, width):
        first, last = np.maximum(left - least - width + 1, 0), np.minimum(left - least, counts - 1)
        some = np.flatnonzero(first <= last)
        if len(some):
            parts = [contexts[i][first[i] : last[i] + length] for i in some.tolist()]
            for i, hit in zip(some.tolist(), _sorted_windows(group[some], (left - first)[some], parts, length), strict=True):
                hits[i][first[i] : last[i] + 1] = hit
    return hits


def _sorted_windows(group: np.ndarray, left: np.ndarray, contexts: list[bytes], length: int) -> list[np.ndarray]:
    sizes = np.array([len(c) for c in contexts], np.int64)
    counts = sizes - length + 1
    at = np.cumsum(counts) - counts
    step = np.arange(counts.sum()) - np.repeat(at, counts)
    key = np.repeat(group.astype(np.uint64) << np.uint64(20), counts) + (np.repeat(left, counts) - step).astype(np.uint64)
    digits = [DIGIT] * (length // DIGIT) + ([length % DIGIT] if length % DIGIT else [])
    depths = np.cumsum([0, *digits[:-1]]).tolist()
    read = [np.empty(len(step), np.uint64) for _ in digits]
    upto = np.cumsum(sizes)
    i = 0
    while i < len(contexts):  # the digits of a MiB or so of contexts at a time
        j = max(i + 1, int(np.searchsorted(upto, upto[i] - sizes[i] + (1 << 20), side="right")))
        hashes = dict(zip(sorted(set(digits)), rolling(np.frombuffer(b"".join(contexts[i:j]), np.uint8), *sorted(set(digits))), strict=True))
        a, b = at[i], at[j - 1] + counts[j - 1]
        start = np.repeat(upto[i:j] - sizes[i:j] - (upto[i] - sizes[i]), counts[i:j]) + step[a:b]
        for d, (digit, depth) in enumerate(zip(digits, depths, strict=True)):
            read[d][a:b] = hashes[digit][start + depth]
        i = j
    alive = np.arange(len(step))
    for digit in read:  # the most significant first
        key = (key * np.uint64(0xD6E8FEB86659FD93) ^ digit[alive]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
        order = np.argsort(key)
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        many = np.zeros(len(key), bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        alive, key = alive[many], key[many]
    hit = np.zeros(len(step), bool)
    hit[alive] = True
    return np.split(hit, at[1:])


def spans_of(hit: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte ranges (start, end) covered by the windows that are hit."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def batched_runs(texts: Sequence[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """runs() of many texts, with the index of the text of each, by whole arrays over the texts put together."""
    if len(texts) == 1:
        found = runs(texts[0], length, gram)
        return np.zeros(len(found[0]), np.int64), *found
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.sum():
        return np.zeros(0, np.int64), *runs(b"", length, gram)
    opens = np.cumsum(sizes) - sizes
    (h,) = rolling(np.frombuffer(b"".join(texts), np.uint8), gram)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    least = sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + opens[text]
    place = (least[start] & _PLACE).astype(np.int64)  # anchors lie in their windows, so never in another text
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    own = text[first]
    return own, h[place[first]], place[first] - opens[own], start[first] - opens[own], start[last] - opens[own]


KEY = ["k", "k2", "n"]
TEXTS = ["text", "k", "k2"]
RUNS = "h long, ext long, k long, k2 long, n int, first int, size int"
CLASSES = "h long, ext long, before int, context binary"
WINDOWS = "w1 long, w2 long, k long, k2 long, n int, first int"


def _texts(batches: Iterator[pa.RecordBatch], asked) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, list[list[int]] | None]]:
    """Texts that are asked for, some together, with their hashes and, if given, their anchors; copies seen lately are passed over, as they have the same places."""
    seen: set[tuple[int, int, int]] = set()
    for whole in batches:
        if asked:
            whole = whole.filter(pa.array(_has(asked.value, whole.column(1).to_numpy().view(np.uint64))))
        for a, b in common.chunks(whole.column(0), TOGETHER):
            rows = []
            for row in zip(*[c.to_pylist() for c in whole.slice(a, b - a).columns], strict=True):
                key = (row[1], row[2], len(row[0]))
                if key not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    rows.append(row)
            if rows:
                texts, k, k2, *own = zip(*rows, strict=True)
                yield list(texts), np.array(k, np.int64), np.array(k2, np.int64), own[0] if own else None


def _run_scan(asked, length: int, gram: int):
    """Every run: its anchor, its class, its text, its first window and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, k, k2, _ in _texts(batches, asked):
            own, h, place, first, last = batched_runs(texts, length, gram)
            ext = [xxhash.xxh64_intdigest(texts[t][a:b], s) for t, a, b, s in zip(own.tolist(), first.tolist(), (last + length).tolist(), (place - first).tolist(), strict=True)]
            n = np.fromiter(map(len, texts), np.int32, len(texts))
            yield pa.RecordBatch.from_arrays([_signed(h), _signed(ext), pa.array(k[own]), pa.array(k2[own]), pa.array(n[own]), pa.array(first.astype(np.int32)), pa.array((last + length - first).astype(np.int32))], names=["h", "ext", "k", "k2", "n", "first", "size"])

    return run


def _has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = (h & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    return ((bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)


def _marked(maps, name: str):
    """Of rows with an anchor first, those whose anchor is in the bitmap of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = maps.value[name]
        for batch in batches:
            yield batch.filter(pa.array(_has(bitmap, batch.column(0).to_numpy().view(np.uint64))))

    return run


def _wanted(maps, asked, length: int, gram: int, way: str, batches: Iterator[pa.RecordBatch]):
    """(texts, k, k2, text, anchors, places, first and last windows) of the runs whose anchor has several classes and goes this way."""
    sent = maps.value
    for texts, k, k2, anchors in _texts(batches, asked):
        own, h, place, first, last = batched_runs(texts, length, gram)
        often = _has(sent["often"], h)
        crowded = often & _has(sent["crowded"], h)
        wanted = {"few": ~often, "often": often & ~crowded, "crowded": crowded}[way]
        if anchors is None:
            wanted &= _has(sent["rivals"], h)
        elif len(h):
            at = np.searchsorted(own, np.arange(len(texts) + 1))
            for t, some in enumerate(anchors):
                wanted[at[t] : at[t + 1]] &= np.isin(h[at[t] : at[t + 1]].view(np.int64), np.array(some, np.int64))
        if wanted.any():
            yield texts, k, k2, own[wanted], h[wanted], place[wanted], first[wanted], last[wanted]


def _class_scan(maps, asked, length: int, gram: int, way: str):
    """The classes of a task, each once, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], tuple[int, bytes]] = {}

        def told() -> pa.RecordBatch:
            rows = [(h, ext, *v) for (h, ext), v in known.items()]
            cols = list(zip(*rows, strict=True))
            known.clear()
            return pa.RecordBatch.from_arrays([_signed(cols[0]), _signed(cols[1]), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], names=["h", "ext", "before", "context"])

        for texts, _, _, own, h, place, first, last in _wanted(maps, asked, length, gram, way, batches):
            for t, hv, left, x, y in zip(own.tolist(), h.tolist(), (place - first).tolist(), first.tolist(), (last + length).tolist(), strict=True):
                context = texts[t][x:y]
                known.setdefault((hv, xxhash.xxh64_intdigest(context, left)), (left, context))
            if len(known) >= REMEMBERED:
                yield told()
        if known:
            yield told()

    return run


def _window_scan(maps, asked, length: int, gram: int):
    """Every window of crowded anchors, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, k, k2, own, _, _, first, last in _wanted(maps, asked, length, gram, "crowded", batches):
            opens = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (first[1:] != last[:-1] + 1))))
            for t, a, b in zip(own[opens].tolist(), first[opens].tolist(), last[np.append(opens[1:], len(last)) - 1].tolist(), strict=True):
                for x in range(a, b + 1, 1 << 18):  # neighbouring runs together
                    y = min(b + 1, x + (1 << 18))
                    data = np.frombuffer(texts[t][x : y - 1 + length], np.uint8)
                    (one,), (two,) = (rolling(data, length, kind=kind) for kind in (0, 1))
                    n = y - x
                    yield pa.RecordBatch.from_arrays([_signed(one), _signed(two), pa.array(np.full(n, k[t])), pa.array(np.full(n, k2[t])), pa.array(np.full(n, len(texts[t]), np.int32)), pa.array(np.arange(x, y, dtype=np.int32))], names=["w1", "w2", "k", "k2", "n", "first"])

    return run


FOUND = "h long, ext long, covered array<struct<start:int,stop:int>>"


def _resolve(length: int):
    """Classes sorted by anchor and bytes become the byte ranges, from a class's first, of the windows that other classes have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # from the first row of the anchor that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            goes_on = bool(held) and held[-1].column(0)[-1].as_py() == int(anchor[-1])
            if cut == 0 and (goes_on or not held):
                held.append(batch)
                continue
            if cut:
                held.append(batch.slice(0, cut))
            yield from solve(pa.Table.from_batches(held))
            held = [batch.slice(cut)]
        if held:
            yield from solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h, ext, before = (table.column(i).to_numpy() for i in range(3))
        opens = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (ext[1:] != ext[:-1]))))
        anchor_no = np.cumsum(np.concatenate(([0], h[opens][1:] != h[opens][:-1])))
        rivals = np.bincount(anchor_no)[anchor_no]
        sizes = pa.compute.binary_length(table.column(3)).to_numpy()[opens]
        covered: dict[int, list[tuple[int, int]]] = {}
        todo = np.flatnonzero(rivals > 1)
        upto = np.cumsum(sizes[todo] - length + 1)
        at = 0
        while at < len(todo):  # whole anchors, about BATCH_WINDOWS at a time
            end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_WINDOWS)), at + 1)
            while end < len(todo) and anchor_no[todo[end]] == anchor_no[todo[end - 1]]:
                end += 1
            part = todo[at:end]
            contexts = table.column(3).take(pa.array(opens[part])).to_pylist()
            for c, hit in zip(part.tolist(), repeated_windows(anchor_no[part], before[opens[part]], contexts, length), strict=True):
                if hit.any():
                    covered[c] = spans_of(hit, length)
            at = end
        if covered:
            rows = opens[list(covered)]
            lists = pa.array([[{"start": a, "stop": b} for a, b in v] for v in covered.values()], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(h[rows]), pa.array(ext[rows]), lists], names=["h", "ext", "covered"])

    return run


def _bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the low bits of h; the driver gets 2**bits bits at most, whatever the number of rows."""
    value = F.col("h").bitwiseAND(F.lit((1 << bits) - 1)) + 1  # bucket n holds the values from 32768 (n - 1) + 1 on
    made = rows.select(value.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in made:
        at = 4096 * (r.bucket - 1)
        out[at : at + 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def _bits(rows: int) -> int:
    """Bits of the values that a bitmap of so many rows goes by: some sixteen bits for each row."""
    return max(HOT_BITS, math.ceil(math.log2(16 * rows + 1)))


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT, gram: int = GRAM, most_anchors: int = MOST_ANCHORS, among: DataFrame | None = None) -> DataFrame:
    """(k, k2, n, start, stop) of repeated bytes, overlapping and unordered, for texts with columns text (binary), k, k2 and n.

    among: the keys (k, k2, n) of all texts that may have any, where that is known; each once.
    """
    spark = texts.sparkSession
    folder = f"{common.shared_folder(spark)}/tidemark-repeats-{uuid.uuid4().hex}"
    long, asked = texts.where(F.col("n") >= length).select(*TEXTS), None
    if among is not None:
        keys = among.count()
        if keys <= most_anchors:  # as with the first digit, a false positive costs a text's scan
            asked = spark.sparkContext.broadcast(_bitmap(among.select(F.col("k").alias("h")), _bits(keys)))
        else:
            long.join(among.select("k", "k2"), ["k", "k2"], "left_semi").select(*TEXTS).write.parquet(f"{folder}/among")
            long = spark.read.parquet(f"{folder}/among")
    common.arrow_map(long, _run_scan(asked, length, gram), RUNS).write.option("compression", "zstd").parquet(f"{folder}/runs")
    seen = spark.read.schema(RUNS).parquet(f"{folder}/runs")
    twice = seen.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("ext").alias("a"), F.max("ext").alias("b")).where("c > 1").select("h", "c", (F.col("a") != F.col("b")).alias("rivals"))
    twice = common.checkpointed(twice)
    known = twice.count()
    often = _bitmap(twice.where(F.col("rivals") & (F.col("c") > hot)), HOT_BITS)
    sent = {"often": often, "crowded": np.zeros_like(often)}
    if often.any():
        # An anchor has no more classes than occurrences, so a false positive of the bitmap is never crowded.
        maps = spark.sparkContext.broadcast(sent)
        classes_of = common.arrow_map(seen.select("h", "ext"), _marked(maps, "often"), "h long, ext long").distinct().groupBy("h").count()
        sent["crowded"] = _bitmap(classes_of.where(F.col("count") > hot).select("h"), HOT_BITS)
    places = seen
    if known <= most_anchors:
        bits = _bits(known)
        sent |= {"twice": _bitmap(twice, bits), "rivals": _bitmap(twice.where("rivals"), bits)}
        maps = spark.sparkContext.broadcast(sent)
        places = common.arrow_map(seen, _marked(maps, "twice"), RUNS)
    else:
        maps = spark.sparkContext.broadcast(sent)
        places = seen.join(twice.select("h"), "h").select(*seen.columns)
        own = seen.join(twice.where("rivals").select("h"), "h").groupBy("k", "k2").agg(F.collect_set("h").alias("own"))
        long.join(own, ["k", "k2"]).select(*TEXTS, "own").write.parquet(f"{folder}/texts")
        long = spark.read.parquet(f"{folder}/texts")
    classes = common.arrow_map(long, _class_scan(maps, asked, length, gram, "few"), CLASSES)
    if often.any():
        more = common.arrow_map(long, _class_scan(maps, asked, length, gram, "often"), CLASSES)
        classes = classes.unionByName(more.groupBy("h", "ext").agg(F.min("before").alias("before"), F.min("context").alias("context")))
    found = common.arrow_map(classes.repartition("h").sortWithinPartitions("h", "ext"), _resolve(length), FOUND)
    place = F.xxhash64("k", "k2", "n", "first")
    whole = places.groupBy("h", "ext").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("size").alias("size")).where("a <> b")
    found = found.unionByName(whole.select("h", "ext", F.expr("array(named_struct('start', 0, 'stop', size))").alias("covered")))
    each = places.join(found, ["h", "ext"]).select(*KEY, "first", F.explode("covered").alias("c"))
    spans = each.select(*KEY, (F.col("first") + F.col("c.start")).alias("start"), (F.col("first") + F.col("c.stop")).alias("stop"))
    if sent["crowded"].any():
        common.arrow_map(long, _window_scan(maps, asked, length, gram), WINDOWS).write.parquet(f"{folder}/windows")
        windows = spark.read.schema(WINDOWS).parquet(f"{folder}/windows")
        again = windows.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("w1", "w2")
        spans = spans.unionByName(windows.join(again, ["w1", "w2"]).select(*KEY, F.col("first").alias("start"), (F.col("first") + length).alias("stop")))
    copies = texts.where(F.col("n") >= length).groupBy(*KEY).count().where("count > 1").select(*KEY, F.lit(0).alias("start"), F.col("n").alias("stop"))
    return spans.unionByName(copies)


def with_spans(docs: DataFrame, columns: list[str], text_column: str = "text", lengths: Sequence[tuple[int, int]] = ((LENGTH, GRAM),), hot: int = HOT, most_anchors: int = MOST_ANCHORS) -> DataFrame:
    """The columns, the text as bytes, and `spans`: its repeated byte ranges by length of the windows, null if it has none."""
    raw = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    texts = docs.select(F.struct(*columns).alias("own"), raw.alias("text"))
    texts = texts.withColumns({"k": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), F.col("text")), "n": F.octet_length("text")})
    spark, found, among = docs.sparkSession, [], None
    folder = f"{common.shared_folder(spark)}/tidemark-spans-{uuid.uuid4().hex}"
    lengths = sorted(lengths)
    for (length, gram), longer in zip(lengths, [*lengths[1:], None], strict=True):
        part = repeated_spans(texts.select("text", *KEY), length, hot, gram, most_anchors, among)
        span = F.struct(F.lit(length).alias("length"), "start", "stop")
        part = part.groupBy(*KEY).agg(F.collect_set(span).alias("spans"), (F.max("stop") - F.min("start")).alias("extent"))
        if longer:
            part.write.parquet(f"{folder}/{length}")
            part = spark.read.parquet(f"{folder}/{length}")
            among = part.where(F.col("extent") >= longer[0])
        found.append(part.select(*KEY, "spans"))
    by_text = found[0]
    if found[1:]:
        by_text = reduce(DataFrame.unionByName, found).groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return texts.join(by_text.hint("shuffle_hash"), KEY, "left").select("own", "text", "spans")


def merged(spans, length: int = LENGTH) -> list[tuple[int, int]]:
    """The byte ranges that spans of this length of window cover, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or () if s["length"] == length):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for s in spans for x in s], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def passages(text: bytes, spans, words: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """The byte ranges covered by PASSAGE windows that have more words; a word cut at an end counts."""
    return [(a, b) for a, b in merged(spans, PASSAGE) if len(text[a:b].split()) > words]


def _characters(text: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges with the whole of the characters that they cut."""
    inside = lambda i: 0 < i < len(text) and text[i] & 0xC0 == 0x80
    out = []
    for a, b in gone:
        while inside(a):
            a -= 1
        while inside(b):
            b += 1
        out.append((a, b))
    return out


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, kept binary"


def without_repeats(docs: DataFrame, columns: list[str], text_column: str = "text", hot: int = HOT, with_text: bool = True, by: str = "bytes", most_anchors: int = MOST_ANCHORS) -> DataFrame:
    """`own` (the columns), the counts and digest of what is removed and, if asked for, the bytes kept.

    by: `bytes`, what LENGTH windows cover goes; `passages`, passages of over PASSAGE_WORDS words go, with the whole of
    the characters at their ends; `both`, as `bytes`, and the passages are counted.
    """
    lengths = [x for x, on in (((LENGTH, GRAM), by != "passages"), ((PASSAGE, PASSAGE_GRAM), by != "bytes")) if on]
    marked = with_spans(docs, columns, text_column, lengths, hot, most_anchors)
    out = marked.select("own").schema
    for field in docs.sparkSession.createDataFrame([], CUT).schema:
        out = out.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for full in batches:
            for a, b in common.chunks(full.column(1)):
                batch = full.slice(a, b - a)
                rows = []
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    found = passages(text, spans)
                    gone = merged(_spans(_characters(text, found))) if by == "passages" else merged(spans)
                    kept = cut(text, gone)
                    rows.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), len(found), kept if with_text else None))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names=["own", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "kept"])

    return common.arrow_map(marked, run, out)


def _spans(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"length": LENGTH, "start": a, "stop": b} for a, b in ranges]


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(common.table(spark, sf_dir, "documents"), ["doc_id"], with_text=False, by="both")
    return out.select("own.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages")


def _covered_sql(name: str, length: int) -> str:
    """Tables that end in `name`_span: the runs (a, b) of bytes that repeated windows cover, of each text r."""
    return f"""{name}_s AS (SELECT r, t, unnest(range(0, octet_length(t) - {length} + 1)) AS i FROM d WHERE octet_length(t) >= {length}),
{name}_w AS (SELECT r, i, md5_number(t[i + 1:i + {length}]) AS w FROM {name}_s),
{name}_many AS (SELECT w FROM {name}_w GROUP BY w HAVING count(*) > 1),
{name}_hit AS (SELECT r, i FROM {name}_w WHERE w IN (SELECT w FROM {name}_many)),
{name}_edge AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {length} THEN 0 ELSE 1 END AS opens FROM {name}_hit),
{name}_run AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS g FROM {name}_edge),
{name}_span AS (SELECT r, min(i) AS a, max(i) + {length} AS b FROM {name}_run GROUP BY r, g)"""


#: A byte in hex and a space, unless it is white space.
_LETTER = "(?:0[0-8EF]|1[0-9A-F]|2[1-9A-F]|[3-9A-F][0-9A-F]) "

#: All windows one by one: for small inputs.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
{_covered_sql("l", LENGTH)},
{_covered_sql("p", PASSAGE)},
nxt AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM l_span),
kept AS (SELECT r, sum(b - a) AS gone, count(*) AS n, max(b) AS e, string_agg(CASE WHEN a > before THEN hex(t[before + 1:a]) ELSE '' END, '' ORDER BY a) AS head FROM nxt JOIN d USING (r) GROUP BY r),
passage AS (SELECT r, count(*) AS n FROM p_span JOIN d USING (r) WHERE len(regexp_extract_all(regexp_replace(hex(t[a + 1:b]), '(..)', '\\1 ', 'g'), '(?:{_LETTER})+')) > {PASSAGE_WORDS} GROUP BY r)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(kept.n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || CASE WHEN octet_length(t) > coalesce(e, 0) THEN hex(t[coalesce(e, 0) + 1:octet_length(t)]) ELSE '' END)) AS kept_sha256,
  coalesce(passage.n, 0)::BIGINT AS n_passages
FROM d LEFT JOIN kept USING (r) LEFT JOIN passage USING (r)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over PASSAGE_WORDS words that repeat go from the texts, wherever they stand. n_chars follows.

    A passage is found if it has PASSAGE bytes, as all but a few of so many words have.
    """
    held = docs.withColumn("tidemark_null", F.col("text").isNull())
    out = without_repeats(held, [c for c in held.columns if c != "text"], by="passages")
    text = F.when(~F.col("own.tidemark_null"), F.col("kept").cast("string"))
    out = out.select("own.*", text.alias("text"), (F.col("n_removed") > 0).alias("tidemark_cut"))
    columns = [F.when(F.col("tidemark_cut"), F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*columns)
