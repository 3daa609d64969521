"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64 bits over shingles of words. The anchors are the words of a covering code: the product of two
binary Golay codes (23 bits, covering radius 3) and a Hamming code (15 bits, radius 1), so every fingerprint has one
home anchor within the radius. Two fingerprints that differ in `threshold` bits have a point between them that is
within half of that from each; both are replicated to every anchor whose cell comes so near (these anchors lie within
the radius plus the threshold), and so meet at the home of that point. About 16 anchors a fingerprint at threshold 2.

Equal fingerprints are one node before that. At an anchor the fingerprints are compared, and only a spanning forest of
the links found is passed on; anchors with very many fingerprints are first dealt by the equal part that two of them
must share (the pigeonhole principle), which is exact as well. Components are closed by alternating large and small
stars over the links, each round written to the checkpoint folder; nothing is collected.

Defined results: null, empty and wordless texts have fingerprint zero, linked like any other; repeated rows are in one
component; a row without id belongs to its fingerprint's component, or to none if no row of it has an id. Other columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

SHINGLE = 3
THRESHOLD = 2
SEED = 42
#: Fingerprints at one anchor beyond which they are dealt by equal parts before they are compared.
CROWD = 4096
#: The stage's near copies: words of a shingle, the least similarity, and the MinHash bands that find candidates
#: (a pair of similarity 0.8 shares a band with a probability of 0.9995).
NEAR_SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
BAND_ROWS = 6
#: Documents of a cluster of candidates that one task compares with each other, and that one task compares with those.
HEADS = 512
PART = 4096


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    parts = [joined[a:b] for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


class Perfect:
    """A perfect binary code given by its generator polynomial: the nearest word of every vector."""

    def __init__(self, length: int, generator: int, radius: int):
        self.length, self.degree = length, generator.bit_length() - 1
        self.rest = np.array([self._remainder(1 << i, generator) for i in range(length)], np.uint64)
        leaders = np.zeros(1 << self.degree, np.uint64)
        errors = [(0, 0)]  # (vector, bits used from)
        for _ in range(radius):
            errors = [(e | 1 << i, i + 1) for e, first in errors for i in range(first, length)]
            for e, _ in errors:
                leaders[self._remainder(e, generator)] = e
        self.leaders = leaders

    def _remainder(self, v: int, g: int) -> int:
        while v.bit_length() > self.degree:
            v ^= g << (v.bit_length() - 1 - self.degree)
        return v

    def nearest(self, v: np.ndarray) -> np.ndarray:
        s = np.zeros(v.shape, np.uint64)
        for i in range(self.length):
            s ^= ((v >> np.uint64(i)) & np.uint64(1)) * self.rest[i]
        return v ^ self.leaders[s.astype(np.int64)]


#: Blocks of bits from the lowest: length, generator polynomial, covering radius. They cover 61 of the 64 bits.
BLOCKS = ((23, 0b101011100011, 3), (23, 0b101011100011, 3), (15, 0b10011, 1))


class Anchors:
    def __init__(self, threshold: int = THRESHOLD):
        self.codes = [Perfect(*b) for b in BLOCKS]
        self.reach = (threshold + 1) // 2

    def _home(self, v: np.ndarray) -> np.ndarray:
        out, low = np.zeros(v.shape, np.uint64), 0
        for code in self.codes:
            part = (v >> np.uint64(low)) & np.uint64((1 << code.length) - 1)
            out |= code.nearest(part) << np.uint64(low)
            low += code.length
        return out

    def of(self, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor), each pair once: the homes of all points within reach."""
        covered = sum(c.length for c in self.codes)
        steps = [np.uint64(0)]
        patterns = [0]
        for _ in range(self.reach):
            patterns = sorted({p | 1 << i for p in patterns for i in range(covered)} - set(patterns))
            steps += [np.uint64(p) for p in patterns]
        steps = np.array(steps, np.uint64)
        who, where = [], []
        for at in range(0, len(fingerprints), 8192):
            near = self._home(fingerprints[at : at + 8192, None] ^ steps[None, :])
            near.sort(axis=1)
            first = np.ones(near.shape, bool)
            first[:, 1:] = near[:, 1:] != near[:, :-1]
            rows, _ = np.nonzero(first)
            who.append(rows + at)
            where.append(near[first])
        return np.concatenate(who or [np.zeros(0, np.int64)]), np.concatenate(where or [np.zeros(0, np.uint64)])


def forest(fp: np.ndarray, node: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links (pairs of nodes) that connect what any links among these fingerprints connect."""
    if len(fp) > CROWD:
        out = []
        parts = threshold + 1
        for k in range(parts):
            low, high = 64 * k // parts, 64 * (k + 1) // parts
            key = (fp >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            order = np.argsort(key, kind="stable")
            edges = np.flatnonzero(np.diff(key[order])) + 1
            for group in np.split(order, edges):
                if len(group) > 1:
                    out += _forest(fp[group], node[group], threshold)
        return out
    return _forest(fp, node, threshold)


def _forest(fp: np.ndarray, node: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    out = []
    left = np.arange(len(fp))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[here]) <= threshold
            found = left[near]
            if len(found):
                left = left[~near]
                out += [(int(node[here]), int(node[f])) for f in found]
                queue += found.tolist()
    return out


def fingerprints(docs: DataFrame, columns: list[str], text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The given columns and `fp`, the fingerprint as a signed long."""

    def make():
        return lambda texts: {"fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64).tolist()}

    return common.map_texts(docs, columns, text_column, "fp long", make)


def links(nodes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b), a < b, between the nodes (fp, node) whose fingerprints differ in few bits; a spanning set of them."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(threshold)
        for batch in batches:
            for start in range(0, batch.num_rows, 65536):
                part = batch.slice(start, 65536)
                fp, node = part.column(0).to_numpy(), part.column(1).to_numpy()
                who, where = anchors.of(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(where.view(np.int64)), pa.array(fp[who]), pa.array(node[who])], names=["anchor", "fp", "node"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; the last group of a batch may go on in the next."""
        kept: list[list[np.ndarray]] = []
        for batch in batches:
            anchor, fp, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if kept and kept[0][0][0] == anchor[-1]:  # one group goes on through the whole batch
                kept.append([anchor, fp, node])
                continue
            head = [np.concatenate(x) for x in zip(*kept, [anchor[:cut], fp[:cut], node[:cut]], strict=True)] if kept else [anchor[:cut], fp[:cut], node[:cut]]
            yield from found(*head)
            kept = [[anchor[cut:], fp[cut:], node[cut:]]]
        if kept:
            yield from found(*[np.concatenate(x) for x in zip(*kept, strict=True)])

    def found(anchor, fp, node) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.diff(anchor, prepend=anchor[0] - 1 if len(anchor) else 0))
        sizes = np.diff(starts, append=len(anchor))
        out: set[tuple[int, int]] = set()
        bits = fp.view(np.uint64)
        two = starts[sizes == 2]
        near = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= threshold]
        pairs = [(int(x), int(y)) for x, y in zip(node[near], node[near + 1], strict=True)]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            pairs += forest(bits[s : s + n], node[s : s + n], threshold)
        out.update((min(p), max(p)) for p in pairs)
        if out:
            a, b = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    spread = common.arrow_map(nodes, replicate, "anchor long, fp long, node long")
    met = spread.repartition("anchor").sortWithinPartitions("anchor", "fp")
    return common.arrow_map(met, compare, "a long, b long").where("a < b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link; by alternating stars."""
    edges = common.checkpointed(pairs.select("a", "b"))  # a < b
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        down = large.join(least, "b")
        small = down.select(F.col("m").alias("a"), F.col("b")).unionByName(down.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a < b").distinct()
        edges = common.checkpointed(small)
        del both, least, large, down, small
        common.tidied(edges.sparkSession)
        now = tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)), F.count_distinct("b")).first())
        if now == before or now[0] == 0:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
        before = now


def near_duplicate_groups(fingerprinted: DataFrame, id_column: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """(fp, node, component) of every distinct fingerprint: its smallest id, and the smallest id reachable."""
    nodes = fingerprinted.groupBy("fp").agg(F.min(F.col(id_column).cast("long")).alias("node"))
    nodes = common.checkpointed(nodes)
    joined = components(links(nodes.where("node IS NOT NULL"), threshold))
    return nodes.join(joined, "node", "left").select("fp", "node", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """Every document with `fp` and `component`."""
    prints = common.checkpointed(fingerprints(docs, [id_column], text_column, shingle))
    return prints.join(near_duplicate_groups(prints, id_column, threshold), "fp").select(id_column, "fp", "component")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def shingles(text: bytes | None, size: int = NEAR_SHINGLE) -> np.ndarray:
    """The distinct hashes of the runs of `size` words, sorted; of all words where they are fewer, none without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bands(found: np.ndarray) -> np.ndarray:
    """One key a band of the MinHash signature of a set of hashes."""
    if not len(found):
        return np.zeros(0, np.int64)
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        np.minimum(least, (factors[:, None] * found[None, at : at + 512]).min(1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        key = (key ^ column) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def near_of_kept(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[int]:
    """Places of the sets, in order, that are at least so similar (Jaccard) to one that stays before them."""
    gone = []
    left = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    while len(left) > 1:
        own, left = sets[left[0]], left[1:]
        sizes = np.array([len(sets[i]) for i in left])
        able = np.minimum(sizes, len(own)) >= similarity * np.maximum(sizes, len(own))
        near = np.zeros(len(left), bool)
        if able.any():
            some = sizes[able]
            values = np.concatenate([sets[i] for i in left[able]])
            hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(some) - some)
            near[able] = both >= similarity * (some + len(own) - both) - 1e-9
        gone += left[near].tolist()
        left = left[~near]
    return gone


class Leaders:
    """Sets of hashes, asked which sets are as similar as that to any of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def near(self, own: np.ndarray, similarity: float = SIMILARITY) -> bool:
        if not len(own):
            return False
        low, high = (np.searchsorted(self.values, own, side) for side in ("left", "right"))
        many = high - low
        at = np.arange(many.sum()) + np.repeat(low - (np.cumsum(many) - many), many)
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        return bool((both >= similarity * (self.sizes + len(own) - both) - 1e-9).any())


def near_copies(docs: DataFrame, folder: str) -> DataFrame:
    """(fp) of the documents, given by distinct fp, with id and text, that are near copies of one that stays.

    Documents that share a band are candidates; clusters of candidates are compared exactly, in order of id. A cluster
    of up to HEADS documents is compared in one task. Of a larger one the first HEADS are, and those that stay go
    against the rest, in as many parts as the rest needs; then the next HEADS of what is left, and so on.
    """

    def make():
        return lambda texts: {"bands": [bands(shingles(t)) for t in texts]}

    rows = common.map_texts(docs, ["fp"], "text", "bands array<long>", make).select("fp", F.explode("bands").alias("band"))

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            band, fp = (np.concatenate((x[-1:], batch.column(k).to_numpy())) for x, k in ((band, 0), (fp, 1)))
            same = band[1:] == band[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(fp[:-1][same]), pa.array(fp[1:][same])], names=["a", "b"])

    met = rows.select("band", "fp").repartition("band").sortWithinPartitions("band", "fp")
    clusters = components(common.arrow_map(met, chained, "a long, b long").where("a < b").distinct())
    clusters = clusters.unionByName(clusters.select(F.col("component").alias("node"), "component").distinct())  # the smallest isn't listed itself
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    clusters = clusters.join(sizes, "component").select(F.col("node").alias("fp"), "component", "size")
    docs.select("fp", "id", F.col("text").cast("binary").alias("text")).join(clusters, "fp").write.parquet(f"{folder}/candidates")
    told = docs.sparkSession.read.parquet(f"{folder}/candidates")

    small = _first_come(told.where(F.col("size") <= HEADS)).where("NOT stays").select("fp")
    gone = [common.checkpointed(small)]
    left = common.checkpointed(told.where(F.col("size") > HEADS).select("component", "id", "fp"))
    first = F.row_number().over(Window.partitionBy("component").orderBy(F.col("id").asc_nulls_last(), "fp"))
    while not left.isEmpty():
        heads = common.checkpointed(left.withColumn("nth", first).where(F.col("nth") <= HEADS).drop("nth"))
        judged = common.checkpointed(_first_come(told.join(heads.select("fp"), "fp", "left_semi")))
        gone.append(judged.where("NOT stays").select("fp"))
        rest = common.checkpointed(left.join(heads.select("fp"), "fp", "left_anti"))
        parts = rest.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
        similar = common.checkpointed(_near_of_leaders(told, rest, judged.where("stays").select("fp"), parts))
        gone.append(similar)
        left = common.checkpointed(rest.join(similar, "fp", "left_anti"))
        common.tidied(docs.sparkSession)
    out = gone[0]
    for part in gone[1:]:
        out = out.unionByName(part)
    return out


def _first_come(told: DataFrame) -> DataFrame:
    """(fp, stays) of every document; it stays unless it is a near copy of one of its cluster that stays before it."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fps, sets = None, [], []

        def closed() -> pa.RecordBatch:
            gone = set(near_of_kept(sets))
            return pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array([i not in gone for i in range(len(fps))], pa.bool_())], names=["fp", "stays"])

        for batch in batches:
            for cluster, fp, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if cluster != now:
                    yield closed()
                    now, fps, sets = cluster, [], []
                fps.append(fp)
                sets.append(shingles(text))
        yield closed()

    rows = told.repartition("component").sortWithinPartitions("component", F.col("id").asc_nulls_last(), "fp")
    return common.arrow_map(rows.select("component", "fp", "text"), compared, "fp long, stays boolean")


def _near_of_leaders(told: DataFrame, rest: DataFrame, leaders: DataFrame, parts: DataFrame) -> DataFrame:
    """(fp) of the rest that are near copies of a leader of their cluster; every part of a cluster gets its leaders."""
    text = told.select("fp", "component", "text").join(parts, "component")
    asked = text.join(rest.select("fp"), "fp", "left_semi").select("component", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("asked"), "fp", "text")
    told_to = text.join(leaders, "fp", "left_semi").select("component", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("asked"), "fp", "text")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, leaders = None, [], None
        for batch in batches:
            near = []
            for component, part, asked, fp, text in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (component, part) != now:
                    now, sets, leaders = (component, part), [], None
                if not asked:
                    sets.append(shingles(text))
                    continue
                if leaders is None:
                    leaders = Leaders(sets)
                if leaders.near(shingles(text)):
                    near.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64())], names=["fp"])

    both = asked.unionByName(told_to).repartition("component", "part").sortWithinPartitions("component", "part", "asked")
    return common.arrow_map(both, compared, "fp long")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; of repeated rows one. Then near copies go.

    A near copy has a similarity (Jaccard, runs of NEAR_SHINGLE words) of SIMILARITY or more to a document that stays.
    """
    folder = f"{common.shared_folder(spark)}/tidemark-near-{uuid.uuid4().hex}"
    # A row is known by two hashes of its id and text; of repeated rows any one stays.
    row = [F.xxhash64("id", "text"), F.xxhash64(F.lit(1), "id", "text")]
    held = docs.select(F.struct(*docs.columns).alias("own"), F.col("doc_id").cast("long").alias("id"), "text").withColumns({"r1": row[0], "r2": row[1]})
    fingerprints(held, ["id", "r1", "r2"]).write.parquet(f"{folder}/prints")
    prints = spark.read.parquet(f"{folder}/prints")
    groups = near_duplicate_groups(prints.select(F.col("id").alias("doc_id"), "fp"))
    winners = groups.where("node <=> component").select(F.col("fp").alias("w_fp"), F.col("node").alias("w_id"))
    won = prints.join(winners, (F.col("fp") == F.col("w_fp")) & F.col("id").eqNullSafe(F.col("w_id")))
    chosen = won.groupBy("fp", "id").agg(F.min(F.struct("r1", "r2")).alias("r")).select("fp", "r.*")
    kept = held.join(chosen, ["r1", "r2"]).withColumn("nth", F.row_number().over(Window.partitionBy("r1", "r2").orderBy("fp")))
    kept.where("nth = 1").select("own", "id", "fp").write.parquet(f"{folder}/kept")
    del prints, groups, winners, won, chosen, kept
    common.removed(spark, f"{folder}/prints")
    common.tidied(spark)
    kept = spark.read.parquet(f"{folder}/kept")
    gone = common.checkpointed(near_copies(kept.select("fp", "id", "own.text"), folder))
    common.removed(spark, f"{folder}/candidates")
    common.tidied(spark)
    return kept.join(gone, "fp", "left_anti").select("own.*")
