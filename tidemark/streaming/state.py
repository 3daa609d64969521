"""State of incremental work: watermarks, backfills, backpressure. A state is a small JSON document in a folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import capture
from tidemark.sources import registry as reg
from tidemark.sources.tables import Tables, scan


#: Versions of a document that are kept.
VERSIONS = 5


class Refused(Exception):
    """A sink will never take these rows: they are counted and passed over."""


class Document:
    """A JSON document that is replaced as a whole; versions are written beside each other and the newest that reads well counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return None
        return self.spark.read.schema("version long, body string").option("recursiveFileLookup", "true").json(self.folder)

    def read(self) -> dict:
        """The newest document; one that is corrupt is passed over, and none is an empty one."""
        known = self._versions()
        for row in known.where("version IS NOT NULL").orderBy(F.desc("version")).limit(5).collect() if known is not None else []:
            try:
                return json.loads(row.body)
            except (TypeError, ValueError):
                continue
        return {}

    def write(self, body: Mapping) -> None:
        known = self._versions()
        last = known.agg(F.max("version")).first()[0] if known is not None else None
        version = (last or 0) + 1
        self.spark.createDataFrame([(version, json.dumps(body, sort_keys=True))], "version long, body string").coalesce(1).write.mode("append").json(f"{self.folder}/v-{version:012d}-{uuid.uuid4().hex}")
        self._prune()

    def _prune(self) -> None:
        """Versions older than the newest VERSIONS go."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = sorted((s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("v-")), key=lambda p: p.getName())
        for p in old[:-VERSIONS]:
            files.delete(p, True)


@dataclass
class Outcome:
    """What a run did: marks that moved, entities held back and left out."""

    moved: dict[str, int] = field(default_factory=dict)
    held: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


Sink = Callable[[DataFrame, reg.Entity], bool]


def incremental(tables: Tables, registry: Mapping[str, reg.Entity], state: Document, sink: Sink) -> Outcome:
    """One change-capture run: each entity's rows between its mark and the mark read before the scan.

    The mark moves only if the sink took everything; the state is written once, after all sinks, and only if it changed.
    """
    out, before = Outcome(), state.read()
    marks = dict(before.get("wm", {}))
    for name, e in registry.items():
        found = None if e.derived or tables.live(e.table) is None else reg.resolved(e, tables.live)
        if found is None or found.watermark is None:
            out.skipped.append(name)
            continue
        since = marks.get(name)
        rows = tables.read(e.table)
        upto = capture.high_water(rows, found.watermark)
        if upto is None or (since is not None and upto <= since):
            continue
        within = F.col(found.watermark) <= F.lit(upto)
        part = scan(tables, e, within if since is None else within & (F.col(found.watermark) > F.lit(since)))
        if part is not None and sink(part, e):
            out.moved[name] = marks[name] = upto
        else:
            out.held.append(name)
    if marks != before.get("wm", {}):
        state.write({**before, "wm": marks})
    return out


def refetch(tables: Tables, registry: Mapping[str, reg.Entity], names: list[str], first: int, last: int, sink: Sink) -> tuple[list[str], list[str]]:
    """Rows of the named entities with a mark in [first, last]; (fetched, unknown). Keeps no state."""
    known, unknown = capture.requested(names, set(registry), first, last)
    for name in known:
        e = registry[name]
        found = None if e.derived or tables.live(e.table) is None else reg.resolved(e, tables.live)
        mark = found.watermark if found else None
        part = scan(tables, e, F.col(mark).between(first, last) if mark else None)
        if part is not None:
            sink(part, e)
    return known, unknown


class Backfill:
    """A campaign over all rows by key, in chunks, that goes on where it stopped."""

    def __init__(self, tables: Tables, registry: Mapping[str, reg.Entity], state: Document, chunk: int = 5000):
        self.tables, self.registry, self.state, self.chunk = tables, registry, state, chunk

    def run(self, sink: Sink, finish: Callable[[str], None], only: list[str] | None = None, room: Callable[[], bool] = lambda: True) -> dict:
        """Goes through entities that aren't done; `finish` (catalog and census) runs once, when all are, in a whole run.

        A sink that refuses, or a buffer without room, stops the entity where it is: stopped isn't the same as finished.
        Rows that it refuses for good (Refused) are counted under "refused" and passed over.
        """
        s = self.state.read()
        s.setdefault("batch", str(uuid.uuid4()))
        names = [n for n in self.registry if only is None or n in only]
        for name in names:
            if s.get("done", {}).get(name) or s.get("complete"):
                continue
            if not self._entity(name, s, sink, room):
                return s
        everything = only is None and all(s.get("done", {}).get(n) for n in self.registry)
        if everything and not s.get("complete"):
            finish(s["batch"])
            s["complete"] = 1
        self.state.write(s)
        return s

    def _entity(self, name: str, s: dict, sink: Sink, room: Callable[[], bool]) -> bool:
        e = self.registry[name]
        marks = s.setdefault("wm", {})
        while not e.derived:
            rows = scan(self.tables, e, F.col("id") > F.lit(marks.get(name, -1)))
            if rows is None:
                break
            page = rows.orderBy("id").limit(self.chunk).persist()  # read once for the mark and the sink
            try:
                last, n = page.agg(F.max("id"), F.count(F.lit(1))).first()
                if last is None:
                    break
                try:
                    taken = room() and sink(page, e)
                except Refused:
                    refused = s.setdefault("refused", {})
                    refused[name] = refused.get(name, 0) + n
                    taken = True
                if not taken:
                    self.state.write(s)
                    return False
            finally:
                page.unpersist()
            marks[name] = last
            self.state.write(s)
        s.setdefault("done", {})[name] = 1
        self.state.write(s)
        return True


def has_room(backlog_bytes: int, cap_bytes: int, drain: Callable[[], int]) -> bool:
    """Whether the backlog is within half the cap, after one attempt at draining it."""
    return backlog_bytes <= cap_bytes / 2 or drain() <= cap_bytes / 2
