"""Marks that are held, campaigns that go on, replays, and the shipping stream."""

import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions.identity import hmac_sha256
from tidemark.sources import files
from tidemark.sources import registry as reg
from tidemark.sources.tables import Tables
from tidemark.streaming import control, ship, state


def tables(spark, n=10):
    rows = [(i, 100 + i) for i in range(n)]
    return Tables(spark, frames={"a": spark.createDataFrame(rows, "id long, timemodified long"), "b": spark.createDataFrame([(1,)], "id long")})


REG = {"a": reg.Entity("a", "a"), "b": reg.Entity("b", "b"), "gone": reg.Entity("gone", "gone")}


def test_marks_move_only_after_the_sink(spark, tmp_path):
    doc, got = state.Document(spark, f"file://{tmp_path}/s"), []
    refuse = state.incremental(tables(spark), REG, doc, lambda df, e: False)
    assert refuse.held == ["a"] and refuse.skipped == ["b", "gone"] and doc.read() == {}
    done = state.incremental(tables(spark), REG, doc, lambda df, e: bool(got.append(df.count()) or True))
    assert done.moved == {"a": 109} and got == [10] and doc.read() == {"wm": {"a": 109}}
    again = state.incremental(tables(spark), REG, doc, lambda df, e: bool(got.append(df.count()) or True))
    assert again.moved == {} and got == [10]
    state.incremental(tables(spark, 13), REG, doc, lambda df, e: bool(got.append(df.count()) or True))
    assert got == [10, 3]


def test_a_corrupt_document_is_passed_over(spark, tmp_path):
    doc = state.Document(spark, f"file://{tmp_path}/s")
    doc.write({"wm": {"a": 1}})
    spark.createDataFrame([(9, "{broken")], "version long, body string").write.mode("append").json(f"file://{tmp_path}/s/v-x")
    assert doc.read() == {"wm": {"a": 1}}
    doc.write({"wm": {"a": 2}})
    assert doc.read() == {"wm": {"a": 2}}


def test_backfill_goes_on_where_it_stopped(spark, tmp_path):
    doc, got, ends = state.Document(spark, f"file://{tmp_path}/b"), [], []
    registry = {"a": REG["a"], "b": REG["b"]}
    take = lambda df, e: bool(got.extend((e.name, r.id) for r in df.collect()) or True)
    calls = iter([True, False])
    first = state.Backfill(tables(spark), registry, doc, 4).run(take, ends.append, room=lambda: next(calls, False))
    assert "complete" not in first and got == [("a", i) for i in range(4)]
    second = state.Backfill(tables(spark), registry, doc, 4).run(take, ends.append)
    assert second["complete"] == 1 and second["batch"] == first["batch"] and ends == [first["batch"]]
    assert got == [("a", i) for i in range(10)] + [("b", 1)]
    state.Backfill(tables(spark), registry, doc, 4).run(take, ends.append)
    assert len(got) == 11 and len(ends) == 1
    partial = state.Backfill(tables(spark), registry, state.Document(spark, f"file://{tmp_path}/p"), 100).run(take, ends.append, only=["b"])
    assert partial["done"] == {"b": 1} and "complete" not in partial


def test_refused_for_good(spark, tmp_path):
    df = spark.range(10).toDF("id")
    registry = {"a": reg.Entity("a", "a")}
    doc, taken, ends = state.Document(spark, f"file://{tmp_path}/s"), [], []

    def take(rows, _):
        ids = [r.id for r in rows.collect()]
        if 4 in ids:
            raise state.Refused
        taken.extend(ids)
        return True

    out = state.Backfill(Tables(spark, frames={"a": df}), registry, doc, 3).run(take, ends.append)
    assert sorted(taken) == [0, 1, 2, 6, 7, 8, 9] and out["refused"] == {"a": 3} and out["complete"] == 1 and len(ends) == 1
    assert len([p for p in (tmp_path / "s").iterdir() if p.name.startswith("v-")]) <= state.VERSIONS and doc.read()["refused"] == {"a": 3}


def test_late_rows_and_nobody_on_a_stream(spark, tmp_path):
    """A row of an earlier window, late but within the watermark, counts there; ids of 0 or less always pass."""
    first = [(1, 70), (1, 71), (1, 72), (0, 70), (0, 70), (0, 70), (None, 70)]
    second = [(1, 50), (1, 51), (1, 52), (1, 73)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, "user long, s long").select("user", F.timestamp_seconds("s").alias("at")).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in/{i}")
    stream = spark.readStream.schema("user long, at timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")
    name = f"t{uuid.uuid4().hex}"
    q = ship.limited(stream, "user", "at", 2).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.user or 0, r.s) for r in spark.table(name).select("user", F.unix_seconds("at").alias("s")).collect())
    assert got == [(0, 70)] * 4 + [(1, 50), (1, 51), (1, 70), (1, 71)]


def test_room():
    assert state.has_room(5, 10, lambda: 99) and state.has_room(9, 10, lambda: 4) and not state.has_room(9, 10, lambda: 6)


def send(c, **body):
    raw = json.dumps({"timestamp": 1000, "site_id": "s", "command_id": "c1", "action": "go", **body}).encode()
    return c.handle(raw, hmac_sha256(b"k", raw))


def test_control_chain():
    now = [1000.0]
    c = control.Control("s", "k", {"go": lambda p: (200, {"status": "ok"}), "bad": lambda p: (500, {"status": "error"})}, now=lambda: now[0])
    assert control.Control("s", "", {}).handle(b"x", "")[0] == 503
    assert c.handle(b"{}", "wrong")[0] == 403
    assert c.handle(b"", "")[0] == 400
    assert c.handle(b"[1]", hmac_sha256(b"k", b"[1]"))[0] == 400
    assert send(c, timestamp=600)[0] == 408
    assert send(c, site_id="t")[0] == 409
    assert send(c, command_id="")[0] == 400
    assert send(c, action="none")[0] == 400
    assert send(c, action="bad", command_id="c2")[0] == 500
    assert send(c, action="bad", command_id="c2")[0] == 500  # may be tried again
    assert send(c)[1] == {"status": "ok", "command_id": "c1"}
    assert send(c)[1]["detail"] == "already_applied"


def buffer(folder, name, lines, closed=True):
    (folder / f"{name}.jsonl{'.closed' if closed else ''}").write_text("".join(x + "\n" for x in lines))


def test_stream_ships_once(spark, tmp_path):
    src = tmp_path / "buffer"
    src.mkdir()
    us = 1785801600000000
    buffer(src, f"events-1-{us}-a-h1", [json.dumps({"site_id": "me", "n": i, "t": "a\u0085b"}, ensure_ascii=False) for i in range(3)] + [json.dumps({"site_id": "other"})])
    buffer(src, f"events-2-{us}-b-h1", ["not json"])
    buffer(src, f"events-3-{us}-c-h1", ["{}"], closed=False)
    args = (spark, f"file://{src}", f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "me")
    for _ in range(2):  # the second run has nothing left to do
        ship.ship(*args).awaitTermination()
        out = [p for p in (tmp_path / "out").rglob("*.gz") if p.is_file()]
        lines = [x for p in out for x in gzip.open(p, "rt", encoding="utf-8", newline="\n").read().split("\n") if x]
        assert len(out) == 1 and str(out[0].relative_to(tmp_path / "out")).startswith(f"events/me/2026/08/04/batch-{us}-2-") and not list((tmp_path / "out").glob("_staging*"))
        assert sorted(lines) == sorted([json.dumps({"site_id": "me", "n": i, "t": "a\u0085b"}, ensure_ascii=False) for i in range(3)] + ["not json"])
    assert ship.ship(spark, "x", "y", "z", "") is None and ship.ship(*args, gates=lambda: False) is None


def test_replays_and_limits_on_a_stream(spark, tmp_path):
    rows = [(f"m{i % 4}", "u", 60 * (i // 5) + i) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, user string, s long").select("id", "user", F.timestamp_seconds("s").alias("at"))
    df.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    read = lambda: spark.readStream.schema(df.schema).parquet(f"file://{tmp_path}/in")
    for made, want in ((ship.once_each(read(), "id", "at"), 4), (ship.limited(read(), "user", "at", 2), 4)):
        name = f"t{uuid.uuid4().hex}"
        q = made.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() == want


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n  \nbad\n')
    (tmp_path / "b.jsonl").write_text("y\n")
    os.link(tmp_path / "b.jsonl", tmp_path / "b2.jsonl")
    os.symlink(tmp_path / "a.jsonl", tmp_path / "c.jsonl")
    (tmp_path / "r.tmp").write_text("")
    assert files.safe_files([str(tmp_path), str(tmp_path), "/nowhere"], ["*.jsonl"]) == [str(tmp_path / "a.jsonl")]
    assert "c.jsonl" in files.unsafe_files(str(tmp_path)) and "b2.jsonl" in files.unsafe_files(str(tmp_path))
    rows = files.read_lines(spark, f"file://{tmp_path}/a.jsonl").withColumn("v", files.parsed(F.col("line")).isNotNull()).orderBy("line_no").collect()
    assert [(r.line_no, r.line, r.v) for r in rows] == [(0, '{"x":1}', True), (3, "bad", False)]
    assert files.purge_residue(str(tmp_path), now=os.lstat(tmp_path / "r.tmp").st_mtime + 901) == 1
    assert files.validated_folder(str(tmp_path / "x"), str(tmp_path)) == str(tmp_path / "x")
    for bad in ("x", str(tmp_path), "/etc", str(tmp_path / ".." / "y")):
        with pytest.raises(ValueError):
            files.validated_folder(bad, str(tmp_path))
