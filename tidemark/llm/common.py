"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker holds decoded at a time.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context: they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    into = Path(tempfile.mkdtemp(prefix="tidemark-code-"))
    file = into / f"tidemark-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(file))
    context._tidemark_shipped = True


#: Bytes of an Arrow batch between the JVM and Python, unless the session names its own: texts are long rows.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def arrow_map(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow in batches of bounded size; a task that ends gives its memory back, as its worker goes on to others."""
    spark = df.sparkSession
    shipped(spark)
    own = spark._jsparkSession.sessionState().conf()
    for key, value in BATCH.items():
        if not own.contains(key):
            spark.conf.set(key, value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Gives freed memory back to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, or that the context has; one of our own only on a local master, as in tests."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def tidied(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of rounds whose lineage has been cut: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed(spark: SparkSession, folder: str) -> None:
    """Takes a folder of intermediate results away."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def map_texts(df: DataFrame, columns: list[str], text: str, schema: str, make: Callable[[], Callable[[list[bytes | None]], dict[str, list[Any]]]], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A column of texts, as bytes, through a Python function in chunks of bounded size, one row out for each row in.

    make() runs once in each task and returns the function; the result has `columns`, then those of `schema`,
    which names what the function returns.
    """
    inputs = df.select(*[F.col(c) for c in columns], F.col(text).cast("binary").alias("__bytes"))
    made = df.sparkSession.createDataFrame([], schema).schema
    out = inputs.drop("__bytes").schema
    for field in made.fields:
        out = out.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, work = to_arrow_schema(out), make()
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            for start, stop in chunks(raw, chunk_bytes):
                part = batch.slice(start, stop - start)
                got = work(part.column(part.num_columns - 1).to_pylist())
                arrays = [part.column(i).cast(arrow.field(i).type) for i in range(part.num_columns - 1)]
                arrays += [pa.array(got[f.name], type=arrow.field(f.name).type) for f in made.fields]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return arrow_map(inputs, run, out)


def chunks(raw: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or of one row."""
    import pyarrow.compute as pc

    start = total = 0
    for i, size in enumerate(pc.binary_length(raw).fill_null(0).to_pylist()):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if len(raw) > start:
        yield start, len(raw)
