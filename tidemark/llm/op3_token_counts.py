"""Token counts as rollups that are maintained by deltas.

Every batch of changes (insert, delete, revise) becomes signed deltas by source, language and tokenizer version; totals
are their sum. A ledger keeps the last count of every document, so that a delete or a revision takes back exactly what
was added. A batch's ledger rows and deltas are written under its id and count only once its commit is written, last;
a batch that failed half-way is written over when it is run again, and one that is committed is not applied again.

Defined results: a null text has no token; a null source or language is a group of its own; an insert of a known
document counts as a revision, a delete of an unknown one changes nothing; of several changes of one document in a
batch the last by `seq` holds (ties: the largest text), and repeated rows count once, also those without an id, which
are known by text, source and language. Groups that fall back to zero documents stay, with zeros; other columns are not
read; an empty batch is committed and changes nothing.

One batch is applied at a time: it claims the next number by creating a file that mustn't be there, and a claim of a
batch that isn't committed holds off every other batch until that one is run again.
"""

from __future__ import annotations

import base64
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

#: Tokenizer versions: bytes of the public vocabulary, and plain words.
BPE, WORDS = "byte_bpe_50k/1", "words/1"
KEYS = ("source", "lang", "tokenizer")

_LOADED: dict[str, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _tokenizer(path: str):
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def counted(rows: DataFrame, columns: list[str], path: str) -> DataFrame:
    """The columns, and for every row the number of tokens by each version."""

    def make():
        encode = _tokenizer(path).encode_ordinary

        def work(texts):
            plain = [(t or b"").decode("utf-8", "replace") for t in texts]
            return {"n_bpe": [len(encode(t)) for t in plain], "n_words": [len((t or b"").split()) for t in texts]}

        return work

    return common.map_texts(rows, columns, "text", "n_bpe long, n_words long", make)


class Rollups:
    """A folder of ledger rows, deltas and commits; all of it goes through Spark's readers and writers."""

    LEDGER = "doc_id string, tokenizer string, source string, lang string, n_tokens long, alive boolean, seq long, batch string"
    DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string"
    COMMITS = "number long, batch string"

    def __init__(self, spark: SparkSession, folder: str, vocabulary: str | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.vocabulary = vocabulary or default_vocabulary()

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{name}")

    def _write(self, rows: DataFrame, name: str, batch: str) -> str:
        path = f"{self.folder}/{name}/{uuid.uuid5(uuid.NAMESPACE_OID, batch).hex}"
        rows.write.mode("overwrite").parquet(path)
        return path

    def commits(self) -> DataFrame:
        return self._read("commits", self.COMMITS)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Changes have doc_id, op (insert, delete or revise), text, source, lang and seq. False if known already."""
        known = self.commits()
        if known.where(F.col("batch") == batch).count():
            return False
        number = (known.agg(F.max("number")).first()[0] or 0) + 1
        self._claim(number, batch)
        columns = ["doc_id", "source", "lang", "op", "seq"]
        doc_id = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.xxhash64("text", "source", "lang").cast("string")))
        counts = counted(changes.withColumn("doc_id", doc_id).select(*columns, "text"), columns, self.vocabulary)
        last = counts.groupBy("doc_id").agg(F.max(F.struct("seq", "n_bpe", "n_words", "source", "lang", "op")).alias("c"))
        rows = last.select("doc_id", "c.*", F.explode(F.create_map(F.lit(BPE), F.col("c.n_bpe"), F.lit(WORDS), F.col("c.n_words"))).alias("tokenizer", "n_tokens"))
        new = rows.select("doc_id", "tokenizer", "source", "lang", "n_tokens", (F.col("op") != "delete").alias("alive"), F.lit(number).cast("long").alias("seq"), F.lit(batch).alias("batch"))
        fresh = self.spark.read.schema(self.LEDGER).parquet(self._write(new, "ledger", batch))
        added = fresh.where("alive").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        signed = added
        if number > 1:  # what the same documents added before
            old = self._read("ledger", self.LEDGER).join(F.broadcast(known.select("batch")), "batch").join(fresh.select("doc_id", "tokenizer"), ["doc_id", "tokenizer"], "left_semi")
            latest = old.groupBy("doc_id", "tokenizer").agg(F.max(F.struct("seq", "alive", "source", "lang", "n_tokens")).alias("o")).select("tokenizer", "o.*").where("alive")
            taken = latest.groupBy(*KEYS).agg((-F.count(F.lit(1))).alias("n_docs"), (-F.sum("n_tokens")).alias("n_tokens"))
            signed = added.unionByName(taken).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        self._write(signed.withColumn("batch", F.lit(batch)), "deltas", batch)
        self._write(self.spark.createDataFrame([(number, batch)], self.COMMITS).coalesce(1), "commits", batch)
        return True

    def _claim(self, number: int, batch: str) -> None:
        """Creates the file of this number with the batch's name, or finds that the same batch did so before it failed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/claims/{number:012d}-{uuid.uuid5(uuid.NAMESPACE_OID, batch).hex}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        first = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/claims/{number:012d}")
        if not files.exists(path):
            try:
                files.create(first, False).close()
            except Py4JJavaError as e:
                raise RuntimeError(f"another batch is being applied as number {number}") from e
            files.create(path, True).close()

    def totals(self) -> DataFrame:
        done = self._read("deltas", self.DELTAS).join(F.broadcast(self.commits().select("batch")), "batch")
        return done.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of all documents, come to by three batches into a new folder of rollups, each sent twice.

    The first inserts every document without its language, and beside it a draft that holds its source's name; the
    second revises every document, now with its language; the third deletes the drafts. Groups left without documents
    are not shown.
    """
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    known = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.xxhash64("text", "source", "lang").cast("string")))
    docs = docs.withColumn("doc_id", known)
    drafts = docs.select(F.concat(F.lit("draft:"), F.col("doc_id")).alias("doc_id"), F.col("source").alias("text"), "source", F.lit(None).cast("string").alias("lang"))
    without = docs.withColumn("lang", F.lit(None).cast("string"))
    rollups = Rollups(spark, f"{common.shared_folder(spark)}/tidemark-token-counts-{uuid.uuid4().hex}")
    batches = [("arrival", without.unionByName(drafts), "insert"), ("languages", docs, "revise"), ("drafts", drafts, "delete")]
    for name, changes, op in batches:
        for _ in range(2):
            rollups.apply(name, changes.withColumns({"op": F.lit(op), "seq": F.lit(0).cast("long")}))
    return rollups.totals().where("n_docs <> 0")
