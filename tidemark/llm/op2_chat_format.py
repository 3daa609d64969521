"""Chat formatting by grammar round trip, in built-in expressions alone.

    conversation := turn*
    turn := "<|turn|>" role mode text "<|end|>"        mode := "<|plain|>" | "<|escaped|>"

A rendering is parsed back by the deterministic parser (`parsed_turns`) and its turns are compared with the source.
First all turns are plain. If that doesn't parse back to the source, the turns with control strings are escaped, and if
even that doesn't, all turns are; escaping leaves no "<" and no "[", so the last form always parses back. A control
string of any public chat template inside a plain turn counts as a failed parse, so that none is ever passed on raw.

Escapes: "\\" is "\\e", "<" is "\\l", "[" is "\\b".

Defined results: a null text or role is empty; turns are in order of `turn` (nulls first), then role, then text, and
repeated rows are repeated turns; a null conversation id is a conversation of its own; other columns are not read. One
conversation is one row of the result, hence one group; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

TURN, PLAIN, ESCAPED, END = "<|turn|>", "<|plain|>", "<|escaped|>", "<|end|>"
# Control strings of public chat templates.
CONTROL = r"</?s>|\[/?INST\]|<</?SYS>>|<\|[A-Za-z_0-9]*\|>|<(?:start|end)_of_turn>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")), F.lit("\\e"), F.lit("\\"))


def rendered_turn(turn: Column, escape: Column) -> Column:
    plain = F.concat(F.lit(TURN), turn["role"], F.lit(PLAIN), turn["text"], F.lit(END))
    safe = F.concat(F.lit(TURN), escaped(turn["role"]), F.lit(ESCAPED), escaped(turn["text"]), F.lit(END))
    return F.when(escape, safe).otherwise(plain)


def rendered(turns: Column, escape) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered_turn(t, escape(t))), "")


def parsed_turns(text: Column) -> Column:
    """The turns of a rendering as (role, text); a turn that breaks the grammar is null."""
    parts = F.split(text, r"\Q<|end|>\E", -1)
    bodies = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(body: Column) -> Column:
        opened = F.startswith(body, F.lit(TURN))
        rest = F.substring(body, len(TURN) + 1, 2147483647)
        plain, safe = F.instr(rest, PLAIN), F.instr(rest, ESCAPED)
        is_plain = (plain > 0) & ((safe == 0) | (plain < safe))
        at, width = F.when(is_plain, plain).otherwise(safe), F.when(is_plain, F.lit(len(PLAIN))).otherwise(F.lit(len(ESCAPED)))
        role, said = F.substring(rest, F.lit(1), at - 1), F.substring(rest, at + width, F.lit(2147483647))
        clash = is_plain & (F.regexp_like(role, F.lit(CONTROL)) | F.regexp_like(said, F.lit(CONTROL)))
        read = F.struct(
            F.when(is_plain, role).otherwise(unescaped(role)).alias("role"),
            F.when(is_plain, said).otherwise(unescaped(said)).alias("text"),
        )
        return F.when(opened & (at > 0) & ~clash, read)

    return F.transform(bodies, turn)


def formatted_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: the id, the formatted string and the turns read back from it."""
    said = rows.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("t"))
    turns = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts")).select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    clash = lambda t: F.regexp_like(t["role"], F.lit(CONTROL)) | F.regexp_like(t["text"], F.lit(CONTROL))
    tried = turns
    done: Column | None = None
    for name, escape in (("plain", lambda t: F.lit(False)), ("mixed", clash), ("safe", lambda t: F.lit(True))):
        again = rendered(F.col("turns"), escape)
        need = F.lit(True) if done is None else done.isNull()
        tried = tried.withColumn(name, F.when(need, again))
        fits = F.when(parsed_turns(F.col(name)) == F.col("turns"), F.col(name))
        tried = tried.withColumn("fit", fits if done is None else F.coalesce("fit", fits))
        done = F.col("fit")
    return tried.select("conv_id", F.col("fit").alias("formatted"), parsed_turns(F.col("fit")).alias("read_back"))


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns, from what is read back from the output."""
    line = F.transform("read_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("read_back", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return formatted.select("conv_id", "formatted", F.size("read_back").cast("long").alias("n_turns"), F.array_join(line, "").alias("all"), loss.alias("loss")).select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("all").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(formatted_conversations(rows.unionByName(probe)))


ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
),
m AS (SELECT *, regexp_matches(role, '{CONTROL}') OR regexp_matches(text, '{CONTROL}') AS bad FROM c),
f AS (
  SELECT *, 15 + CASE WHEN bad THEN 11 ELSE 9 END + length(role) + length(text)
    + CASE WHEN bad THEN length(role || text) - length(regexp_replace(role || text, '[\[<\\]', '', 'g')) ELSE 0 END AS n
  FROM m
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
