"""Line-first quality rules.

Every line of a text is held against punctuation, navigation and boilerplate rules: runs of marks, separators, short
lines that open like a menu entry, that break off, or that are a word or two without an end (in any language), and
fixed phrases. Failing lines are removed, and a document that loses more than half of its words, or that fails the base counts, is rejected.

Defined results: a null or empty text has no words, no lines and fails the base rule (fewer than ten words); lines
without a word are neither judged nor removed; repeated rows are judged one by one; other columns are not read.
Needs no shuffle: one pass over the texts, memory bounded by the longest text.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common

# The ASCII white space that ends a word, and the symbols that are counted.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: A line of prose has few runs of symbols or exclamation marks: at most one for every four words.
MARKS = r"[#*$%&|<>~^=_]{2,}|[!?]{2,}"
#: A separator standing between menu entries.
SEPARATOR = r"(?:^|[\x20\x09])(?:\||>|>>|/|»|·|•)(?:[\x20\x09]|$)"
#: A line whose end shows that its text goes on elsewhere.
TORN = r"(?:\.\.\.|…|»|>>|\[[^\]]{1,12}\])[\x20\x09\r]*$"
#: The end of a sentence, heading or list item, closing quotes and brackets after it; and how few words may do without.
ENDED = r"[.!?:;,。！？)\]}\x22'”’]+[\x20\x09\r]*$"
FRAGMENT_WORDS = 2
#: A short line that opens like a menu entry, in the languages that are told apart most often.
MENU = r"(?i)^[\x20\x09]*(?:home|menu|log ?in|sign (?:in|up)|search|next|previous|skip to|back to top|read more|click here|share this|follow us|startseite|anmelden|suche|weiterlesen|mehr erfahren|teilen|accueil|connexion|rechercher|lire la suite|en savoir plus|suivant|partager|inicio|iniciar|buscar|siguiente|anterior|leer más|compartir)\b"
BOILERPLATE = r"(?i)cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|subscribe to our|newsletter|enable javascript|lorem ipsum|released under the|licensed under the|spdx-license-identifier|datenschutzerkl|alle rechte vorbehalten|allgemeine geschäftsbedingungen|mentions légales|tous droits réservés|politique de confidentialité|todos los derechos reservados|política de privacidad|aviso legal"
MENU_WORDS = 6

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines_removed long, n_words_removed long, clean_text string"


def repeated_words(words: list[str]) -> int:
    """Words that stand in a window of five that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 5 - max(end, i)
            end = i + 5
    return covered


class LineRules:
    def __init__(self) -> None:
        self.word = re.compile(r"[^\x20\x09-\x0D]+")
        self.marks, self.separator = re.compile(MARKS), re.compile(SEPARATOR)
        self.menu, self.boilerplate = re.compile(MENU), re.compile(BOILERPLATE)
        self.torn, self.ended = re.compile(TORN), re.compile(ENDED)

    def fails(self, line: str, n_words: int) -> bool:
        if 4 * len(self.marks.findall(line)) > n_words:
            return True
        separators = len(self.separator.findall(line))
        if separators >= 2 and 4 * separators >= n_words:
            return True
        if n_words <= MENU_WORDS and (self.menu.search(line) or self.torn.search(line)):
            return True
        if n_words <= FRAGMENT_WORDS and not self.ended.search(line):
            return True
        return self.boilerplate.search(line) is not None

    def judge(self, text: str) -> tuple:
        words = self.word.findall(text)
        n_words = len(words)
        n_dup = removed_lines = removed_words = 0
        seen: set[str] = set()
        left = []
        for line in text.split("\n"):
            n = len(self.word.findall(line))
            if n:
                n_dup += line in seen
                seen.add(line)
                if self.fails(line, n):
                    removed_lines += 1
                    removed_words += n
                    continue
            left.append(line)
        n_repeat = repeated_words(words)
        base_failed = n_words < 10 or 100 * n_repeat > 20 * n_words
        kept = not base_failed and 2 * removed_words <= n_words
        word_chars = len(text) - sum(map(text.count, SPACE))
        return n_words, word_chars, sum(map(text.count, SYMBOLS)), n_dup, n_repeat, base_failed, kept, removed_lines, removed_words, "\n".join(left)


def _make():
    rules, names = LineRules(), [x.split()[0] for x in SCHEMA.split(", ")]

    def work(texts):
        rows = [rules.judge((t or b"").decode("utf-8", "replace")) for t in texts]
        return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    return work


def line_first_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, verdicts and the cleaned text of every document."""
    return common.map_texts(docs, [id_column], text_column, SCHEMA, _make)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first_quality(common.table(spark, sf_dir, "documents")).drop("clean_text")


ENDED_SQL = ENDED.replace("'", "''")

ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(5)) AS j) GROUP BY r),
ln AS (
  SELECT r, k, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d)
),
judged AS (
  SELECT r, n, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS dup,
    4 * len(regexp_extract_all(line, '{MARKS}')) > n
    OR (len(regexp_extract_all(line, '{SEPARATOR}')) >= 2 AND 4 * len(regexp_extract_all(line, '{SEPARATOR}')) >= n)
    OR (n <= {MENU_WORDS} AND (regexp_matches(line, '{MENU}') OR regexp_matches(line, '{TORN}')))
    OR (n <= {FRAGMENT_WORDS} AND NOT regexp_matches(line, '{ENDED_SQL}'))
    OR regexp_matches(line, '{BOILERPLATE}') AS bad
  FROM ln WHERE n > 0
),
lines AS (SELECT r, count_if(dup) AS n_dup, count_if(bad) AS bad_lines, coalesce(sum(n) FILTER (bad), 0) AS bad_words FROM judged GROUP BY r),
f AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(bad_lines, 0) AS n_lines_removed, coalesce(bad_words, 0) AS n_words_removed
  FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * n_words_removed <= n_words AS kept,
  n_lines_removed::BIGINT AS n_lines_removed, n_words_removed::BIGINT AS n_words_removed
FROM f
"""
