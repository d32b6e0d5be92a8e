"""Registered queries: counting and searching in text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import text as tf
from tallybrook.operators import relational, text
from tallybrook.plans.tables import Query, table
from tallybrook.sinks.files import tab_lines

_MARKS_SQL = "(" + ", ".join(f"'{m}'" for m in C.MARKS) + ")"
_CHARS_SQL = """
  SELECT unnest(string_split(replace(text, chr(10), ''), '')) AS ch FROM documents
"""
WORDS_SQL = """
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
"""
SENTENCES_SQL = r"""
  SELECT source, doc_id, pos, found[pos + 1] AS sentence
  FROM (SELECT source, doc_id, found, unnest(range(len(found))) AS pos
        FROM (SELECT source, doc_id, string_split_regex(text, '[\n.]') AS found FROM documents))
  WHERE contains(found[pos + 1], 'th')
"""


def char_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = text.char_count(table(spark, sf_dir, "documents"), "text")
    return counts.orderBy(F.col("n").desc(), "ch")


CHAR_SQL = f"""
SELECT ch, count(*) AS n FROM ({_CHARS_SQL})
WHERE ch <> '' AND ch NOT IN {_MARKS_SQL} GROUP BY ch ORDER BY n DESC, ch
"""


def char_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`character TAB count` lines in byte order of the character."""
    counts = text.char_count(table(spark, sf_dir, "documents"), "text").orderBy("ch")
    return tab_lines(counts, "ch", "n")


CHAR_LINES_SQL = f"""
SELECT ch || chr(9) || count(*) AS value FROM ({_CHARS_SQL})
WHERE ch <> '' AND ch NOT IN {_MARKS_SQL} GROUP BY ch ORDER BY ch
"""


def mark_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.mark_count(table(spark, sf_dir, "documents"), "text")


MARK_SQL = f"SELECT ch, count(*) AS n FROM ({_CHARS_SQL}) WHERE ch IN {_MARKS_SQL} GROUP BY ch"


def mark_vs_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.mark_vs_word(table(spark, sf_dir, "documents"), "text")


def mark_vs_word_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank lines count as one character that is not a mark."""
    return text.mark_vs_word(table(spark, sf_dir, "documents"), "text", blank_lines=True)


MARK_WORD_BLANKS_SQL = f"""
SELECT CAST(count(*) FILTER (WHERE ch IN {_MARKS_SQL}) AS BIGINT) AS mark_sum,
       CAST(count(*) FILTER (WHERE ch NOT IN {_MARKS_SQL}) AS BIGINT) AS word_sum
FROM (SELECT unnest(CASE WHEN line = '' THEN [''] ELSE string_split(line, '') END) AS ch
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
"""

MARK_WORD_SQL = f"""
SELECT CAST(count(*) FILTER (WHERE ch IN {_MARKS_SQL}) AS BIGINT) AS mark_sum,
       CAST(count(*) FILTER (WHERE ch NOT IN {_MARKS_SQL} AND ch <> '') AS BIGINT) AS word_sum
FROM ({_CHARS_SQL})
"""


def char_count_ignore_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vowels left out in either case."""
    docs = table(spark, sf_dir, "documents")
    return text.char_count(docs, "text", exclude=["a", "e", "i", "o", "u"], ignore_case=True)


CHAR_IGNORE_CASE_SQL = f"""
SELECT ch, count(*) AS n FROM ({_CHARS_SQL})
WHERE ch <> '' AND lower(ch) NOT IN ('a', 'e', 'i', 'o', 'u') GROUP BY ch
"""


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(table(spark, sf_dir, "documents"), "text")


WORD_SQL = f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word"


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return text.keyword_sentences(docs, ["source", "doc_id"], "text", "th", ".")


def keyword_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.count_by_key(_found(spark, sf_dir), "source")


KEYWORD_SQL = f"SELECT source, count(*) AS n FROM ({SENTENCES_SQL}) GROUP BY source"


def keyword_sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).withColumn("pos", F.col("pos").cast("bigint"))


def sentence_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All found sentences of a source, sorted and joined into one text."""
    spread = F.col("doc_id") + F.col("pos")
    return text.sentences_by_key(_found(spark, sf_dir), ["source"], spread, parts=1)


CONCAT_SQL = f"""
SELECT source, CAST(0 AS BIGINT) AS part, count(*) AS n_values,
       string_agg(sentence, '---|---' ORDER BY sentence) AS joined
FROM ({SENTENCES_SQL}) GROUP BY source
"""


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per language that are not blank and hold one of two tokens."""
    lines = table(spark, sf_dir, "documents").select(
        "lang", F.explode(F.split("text", "\n")).alias("line")
    )
    line = F.col("line")
    kept = lines.where(tf.non_blank(line) & tf.contains_any(line, ["the", "qu"]))
    return relational.count_by_key(kept, "lang")


MARKED_SQL = """
SELECT lang, count(*) AS n FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE trim(line) <> '' AND (contains(line, 'the') OR contains(line, 'qu')) GROUP BY lang
"""


QUERIES = {
    "char_count": Query(char_count, CHAR_SQL),
    "char_lines": Query(char_lines, CHAR_LINES_SQL),
    "mark_count": Query(mark_count, MARK_SQL),
    "mark_vs_word": Query(mark_vs_word, MARK_WORD_SQL),
    "mark_vs_word_blanks": Query(mark_vs_word_blanks, MARK_WORD_BLANKS_SQL),
    "char_count_ignore_case": Query(char_count_ignore_case, CHAR_IGNORE_CASE_SQL),
    "word_count": Query(word_count, WORD_SQL),
    "keyword_sentences": Query(keyword_sentences, KEYWORD_SQL),
    "keyword_sentence_rows": Query(keyword_sentence_rows, SENTENCES_SQL),
    "sentence_concat": Query(sentence_concat, CONCAT_SQL),
    "marked_lines": Query(marked_lines, MARKED_SQL),
}
