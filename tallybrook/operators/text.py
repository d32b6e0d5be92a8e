"""Counting and searching in text.

Every operator takes a DataFrame with a string column whose values may hold
several lines; a line from a text file is the one-line case.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import text as tf
from tallybrook.operators.groups import concat_groups

_PIECE_BYTES = 4 * 1024 * 1024
_CODE_POINTS = 0x110000


def _code_point_counter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that turns a partition of texts into one row per character.

    The texts of a batch lie one after another in a single buffer, so a batch
    is counted with a few array operations and no loop over rows. Pieces keep
    the wide form of the text small, however long the texts are. It is made
    here, not defined at the top, so that it travels to the executors whole and
    they need no copy of this package.
    """
    piece_bytes, code_points = _PIECE_BYTES, _CODE_POINTS

    def count(batches):
        totals = np.zeros(code_points, dtype=np.int64)
        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())
            _, offset_buffer, data = column.buffers()
            if len(column) == 0 or data is None:
                continue
            offsets = np.frombuffer(offset_buffer, dtype=np.int64)
            first = int(offsets[column.offset])
            last = int(offsets[column.offset + len(column)])
            decoder = codecs.getincrementaldecoder("utf-8")("replace")
            for start in range(first, last, piece_bytes):
                stop = min(start + piece_bytes, last)
                piece = decoder.decode(memoryview(data)[start:stop], final=stop == last)
                points = np.frombuffer(piece.encode("utf-32-le"), dtype=np.uint32)
                seen = np.bincount(points)
                totals[: len(seen)] += seen
        used = np.nonzero(totals)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([chr(p) for p in used], pa.string()), pa.array(totals[used], pa.int64())],
            names=["ch", "n"],
        )

    return count


def all_char_counts(texts: DataFrame, text: str = "value") -> DataFrame:
    """(ch, n) for every character in the texts, line ends included.

    Each task adds up its own partition and emits one row per distinct
    character, so the shuffle holds an alphabet per task and not the text.
    Exploding to a row per character gives the same result in built-in
    expressions; for 500 million characters it took 12.7 s, and this 2.3 s.
    """
    return (
        texts.select(text)
        .where(F.col(text).isNotNull())
        .mapInArrow(_code_point_counter(), "ch string, n bigint")
        .groupBy("ch")
        .agg(F.sum("n").alias("n"))
    )


def char_count(
    texts: DataFrame,
    text: str = "value",
    exclude: list[str] = C.MARKS,
    ignore_case: bool = False,
    blank_lines: bool = False,
) -> DataFrame:
    """(ch, n) per character that is not excluded; line ends never count.

    With `blank_lines`, lines without any character are counted under the empty
    string, as a split of every line into characters would have it.
    """
    counts = all_char_counts(texts, text)
    kept = counts.where(~tf.in_list(F.col("ch"), exclude, ignore_case) & (F.col("ch") != "\n"))
    if not blank_lines:
        return kept
    lines = texts.select(F.explode(F.split(text, "\n")).alias("ch")).where(F.col("ch") == "")
    return kept.unionByName(lines.groupBy("ch").agg(F.count(F.lit(1)).alias("n")))


def mark_count(texts: DataFrame, text: str = "value", marks: list[str] = C.MARKS) -> DataFrame:
    """(ch, n) for the listed marks only."""
    return all_char_counts(texts, text).where(tf.in_list(F.col("ch"), marks))


def mark_vs_word(
    texts: DataFrame, text: str = "value", marks: list[str] = C.MARKS, blank_lines: bool = False
) -> DataFrame:
    """One row: how many characters are marks and how many are not.

    With `blank_lines`, a line without any character counts as one that is not a mark.
    """
    is_mark = tf.in_list(F.col("ch"), marks)
    n = lambda keep: F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0)).cast("bigint")
    return (
        char_count(texts, text, exclude=[], blank_lines=blank_lines)
        .agg(n(is_mark).alias("mark_sum"), n(~is_mark).alias("word_sum"))
    )


def words(texts: DataFrame, text: str = "value", separator: str = " ") -> DataFrame:
    """One row per word; lines split on the separator, trailing empties dropped."""
    lines = texts.select(F.explode(F.split(text, "\n")).alias("_line"))
    return lines.select(F.explode(tf.fields(F.col("_line"), separator)).alias("word"))


def word_count(texts: DataFrame, text: str = "value", separator: str = " ") -> DataFrame:
    """(word, n) over all lines."""
    return words(texts, text, separator).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def keyword_sentences(
    texts: DataFrame,
    keep: list[str],
    text: str = "value",
    keyword: str = C.SEARCH_KEYWORD,
    stop: str = C.SENTENCE_STOP,
) -> DataFrame:
    """One row per sentence holding the keyword: the kept columns, `pos`, `sentence`.

    Texts without the keyword are dropped before they are split. A sentence
    never spans lines.
    """
    has_word = texts.where(F.col(text).contains(keyword))
    split = has_word.select(*keep, F.posexplode(tf.pieces(F.col(text), stop)).alias("pos", "sentence"))
    return split.where(F.col("sentence").contains(keyword))


def sentences_by_key(
    sentences: DataFrame,
    keys: list[str],
    spread: Column,
    separator: str = C.SENTENCE_SEPARATOR,
    trailing: bool = False,
    *,
    parts: int,
) -> DataFrame:
    """All found sentences of a key as text, in `parts` rows per key (see `concat_groups`)."""
    return concat_groups(sentences, keys, "sentence", spread, separator, trailing, parts=parts)
