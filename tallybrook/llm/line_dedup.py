"""Line dedup: passages of three or more consecutive lines that occur before are removed.

Every three consecutive lines are a window. A window that occurs again, in the
same text or another, is removed where it is not the first; overlapping windows
merge, so a repeated passage of any length from three lines on goes as a whole.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import once
from tallybrook.llm.shared import row_key, settled

LINES = 3


def _windows(lines: Column, length: int) -> Column:
    """128-bit hashes of every `length` consecutive lines, in order."""
    last = F.size(lines) - length + 1

    def hashed(at: Column) -> Column:
        part = F.slice(lines, at, length)
        # Two hashes of different seeds, as one of 64 bits meets by chance in a large corpus.
        return F.struct(F.xxhash64(part).alias("a"), F.xxhash64(F.lit(7919), part).alias("b"))

    some = F.transform(F.sequence(F.lit(1), last), hashed)
    return F.when(last >= 1, some).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))


def repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LINES
) -> DataFrame:
    """One row per document with a window that occurs before: `_key` and `flags`.

    `flags` has a boolean per window of the document, in order: whether the same
    window occurs before, in a document of smaller key (by id, then text hash) or
    earlier in this one. Lines are counted as they are, blank ones included; a
    window of blank lines alone is never a repeat. Occurrences are counted with
    map-side combine, so a window that very many documents share costs one row
    per task; the join that marks them is left to adaptive execution to split.
    """
    lines = docs.select(
        row_key(key, text).alias("_key"), once(F.split(F.col(text), "\n")).alias("lines")
    ).where(F.size("lines") >= length)
    hashed = lines.select("_key", F.posexplode(_windows(F.col("lines"), length)).alias("at", "window"))
    blank = F.xxhash64(F.array(*[F.lit("")] * length))
    rows = hashed.where(F.col("window.a") != blank).select(
        "_key", "at", F.col("window.a").alias("a"), F.col("window.b").alias("b")
    )
    # Used twice below; the texts are read and hashed once.
    rows = settled(rows, "windows")
    firsts = (
        rows.groupBy("a", "b")
        .agg(F.min(F.struct("_key", "at")).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .drop("times")
    )
    later = rows.join(firsts, ["a", "b"]).where(F.struct("_key", "at") != F.col("first"))
    # A later window comes once however often its row does.
    return later.select("_key", "at").groupBy("_key").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LINES, counts: bool = True
) -> DataFrame:
    """The documents with repeated passages taken out of `text`, and two columns more.

    `n_lines` counts the lines of the given text (0 for a null text, 1 for an
    empty one) and `n_removed` those taken out. Every document stays, also one
    of which no line is left (its text is then empty); null texts stay null.
    Rows that repeat an id and its text count as one document, and stay. Given
    columns of those two names are replaced; without `counts` there are no others
    than the given columns.
    """
    # The given columns go by their places, so that no name meets another.
    places = {c: f"_given{i}" for i, c in enumerate(docs.columns)}
    own = list(places.values())
    renamed = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in places.items()])
    given = renamed.select(*own, row_key(places[key], places[text]).alias("_key"))
    found = repeated_windows(docs, key, text, length)
    lines = given.join(found, "_key", "left").select(
        *own, "starts", once(F.split(F.col(places[text]), "\n")).alias("lines")
    )
    # Merged spans from the sorted starts: a span begins where no window reaches from before,
    # and ends with the last window that the ones before reach.
    starts = F.col("starts")
    begins = F.filter(
        starts, lambda start, i: (i == 0) | (start > F.get(F.col("starts"), i - 1) + length)
    )
    ends = F.filter(
        starts,
        lambda start, i: F.coalesce(F.get(F.col("starts"), i + 1) > start + length, F.lit(True)),
    )
    spans = lines.select(*own, "lines", once(F.struct(begins.alias("begins"), ends.alias("ends"))).alias("spans"))
    begins, ends = F.col("spans.begins"), F.col("spans.ends")
    # What stays lies between the spans: from the end of one to the beginning of the next.
    n = F.size("lines")
    froms = F.concat(F.array(F.lit(0)), F.transform(ends, lambda e: e + length))
    upto = F.concat(begins, F.array(n))
    gaps = spans.select(*own, "lines", F.when(begins.isNotNull(), F.arrays_zip(froms.alias("a"), upto.alias("b"))).alias("gaps"))
    kept = F.flatten(F.transform("gaps", lambda g: F.slice("lines", g["a"] + 1, g["b"] - g["a"])))
    result = gaps.select(*own, "lines", "gaps", once(F.when(F.col("gaps").isNotNull(), kept)).alias("kept"))
    new_text = F.when(F.col("kept").isNull(), F.col(places[text])).otherwise(F.array_join("kept", "\n"))
    added = ("n_lines", "n_removed") if counts else ()
    columns = [
        (new_text if c == text else F.col(places[c])).alias(c) for c in docs.columns if c not in added
    ]
    n_lines = F.when(F.col(places[text]).isNull(), 0).otherwise(F.size("lines"))
    n_removed = F.when(F.col("kept").isNull(), 0).otherwise(F.size("lines") - F.size("kept"))
    counted = [n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed")]
    return result.select(*columns, *(counted if counts else ()))


# The same in SQL: windows compared as text, spans by position.
SQL = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS win
  FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM lines WHERE len(lines) >= 3)),
marked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS later
  FROM windows WHERE win <> ['', '', '']),
covered AS (
  SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM marked WHERE later),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM lines)
  ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       d.lang, d.source, d.n_chars, coalesce(len(l.lines), 0) AS n_lines,
       CASE WHEN l.doc_id IS NULL THEN 0 ELSE len(l.lines) - coalesce(k.n, 0) END AS n_removed
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
