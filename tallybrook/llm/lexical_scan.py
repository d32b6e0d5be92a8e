"""Ranked lexical search without an index: items' terms are counted in the texts themselves.

The terms of the items, each between two guards, make an Aho-Corasick automaton that is
broadcast; one scan of a text, with guards for all that is no term, gives its length and the
counts of all items' terms. Document frequencies are then summed up by Spark, and a second
pass over the counts alone scores them: each term leads on to the items that hold it.

Items are taken in blocks of bounded size, so what is broadcast does not grow with them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.shared import let_workers_import, settled

TOP = 10
# A block of items has so many distinct terms and items at most, or is one item.
BLOCK_TERMS = 100_000
BLOCK_ITEMS = 5_000
GUARD = "\0"
# Bytes that part terms become guards; letters, digits and all beyond ASCII are terms.
PARTING = bytes(b if b >= 0x80 or chr(b).isalnum() else 0 for b in range(256))
# Places of a table of scores, texts by items, that are held at once.
CELLS = 1 << 18
# Scores kept before they are cut back to each item's best.
KEPT = 1 << 18
LOW = (1 << 26) - 1


class Block(NamedTuple):
    """Items with the numbers of their terms; `terms[t]` is held by items `members[starts[t]:starts[t + 1]]`."""

    ids: list[int | None]
    terms: list[str]
    starts: np.ndarray
    members: np.ndarray


def guarded(text: str) -> str:
    """The text with A-Z in lower case, and a guard for each character that is no part of a term."""
    plain = text.encode("utf-8", "surrogatepass").lower().translate(PARTING)
    return GUARD + plain.decode("utf-8", "surrogatepass") + GUARD


def terms_of(text: str | None) -> list[str]:
    return [t for t in guarded(text or "").split(GUARD) if t]


def blocks(items: DataFrame, item_id: str, text: str, most_terms: int, most_items: int) -> Iterator[Block]:
    """Blocks of distinct items; the driver holds one block, and rows of one partition of the items."""
    rows = items.select(F.col(item_id).alias("id"), F.col(text).alias("text")).distinct()
    ids: list[int | None] = []
    places: dict[str, list[int]] = {}

    def block() -> Block:
        starts = np.cumsum([0, *map(len, places.values())])
        return Block(ids, list(places), starts, np.array([i for p in places.values() for i in p], np.int64))

    for row in rows.toLocalIterator():
        own = set(terms_of(row["text"]))
        if not own:
            continue
        if ids and (len(places.keys() | own) > most_terms or len(ids) == most_items):
            yield block()
            ids, places = [], {}
        for term in sorted(own):
            places.setdefault(term, []).append(len(ids))
        ids.append(row["id"])
    if ids:
        yield block()


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """An automaton that finds each term between guards and gives its number."""
    made = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        made.add_word(GUARD + term + GUARD, number)
    made.make_automaton()
    return made


def _scanned(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, n, terms, tf) of every text with a term: its length, and the items' terms in it."""
    shared = docs.sparkSession.sparkContext.broadcast(block.terms)
    schema = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"
    runs = re.compile(f"[^{GUARD}]+")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shared.value)
        for batch in batches:
            ids, lengths, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                plain = guarded(text.as_py())
                n = sum(1 for _ in runs.finditer(plain))
                if n == 0:
                    continue
                counts = Counter(map(itemgetter(1), found.iter(plain)))
                ids.append(doc_id)
                lengths.append(n)
                terms.append(list(counts))
                tfs.append(list(counts.values()))
            arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(scan, schema)


class _Best:
    """The best documents per item out of all scores shown; ties go to the smaller id, null last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.held = top, 0
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.least = np.zeros(items, np.int64)

    def show(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of documents (rows) for items (columns); 0 is no score."""
        rows, items = np.nonzero((scores > 0) & (scores >= self.least))
        self.parts.append((items, scores[rows, items], ids[rows], null[rows]))
        self.held += len(rows)
        if self.held > KEPT:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        items, scores, ids, null = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, null, -scores, items))
        items, scores, ids, null = items[order], scores[order], ids[order], null[order]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        kept = place < self.top
        last = place == self.top - 1
        self.least[items[last]] = scores[last]
        self.parts = [(items[kept], scores[kept], ids[kept], null[kept])]
        self.held = int(kept.sum())
        return self.parts[0]


def _scored(scanned: DataFrame, block: Block, weights: np.ndarray, texts: int, total: int, top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents per item of the block."""
    shared = scanned.sparkSession.sparkContext.broadcast((weights, block.starts, block.members, len(block.ids)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, starts, members, items = shared.value
        best = _Best(items, top)
        step = max(1, CELLS // items)
        for batch in batches:
            for part in (batch.slice(at, step) for at in range(0, batch.num_rows, step)):
                lists = part.column(2)
                terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(lists.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), sizes)
                m = 10 + (90 * part.column(1).to_numpy() * texts) // total
                gain = weight[terms] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * m[row]))
                # Every term of a text leads on to all items that hold it.
                many = starts[terms + 1] - starts[terms]
                ends = np.cumsum(many)
                within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many)
                cell = np.repeat(row, many) * items + members[np.repeat(starts[terms], many) + within]
                gains = np.repeat(gain, many)
                # Sums of halves stay below 2**53, where doubles are exact.
                low = np.bincount(cell, gains & LOW, part.num_rows * items).astype(np.int64)
                high = np.bincount(cell, gains >> 26, part.num_rows * items).astype(np.int64)
                scores = ((high << 26) + low).reshape(part.num_rows, items)
                ids = part.column(0)
                null = ids.is_null().to_numpy(zero_copy_only=False)
                best.show(scores, ids.fill_null(0).to_numpy(), null)
        if best.parts:
            item, found, ids, null = best.cut()
            arrays = [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return scanned.mapInArrow(score, "item int, doc_id bigint, score bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    most_terms: int = BLOCK_TERMS,
    most_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each item, ranks from 1.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z
    lower-cased; the score is that of the contract, in 64-bit numbers. Texts are scanned
    whole, once per block of items. Ids are whole numbers; a null id comes after the others
    of equal score, and rows of one id are documents of their own. Null, empty and termless
    texts are no documents, and such items have no rows. Item rows that are equal count
    once; different texts under one item id are ranked each by itself. Further columns play
    no part. Each task keeps `top` documents per item, so a term that most documents hold
    moves no more rows than a rare one.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    result = None
    for block in blocks(items, item_id, item_text, most_terms, most_items):
        scanned = settled(_scanned(rows, block), "lexical-scan")
        texts, total = scanned.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not texts:
            break
        held = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weights = np.zeros(len(block.terms), np.int64)
        # A row per term of the block at most.
        for row in held.collect():
            weights[row["term"]] = int(np.floor(1000 * np.log((2 * texts + 2) / (2 * row["df"] + 1))))
        best = _scored(scanned, block, weights, texts, total, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id bigint")
        named = best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        result = named if result is None else result.unionByName(named)
    if result is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return result


SQL = """
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id
), totals AS (
  SELECT count(*) AS texts, CAST(sum(n) AS BIGINT) AS total FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * texts + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, texts
), items AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark
), scores AS (
  SELECT i.item_id, c.doc_id,
         CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * l.n * t.texts) // t.total)))) AS BIGINT) AS score
  FROM items i JOIN counts c USING (term) JOIN weights w USING (term) JOIN lengths l ON l.doc_id = c.doc_id, totals t
  GROUP BY i.item_id, c.doc_id
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 10
"""
