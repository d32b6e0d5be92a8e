"""Nearest neighbours by a forest of hash prefixes.

A vector's hash symbols are the axes it lies closest to after random rotations
(cross-polytope hashing). Each tree is a sorted array of long strings of symbols.
A query goes down every tree to the longest prefixes that match its own strings,
and then up in all trees at once, one symbol a step, until enough vectors share a
prefix with it; those are compared exactly. Large inner products are found by
angles after vectors get one component more that evens out their lengths.

Vectors lie in blocks of bounded size, each with a forest of its own in one task.
Each vector is shuffled once, whatever the queries; the stated queries stream past
every block. Equal vectors are one, with their smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.shared import let_workers_import, settled

TREES = 64
# Symbols in a string; tree t reads the rotations from t on, round to the first.
DEPTH = 7
SYMBOL_BITS = 8
BLOCK_ROWS = 16_384
# So many queries go down a forest at a time.
QUERY_ROWS = 512
# Trees are climbed until so many vectors of a block share a prefix with the query.
CANDIDATES = 2_000


@cache
def _rotations(width: int) -> np.ndarray:
    """TREES random rotations, the same in every process; at most 128 axes are told apart."""
    random = np.random.default_rng(20_240_601)
    axes = min(width, 1 << (SYMBOL_BITS - 1))
    turns = [np.linalg.qr(random.standard_normal((width, width)))[0][:, :axes] for _ in range(TREES)]
    return np.stack(turns).astype(np.float32)


def symbols(vectors: np.ndarray) -> np.ndarray:
    """One symbol per rotation for each row: the nearest axis and its direction."""
    out = np.empty((len(vectors), TREES), np.uint8)
    for t, turn in enumerate(_rotations(vectors.shape[1])):
        turned = vectors.astype(np.float32) @ turn
        axis = np.argmax(np.abs(turned), axis=1)
        out[:, t] = axis * 2 + (turned[np.arange(len(vectors)), axis] < 0)
    return out


def strings(found: np.ndarray) -> np.ndarray:
    """The trees' strings, a column per tree, as numbers that sort like the strings."""
    out = np.zeros(found.shape, np.int64)
    for level in range(DEPTH):
        out = (out << SYMBOL_BITS) | np.roll(found, -level, axis=1).astype(np.int64)
    return out


class Forest:
    """Sorted strings of a block's vectors, and which vector each belongs to."""

    def __init__(self, found: np.ndarray) -> None:
        whole = strings(found)
        self.size = len(whole)
        self.order = np.argsort(whole, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(whole, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query's symbols, the vectors that share the longest prefixes, `enough` if there are."""
        wanted = strings(queries)
        ranges = []
        for level in range(DEPTH, 0, -1):
            shift = SYMBOL_BITS * (DEPTH - level)
            low = (wanted >> shift) << shift
            high = low + (1 << shift)
            begin = np.stack([np.searchsorted(s, low[:, t]) for t, s in enumerate(self.sorted)], axis=1)
            end = np.stack([np.searchsorted(s, high[:, t]) for t, s in enumerate(self.sorted)], axis=1)
            ranges.append((begin, end))
        for i in range(len(queries)):
            met = np.zeros(self.size, bool)
            for begin, end in ranges:
                if (end[i] - begin[i]).sum() >= min(enough, self.size):
                    for t in np.flatnonzero(end[i] > begin[i]):
                        met[self.order[t, begin[i, t] : end[i, t]]] = True
                    if met.sum() >= enough:
                        break
            else:
                met[:] = True  # the roots, which all strings share
            yield np.flatnonzero(met)


def _sound(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _with_symbols(rows: DataFrame, vector: str, longest: float, is_query: bool) -> DataFrame:
    """Add `symbols`: of rows with the evening component, of queries by direction."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, symbols binary"
    at = rows.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            lengths = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            out: list[bytes | None] = [None] * batch.num_rows
            starts = np.cumsum(lengths) - lengths
            for width in np.unique(lengths):
                own = np.flatnonzero(lengths == width)
                values = flat[starts[own][:, None] + np.arange(width)]
                squares = (values * values).sum(axis=1)
                if is_query:
                    values = values / np.sqrt(squares)[:, None]
                    rest = np.zeros(len(own))
                else:
                    values = values / longest
                    rest = np.sqrt(np.maximum(0.0, 1.0 - squares / longest**2))
                for i, s in zip(own, symbols(np.column_stack([values, rest])), strict=True):
                    out[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "symbols"])

    return rows.mapInArrow(run, schema)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _symbols_of(marks: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(marks), np.uint8).reshape(len(marks), -1)


def _nearest_of(
    forest: Forest, vectors: np.ndarray, ids: list[list[int]], asking: pa.RecordBatch, k: int, enough: int
) -> pa.RecordBatch:
    """(query_id, vec_id, score): the k nearest of a block for each of some queries."""
    queries = _matrix(asking.column(2), vectors.shape[1])
    found: list[tuple[int, int, float]] = []
    candidates = forest.candidates(_symbols_of(asking.column(3).to_pylist()), enough)
    for query_id, query, met in zip(asking.column(1).to_pylist(), queries, candidates, strict=True):
        scores = vectors[met] @ query
        top = met
        if len(met) > k + 1:
            # A vector may stand for the query alone, so one more than k is looked at,
            # and whatever ties with the last of them.
            last = len(met) - k - 1
            top = met[scores >= np.partition(scores, last)[last]]
        exact = (vectors[top] * query).sum(axis=1)
        own = [(-s, i) for s, at in zip(exact, top, strict=True) for i in ids[at] if i != query_id]
        found += [(query_id, i, -s) for s, i in sorted(own)[:k]]
    columns = zip(*found, strict=True) if found else ([], [], [])
    kinds = (pa.int64(), pa.int64(), pa.float64())
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    enough: int = CANDIDATES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows found, by inner product.

    Scores are sums in double precision of the given vectors; ties go to the
    smaller id, and `rank` counts from 1. A row with the query's id is not its
    neighbour. Ids that are null, and vectors that are null, zero or hold a
    component that is null or not finite, take no part; vectors are compared with
    those of as many components. Repeated rows are neighbours of their own; of a
    repeated query id the smallest vector asks. Fewer rows than k give all. In
    blocks of `enough` vectors or fewer, every vector is compared.
    """
    let_workers_import(rows.sparkSession)
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), numbers.alias("vec")).where(_sound(F.col("vec")))
    # Of equal vectors, no more than k ids can be among the nearest, besides the query's own.
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = sound.withColumn("_place", place).where(F.col("_place") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = settled(classes.withColumn("width", F.size("vec")), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    sums = classes.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest")).first()
    asked = queries.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("query_id"), numbers.alias("vec"))
    asked = asked.where(_sound(F.col("vec"))).groupBy("query_id").agg(F.min("vec").alias("vec"))
    asked = settled(_with_symbols(asked.withColumn("width", F.size("vec")), "vec", 1.0, True), "queries", gather=True)
    n_blocks = max(1, -(-sums["n"] // BLOCK_ROWS))
    indexed = _with_symbols(classes, "vec", max((sums["longest"] or 1.0) ** 0.5, 1e-300), False)
    block = F.pmod(F.xxhash64("vec"), F.lit(n_blocks)).cast("int").alias("block")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    no_id, no_ids = F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<long>").alias("ids")
    held = indexed.select(block, "width", no_id, "vec", "symbols", "ids")
    asking = asked.select(every_block, "width", "query_id", "vec", "symbols", no_ids)
    # A block is a task: its vectors come first, those of each width before their queries.
    dealt = held.unionByName(asking).repartitionById(n_blocks, F.col("block"))
    dealt = dealt.drop("block").sortWithinPartitions("width", F.col("query_id").isNotNull())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, vectors, marks, ids, forest = None, [], [], [], None
        for batch in batches:
            widths = batch.column(0).to_numpy()
            for own_width in np.unique(widths):
                rows_ = batch.filter(pa.array(widths == own_width))
                if own_width != width:
                    width, vectors, marks, ids, forest = own_width, [], [], [], None
                is_query = rows_.column(1).is_valid()
                more, theirs = rows_.filter(pc.invert(is_query)), rows_.filter(is_query)
                if len(more):
                    vectors.append(_matrix(more.column(2), width))
                    marks += more.column(3).to_pylist()
                    ids += more.column(4).to_pylist()
                if not len(theirs) or not ids:
                    continue
                if forest is None:
                    forest = Forest(_symbols_of(marks))
                    vectors = [np.concatenate(vectors)]
                for at in range(0, len(theirs), QUERY_ROWS):
                    yield _nearest_of(forest, vectors[0], ids, theirs.slice(at, QUERY_ROWS), k, enough)

    met = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    ranked = met.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
