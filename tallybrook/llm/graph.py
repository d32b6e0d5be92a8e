"""Connected components by Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.shared import let_workers_import, settled

# A task holds so many nodes at most while it joins its own links.
HELD_NODES = 500_000


def _stars(pairs: DataFrame) -> DataFrame:
    """Links (u, v) that join what `pairs` joins: each task's own, as stars around their smallest nodes.

    A chain within a task is one step long after this, so rounds are left for
    what crosses tasks. A task that meets more than HELD_NODES gives its stars
    out and begins anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        kind = None

        def root(node):
            top = node
            while parent[top] != top:
                top = parent[top]
            while parent[node] != top:
                parent[node], node = top, parent[node]
            return top

        def given() -> pa.RecordBatch:
            ends = [(node, root(node)) for node in parent]
            ends = [(node, top) for node, top in ends if node != top]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], kind) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            kind = batch.column(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parent.setdefault(u, u)
                parent.setdefault(v, v)
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= HELD_NODES:
                yield given()
                parent.clear()
        if parent:
            yield given()

    return pairs.mapInArrow(run, pairs.schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, from links (a, b).

    Tasks join their own links first. Then large-star and small-star rounds: every
    node links its larger neighbours, and then its smaller ones, to the smallest
    of them, until nothing changes. The number of rounds grows with the logarithm
    of the longest chain across tasks. Links stay in Spark; each round is written
    to the shared folder. Loops, repeated links and
    links with a null end are allowed and count for nothing.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    let_workers_import(links.sparkSession)
    state = settled(_stars(pairs).distinct(), "links")
    mark = _mark(state)
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("_u")).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        named = least.withColumnRenamed("u", "_u")
        small = large.join(named, F.col("u") == F.col("_u")).where("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = settled(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        before, mark = mark, _mark(state)
        if mark == before:
            break
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(state: DataFrame) -> tuple:
    """What tells two sets of links apart."""
    return tuple(state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
