import random
import time
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import mixing


@pytest.mark.parametrize("parts", [[1], [1, 1], [7, 2, 1], [500, 300, 150, 49, 1], [333, 333, 334], [1] * 13 + [87]])
def test_deviation_stays_under_one_block(parts):
    period, had = sum(parts), Counter()
    for slot, source in enumerate(mixing.one_period(parts), 1):
        had[source] += 1
        for s, part in enumerate(parts):
            assert abs(had[s] - Fraction(part * slot, period)) < 1
    assert [had[s] for s in range(len(parts))] == parts


def test_random_weights_are_scheduled():
    rnd = random.Random(1)
    for _ in range(20):
        parts = mixing.whole_parts([rnd.random() ** 3 for _ in range(rnd.randrange(1, 40))], 400)
        assert sum(parts) == 400 and min(parts) >= 1
        had = Counter()
        for slot, source in enumerate(mixing.one_period(parts), 1):
            had[source] += 1
            assert all(abs(had[s] - Fraction(p * slot, 400)) < 1 for s, p in enumerate(parts))


def test_whole_parts():
    assert mixing.whole_parts([3, 1], 8) == [6, 2]
    assert mixing.whole_parts([0, 0], 10) == [5, 5]
    assert mixing.whole_parts([0, 0, 1], 10) == [1, 1, 8]
    assert mixing.whole_parts([1, 1, 1], 10) == [4, 3, 3]


@pytest.fixture(scope="module")
def sources(spark):
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    return spark.range(1200).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("x").alias("slot"))


def test_rows_follow_the_schedule(sources):
    targets = {"hot": 5.0, "s1": 3.0, "s2": 2.0, None: 1.0}
    rows = mixing.mixed(sources, targets, block_rows=4, period=60).collect()
    assert sorted(r.position for r in rows) == list(range(1200))
    assert sorted(r.doc_id for r in rows) == list(range(1200))
    assert isinstance(rows[0].slot, int)
    blocks = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.position):
        blocks[r.slot].append(r)
    for slot, held in blocks.items():
        assert len({(r.source, r.block) for r in held}) == 1 and len(held) <= 4
        assert [r.position for r in held] == list(range(held[0].position, held[0].position + len(held)))
    assert [r.slot for r in sorted(rows, key=lambda r: r.position)] == sorted(r.slot for r in rows)
    # While all sources last, each has its share of the blocks.
    names = sorted({r.source for r in rows}, key=lambda s: (s is not None, s or ""))
    parts = mixing.whole_parts([targets.get(s, 0.0) for s in names], max(60, 10 * len(names)))
    had = Counter()
    for n, slot in enumerate(sorted(s for s, held in blocks.items() if held[0].on_target), 1):
        assert slot == n - 1
        had[blocks[slot][0].source] += 1
        assert all(abs(had[s] - Fraction(p * n, sum(parts))) < 1 for s, p in zip(names, parts, strict=True))
    assert n > 50


def test_many_sources(spark):
    """Each source of thousands has its slot, and positions are those of the sorted slots."""
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.pmod(F.hash("id"), F.lit(3000))).alias("source"))
    rows = mixing.mixed(docs, block_rows=2).collect()
    assert sorted(r.position for r in rows) == list(range(60_000))
    ordered = sorted(rows, key=lambda r: r.position)
    assert [r.slot for r in ordered] == sorted(r.slot for r in rows)
    # The operator's own blocks give the same order as its positions.
    by_position = sorted(mixing.mixed(docs).collect(), key=lambda r: r.position)
    assert [r.doc_id for r in mixing.in_mixed_order(docs).collect()] == [r.doc_id for r in by_position]


def test_five_thousand_sources_are_scheduled_in_seconds():
    rnd = random.Random(2)
    sizes = [int(rnd.paretovariate(0.7)) for _ in range(5000)]
    start = time.monotonic()
    parts = mixing.whole_parts([n**0.5 for n in sizes], 50_000)
    slots_of = [[] for _ in parts]
    for slot, i in enumerate(mixing.one_period(parts)):
        slots_of[i].append(slot)
    plan = mixing._Plan(sizes, parts, 16, slots_of)
    spans = plan.spans()
    assert time.monotonic() - start < 20
    assert len(spans) <= 2 * len(sizes)
    assert sum(size * (after - first) for first, after, _, size in spans) == sum(sizes)


@pytest.mark.parametrize("sizes, parts", [([1], [1]), ([33, 7, 120], [5, 3, 2]), ([96, 48, 48], [2, 1, 1]), ([], [])])
def test_turns_start_after_the_rows_before(spark, sizes, parts):
    slots_of = [[] for _ in parts]
    for slot, i in enumerate(mixing.one_period(parts)):
        slots_of[i].append(slot)
    plan = mixing._Plan(sizes, parts, 4, slots_of)
    starts = {r["_turn"]: r.start for r in mixing._turn_starts(spark, plan).collect()}
    n_turns = max((-(-n // (p * 4)) for n, p in zip(sizes, parts, strict=True)), default=0)
    assert starts == {t: sum(min(n, t * p * 4) for n, p in zip(sizes, parts, strict=True)) for t in range(n_turns)}


def test_rows_without_a_key_are_shared_out(spark):
    """A third of the ids null: their rows are ranked in as many parts as the others."""
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    docs = spark.range(30_000).select(key.alias("doc_id"), F.lit("hot").alias("source"), F.hex("id").alias("text"), F.create_map("id", "id").alias("more"))
    placed = mixing.mixed(docs, targets={"hot": 1.0}, block_rows=1)
    rows = placed.collect()
    assert sorted(r.position for r in rows) == list(range(30_000))
    places = [r.position * 256 // 30_000 for r in rows if r.doc_id is None]
    assert max(Counter(places).values()) < 4 * len(places) / 256 and len(set(places)) > 250
    again = mixing.mixed(docs.repartition(7), targets={"hot": 1.0}, block_rows=1).collect()
    assert {r.text: r.position for r in again} == {r.text: r.position for r in rows}


def test_edges(edge, nothing):
    rows = mixing.mixed(edge).collect()
    assert sorted(r.position for r in rows) == list(range(edge.count()))
    assert mixing.mixed(nothing).count() == 0
    ordered = mixing.in_mixed_order(edge.withColumn("position", F.lit("given")))
    assert ordered.columns == [*edge.columns, "position"]
    assert ordered.count() == edge.count()
    ids = [r.doc_id for r in mixing.in_mixed_order(edge).collect()]
    assert ids == [r.doc_id for r in sorted(rows, key=lambda r: r.position)]
