from collections import defaultdict

import numpy as np
import pytest

from tallybrook.llm import prefix_forest, queries


def brute(rows, queries_, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.all(np.isfinite(v)) and np.any(v)]
    out = {}
    for q, vector in good:
        if q in queries_:
            scores = [(-(v * vector).sum(), i) for i, v in good if i != q and len(v) == len(vector)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(frame, ids, **options):
    rows = prefix_forest.nearest(frame, frame.where(frame.vec_id.isin(ids)), **options).collect()
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(a, b):
    assert sorted(a) == sorted(b)
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], atol=1e-12)


SCHEMA = "vec_id bigint, embedding array<float>"


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 0.0]), (4, [3.0, 0.1]), (5, None), (6, []),
        (7, [0.0, 0.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [None, 1.0]), (None, [1.0, 1.0]),
        (11, [1.0, 2.0, 3.0]), (12, [0.0, 1.0, 0.0]), (20, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ids = [0, 5, 7, 8, 20, 11, 1]
    same(found(frame, ids, k=3), {q: v for q, v in brute([(i, v if v is None else list(map(lambda x: x, v))) for i, v in rows], ids, 3).items()})
    assert prefix_forest.nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert found(frame.where("vec_id = 0"), [0]) == {}


def test_very_many_equal_vectors(spark):
    rows = [(i, [0.6, 0.8, 0.0] if i % 3 else [float(np.cos(i)), float(np.sin(i)), 0.5]) for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA)
    ids = [0, 1, 20, 40]
    single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    same(found(frame, ids), brute(single, ids, 20))


def test_repeated_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.9, 0.1])], SCHEMA)
    assert [i for i, _ in found(frame, [0])[0]] == [1, 1]


def test_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(prefix_forest, "QUERY_ROWS", 40)
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((30, 24))
    vectors = centres[rnd.integers(0, 30, 4000)] + rnd.standard_normal((4000, 24))
    vectors *= rnd.uniform(0.5, 1.5, (4000, 1))  # lengths differ, so products are not angles
    rows = [(i, v.tolist()) for i, v in enumerate(vectors.astype(np.float32))]
    ids = list(range(0, 4000, 50))
    got = found(spark.createDataFrame(rows, SCHEMA), ids, enough=300)
    expected = brute(rows, set(ids), 20)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in ids])
    assert recall >= 0.9


def test_vectors_are_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(prefix_forest, "QUERY_ROWS", 7)
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.standard_normal(8 if i % 4 else 5).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA)
    single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    ids = list(range(0, 900, 3))
    same(found(frame, ids, enough=100), brute(single, set(ids), 20))
    plan = prefix_forest.nearest(frame, frame.where("vec_id % 3 = 0"))._jdf.queryExecution().optimizedPlan().toString()
    # Queries alone are repeated, once a block.
    assert plan.count("Generate explode") == 1 and "CoGroup" not in plan


def test_the_forest_climbs_until_there_are_enough():
    rnd = np.random.default_rng(1)
    held = prefix_forest.symbols(rnd.standard_normal((500, 16)))
    forest = prefix_forest.Forest(held)
    for enough in (1, 50, 500, 900):
        for i, met in zip(range(5), forest.candidates(held[:5], enough), strict=True):
            assert i in met and len(met) >= min(enough, 500)
    strings = prefix_forest.strings(held)
    (met,) = forest.candidates(held[7:8], 1)
    shared = (strings >> (prefix_forest.SYMBOL_BITS * 0)) == strings[7]
    assert set(np.flatnonzero(shared.any(axis=1))) == set(met)


@pytest.mark.parametrize("table", ["embeddings"])
def test_query_recall(spark, sf_dir, table):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()]
    ids = {i for i, _ in rows if i % 20 == 0}
    expected = brute(rows, ids, 20)
    got = defaultdict(list)
    for r in queries.op9_prefix_forest(spark, sf_dir).collect():
        got[r.query_id].append(r.vec_id)
    assert np.mean([len(set(got[q]) & {i for i, _ in expected[q]}) / 20 for q in ids]) >= 0.9
