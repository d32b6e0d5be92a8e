"""Reducers and partitioners that a caller brings along."""

import math
import random
import time
from collections import defaultdict
from functools import reduce as fold

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import reduce


def test_own_reducer_equals_a_fold(spark):
    random.seed(2)
    rows = [(random.choice(["hot"] * 8 + [f"k{i}" for i in range(40)] + [None]), random.randint(1, 5), 6 * random.randint(1, 99)) for _ in range(5000)]
    rows += [("none", 1, None), ("hot", 1, None)]
    frame = spark.createDataFrame(rows, "k string, part int, v bigint").repartition(7)
    expected = defaultdict(list)
    for k, part, v in rows:
        expected[k, part].append(v)
    expected = {k: fold(math.gcd, [v for v in vs if v is not None]) if any(vs) else None for k, vs in expected.items()}
    for held in (100_000, 3):
        found = reduce.reduce_by_key(frame, ["k", "part"], "v", math.gcd, held_keys=held).collect()
        assert len(found) == len(expected)
        assert {(r.k, r.part): r.v for r in found} == expected


def test_values_of_other_types(spark):
    rows = [("a", ["x", "y"]), ("a", ["y", "z"]), ("b", []), ("b", None)]
    frame = spark.createDataFrame(rows, "k string, v array<string>")
    found = reduce.reduce_by_key(frame, ["k"], "v", lambda a, b: sorted({*a, *b}))
    assert {r.k: r.v for r in found.collect()} == {"a": ["x", "y", "z"], "b": []}
    assert reduce.reduce_by_key(frame.where("false"), ["k"], "v", max).collect() == []


def test_one_shuffle_and_a_hot_key_arrives_combined(spark):
    frame = spark.range(20_000).repartition(6).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    result = reduce.reduce_by_key(frame, ["k"], "v", max)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") == 1
    assert [tuple(r) for r in result.collect()] == [("hot", 19_999)]


def test_rows_go_to_the_parts_they_name(spark):
    rows = spark.range(100).withColumn("law", F.when(F.col("id") != 50, F.col("id") * 7 - 20))
    dealt = reduce.partitioned(rows, F.col("law"), 9)
    found = {r.id: r.p for r in dealt.withColumn("p", F.spark_partition_id()).collect()}
    assert found == {i: 0 if i == 50 else (i * 7 - 20) % 9 for i in range(100)}
    with pytest.raises(ValueError):
        reduce.partitioned(rows, F.col("law"), 0)


def test_a_late_match_does_not_wait_for_the_rest(spark):
    rows = spark.range(0, 4, 1, 4).withColumn("name", F.concat(F.lit("n"), "id"))

    def slow(row):
        # The last task has the match; the others would take a minute each.
        time.sleep(1 if row["id"] == 3 else 60)
        return row["id"] == 3

    started = time.monotonic()
    found = reduce.any_match(rows, slow)
    assert (found["id"], found["name"]) == (3, "n3")
    assert time.monotonic() - started < 40


def test_matches_by_column_and_none(spark):
    rows = spark.range(1000).repartition(5)
    assert reduce.any_match(rows, F.col("id") == 777)["id"] == 777
    assert reduce.any_match(rows, F.col("id") > 1000) is None
    assert reduce.any_match(rows.where("false"), lambda row: True) is None


def test_a_failing_predicate_fails_the_search(spark):
    with pytest.raises(Exception, match="ZeroDivisionError"):
        reduce.any_match(spark.range(3), lambda row: 1 // 0)
