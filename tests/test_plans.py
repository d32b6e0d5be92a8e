"""What the plans must keep: one parse, pruned scans, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import logs, relational, windows
from tallybrook.plans.catalogue import QUERIES
from tallybrook.session import SETTINGS
from tallybrook.sources import files


@pytest.fixture
def plan(capsys):
    def show(frame):
        capsys.readouterr()
        frame.explain()
        return capsys.readouterr().out

    return show


def test_a_log_line_is_parsed_once(spark, tmp_path, plan):
    (tmp_path / "x.log").write_text("{}\n")
    calls = logs.good_calls(logs.parse_call_lines(files.text_lines(spark, str(tmp_path))))
    shown = plan(logs.cost_report(logs.in_cost_range(logs.pair_cost(calls, ["uri", "context"]))))
    assert shown.count("from_json(") == 1
    assert "StringContains(value,@P)" in shown
    assert len(re.findall(r"Exchange (hash|range)partitioning", shown)) == 3


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("latency_report", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("char_count", "text:string"),
        ("sliding_count", "ts:timestamp_ntz,user_id:bigint"),
        ("topn_orders", "o_orderkey:bigint,o_custkey:bigint,o_totalprice:double"),
        ("distinct_types", "event_type:string"),
    ],
)
def test_scans_read_only_the_columns_used(spark, sf_dir, plan, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name].run(spark, sf_dir)))
    assert schemas == [columns]


def test_filters_reach_the_scan(spark, sf_dir, plan):
    shown = plan(QUERIES["cogroup_counts"].run(spark, sf_dir))
    assert "EqualTo(event_type,click)" in shown and "EqualTo(event_type,purchase)" in shown
    shown = plan(QUERIES["keyword_sentences"].run(spark, sf_dir))
    assert "StringContains(text,th)" in shown


def test_listing_does_not_read_contents(spark, tmp_path, plan):
    (tmp_path / "x.txt").write_text("x")
    assert "content" not in plan(files.listing(spark, str(tmp_path)))


def test_sliding_windows_shuffle_intervals_only(spark, plan):
    rows = spark.createDataFrame([], "ip string, ts timestamp")
    shown = plan(windows.sliding_counts(rows, "ip"))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", shown)
    assert len(exchanges) == 2 and "_block" in exchanges[0]


def test_facts_are_summed_before_the_join(spark, sf_dir, plan):
    shown = plan(QUERIES["lookup_join_sum"].run(spark, sf_dir))
    join = shown.index("Join [")
    assert shown.index("partial_sum(_measure", join) > join


@pytest.mark.parametrize(("name", "scans"), [("sentence_concat", 1), ("cogroup_lists", 2), ("user_profile", 1)])
def test_groups_are_read_once_and_not_joined(spark, sf_dir, plan, name, scans):
    shown = plan(QUERIES[name].run(spark, sf_dir))
    assert shown.count("FileScan") == scans and "Join" not in shown
    if name != "user_profile":
        assert shown.count("Exchange hashpartitioning") == 1


def test_shuffles_begin_with_many_partitions():
    assert int(SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 2000


def test_no_broadcast_is_forced(spark, sf_dir, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("lookup_join_sum", "pair_join", "sentence_concat", "user_profile"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name].run(spark, sf_dir))
        left = spark.range(9).select((F.col("id") % 2).alias("k"), "id")
        joined = relational.salted_join(left, left.limit(1).drop("id"), ["k"], F.col("id"), 3)
        assert "BroadcastHashJoin" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
