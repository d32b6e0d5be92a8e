"""Streams over folders of files, compared with the batch operators."""

import os
import shutil
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import behavior, text, windows
from tallybrook.sources.streams import _as_glob, parquet_stream, text_stream
from tallybrook.streaming import jobs
from tallybrook.streaming.runner import (
    State,
    finished_batches,
    latest_state,
    newest_folders,
    read_per_batch,
    read_state,
    stop_after_batch,
    write_closed,
    write_per_batch,
    write_snapshot,
)


@pytest.fixture
def folders(tmp_path):
    place = {n: str(tmp_path / n) for n in ("in", "out", "ck")}
    (tmp_path / "in").mkdir()
    return place


def put(folders, name, content):
    with open(f"{folders['in']}/{name}", "w", encoding="utf-8") as f:
        f.write(content)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_words_and_totals_per_batch(spark, folders):
    put(folders, "1.txt", "river over stone 9\n\nriver  x \n")
    stream = text_stream(spark, folders["in"])
    jobs.words_per_batch(stream, folders["out"], folders["ck"], None).awaitTermination()
    put(folders, "2.txt", "river\n")
    jobs.words_per_batch(stream, folders["out"], folders["ck"], None).awaitTermination()
    found = read_per_batch(spark, folders["out"])
    assert rows(found.where("word = 'river'"), "batch_id", "n") == [(0, 2), (1, 1)]
    assert rows(found.where("batch_id = 0 and word = ''"), "n") == [(2,)]
    total = folders["out"] + "-total"
    jobs.word_total_per_batch(stream, total, folders["ck"] + "-total", None).awaitTermination()
    assert rows(read_per_batch(spark, total), "batch_id", "n") == [(0, 9)]


def test_a_batch_that_runs_twice_leaves_one_result(spark, folders):
    put(folders, "1.txt", "a b a\n")
    for checkpoint in ("ck1", "ck2"):
        stream = text_stream(spark, folders["in"])
        query = jobs.words_per_batch(stream, folders["out"], folders["ck"] + checkpoint, None)
        query.awaitTermination()
    assert rows(read_per_batch(spark, folders["out"]), "word", "n") == [("a", 2), ("b", 1)]


def test_characters_per_batch_equal_batch(spark, folders):
    put(folders, "1.txt", "月夜，月\nab\n")
    stream = text_stream(spark, folders["in"])
    jobs.characters_per_batch(stream, folders["out"], folders["ck"], None).awaitTermination()
    batch = text.char_count(spark.read.text(folders["in"]), exclude=[])
    assert rows(read_per_batch(spark, folders["out"]), "ch", "n") == rows(batch, "ch", "n")


def test_profiles_and_running_totals(spark, folders):
    contents = ["u,VIDEO_DY,x,y\nv,OTHER,x\n", "u,VIDEO_DY,x\nw,VIDEO_DY,z\n"]
    changes = folders["out"] + "-changes"
    for i, content in enumerate(contents):
        put(folders, f"{i}.txt", content)
        stream = text_stream(spark, folders["in"])
        profiles = jobs.profiles_per_batch(stream, folders["out"], folders["ck"], None)
        profiles.awaitTermination()
        totals = jobs.preference_totals(stream, changes, folders["ck"] + "-totals", None)
        totals.awaitTermination()
    found = read_per_batch(spark, folders["out"])
    assert rows(found, "batch_id", "user_id", "profile") == [
        (0, "u", "x:1,y:1"),
        (1, "u", "x:1"),
        (1, "w", "z:1"),
    ]
    state = latest_state(read_per_batch(spark, changes), ["user_id", "info_type"], ["n"])
    batch = behavior.preference_counts(behavior.preferences(spark.read.text(folders["in"])))
    columns = ("user_id", "info_type", "n")
    assert rows(state, *columns) == rows(batch, *columns)


START = datetime(2024, 1, 1, 10, 0, 0)


def hits(spark, folders, minutes_by_file):
    """One Parquet file per list of minutes, in this order; returns the stream."""
    schema = "ip string, ts timestamp_ntz"
    for i, minutes in enumerate(minutes_by_file):
        data = [("ab"[m % 2], START + timedelta(minutes=m)) for m in minutes]
        frame = spark.createDataFrame(data, schema).coalesce(1)
        frame.write.mode("append").parquet(folders["in"])
    return parquet_stream(spark, folders["in"], schema, max_files=1)


def test_closed_windows_equal_batch(spark, folders):
    stream = hits(spark, folders, [range(0, 30), range(30, 60), range(60, 90), [200]])
    closed = jobs.closed_windows(stream, "ip", lateness="30 minutes")
    write_closed(closed, folders["out"], folders["ck"]).awaitTermination()
    found = spark.read.parquet(folders["out"]).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )
    watermark = START + timedelta(minutes=200 - 30)
    every = windows.sliding_counts(spark.read.parquet(folders["in"]), "ip")
    final = every.where(F.col("window_start") + F.expr("interval 10 minutes") <= F.lit(watermark))
    columns = ("window_start", "ip", "n")
    assert rows(found, *columns) == rows(final, *columns)
    assert final.count() > 100


def test_closed_windows_hold_a_count_once(spark, folders):
    """Keys share states, null is a key, and a late row of an interval that is still open counts."""
    schema = "ip string, ts timestamp_ntz"
    many = [(f"k{i}", i % 40) for i in range(3000)]
    for data in [[*many, (None, 5), ("a", 60 + 50 / 60)], [("a", 61)], [("a", 31 + 10 / 60), ("b", 20)], [("a", 200)]]:
        data = [(k, START + timedelta(minutes=m)) for k, m in data]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folders["in"])
    stream = parquet_stream(spark, folders["in"], schema, max_files=1)
    query = write_closed(jobs.closed_windows(stream, "ip", lateness="30 minutes"), folders["out"], folders["ck"])
    query.awaitTermination()
    found = spark.read.parquet(folders["out"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    every = windows.sliding_counts(spark.read.parquet(folders["in"]).where("ip <> 'b' OR ip IS NULL"), "ip")
    final = every.where(F.col("window_start") < F.lit(START + timedelta(minutes=161)))
    columns = ("window_start", "ip", "n")
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(map(tuple, final.select(*columns).collect()))
    # No state has more rows than there are buckets, with one for null.
    assert max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress) <= 1025


def test_window_state_equals_batch(spark, folders):
    stream = hits(spark, folders, [range(0, 15), range(10, 25)])
    query = jobs.interval_state(stream, "ip", folders["out"], folders["ck"], interval=None)
    query.awaitTermination()
    changes = read_per_batch(spark, folders["out"])
    state = read_state(spark, folders["out"], jobs.intervals_of("ip"))
    found = windows.sum_intervals(state, "ip").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )
    batch = windows.sliding_counts(spark.read.parquet(folders["in"]), "ip")
    columns = ("window_start", "ip", "n")
    assert changes.select("batch_id").distinct().count() >= 2
    assert rows(found, *columns) == rows(batch, *columns)


def test_running_counts(spark, folders):
    stream = hits(spark, folders, [range(0, 5), range(5, 20)])
    jobs.running_counts(stream, ["ip"], folders["out"], folders["ck"]).awaitTermination()
    state = latest_state(read_per_batch(spark, folders["out"]), ["ip"], ["n"])
    assert rows(state, "ip", "n") == [("a", 10), ("b", 10)]


def test_stream_joins_a_table(spark, folders):
    stream = hits(spark, folders, [range(0, 5)])
    lookup = spark.createDataFrame([("a", "home"), ("c", "away")], "ip string, place string")
    joined = jobs.with_lookup(stream, lookup, ["ip"], F.col("ts"))
    write_closed(joined, folders["out"], folders["ck"]).awaitTermination()
    assert rows(spark.read.parquet(folders["out"]), "ip", "place") == [("a", "home")] * 3


def test_stream_joins_stream(spark, folders):
    asked = [("a", 0), ("b", 0), ("c", 5), ("d", 7), ("late", 600)]
    answered = [("a", 10), ("b", 1000), ("c", 1006), ("x", 9)]
    streams = []
    for name, calls in (("asked", asked), ("answered", answered)):
        data = [(key, START + timedelta(seconds=s)) for key, s in calls]
        schema = "call string, ts timestamp_ntz"
        spark.createDataFrame(data, schema).write.parquet(f"{folders['in']}/{name}")
        streams.append(parquet_stream(spark, f"{folders['in']}/{name}", schema))
    write_closed(jobs.join_calls(*streams, "call"), folders["out"], folders["ck"]).awaitTermination()
    found = rows(spark.read.parquet(folders["out"]), "call", "cost_ms")
    assert found == [("a", 10_000), ("b", 1_000_000)]


def test_two_streams_per_window(spark, folders):
    stream = hits(spark, folders, [range(0, 30), [300]])
    even = stream.where("minute(ts) % 3 = 0")
    other = stream.where("minute(ts) % 3 <> 0")
    counts = jobs.window_cogroup(even, other, "ip", "ts", "10 minutes", "1 minute")
    write_closed(counts, folders["out"], folders["ck"]).awaitTermination()
    expected = defaultdict(lambda: [0, 0])
    for m in range(30):
        start = START + timedelta(minutes=m - m % 10)
        expected[start, "ab"[m % 2]][0 if m % 3 == 0 else 1] += 1
    found = spark.read.parquet(folders["out"])
    assert rows(found, "window_start", "ip", "n_left", "n_right") == sorted(
        (s, k, a, b) for (s, k), (a, b) in expected.items()
    )


def test_stop_after_batch(spark, folders):
    put(folders, "1.txt", "a b\n")
    query = jobs.words_per_batch(
        text_stream(spark, folders["in"]), folders["out"], folders["ck"], "1 second"
    )
    query.processAllAvailable()
    stop_after_batch(query)
    assert not query.isActive
    assert rows(read_per_batch(spark, folders["out"]), "word", "n") == [("a", 1), ("b", 1)]


def test_state_is_read_from_the_snapshot_and_what_follows(spark, folders):
    stream = hits(spark, folders, [range(0, 4), range(4, 8), range(8, 12), range(12, 16), range(16, 19)])
    counts = stream.groupBy("ip").agg(F.count(F.lit(1)).alias("n"))
    state = State(("ip",), ("n",), every=2)
    write_per_batch(counts, lambda b: b, folders["out"], folders["ck"], None, "update", state).awaitTermination()
    through, batches = newest_folders(spark, folders["out"])
    assert through == 3 and [b.rsplit("=", 1)[1] for b in batches] == ["4"]
    # The folders before the snapshot are not read: the state is whole without them.
    for n in range(4):
        shutil.rmtree(f"{folders['out']}/batch_id={n}")
    assert rows(read_state(spark, folders["out"], state), "ip", "n") == [("a", 10), ("b", 9)]
    write_snapshot(spark, folders["out"], 4, State(("ip",), ("n",), keep="ip = 'a'"))
    assert newest_folders(spark, folders["out"]) == (4, [])
    assert rows(read_state(spark, folders["out"], state), "ip", "n") == [("a", 10)]
    with pytest.raises(ValueError):
        read_state(spark, folders["out"] + "-none", state)


def test_what_was_cut_short_is_not_read(spark, folders):
    stream = hits(spark, folders, [range(0, 4), range(4, 8), range(8, 11)])
    counts = stream.groupBy("ip").agg(F.count(F.lit(1)).alias("n"))
    state = State(("ip",), ("n",), every=2)
    write_per_batch(counts, lambda b: b, folders["out"], folders["ck"], None, "update", state).awaitTermination()
    assert newest_folders(spark, folders["out"])[0] == 1
    # A snapshot whose job ended before it was listed, and a batch that ended before its note.
    spark.createDataFrame([("a", 99)], "ip string, n bigint").write.parquet(f"{folders['out']}-state/through=2")
    spark.createDataFrame([("a", 99)], "ip string, n bigint").write.parquet(f"{folders['out']}/batch_id=3")
    through, batches = newest_folders(spark, folders["out"])
    assert through == 1 and [b.rsplit("=", 1)[1] for b in batches] == ["2"]
    assert rows(read_state(spark, folders["out"], state), "ip", "n") == [("a", 6), ("b", 5)]
    assert rows(finished_batches(spark, folders["out"]), "batch_id", "n_rows", "n_late") == [(0, 2, 0), (1, 2, 0), (2, 2, 0)]
    assert rows(read_per_batch(spark, folders["out"]).select("batch_id").distinct(), "batch_id") == [(0,), (1,), (2,)]
    write_snapshot(spark, folders["out"], 2, state)
    assert newest_folders(spark, folders["out"]) == (2, [])
    assert rows(read_state(spark, folders["out"], state), "ip", "n") == [("a", 6), ("b", 5)]


def test_all_files_are_one_batch_unless_limited(spark, folders):
    for i in range(1100):
        put(folders, f"{i}.txt", "w\n")
    jobs.word_total_per_batch(text_stream(spark, folders["in"]), folders["out"], folders["ck"], None).awaitTermination()
    assert rows(read_per_batch(spark, folders["out"]), "batch_id", "n") == [(0, 1100)]
    limited = folders["out"] + "-limited"
    stream = text_stream(spark, folders["in"], max_files=600)
    jobs.word_total_per_batch(stream, limited, folders["ck"] + "-limited", None).awaitTermination()
    assert rows(read_per_batch(spark, limited), "batch_id", "n") == [(0, 600), (1, 500)]


def test_a_repeated_call_gives_one_cost(spark, folders):
    schema = "call string, ts timestamp_ntz"
    streams = []
    for name, seconds in (("asked", (0, 1, 2)), ("answered", (10, 11))):
        data = [("a", START + timedelta(seconds=s)) for s in seconds]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folders['in']}/{name}")
        streams.append(parquet_stream(spark, f"{folders['in']}/{name}", schema))
    write_closed(jobs.join_calls(*streams, "call"), folders["out"], folders["ck"]).awaitTermination()
    assert spark.read.parquet(folders["out"]).count() == 1


def access_files(folders, times):
    """Three files of access lines, ten minutes further on each, with these modification times."""
    for i in range(3):
        lines = [f"10.0.0.{m % 2} - - 2023-11-05T08:{m:02d}:30.000Z z GET 200 /x" for m in range(10 * i, 10 * i + 12)]
        put(folders, f"{i}.txt", "\n".join(lines) + "\n")
        os.utime(f"{folders['in']}/{i}.txt", (times[i], times[i]))


def access_windows(spark, folders, lateness="10 minutes"):
    stream = text_stream(spark, folders["in"], max_files=1)
    jobs.access_log_state(stream, folders["out"], folders["ck"], lateness, interval=None).awaitTermination()
    state = read_state(spark, folders["out"], jobs.intervals_of("ip"))
    return rows(windows.sum_intervals(state, "ip"), "window_start", "ip", "n")


def access_batch(spark, folders):
    batch = windows.sliding_counts(windows.timed_access_hits(spark.read.text(folders["in"])), "ip")
    return rows(batch, "window_start", "ip", "n")


def test_access_log_stream_equals_batch(spark, folders):
    access_files(folders, [1_700_000_000, 1_700_000_060, 1_700_000_120])
    assert access_windows(spark, folders) == access_batch(spark, folders)
    assert rows(finished_batches(spark, folders["out"]), "batch_id", "n_rows", "n_late") == [(b, 12, 0) for b in range(3)]


def test_late_lines_are_counted_apart(spark, folders):
    # The newest file first: of the others, lines more than ten minutes before 08:31:30 are late.
    access_files(folders, [1_700_000_120, 1_700_000_060, 1_700_000_000])
    found = access_windows(spark, folders)
    notes = rows(finished_batches(spark, folders["out"]), "batch_id", "n_rows", "n_late")
    assert notes == [(0, 12, 0), (1, 12, 11), (2, 12, 12)]
    assert {r["newest"] for r in finished_batches(spark, folders["out"]).collect()} == {datetime(2023, 11, 5, 8, 31, 30)}
    kept = read_per_batch(spark, folders["out"])
    assert kept.where("late").agg(F.sum("n")).first()[0] == 23
    assert sum(n for *_, n in found) == 10 * 13


def test_files_of_one_time_lose_nothing_without_a_bound(spark, folders):
    access_files(folders, [1_700_000_000] * 3)
    assert access_windows(spark, folders, lateness=None) == access_batch(spark, folders)
    assert {r["n_late"] for r in finished_batches(spark, folders["out"]).collect()} == {0}


def test_a_pattern_stays_a_pattern():
    assert _as_glob("/x/*") == "/x/*" and _as_glob("/x/ab") == "/x/a[b]"


def test_blank_lines_per_batch(spark, folders):
    put(folders, "1.txt", "ab\n\n\n")
    stream = text_stream(spark, folders["in"])
    jobs.characters_per_batch(stream, folders["out"], folders["ck"], None, blank_lines=True).awaitTermination()
    assert rows(read_per_batch(spark, folders["out"]), "ch", "n") == [("", 2), ("a", 1), ("b", 1)]
