"""Streams with state of their own, and effects per row."""

import json
import os
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybrook.sinks import rows as row_sink
from tallybrook.sources.streams import parquet_stream, text_stream
from tallybrook.streaming import jobs, state
from tallybrook.streaming.runner import finished_batches, read_per_batch, read_state, write_closed, write_per_batch

START = datetime(2024, 1, 1, 10, 0, 0)
CALL = "call string, ts timestamp_ntz"


def at(seconds):
    return START + timedelta(seconds=seconds)


def put(spark, folder, data, schema, order):
    """One more Parquet file in a folder; `order` makes its modification time later."""
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
    for name in set(os.listdir(folder)) - before:
        os.utime(f"{folder}/{name}", (1_700_000_000 + order, 1_700_000_000 + order))


def calls(spark, tmp_path, asked, answered, order=0):
    streams = []
    for name, data in (("asked", asked), ("answered", answered)):
        put(spark, f"{tmp_path}/{name}", [(k, at(s)) for k, s in data], CALL, order)
        streams.append(parquet_stream(spark, f"{tmp_path}/{name}", CALL, max_files=1))
    return streams


def test_calls_are_paired_once_and_open_ones_come_by_timer(spark, tmp_path):
    asked = [("a", 0), ("b", 0), ("c", 5), ("d", 7), ("a", 3), (None, 1), ("late", 9000)]
    answered = [("a", 10), ("a", 11), ("b", 1000), ("c", 1006), ("x", 9)]
    paired = state.call_state(*calls(spark, tmp_path, asked, answered), "call", buckets=3)
    write_closed(paired, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    found = sorted((r["call"], r["cost_ms"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    # `c` was answered too late and `d` never; the watermark has not passed `late`.
    assert found == [("a", 10_000), ("b", 1_000_000), ("c", None), ("d", None)]


def test_pairs_go_on_from_a_checkpoint(spark, tmp_path):
    def run(asked, answered, order):
        paired = state.call_state(*calls(spark, tmp_path, asked, answered, order), "call")
        write_per_batch(paired, lambda b: b, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()

    run([("a", 0), ("b", 2), ("gone", 1)], [("z", 4)], 0)
    run([("c", 20)], [("b", 30), ("c", 22)], 1)
    run([("far", 5000)], [("a", 5)], 2)
    run([("a", 5001)], [("a", 5003)], 3)
    found = sorted(((r["call"], r["cost_ms"]) for r in read_per_batch(spark, f"{tmp_path}/out").collect()), key=str)
    # The key `a` was forgotten after its first call, and is a call again.
    assert found == sorted([("a", 5_000), ("a", 2_000), ("b", 28_000), ("c", 2_000), ("gone", None)], key=str)


def test_unanswered_requests_come_once_no_response_can(spark, tmp_path):
    asked = [("a", 0), ("b", 0), ("b", 1), ("c", 5), ("open", 9000)]
    answered = [("a", 10), ("c", 1006), ("other", 9000)]
    streams = calls(spark, tmp_path, asked, answered)
    write_closed(state.unanswered(*streams, "call"), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r["call"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["b", "c"]


@pytest.mark.parametrize("sizes", [(10, 1), (6, 2), (3, 3)])
def test_ring_windows_equal_brute_force(spark, tmp_path, sizes):
    length, slide = sizes
    random.seed(length)
    files = [[(random.choice("ab"), random.randint(600 * f, 600 * f + 900)) for _ in range(60)] for f in range(5)]
    files.append([("a", 20_000), (None, 19_000)])
    for order, data in enumerate(files):
        put(spark, f"{tmp_path}/in", [(k, at(s)) for k, s in data], CALL, order)
    stream = parquet_stream(spark, f"{tmp_path}/in", CALL, max_files=2)
    windowed = state.ring_windows(stream, "call", lateness="20 minutes", length_minutes=length, slide_minutes=slide)
    write_closed(windowed, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    counts = Counter()
    for k, s in (hit for data in files for hit in data):
        first = s // (60 * slide) * slide
        for back in range(0, length, slide):
            counts[k, at(60 * (first - back))] += 1
    final = at(20_000 - 1200)
    expected = {(k, w): n for (k, w), n in counts.items() if w + timedelta(minutes=length) <= final}
    rows = spark.read.parquet(f"{tmp_path}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    assert len(rows) == len(expected)
    assert {(r["call"], r["window_start"]): r["n"] for r in rows} == expected


def test_ring_needs_whole_slides(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", at(0))], CALL, 0)
    with pytest.raises(ValueError):
        state.ring_windows(parquet_stream(spark, f"{tmp_path}/in", CALL), "call", length_minutes=10, slide_minutes=3)


def access_files(folder, n):
    os.makedirs(folder)
    for i in range(n):
        with open(f"{folder}/{i}.txt", "w") as f:
            f.writelines(f"10.0.0.{m % 2} - - 2023-11-05T{8 + i:02d}:{m:02d}:30.000Z z GET 200 /x\n" for m in range(40))
        os.utime(f"{folder}/{i}.txt", (1_700_000_000, 1_700_000_000))


def test_backlog_is_let_in_by_bytes_and_archived(spark, tmp_path):
    access_files(tmp_path / "in", 6)
    size = os.path.getsize(tmp_path / "in/0.txt")

    def run():
        stream = text_stream(spark, f"{tmp_path}/in", max_bytes=2 * size + 10, archive=f"{tmp_path}/done")
        jobs.access_log_state(stream, f"{tmp_path}/out", f"{tmp_path}/ck", lateness=None, interval=None).awaitTermination()
        kept = read_state(spark, f"{tmp_path}/out", jobs.intervals_of("ip"))
        return kept.agg(F.sum("n")).first()[0]

    assert run() == 240
    assert finished_batches(spark, f"{tmp_path}/out").count() >= 2
    archived = sum(len(files) for _, _, files in os.walk(tmp_path / "done"))
    assert archived > 0 and archived + len(list((tmp_path / "in").glob("*.txt"))) >= 6
    # What has been archived is not read again, and neither is what has been read.
    assert run() == 240


def test_limits_exclude_each_other(spark, tmp_path):
    with pytest.raises(ValueError):
        text_stream(spark, str(tmp_path), max_files=1, max_bytes=1)


def cut_short(folder, flag):
    """A writer that fails in the first attempt of one task, after some rows."""

    class Noted(row_sink.LineFiles):
    
        def __init__(self, folder, flag):
            super().__init__(folder)
            self.flag = flag

        def process(self, row):
            super().process(row)
            if row["id"] == 17 and not os.path.exists(self.flag):
                with open(self.flag, "w"):
                    raise RuntimeError("cut short")

    return Noted(folder, flag)


def lines(folder):
    out = defaultdict(list)
    for name in os.listdir(folder):
        if not name.startswith((".", "_")):
            with open(f"{folder}/{name}") as f:
                out[name] += [json.loads(line)["id"] for line in f]
    return out


def test_row_effects_come_once_per_task_and_epoch(spark, tmp_path):
    numbers = spark.range(40).repartition(3, "id")
    with pytest.raises(Exception, match="cut short"):
        row_sink.for_each_row(numbers, cut_short(f"{tmp_path}/out", f"{tmp_path}/flag"))
    for epoch in (0, 0, 1):
        row_sink.for_each_row(numbers, cut_short(f"{tmp_path}/out", f"{tmp_path}/flag"), epoch)
    found = lines(f"{tmp_path}/out")
    assert not [n for n in os.listdir(f"{tmp_path}/out") if n.startswith("_")]
    for epoch in (0, 1):
        assert sorted(v for n, ids in found.items() if n.startswith(f"epoch-{epoch}-") for v in ids) == list(range(40))


def test_rows_of_a_stream_are_written_once_though_an_epoch_runs_again(spark, tmp_path):
    spark.range(30).repartition(4).write.parquet(f"{tmp_path}/in")
    for attempt in range(2):
        stream = parquet_stream(spark, f"{tmp_path}/in", "id bigint")
        row_sink.write_rows(stream, row_sink.LineFiles(f"file:{tmp_path}/out"), f"{tmp_path}/ck{attempt}").awaitTermination()
    assert sorted(v for ids in lines(f"{tmp_path}/out").values() for v in ids) == list(range(30))


def test_a_writer_may_pass_rows_over(spark):
    class Shut:
        """A writer that takes no rows."""

        def open(self, partition_id, epoch_id):
            return False

        def process(self, row):
            raise AssertionError

        def close(self, error):
            assert error is None

    row_sink.for_each_row(spark.range(5), Shut())


def most_states(query):
    return max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress)


def test_ring_keys_share_states(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(f"k{i}", at(60 * (i % 7))) for i in range(900)] + [("end", at(4000))], CALL, 0)
    windowed = state.ring_windows(parquet_stream(spark, f"{tmp_path}/in", CALL), "call", buckets=8)
    query = write_closed(windowed, f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(rows) == 9000 and len({(r["call"], r["window_start"]) for r in rows}) == 9000
    assert 0 < most_states(query) <= 8
