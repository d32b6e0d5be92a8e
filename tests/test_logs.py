import json
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import clock, numeric
from tallybrook.operators import behavior, logs, windows

START = datetime(2024, 1, 14, 10, 0, 0)


def line(uri, marker, ms, context="t1", millis=True):
    moment = START + timedelta(milliseconds=ms)
    shape = "%Y-%m-%dT%H:%M:%S" + (f".{moment.microsecond // 1000:03d}" if millis else "") + "Z"
    return json.dumps(
        {
            "logTime": moment.strftime(shape),
            "message": f"{uri} {marker} body",
            "level": "INFO",
            "contextMap": {"trace.id": context},
            "traceId": "x",
        }
    )


def call(uri, start, cost, context):
    return [line(uri, "@P", start, context), line(uri, "@R", start + cost, context)]


def report(frame):
    calls = logs.good_calls(logs.parse_call_lines(frame))
    return logs.cost_report(logs.in_cost_range(logs.pair_cost(calls, ["uri", "context"])))


def test_latency_report(lines):
    values = [
        *call("/a", 0, 100, "1"),
        *call("/a", 50, 101, "2"),
        *call("/a", 50, 101, "3"),
        *call("/b", 0, 1_000_000, "4"),
        *call("/b", 0, 1_000_001, "5"),
        *call("/c", 0, 0, "6"),
        *call("/d#x", 0, 7, "7"),
        line("/a", "@P", 5, "unpaired"),
        *[line("/a", "@P", t, "three") for t in (1, 2, 3)],
        *[line("/a", "@P", t, "four") for t in (1, 2, 3, 9)],
        line("/e", "@P", 0, "8", millis=False),
        line("/e", "@R", 1250, "8"),
        line("/a", "none", 0, "9"),
        "",
        "   ",
        "not json @P",
        '{"logTime":"yesterday","message":"/a @P"}',
    ]
    rows = report(lines(values)).collect()
    assert [(r.uri, r.avg_cost, r.sum_cost, r.n_calls) for r in rows] == [
        ("/b", Decimal("1000000.00"), 1_000_000, 1),
        ("/e", Decimal("1250.00"), 1250, 1),
        ("/a", Decimal("100.67"), 302, 3),
        ("/d", Decimal("7.00"), 7, 1),
    ]
    shown = [r.value for r in logs.report_lines(report(lines(values))).collect()]
    assert shown[2] == "(/a,100.67#302)"
    bad = logs.bad_lines(logs.parse_call_lines(lines(values))).collect()
    assert sorted(r.bad_line for r in bad) == sorted(values[-2:])


def test_results_are_the_same_for_any_partitioning(lines):
    calls = [x for i in range(40) for x in call(f"/u{i % 5}", i, i % 7 + 1, str(i))]
    log = [f"t [{i % 9}] x" for i in range(60)]
    messages = [f"u{i % 4},VIDEO_DY,t{i % 6},t{i % 5}" for i in range(60)]
    jobs = {
        report: calls,
        logs.merchant_count: log,
        lambda frame: behavior.user_profiles(frame).orderBy("user_id", "part"): messages,
    }
    for job, values in jobs.items():
        one, four = (job(lines(values, n)).collect() for n in (1, 4))
        assert one == four and one


def test_context_stays_json_text(lines):
    row = logs.parse_call_lines(lines([line("/a", "@P", 0, "q")])).first()
    assert json.loads(row.context) == {"trace.id": "q"} and row.bad_line is None


def test_missing_message_and_context_pair_up(lines):
    values = ['{"logTime":"2024-01-14T10:00:00Z","level":"@P"}',
              '{"logTime":"2024-01-14T10:00:01Z","level":"@R"}']
    assert [(r.uri, r.sum_cost) for r in report(lines(values)).collect()] == [("", 1000)]


def test_log_time_formats(lines):
    good = {
        "2024-05-22T00:00:02.999Z": 1716336002999,
        "2024-05-22T00:00:02Z": 1716336002000,
        "2024-05-22": None,
        "2024-05-22T00:00:02.9Z": None,
        "2024-05-22T00:00:02.999": None,
        "2024-13-22T00:00:02Z": None,
    }
    frame = lines(list(good)).select(
        "value", clock.epoch_millis(clock.parse_log_time(F.col("value"))).alias("ms")
    )
    assert {r.value: r.ms for r in frame.collect()} == good


def test_log_time_reads_what_the_formats_write(spark):
    frame = spark.sql("SELECT timestamp'2024-05-22 01:02:03.045' AS ts")
    for pattern, kept in ((C.LOG_TIME_FORMAT, 45), (C.LOG_TIME_FORMAT_NO_MILLIS, 0)):
        shown = F.date_format("ts", pattern)
        row = frame.select(
            (clock.epoch_millis(clock.parse_log_time(shown)) % 1000).alias("ms")
        ).first()
        assert row.ms == kept


def test_millis_are_cut_after_subtracting(spark):
    frame = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00.000900' a, timestamp'2024-01-01 00:00:00.002100' b"
    )
    assert frame.select(clock.millis_between(F.col("a"), F.col("b")).alias("d")).first().d == 1


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**9)), min_size=1, max_size=40
    )
)
def test_average_is_half_up(spark, pairs):
    frame = spark.createDataFrame(pairs, "s long, n long")
    rows = frame.select("s", "n", numeric.half_up_average(F.col("s"), F.col("n")).alias("a"))
    for r in rows.collect():
        assert r.a == (Decimal(r.s) / Decimal(r.n)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_average_rounds_once(spark):
    """4,999,999 over a billion is below half a cent, whatever it rounds to in between."""
    frame = spark.createDataFrame([(4_999_999, 10**9)], "s long, n long")
    average = numeric.half_up_average(F.col("s"), F.col("n")).alias("a")
    assert frame.select(average).first().a == Decimal("0.00")


def test_pair_cost_brute_force(spark):
    rows = [(i * 37 % 23, START + timedelta(milliseconds=i * i % 977)) for i in range(60)]
    found = logs.pair_cost(spark.createDataFrame(rows, "k int, ts timestamp"), ["k"]).collect()
    times = defaultdict(list)
    for k, ts in rows:
        times[k].append(ts)
    expected = {
        k: (max(v) - min(v)) // timedelta(milliseconds=1) for k, v in times.items() if len(v) == 2
    }
    assert {r.k: r.cost_ms for r in found} == expected


def test_folded_cost_brute_force(spark):
    rows = [
        (k, START + timedelta(milliseconds=(i * 7919 + k * 31) % 400_000 // (k + 1)))
        for k in range(12)
        for i in range(k * 5 + 1)
    ]
    rows += [(20, START)] * 4 + [(21, START)] * 3
    found = logs.folded_cost(spark.createDataFrame(rows, "k int, ts timestamp"), ["k"]).collect()
    times = defaultdict(list)
    for k, ts in rows:
        times[k].append((ts - datetime(1970, 1, 1)) // timedelta(milliseconds=1))
    expected = {k: reduce(lambda a, b: abs(a - b), sorted(v)) for k, v in times.items()}
    assert {r.k: r.cost_ms for r in found} == expected


def test_merchants(lines):
    values = [
        "2023-11-05T08:15:40.010 [25] </shop>, <3>, <52ms>, end",
        "t [25] </x>",
        "t 25 </x>",
        "t [7] </x>",
        "t  [9] two spaces",
        "t",
        "t   ",
        "",
        None,
    ]
    rows = logs.merchant_count(lines(values)).collect()
    assert [(r.merchant, r.n) for r in rows] == [(None, 4), ("25", 3), ("", 1), ("7", 1)]
    kept = logs.merchant_count(lines(values), drop_null=True).collect()
    assert [(r.merchant, r.n) for r in kept] == [("25", 3), ("", 1), ("7", 1)]


MESSAGES = [
    "u1,VIDEO_DY,music,sport",
    "u1,VIDEO_DY,music",
    "u1,VIDEO_DY",
    "u2,OTHER,music",
    "u2,VIDEO_DY,,a#b,,",
    "u3",
    " ",
    None,
    "u3,VIDEO_DY,,",
]


def test_profiles(lines):
    rows = behavior.user_profiles(lines(MESSAGES)).orderBy("user_id").collect()
    assert [(r.user_id, r.part, r.n_types, r.profile) for r in rows] == [
        ("u1", 0, 2, "music:2,sport:1"),
        ("u2", 0, 1, "a#b:1"),
    ]


def test_profile_of_very_many_types_is_whole(lines):
    counts = behavior.preference_counts(
        behavior.preferences(lines([f"u,VIDEO_DY,t{i},t{i % 10}" for i in range(300)]))
    )
    assert behavior.profiles(counts).count() == 1
    rows = behavior.profiles(counts, parts=6).collect()
    assert len(rows) == 6
    found = sorted(t for r in rows for t in r.profile.split(","))
    assert found == sorted(f"t{i}:{31 if i < 10 else 1}" for i in range(300))


def test_access_hits(lines):
    values = [
        "1.1.1.1 b c d e f g /path more",
        "1.1.1.2 b c d e f g path",
        "1.1.1.3 b c d e f /g",
        "1.1.1.4 b c d e f g /",
    ]
    rows = windows.access_hits(lines(values)).collect()
    assert sorted(r.ip for r in rows) == ["1.1.1.1", "1.1.1.4"]


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 400 * 60)), min_size=1, max_size=60),
    st.sampled_from([(10, 1), (6, 2), (60, 15), (3, 3)]),
    st.sampled_from(["timestamp", "timestamp_ntz"]),
)
def test_sliding_counts_brute_force(spark, hits, shape, kind):
    length, slide = shape
    midnight = datetime(2024, 1, 14)
    rows = [(k, midnight + timedelta(seconds=s)) for k, s in hits]
    frame = spark.createDataFrame(rows, f"ip string, ts {kind}")
    result = windows.sliding_counts(frame, "ip", "ts", length, slide)
    found = [(r.window_start, r.ip, r.n) for r in result.collect()]
    expected = defaultdict(int)
    for k, t in rows:
        own = t - timedelta(seconds=(t - midnight).total_seconds() % (slide * 60))
        for back in range(0, length, slide):
            expected[own - timedelta(minutes=back), k] += 1
    assert sorted(found) == sorted((*key, n) for key, n in expected.items())


def test_sliding_counts_of_a_hot_key(spark):
    frame = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 0, id % 997) AS ip",
        "timestamp_ntz'2024-01-14' + make_dt_interval(0, 0, 0, id % 7200) AS ts",
    )
    found = windows.sliding_counts(frame, "ip")
    plain = frame.groupBy(F.window("ts", "10 minutes", "1 minute").start.alias("window_start"), "ip")
    expected = plain.agg(F.count("*").alias("n"))
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_unpaired_calls_are_counted(spark):
    calls = [("/a", "1"), ("/a", "1"), ("/a", "2"), ("/b", "1"), ("/b", "1"), ("/b", "1"), ("/b", "4")]
    frame = spark.createDataFrame(calls, "uri string, context string")
    rows = logs.unpaired(frame, ["uri", "context"]).collect()
    assert {r.uri: (r.n_keys, r.n_lines) for r in rows} == {"/a": (1, 1), "/b": (2, 4)}


def test_only_the_fields_asked_for_are_parsed(lines, capsys):
    line = '{"logTime":"2023-11-05T08:15:40.010Z","message":"/a @P","level":"INFO","contextMap":{"t":1},"traceId":"x"}'
    whole = logs.parse_call_lines(lines([line])).first()
    few = logs.parse_call_lines(lines([line]), fields=logs.CALL_FIELDS)
    assert few.first() == whole.__class__(**(whole.asDict() | {"level": None, "trace_id": None}))
    few.explain()
    assert "traceId" not in capsys.readouterr().out


def test_timed_access_hits(lines):
    values = [
        "10.1.1.1 - - 2023-11-05T08:15:40.010Z z GET 200 /x",
        "10.1.1.2 - - yesterday z GET 200 /x",
        "10.1.1.3 - - 2023-11-05T08:15:41Z z GET 200 x",
        "",
    ]
    rows = windows.timed_access_hits(lines(values)).collect()
    assert [(r.ip, str(r.ts)) for r in rows] == [("10.1.1.1", "2023-11-05 08:15:40.010000")]
