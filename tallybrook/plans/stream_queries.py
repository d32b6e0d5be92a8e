"""Registered queries: streaming jobs run to the end of the given tables.

Each reads its table as a stream of files, writes batch results under the
shared folder, and returns them. The stream runs when the query is called; its
folder stays until `session.remove_runs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.operators import relational, windows
from tallybrook.plans import tables as t
from tallybrook.plans.log_queries import PROFILE_SQL, PREFERENCE_SQL, sliding_sql
from tallybrook.plans.tables import Query, table
from tallybrook.plans.text_queries import WORDS_SQL
from tallybrook.session import run_dir
from tallybrook.sinks import rows
from tallybrook.sinks.files import write_lines
from tallybrook.sources.streams import parquet_stream, text_stream
from tallybrook.streaming import jobs, state
from tallybrook.streaming.runner import (
    State,
    read_per_batch,
    read_state,
    write_closed,
    write_per_batch,
)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return parquet_stream(spark, path, table(spark, sf_dir, name).schema)


def _run(spark: SparkSession, name: str, start) -> DataFrame:
    """Start a job with its own output and checkpoint, wait, return its batches."""
    folder = run_dir(spark, name)
    start(f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_per_batch(spark, f"{folder}/out")


def _run_state(spark: SparkSession, name: str, kept: State, start) -> DataFrame:
    """Start a job, wait, and return the values that its batches add up to."""
    folder = run_dir(spark, name)
    start(f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_state(spark, f"{folder}/out", kept)


INTERVALS = jobs.intervals_of("ip")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _stream(spark, sf_dir, "documents")
    return _run(spark, "words", lambda out, ck: jobs.words_per_batch(docs, out, ck, None, "text"))


STREAM_WORDS_SQL = f"""
SELECT CAST(0 AS BIGINT) AS batch_id, word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word
"""


def stream_char_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = _stream(spark, sf_dir, "conversations")
    return _run(
        spark, "characters", lambda out, ck: jobs.characters_per_batch(talk, out, ck, None, "text")
    )


STREAM_CHARS_SQL = """
SELECT CAST(0 AS BIGINT) AS batch_id, ch, count(*) AS n
FROM (SELECT unnest(string_split(replace(text, chr(10), ''), '')) AS ch FROM conversations)
WHERE ch <> '' GROUP BY ch
"""


def stream_word_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _stream(spark, sf_dir, "documents")
    return _run(
        spark, "total", lambda out, ck: jobs.word_total_per_batch(docs, out, ck, None, "text")
    )


STREAM_TOTAL_SQL = f"SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n FROM ({WORDS_SQL})"


def stream_user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = t.behavior_messages(_stream(spark, sf_dir, "events"))
    return _run(
        spark, "profiles", lambda out, ck: jobs.profiles_per_batch(messages, out, ck, None)
    )


STREAM_PROFILES_SQL = f"SELECT CAST(0 AS BIGINT) AS batch_id, * FROM ({PROFILE_SQL})"


def stream_preference_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = t.behavior_messages(_stream(spark, sf_dir, "events"))
    return _run_state(
        spark,
        "preferences",
        State(("user_id", "info_type"), ("n",)),
        lambda out, ck: jobs.preference_totals(messages, out, ck, None),
    )


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    return _run_state(
        spark,
        "running",
        State(("event_type",), ("n",)),
        lambda out, ck: jobs.running_counts(events, ["event_type"], out, ck),
    )


RUNNING_SQL = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"


def stream_ip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.access_log_lines(_stream(spark, sf_dir, "events"))
    hits = windows.access_hits(lines, keep=["ts"])
    found = _run_state(
        spark,
        "windows",
        INTERVALS,
        lambda out, ck: jobs.interval_state(hits, "ip", out, ck, interval=None),
    )
    counts = windows.sum_intervals(found, "ip")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding counts per address from a directory of text files, by the time in each line."""
    folder = run_dir(spark, "access-lines")
    write_lines(t.access_log_lines(table(spark, sf_dir, "events")).select("value"), folder)
    found = _run_state(
        spark,
        "access",
        INTERVALS,
        lambda out, ck: jobs.access_log_state(text_stream(spark, folder), out, ck, interval=None),
    )
    counts = windows.sum_intervals(found, "ip")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_text_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per batch from a directory of text files."""
    folder = run_dir(spark, "text-lines")
    write_lines(table(spark, sf_dir, "documents").select(F.col("text").alias("value")), folder)
    stream = text_stream(spark, folder)
    return _run(spark, "text-words", lambda out, ck: jobs.words_per_batch(stream, out, ck, None))


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows that the watermark has passed, each written once."""
    folder = run_dir(spark, "closed")
    windowed = jobs.closed_windows(_stream(spark, sf_dir, "events"), "user_id")
    write_closed(windowed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    counts = spark.read.parquet(f"{folder}/out")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


CLOSED_SQL = f"""
SELECT * FROM ({sliding_sql("FROM events", "user_id")})
WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
"""


def stream_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per customer segment of each batch."""
    events = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_id")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = jobs.with_lookup(events, customers, ["c_custkey"], F.col("event_id"))
    return _run(
        spark,
        "lookup",
        lambda out, ck: write_per_batch(
            joined, lambda b: relational.count_by_key(b, "c_mktsegment"), out, ck
        ),
    )


STREAM_LOOKUP_SQL = """
SELECT CAST(0 AS BIGINT) AS batch_id, c_mktsegment, count(*) AS n
FROM events JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment
"""


def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of two streams: an event starts one, its value is the cost in millis."""
    events = _stream(spark, sf_dir, "events")
    millis = F.floor("value").cast("decimal(18,3)") / 1000
    later = F.col("ts") + F.make_dt_interval(secs=millis.cast("decimal(18,6)"))
    responses = _stream(spark, sf_dir, "events").select("event_id", later.alias("ts"))
    costs = jobs.join_calls(events, responses, "event_id")
    found = _run(
        spark, "join", lambda out, ck: write_per_batch(costs, lambda b: b, out, ck)
    )
    return found.drop("batch_id")


STREAM_JOIN_SQL = "SELECT event_id, CAST(floor(value) AS BIGINT) AS cost_ms FROM events"


def stream_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases per user and day, from two streams."""
    clicks = _stream(spark, sf_dir, "events").where("event_type = 'click'")
    purchases = _stream(spark, sf_dir, "events").where("event_type = 'purchase'")
    counts = jobs.window_cogroup(clicks, purchases, "user_id", "ts", "1 day", "1 hour")
    kept = State(("window_start", "user_id"), ("n_left", "n_right"))
    found = _run_state(
        spark,
        "cogroup",
        kept,
        lambda out, ck: write_per_batch(counts, lambda b: b, out, ck, None, "update", kept),
    )
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


STREAM_COGROUP_SQL = """
SELECT date_trunc('day', ts) AS window_start, user_id,
       count(*) FILTER (WHERE event_type = 'click') AS n_left,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_right
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL
"""


def _calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Requests, one per event, and responses, of all but errors, as many millis later as the value says."""
    events = _stream(spark, sf_dir, "events")
    millis = F.floor("value").cast("decimal(18,3)") / 1000
    later = F.col("ts") + F.make_dt_interval(secs=millis.cast("decimal(18,6)"))
    responses = _stream(spark, sf_dir, "events").where("event_type <> 'error'")
    return events.select("event_id", "ts"), responses.select("event_id", later.alias("ts"))


# When the watermark of both streams ends: ten minutes before the newest time, or the older of the two.
_LAST = "max(ts + to_milliseconds(CAST(floor(value) AS BIGINT))) FILTER (WHERE event_type <> 'error')"
_BOUND = f"INTERVAL {C.MAX_COST_MS} MILLISECOND + INTERVAL 10 MINUTE"


def stream_pair_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost of every call, and calls left open, from one state per call."""
    calls = state.call_state(*_calls(spark, sf_dir), "event_id")
    found = _run(spark, "pairs", lambda out, ck: write_per_batch(calls, lambda b: b, out, ck))
    return found.drop("batch_id")


PAIR_STATE_SQL = f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS cost_ms FROM events
WHERE event_type <> 'error' OR ts + {_BOUND} < (SELECT greatest(max(ts), {_LAST}) FROM events)
"""


def stream_unanswered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests to which no response came in time, by an outer join of the two streams."""
    requests = state.unanswered(*_calls(spark, sf_dir), "event_id")
    found = _run(spark, "unanswered", lambda out, ck: write_per_batch(requests, lambda b: b, out, ck))
    return found.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


UNANSWERED_SQL = f"""
SELECT event_id, ts FROM events
WHERE event_type = 'error' AND ts + {_BOUND} < (SELECT least(max(ts), {_LAST}) FROM events)
"""


def stream_ring_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows that the watermark has passed, from a ring of counts per user."""
    folder = run_dir(spark, "ring")
    windowed = state.ring_windows(_stream(spark, sf_dir, "events"), "user_id")
    write_closed(windowed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    counts = spark.read.parquet(f"{folder}/out")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access lines of a backlog of files, let in by bytes, counted in any order, and archived when done."""
    folder = run_dir(spark, "backlog")
    lines = t.access_log_lines(table(spark, sf_dir, "events")).select("value")
    write_lines(lines.repartition(BACKLOG_FILES), f"{folder}/in")
    counted = _run_state(
        spark,
        "backlog-counts",
        INTERVALS,
        lambda out, ck: jobs.access_log_state(
            text_stream(spark, f"{folder}/in", max_bytes=BACKLOG_BYTES, archive=f"{folder}/done"),
            out, ck, lateness=None, interval=None,
        ),
    )
    counts = windows.sum_intervals(counted, "ip")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


BACKLOG_FILES, BACKLOG_BYTES = 4, 64 << 20


def stream_foreach_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events handed row by row to a writer with set-up and clean-up; each epoch runs twice."""
    folder = run_dir(spark, "rows")
    events = _stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for attempt in range(2):
        # A new checkpoint begins the epochs anew, as after a failure that lost it.
        rows.write_rows(events, rows.LineFiles(f"{folder}/out"), f"{folder}/checkpoint-{attempt}").awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint, event_type string").json(f"{folder}/out")


FOREACH_SQL = "SELECT event_id, user_id, event_type FROM events"


QUERIES = {
    "stream_word_count": Query(stream_word_count, STREAM_WORDS_SQL),
    "stream_char_count": Query(stream_char_count, STREAM_CHARS_SQL),
    "stream_word_total": Query(stream_word_total, STREAM_TOTAL_SQL),
    "stream_user_profile": Query(stream_user_profile, STREAM_PROFILES_SQL),
    "stream_preference_totals": Query(stream_preference_totals, PREFERENCE_SQL),
    "stream_running_count": Query(stream_running_count, RUNNING_SQL),
    "stream_ip_count": Query(stream_ip_count, sliding_sql(t.ACCESS_SQL, "ip")),
    "stream_access_log": Query(stream_access_log, sliding_sql(t.ACCESS_SQL, "ip")),
    "stream_text_words": Query(stream_text_words, STREAM_WORDS_SQL),
    "stream_closed_windows": Query(stream_closed_windows, CLOSED_SQL),
    "stream_ring_windows": Query(stream_ring_windows, CLOSED_SQL),
    "stream_pair_state": Query(stream_pair_state, PAIR_STATE_SQL),
    "stream_unanswered": Query(stream_unanswered, UNANSWERED_SQL),
    "stream_backlog": Query(stream_backlog, sliding_sql(t.ACCESS_SQL, "ip")),
    "stream_foreach_rows": Query(stream_foreach_rows, FOREACH_SQL),
    "stream_lookup_join": Query(stream_lookup_join, STREAM_LOOKUP_SQL),
    "stream_join": Query(stream_join, STREAM_JOIN_SQL),
    "stream_cogroup": Query(stream_cogroup, STREAM_COGROUP_SQL),
}
