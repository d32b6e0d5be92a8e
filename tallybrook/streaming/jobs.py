"""The streaming jobs."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybrook import constants as C
from tallybrook.functions import clock
from tallybrook.operators import behavior, relational, text, windows
from tallybrook.streaming import state
from tallybrook.streaming.runner import State, write_per_batch, write_timed_batches


def words_per_batch(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = C.DIRECTORY_INTERVAL,
    column: str = "value",
) -> StreamingQuery:
    """Word counts of each micro-batch by itself."""
    return write_per_batch(
        lines, lambda batch: text.word_count(batch, column), out, checkpoint, interval
    )


def characters_per_batch(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = C.DIRECTORY_INTERVAL,
    column: str = "value",
    blank_lines: bool = False,
) -> StreamingQuery:
    """Character counts of each micro-batch by itself, marks included.

    With `blank_lines`, lines without a character are counted under the empty string.
    """
    return write_per_batch(
        lines,
        lambda batch: text.char_count(batch, column, exclude=[], blank_lines=blank_lines),
        out,
        checkpoint,
        interval,
    )


def word_total_per_batch(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = C.KAFKA_INTERVAL,
    column: str = "value",
) -> StreamingQuery:
    """One total of words for each micro-batch."""
    return write_per_batch(
        lines,
        lambda batch: text.words(batch, column).agg(F.count(F.lit(1)).alias("n")),
        out,
        checkpoint,
        interval,
    )


def profiles_per_batch(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = C.BEHAVIOR_INTERVAL,
    column: str = "value",
) -> StreamingQuery:
    """User-preference profiles of each micro-batch by itself."""
    return write_per_batch(
        messages, lambda batch: behavior.user_profiles(batch, column), out, checkpoint, interval
    )


def preference_totals(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = C.BEHAVIOR_INTERVAL,
    column: str = "value",
) -> StreamingQuery:
    """Preference counts since the start: the changed counts of every batch."""
    counts = behavior.preference_counts(behavior.preferences(messages, column))
    kept = State(("user_id", "info_type"), ("n",))
    return write_per_batch(counts, lambda batch: batch, out, checkpoint, interval, "update", kept)


def running_counts(
    rows: DataFrame, keys: list[str], out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Rows per key since the start: the changed counts of every batch."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    kept = State(tuple(keys), ("n",))
    return write_per_batch(counts, lambda batch: batch, out, checkpoint, interval, "update", kept)


def _timed(rows: DataFrame, ts: str, lateness: str, *keep: str) -> DataFrame:
    """Times with a watermark. Times without a zone are taken as session time."""
    return rows.select(F.col(ts).cast("timestamp").alias(ts), *keep).withWatermark(ts, lateness)


# Counts per interval: what batches add, without the rows that came late.
def intervals_of(key: str) -> State:
    return State(("interval_start", key), ("n",), adds=True, aside="late")


def interval_state(
    rows: DataFrame,
    key: str,
    out: str,
    checkpoint: str,
    ts: str = "ts",
    lateness: str | None = "10 minutes",
    slide_minutes: int = C.WINDOW_SLIDE_MINUTES,
    interval: str | None = C.ACCESS_LOG_INTERVAL,
) -> StreamingQuery:
    """Counts per key and slide interval: what every batch adds to them.

    `read_state` with `intervals_of(key)` sums them up, and `windows.sum_intervals` gives
    the sliding windows; keeping the windows would hold every count once per window.

    A row is late where its time is more than `lateness` before the newest time of all
    earlier batches; within a batch no row is. Late rows are counted apart: they stay in
    their batch with `late` set and count in no window, and `finished_batches` has their
    number. With no `lateness` every row counts, whenever it comes. Files are taken in the
    order of their modification times, and those of one time in any order; so files that
    may hold times further apart than `lateness` need distinct times, or no bound.
    """

    def counts(batch: DataFrame, newest: Column | None) -> DataFrame:
        times = batch.select(F.col(ts).cast("timestamp").alias("_ts"), key).where("_ts IS NOT NULL")
        late = F.lit(False)
        if lateness is not None and newest is not None:
            late = F.col("_ts") < newest - F.expr(f"INTERVAL {lateness}")
        start = F.window("_ts", f"{slide_minutes} minutes")["start"].alias("interval_start")
        return times.groupBy(start, key, late.alias("late")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_ts").alias("newest")
        )

    return write_timed_batches(rows, counts, out, checkpoint, interval, intervals_of(key))


def access_log_state(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    lateness: str | None = "10 minutes",
    interval: str | None = C.ACCESS_LOG_INTERVAL,
) -> StreamingQuery:
    """Access-log lines of a text stream to counts per address and minute, by the time in each line.

    Lines that come too late are counted apart (see `interval_state`).
    """
    return interval_state(windows.timed_access_hits(lines), "ip", out, checkpoint, "ts", lateness, interval=interval)


def closed_windows(
    rows: DataFrame,
    key: str,
    ts: str = "ts",
    lateness: str = "10 minutes",
    length_minutes: int = C.WINDOW_LENGTH_MINUTES,
    slide_minutes: int = C.WINDOW_SLIDE_MINUTES,
) -> DataFrame:
    """(window_start, key, n) as a stream to append: each window once, when it is final.

    Rows that come after the watermark has passed their slide interval are dropped; all
    rows of an interval that is still open count. So the watermark goes by the ends of
    intervals: it is where that of the times is, cut to whole slides, which closes the same
    windows. A lateness that is no multiple of the slide is rounded up to one.
    `state.windows_of_counts` holds each count once, not once per window.
    """
    slide = slide_minutes * 60_000
    wait = -(-pd.Timedelta(lateness) // timedelta(milliseconds=slide)) * slide
    counts = state.interval_counts(rows, key, ts, slide_minutes)
    ends = counts.select(key, "at", "n", F.timestamp_millis(F.col("at") + slide).alias("until"))
    timed = ends.withWatermark("until", f"{wait + slide} milliseconds")
    return state.windows_of_counts(timed, key, length_minutes, slide_minutes)


def with_lookup(
    rows: DataFrame, lookup: DataFrame, on: list[str], spread: Column, salts: int = 1
) -> DataFrame:
    """Join a stream with a table, which has no broadcast hint: Spark sizes it.

    For a table too large to broadcast, `salts` spreads a hot key of the stream
    over so many tasks, at the price of as many copies of the table.
    """
    return relational.salted_join(rows, lookup, on, spread, salts)


def join_calls(
    requests: DataFrame,
    responses: DataFrame,
    key: str,
    ts: str = "ts",
    max_cost_ms: int = C.MAX_COST_MS,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Join two streams: (key, cost_ms) of each request and its response.

    The key is that of one call. A key that comes again on a side within the
    lateness is taken once, so repeated lines do not give pairs. The bound on the
    cost lets Spark drop a call from the state when no response can follow. A key that
    comes again after the lateness is another call, with a cost of its own.
    """
    asked = _timed(requests, ts, lateness, key).dropDuplicatesWithinWatermark([key])
    asked = asked.withColumnRenamed(ts, "_asked")
    answered = _timed(responses, ts, lateness, key).dropDuplicatesWithinWatermark([key])
    answered = answered.withColumnsRenamed({ts: "_answered", key: "_key"})
    # A literal: of any other expression Spark derives no bound for the state.
    bound = F.lit(timedelta(milliseconds=max_cost_ms))
    in_time = (F.col("_answered") >= F.col("_asked")) & (
        F.col("_answered") <= F.col("_asked") + bound
    )
    cost = clock.millis_between(F.col("_asked"), F.col("_answered"))
    return asked.join(answered, (F.col(key) == F.col("_key")) & in_time).select(
        key, cost.alias("cost_ms")
    )


def window_cogroup(
    left: DataFrame, right: DataFrame, key: str, ts: str, window: str, lateness: str
) -> DataFrame:
    """Rows of two streams per key and window: `n_left`, `n_right`.

    The streams are stacked and counted, so the state is two counts per key and
    window. Joining the rows themselves would hold both sides in state and give
    every pair of a hot key.
    """
    stacked = left.select(key, ts, F.lit(True).alias("_left")).union(
        right.select(key, ts, F.lit(False).alias("_left"))
    )
    return (
        _timed(stacked, ts, lateness, key, "_left")
        .groupBy(F.window(ts, window).alias("_w"), key)
        .agg(
            F.count_if(F.col("_left")).alias("n_left"),
            F.count_if(~F.col("_left")).alias("n_right"),
        )
        .select(F.col("_w.start").alias("window_start"), key, "n_left", "n_right")
    )
