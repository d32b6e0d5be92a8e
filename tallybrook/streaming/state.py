"""Streams with state of their own: what built-in counts and joins cannot say."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallybrook import constants as C

# States that calls are dealt over.
BUCKETS = 1024


def call_state(
    requests: DataFrame,
    responses: DataFrame,
    key: str,
    ts: str = "ts",
    max_cost_ms: int = C.MAX_COST_MS,
    lateness: str = "10 minutes",
    forget_ms: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, cost_ms) of calls of two streams, each paired in one state, as rows to append.

    A call's cost is from its earliest request to its earliest response, and comes once,
    when both are there and it is within `max_cost_ms`. A request without such a response
    comes with a null cost once the watermark is `max_cost_ms` and `forget_ms` past it;
    then the key is forgotten, and lines of it are another call. Lines without a key or a
    time are left out, and so are those behind the watermark.

    Keys share `buckets` states, as a state has a price of its own however few calls are
    open in it; a bucket's timer is that of its call that ends next. Choose so many that
    the open calls of one fit in a row. The number is part of a checkpoint.
    """
    field = requests.schema[key]
    out = T.StructType([field, T.StructField("cost_ms", T.LongType())])
    sides = [
        side.select(key, F.col(ts).cast("timestamp").alias("ts"), F.lit(asks).alias("asks"))
        for side, asks in ((requests, True), (responses, False))
    ]
    lines = sides[0].union(sides[1]).where(F.col(key).isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", lateness)
    lines = lines.withColumns({"ms": F.unix_millis("ts"), "bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})

    def due(call: list) -> int:
        """The time after which a call is forgotten."""
        asked, answered, _ = call
        return (answered if asked is None else asked) + max_cost_ms + forget_ms

    def pair(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Open calls: the millis of the earliest request and response, and whether the cost is out.
        calls = {k: list(c) for k, *c in zip(*state.get, strict=True)} if state.exists else {}
        watermark = state.getCurrentWatermarkMs()
        over = [k for k, c in calls.items() if due(c) < watermark]
        found = [(k, None) for k in over if calls[k][0] is not None and not calls[k][2]]
        for k in over:
            del calls[k]
        if not state.hasTimedOut:
            for frame in frames:
                for k, ms, asks in zip(frame[key].tolist(), frame["ms"].tolist(), frame["asks"].tolist(), strict=True):
                    call = calls.setdefault(k, [None, None, False])
                    side = 0 if asks else 1
                    call[side] = ms if call[side] is None else min(call[side], ms)
        for k, call in calls.items():
            asked, answered, done = call
            if not done and asked is not None and answered is not None and 0 <= answered - asked <= max_cost_ms:
                found.append((k, answered - asked))
                call[2] = True
        if calls:
            state.update((list(calls), *map(list, zip(*calls.values(), strict=True))))
            state.setTimeoutTimestamp(max(min(map(due, calls.values())), watermark) + 1)
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame({key: [k for k, _ in found], "cost_ms": pd.array([c for _, c in found], "Int64")})

    kept = T.StructType(
        [
            T.StructField("keys", T.ArrayType(field.dataType)),
            T.StructField("asked", T.ArrayType(T.LongType())),
            T.StructField("answered", T.ArrayType(T.LongType())),
            T.StructField("done", T.ArrayType(T.BooleanType())),
        ]
    )
    return lines.groupBy("bucket").applyInPandasWithState(pair, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def unanswered(
    requests: DataFrame,
    responses: DataFrame,
    key: str,
    ts: str = "ts",
    max_cost_ms: int = C.MAX_COST_MS,
    lateness: str = "10 minutes",
) -> DataFrame:
    """(key, ts) of requests without a response within `max_cost_ms`, as a left outer join of two streams.

    A request is released once the watermarks of both sides say that no response can
    come any more; repeated lines of a call within the lateness count once. Append it.
    """
    asked = requests.select(key, F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, lateness)
    asked = asked.dropDuplicatesWithinWatermark([key])
    answered = responses.select(F.col(key).alias("_key"), F.col(ts).cast("timestamp").alias("_answered"))
    answered = answered.withWatermark("_answered", lateness)
    bound = F.lit(timedelta(milliseconds=max_cost_ms))
    in_time = (F.col("_answered") >= F.col(ts)) & (F.col("_answered") <= F.col(ts) + bound)
    joined = asked.join(answered, (F.col(key) == F.col("_key")) & in_time, "left_outer")
    return joined.where(F.col("_key").isNull()).select(key, ts)


def ring_windows(
    rows: DataFrame,
    key: str,
    ts: str = "ts",
    lateness: str = "10 minutes",
    length_minutes: int = C.WINDOW_LENGTH_MINUTES,
    slide_minutes: int = C.WINDOW_SLIDE_MINUTES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(window_start, key, n) as a stream to append: each window once, when it is final.

    Tasks count their rows per key and interval before the shuffle; such a count is dropped
    where all of it lies behind the watermark. Rows without a time are left out. The counts
    are kept and summed up as `windows_of_counts` says.
    """
    counts = interval_counts(rows, key, ts, slide_minutes).withWatermark("newest", lateness)
    return windows_of_counts(counts, key, length_minutes, slide_minutes, buckets)


def interval_counts(rows: DataFrame, key: str, ts: str, slide_minutes: int) -> DataFrame:
    """(key, at, n, newest): rows per key and slide interval as tasks count them, in parts, and their newest time."""
    slide = slide_minutes * 60_000
    timed = rows.select(key, F.col(ts).cast("timestamp").alias("newest")).where("newest IS NOT NULL")
    names = [key, "at", "n", "newest"]
    parts = T.StructType([rows.schema[key], *(T.StructField(n, T.LongType()) for n in names[1:3]), T.StructField("newest", T.TimestampType())])
    # Rows that a task counts at a time.
    many = 1_000_000

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                size += batch.num_rows
            if held and (batch is None or size >= many):
                counts = pa.Table.from_batches(held).group_by([key, "at"]).aggregate([([], "count_all"), ("newest", "max")])
                yield from counts.rename_columns(names).to_batches(max_chunksize=10_000)
                held, size = [], 0

    start = (F.floor(F.unix_millis("newest") / slide) * slide).cast("long")
    return timed.withColumn("at", start).mapInArrow(counted, parts)


def windows_of_counts(
    counts: DataFrame, key: str, length_minutes: int, slide_minutes: int, buckets: int = BUCKETS
) -> DataFrame:
    """(window_start, key, n) as a stream to append, from a stream of counts per slide interval.

    The counts have the key, `at` (the start of the interval in millis), `n` and a watermark;
    those of one key and interval may come in parts. Keys share `buckets` states, as a state
    has a price of its own however few counts are in it: a bucket holds, as one Arrow table,
    the counts of intervals that are not yet in all of their windows, and the end of the last
    window that was emitted. Null keys have a bucket to themselves. As the watermark moves on,
    the counts are added up into the windows that it has passed. Choose so many buckets that
    the open counts of one fit in a row. The number is part of a checkpoint.
    """
    slide, length = slide_minutes * 60_000, length_minutes * 60_000
    if length % slide:
        raise ValueError("the length of a window must be a multiple of its slide")
    field = counts.schema[key]
    out = T.StructType([T.StructField("window_start", T.TimestampType()), field, T.StructField("n", T.LongType())])
    schema = pa.schema([(key, to_arrow_type(field.dataType)), ("at", pa.int64()), ("n", pa.int64())])
    # Intervals whose windows are worked out at a time.
    many = 100_000

    def packed(ring: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_table(ring)
        return sink.getvalue().to_pybytes()

    def closing(ring: pa.Table, floor: int, closed: int) -> Iterator[pd.DataFrame]:
        """The windows that end after `floor` and not after `closed`."""
        ats = ring["at"].to_numpy()
        ring = ring.filter(pa.array((ats + slide <= closed) & (ats + length > floor)))
        keys = ring[key].combine_chunks().dictionary_encode()
        codes = np.asarray(keys.indices.fill_null(0), np.int64)
        order = np.argsort(codes, kind="stable")
        codes, ats, ns = codes[order], ring["at"].to_numpy()[order], ring["n"].to_numpy()[order]
        # A key's intervals stay together.
        begins = np.flatnonzero(np.diff(codes, prepend=-1))
        cuts = [*begins[np.flatnonzero(np.diff(begins // many, prepend=-1))], len(codes)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            ends = ats[low:high, None] + np.arange(slide, length + slide, slide)
            met = (ends > floor) & (ends <= closed)
            of, n = (np.broadcast_to(v[low:high, None], ends.shape)[met] for v in (codes, ns))
            ends = ends[met]
            order = np.lexsort((ends, of))
            of, ends, n = of[order], ends[order], n[order]
            first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(ends, prepend=-1) != 0))
            yield pd.DataFrame(
                {
                    "window_start": pd.to_datetime(ends[first] - length, unit="ms", utc=True),
                    key: keys.dictionary.take(pa.array(of[first])).to_pandas() if len(keys.dictionary) else None,
                    "n": np.add.reduceat(n, first),
                }
            )

    def slid(of: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept, floor = state.get if state.exists else (None, None)
        tables = [] if kept is None else [pa.ipc.open_stream(bytes(kept)).read_all()]
        if not state.hasTimedOut:
            for frame in frames:
                columns = [pa.array(frame[f.name], f.type, from_pandas=of[0] < 0) for f in schema]
                tables.append(pa.Table.from_arrays(columns, schema=schema))
        ring = pa.concat_tables(tables).group_by([key, "at"]).aggregate([("n", "sum")])
        ring = pa.Table.from_arrays([ring[key], ring["at"], ring["n_sum"]], schema=schema)
        watermark = state.getCurrentWatermarkMs()
        closed = watermark // slide * slide
        if floor is None:
            # No window of the bucket is out yet.
            floor = min(closed, pc.min(ring["at"]).as_py())
        if closed > floor and ring.num_rows:
            yield from closing(ring, floor, closed)
        floor = max(floor, closed)
        # An interval is in windows that end up to `length` after it.
        ring = ring.filter(pc.greater(ring["at"], floor - length))
        # The end of the last window emitted is kept where no interval is.
        state.update((packed(ring), floor))
        if ring.num_rows:
            state.setTimeoutTimestamp(max(max(pc.min(ring["at"]).as_py(), floor) + slide - 1, watermark + 1))

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    dealt = counts.withColumn("bucket", F.when(F.col(key).isNull(), -1).otherwise(bucket))
    return dealt.groupBy("bucket").applyInPandasWithState(
        slid, out, "ring binary, emitted bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
