"""Start and stop streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

Operator = Callable[[DataFrame], DataFrame]
TimedOperator = Callable[[DataFrame, Column | None], DataFrame]


class State(NamedTuple):
    """What a stream of changes is about, and after how many batches it is gathered anew.

    A batch holds the newest values of its keys, or, where `adds`, what it adds to them.
    `keep` is a predicate for keys that still matter, such as days not closed yet;
    what does not meet it leaves the next snapshot. Rows for which `aside` holds, such
    as late ones, stay in their batch and do not count.
    """

    keys: tuple[str, ...]
    values: tuple[str, ...]
    every: int = 100
    keep: str | None = None
    adds: bool = False
    aside: str | None = None


# The note of a finished batch: its rows, those that came late, and the newest time
# of this batch and all before it, where the job tells times.
NOTE = "n_rows bigint, n_late bigint, newest timestamp"


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every interval, or, without one, until all present input is read."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def write_per_batch(
    stream: DataFrame,
    operator: Operator,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    output_mode: str = "append",
    state: State | None = None,
) -> StreamingQuery:
    """Apply a batch operator to every micro-batch and keep its result by batch.

    A batch overwrites its own folder `batch_id=N` and then its note, so a batch that is
    run again after a failure leaves the same as one that ran once, and one that was cut
    short has no note and is not read. The rows are first moved into as few files as
    their size asks for: a stateful operator has as many tasks as its state has parts,
    however little changed. With `state`, the newest values are gathered into a snapshot
    every so many batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        operator(batch).hint("rebalance").write.mode("overwrite").parquet(_batch(out, batch_id))
        _finish(batch.sparkSession, out, batch_id, state)

    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def write_timed_batches(
    stream: DataFrame,
    operator: TimedOperator,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    state: State | None = None,
) -> StreamingQuery:
    """`write_per_batch` for operators that also take the newest time of all batches before.

    The operator adds the columns `late` and `newest`, from which the batch's note comes,
    to its counts in `n`. The time is read from the note of the batch before, so it is the
    same when a batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _note(spark, out, batch_id - 1)
        # As micros: a session's time zone may have hours twice.
        newest = F.timestamp_micros(F.lit(before["us"])) if before and before["us"] is not None else None
        operator(batch, newest).hint("rebalance").write.mode("overwrite").parquet(_batch(out, batch_id))
        late, rows = F.sum(F.when(F.col("late"), F.col("n"))), F.sum("n")
        _finish(spark, out, batch_id, state, rows, late, F.max("newest") if newest is None else F.greatest(F.max("newest"), newest))

    writer = stream.writeStream.foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def _batch(out: str, batch_id: int) -> str:
    return f"{out}/batch_id={batch_id}"


def _finish(
    spark: SparkSession,
    out: str,
    batch_id: int,
    state: State | None,
    rows: Column | None = None,
    late: Column | None = None,
    newest: Column | None = None,
) -> None:
    """Write a batch's note, which is what makes it count, and a snapshot where one is due."""
    values = {
        "n_rows": F.count(F.lit(1)) if rows is None else rows,
        "n_late": F.lit(0) if late is None else late,
        "newest": F.lit(None) if newest is None else newest,
    }
    types = dict(part.split() for part in NOTE.split(", "))
    note = spark.read.parquet(_batch(out, batch_id)).agg(*[v.cast(types[n]).alias(n) for n, v in values.items()])
    note = note.fillna(0, ["n_rows", "n_late"]).coalesce(1)
    note.write.mode("overwrite").parquet(f"{_notes(out)}/batch_id={batch_id}")
    if state is not None and (batch_id + 1) % state.every == 0:
        write_snapshot(spark, out, batch_id, state)


def write_closed(
    stream: DataFrame, out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append rows that are final, such as windows behind the watermark."""
    writer = stream.writeStream.format("parquet").option("path", out).outputMode("append")
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def _notes(out: str) -> str:
    return f"{out}-notes"


def _snapshots(out: str) -> str:
    return f"{out}-state"


def _if_written(frame: Callable[[], DataFrame]) -> DataFrame | None:
    """What a path holds, or None before anything is written to it."""
    try:
        return frame()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _note(spark: SparkSession, out: str, batch_id: int) -> Row | None:
    found = _if_written(lambda: spark.read.schema(NOTE).parquet(f"{_notes(out)}/batch_id={batch_id}"))
    return found.select("*", F.unix_micros("newest").alias("us")).first() if found is not None else None


def finished_batches(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, n_rows, n_late, newest) of every finished batch.

    This is the list of what counts: a batch without a row here was cut short. `n_late`
    are rows of the batch that were put aside for coming too late.
    """
    found = _if_written(lambda: spark.read.schema(f"{NOTE}, batch_id bigint").parquet(_notes(out)))
    columns = ["batch_id", "n_rows", "n_late", "newest"]
    if found is None:
        return spark.createDataFrame([], f"batch_id bigint, {NOTE}").select(columns)
    return found.select(columns)


def read_per_batch(spark: SparkSession, out: str) -> DataFrame:
    """All finished batches' results with their `batch_id`."""
    found = spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return found.join(finished_batches(spark, out).select("batch_id"), "batch_id", "left_semi")


def newest_folders(spark: SparkSession, out: str, upto: int | None = None) -> tuple[int, list[str]]:
    """The number of the newest finished snapshot (-1 if none), and the finished batches' folders after it."""
    kept = F.lit(True) if upto is None else F.col("batch_id") <= upto
    found = _if_written(lambda: spark.read.schema("batch_id bigint").parquet(f"{_snapshots(out)}-list"))
    through = found.where(kept).agg(F.max("batch_id")).first()[0] if found is not None else None
    through = -1 if through is None else through
    after = finished_batches(spark, out).where(kept & (F.col("batch_id") > through)).orderBy("batch_id")
    return through, [_batch(out, r["batch_id"]) for r in after.select("batch_id").collect()]


def read_state(spark: SparkSession, out: str, state: State, upto: int | None = None) -> DataFrame:
    """The values per key: the newest snapshot and the batches since, and nothing before it."""
    through, folders = newest_folders(spark, out, upto)
    parts = []
    if through >= 0:
        kept = spark.read.parquet(f"{_snapshots(out)}/through={through}")
        parts.append(kept.withColumn("batch_id", F.lit(through).cast("bigint")))
    if folders:
        tail = spark.read.option("basePath", out).parquet(*folders)
        tail = tail if state.aside is None else tail.where(f"NOT ({state.aside})")
        parts.append(tail.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        raise ValueError(f"no batch has been written to {out}")
    columns = [*state.keys, *state.values, "batch_id"]
    whole = parts[0].select(*columns)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*columns))
    if state.adds:
        return whole.groupBy(*state.keys).agg(*[F.sum(v).alias(v) for v in state.values])
    return latest_state(whole, list(state.keys), list(state.values))


def write_snapshot(spark: SparkSession, out: str, batch_id: int, state: State) -> None:
    """Gather the values through a batch; a repeated batch leaves a finished snapshot as it is."""
    if newest_folders(spark, out, upto=batch_id)[0] == batch_id:
        return
    newest = read_state(spark, out, state, upto=batch_id)
    if state.keep is not None:
        newest = newest.where(state.keep)
    newest.write.mode("overwrite").parquet(f"{_snapshots(out)}/through={batch_id}")
    # A snapshot counts once it is in this list.
    done = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id")).coalesce(1)
    done.write.mode("append").parquet(f"{_snapshots(out)}-list")


def latest_state(changes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The newest values per key out of the changes of all batches."""
    newest = F.max_by(F.struct(*values), F.col("batch_id")).alias("_state")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_state.*")


def stop_after_batch(query: StreamingQuery, timeout_seconds: float = 60.0) -> None:
    """Stop once no batch is being worked on, or when the time is up."""
    end = time.monotonic() + timeout_seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.1)
    query.stop()
