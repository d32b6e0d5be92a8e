"""Reducers and partitioners that a caller brings along, and a search that ends at the first match."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import AccumulatorParam
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallybrook.session import let_workers_import

# Keys whose partial results a task holds before it passes them on.
HELD_KEYS = 100_000


def reduce_by_key(
    rows: DataFrame, keys: list[str], value: str, fn: Callable[[Any, Any], Any], held_keys: int = HELD_KEYS
) -> DataFrame:
    """One row per key: its values combined by `fn`, which must be associative and commutative.

    Tasks combine what they hold before the one shuffle, so a hot key arrives as a row or
    a few per task, and the last step combines these as they stream by; no key's values
    are ever held together. `fn` gets and gives plain Python values of the column's type.
    Null values take no part: a key with no others has a null. Null keys are a key.
    """
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField(value, rows.schema[value].dataType)])
    arrow = to_arrow_schema(schema)

    def batch_of(held: dict[tuple, Any]) -> pa.RecordBatch:
        columns = [*zip(*held.keys(), strict=True)] if keys else []
        arrays = [pa.array(list(c), f.type) for c, f in zip([*columns, held.values()], arrow, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def pairs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, Any]]:
        lists = [c.to_pylist() for c in batch.columns]
        return zip(zip(*lists[:-1], strict=True), lists[-1], strict=True)

    def both(a: Any, b: Any) -> Any:
        return b if a is None else a if b is None else fn(a, b)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for batch in batches:
            for key, one in pairs(batch):
                held[key] = both(held.get(key), one)
            if len(held) >= held_keys:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key: the key that is still open goes on into the next batch.
        held: dict[tuple, Any] = {}
        for batch in batches:
            for key, one in pairs(batch):
                held[key] = both(held.get(key), one)
            if len(held) > 1:
                last = next(reversed(held))
                rest = {last: held.pop(last)}
                yield batch_of(held)
                held = rest
        if held:
            yield batch_of(held)

    partial = rows.select(*keys, value).mapInArrow(combine, schema)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(finish, schema)


def partitioned(rows: DataFrame, part: Column, parts: int) -> DataFrame:
    """Rows in `parts` tasks by a law of the caller's: `part` is the number of a row's task.

    Numbers beyond the parts wrap around, negative and null ones included (null is 0).
    Written as files, each part is a file of its own. Rows of a part stay in one task
    however many there are, so the law must not send a large share of them to one part.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    number = F.pmod(F.coalesce(part.cast("bigint"), F.lit(0)), F.lit(parts)).cast("int")
    return rows.repartitionById(parts, number)


class _FirstFound(AccumulatorParam):
    """Keeps one of the values it is given."""

    def zero(self, value: Any) -> None:
        return None

    def addInPlace(self, value1: Any, value2: Any) -> Any:  # noqa: N802
        return value2 if value1 is None else value1


def any_match(rows: DataFrame, predicate: Callable[[dict], bool] | Column, wait_seconds: float = 0.05) -> Row | None:
    """A row that meets the predicate, or None; the search ends when any task has found one.

    All tasks search at the same time, and each stops at its first match. Where `limit(1)`
    looks into few partitions first and then into more, here a match that only the last
    partition holds is found without waiting for the others: their job is cancelled. Which
    of several matches is found may differ from run to run. The predicate is a column, or
    a function of a row's values by name, for what no column can say.
    """
    spark = rows.sparkSession
    let_workers_import(spark)
    names, context = rows.columns, spark.sparkContext
    found = context.accumulator(None, _FirstFound())
    kept, test = (rows.where(predicate), None) if isinstance(predicate, Column) else (rows, predicate)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In slices: what follows a match is not looked at.
            for row in (r for at in range(0, batch.num_rows, 64) for r in batch.slice(at, 64).to_pylist()):
                if test is None or test(row):
                    found.add(tuple(row[n] for n in names))
                    yield pa.RecordBatch.from_arrays([pa.array([1])], names=["n"])
                    return

    job = kept.mapInArrow(search, "n bigint")
    tag = f"any-match-{uuid.uuid4().hex}"
    failed: list[Exception] = []

    def run() -> None:
        context.addJobTag(tag)
        try:
            job.write.format("noop").mode("overwrite").save()
        except Exception as error:
            failed.append(error)
        finally:
            context.removeJobTag(tag)

    searching = threading.Thread(target=run, daemon=True)
    searching.start()
    while searching.is_alive() and found.value is None:
        searching.join(wait_seconds)
    if found.value is not None:
        context.cancelJobsWithTag(tag)
        searching.join()
        return Row(*names)(*found.value)
    if failed:
        raise failed[0]
    return None
