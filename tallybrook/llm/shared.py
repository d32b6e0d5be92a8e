"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallybrook.session import run_dir

# The six characters that part words.
SPACES = " \t\n\x0b\x0c\r"

# Rows of one group are ranked in 2**RANK_BITS parts, so that no task sorts a whole group.
RANK_BITS = 8


def settled(rows: DataFrame, name: str, gather: bool = False) -> DataFrame:
    """The rows written to the shared folder and read back.

    With `gather`, for little that many tasks hold, Spark first moves the rows
    into as few files as their size asks for.

    This cuts the lineage and works a costly frame out once. The folder lies
    under `spark.checkpoint.dir` (see `session.run_dir`), which all executors
    reach, so nothing is lost with an executor.
    """
    spark = rows.sparkSession
    folder = run_dir(spark, name)
    (rows.hint("rebalance") if gather else rows).write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def let_workers_import(spark: SparkSession) -> None:
    """Add the place this package was imported from to the path of Python workers.

    Functions sent to workers name this package. On a cluster it is installed or
    sent with the job; on one machine this finds it from any working folder.
    """
    place = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if place not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, place])


def row_key(id_column: str, text_column: str | None = None) -> Column:
    """A key that is never null: the id, and the hash of the text where ids may repeat."""
    parts = [F.col(id_column).alias("id")]
    if text_column is not None:
        parts.append(F.xxhash64(F.col(text_column)).alias("text_hash"))
    return F.struct(*parts)


def words(text: Column) -> Column:
    """The runs of characters other than the six spaces; no text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+")
    return F.array_remove(parts, "")


def spread(value: Column) -> Column:
    """A long from 0 to 2**60 that values are spread over evenly; null counts as empty text."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ranked(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Add `name`: the place of a row in its group by `order`, gapless from 0.

    Groups may be of any size. Each is dealt by the first column of `order`,
    which must come from `spread`, into 2**RANK_BITS ranges; the ranges are
    counted, and rows are ranked within their range only. Rows equal in all of
    `order` share out their places in any order.
    """
    part = F.shiftright(F.col(order[0]), 60 - RANK_BITS).cast("int")
    dealt = rows.withColumn("_part", part)
    counts = dealt.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_part").alias("_of_part"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_part") == F.col("_of_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy(*by, "_part").orderBy(*order)
    placed = dealt.join(counts, same).withColumn(
        name, (F.col("_before") + F.row_number().over(within) - 1).cast("long")
    )
    return placed.select(*rows.columns, name)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
