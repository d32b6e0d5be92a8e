"""Operators over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions import text as tf


def _trimmed(rows: DataFrame, key: str) -> Column:
    """The key, without surrounding spaces if it is a string."""
    is_text = isinstance(rows.schema[key].dataType, T.StringType)
    return F.trim(F.col(key)) if is_text else F.col(key)


def unique_lookup(lookup: DataFrame, key: str, name: str) -> DataFrame:
    """(_key, name) with trimmed keys; the job fails on a key that has two rows."""
    message = F.concat(F.lit("lookup key is not unique: "), F.first("_key").cast("string"))
    one_name = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(F.first(name))
    return (
        lookup.select(_trimmed(lookup, key).alias("_key"), name)
        .groupBy("_key")
        .agg(one_name.alias(name))
    )


def lookup_sum(
    facts: DataFrame, key: str, measure: Column, lookup: DataFrame, lookup_key: str, name: str
) -> DataFrame:
    """Sum of a measure per looked-up name, over facts whose key is known.

    The facts are summed per key before the join, so the join sees one row per
    key however many facts share it. The join has no hint: Spark broadcasts the
    lookup when its measured size allows and shuffles both small sides if not.
    """
    per_key = (
        facts.select(_trimmed(facts, key).alias("_key"), measure.alias("_measure"))
        .where(F.col("_measure").isNotNull())
        .groupBy("_key")
        .agg(F.sum("_measure").alias("_measure"))
    )
    return (
        per_key.join(unique_lookup(lookup, lookup_key, name), "_key")
        .groupBy(name)
        .agg(F.sum("_measure").alias("total"))
    )


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], spread: Column, salts: int = 1
) -> DataFrame:
    """Inner equi-join whose left side may have hot keys.

    With salts above one, every left key is spread over that many tasks by
    `spread` and the right side is repeated once per salt. With one salt it is
    the plain join, and Spark splits skewed partitions at run time.
    """
    if salts <= 1:
        return left.join(right, on)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")


def cogroup_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on either side (0 when absent), for keys on any side.

    The sides are stacked with a flag and counted in one shuffle with map-side
    combine; nothing is joined.
    """
    stacked = left.select(*keys, F.lit(True).alias("_left")).unionByName(
        right.select(*keys, F.lit(False).alias("_left"))
    )
    return stacked.groupBy(*keys).agg(
        F.count_if(F.col("_left")).alias("n_left"), F.count_if(~F.col("_left")).alias("n_right")
    )


def count_by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows per key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_by_value(rows: DataFrame) -> DataFrame:
    """Rows per distinct row."""
    return count_by_key(rows, *rows.columns)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept, columns matched by name."""
    for other in others:
        first = first.unionByName(other)
    return first


def sort_desc(rows: DataFrame, by: str, *tie_break: str) -> DataFrame:
    """Largest first; the tie break also lets equal values spread over tasks."""
    return rows.orderBy(F.col(by).desc(), *tie_break)


def top_n(rows: DataFrame, n: int, by: str, *tie_break: str) -> DataFrame:
    """The n largest rows; every task keeps its own n and only those are merged."""
    return rows.orderBy(F.col(by).desc(), *[F.col(t).desc() for t in tie_break]).limit(n)


def sample_by_key(rows: DataFrame, key: list[str], fraction: float) -> DataFrame:
    """The rows whose key's digest lies below a bound: about the fraction of the keys.

    The same keys are drawn however the rows lie in files, and in any table that has them.
    """
    text = F.concat_ws("/", *[F.col(k).cast("string") for k in key])
    bound = f"{round(fraction * 16**8):08x}" if fraction < 1 else "g"
    return rows.where(F.substring(F.md5(text), 1, 8) < bound)


def first_match(rows: DataFrame, predicate: Column | str) -> DataFrame:
    """One row that meets the predicate, or none; reading stops once one is found."""
    return rows.where(predicate).limit(1)


def sample_rows(
    rows: DataFrame, fraction: float, seed: int, with_replacement: bool = False
) -> DataFrame:
    """A random share of the rows, with replacement if asked; it depends on how they lie in files.

    `sample_by_key` draws the same rows whatever the layout.
    """
    return rows.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def sql_over(spark: SparkSession, statement: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text over DataFrames, each named in it as `{name}`; no view stays behind."""
    return spark.sql(statement, **frames)


def rows_as_json(rows: DataFrame) -> DataFrame:
    """Every row as one JSON string."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def keep_listed(rows: DataFrame, column: str, members: list[str]) -> DataFrame:
    return rows.where(tf.in_list(F.col(column), members))


def drop_listed(
    rows: DataFrame, column: str, members: list[str], ignore_case: bool = False
) -> DataFrame:
    return rows.where(~tf.in_list(F.col(column), members, ignore_case))


def dictionary_rows(lines: DataFrame, text: str = "value") -> DataFrame:
    """`type code name parent_code sort status` lines as rows ready to append to a table.

    Lines with other than six fields, or a `sort` that is no number, are no rows.
    """
    split = lines.select(tf.once(tf.fields(F.col(text), " ")).alias("_f")).where(F.size("_f") == 6)
    names = ["type", "code", "name", "parent_code", "sort", "status"]
    rows = split.select(*[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names)])
    number = F.col("sort").try_cast("int")
    return rows.withColumn("sort", number).where(F.col("sort").isNotNull())
