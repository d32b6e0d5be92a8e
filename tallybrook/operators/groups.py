"""Groups that may be too large for one task.

A group is cut into `parts` by an argument, the same for every key and whatever
its size: results keep their shape as data grows. Rows are read once and
shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def part_of(spread: Column, parts: int) -> Column:
    """Which of `parts` a row belongs to; `spread` is a bigint that differs between a key's rows.

    A single part takes rows without a `spread` as well.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    part = F.pmod(spread.cast("bigint"), F.lit(parts).cast("bigint"))
    return F.coalesce(part, F.lit(0)) if parts == 1 else part


def concat_groups(
    rows: DataFrame,
    keys: list[str],
    value: str,
    spread: Column,
    separator: str,
    trailing: bool = False,
    *,
    parts: int,
) -> DataFrame:
    """Join the values of every key into text, sorted within each part.

    One row per (keys, part) that has values, with `n_values` and `joined`.
    Reading the parts of a key one after another gives all its values. Choose
    `parts` so that a part of the largest key fits in a row. `trailing` adds the
    separator after the last value as well.
    """
    joined = F.array_join(F.array_sort(F.collect_list(value)), separator)
    if trailing:
        joined = F.concat(joined, F.lit(separator))
    return (
        rows.where(F.col(value).isNotNull())
        .select(*keys, part_of(spread, parts).alias("part"), value)
        .repartition(*keys, "part")
        .groupBy(*keys, "part")
        .agg(F.count(F.lit(1)).alias("n_values"), joined.alias("joined"))
    )


def cogroup_lists(
    left: DataFrame, right: DataFrame, keys: list[str], value: str, spread: str, *, parts: int
) -> DataFrame:
    """Both sides' values per key and part as sorted lists.

    Both sides have the keys, a value and a bigint column that tells the rows
    of one key apart. One shuffle brings the two sides together: they are
    stacked with a side flag rather than joined, so no pairs are formed.
    """
    columns = [*keys, part_of(F.col(spread), parts).alias("part"), value]
    stacked = left.select(*columns, F.lit(True).alias("_left")).unionByName(
        right.select(*columns, F.lit(False).alias("_left"))
    )
    return stacked.repartition(*keys, "part").groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.when(F.col("_left"), F.col(value)))).alias("left_values"),
        F.array_sort(F.collect_list(F.when(~F.col("_left"), F.col(value)))).alias("right_values"),
    )
