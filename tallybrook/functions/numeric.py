"""Column functions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_average(total: Column, count: Column) -> Column:
    """total / count rounded half up to two places, as decimal(20,2).

    Integer arithmetic throughout: dividing decimals first and rounding after
    rounds twice, which shows for large counts.
    """
    wide = F.abs(total.cast("decimal(30,0)")) * F.lit(200) + count
    hundredths = F.call_function("div", wide, count.cast("decimal(20,0)") * F.lit(2))
    signed = F.when(total < 0, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)")


def cents(amount: Column) -> Column:
    """A currency amount held as double, as whole cents, so sums are exact."""
    return F.round(amount * 100).cast("bigint")
