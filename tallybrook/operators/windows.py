"""Access logs and sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import clock
from tallybrook.functions import text as tf

# Sliding windows are worked out per key and block of so many window lengths.
BLOCK_LENGTHS = 6


def access_hits(
    lines: DataFrame,
    text: str = "value",
    keep: list[str] | None = None,
    ip_field: int = C.ACCESS_IP_FIELD,
    path_field: int = C.ACCESS_PATH_FIELD,
    min_fields: int = C.ACCESS_MIN_FIELDS,
    prefix: str = C.ACCESS_PATH_PREFIX,
) -> DataFrame:
    """`ip` of every line with enough fields and a path that starts as asked."""
    split = lines.select(*(keep or []), tf.once(tf.fields(F.col(text), " ")).alias("_f"))
    wanted = (F.size("_f") >= min_fields) & F.get("_f", F.lit(path_field)).startswith(prefix)
    return split.where(wanted).select(*(keep or []), F.get("_f", F.lit(ip_field)).alias("ip"))


def timed_access_hits(
    lines: DataFrame, text: str = "value", time_field: int = C.ACCESS_TIME_FIELD, **layout
) -> DataFrame:
    """`ip` and `ts` of every line that `access_hits` takes; a line without a log time is dropped."""
    stamp = F.get(tf.fields(F.col(text), " "), F.lit(time_field))
    timed = lines.select(F.col(text), tf.once(clock.parse_log_time(stamp)).alias("ts"))
    return access_hits(timed.where(F.col("ts").isNotNull()), text, ["ts"], **layout)


def interval_counts(
    rows: DataFrame, key: str, ts: str = "ts", minutes: int = C.WINDOW_SLIDE_MINUTES
) -> DataFrame:
    """(interval_start, key, n) for intervals that follow one another. Also for streams."""
    return (
        rows.where(F.col(ts).isNotNull())
        .groupBy(F.window(ts, f"{minutes} minutes").alias("_w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("_w.start").alias("interval_start"), key, "n")
    )


def sum_intervals(
    counts: DataFrame,
    key: str,
    length_minutes: int = C.WINDOW_LENGTH_MINUTES,
    slide_minutes: int = C.WINDOW_SLIDE_MINUTES,
) -> DataFrame:
    """(window_start, key, n) for sliding windows over counts per slide interval.

    A count raises the windows from the first to the last one that covers its
    interval, and lowers the one after. Summed up in time order, these changes
    give the count of every window between one change and the next, and only
    then are windows written out: no count is copied per window.

    Changes are sorted per key and block of time, so a hot key has one group
    per block, of at most one change per interval at either end. A count whose
    windows start in two blocks goes to both.
    """
    if length_minutes % slide_minutes:
        raise ValueError("the window length must be a multiple of the slide")
    minutes = lambda n: F.expr(f"interval {n} minutes")
    block_minutes = BLOCK_LENGTHS * length_minutes
    slide, block = minutes(slide_minutes), F.col("_block")
    last, block_end = F.col("interval_start"), block + minutes(block_minutes)
    first = last - minutes(length_minutes - slide_minutes)

    own = counts.select("*", F.window(last, f"{block_minutes} minutes").start.alias("_own"))
    blocks = F.when(first < F.col("_own"), F.array(F.col("_own") - minutes(block_minutes), "_own"))
    placed = own.select(
        "interval_start", key, "n", F.explode(blocks.otherwise(F.array("_own"))).alias("_block")
    ).repartition(F.col(key), block)

    rise = F.struct(F.greatest(first, block).alias("at"), F.col("n").alias("by"))
    fall = F.struct(F.least(last + slide, block_end).alias("at"), (-F.col("n")).alias("by"))
    changes = placed.select(key, "_block", F.inline(F.array(rise, fall)))
    in_order = Window.partitionBy(key, "_block").orderBy("at")
    steps = changes.select(
        key,
        "at",
        F.lead("at").over(in_order).alias("_next"),
        F.sum("by").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
    ).where((F.col("_next") > F.col("at")) & (F.col("n") > 0))
    starts = F.sequence("at", F.col("_next") - slide, slide)
    return steps.select(F.explode(starts).alias("window_start"), key, "n")


def sliding_counts(
    rows: DataFrame,
    key: str,
    ts: str = "ts",
    length_minutes: int = C.WINDOW_LENGTH_MINUTES,
    slide_minutes: int = C.WINDOW_SLIDE_MINUTES,
) -> DataFrame:
    """(window_start, key, n) for every sliding window that holds a row.

    Rows are first counted per slide interval, and only these counts are copied
    into the windows that cover them: a hot key costs one count per interval
    and not one copy of each of its rows per window.
    """
    counts = interval_counts(rows, key, ts, slide_minutes)
    return sum_intervals(counts, key, length_minutes, slide_minutes)
