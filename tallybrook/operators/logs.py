"""API logs: parse, pair requests with responses, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook import constants as C
from tallybrook.functions import clock, numeric
from tallybrook.functions import text as tf

# The nested `contextMap` object stays JSON text.
LOG_LINE = T.StructType(
    [
        T.StructField("logTime", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("contextMap", T.StringType()),
        T.StructField("traceId", T.StringType()),
    ]
)
CALL_FIELDS = T.StructType(LOG_LINE.fields[:2] + LOG_LINE.fields[3:4])
_CORRUPT = T.StructField("_corrupt", T.StringType())


def parse_call_lines(
    lines: DataFrame,
    text: str = "value",
    markers: list[str] = C.CALL_MARKERS,
    fields: T.StructType = LOG_LINE,
) -> DataFrame:
    """Marked JSON lines as `uri`, `context`, `ts`, `level`, `trace_id`, `bad_line`.

    Lines without a marker, blank ones among them, are dropped before the JSON
    is parsed. A line that is not JSON, or has no usable time, keeps its text in
    `bad_line` and never fails the job. Only the given `fields` are parsed; those
    of LOG_LINE that are left out are null. CALL_FIELDS is what costs need.
    """
    marked = lines.where(tf.contains_any(F.col(text), markers))
    schema = T.StructType([*fields.fields, _CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT.name}
    parsed = marked.select(
        F.col(text).alias("_text"), tf.once(F.from_json(text, schema, options)).alias("log")
    )
    timed = parsed.select(
        "_text", "log", tf.once(clock.parse_log_time(F.col("log.logTime"))).alias("ts")
    )
    bad = F.col("log._corrupt").isNotNull() | F.col("ts").isNull()
    return timed.select(
        F.when(tf.non_blank(F.col("log.message")), tf.first_field(F.col("log.message"), " "))
        .otherwise(F.lit(""))
        .alias("uri"),
        F.col("log.contextMap").alias("context"),
        "ts",
        (F.col("log.level") if "level" in fields.names else F.lit(None).cast("string")).alias("level"),
        (F.col("log.traceId") if "traceId" in fields.names else F.lit(None).cast("string")).alias("trace_id"),
        F.when(bad, F.col("_text")).alias("bad_line"),
    )


def good_calls(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("bad_line").isNull()).drop("bad_line")


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("bad_line").isNotNull()).select("bad_line")


def pair_cost(calls: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """`cost_ms` between the two rows of every key that has exactly two.

    Count, first and last time combine map-side, whatever the size of a key.
    Keys with another number of rows have no defined cost and give no row.
    """
    return (
        calls.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
        .where(F.col("_n") == 2)
        .select(*keys, clock.millis_between(F.col("_first"), F.col("_last")).alias("cost_ms"))
    )


def unpaired(calls: DataFrame, keys: list[str], uri: str = "uri") -> DataFrame:
    """Per URI, the keys with other than two rows, which have no cost: `n_keys`, `n_lines`."""
    return (
        calls.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") != 2)
        .groupBy(uri)
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("_n").alias("n_lines"))
    )


def folded_cost(calls: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """`cost_ms` as the absolute differences folded over each key's times in order.

    For two rows that is the gap; for four it is the first gap plus the second,
    as of two calls with the same key; for an odd number it is close to a time
    itself and falls outside any cost range. All of these are the alternating
    sum of the times: a time that occurs an even number of times cancels out,
    and every other time counts once, with the sign of its rank.

    Ranks are taken per key and minute, where there are at most 60,000 different
    times, and then over a key's minutes, so a hot key is never sorted as a whole.
    """
    millis, minute = F.unix_millis(F.col(ts).cast("timestamp")), F.expr("_ms div 60000")
    times = calls.select(*keys, millis.alias("_ms")).where(F.col("_ms").isNotNull())
    single = times.groupBy(*keys, "_ms").agg((F.count(F.lit(1)) % 2).alias("_odd"))
    by_time = Window.partitionBy(*keys, "_minute").orderBy("_ms")
    ranked = single.withColumn("_minute", minute).withColumn(
        "_rank", F.sum("_odd").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    sign = F.when(F.col("_rank") % 2 == 1, F.col("_odd")).otherwise(-F.col("_odd"))
    minutes = ranked.groupBy(*keys, "_minute").agg(
        F.sum(sign * F.col("_ms")).alias("_sum"), F.sum("_odd").alias("_n")
    )
    earlier = Window.partitionBy(*keys).orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    signed = F.when(before % 2 == 0, F.col("_sum")).otherwise(-F.col("_sum"))
    return (
        minutes.select(*keys, signed.alias("_sum"))
        .groupBy(*keys)
        .agg(F.abs(F.sum("_sum")).alias("cost_ms"))
    )


def in_cost_range(costs: DataFrame, max_cost_ms: int = C.MAX_COST_MS) -> DataFrame:
    """Costs above zero and up to the bound, both as milliseconds."""
    return costs.where((F.col("cost_ms") > 0) & (F.col("cost_ms") <= max_cost_ms))


def rank_costs(costs: DataFrame, tie_break: list[str]) -> DataFrame:
    """Single costs, largest first."""
    return costs.orderBy(F.col("cost_ms").desc(), *tie_break)


def avg_sum_by_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Average (two places, half up), sum and count of an integer per key."""
    return (
        rows.groupBy(key)
        .agg(F.sum(value).alias("sum_cost"), F.count(value).alias("n_calls"))
        .select(
            key,
            numeric.half_up_average(F.col("sum_cost"), F.col("n_calls")).alias("avg_cost"),
            "sum_cost",
            "n_calls",
        )
    )


def cost_report(costs: DataFrame, uri: str = "uri") -> DataFrame:
    """Per URI: average, sum and number of paired calls, slowest first.

    A URI is reported up to its first `#`.
    """
    named = costs.withColumn(uri, tf.first_field(F.col(uri).cast("string"), "#"))
    return avg_sum_by_key(named, uri, "cost_ms").orderBy(F.col("avg_cost").desc(), uri)


def report_lines(report: DataFrame, uri: str = "uri") -> DataFrame:
    """The report as text lines `(uri,avg#sum)`."""
    shown = F.col("avg_cost").cast("float").cast("string")
    line = F.concat(F.lit("("), uri, F.lit(","), shown, F.lit("#"), F.col("sum_cost"), F.lit(")"))
    return report.select(line.alias("value"))


def merchant_of(lines: DataFrame, text: str = "value") -> DataFrame:
    """`merchant` of every line: its second word without brackets, else null."""
    second = tf.second_field(F.col(text), " ")
    name = F.when(tf.non_blank(F.col(text)), F.translate(second, "[]", ""))
    return lines.select(name.alias("merchant"))


def merchant_count(lines: DataFrame, text: str = "value", drop_null: bool = False) -> DataFrame:
    """Lines per merchant, most first. Lines without a merchant count under null."""
    merchants = merchant_of(lines, text)
    if drop_null:
        merchants = merchants.where(F.col("merchant").isNotNull())
    return (
        merchants.groupBy("merchant")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "merchant")
    )
