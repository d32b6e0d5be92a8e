"""Registered queries: API latency, merchants, behaviour, access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import clock, numeric
from tallybrook.operators import behavior, logs, windows
from tallybrook.plans import tables as t
from tallybrook.plans.tables import Query, table
from tallybrook.sinks.files import tuple_lines

DAY_MS = 86_400_000

# Average of `s` over `n`, two places, half up, in whole numbers.
_AVG = "CAST((CAST(s AS HUGEINT) * 200 + n) // (2 * n) AS DOUBLE) / 100"


def _plain(report: DataFrame) -> DataFrame:
    """The report with its average as double, which every engine shows alike."""
    return report.withColumn("avg_cost", F.col("avg_cost").cast("double"))


def _daily_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return logs.pair_cost(events, ["user_id", "event_type", "day"])


_DAILY_SQL = """
  SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
         (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS cost_ms
  FROM events GROUP BY ALL HAVING count(*) = 2
"""


def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = logs.in_cost_range(_daily_costs(spark, sf_dir), DAY_MS)
    return _plain(logs.cost_report(costs, "event_type"))


LATENCY_SQL = f"""
SELECT event_type, {_AVG} AS avg_cost, s AS sum_cost, n AS n_calls FROM (
  SELECT event_type, CAST(sum(cost_ms) AS BIGINT) AS s, count(*) AS n
  FROM ({_DAILY_SQL}) WHERE cost_ms > 0 AND cost_ms <= {DAY_MS} GROUP BY event_type)
ORDER BY avg_cost DESC, event_type
"""


def pair_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = _daily_costs(spark, sf_dir)
    ranked = logs.rank_costs(costs, ["user_id", "event_type", "day"])
    return ranked.withColumn("day", F.col("day").cast("string"))


PAIR_SQL = f"{_DAILY_SQL} ORDER BY cost_ms DESC, user_id, event_type, day"


def folded_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of all calls of a user and type, repeated calls added up."""
    events = table(spark, sf_dir, "events")
    costs = logs.folded_cost(events, ["user_id", "event_type"])
    return logs.in_cost_range(costs, 1000 * DAY_MS)


FOLDED_SQL = f"""
SELECT user_id, event_type, CAST(abs(sum(CASE WHEN r % 2 = 1 THEN ms ELSE -ms END)) AS BIGINT) AS cost_ms
FROM (SELECT user_id, event_type, ms, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ms) AS r
      FROM (SELECT user_id, event_type, epoch_us(date_trunc('millisecond', ts)) // 1000 AS ms FROM events))
GROUP BY user_id, event_type HAVING cost_ms > 0 AND cost_ms <= {1000 * DAY_MS}
"""


def json_log_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.api_log_lines(table(spark, sf_dir, "events"))
    calls = logs.good_calls(logs.parse_call_lines(lines, fields=logs.CALL_FIELDS))
    costs = logs.in_cost_range(logs.pair_cost(calls, ["uri", "context"]), DAY_MS)
    return _plain(logs.cost_report(costs))


JSON_LOG_SQL = f"""
WITH pairs AS (
  SELECT uri, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS cost_ms
  FROM ({t.API_LOG_SQL}) GROUP BY uri, user_id, day HAVING count(*) = 2)
SELECT uri, {_AVG} AS avg_cost, s AS sum_cost, n AS n_calls FROM (
  SELECT uri, CAST(sum(cost_ms) AS BIGINT) AS s, count(*) AS n
  FROM pairs WHERE cost_ms > 0 AND cost_ms <= {DAY_MS} GROUP BY uri)
ORDER BY avg_cost DESC, uri
"""


def json_log_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs within the default bound, largest first."""
    lines = t.api_log_lines(table(spark, sf_dir, "events"))
    calls = logs.good_calls(logs.parse_call_lines(lines, fields=logs.CALL_FIELDS))
    costs = logs.in_cost_range(logs.pair_cost(calls, ["uri", "context"]))
    return logs.rank_costs(costs, ["uri", "context"])


JSON_COSTS_SQL = f"""
SELECT uri, '{{"user_id":' || user_id || ',"day":"' || day || '"}}' AS context, cost_ms FROM (
  SELECT uri, user_id, day, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS cost_ms
  FROM ({t.API_LOG_SQL}) GROUP BY uri, user_id, day HAVING count(*) = 2)
WHERE cost_ms > 0 AND cost_ms <= 1000000
ORDER BY cost_ms DESC, uri, context
"""


def json_log_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.damaged_api_log_lines(table(spark, sf_dir, "events"))
    return logs.bad_lines(logs.parse_call_lines(lines))


BAD_LINES_SQL = """
SELECT '{"message":"/api/' || event_type || ' @P ' || event_id AS bad_line FROM events WHERE event_id % 10 = 0
"""


def json_log_unpaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the report leaves out: calls with other than two lines, per URI."""
    lines = t.api_log_lines(table(spark, sf_dir, "events"))
    return logs.unpaired(logs.good_calls(logs.parse_call_lines(lines, fields=logs.CALL_FIELDS)), ["uri", "context"])


UNPAIRED_SQL = f"""
SELECT uri, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_lines FROM (
  SELECT uri, count(*) AS n FROM ({t.API_LOG_SQL}) GROUP BY uri, user_id, day HAVING count(*) <> 2)
GROUP BY uri
"""


def json_log_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with repeated calls folded in the order of their times."""
    lines = t.api_log_lines(table(spark, sf_dir, "events"))
    calls = logs.good_calls(logs.parse_call_lines(lines, fields=logs.CALL_FIELDS))
    costs = logs.in_cost_range(logs.folded_cost(calls, ["uri", "context"]), DAY_MS)
    return _plain(logs.cost_report(costs))


JSON_FOLDED_SQL = f"""
WITH ranked AS (
  SELECT uri, user_id, day, ms, row_number() OVER (PARTITION BY uri, user_id, day ORDER BY ms) AS r
  FROM (SELECT uri, user_id, day, epoch_us(ts) // 1000 AS ms FROM ({t.API_LOG_SQL}))),
costs AS (
  SELECT uri, CAST(abs(sum(CASE WHEN r % 2 = 1 THEN ms ELSE -ms END)) AS BIGINT) AS cost_ms
  FROM ranked GROUP BY uri, user_id, day)
SELECT uri, {_AVG} AS avg_cost, s AS sum_cost, n AS n_calls FROM (
  SELECT uri, CAST(sum(cost_ms) AS BIGINT) AS s, count(*) AS n
  FROM costs WHERE cost_ms > 0 AND cost_ms <= {DAY_MS} GROUP BY uri)
ORDER BY avg_cost DESC, uri
"""


def avg_sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = table(spark, sf_dir, "events").select(
        "event_type", numeric.cents(F.col("value")).alias("amount")
    )
    return _plain(logs.avg_sum_by_key(amounts, "event_type", "amount"))


AVG_SUM_SQL = f"""
SELECT event_type, {_AVG} AS avg_cost, s AS sum_cost, n AS n_calls FROM (
  SELECT event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS s, count(*) AS n
  FROM events GROUP BY event_type)
"""


def log_time_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.date_format("ts", C.LOG_TIME_FORMAT_NO_MILLIS)
    millis = F.date_format("ts", C.LOG_TIME_FORMAT)
    shown = F.when(F.col("event_type") == "signup", seconds).otherwise(millis)
    parsed = clock.epoch_millis(clock.parse_log_time(shown))
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("millis"))


LOG_TIME_SQL = """
SELECT event_id, epoch_us(date_trunc(
  CASE WHEN event_type = 'signup' THEN 'second' ELSE 'millisecond' END, ts)) // 1000 AS millis
FROM events
"""


def merchant_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.merchant_count(t.merchant_log_lines(table(spark, sf_dir, "events")))


MERCHANT_SQL = """
SELECT CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS merchant, count(*) AS n
FROM events GROUP BY merchant ORDER BY n DESC, merchant
"""


def merchant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(merchant,count)` lines, most first."""
    return tuple_lines(merchant_count(spark, sf_dir), "merchant", "n")


MERCHANT_LINES_SQL = f"""
SELECT '(' || coalesce(merchant, 'null') || ',' || n || ')' AS value FROM ({MERCHANT_SQL})
"""


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.user_profiles(t.behavior_messages(table(spark, sf_dir, "events")))


PROFILE_SQL = f"""
SELECT user_id, CAST(0 AS BIGINT) AS part, count(*) AS n_types,
       string_agg(info_type || ':' || n, ',' ORDER BY info_type || ':' || n) AS profile
FROM (SELECT user_id, info_type, count(*) AS n FROM ({t.BEHAVIOR_SQL}) GROUP BY ALL)
GROUP BY user_id
"""


def preference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = t.behavior_messages(table(spark, sf_dir, "events"))
    return behavior.preference_counts(behavior.preferences(messages))


PREFERENCE_SQL = f"""
SELECT user_id, info_type, count(*) AS n FROM ({t.BEHAVIOR_SQL}) GROUP BY ALL
"""


def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(table(spark, sf_dir, "events"), "user_id")


def sliding_sql(source: str, key: str) -> str:
    return f"""
SELECT date_trunc('minute', ts) - to_minutes(CAST(back AS INTEGER)) AS window_start, {key}, count(*) AS n
FROM ({source}), generate_series(0, 9) AS g(back) GROUP BY ALL
"""


def access_log_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.access_log_lines(table(spark, sf_dir, "events"))
    return windows.sliding_counts(windows.access_hits(lines, keep=["ts"]), "ip")


QUERIES = {
    "latency_report": Query(latency_report, LATENCY_SQL),
    "pair_latency": Query(pair_latency, PAIR_SQL),
    "folded_latency": Query(folded_latency, FOLDED_SQL),
    "json_log_report": Query(json_log_report, JSON_LOG_SQL),
    "json_log_costs": Query(json_log_costs, JSON_COSTS_SQL),
    "json_log_bad_lines": Query(json_log_bad_lines, BAD_LINES_SQL),
    "json_log_unpaired": Query(json_log_unpaired, UNPAIRED_SQL),
    "json_log_folded": Query(json_log_folded, JSON_FOLDED_SQL),
    "avg_sum_by_key": Query(avg_sum_by_key, AVG_SUM_SQL),
    "log_time_millis": Query(log_time_millis, LOG_TIME_SQL),
    "merchant_count": Query(merchant_count, MERCHANT_SQL),
    "merchant_lines": Query(merchant_lines, MERCHANT_LINES_SQL),
    "user_profile": Query(user_profile, PROFILE_SQL),
    "preference_counts": Query(preference_counts, PREFERENCE_SQL),
    "sliding_count": Query(sliding_count, sliding_sql("FROM events", "user_id")),
    "access_log_count": Query(access_log_count, sliding_sql(t.ACCESS_SQL, "ip")),
}
