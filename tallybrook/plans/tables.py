"""The given tables, and log lines and messages derived from them by Spark."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions.text import once


class Query(NamedTuple):
    """A registered query and, where SQL can say the same, its SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def api_log_lines(events: DataFrame) -> DataFrame:
    """JSON API log lines: errors carry no marker, signups have no millis."""
    millis = F.date_format("ts", C.LOG_TIME_FORMAT)
    seconds = F.date_format("ts", C.LOG_TIME_FORMAT_NO_MILLIS)
    marker = F.when(F.col("event_type") == "error", "@X").when(F.col("value") < 10, "@P")
    line = F.struct(
        F.when(F.col("event_type") == "signup", seconds).otherwise(millis).alias("logTime"),
        F.concat(F.lit("/api/"), "event_type", F.lit(" "), marker.otherwise("@R")).alias("message"),
        F.lit("INFO").alias("level"),
        F.struct("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).alias("contextMap"),
        F.col("event_id").cast("string").alias("traceId"),
    )
    return events.select(once(F.to_json(line)).alias("value"))


def damaged_api_log_lines(events: DataFrame) -> DataFrame:
    """API log lines of which every tenth breaks off, and is no JSON any more."""
    whole = api_log_lines(events.where("event_id % 10 <> 0"))
    start = F.concat(F.lit('{"message":"/api/'), "event_type", F.lit(" @P "), "event_id")
    return whole.unionByName(events.where("event_id % 10 = 0").select(start.alias("value")))


# Lines of api_log_lines that carry a marker, as columns.
API_LOG_SQL = """
  SELECT '/api/' || event_type AS uri, user_id, CAST(ts AS DATE) AS day,
         date_trunc(CASE WHEN event_type = 'signup' THEN 'second' ELSE 'millisecond' END, ts) AS ts
  FROM events WHERE event_type <> 'error'
"""


def merchant_log_lines(events: DataFrame) -> DataFrame:
    """Space-delimited log lines; those of errors hold the time alone."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    whole = F.concat(
        time,
        F.lit(" ["),
        "user_id",
        F.lit("] </api/"),
        "event_type",
        F.lit(">, <0>, <"),
        F.floor("value").cast("string"),
        F.lit("ms>"),
    )
    line = F.when(F.col("event_type") == "error", time).otherwise(whole)
    return events.select(once(line).alias("value"))


def behavior_messages(events: DataFrame) -> DataFrame:
    """`user,behaviour,type,type` messages; errors are of another behaviour."""
    kind = F.when(F.col("event_type") == "error", "AUDIO").otherwise(C.KEPT_BEHAVIOR)
    tier = F.concat(F.lit("tier"), F.floor(F.col("value") / 10).cast("string"))
    return events.select(once(F.concat_ws(",", "user_id", kind, "event_type", tier)).alias("value"))


BEHAVIOR_SQL = """
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         unnest([event_type, 'tier' || CAST(floor(value / 10) AS BIGINT)]) AS info_type
  FROM events WHERE event_type <> 'error'
"""


def access_log_lines(events: DataFrame) -> DataFrame:
    """Access-log lines with `ts`; signups lack a field, errors lack the path."""
    path = F.when(F.col("event_type") == "error", F.lit("-"))
    path = path.otherwise(F.concat(F.lit("/"), "event_type"))
    time = F.date_format("ts", C.LOG_TIME_FORMAT)
    head = F.concat(F.lit("10.0.0."), "user_id", F.lit(" - - "), time, F.lit(" z GET"))
    code = F.when(F.col("event_type") == "signup", F.lit(" ")).otherwise(F.lit(" 200 "))
    return events.select("ts", once(F.concat(head, code, path)).alias("value"))


ACCESS_SQL = """
  SELECT ts, '10.0.0.' || user_id AS ip FROM events
  WHERE event_type NOT IN ('signup', 'error')
"""
