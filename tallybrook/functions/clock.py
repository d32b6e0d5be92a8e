"""Column functions over log times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A day, a time to the millisecond or to the second, in UTC.
_LOG_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?Z$"


def parse_log_time(text: Column) -> Column:
    """UTC log time to timestamp, null when it has neither accepted format.

    The pattern check keeps the two formats exact. The cast behind it reads the
    string directly; a format-driven parse costs an exception per row for every
    line in the second format.
    """
    return F.when(text.rlike(_LOG_TIME), text.try_cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def millis_between(start: Column, end: Column) -> Column:
    """Whole milliseconds from start to end, truncated once, after subtracting.

    Rounding both ends first would be off by one for microsecond times. Times
    without a zone are taken as session time.
    """
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.call_function("div", micros, F.lit(1000))
