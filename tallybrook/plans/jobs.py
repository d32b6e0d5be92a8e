"""End-to-end jobs over paths and connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.operators import behavior, logs, relational, text, windows
from tallybrook.sinks import files as out_files
from tallybrook.sources import files, jdbc


CALL = ["uri", "context"]
# Rows that the sentences of one file are cut into, so that a row of the largest stays small.
REPORT_PARTS = 4096
PAIRINGS = {"two": logs.pair_cost, "fold": logs.folded_cost}


def _calls(spark: SparkSession, log_path: str) -> DataFrame:
    return logs.good_calls(
        logs.parse_call_lines(files.text_lines(spark, log_path), fields=logs.CALL_FIELDS)
    )


def _costs(spark: SparkSession, log_path: str, max_cost_ms: int, pairing: str) -> DataFrame:
    return logs.in_cost_range(PAIRINGS[pairing](_calls(spark, log_path), CALL), max_cost_ms)


def latency_report(
    spark: SparkSession, log_path: str, max_cost_ms: int = C.MAX_COST_MS, pairing: str = "two"
) -> DataFrame:
    """JSON API log to average, sum and number of calls per URI, slowest first.

    `pairing` "two" costs calls with exactly two lines; "fold" also takes calls
    that are repeated, as differences folded in the order of their times.
    `left_out` and `malformed_lines` give what is in neither.
    """
    return logs.cost_report(_costs(spark, log_path, max_cost_ms, pairing))


def left_out(spark: SparkSession, log_path: str) -> DataFrame:
    """Per URI, how many calls with other than two lines there are, and their lines."""
    return logs.unpaired(_calls(spark, log_path), CALL)


def malformed_lines(spark: SparkSession, log_path: str) -> DataFrame:
    """Marked lines that are no JSON or have no usable time."""
    return logs.bad_lines(logs.parse_call_lines(files.text_lines(spark, log_path)))


def write_latency_report(
    spark: SparkSession,
    log_path: str,
    out_path: str,
    max_cost_ms: int = C.MAX_COST_MS,
    pairing: str = "two",
    malformed_path: str | None = None,
    left_out_path: str | None = None,
) -> None:
    """The report as `(uri,avg#sum)` lines, and what it leaves out where paths are given for it."""
    report = latency_report(spark, log_path, max_cost_ms, pairing)
    out_files.write_lines(logs.report_lines(report), out_path)
    if malformed_path is not None:
        out_files.write_lines(malformed_lines(spark, log_path), malformed_path)
    if left_out_path is not None:
        counts = left_out(spark, log_path).orderBy("uri")
        out_files.write_lines(out_files.tab_lines(counts, "uri", "n_keys", "n_lines"), left_out_path)


def call_costs(
    spark: SparkSession, log_path: str, max_cost_ms: int = C.MAX_COST_MS, pairing: str = "two"
) -> DataFrame:
    """JSON API log to the cost of every paired call, largest first."""
    return logs.rank_costs(_costs(spark, log_path, max_cost_ms, pairing), CALL)


def access_log_counts(spark: SparkSession, log_path: str) -> DataFrame:
    """Access-log lines to hits per address and sliding window, by the time in each line."""
    hits = windows.timed_access_hits(files.text_lines(spark, log_path))
    return windows.sliding_counts(hits, "ip")


def merchant_report(spark: SparkSession, log_path: str) -> DataFrame:
    """Space-delimited log to hits per merchant, most first."""
    return logs.merchant_count(files.text_lines(spark, log_path))


def character_report(spark: SparkSession, path: str, by_count: bool = False) -> DataFrame:
    """Text to (ch, n), in byte order of the character or most frequent first."""
    counts = text.char_count(files.text_lines(spark, path))
    return counts.orderBy(F.col("n").desc(), "ch") if by_count else counts.orderBy("ch")


def write_character_report(spark: SparkSession, path: str, out_path: str) -> None:
    """`character TAB count` lines."""
    lines = out_files.tab_lines(character_report(spark, path), "ch", "n")
    out_files.write_lines(lines, out_path)


def keyword_report(
    spark: SparkSession,
    path: str,
    keyword: str = C.SEARCH_KEYWORD,
    stop: str = C.SENTENCE_STOP,
    *,
    parts: int = REPORT_PARTS,
) -> DataFrame:
    """Text files to the sentences with the keyword, joined per file name, in up to `parts` rows each.

    A file with fewer sentences has a row for each; ask for fewer parts where files are small.
    """
    lines = files.named_lines(spark, path)
    found = text.keyword_sentences(lines, ["file_name"], "value", keyword, stop)
    # Numbers of rows straight from a scan: the same when a task is run again.
    numbered = found.withColumn("row", F.monotonically_increasing_id())
    return text.sentences_by_key(numbered, ["file_name"], F.col("row"), trailing=True, parts=parts)


def department_totals(spark: SparkSession, employees: str, departments: str) -> DataFrame:
    """Comma-separated employees and departments to total salary per department name."""
    emp = files.delimited(
        spark,
        employees,
        "empno int, ename string, job string, mgr int, hired string, "
        "sal bigint, comm bigint, deptno string",
    )
    dept = files.delimited(spark, departments, "deptno string, dname string, loc string")
    return relational.lookup_sum(emp, "deptno", F.col("sal"), dept, "deptno", "dname")


def newest_dictionary_rows(
    spark: SparkSession,
    connection: jdbc.Connection,
    table: str,
    n: int = 10,
) -> DataFrame:
    """The n rows with the largest id of a database table, picked by the database."""
    return jdbc.read_table(spark, connection, query=jdbc.newest_query(table, n))


def profile_report(spark: SparkSession, path: str) -> DataFrame:
    """Behaviour messages, one per line, to preference profiles."""
    return behavior.user_profiles(files.text_lines(spark, path))
