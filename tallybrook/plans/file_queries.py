"""Registered queries: tables written to files by Spark and read back.

Calling one writes its files at once, under the shared folder, where they stay
until `session.remove_runs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import relational, text
from tallybrook.plans import jobs
from tallybrook.plans.log_queries import sliding_sql
from tallybrook.plans.tables import ACCESS_SQL, Query, access_log_lines, table
from tallybrook.plans.text_queries import KEYWORD_SQL, WORD_SQL
from tallybrook.session import run_dir
from tallybrook.sinks import files as sinks
from tallybrook.sources import files as sources
from tallybrook.sources.wide import wide_lines


def _source_of(path: str) -> F.Column:
    return F.regexp_extract(path, "source=([^/]+)", 1).alias("source")


def _text_files(spark: SparkSession, sf_dir: str, name: str, max_texts: int = 0) -> str:
    """The documents as text files, in one folder per source, any number per file or few."""
    out = run_dir(spark, name)
    docs = table(spark, sf_dir, "documents").select("source", F.col("text").alias("value"))
    docs.write.partitionBy("source").option("maxRecordsPerFile", max_texts).text(out)
    return out


def file_keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences found in text files, counted by the source in the file's path."""
    lines = sources.named_lines(spark, _text_files(spark, sf_dir, "search"), recursive=True)
    found = text.keyword_sentences(
        lines.select(_source_of("file_path"), "value"), ["source"], "value", "th", "."
    )
    return relational.count_by_key(found, "source")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per source in the listed text files."""
    files = sources.listing(spark, _text_files(spark, sf_dir, "listing"))
    return files.groupBy(_source_of("path")).agg(F.sum("length").alias("bytes"))


LISTING_SQL = """
SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source
"""


def whole_file_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters per source in text files that are read as one value each."""
    files = sources.whole_files(spark, _text_files(spark, sf_dir, "whole", 200))
    return files.groupBy(_source_of("file_path")).agg(
        F.sum(F.length("value").cast("bigint")).alias("n_chars")
    )


WHOLE_SQL = """
SELECT source, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY source
"""


def charset_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts over text files in ISO-8859-1, which holds all the documents' characters."""
    out = run_dir(spark, "charset")
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")))
    plain = {"sep": "\x01", "quote": "\x00", "emptyValue": "", "encoding": "ISO-8859-1"}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(**plain, **kept).csv(out)
    return text.word_count(sources.charset_lines(spark, out, "ISO-8859-1"))


def charset_wide_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts over text files in UTF-16, cut between tasks at whole code units."""
    out = run_dir(spark, "charset-wide")
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")))
    plain = {"sep": "\x01", "quote": "\x00", "emptyValue": "", "encoding": "UTF-16LE"}
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(**plain, **kept).csv(out)
    return text.word_count(wide_lines(spark, out, "UTF-16LE"))


def delimited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as tab-separated lines, read back typed, filtered, sorted."""
    out = run_dir(spark, "delimited")
    orders = table(spark, sf_dir, "orders")
    sinks.write_lines(sinks.tab_lines(orders), out)
    rows = sources.delimited(spark, out, orders.schema, "\t").where("o_totalprice > 100000")
    return relational.sort_desc(rows, "o_totalprice", "o_orderkey")


DELIMITED_SQL = """
SELECT * FROM orders WHERE o_totalprice > 100000
ORDER BY o_totalprice DESC, o_orderkey
"""


def json_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines, read back, filtered with a SQL string."""
    out = run_dir(spark, "json")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    sinks.write_json_lines(events, out)
    return sources.json_lines(spark, out, events.schema).where("value > 26")


JSON_LINES_SQL = "SELECT event_id, user_id, event_type, value FROM events WHERE value > 26"


def json_inferred_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as JSON lines and read back without a schema."""
    out = run_dir(spark, "inferred")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_json_lines(customers, out)
    return sources.json_lines(spark, out)


INFERRED_SQL = """
SELECT c_custkey, c_name, c_acctbal FROM customer
"""


def appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, overwritten, appended to, and read back: rows per nation."""
    out = run_dir(spark, "appended")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sinks.write_parquet(customers, out)
    sinks.write_parquet(customers.where("c_nationkey < 10"), out, "overwrite")
    sinks.write_parquet(customers.where("c_nationkey < 20"), out, "append")
    return relational.count_by_key(spark.read.parquet(out), "c_nationkey")


APPENDED_SQL = """
SELECT c_nationkey, count(*) * CASE WHEN c_nationkey < 10 THEN 2 ELSE 1 END AS n
FROM customer WHERE c_nationkey < 20 GROUP BY c_nationkey
"""


def access_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log files to sliding counts per address, by the time in each line."""
    out = run_dir(spark, "access")
    sinks.write_lines(access_log_lines(table(spark, sf_dir, "events")).select("value"), out)
    counts = jobs.access_log_counts(spark, out)
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


QUERIES = {
    "file_keyword_search": Query(file_keyword_search, KEYWORD_SQL),
    "file_listing": Query(file_listing, LISTING_SQL),
    "whole_file_chars": Query(whole_file_chars, WHOLE_SQL),
    "charset_words": Query(charset_words, WORD_SQL),
    "charset_wide_words": Query(charset_wide_words, WORD_SQL),
    "delimited_rows": Query(delimited_rows, DELIMITED_SQL),
    "json_line_rows": Query(json_line_rows, JSON_LINES_SQL),
    "json_inferred_rows": Query(json_inferred_rows, INFERRED_SQL),
    "appended_rows": Query(appended_rows, APPENDED_SQL),
    "access_log_files": Query(access_log_files, sliding_sql(ACCESS_SQL, "ip")),
}
