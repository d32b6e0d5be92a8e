"""Registered queries: joins, totals, sorting, sets, JSON and SQL over tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import numeric
from tallybrook.functions.text import once
from tallybrook.operators import groups, reduce, relational
from tallybrook.plans.tables import Query, table
from tallybrook.session import run_dir


def lookup_join_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = numeric.cents(F.col("c_acctbal"))
    return relational.lookup_sum(
        table(spark, sf_dir, "customer"),
        "c_nationkey",
        balance,
        table(spark, sf_dir, "nation"),
        "n_nationkey",
        "n_name",
    )


LOOKUP_SQL = """
SELECT n_name, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
"""


def pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"
    )
    return relational.salted_join(orders, customers, ["custkey"], F.col("o_orderkey"))


PAIR_JOIN_SQL = """
SELECT c_custkey AS custkey, o_orderkey, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def _kind(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == event_type)
        .select("user_id", "event_id", numeric.cents(F.col("value")).alias("amount"))
    )


def cogroup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, purchases = _kind(spark, sf_dir, "click"), _kind(spark, sf_dir, "purchase")
    return relational.cogroup_counts(clicks, purchases, ["user_id"])


COGROUP_SQL = """
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS n_left,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_right
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id
"""


def cogroup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All amounts of both kinds per user, sorted and shown as text."""
    clicks, purchases = _kind(spark, sf_dir, "click"), _kind(spark, sf_dir, "purchase")
    lists = groups.cogroup_lists(clicks, purchases, ["user_id"], "amount", "event_id", parts=1)
    shown = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists.columns[2:]}
    return lists.withColumns(shown)


COGROUP_LISTS_SQL = """
WITH e AS (SELECT user_id, event_type, CAST(round(value * 100) AS BIGINT) AS amount FROM events)
SELECT user_id, CAST(0 AS BIGINT) AS part,
       coalesce(string_agg(CAST(amount AS VARCHAR), ',' ORDER BY amount)
                FILTER (WHERE event_type = 'click'), '') AS left_values,
       coalesce(string_agg(CAST(amount AS VARCHAR), ',' ORDER BY amount)
                FILTER (WHERE event_type = 'purchase'), '') AS right_values
FROM e WHERE event_type IN ('click', 'purchase') GROUP BY user_id
"""


def union_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = table(spark, sf_dir, "documents").select(F.col("lang").alias("value"))
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("value"))
    return relational.count_by_value(relational.union_all(langs, types))


UNION_SQL = """
SELECT value, count(*) AS n FROM (
  SELECT lang AS value FROM documents UNION ALL SELECT event_type FROM events) GROUP BY value
"""


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return relational.count_by_value(rows)


VALUE_COUNTS_SQL = """
SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL
"""


def distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type").distinct()


def json_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = once(F.from_json("props", "k int")).alias("p")
    parsed = table(spark, sf_dir, "events").select("event_id", props)
    return parsed.select("event_id", "p.k").where("k > 26")


JSON_FILTER_SQL = """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 26
"""


def rows_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as JSON; the price in its two places and the date as a day."""
    shown = {"o_totalprice": F.col("o_totalprice").cast("decimal(20,2)").cast("string"), "o_orderdate": F.to_date("o_orderdate")}
    return relational.rows_as_json(table(spark, sf_dir, "orders").withColumns(shown))


ROWS_AS_JSON_SQL = """
SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey,
  'o_orderstatus': o_orderstatus, 'o_totalprice': printf('%.2f', o_totalprice),
  'o_orderdate': strftime(o_orderdate, '%Y-%m-%d'), 'o_orderpriority': o_orderpriority}) AS VARCHAR) AS value
FROM orders
"""


def topn_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relational.top_n(orders, 10, "o_totalprice", "o_orderkey")


TOPN_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10
"""

_VIEW_SQL = "SELECT * FROM {customer} ORDER BY c_custkey DESC LIMIT 10"


def sql_view_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sql_over(spark, _VIEW_SQL, customer=table(spark, sf_dir, "customer"))


_JOIN_SQL = """
SELECT n.n_name, c.c_mktsegment, count(*) AS n_orders
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
WHERE o.o_totalprice > 1000 GROUP BY n.n_name, c.c_mktsegment
"""


def sql_view_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables joined in SQL text."""
    frames = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation")}
    return relational.sql_over(spark, _JOIN_SQL, **frames)


def dictionary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space-separated lines to the six fields of a dictionary row."""
    customers = table(spark, sf_dir, "customer")
    kind = F.concat(F.lit("kind"), "c_nationkey")
    fields = [kind, F.col("c_custkey"), F.concat(F.lit("n"), "c_custkey"), F.col("c_nationkey"), F.col("c_custkey") % 7]
    status = F.when(F.col("c_acctbal") > 0, "NORMAL").otherwise("FROZEN")
    return relational.dictionary_rows(customers.select(F.concat_ws(" ", *fields, status).alias("value")))


DICTIONARY_SQL = """
SELECT 'kind' || c_nationkey AS type, CAST(c_custkey AS VARCHAR) AS code, 'n' || c_custkey AS name,
       CAST(c_nationkey AS VARCHAR) AS parent_code, CAST(c_custkey % 7 AS INTEGER) AS sort,
       CASE WHEN c_acctbal > 0 THEN 'NORMAL' ELSE 'FROZEN' END AS status
FROM customer
"""


def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return relational.sort_desc(orders, "o_totalprice", "o_orderkey")


SORT_SQL = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey"


def listed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per type, with one list kept and another dropped."""
    events = table(spark, sf_dir, "events")
    kept = relational.keep_listed(events, "event_type", ["click", "view", "error"])
    dropped = relational.drop_listed(kept, "event_type", ["ERROR"], ignore_case=True)
    return relational.count_by_key(dropped, "event_type")


LISTED_SQL = """
SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type
"""


def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the order found meets the predicate; which order it is is not defined."""
    dear = F.col("o_totalprice") > 1000
    return relational.first_match(table(spark, sf_dir, "orders"), dear).select(dear.alias("meets"))


FIRST_MATCH_SQL = "SELECT o_totalprice > 1000 AS meets FROM orders WHERE o_totalprice > 1000 LIMIT 1"


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About a tenth of the line items, drawn by their key."""
    return relational.sample_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.1)


SAMPLE_SQL = """
SELECT * FROM lineitem
WHERE substr(md5(CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR)), 1, 8) < '1999999a'
"""


def reduced_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest amount, in cents, that all of a user's events of a type are multiples of."""
    amounts = table(spark, sf_dir, "events").select("user_id", "event_type", numeric.cents(F.col("value")).alias("amount"))
    return reduce.reduce_by_key(amounts, ["user_id", "event_type"], "amount", math.gcd)


REDUCED_SQL = """
SELECT user_id, event_type, list_reduce(list(amount), lambda a, b: gcd(a, b)) AS amount
FROM (SELECT user_id, event_type, CAST(round(value * 100) AS BIGINT) AS amount FROM events)
GROUP BY user_id, event_type
"""

PARTS = 16


def partitioned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt by customer into PARTS tasks, each written as one file: rows, and files, per part."""
    out = run_dir(spark, "partitioned")
    dealt = reduce.partitioned(table(spark, sf_dir, "orders"), F.col("o_custkey"), PARTS)
    dealt.select("o_orderkey", "o_custkey").write.parquet(out)
    written = spark.read.parquet(out).select((F.col("o_custkey") % PARTS).alias("part"), F.col("_metadata.file_name").alias("file"))
    return written.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("n_files"))


PARTITIONED_SQL = f"SELECT o_custkey % {PARTS} AS part, count(*) AS n, CAST(1 AS BIGINT) AS n_files FROM orders GROUP BY part"


def first_match_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the order that any task found first meets the predicate, a function of the row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    found = reduce.any_match(orders, lambda row: row["o_totalprice"] > 1000)
    rows = [] if found is None else [(found["o_totalprice"] > 1000,)]
    return spark.createDataFrame(rows, "meets boolean")


QUERIES = {
    "lookup_join_sum": Query(lookup_join_sum, LOOKUP_SQL),
    "pair_join": Query(pair_join, PAIR_JOIN_SQL),
    "cogroup_counts": Query(cogroup_counts, COGROUP_SQL),
    "cogroup_lists": Query(cogroup_lists, COGROUP_LISTS_SQL),
    "union_count": Query(union_count, UNION_SQL),
    "value_counts": Query(value_counts, VALUE_COUNTS_SQL),
    "distinct_types": Query(distinct_types, "SELECT DISTINCT event_type FROM events"),
    "json_filter": Query(json_filter, JSON_FILTER_SQL),
    "rows_as_json": Query(rows_as_json, ROWS_AS_JSON_SQL),
    "topn_orders": Query(topn_orders, TOPN_SQL),
    "sql_view_topn": Query(sql_view_topn, _VIEW_SQL.format(customer="customer")),
    "sql_view_join": Query(sql_view_join, _JOIN_SQL.format(orders="orders", customer="customer", nation="nation")),
    "dictionary_rows": Query(dictionary_rows, DICTIONARY_SQL),
    "sort_desc": Query(sort_desc, SORT_SQL),
    "listed_events": Query(listed_events, LISTED_SQL),
    "first_match": Query(first_match, FIRST_MATCH_SQL),
    "first_match_parallel": Query(first_match_parallel, FIRST_MATCH_SQL),
    "reduced_pairs": Query(reduced_pairs, REDUCED_SQL),
    "partitioned_keys": Query(partitioned_keys, PARTITIONED_SQL),
    "sample_rows": Query(sample_rows, SAMPLE_SQL),
}
