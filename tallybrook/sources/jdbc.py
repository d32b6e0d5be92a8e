"""Database tables over JDBC. All connection values are parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a database is; the password never shows in a printed value."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        values = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }
        return {name: value for name, value in values.items() if value is not None}


@dataclass(frozen=True)
class Slices:
    """Split a read into `count` queries over ranges of a numeric or date column.

    The bounds only place the cuts; rows outside them are read as well.
    """

    column: str
    lower: int | str
    upper: int | str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def table_options(
    connection: Connection,
    table: str | None = None,
    query: str | None = None,
    slices: Slices | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or for a query the database runs itself.

    Without slices one task reads everything, which suits small tables only.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    if query is not None and slices is not None:
        table, query = f"({query}) sliced_query", None
    options = connection.options() | {"fetchsize": str(fetch_size)}
    options |= {"dbtable": table} if table is not None else {"query": query}
    return options | (slices.options() if slices else {})


def newest_query(table: str, n: int, key: str = "id") -> str:
    """The query for the n rows with the largest key, so that only they leave the database."""
    return f"SELECT * FROM {table} ORDER BY {key} DESC LIMIT {int(n)}"


def read_table(spark: SparkSession, connection: Connection, **kwargs) -> DataFrame:
    """A table or query as a DataFrame; filters and columns go to the database."""
    return spark.read.format("jdbc").options(**table_options(connection, **kwargs)).load()


def read_where(
    spark: SparkSession, connection: Connection, table: str, predicates: list[str]
) -> DataFrame:
    """A table read by one task per predicate; together they must cover all rows once."""
    properties = connection.options()
    url = properties.pop("url")
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
