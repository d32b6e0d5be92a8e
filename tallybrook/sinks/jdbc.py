"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybrook.sources.jdbc import Connection


def write_options(
    connection: Connection, table: str, batch_size: int = 10_000, connections: int = 16
) -> dict[str, str]:
    """Writer options; `connections` caps how many tasks write at a time."""
    return connection.options() | {
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }


def append(rows: DataFrame, connection: Connection, table: str, **kwargs) -> None:
    """Append rows to a table.

    A task writes its partition in one transaction, but a task that is lost
    after its commit is run again: append to a staging table and move the rows
    by key where a repeated row matters.
    """
    options = write_options(connection, table, **kwargs)
    rows.write.format("jdbc").options(**options).mode("append").save()
