"""Streams over directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader


def _as_glob(path: str) -> str:
    """The path as a pattern with one match, so a single file works like a folder."""
    if any(c in path for c in "*?[]{}"):
        return path
    return f"{path[:-1]}[{path[-1]}]"


def _limited(reader: DataStreamReader, max_files: int | None, max_bytes: int | None = None) -> DataStreamReader:
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    for name, value in limits.items():
        reader = reader if value is None else reader.option(name, value)
    return reader


def text_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """`value` per line of every file that appears; each file is read once.

    A batch takes all files that are there, or `max_files`, or files of `max_bytes` together,
    where one of those rate limits is asked for; what is counted per batch
    then depends on it. Files come in the order of their modification times. With
    `archive`, a folder outside the path, finished files move there and are not listed
    any more; a batch's files move while later batches run.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("a stream is limited by files or by bytes, not by both")
    reader = _limited(spark.readStream, max_files, max_bytes)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Rows of every Parquet file in a table folder, of a single file, or of a pattern's matches."""
    return _limited(spark.readStream.schema(schema), max_files).parquet(_as_glob(path.rstrip("/")))


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """`value` per line from a socket. Not replayable: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
