"""Files: lines, JSON lines, delimited rows, whole files, listings."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """`value` per line. Large files are split between tasks."""
    return spark.read.option("recursiveFileLookup", recursive).text(path)


def named_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """`value`, `file_name` (base name) and `file_path` per line."""
    lines = text_lines(spark, path, recursive)
    return lines.select(
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def charset_lines(spark: SparkSession, path: str | list[str], charset: str) -> DataFrame:
    """`value` per line of a file in a charset other than UTF-8, such as GBK.

    The line reader hands over the raw bytes of each line, and they are decoded
    in place, so large files still split between tasks. It holds for charsets
    in which the byte of a line feed is always a line feed (GBK, GB18030, Big5,
    ISO-8859); UTF-16 and UTF-32 are read by `wide.wide_lines`. Bytes that are not valid come out as
    the replacement character.
    """
    with _any_charset(spark):
        return spark.read.text(path).select(
            F.decode(F.col("value").cast("binary"), charset).alias("value")
        )


_CHARSET_LOCK = threading.Lock()


@contextmanager
def _any_charset(spark: SparkSession) -> Iterator[None]:
    """Let `decode` take any charset of the JVM and replace invalid bytes.

    Spark reads both settings when a column is resolved, which select does at
    once, so the session is left as it was. One reader at a time changes them,
    so each restores what was set before the first.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    with _CHARSET_LOCK:
        before = {name: spark.conf.get(name, None) for name in names}
        for name in names:
            spark.conf.set(name, "true")
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """One row per JSON line. Without a schema Spark reads the input twice."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    separator: str = ",",
    mode: str = "PERMISSIVE",
    quote: str = "",
) -> DataFrame:
    """Typed rows from separated text without a header.

    Lines are split at every separator; quotes and backslashes are characters
    like others unless `quote` names the one that fields are quoted with. A field that does not fit its type is null; mode FAILFAST fails the job
    instead and DROPMALFORMED drops the row.
    """
    return (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("mode", mode)
        .option("quote", quote)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def listing(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """`path`, `length`, `modified` per file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def whole_files(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """`file_path` and `value`, one row per file, for files that fit in a row.

    Use `text_lines` for files of any size.
    """
    files = spark.read.option("recursiveFileLookup", recursive).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "value")
