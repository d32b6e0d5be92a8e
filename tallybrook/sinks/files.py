"""Files: Parquet, text in two line formats, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The default sink. Mode `append` adds part files, `overwrite` replaces all."""
    rows.write.mode(mode).parquet(path)


def tuple_lines(rows: DataFrame, key: str, value: str) -> DataFrame:
    """`(key,value)` lines; a missing value shows as null."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (key, value)]
    return rows.select(F.concat(F.lit("("), shown[0], F.lit(","), shown[1], F.lit(")")).alias("value"))


def tab_lines(rows: DataFrame, *columns: str) -> DataFrame:
    """Columns separated by tabs, without quoting; a missing value is empty.

    The job fails on a value that holds a tab or a line end, which no reader
    could tell from the end of the field.
    """

    def shown_as(column: str):
        value = F.coalesce(F.col(column).cast("string"), F.lit(""))
        message = F.concat(F.lit(f"{column} holds a tab or a line end: "), value)
        return F.when(value.rlike(r"[\t\n\r]"), F.raise_error(message)).otherwise(value)

    shown = [shown_as(c) for c in columns or rows.columns]
    return rows.select(F.concat_ws("\t", *shown).alias("value"))


def write_lines(
    lines: DataFrame, path: str, mode: str = "overwrite", line_separator: str = "\n"
) -> None:
    """One-column text output, in part files named in the order of the rows.

    Of sorted rows, the files one after another in name order are one sorted
    file, however many tasks write it.
    """
    lines.write.mode(mode).option("lineSep", line_separator).text(path)


def write_json_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(path)
