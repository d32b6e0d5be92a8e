"""Column functions over strings."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b"


def non_blank(text: Column) -> Column:
    """True when the string holds something besides whitespace.

    Most lines show it by their first character and are not trimmed.
    """
    trimmed = F.trim(text, F.lit(WHITESPACE)) != ""
    return F.when(F.substring(text, 1, 1) > " ", True).otherwise(F.coalesce(trimmed, F.lit(False)))


def contains_any(text: Column, tokens: list[str]) -> Column:
    """True when at least one of the tokens occurs."""
    return reduce(lambda a, b: a | b, [text.contains(t) for t in tokens])


def fields(text: Column, separator: str) -> Column:
    """Split on a one-character separator, without trailing empty fields.

    An empty string has one empty field; a string of separators alone has none.
    """
    if len(separator) != 1:
        raise ValueError("separator must be one character")
    kept = F.rtrim(text, F.lit(separator)) if separator != " " else F.rtrim(text)
    nothing = F.array().cast("array<string>")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", nothing)
        .otherwise(F.split(kept, re.escape(separator)))
    )


def first_field(text: Column, separator: str) -> Column:
    """The part before the first separator (the whole string if there is none)."""
    return F.substring_index(text, separator, 1)


def second_field(text: Column, separator: str) -> Column:
    """The second of `fields`, null when there is none."""
    kept = F.rtrim(text) if separator == " " else F.rtrim(text, F.lit(separator))
    head = F.substring_index(kept, separator, 2)
    return F.when(kept.contains(separator), F.substring_index(head, separator, -1))


def pieces(text: Column, stop: str) -> Column:
    """Split at line ends and at a one-character stop mark; may hold empty pieces."""
    return F.split(text, f"[\n{re.escape(stop)}]")


def in_list(value: Column, members: list[str], ignore_case: bool = False) -> Column:
    """Membership in a fixed list, optionally ignoring case."""
    if ignore_case:
        return F.lower(value).isin([m.lower() for m in members])
    return value.isin(members)


def once(value: Column) -> Column:
    """The same value, worked out once per row wherever it is used.

    Spark copies a projected expression into every filter and column that uses
    it. The one element of an unfolded array is not copied. Use it on its own
    in a select, for a value that is costly and used several times.
    """
    return F.explode(F.array(value))
