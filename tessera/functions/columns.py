"""Small column expressions used in several places."""

from __future__ import annotations

import re

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open end of a type-2 row, the e-mail pattern of the quality rules, the watermark
# text format and the watermark types compared as times and as numbers.
OPEN_END = "9999-12-31 23:59:59.999"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
TIME_WATERMARKS = ("datetime", "date", "timestamp")
NUMBER_WATERMARKS = ("int", "bigint", "smallint")


def as_time(value: str | datetime | Column) -> Column:
    """A run time as a timestamp without time zone, the type of the lake's event columns."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def span(text: str) -> Column:
    """Interval such as ``15 minutes`` or ``7 days``."""
    return F.expr(f"INTERVAL {text}")


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in per cent; null for an empty group."""
    return F.try_divide(part * F.lit(100.0), whole)


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def bin_time(column: str | Column, width: str) -> Column:
    """Start of the fixed-width bin a time falls in, for example ``5 minutes``.

    Works on batch rows; streaming aggregates group by ``F.window`` itself.
    """
    return F.window(column, width)["start"].cast("timestamp_ntz")


def hour_of(column: str | Column) -> Column:
    return F.date_trunc("hour", column).cast("timestamp_ntz")


def day_of(column: str | Column) -> Column:
    return F.date_trunc("day", column).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole second boundaries crossed from start to end."""
    return F.timestamp_diff(
        "SECOND", F.date_trunc("second", start), F.date_trunc("second", end)
    ).cast("long")


def watermark_text(value: Column, data_type: T.DataType) -> Column:
    """Watermark as text: times with milliseconds, everything else as it prints."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, WATERMARK_FORMAT)
    return value.cast("string")


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(?:\.[A-Za-z_][A-Za-z0-9_$]*){0,3}")
_ARITHMETIC = re.compile(r"(?:[A-Za-z_][A-Za-z0-9_]*|`[^`;]+`|[0-9]+(?:\.[0-9]+)?|[-+*/%()]|\s)+")
#: A call, or two operands side by side, as in a statement.
_CALL = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\s*\(|[A-Za-z0-9_`)]\s+[A-Za-z0-9_`(]")


def checked_name(name: str) -> str:
    """A table or column name that can stand in generated SQL: letters, digits, _ and $, with up to three dots."""
    if not _NAME.fullmatch(name or ""):
        raise ValueError(f"not a table or column name: {name!r}")
    return name


def checked_clause(clause: str) -> str:
    """A filter clause of one expression: no statement end and no comment outside of quoted text."""
    outside = re.sub(r"'(?:[^']|'')*'", "", clause)
    if re.search(r";|--|/\*|'", outside):
        raise ValueError(f"not a filter clause: {clause!r}")
    return clause


def checked_arithmetic(text: str) -> str:
    """An expression of column names, numbers, arithmetic signs and parentheses."""
    if not _ARITHMETIC.fullmatch(text) or _CALL.search(text):
        raise ValueError(f"not arithmetic over columns: {text!r}")
    return text
