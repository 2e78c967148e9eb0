"""Incremental loading: filters above a watermark and the next watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import NUMBER_WATERMARKS, TIME_WATERMARKS, checked_clause, watermark_text

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def watermark_literal(value: str, kind: str, column_type: T.DataType) -> Column:
    """The watermark text as a literal of the column's own type, so the source can push it down."""
    kind = kind.lower()
    if kind in TIME_WATERMARKS and isinstance(column_type, _TIMES):
        return F.lit(value).cast(column_type)
    if kind in NUMBER_WATERMARKS:
        return F.lit(int(value))
    return F.lit(str(value))


def filter_above(
    df: DataFrame,
    column: str | None,
    value: str | None,
    kind: str = "datetime",
    lookback: str | None = None,
) -> DataFrame:
    """Rows whose watermark column is strictly above ``value``; all rows without a watermark.

    ``lookback`` moves a time watermark back, to pick up rows that arrived late with an equal or
    older value; the caller then removes the rows read twice with ``dedup.latest``.
    """
    if not column or value in (None, ""):
        return df
    bound = watermark_literal(value, kind, df.schema[column].dataType)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    return df.where(F.col(column) > bound)


def filter_with_clause(
    df: DataFrame,
    clause: str | None,
    column: str | None = None,
    value: str | None = None,
    kind: str = "datetime",
) -> DataFrame:
    """Source filter and watermark together, either alone, or neither."""
    filtered = df.where(F.expr(checked_clause(clause))) if clause else df
    return filter_above(filtered, column, value, kind)


def max_watermark(df: DataFrame, column: str | None, previous: str | None = None) -> DataFrame:
    """One row with the next watermark; the previous one when there is no column or no value."""
    newest = F.max(F.lit(None).cast("string"))
    if column and column in df.columns:
        newest = watermark_text(F.max(column), df.schema[column].dataType)
    return df.agg(F.coalesce(newest, F.lit(previous)).alias("watermark"))


def last_watermark(entity_runs: DataFrame) -> DataFrame:
    """Watermark of the latest successful run of every entity."""
    return (
        entity_runs.where(F.upper("Status") == "SUCCEEDED")
        .groupBy("EntityId")
        .agg(F.max_by("WatermarkAfter", F.struct("EndTime", "EntityRunId")).alias("WatermarkAfter"))
    )
