"""Latest row per key, key flags against a reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.lookup import lookup_join, mark_known


def rank_latest(
    df: DataFrame, keys: list[str], order: list[Column], keep: int = 1, output: str = "rn"
) -> DataFrame:
    """The first ``keep`` rows per key in the given order, with their rank.

    The rank filter sits directly on the window, so Spark keeps only ``keep`` rows per key in every
    map task before the shuffle; a key with a third of all rows shrinks to a few rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(output, F.row_number().over(window)).where(F.col(output) <= keep)


def latest(
    df: DataFrame, keys: list[str], order: list[Column], tie_break: list[str] | None = None
) -> DataFrame:
    """One row per key: first in the given order, ties decided by ``tie_break`` columns.

    Without ``tie_break`` all remaining columns decide, so the result does not depend on row order.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    ranked = rank_latest(df, keys, [*order, *[F.col(c).asc() for c in tie_break]], 1, "__rn")
    return ranked.drop("__rn")


def flag_keys(
    df: DataFrame, foreign_keys: list[dict], references: dict[str, DataFrame], always_split: bool = False
) -> DataFrame:
    """``_fk_valid_<column>`` per configured key: not null and present in the reference table.

    A key without a reference table, or whose table is not available, gets the not-null test.
    """
    for key in foreign_keys:
        column, table = key.get("column"), key.get("ref_table")
        if not column or column not in df.columns:
            continue
        flag = f"_fk_valid_{column}"
        reference = references.get(table) if table else None
        if reference is None:
            df = df.withColumn(flag, F.col(column).isNotNull())
        else:
            df = mark_known(df, column, reference, key.get("ref_column", column), flag, always_split)
    return df


def invalid_keys(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct non-null keys that are absent in the reference table.

    Keys are made distinct before the join, so hot keys are gone before any shuffle by key.
    """
    keys = df.select(column).where(F.col(column).isNotNull()).distinct()
    known = reference.select(F.col(reference_column).alias("__known"))
    return keys.join(known, keys[column] == known["__known"], "left_anti")


def valid_keys(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct keys that are present in the reference table."""
    keys = df.select(column).distinct()
    known = reference.select(F.col(reference_column).alias("__known"))
    return keys.join(known, keys[column] == known["__known"], "left_semi")


def attach_latest(
    df: DataFrame, lookup: DataFrame, keys: list[str], order: list[Column], columns: list[str]
) -> DataFrame:
    """Every row with the given columns of its latest lookup row, null where there is none."""
    newest = rank_latest(lookup, keys, order, 1, "__rn").select(*keys, *columns)
    return lookup_join(df, newest, {k: k for k in keys}, columns)
