"""Type-2 history as a stored table: closed rows are only ever added, current rows are rewritten."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera import layout as lake
from tessera.layout import LOAD, WHOLE, Layout, table_exists
from tessera.operators import drift, scd

#: Partition column: ``current`` or ``closed``.
PART = f"{lake.OWN}part"


def is_history(spark: SparkSession, layout: Layout) -> bool:
    return table_exists(spark, layout) and PART in lake.partition_columns(spark, layout)


def read_current(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Current rows of the stored history, without opening the closed ones."""
    if not table_exists(spark, layout):
        return None
    return lake.read_whole(spark, layout).where(F.col(PART) == "current").drop(PART, LOAD)


def merge_into(
    batch: DataFrame,
    layout: Layout,
    keys: list[str],
    tracked: list[str],
    as_of,
    order: list[Column] | None = None,
    names: scd.Names = scd.DEFAULT,
    writer: tuple[str, int] | None = None,
) -> dict[str, int]:
    """Merge a batch into the stored history in one insert.

    It overwrites the partition of current rows and adds the closed ones as a load of their own.
    Returns the numbers of current and newly closed rows. ``writer`` is a (name, batch
    number) pair; a number already applied is skipped. Merging a batch again changes nothing.
    """
    spark = batch.sparkSession
    if writer:
        applied = lake.marked(spark, layout, f"batch.{writer[0]}")
        if applied is not None and int(applied) >= writer[1]:
            return {"current": 0, "closed": 0}
    current = read_current(spark, layout)
    rows = scd.prepare(batch, keys, order, names)
    if current is None:
        merged = scd.initial(rows, as_of, names)
    else:
        merged = scd.merge_current(current, rows, keys, tracked, as_of, names)
    is_current = F.col(names.is_current)
    placed = merged.withColumn(PART, F.when(is_current, "current").otherwise("closed"))
    placed = placed.withColumn(LOAD, F.when(is_current, WHOLE).otherwise(f"closed-{uuid.uuid4().hex}"))
    if current is None:
        lake.create(spark, layout, placed.schema, (PART,))
    else:
        lake.evolve(spark, layout, merged.schema)
    shaped = drift.conform(placed, StructType([*lake.fields(spark, layout).fields, *placed.schema[-2:].fields]))
    counts = {"current": F.count_if(is_current), "closed": F.count_if(~is_current)}
    found = lake.insert(shaped, layout, counts)
    if writer:
        lake.mark(spark, layout, f"batch.{writer[0]}", writer[1])
    return {name: found[name] for name in counts}
