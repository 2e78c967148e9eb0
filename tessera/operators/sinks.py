"""Batch sinks. Each write is one Spark job; row counts come from an observation on that write."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera import layout as lake
from tessera.layout import LOAD, ROWS, WHOLE, Layout, load_name, read_table, table_exists
from tessera.operators import drift


def overwrite(df: DataFrame, layout: Layout, metrics: dict[str, Column] | None = None, load: str = WHOLE, keep_if_empty: bool = False) -> dict:
    """Replace rows and columns; returns the observed metrics. ``df`` may be read from the table itself.

    The new rows are one load, the partitions of all others are dropped after the write. With
    ``keep_if_empty`` a frame without rows changes nothing.
    """
    spark = df.sparkSession
    if not table_exists(spark, layout):
        lake.create(spark, layout, df.schema)
    elif not _same_columns(df.schema, lake.fields(spark, layout)) or lake.partition_columns(spark, layout) != [LOAD]:
        rows = df.select("*", F.lit(load).alias(LOAD))
        if keep_if_empty and rows.isEmpty():
            return {ROWS: 0, **dict.fromkeys(metrics or {})}
        observed = df.agg(*[e.alias(n) for n, e in (metrics or {}).items()]).first().asDict() if metrics else {}
        return {ROWS: lake.replace_table(spark, layout, rows), **observed}
    observed = lake.insert(df.select("*", F.lit(load).alias(LOAD)), layout, metrics)
    if observed[ROWS] or not keep_if_empty:
        gone = [p for p in lake.partitions(spark, layout) if p[LOAD] != load or not observed[ROWS]]
        lake.drop_partitions(spark, layout, gone)
    return observed


def _same_columns(a: StructType, b: StructType) -> bool:
    return {f.name: f.dataType.simpleString() for f in a.fields} == {f.name: f.dataType.simpleString() for f in b.fields}


def append(
    df: DataFrame,
    layout: Layout,
    metrics: dict[str, Column] | None = None,
    load: str | None = None,
    batch: tuple[str, int] | None = None,
    partitioned: tuple[str, ...] = (),
) -> dict:
    """Add a load; new columns join the table, narrower types are widened. Returns the observed metrics.

    A load that the table already has is replaced, so repeated runs and repeated batches of a stream add
    nothing twice. ``batch`` is a (writer, number) pair that names the load; without a name the load is new.
    """
    spark = df.sparkSession
    name = load_name(*batch) if batch else load_name(load) if load else uuid.uuid4().hex
    if table_exists(spark, layout):
        lake.evolve(spark, layout, StructType([f for f in df.schema.fields if f.name not in partitioned]))
    else:
        lake.create(spark, layout, df.schema, partitioned)
    wanted = StructType([*lake.fields(spark, layout).fields, *[f for f in df.schema.fields if f.name in partitioned]])
    before = [p for p in lake.partitions(spark, layout) if p[LOAD] == name]
    if before and partitioned:  # one entry per partition
        metrics = {**(metrics or {}), "__brought": F.collect_set(F.struct(*[F.col(c).cast("string") for c in partitioned]))}
    observed = lake.insert(drift.conform(df, wanted).withColumn(LOAD, F.lit(name)), layout, metrics)
    # Partitions that the load had before and has no longer.
    now = {tuple(r) for r in observed.pop("__brought", [()] if observed[ROWS] else [])}
    lake.drop_partitions(spark, layout, [p for p in before if tuple(p[c] for c in partitioned) not in now])
    return observed


def rewrite(
    spark: SparkSession,
    layout: Layout,
    transform: Callable[[DataFrame], DataFrame],
    only: list[dict[str, str]] | None = None,
) -> int:
    """Rewrite partitions through ``transform``, by default all; returns the rows written.

    ``transform`` gets and returns rows with their partition columns. Partitions of which it leaves nothing
    are dropped. All others stay as they are, those added meanwhile included.
    """
    chosen = lake.partitions(spark, layout) if only is None else only
    if not chosen:
        return 0
    columns = lake.partition_columns(spark, layout)
    rows = transform(lake.read_whole(spark, layout).where(lake.matching(chosen)))
    key = F.struct(*[F.col(c).cast("string") for c in columns])
    observed = lake.insert(rows, layout, {"left": F.collect_set(key)})  # one entry per partition
    left = {tuple(k) for k in observed["left"]}
    lake.drop_partitions(spark, layout, [p for p in chosen if tuple(p[c] for c in columns) not in left])
    return observed[ROWS]


def merge_loads(spark: SparkSession, layout: Layout, names: list[str], into: str) -> int:
    """Put loads together into one new load, for tables of many small ones; returns its rows.

    The merged loads are over: running them again would add their rows a second time.
    """
    if into in lake.loads(spark, layout):
        raise ValueError(f"{layout.path}: there is a load {into}")
    gone = [p for p in lake.partitions(spark, layout) if p[LOAD] in names]
    if not gone:
        return 0
    merged = lake.read_whole(spark, layout).where(lake.matching(gone)).withColumn(LOAD, F.lit(load_name(into)))
    rows = lake.insert(merged.coalesce(max(1, merged.rdd.getNumPartitions() // len(names))), layout)[ROWS]
    lake.drop_partitions(spark, layout, gone)
    return rows


def register(spark: SparkSession, layout: Layout, name: str) -> None:
    """A view of the table's rows under a name of the catalog's current database; made anew where it exists."""
    lake.require(spark, layout)
    columns = ", ".join(f"`{f.name}`" for f in lake.fields(spark, layout).fields)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {layout.name}")


def fingerprint(df: DataFrame, table: str, side: str) -> DataFrame:
    """One row: table, side, row count and an order-free checksum of all rows."""
    checksum = F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), checksum.alias("checksum")).select(
        F.lit(table).alias("table_name"), F.lit(side).alias("side"), "rows", "checksum"
    )


def backup(spark: SparkSession, tables: list[Layout], backup_base: str) -> DataFrame:
    """Copy tables to a backup base where not there yet, and compare each copy with its source."""
    sides = []
    for source in tables:
        copy = source.sibling(base=backup_base)
        if not table_exists(spark, copy):
            overwrite(read_table(spark, source), copy)
        sides.append(fingerprint(read_table(spark, source), source.table, "source"))
        sides.append(fingerprint(read_table(spark, copy), source.table, "copy"))
    state = F.struct("rows", "checksum")

    def of(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, state))

    compared = reduce(DataFrame.unionByName, sides).groupBy("table_name").agg(
        of("source").alias("source"), of("copy").alias("copy")
    )
    same = F.col("source").eqNullSafe(F.col("copy"))
    return compared.select("table_name", F.col("copy.rows").alias("rows"), same.alias("matches"))
