"""Tables kept by key, in buckets that are partitions: a delivery reads and rewrites only the buckets of its keys.

Three of them: the latest row per key, the type-2 history of a change log, and aggregates that follow a table of
latest rows. Each equals what a computation over everything delivered would give, however it was cut into
deliveries, and a repeated delivery changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera import layout as lake
from tessera.layout import LOAD, OWN, ROWS, WHOLE, Layout
from tessera.operators import dedup, drift, scd, sinks
from tessera.session import scratch

#: Partition column: the bucket of a row's key.
BUCKET = f"{OWN}bucket"
#: Rows of the first delivery per bucket; the number of buckets, a power of two, stays as it is then.
ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 4096


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, as it is read several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(keys: list[str], number: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(number).cast("long")).cast("int")


def _buckets(spark: SparkSession, layout: Layout, rows: DataFrame, partitioned: tuple[str, ...] = (BUCKET,)) -> int:
    """The number of buckets of a table, which is made for ``rows`` where it does not exist."""
    known = lake.marked(spark, layout, "buckets")
    if known is not None:
        lake.evolve(spark, layout, rows.schema)
        return int(known)
    number, n = 1, rows.count()
    while number * ROWS_PER_BUCKET < n and number < MOST_BUCKETS:
        number *= 2
    lake.create(spark, layout, StructType([*rows.schema.fields, StructField(BUCKET, IntegerType())]), partitioned)
    lake.mark(spark, layout, "buckets", number)
    return number


def _hit(rows: DataFrame, bucket: Column) -> list[int]:
    return sorted(r[0] for r in rows.select(bucket).distinct().collect())  # one row per bucket


def _held(spark: SparkSession, layout: Layout, hit: list[int]) -> DataFrame:
    return lake.read_whole(spark, layout).where(F.col(BUCKET).isin(hit))


def _replace(rows: DataFrame, layout: Layout, keys: list[str], number: int, hit: list[int]) -> int:
    """Overwrite the buckets ``hit`` with ``rows``; returns the rows written."""
    spark = rows.sparkSession
    shaped = drift.conform(rows, lake.fields(spark, layout)).withColumn(BUCKET, _bucket(keys, number))
    seen = lake.insert(shaped.repartition(F.col(BUCKET)).withColumn(LOAD, F.lit(WHOLE)), layout, {"left": F.collect_set(BUCKET)})
    gone = set(hit) - set(seen["left"])
    lake.drop_partitions(spark, layout, [p for p in lake.partitions(spark, layout) if int(p[BUCKET]) in gone])
    return seen[ROWS]


# --- latest rows -----------------------------------------------------------------------------------


def merge_latest(
    batch: DataFrame,
    layout: Layout,
    keys: list[str],
    order: list[Column],
    tie_break: list[str] | None = None,
    on_change: Callable[[DataFrame, DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge a delivery into a table of the latest row per key, by ``order`` and ``tie_break`` as in ``dedup.latest``.

    Returns the rows that are new in the table and those that they replace. ``on_change`` is given both before the
    table changes: a run that ends there gives it the same rows when it is repeated.
    """
    spark = batch.sparkSession
    new = _stored(dedup.latest(batch, keys, order, tie_break), "keyed")
    number = _buckets(spark, layout, new)
    hit = _hit(new, _bucket(keys, number))
    shape = lake.fields(spark, layout)
    new = drift.conform(new, shape)
    held = _held(spark, layout, hit).select(*new.columns)
    side = held.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)))
    # Of equal rows the held one stays, so that a repeated delivery changes nothing.
    ties = tie_break if tie_break is not None else [c for c in new.columns if c not in keys]
    chosen = dedup.latest(side, keys, order, [*ties, "__new"])
    chosen = _stored(chosen, "keyed-chosen")
    came = chosen.where("__new").drop("__new")
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    told = came.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)])
    left = _stored(held.join(told, _all(same), "left_semi"), "keyed-replaced")
    if not came.isEmpty():
        if on_change is not None:
            on_change(came, left)
        _replace(chosen.drop("__new"), layout, keys, number, hit)
    return came, left


def _all(tests: list[Column]) -> Column:
    found = F.lit(True)
    for t in tests:
        found = found & t
    return found


# --- histories of change logs ----------------------------------------------------------------------


def merge_changes(
    batch: DataFrame,
    log: Layout,
    history: Layout,
    load: str,
    keys: list[str],
    tracked: list[str],
    time: str,
    position: list[Column] | None = None,
    deleted: Column | None = None,
    names: scd.Names = scd.DEFAULT,
) -> int:
    """Add changes to their log and bring the type-2 history of their keys up to date; returns the keys touched.

    The log is partitioned by bucket of the key and load. Only the buckets of the batch's keys are read, from both
    tables, and only their keys' changes are ordered again; the others' versions are taken over as they are.
    """
    spark = batch.sparkSession
    batch = _stored(batch, "changes")
    number = _buckets(spark, log, batch)
    placed = batch.withColumn(BUCKET, _bucket(keys, number))
    sinks.append(placed, log, load=load, partitioned=(BUCKET,))
    touched = batch.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)]).dropna().distinct()
    hit = _hit(placed, F.col(BUCKET))
    if not hit:
        return 0
    same = _all([F.col(f"`{k}`") == F.col(f"__{i}") for i, k in enumerate(keys)])
    changes = _held(spark, log, hit).drop(BUCKET, LOAD).join(touched, same, "left_semi")
    versions = scd.from_changes(changes, keys, tracked, time, position, deleted, names)
    if not lake.table_exists(spark, history):
        lake.create(spark, history, StructType([*versions.schema.fields, StructField(BUCKET, IntegerType())]), (BUCKET,))
    else:
        lake.evolve(spark, history, versions.schema)
    others = _held(spark, history, hit).drop(BUCKET, LOAD).join(touched, same, "left_anti")
    wanted = lake.fields(spark, history)
    _replace(drift.conform(others, wanted).unionByName(drift.conform(versions, wanted)), history, keys, number, hit)
    return touched.count()


# --- aggregates ------------------------------------------------------------------------------------

_MEASURE = re.compile(r"\s*(SUM|COUNT|AVG|MIN|MAX)\s*\(\s*(DISTINCT\s+)?(\w+)\s*\)\s*", re.IGNORECASE)


def _parsed(measures: dict[str, str]) -> dict[str, tuple[str, str]]:
    found = {}
    for name, text in measures.items():
        m = _MEASURE.fullmatch(text)
        if m is None or (m[2] and m[1].upper() != "COUNT"):
            raise ValueError(f"not an aggregate: {text}")
        found[name] = ("DISTINCT" if m[2] else m[1].upper(), m[3])
    return found


def _signed(came: DataFrame, left: DataFrame) -> DataFrame:
    return came.withColumn("__sign", F.lit(1)).unionByName(left.withColumn("__sign", F.lit(-1)))


def follow(
    came: DataFrame, left: DataFrame, sums: Layout, values: Layout, load: str, grain: list[str], measures: dict[str, str]
) -> None:
    """Add what a delivery changed to kept partial aggregates: rows that came count, rows that left count back.

    ``sums`` gets per group the change of row counts, sums and counts of values; ``values`` the change of how often
    a group holds each value, for distinct counts, smallest and largest values. Both are only added to; a repeated
    load replaces itself.
    """
    parsed = _parsed(measures)
    rows = _signed(came, left)
    added = sorted({c for kind, c in parsed.values() if kind in ("SUM", "AVG", "COUNT")})
    parts = [F.sum("__sign").cast("long").alias("__rows")]
    for c in added:
        parts.append(F.sum(F.when(F.col(c).isNotNull(), F.col("__sign")).otherwise(0)).cast("long").alias(f"__n_{c}"))
        if any(kind in ("SUM", "AVG") and column == c for kind, column in parsed.values()):
            parts.append(F.sum(F.col(c) * F.col("__sign")).alias(f"__sum_{c}"))
    sinks.append(rows.groupBy(*grain).agg(*parts), sums, load=load)
    for c in sorted({c for kind, c in parsed.values() if kind in ("DISTINCT", "MIN", "MAX")}):
        held = rows.where(F.col(c).isNotNull()).groupBy(*grain, F.col(c).alias("value")).agg(F.sum("__sign").cast("long").alias("n"))
        sinks.append(held.where("n <> 0"), values.sibling(table=f"{values.table}_{c}"), load=load)


def followed(spark: SparkSession, sums: Layout, values: Layout, grain: list[str], measures: dict[str, str]) -> DataFrame:
    """The aggregate as it stands, from the kept parts."""
    parsed = _parsed(measures)
    parts = lake.read_table(spark, sums)
    kept = [c for c in parts.columns if c not in grain]
    found = parts.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in kept]).where("__rows > 0")
    columns: dict[str, Column] = {}
    for name, (kind, c) in parsed.items():
        if kind == "COUNT":
            columns[name] = F.col(f"__n_{c}")
        elif kind == "SUM":
            columns[name] = F.when(F.col(f"__n_{c}") > 0, F.col(f"__sum_{c}"))
        elif kind == "AVG":
            columns[name] = F.try_divide(F.when(F.col(f"__n_{c}") > 0, F.col(f"__sum_{c}")), F.col(f"__n_{c}"))
    for c in sorted({c for kind, c in parsed.values() if kind in ("DISTINCT", "MIN", "MAX")}):
        held = lake.read_table(spark, values.sibling(table=f"{values.table}_{c}"))
        live = held.groupBy(*grain, "value").agg(F.sum("n").alias("n")).where("n > 0")
        ends = live.groupBy(*grain).agg(F.count(F.lit(1)).alias("DISTINCT"), F.min("value").alias("MIN"), F.max("value").alias("MAX"))
        ends = ends.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(grain)], *[F.col(k).alias(f"__{k}_{c}") for k in ("DISTINCT", "MIN", "MAX")])
        same = _all([F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(grain)])
        found = found.join(ends, same, "left").drop(*[f"__g{i}" for i in range(len(grain))])
        for name, (kind, column) in parsed.items():
            if column == c and kind in ("DISTINCT", "MIN", "MAX"):
                columns[name] = F.coalesce(f"__{kind}_{c}", F.lit(0)) if kind == "DISTINCT" else F.col(f"__{kind}_{c}")
    return found.select(*grain, *[columns[name].alias(name) for name in measures])
