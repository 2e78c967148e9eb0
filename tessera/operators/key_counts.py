"""Counts of keys kept beside a table, so that repeated keys are found across deliveries without reading old rows.

One row per column under watch, key and load: a digest of the key and how many rows of the load hold it. Rows lie
in buckets by the digest, which are partitions; a delivery reads and rewrites just the buckets that its keys fall
into, and replaces what it had put there before, so it may be repeated. Sums per bucket are kept beside it: rows
and different keys of the whole table are known without opening other buckets.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera import layout as lake
from tessera.layout import LOAD, Layout
from tessera.operators import sinks
from tessera.session import scratch

COLUMN, BUCKET = f"{lake.OWN}column", f"{lake.OWN}bucket"
#: Keys of the first delivery per bucket; the number of buckets is a power of two and stays.
KEYS_PER_BUCKET = 4_000_000
MOST_BUCKETS = 4096
#: Parts that a bucket is written in, side by side: files per bucket, at most.
PARTS = 8


def digest(column: str) -> Column:
    """What a key is told by; null is a key of its own."""
    return F.md5(F.coalesce(F.concat(F.lit("v"), F.col(f"`{column}`").cast("string")), F.lit("n")))


def counts_layout(base: str, table: str) -> Layout:
    return Layout(base, "system", "keys", table)


def totals_layout(base: str, table: str) -> Layout:
    """Rows and keys by bucket, and the loads that are counted, as rows without a bucket; by column."""
    return Layout(base, "system", "key_totals", table)


@dataclass(frozen=True)
class Found:
    """What a delivery did to a column: its ``repeated`` keys (key) or None, loads whose rows became repeated by it,
    and rows and different keys of the whole table."""

    repeated: DataFrame | None
    loads: list[str]
    rows: int
    keys: int


def _buckets(spark: SparkSession, counts: Layout, column: str, keys: int) -> int:
    known = lake.marked(spark, counts, f"buckets.{column}")
    if known is not None:
        return int(known)
    number = 1
    while number * KEYS_PER_BUCKET < keys and number < MOST_BUCKETS:
        number *= 2
    lake.mark(spark, counts, f"buckets.{column}", number)
    return number


def deliver(df: DataFrame, column: str, base: str, table: str, present: Iterable[str]) -> Found:
    """Count the keys of a delivery, ``df`` with its ``LOAD`` column, into the kept counts.

    ``present`` are the loads that the table holds; what others had put into the counts is taken out.
    """
    spark = df.sparkSession
    counts, totals = counts_layout(base, table), totals_layout(base, table)
    path, seen = scratch(spark, "keys"), Observation()
    per_load = df.groupBy(digest(column).alias("key"), F.col(LOAD).alias("load")).agg(F.count(F.lit(1)).alias("n"))
    found = per_load.observe(seen, F.count(F.lit(1)).alias("keys"), F.collect_set("load").alias("loads"))  # one entry per load
    found.write.parquet(path)
    fresh = sorted(seen.get["loads"])
    new = spark.read.schema("key string, load string, n long").parquet(path)
    if not lake.table_exists(spark, counts):
        empty = spark.createDataFrame([], f"key string, load string, n long, {COLUMN} string, {BUCKET} int")
        lake.create(spark, counts, empty.schema, (COLUMN, BUCKET))
    number = _buckets(spark, counts, column, seen.get["keys"])
    bucket = F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.lit(number).cast("long")).cast("int")
    new = new.withColumn(BUCKET, bucket)
    known, earlier = _totals(spark, totals, column)
    gone = sorted(earlier - set(present))
    hit = {0} if number == 1 else {r[BUCKET] for r in new.select(BUCKET).distinct().collect()}  # one row per bucket
    hit |= set(known) if gone else set()
    if not fresh and not gone:
        return Found(None, [], *(sum(s[i] for s in known.values()) for i in (0, 1)))
    held = lake.read_whole(spark, counts).where((F.col(COLUMN) == column) & F.col(BUCKET).isin(sorted(hit)))
    old = held.where(~F.col("load").isin([*gone, *fresh]))
    merged = old.select("key", "load", "n", BUCKET).unionByName(new.select("key", "load", "n", BUCKET))
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS))
    lake.insert(merged.repartition(F.col(BUCKET), part).withColumns({COLUMN: F.lit(column), LOAD: F.lit("counts")}), counts)

    # From here on the counts are read as stored; buckets of gone loads only are dropped below.
    touched = lake.read_whole(spark, counts).where((F.col(COLUMN) == column) & F.col(BUCKET).isin(sorted(hit)))
    touched = touched.where(~F.col("load").isin(gone))
    mine = F.col("load").isin(fresh)
    per_key = touched.groupBy(BUCKET, "key").agg(
        F.sum("n").alias("n"), F.sum(F.when(mine, 0).otherwise(F.col("n"))).alias("before"), F.max(mine).alias("mine")
    )
    again = F.col("mine") & (F.col("n") > 1)
    sums = per_key.groupBy(BUCKET).agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(again).alias("repeated"),
        F.count_if(again & (F.col("before") == 1)).alias("moved"),
    )
    sums = {r[BUCKET]: r for r in sums.collect()}  # one row per bucket
    known = {b: s for b, s in known.items() if b not in hit} | {b: (r["rows"], r["keys"]) for b, r in sums.items()}
    stored = [(b, *s, None) for b, s in sorted(known.items())] + [(None, None, None, x) for x in sorted((earlier - set(gone)) | set(fresh))]
    sinks.append(spark.createDataFrame(stored, "bucket int, rows long, keys long, source_load string").coalesce(1), totals, load=column)
    lake.drop_partitions(spark, counts, [{COLUMN: column, BUCKET: str(b), LOAD: "counts"} for b in hit - set(sums)])

    repeated = None
    if any(r["repeated"] for r in sums.values()):  # written, as every lookup of repeated keys would count all keys again
        path = scratch(spark, "repeated")
        per_key.where(again).select("key", "before").write.parquet(path)
        repeated = spark.read.schema("key string, before long").parquet(path)
    loads = []
    if any(r["moved"] for r in sums.values()):
        before = touched.where(~mine).join(repeated.where("before = 1"), "key", "left_semi").select("load").distinct()
        loads = [r["load"] for r in before.collect()]  # one row per load
    return Found(
        None if repeated is None else repeated.select("key"), loads, sum(s[0] for s in known.values()), sum(s[1] for s in known.values())
    )


def _totals(spark: SparkSession, totals: Layout, column: str) -> tuple[dict[int, tuple[int, int]], set[str]]:
    """Rows and keys by bucket, and the loads counted so far."""
    if not lake.table_exists(spark, totals):
        return {}, set()
    rows = lake.read_whole(spark, totals).where(F.col(LOAD) == lake.load_name(column)).collect()  # one row per bucket and load
    sums = {r["bucket"]: (r["rows"], r["keys"]) for r in rows if r["bucket"] is not None}
    return sums, {r["source_load"] for r in rows if r["bucket"] is None}
