"""Lake tables: Spark's own managed Parquet tables, partitioned by load.

A lake is a database of the session's catalog whose location is the lake's base folder; a table in it is named by
layer, schema and table. Every row belongs to a load - a run, or a batch of a stream - which is a partition, and
inserts overwrite just the partitions that they bring. So a load that is repeated replaces itself, loads of
several writers do not touch each other, and a query may read a table while it rewrites some of its
partitions. Spark commits an insert's files when its job is done and drops the files of dropped partitions.

Lakes that outlive a session need a catalog that does, such as a Hive metastore.
"""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.operators import drift

#: Partition column of every table: the load that brought a row. Further ones begin with ``OWN``.
LOAD = "_load"
OWN = "_lake_"
#: Name of the observed row count of a write.
ROWS = "__rows"
#: Load of tables that are replaced as a whole.
WHOLE = "whole"

_creation = threading.Lock()


@dataclass(frozen=True)
class Layout:
    """Address of a lake table: base folder, layer, schema, table."""

    base: str
    layer: str
    schema: str
    table: str

    @property
    def database(self) -> str:
        return database(self.base)

    @property
    def short_name(self) -> str:
        return "__".join(re.sub(r"\W", "_", part).lower() for part in (self.layer, self.schema, self.table))

    @property
    def name(self) -> str:
        """The table's name in the catalog."""
        return f"{self.database}.{self.short_name}"

    @property
    def path(self) -> str:
        """Where Spark keeps the table's files."""
        return f"{self.base}/{self.short_name}"

    def sibling(self, **parts: str) -> "Layout":
        return Layout(**{**self.__dict__, **parts})


def database(base: str) -> str:
    return "lake_" + hashlib.md5(base.encode()).hexdigest()[:16]


def bronze(base: str, table: str, schema: str = "raw") -> Layout:
    return Layout(base, "bronze", schema, table)


def silver(base: str, table: str, schema: str = "cleaned") -> Layout:
    return Layout(base, "silver", schema, table)


def gold(base: str, table: str, schema: str = "curated") -> Layout:
    return Layout(base, "gold", schema, table)


def quarantine(base: str, table: str) -> Layout:
    return Layout(base, "bronze", "quarantine", f"{table}_quarantine")


def is_directory(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def load_name(*parts: object) -> str:
    """A load's name from a run, a table, a batch number: letters, digits, dots and dashes."""
    return re.sub(r"[^A-Za-z0-9.-]+", "-", "-".join(f"{p:012d}" if isinstance(p, int) else str(p) for p in parts))


# --- reading ---------------------------------------------------------------------------------------


def table_exists(spark: SparkSession, layout: Layout) -> bool:
    return spark.catalog.tableExists(layout.name)


def require(spark: SparkSession, layout: Layout) -> None:
    if not table_exists(spark, layout):
        raise FileNotFoundError(f"no table {layout.layer}.{layout.schema}.{layout.table} in {layout.base}")


def partition_columns(spark: SparkSession, layout: Layout) -> list[str]:
    return [c for c in spark.table(layout.name).columns if c == LOAD or c.startswith(OWN)]


def read_whole(spark: SparkSession, layout: Layout) -> DataFrame:
    """The table with its partition columns."""
    require(spark, layout)
    return spark.table(layout.name)


def read_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """The rows of a table; a column that came later is null in earlier rows."""
    rows = read_whole(spark, layout)
    return rows.drop(*[c for c in rows.columns if c == LOAD or c.startswith(OWN)])


def partitions(spark: SparkSession, layout: Layout) -> list[dict[str, str]]:
    """The values of the partition columns of every partition."""
    require(spark, layout)
    found = spark.sql(f"SHOW PARTITIONS {layout.name}").collect()  # one row per partition
    return [dict(part.split("=", 1) for part in r["partition"].split("/")) for r in found]


def loads(spark: SparkSession, layout: Layout) -> list[str]:
    """The loads that a table holds rows of, by name; none where there is no table."""
    if not table_exists(spark, layout):
        return []
    return sorted({p[LOAD] for p in partitions(spark, layout)})


def matching(wanted: Iterable[dict[str, str]]) -> Column:
    """Test for rows of some partitions, which Spark prunes by."""
    test = F.lit(False)
    for partition in wanted:
        same = F.lit(True)
        for column, value in partition.items():
            same = same & (F.col(column) == value)
        test = test | same
    return test


# --- writing ---------------------------------------------------------------------------------------


def create(
    spark: SparkSession, layout: Layout, schema: StructType, partitioned: Iterable[str] = (), buckets: tuple[list[str], int] | None = None
) -> None:
    """An empty table; ``partitioned`` names columns of the schema to partition by before the load.

    ``buckets`` are columns and a number: files are bucketed and sorted by these, so joins and aggregates by
    the columns read the table without a shuffle.
    """
    partitioned = [*partitioned, LOAD]
    plain = StructType([StructField(f.name, f.dataType) for f in schema.fields if f.name not in partitioned])
    split = StructType([StructField(f.name, f.dataType) for f in schema.fields if f.name in partitioned and f.name != LOAD])
    columns = ", ".join(x for x in (plain.toDDL(), split.toDDL(), f"{LOAD} STRING") if x)
    names = ", ".join(f"`{c}`" for c in partitioned)
    by = ", ".join(f"`{c}`" for c in buckets[0]) if buckets else ""
    bucketed = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets[1]} BUCKETS" if buckets else ""
    with _creation:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.database} LOCATION '{layout.base}'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layout.name} ({columns}) USING parquet "
            f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({names}){bucketed}"
        )


def fields(spark: SparkSession, layout: Layout) -> StructType:
    """The schema without partition columns."""
    found = spark.table(layout.name).schema.fields
    return StructType([f for f in found if f.name != LOAD and not f.name.startswith(OWN)])


def evolve(spark: SparkSession, layout: Layout, schema: StructType) -> None:
    """Make room for rows of ``schema``: new columns are added; wider types rewrite the table once, as a
    Parquet table of the catalog keeps the types it was created with."""
    with _creation:
        present = fields(spark, layout)
        merged = drift.merged_schema(schema, present)
        types = {f.name: f.dataType for f in merged.fields}
        wider = [f.name for f in present.fields if types[f.name] != f.dataType]
        known = {f.name for f in present.fields}
        new = StructType([StructField(f.name, f.dataType) for f in merged.fields if f.name not in known])
        if new.fields and not wider:
            spark.sql(f"ALTER TABLE {layout.name} ADD COLUMNS ({new.toDDL()})")
    if wider:
        rows = drift.conform(read_whole(spark, layout), StructType([*merged.fields, *_split_fields(spark, layout)]))
        replace_table(spark, layout, rows, partition_columns(spark, layout)[:-1])


def _split_fields(spark: SparkSession, layout: Layout) -> list[StructField]:
    found = spark.table(layout.name).schema.fields
    return [f for f in found if f.name == LOAD or f.name.startswith(OWN)]


def replace_table(spark: SparkSession, layout: Layout, rows: DataFrame, partitioned: Iterable[str] = ()) -> int:
    """Make the table anew from rows that may be read from it, with their loads; used where its columns change.

    The rows go through a scratch folder, which keeps them until the new table is written.
    """
    from tessera.session import scratch

    path = scratch(spark, "replaced")
    rows.write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    spark.sql(f"DROP TABLE {layout.name}")
    create(spark, layout, kept.schema, partitioned)
    return insert(kept, layout)[ROWS]


def insert(df: DataFrame, layout: Layout, metrics: dict[str, Column] | None = None) -> dict:
    """Overwrite the partitions that ``df`` brings; it has the table's columns and its partition columns.

    Returns the observed metrics of the write, the row count among them.
    """
    seen = Observation()
    columns = {ROWS: F.count(F.lit(1)), **(metrics or {})}
    observed = df.observe(seen, *[e.alias(n) for n, e in columns.items()])
    names = df.sparkSession.table(layout.name).columns
    observed.select(*[f"`{c}`" for c in names]).write.mode("overwrite").insertInto(layout.name)
    return seen.get


def drop_partitions(spark: SparkSession, layout: Layout, gone: Iterable[dict[str, str]]) -> None:
    specs = []
    for partition in gone:
        specs.append("PARTITION (" + ", ".join(f"`{c}` = '{v}'" for c, v in partition.items()) + ")")
    if specs:
        spark.sql(f"ALTER TABLE {layout.name} DROP IF EXISTS {', '.join(specs)}")


def mark(spark: SparkSession, layout: Layout, key: str, value: object) -> None:
    """A note kept with the table in the catalog."""
    spark.sql(f"ALTER TABLE {layout.name} SET TBLPROPERTIES ('tessera.{load_name(key)}' = '{value}')")


def marked(spark: SparkSession, layout: Layout, key: str) -> str | None:
    if not table_exists(spark, layout):
        return None
    wanted = f"tessera.{load_name(key)}"
    found = spark.sql(f"SHOW TBLPROPERTIES {layout.name}").where(F.col("key") == wanted).first()
    return found["value"] if found else None
