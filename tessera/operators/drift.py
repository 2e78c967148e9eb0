"""Schema drift: comparing, classifying and reconciling columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import as_time

# Conversions that lose nothing, narrow to wide.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


class SchemaDrift(ValueError):
    """Raised by the strict strategy and for type changes that cannot be reconciled."""


@dataclass(frozen=True)
class Drift:
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    retyped: tuple[tuple[str, str, str], ...] = ()
    new_table: bool = False

    @property
    def kind(self) -> str | None:
        if self.new_table:
            return "NEW_TABLE"
        found = [
            name
            for name, part in (
                ("ADDED_COLUMNS", self.added),
                ("REMOVED_COLUMNS", self.removed),
                ("TYPE_CHANGES", self.retyped),
            )
            if part
        ]
        return found[0] if len(found) == 1 else "MIXED" if found else None

    def __str__(self) -> str:
        return f"{self.kind}: added={self.added} removed={self.removed} retyped={self.retyped}"


def compare(source: T.StructType, target: T.StructType | None) -> Drift:
    """Differences of two schemas, by name and type, top level."""
    here = {f.name: f.dataType.simpleString() for f in source.fields}
    if target is None:
        return Drift(added=tuple(here), new_table=True)
    there = {f.name: f.dataType.simpleString() for f in target.fields}
    return Drift(
        tuple(c for c in here if c not in there),
        tuple(c for c in there if c not in here),
        tuple((c, t, there[c]) for c, t in here.items() if c in there and there[c] != t),
    )


def column_frame(spark: SparkSession, schemas: dict[int, T.StructType]) -> DataFrame:
    """The columns of known tables as rows (EntityId, column, type); metadata, so small."""
    rows = [
        (entity, f.name, f.dataType.simpleString())
        for entity, schema in schemas.items()
        for f in schema.fields
    ]
    return spark.createDataFrame(rows, "EntityId int, column string, type string")


_JSON_TYPES = {"BOOLEAN": "boolean", "BIGINT": "bigint", "STRING": "string", "DOUBLE": "double"}


def landed_columns(df: DataFrame, entity: str, json: str) -> DataFrame:
    """Columns found in landed JSON rows, with their types: (EntityId, column, type).

    Reduced with partial sums inside every task, so the shuffle carries one row per entity, column and
    type and task, however many rows an entity landed. Decimals count as double; a column that is
    null throughout has no type of its own and takes none.
    """
    kind = F.col("kind")
    name = F.when(kind.startswith("DECIMAL"), F.lit("double"))
    for variant, simple in _JSON_TYPES.items():
        name = name.when(kind == variant, F.lit(simple))
    name = name.when(kind.startswith("OBJECT"), "struct").when(kind.startswith("ARRAY"), "array")
    rank = {"boolean": 1, "bigint": 2, "double": 3}
    weight = F.coalesce(*[F.when(F.col("type") == t, F.lit(w)) for t, w in rank.items()], F.lit(4))
    return (
        df.select(F.col(entity).alias("EntityId"), F.explode(F.from_json(json, "map<string,variant>")))
        .select("EntityId", F.col("key").alias("column"), F.schema_of_variant("value").alias("kind"))
        .groupBy("EntityId", "column", "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("EntityId", "column", name.alias("type"))
        .groupBy("EntityId", "column")
        .agg(F.max_by("type", F.when(F.col("type").isNotNull(), weight)).alias("type"))
    )


def detect(source_columns: DataFrame, target_columns: DataFrame) -> DataFrame:
    """One row per changed column: (EntityId, column, change, source_type, target_type).

    Both inputs are column frames; an entity without any target column is a new table.
    """
    known = target_columns.select("EntityId").distinct().withColumn("__has_target", F.lit(True))
    source = source_columns.select("EntityId", "column", F.col("type").alias("source_type"))
    target = target_columns.select("EntityId", "column", F.col("type").alias("target_type"))
    source = source.withColumn("__in_source", F.lit(True))
    target = target.withColumn("__in_target", F.lit(True))
    change = (
        F.when(F.col("__in_target").isNull(), "ADDED")
        .when(F.col("__in_source").isNull(), "REMOVED")
        .when(F.col("source_type") != F.col("target_type"), "RETYPED")
    )
    return (
        source.join(target, ["EntityId", "column"], "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .join(known, "EntityId", "left")
        .select(
            "EntityId",
            "column",
            "change",
            "source_type",
            "target_type",
            F.col("__has_target").isNull().alias("new_table"),
        )
    )


def _kind(new_table: Column, added: Column, removed: Column, retyped: Column) -> Column:
    """Drift kind from the numbers of changed columns."""
    kinds = sum((n > 0).cast("int") for n in (added, removed, retyped))
    return (
        F.when(new_table, "NEW_TABLE")
        .when(kinds > 1, "MIXED")
        .when(added > 0, "ADDED_COLUMNS")
        .when(removed > 0, "REMOVED_COLUMNS")
        .otherwise("TYPE_CHANGES")
    )


def classify(changes: DataFrame) -> DataFrame:
    """One row per entity with drift: kind and counts of changed columns."""
    names = {"Added": "ADDED", "Removed": "REMOVED", "Retyped": "RETYPED"}
    counts = [F.count_if(F.col("change") == change).alias(name) for name, change in names.items()]
    found = changes.groupBy("EntityId").agg(F.bool_or("new_table").alias("__new"), *counts)
    kind = _kind(*[F.col(c) for c in ("__new", *names)])
    return found.select("EntityId", kind.alias("DriftType"), *names)


def scan_entities(source_columns: DataFrame, target_columns: DataFrame, as_of) -> DataFrame:
    """Drift log entries of all entities in one job; the lists are as long as a table is wide."""
    changes = detect(source_columns, target_columns)

    def listed(change: str, value: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("change") == change, value)))

    types = F.struct("column", "source_type", "target_type")
    lists = changes.groupBy("EntityId").agg(
        F.bool_or("new_table").alias("__new"),
        listed("ADDED", F.col("column")).alias("AddedColumns"),
        listed("REMOVED", F.col("column")).alias("RemovedColumns"),
        listed("RETYPED", types).alias("TypeChanges"),
    )
    sizes = [F.size(c) for c in ("AddedColumns", "RemovedColumns", "TypeChanges")]
    return lists.select(
        "EntityId",
        _kind(F.col("__new"), *sizes).alias("DriftType"),
        "AddedColumns",
        "RemovedColumns",
        "TypeChanges",
        as_time(as_of).alias("DetectedTime"),
    )


def log_entry(spark: SparkSession, entity_id: int, drift: Drift, as_of: str) -> DataFrame:
    """One drift log row for a single table."""
    return spark.createDataFrame(
        [(entity_id, drift.kind, list(drift.added), list(drift.removed), list(drift.retyped))],
        "EntityId int, DriftType string, AddedColumns array<string>, RemovedColumns array<string>, "
        "TypeChanges array<struct<column:string,source_type:string,target_type:string>>",
    ).withColumn("DetectedTime", as_time(as_of))


def strict(df: DataFrame, target: DataFrame) -> DataFrame:
    """The batch unchanged, or an error when its schema differs from the target's."""
    drift = compare(df.schema, target.schema)
    if drift.kind:
        raise SchemaDrift(str(drift))
    return df


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the schema's missing columns as typed nulls, in one projection."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def merge(df: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch and target with one common schema: added columns on both sides, safe widening by cast."""
    schema = merged_schema(df.schema, target.schema)
    return conform(df, schema), conform(target, schema)


def ignore(df: DataFrame, target: DataFrame) -> DataFrame:
    """Only the columns the target has."""
    return df.select(*[c for c in df.columns if c in target.columns])


def merged_schema(source: T.StructType, target: T.StructType) -> T.StructType:
    """Target columns first, then the batch's own; the wider of two types."""
    here = {f.name: f.dataType for f in source.fields}
    fields = []
    for f in target.fields:
        new, old = here.get(f.name, f.dataType), f.dataType
        a, b = new.simpleString(), old.simpleString()
        if a == b or b in WIDER.get(a, ()):
            fields.append(T.StructField(f.name, old))
        elif a in WIDER.get(b, ()):
            fields.append(T.StructField(f.name, new))
        else:
            raise SchemaDrift(f"column {f.name}: {a} in the batch, {b} in the table")
    known = {f.name for f in target.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in source.fields if f.name not in known])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the given schema; missing columns are typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def handle(df: DataFrame, target: DataFrame | None, strategy: str) -> tuple[DataFrame, Drift]:
    """The batch as the strategy lets it through, and the drift found.

    ``merge`` and ``alert`` pass the batch on; the append then adds the new columns to the table's
    schema without rewriting its files.
    """
    drift = compare(df.schema, target.schema if target is not None else None)
    if target is None or drift.kind is None:
        return df, drift
    if strategy == "strict":
        raise SchemaDrift(str(drift))
    if strategy == "ignore":
        return ignore(df, target), drift
    if strategy == "merge":
        return conform(df, merged_schema(df.schema, target.schema)), drift
    return df, drift
