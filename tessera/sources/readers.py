"""Batch readers. Give a schema in scheduled jobs: inference costs a pass over the files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.config import Entity
from tessera.functions.columns import NUMBER_WATERMARKS, checked_clause, checked_name
from tessera.layout import Layout, read_table
from tessera.operators import incremental

Schema = str | T.StructType | None


def _reader(spark: SparkSession, schema: Schema):
    return spark.read.schema(schema) if schema is not None else spark.read


def csv(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    reader = _reader(spark, schema).option("header", "true").option("mode", "PERMISSIVE")
    return (reader if schema is not None else reader.option("inferSchema", "true")).csv(path)


def json(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    return _reader(spark, schema).option("mode", "PERMISSIVE").json(path)


def parquet(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    return _reader(spark, schema).parquet(path)


def xml(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    return _reader(spark, schema).format("xml").option("rowTag", "row").load(path)


def file(spark: SparkSession, path: str, name: str, schema: Schema = None) -> DataFrame:
    """Reader by the extension of the entity name; unknown extensions read as Parquet."""
    extension = name.rsplit(".", 1)[-1].lower()
    return {"csv": csv, "json": json, "xml": xml}.get(extension, parquet)(spark, path, schema)


def document_type(path: Column) -> Column:
    """Kind of a document by its extension."""
    extension = F.lower(F.substring_index(path, ".", -1))
    return (
        F.when(extension == "pdf", "PDF")
        .when(extension == "docx", "DOCX")
        .when(extension.isin("png", "jpg", "jpeg"), "IMAGE")
        .when(extension == "txt", "TEXT")
    )


def text_documents(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Landed text files: (path, value, extracted_text, document_type).

    One file is one document; with ``separator`` a file holds many documents, which avoids one small
    file per document.
    """
    rows = spark.read.text(path, lineSep=separator) if separator else spark.read.text(path, wholetext=True)
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        "value",
        F.col("value").alias("extracted_text"),
        document_type(F.col("_metadata.file_path")).alias("document_type"),
    )


def table(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout)


def cdc_changes(df: DataFrame, after_lsn: str | None, column: str = "__$start_lsn") -> DataFrame:
    """Change-table rows after a log position given as hex text; all rows without a position."""
    if not after_lsn:
        return df
    if not re.fullmatch(r"[0-9a-fA-F]+", after_lsn):
        raise ValueError(f"not a hexadecimal log position: {after_lsn}")
    return df.where(F.col(f"`{column}`") > F.unhex(F.lit(after_lsn.rjust(20, "0"))))


def jdbc_query(
    table: str,
    clause: str | None = None,
    column: str | None = None,
    value: str | None = None,
    kind: str = "datetime",
) -> str:
    """Sub-select with source filter and watermark, evaluated by the database."""
    tests = [f"({checked_clause(clause)})"] if clause else []
    if column and value not in (None, ""):
        bound = str(int(value)) if kind.lower() in NUMBER_WATERMARKS else "'" + value.replace("'", "''") + "'"
        tests.append(f"{checked_name(column)} > {bound}")
    return f"SELECT * FROM {checked_name(table)}" + (f" WHERE {' AND '.join(tests)}" if tests else "")


def cdc_query(table: str, after_lsn: str | None, clause: str | None = None, column: str = "__$start_lsn") -> str:
    """Sub-select of a change table after a log position, compared as binary by the database."""
    tests = [f"({checked_clause(clause)})"] if clause else []
    if after_lsn:
        if not re.fullmatch(r"[0-9a-fA-F]+", after_lsn):
            raise ValueError(f"not a hexadecimal log position: {after_lsn}")
        tests.append(f"{checked_name(column)} > 0x{after_lsn.rjust(20, '0')}")
    return f"SELECT * FROM {checked_name(table)}" + (f" WHERE {' AND '.join(tests)}" if tests else "")


def document_query(epoch: int | str | None, clause: str | None = None, column: str = "_ts") -> str:
    """Store query for documents changed after an epoch second; without one, for all documents."""
    tests = [f"({checked_clause(clause)})"] if clause else []
    if epoch not in (None, ""):
        tests.append(f"c.{checked_name(column)} > {int(epoch)}")
    return "SELECT * FROM c" + (f" WHERE {' AND '.join(tests)}" if tests else "")


PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def partition_of(options: dict[str, str]) -> tuple[str, str, str, int] | None:
    """The range partitioning that an entity's options name, taken out of them; None without all four."""
    values = [options.pop(name, None) for name in PARTITION_OPTIONS]
    if None in values:
        return None
    return checked_name(values[0]), str(values[1]), str(values[2]), int(values[3])


def jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    options: dict[str, str] | None = None,
    partition: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """Relational read of a sub-select.

    ``partition`` = (column, lower, upper, number) reads in parallel ranges; without it one task
    reads everything, which suits small tables only.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS src")
    if partition:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        reader = reader.options(**dict(zip(names, map(str, partition))))
    return reader.options(**(options or {})).load()


def since_epoch(df: DataFrame, epoch: int | str | None, column: str = "_ts") -> DataFrame:
    """Documents changed after an epoch second."""
    return df.where(F.col(column) > F.lit(int(epoch or 0)))


def document_store(
    spark: SparkSession,
    format: str,
    options: dict[str, str],
    epoch: int | str | None = None,
    clause: str | None = None,
) -> DataFrame:
    """Document-store read through its Spark connector.

    Position and filter are part of the store's query; without a position all documents are read.
    """
    options = {"spark.cosmos.read.customQuery": document_query(epoch, clause), **options}
    rows = spark.read.format(format).options(**options).load()
    return rows if epoch in (None, "") else since_epoch(rows, epoch)


def api_records(pages: DataFrame, record: str | T.StructType, column: str = "value") -> DataFrame:
    """One row per record of landed API pages.

    A page is a list, or an object whose first present member of data, results, items holds the
    records, or a single record.
    """
    text = F.trim(F.col(column))
    inner = F.coalesce(*[F.get_json_object(text, f"$.{name}") for name in ("data", "results", "items")])
    body = F.when(text.startswith("["), text).otherwise(F.coalesce(inner, text))
    body = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    ddl = record if isinstance(record, str) else record.simpleString()
    rows = pages.select(F.from_json(body, f"array<{ddl}>").alias("records"))
    return rows.select(F.inline("records"))


def api_pages(spark: SparkSession, path: str, record: str | T.StructType) -> DataFrame:
    """Records of page files, one page per file."""
    return api_records(spark.read.text(path, wholetext=True), record)


def query_lookup(spark: SparkSession, query: str) -> DataFrame:
    """Rows of a query as JSON text, one per row; nothing is collected."""
    result = spark.sql(query)
    return result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


# Source types by name prefix, for entities that do not state their type.
PREFIXES = {
    "SQL": ("azsql", "sql", "postgres", "mysql"),
    "API": ("api", "rest"),
    "FILE": ("adls", "file", "s3", "blob"),
    "COSMOS": ("cosmos", "mongodb"),
}


def source_type(entity: Entity) -> str:
    """Declared source type, else the one of the name prefix, else SQL."""
    if entity.source_type:
        return entity.source_type.upper()
    prefix = entity.source_name.split("-")[0]
    return next((kind for kind, names in PREFIXES.items() if prefix in names), "SQL")


def read_entity(spark: SparkSession, entity: Entity) -> DataFrame:
    """All rows of an entity above its watermark, from the reader its type and extension name."""
    kind, options = source_type(entity), dict(entity.options)
    incremental_load = entity.load_type == "INCREMENTAL"
    value = entity.last_watermark if incremental_load else None
    schema = options.pop("schema", None)
    if kind == "API":
        rows = api_pages(spark, entity.location, schema)
    elif kind == "FILE" and entity.name.endswith(".txt"):
        rows = text_documents(spark, entity.location, options.get("separator"))
    elif kind == "FILE":
        rows = file(spark, entity.location, entity.name, schema)
    elif kind == "COSMOS":
        epoch = None if entity.load_type == "FULL" else entity.last_watermark or 0
        return document_store(spark, options.pop("format", "cosmos.oltp"), options, epoch, entity.filter_clause)
    elif entity.load_type == "CDC":
        query = cdc_query(entity.table, entity.last_watermark, entity.filter_clause)
        return jdbc(spark, entity.location, query, options, partition_of(options))
    else:
        query = jdbc_query(
            entity.table, entity.filter_clause, entity.watermark_column, value, entity.watermark_type
        )
        return jdbc(spark, entity.location, query, options, partition_of(options))
    if entity.load_type == "CDC":
        return cdc_changes(rows, entity.last_watermark)
    return incremental.filter_with_clause(
        rows, entity.filter_clause, entity.watermark_column, value, entity.watermark_type
    )
