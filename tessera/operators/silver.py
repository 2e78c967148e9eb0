"""Silver transformations, driven by a configuration row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import Transformation
from tessera.functions.columns import as_time
from tessera.operators import aggregates, audit, dedup, scd, standardize

INGESTED = "_bronze_ingestion_timestamp"


def standardize_table(
    df: DataFrame,
    logic: dict,
    references: dict[str, DataFrame] | None = None,
    transformation_id: int = 0,
    run_id: str = "",
    entity_run_id: str = "",
    as_of="1970-01-01",
) -> DataFrame:
    """Dedup, null defaults, standardization, key flags and lineage, each where configured."""
    key = logic.get("dedup_key")
    if key and key in df.columns:
        order = [F.col(INGESTED).desc()] if INGESTED in df.columns else []
        df = dedup.latest(df, [key], order)
    df = standardize.null_defaults(df, logic.get("null_defaults", {}))
    df = standardize.apply(df, logic.get("standardize", {}))
    df = dedup.flag_keys(df, logic.get("foreign_keys", []), references or {})
    return audit.silver(df, transformation_id, run_id, entity_run_id, as_of)


def parse_columns(df: DataFrame, logic: dict) -> DataFrame:
    """JSON column flattened and timestamp column parsed, where configured."""
    column = logic.get("json_parse")
    if column and column in df.columns:
        df = standardize.json_flatten(df, column, logic.get("json_schema"))
    column = logic.get("timestamp_extract")
    if column and column in df.columns:
        df = standardize.timestamp(df, column)
    return df


def enrich(df: DataFrame, logic: dict, *args, **kwargs) -> DataFrame:
    """Standardization and JSON parsing."""
    return parse_columns(standardize_table(df, logic, *args, **kwargs), logic)


def aggregate(df: DataFrame, logic: dict, as_of) -> DataFrame:
    """Grouped aggregates with the transform time."""
    rows = aggregates.grouped(df, logic.get("group_by", []), logic.get("aggregations", []))
    return rows.withColumn("_silver_transform_timestamp", as_time(as_of))


def dispatch(
    df: DataFrame,
    transformation: Transformation,
    references: dict[str, DataFrame] | None = None,
    run_id: str = "",
    entity_run_id: str = "",
    as_of="1970-01-01",
    history: DataFrame | None = None,
) -> DataFrame:
    """The transformation named by the row; anything unknown standardizes."""
    logic, number = transformation.logic, transformation.transformation_id
    context = (references, number, run_id, entity_run_id, as_of)
    kind = transformation.kind
    if kind == "SCD2":
        order = [F.col(INGESTED).desc()] if INGESTED in df.columns else []
        keys, tracked = list(transformation.business_keys), logic.get("scd2_columns", [])
        return scd.apply(history, df, keys, tracked, as_of, order, scd_names(logic))
    if kind == "DEDUPLICATION":
        key = transformation.business_keys[0] if transformation.business_keys else None
        return standardize_table(df, {"dedup_key": key}, *context)
    if kind == "AGGREGATION":
        return aggregate(df, logic, as_of)
    if kind in ("STANDARDIZATION", "ENRICHMENT"):
        return enrich(df, logic, *context)
    return standardize_table(df, logic, *context)


def scd_names(logic: dict) -> scd.Names:
    return scd.Names(
        logic.get("effective_date", "ValidFrom"),
        logic.get("expiry_date", "ValidTo"),
        logic.get("is_current", "IsCurrent"),
    )
