"""Lineage columns, prefixed by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import as_time


def basic(
    df: DataFrame,
    run_id: str,
    as_of,
    stage: str = "bronze",
    source_name: str | None = None,
    entity_name: str | None = None,
) -> DataFrame:
    """Ingestion time and run id, and the source and entity names where given."""
    columns = {
        f"_{stage}_ingestion_timestamp": as_time(as_of),
        f"_{stage}_run_id": F.lit(run_id),
    }
    if source_name:
        columns[f"_{stage}_source_name"] = F.lit(source_name)
    if entity_name:
        columns[f"_{stage}_entity_name"] = F.lit(entity_name)
    return df.withColumns(columns)


def bronze(
    df: DataFrame,
    source_name: str,
    entity_name: str,
    load_type: str,
    watermark_before: str | None,
    run_id: str,
    entity_run_id: str,
    as_of,
) -> DataFrame:
    return df.withColumns(
        {
            "_bronze_ingestion_timestamp": as_time(as_of),
            "_bronze_source_name": F.lit(source_name),
            "_bronze_entity_name": F.lit(entity_name),
            "_bronze_run_id": F.lit(run_id),
            "_bronze_entity_run_id": F.lit(entity_run_id),
            "_bronze_load_type": F.lit(load_type),
            "_bronze_watermark_before": F.lit(watermark_before).cast("string"),
            "_bronze_batch_id": F.date_format(as_time(as_of), "yyyyMMddHHmmss"),
        }
    )


def silver(df: DataFrame, transformation_id: int, run_id: str, entity_run_id: str, as_of) -> DataFrame:
    return df.withColumns(
        {
            "_silver_transform_timestamp": as_time(as_of),
            "_silver_transformation_id": F.lit(transformation_id),
            "_silver_run_id": F.lit(run_id),
            "_silver_entity_run_id": F.lit(entity_run_id),
        }
    )


def gold(df: DataFrame, model_name: str, run_id: str, as_of) -> DataFrame:
    return df.withColumns(
        {
            "_gold_load_timestamp": as_time(as_of),
            "_gold_run_id": F.lit(run_id),
            "_gold_model_name": F.lit(model_name),
        }
    )
