"""Equi-joins. Join choice is left to Spark: it broadcasts what fits and splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import dedup

# Lineage columns of the silver layer, never used as a join key.
AUDIT_COLUMNS = (
    "_silver_transform_timestamp",
    "_silver_transformation_id",
    "_silver_run_id",
    "_silver_entity_run_id",
)


def join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    return left.join(right, on, how)


def join_source_side(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows joined to the target by a key list, source columns only."""
    return source.alias("source").join(target.alias("target"), keys, "left").select("source.*")


def anti(df: DataFrame, reference: DataFrame, column: str, reference_column: str) -> DataFrame:
    """Rows whose key is absent in the reference."""
    known = reference.select(F.col(reference_column).alias("__known"))
    return df.join(known, df[column] == known["__known"], "left_anti")


def semi(df: DataFrame, reference: DataFrame, column: str, reference_column: str) -> DataFrame:
    """Rows whose key is present in the reference."""
    known = reference.select(F.col(reference_column).alias("__known"))
    return df.join(known, df[column] == known["__known"], "left_semi")


def lateral_latest(entities: DataFrame, runs: DataFrame) -> DataFrame:
    """Every entity with the watermark of its latest successful run, null where there is none."""
    done = runs.where(F.upper("Status") == "SUCCEEDED")
    order = [F.col("EndTime").desc(), F.col("EntityRunId").desc()]
    return dedup.attach_latest(entities, done, ["EntityId"], order, ["WatermarkAfter"])


def common_key(fact: DataFrame, dimension: DataFrame, excluded=AUDIT_COLUMNS) -> str | None:
    """First column of the dimension that the fact has too, lineage columns aside."""
    return next(
        (
            c
            for c in dimension.columns
            if c in fact.columns and c not in excluded and not c.startswith("_")
        ),
        None,
    )


def join_dimension(
    fact: DataFrame, dimension: DataFrame, name: str, on: str | None = None, how: str = "left"
) -> DataFrame:
    """Fact joined to a dimension by the given or the common key.

    Other columns both sides share come out prefixed with the dimension's name; the dimension's
    lineage columns are dropped where the fact has them. Without a key the fact passes unchanged.
    """
    key = on or common_key(fact, dimension)
    if key is None:
        return fact
    shared = [c for c in dimension.columns if c in fact.columns and c != key]
    dimension = dimension.drop(*[c for c in shared if c.startswith("_")])
    renames = {c: f"{name}_{c}" for c in shared if not c.startswith("_")}
    return fact.join(dimension.withColumnsRenamed(renames), key, "inner" if how == "inner" else "left")


def star(
    fact: DataFrame, dimensions: dict[str, tuple[DataFrame, str, str]]
) -> DataFrame:
    """Fact joined along model relationships: name -> (dimension, fact column, dimension column)."""
    for name, (dimension, fact_column, dimension_column) in dimensions.items():
        clashes = {c: f"{name}_{c}" for c in dimension.columns if c in fact.columns}
        renamed = dimension.withColumnsRenamed(clashes)
        key = clashes.get(dimension_column, dimension_column)
        fact = fact.join(renamed, fact[fact_column] == renamed[key], "left").drop(renamed[key])
    return fact


def run_history(pipeline_runs: DataFrame, entity_runs: DataFrame, gold_runs: DataFrame) -> DataFrame:
    """Entity and gold runs with their pipeline run, in one shape.

    The two run tables are stacked before the join, so pipeline runs are joined once.
    """
    shape = ["RunId", "ChildRunId", "Kind", "Name", "ChildStatus"]
    children = entity_runs.select(
        "RunId",
        F.col("EntityRunId").alias("ChildRunId"),
        F.lit("entity").alias("Kind"),
        F.col("EntityName").alias("Name"),
        F.col("Status").alias("ChildStatus"),
    ).unionByName(
        gold_runs.select(
            "RunId",
            F.col("GoldRunId").alias("ChildRunId"),
            F.lit("gold").alias("Kind"),
            F.col("ModelName").alias("Name"),
            F.col("Status").alias("ChildStatus"),
        )
    )
    parents = pipeline_runs.select("RunId", "PipelineName", F.col("Status").alias("PipelineStatus"))
    return children.join(parents, "RunId").select(*shape, "PipelineName", "PipelineStatus")
