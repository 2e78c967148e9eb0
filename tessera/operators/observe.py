"""Run history: control-table queries, views, dashboard queries and KPI checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import as_time, bin_time, day_of, hour_of, percent, seconds_between
from tessera.operators import joins
from tessera.operators.standardize import recent

# --- control tables --------------------------------------------------------------------------------


def entities_to_process(entities: DataFrame, sources: DataFrame, entity_runs: DataFrame) -> DataFrame:
    """Active entities of active sources with their last successful watermark, else the offset."""
    active = entities.where("IsActive").join(
        sources.where("IsActive").drop("IsActive"), "SourceId", "inner"
    )
    return (
        joins.lateral_latest(active, entity_runs)
        .select(
            "EntityId",
            "EntityName",
            "SourceName",
            "SourceType",
            "SourceSchema",
            "TargetLakehouse",
            "TargetSchema",
            "TargetTableName",
            "LoadType",
            "WatermarkColumn",
            "WatermarkDataType",
            F.coalesce("WatermarkAfter", "WatermarkOffset").alias("LastWatermark"),
            "ConnectionStringRef",
            "SourceFilterClause",
            "AuthenticationType",
            "ParallelismDegree",
            "Priority",
        )
        .orderBy("Priority", "EntityId")
    )


def fold_runs(events: DataFrame) -> DataFrame:
    """Start and end events to one row per run.

    Row counts keep their last known value when a later end event has none; status, error and
    watermark are those of the last end event.
    """
    ended = F.when(F.col("EventType") == "end", F.col("EventTime"))
    started = F.when(F.col("EventType") == "start", F.col("EventTime"))

    def last(column: str, when: Column) -> Column:
        return F.max_by(column, when).alias(column)

    def last_known(column: str) -> Column:
        return last(column, F.when(F.col(column).isNotNull(), F.col("EventTime")))

    return (
        events.groupBy("RunKind", "RunId")
        .agg(
            F.max("ParentRunId").alias("ParentRunId"),
            F.min_by("Name", "EventTime").alias("Name"),
            F.max_by("Status", ended).alias("__status"),
            F.min(started).alias("StartTime"),
            F.max(ended).alias("EndTime"),
            last("ErrorMessage", ended),
            *[last_known(c) for c in ("RowsRead", "RowsWritten", "RowsRejected")],
            last("WatermarkBefore", started),
            last("WatermarkAfter", ended),
        )
        .withColumn("Status", F.coalesce("__status", F.lit("RUNNING")))
        .drop("__status")
    )


def entity_runs(runs: DataFrame) -> DataFrame:
    """Folded runs of entities in the shape of the entity run table; the run id ends in the entity id."""
    return runs.where("RunKind = 'entity'").select(
        F.regexp_extract("RunId", r"-([0-9]+)$", 1).cast("int").alias("EntityId"),
        F.col("RunId").alias("EntityRunId"),
        F.col("ParentRunId").alias("PipelineRunId"),
        F.col("Name").alias("EntityName"),
        "Status", "StartTime", "EndTime", "RowsRead", "RowsWritten", "RowsRejected",
        "WatermarkBefore", "WatermarkAfter", "ErrorMessage",
    )


def with_duration(runs: DataFrame, as_of) -> DataFrame:
    """Runs with their duration in seconds; open runs are measured to ``as_of``."""
    end = F.coalesce(F.col("EndTime"), as_time(as_of))
    return runs.withColumn("DurationSeconds", seconds_between(F.col("StartTime"), end))


_SUMMARY = ["Status", "StartTime", "EndTime", "DurationSeconds", "RowsRead", "RowsWritten", "ErrorMessage"]


def pipeline_summary(pipeline_runs: DataFrame, as_of) -> DataFrame:
    return with_duration(pipeline_runs, as_of).select("RunId", "PipelineName", *_SUMMARY)


def gold_summary(gold_runs: DataFrame, as_of) -> DataFrame:
    return with_duration(gold_runs, as_of).select("GoldRunId", "RunId", "ModelName", "ModelType", *_SUMMARY)


# --- dashboard queries -----------------------------------------------------------------------------


def _is(status: str) -> Column:
    return F.upper("Status") == status


def _success() -> Column:
    return percent(F.count_if(_is("SUCCEEDED")), F.count(F.lit(1)))


def pipeline_runs_24h(pipeline_runs: DataFrame, as_of) -> DataFrame:
    runs = with_duration(recent(pipeline_runs, "StartTime", "24 hours", as_of), as_of)
    return runs.groupBy("PipelineName").agg(
        F.count(F.lit(1)).alias("TotalRuns"),
        F.count_if(_is("SUCCEEDED")).alias("Successful"),
        F.count_if(_is("FAILED")).alias("Failed"),
        _success().alias("SuccessRate"),
        F.avg("DurationSeconds").alias("AvgDuration"),
    )


def entity_throughput(entity_runs: DataFrame, as_of) -> DataFrame:
    runs = with_duration(recent(entity_runs, "StartTime", "24 hours", as_of), as_of)
    totals = runs.groupBy("EntityName").agg(
        F.sum("RowsRead").alias("TotalRows"),
        F.sum("RowsWritten").alias("TotalWritten"),
        F.avg("DurationSeconds").alias("AvgDuration"),
    )
    return totals.orderBy(F.desc("TotalRows"), "EntityName")


def gold_build_times(gold_runs: DataFrame, as_of) -> DataFrame:
    runs = with_duration(recent(gold_runs, "StartTime", "7 days", as_of), as_of)
    return runs.groupBy("ModelName").agg(
        F.avg("DurationSeconds").alias("AvgBuildTime"),
        F.max("DurationSeconds").alias("MaxBuildTime"),
        _success().alias("SuccessRate"),
    )


def _rates(results: DataFrame, *by) -> DataFrame:
    """Sum of failure rates, rows and failures per rule, before the rules are joined."""
    return results.groupBy("RuleId", *by).agg(
        F.sum("FailureRate").alias("__sum"),
        F.count("FailureRate").alias("__n"),
        F.count_if(~F.col("Passed")).alias("__failures"),
    )


def quality_trend(results: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """Average failure rate and critical failures per entity and day over seven days."""
    described = rules.select("RuleId", "EntityId", "Severity")
    daily = _rates(recent(results, "EvaluatedTime", "7 days", as_of), day_of("EvaluatedTime").alias("Day"))
    critical = F.when(F.col("Severity") == "CRITICAL", F.col("__failures")).otherwise(0)
    return daily.join(described, "RuleId").groupBy("EntityId", "Day").agg(
        F.try_divide(F.sum("__sum"), F.sum("__n")).alias("AvgFailureRate"),
        F.sum(critical).alias("CriticalFailures"),
    )


def throttling(metrics: DataFrame, metric: str = "CapacityThrottling") -> DataFrame:
    """Throttle events per hour."""
    events = metrics.where((F.col("MetricName") == metric) & (F.col("Maximum") > 0))
    return events.groupBy(hour_of("TimeGenerated").alias("Hour")).agg(
        F.count(F.lit(1)).alias("ThrottleEvents")
    )


def drift_log_24h(log: DataFrame, as_of) -> DataFrame:
    return recent(log, "DetectedTime", "24 hours", as_of).select(
        "EntityId", "DriftType", "AddedColumns", "RemovedColumns", "DetectedTime"
    )


def quarantine_hourly(rows: DataFrame, as_of) -> DataFrame:
    return (
        recent(rows, "QuarantineTime", "24 hours", as_of)
        .groupBy("SourceTable", hour_of("QuarantineTime").alias("Hour"))
        .agg(F.count(F.lit(1)).alias("QuarantinedCount"))
    )


def success_rate_24h(pipeline_runs: DataFrame, as_of) -> DataFrame:
    runs = recent(pipeline_runs, "StartTime", "24 hours", as_of)
    return runs.agg(F.round(_success(), 2).alias("SuccessRate"))


def rows_last_hour(pipeline_runs: DataFrame, as_of) -> DataFrame:
    return recent(pipeline_runs, "StartTime", "1 hour", as_of).agg(F.sum("RowsRead").alias("TotalRows"))


def capacity_hourly(metrics: DataFrame, as_of) -> DataFrame:
    return (
        recent(metrics, "TimeGenerated", "24 hours", as_of)
        .groupBy(hour_of("TimeGenerated").alias("Hour"))
        .agg(F.avg("CUConsumption").alias("AvgCU"), F.max("CUConsumption").alias("MaxCU"))
    )


def quality_score(results: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """100 minus the average failure rate, per rule name."""
    names = rules.select("RuleId", "RuleName")
    return (
        _rates(recent(results, "EvaluatedTime", "24 hours", as_of))
        .join(names, "RuleId")
        .groupBy("RuleName")
        .agg(F.try_divide(F.sum("__sum"), F.sum("__n")).alias("AvgFailureRate"))
        .withColumn("QualityScore", F.round(F.lit(100) - F.col("AvgFailureRate"), 2))
    )


def active_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("Status") == "Active").groupBy("Severity").agg(
        F.count(F.lit(1)).alias("Count")
    )


def sales_5min(transactions: DataFrame, as_of) -> DataFrame:
    """Revenue per five minutes over the last hour."""
    return (
        recent(transactions, "Timestamp", "1 hour", as_of)
        .groupBy(bin_time("Timestamp", "5 minutes").alias("Bin"))
        .agg(F.sum("AmountUSD").alias("Revenue"))
    )


def success_rate_hourly(pipeline_runs: DataFrame) -> DataFrame:
    return pipeline_runs.groupBy(hour_of("StartTime").alias("Hour")).agg(_success().alias("SuccessRate"))


def top_failing(entity_runs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` entities with most failed runs, ties by name."""
    failures = entity_runs.where(_is("FAILED")).groupBy("EntityName").agg(
        F.count(F.lit(1)).alias("FailureCount")
    )
    return failures.orderBy(F.desc("FailureCount"), "EntityName").limit(k)


def capacity_5min(metrics: DataFrame, metric: str = "CapacityUtilization") -> DataFrame:
    return (
        metrics.where(F.col("MetricName") == metric)
        .groupBy(bin_time("TimeGenerated", "5 minutes").alias("Bin"))
        .agg(F.avg("Maximum").alias("AvgCU"))
    )


# Target and alert threshold per metric, and whether more is better.
THRESHOLDS = {
    "Pipeline Success Rate": (99.0, 95.0, True),
    "Avg Pipeline Duration": (30.0, 60.0, False),
    "Data Quality Score": (98.0, 95.0, True),
    "Capacity Utilization": (80.0, 95.0, False),
    "Failed Entities/Day": (0.0, 5.0, False),
}


def kpis(
    pipeline_runs: DataFrame,
    entity_runs: DataFrame,
    results: DataFrame,
    metrics: DataFrame,
    as_of,
) -> DataFrame:
    """The five metrics of the last 24 hours, as (metric, value); durations in minutes.

    Every input is reduced to one row before the rows are stacked.
    """
    runs = with_duration(recent(pipeline_runs, "StartTime", "24 hours", as_of), as_of)
    success, duration = "Pipeline Success Rate", "Avg Pipeline Duration"
    pairs = F.array(
        F.struct(F.lit(success).alias("metric"), F.col("rate").alias("value")),
        F.struct(F.lit(duration).alias("metric"), F.col("minutes").alias("value")),
    )
    from_runs = runs.agg(
        _success().alias("rate"), (F.avg("DurationSeconds") / F.lit(60.0)).alias("minutes")
    ).select(F.inline(pairs))

    def single(df: DataFrame, metric: str, value: Column) -> DataFrame:
        return df.agg(value.cast("double").alias("value")).select(F.lit(metric).alias("metric"), "value")

    quality = recent(results, "EvaluatedTime", "24 hours", as_of)
    utilisation = recent(metrics, "TimeGenerated", "24 hours", as_of).where(
        F.col("MetricName") == "CapacityUtilization"
    )
    entities = recent(entity_runs, "StartTime", "24 hours", as_of).where(_is("FAILED"))
    return (
        from_runs.unionByName(single(quality, "Data Quality Score", F.lit(100) - F.avg("FailureRate")))
        .unionByName(single(utilisation, "Capacity Utilization", F.avg("Maximum")))
        .unionByName(single(entities, "Failed Entities/Day", F.count_distinct("EntityName")))
    )


def check_kpis(values: DataFrame) -> DataFrame:
    """KPI rows with whether each meets its target and whether it calls for an alert."""
    on_target, alert = F.lit(None).cast("boolean"), F.lit(None).cast("boolean")
    value = F.col("value")
    for metric, (target, limit, more) in THRESHOLDS.items():
        here = F.col("metric") == metric
        met = value > target if more else (value < target if target else value <= target)
        hit = value < limit if more else value > limit
        on_target, alert = F.when(here, met).otherwise(on_target), F.when(here, hit).otherwise(alert)
    return values.select("metric", "value", on_target.alias("on_target"), alert.alias("alert"))
