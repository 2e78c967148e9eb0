"""Alert conditions and how long they last. Each returns the matching rows; delivering them is left to the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import as_time
from tessera.operators.standardize import recent

# The thresholds of the alert rules.
HIGH_VALUE_USD = 10_000
FRAUD_USD = 5_000
DEVICE_ANOMALIES = 5
QUALITY_FAILURE_RATE = 5
CAPACITY_LIMIT = 95


def _is_high_value() -> Column:
    return F.col("AmountUSD") > HIGH_VALUE_USD


def _is_fraud() -> Column:
    return (F.col("Status") == "Fraud") & (F.col("AmountUSD") > FRAUD_USD)


def high_value(transactions: DataFrame) -> DataFrame:
    return transactions.where(_is_high_value())


def fraud(transactions: DataFrame) -> DataFrame:
    return transactions.where(_is_fraud())


def device(summary: DataFrame, limit: int = DEVICE_ANOMALIES) -> DataFrame:
    """Device bins with more anomalies than the limit."""
    return summary.where(F.col("AnomalyCount") > limit)


def pipeline_failed(pipeline_runs: DataFrame, as_of) -> DataFrame:
    """Failed runs of the last 15 minutes."""
    return recent(pipeline_runs, "StartTime", "15 minutes", as_of).where(F.upper("Status") == "FAILED")


def quality_drop(results: DataFrame) -> DataFrame:
    return results.where(F.col("FailureRate") > QUALITY_FAILURE_RATE)


def capacity(metrics: DataFrame) -> DataFrame:
    """Readings above the utilisation limit."""
    return metrics.where(
        (F.col("MetricName") == "CapacityUtilization") & (F.col("Maximum") > CAPACITY_LIMIT)
    )


# Name and severity of each rule.
RULES = {
    "high_value": ("High Value Transaction Alert", "High"),
    "fraud": ("Fraud Detection", "Critical"),
    "device": ("IoT Device Anomaly", "Medium"),
    "pipeline": ("Pipeline Failure", "Critical"),
    "quality": ("Data Quality Drop", "High"),
    "capacity": ("Capacity Throttling", "Warning"),
}


def _entries(rows: DataFrame, rule: str, key: str, time: str, value: Column) -> DataFrame:
    name, severity = RULES[rule]
    return rows.select(
        F.lit(name).alias("RuleName"),
        F.lit(severity).alias("Severity"),
        F.col(key).cast("string").alias("EntityKey"),
        F.col(time).cast("timestamp_ntz").alias("EventTime"),
        value.cast("double").alias("Value"),
    )


def _amount_entries(transactions: DataFrame) -> DataFrame:
    """Entries of both rules on single transactions, from one scan: a row gives one entry per rule it meets."""
    tests = {"high_value": _is_high_value(), "fraud": _is_fraud()}
    met = F.array_compact(F.array(*[F.when(test, F.struct(*map(F.lit, RULES[rule]))) for rule, test in tests.items()]))
    return transactions.where(_is_high_value() | _is_fraud()).select(
        F.inline(met).alias("RuleName", "Severity"),
        F.col("TransactionId").cast("string").alias("EntityKey"),
        F.col("Timestamp").cast("timestamp_ntz").alias("EventTime"),
        F.col("AmountUSD").cast("double").alias("Value"),
    )


def feed(
    transactions: DataFrame,
    device_summary: DataFrame,
    pipeline_runs: DataFrame,
    results: DataFrame,
    metrics: DataFrame,
    as_of,
    device_limit: int = DEVICE_ANOMALIES,
) -> DataFrame:
    """All alert conditions as one table: rule, severity, key, time, value, and the status of a new alert."""
    failed = pipeline_failed(pipeline_runs, as_of)
    found = device(device_summary, device_limit)
    parts = [
        _amount_entries(transactions),
        _entries(found, "device", "DeviceId", "Timestamp", F.col("AnomalyCount")),
        _entries(failed, "pipeline", "RunId", "StartTime", F.lit(1)),
        _entries(quality_drop(results), "quality", "RuleId", "EvaluatedTime", F.col("FailureRate")),
        _entries(capacity(metrics), "capacity", "MetricName", "TimeGenerated", F.col("Maximum")),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("Status", F.lit("Active"))


# --- episodes --------------------------------------------------------------------------------------

EPISODE = ("OpenedAt", "LastAt", "Evaluations")


def episodes(
    met: DataFrame, keys: list[str], time: str, every: str, as_of, known: DataFrame | None = None
) -> DataFrame:
    """Conditions that last, as one row from the evaluation that opened them to the one that closed them.

    ``met`` has a row per evaluation at which the condition of a key held; evaluations are ``every`` interval
    apart, so a longer gap means that one found it not held. ``known`` are episodes from earlier calls: those that
    new evaluations touch or carry on are joined with them, whatever order evaluations arrive in, and the
    same evaluation may be given again. ``as_of`` is the time of the last evaluation: an episode closed by then
    has the time of the first evaluation that did not hold.

    Evaluations of a key are made distinct before they are ordered, so a window orders as many rows as there
    were evaluations, not events.
    """
    step = F.expr(f"INTERVAL {every}")
    at = F.col(time).cast("timestamp_ntz")
    spans = met.where(F.col(time).isNotNull()).select(*keys, at.alias("OpenedAt"), at.alias("LastAt"), F.lit(1).cast("long").alias("Evaluations")).distinct()
    if known is not None:
        spans = known.select(*keys, *EPISODE).unionByName(spans)
    by_time = Window.partitionBy(*keys).orderBy("OpenedAt", F.col("LastAt").desc())
    before = F.max("LastAt").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    told = spans.withColumns({"__before": before, "__inside": F.coalesce(F.col("LastAt") <= before, F.lit(False))})
    told = told.withColumn("__opens", F.coalesce((F.col("OpenedAt") > F.col("__before") + step).cast("int"), F.lit(1)))
    told = told.withColumn("__island", F.sum("__opens").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    # An evaluation inside a known episode is one of those it counts already.
    found = told.groupBy(*keys, "__island").agg(
        F.min("OpenedAt").alias("OpenedAt"),
        F.max("LastAt").alias("LastAt"),
        F.sum(F.when(F.col("__inside"), 0).otherwise(F.col("Evaluations"))).alias("Evaluations"),
    )
    end = F.col("LastAt") + step
    closed = F.when(end <= as_time(as_of), end)
    state = F.when(closed.isNull(), "Open").otherwise("Closed")
    return found.select(*keys, *EPISODE, closed.alias("ClosedAt"), state.alias("Status"))
