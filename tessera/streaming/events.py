"""Event processing. Every function takes a batch or a streaming frame.

Rollups group by fixed windows. On a stream they set a watermark, so state stays bounded; rows later
than that are dropped and counted in the query progress. Distinct counts are exact in batch and come
from a fixed-size sketch on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import percent

WATERMARK = "10 minutes"

# Columns of the raw event tables with JSON path and type.
MAPPINGS = {
    "IoTDevices": [
        ("DeviceId", "$.deviceId", "string"),
        ("Timestamp", "$.timestamp", "timestamp"),
        ("Temperature", "$.temperature", "double"),
        ("Humidity", "$.humidity", "double"),
        ("Location", "$.location", "string"),
        ("Status", "$.status", "string"),
    ],
    "WebEvents": [
        ("EventId", "$.eventId", "string"),
        ("Timestamp", "$.timestamp", "timestamp"),
        ("UserId", "$.userId", "string"),
        ("PageUrl", "$.pageUrl", "string"),
        ("SessionId", "$.sessionId", "string"),
        ("EventType", "$.eventType", "string"),
        ("DurationMs", "$.durationMs", "int"),
    ],
    "Transactions": [
        ("TransactionId", "$.transactionId", "string"),
        ("Timestamp", "$.timestamp", "timestamp"),
        ("UserId", "$.userId", "string"),
        ("Amount", "$.amount", "decimal(18,4)"),
        ("Currency", "$.currency", "string"),
        ("MerchantId", "$.merchantId", "string"),
        ("Status", "$.status", "string"),
    ],
}


def map_json(df: DataFrame, mapping: list[tuple[str, str, str]], column: str = "value") -> DataFrame:
    """Typed columns from a JSON text column; a record that does not parse gives nulls."""
    names = [(name, path.removeprefix("$."), kind) for name, path, kind in mapping]
    schema = ", ".join(f"`{key}` {kind}" for _, key, kind in names)
    parsed = df.select(F.from_json(F.col(column).cast("string"), schema).alias("record"))
    return parsed.select(*[F.col(f"record.`{key}`").alias(name) for name, key, _ in names])


def clean_iot(df: DataFrame) -> DataFrame:
    raw = F.col("Temperature")
    return df.withColumns(
        {
            "TemperatureCelsius": (raw - F.lit(32)) * F.lit(5.0) / F.lit(9.0),
            "IsAnomaly": (raw > 100) | (raw < 0),
        }
    )


def clean_web(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"HourOfDay": F.hour("Timestamp"), "IsBounce": F.col("DurationMs") < F.lit(5000)}
    )


def clean_transactions(df: DataFrame) -> DataFrame:
    """Amount in USD, at the fixed rate of 1.1 for any other currency, and the high-value flag."""
    is_usd = F.col("Currency").eqNullSafe(F.lit("USD"))
    other = F.col("Amount") * F.lit("1.1").cast("decimal(2,1)")
    usd = F.when(is_usd, F.col("Amount")).otherwise(other.cast("decimal(18,4)"))
    return df.withColumn("AmountUSD", usd.cast("decimal(18,4)")).withColumn(
        "IsHighValue", F.col("AmountUSD") > 1000
    )


def windowed(
    df: DataFrame,
    width: str,
    by: str | None,
    metrics: dict[str, Column],
    output: str = "Timestamp",
    watermark: str = WATERMARK,
    slide: str | None = None,
    time: str = "Timestamp",
) -> DataFrame:
    """Metrics per window and key, with the window start as ``output``."""
    keys = [by] if by else []
    if df.isStreaming:
        df = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = df.groupBy(*keys, window).agg(*[e.alias(n) for n, e in metrics.items()])
    return grouped.select(*keys, F.col("window.start").cast("timestamp_ntz").alias(output), *metrics)


def _distinct(df: DataFrame, column: str) -> Column:
    return F.approx_count_distinct(column) if df.isStreaming else F.count_distinct(column)


def transaction_summary(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    metrics = {
        "TransactionCount": F.count(F.lit(1)),
        "TotalAmount": F.sum("AmountUSD"),
        "AvgAmount": F.avg("AmountUSD"),
        "MaxAmount": F.max("AmountUSD"),
    }
    return windowed(df, "1 hour", "MerchantId", metrics, watermark=watermark)


def device_summary(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    metrics = {
        "AvgTemperature": F.avg("TemperatureCelsius"),
        "MaxHumidity": F.max("Humidity"),
        "AnomalyCount": F.count_if("IsAnomaly"),
    }
    return windowed(df, "5 minutes", "DeviceId", metrics, watermark=watermark)


def merchant_metrics(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    metrics = {
        "TransactionCount": F.count(F.lit(1)),
        "TotalRevenue": F.sum("AmountUSD"),
        "UniqueCustomers": _distinct(df, "UserId"),
        "AvgTransactionValue": F.avg("AmountUSD"),
        "FraudRate": percent(F.count_if(F.col("Status") == "Fraud"), F.count(F.lit(1))),
    }
    return windowed(df, "1 hour", "MerchantId", metrics, "Hour", watermark)


def user_behavior(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Sessions, views, durations, bounces and pages per user and hour.

    ``TopPage`` is the last page by name; batch results add ``MostViewedPage``, the most frequent one.
    In batch, every row counts once for its page and once for its session, so one scan and one pair of
    aggregates give views per page and different sessions alike.
    """
    if df.isStreaming:
        metrics = {
            "SessionCount": _distinct(df, "SessionId"),
            "PageViews": F.count(F.lit(1)),
            "AvgSessionDuration": F.avg("DurationMs").cast("long"),
            "BounceRate": F.avg(F.col("IsBounce").cast("int")) * F.lit(100.0),
            "TopPage": F.max("PageUrl"),
        }
        return windowed(df, "1 hour", "UserId", metrics, "Hour", watermark)
    hour = F.window("Timestamp", "1 hour")["start"].cast("timestamp_ntz")
    sides = F.inline(
        F.array(
            F.struct(F.lit(True).alias("is_page"), F.col("PageUrl").alias("value"), "DurationMs", F.col("IsBounce").cast("int").alias("Bounce")),
            F.struct(
                F.lit(False).alias("is_page"), F.col("SessionId").alias("value"), F.lit(None).alias("DurationMs"), F.lit(None).alias("Bounce")
            ),
        )
    )
    rows = df.where(F.col("UserId").isNotNull()).select("UserId", hour.alias("Hour"), "PageUrl", "SessionId", "DurationMs", "IsBounce")
    sums = {"Duration": F.sum("DurationMs"), "Durations": F.count("DurationMs"), "Bounce": F.sum("Bounce"), "Bounces": F.count("Bounce")}
    per_value = rows.select("UserId", "Hour", sides).groupBy("UserId", "Hour", "is_page", "value").agg(
        F.count(F.lit(1)).alias("n"), *[e.alias(c) for c, e in sums.items()]
    )
    page = F.col("is_page")
    most = F.min(F.when(page, F.struct((-F.col("n")).alias("order"), F.col("value").alias("page"))))
    found = per_value.groupBy("UserId", "Hour").agg(
        F.count_if(~page & F.col("value").isNotNull()).alias("SessionCount"),
        F.sum(F.when(page, F.col("n"))).alias("PageViews"),
        F.try_divide(F.sum("Duration").cast("double"), F.sum("Durations")).cast("long").alias("AvgSessionDuration"),
        (F.try_divide(F.sum("Bounce").cast("double"), F.sum("Bounces")) * F.lit(100.0)).alias("BounceRate"),
        F.max(F.when(page, F.col("value"))).alias("TopPage"),
        most.alias("most"),
    )
    return found.select("*", F.col("most.page").alias("MostViewedPage")).drop("most")


def user_hours(df: DataFrame) -> DataFrame:
    """The users and hours that ``user_behavior`` of a batch has rows for."""
    return windowed(df, "1 hour", "UserId", {"PageViews": F.count(F.lit(1))}, "Hour")


def merchant_rollup(metrics: DataFrame) -> DataFrame:
    """Metric rows re-aggregated per merchant and hour.

    Counts and revenue add up. Unique customers added over rows are an upper bound, and the averages
    are averages of the rows' averages.
    """
    return metrics.groupBy("MerchantId", F.date_trunc("hour", "Hour").cast("timestamp_ntz").alias("Hour")).agg(
        F.sum("TransactionCount").alias("TransactionCount"),
        F.sum("TotalRevenue").alias("TotalRevenue"),
        F.sum("UniqueCustomers").alias("UniqueCustomers"),
        F.avg("AvgTransactionValue").alias("AvgTransactionValue"),
        F.avg("FraudRate").alias("FraudRate"),
    )


def fraud_alert(df: DataFrame, limit: int = 3, watermark: str = WATERMARK) -> DataFrame:
    """Merchants with more than ``limit`` high-value frauds in five minutes."""
    metrics = {"FraudCount": F.count(F.lit(1)), "TotalFraudAmount": F.sum("AmountUSD")}
    rows = df.where(F.col("IsHighValue") & (F.col("Status") == "Fraud"))
    found = windowed(rows, "5 minutes", "MerchantId", metrics, watermark=watermark)
    return found.where(F.col("FraudCount") > limit)


def high_value_alert(df: DataFrame, limit: int = 10_000) -> DataFrame:
    return df.where(F.col("AmountUSD") > limit).select(
        "TransactionId", "UserId", "MerchantId", "AmountUSD", "Timestamp"
    )


def device_alert(df: DataFrame, limit: int = 5, watermark: str = WATERMARK) -> DataFrame:
    """Devices with more than ``limit`` anomalies in five minutes."""
    metrics = {"AnomalyCount": F.count(F.lit(1))}
    found = windowed(df.where("IsAnomaly"), "5 minutes", "DeviceId", metrics, watermark=watermark)
    return found.where(F.col("AnomalyCount") > limit)


def pipeline_failure_alert(runs: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Failures in the last 15 minutes, looked at every 5 minutes."""
    failed = runs.where(F.upper("Status") == "FAILED")
    metrics = {"Failures": F.count(F.lit(1))}
    return windowed(
        failed, "15 minutes", None, metrics, "WindowStart", watermark, "5 minutes", "StartTime"
    )
