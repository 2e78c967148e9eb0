"""Real-time path: ingestion and upserts run as streams, rollups and alerts over the whole tables."""

from pyspark.sql import functions as F

from tessera.layout import bronze
from tessera.session import scratch
from tessera.streaming import events, tables
from tessera.suite import inputs
from tessera.suite.inputs import sql
from tessera.suite.q_sources import landed, transaction_json
from tessera.suite.registry import ORACLES, query


def _json(df, mapping, time="yyyy-MM-dd'T'HH:mm:ss.SSSSSS"):
    fields = [F.col(name).alias(path.removeprefix("$.")) for name, path, _ in mapping]
    return df.select(F.to_json(F.struct(*fields), {"timestampNTZFormat": time}).alias("value"))


def _ingested(spark, sf_dir, make, name):
    """Events as JSON text on a stream, mapped and landed in the raw event table."""
    rows = make(spark, sf_dir, inputs.stream(spark, sf_dir, "events"))
    mapping = events.MAPPINGS[name]
    return landed(spark, events.map_json(_json(rows, mapping), mapping), name)


@query("rt_ingest_iot", sql("SELECT DeviceId, Timestamp, Temperature, Humidity, Location, Status FROM iot_raw", "iot_raw"))
def rt_ingest_iot(spark, sf_dir):
    return _ingested(spark, sf_dir, inputs.readings, "IoTDevices")


@query("rt_ingest_web", sql("SELECT EventId, Timestamp, UserId, PageUrl, SessionId, EventType, DurationMs FROM web_raw", "web_raw"))
def rt_ingest_web(spark, sf_dir):
    return _ingested(spark, sf_dir, inputs.web_events, "WebEvents")


@query(
    "rt_ingest_txn",
    sql("SELECT TransactionId, Timestamp, UserId, CAST(Amount AS DOUBLE) AS Amount, Currency, MerchantId, Status FROM txn_raw", "txn_raw"),
)
def rt_ingest_txn(spark, sf_dir):
    rows = inputs.transactions(spark, sf_dir, inputs.stream(spark, sf_dir, "events"))
    return landed(spark, events.map_json(transaction_json(rows), events.MAPPINGS["Transactions"]), "Transactions")


@query(
    "rt_clean_iot",
    sql("SELECT DeviceId, Timestamp, TemperatureCelsius, IsAnomaly FROM iot", "iot"),
)
def rt_clean_iot(spark, sf_dir):
    rows = events.clean_iot(inputs.readings(spark, sf_dir, inputs.stream(spark, sf_dir, "events")))
    return landed(spark, rows, "IoTDevicesCleaned").select(
        "DeviceId", "Timestamp", "TemperatureCelsius", "IsAnomaly"
    )


@query("rt_clean_web", sql("SELECT EventId, Timestamp, HourOfDay, IsBounce FROM web", "web"))
def rt_clean_web(spark, sf_dir):
    rows = events.clean_web(inputs.web_events(spark, sf_dir, inputs.stream(spark, sf_dir, "events")))
    return landed(spark, rows, "WebEventsCleaned").select("EventId", "Timestamp", "HourOfDay", "IsBounce")


@query(
    "rt_clean_txn",
    sql("SELECT TransactionId, Timestamp, CAST(AmountUSD AS DOUBLE) AS AmountUSD, IsHighValue FROM txn", "txn"),
)
def rt_clean_txn(spark, sf_dir):
    rows = inputs.transactions(spark, sf_dir, inputs.stream(spark, sf_dir, "events"))
    cleaned = landed(spark, events.clean_transactions(rows), "TransactionsCleaned")
    return cleaned.select("TransactionId", "Timestamp", "AmountUSD", "IsHighValue")


def transactions(spark, sf_dir):
    return events.clean_transactions(inputs.transactions(spark, sf_dir))


def devices(spark, sf_dir):
    return events.clean_iot(inputs.readings(spark, sf_dir))


def _rounded(df, **places):
    return df.withColumns({c: F.round(c, p) for c, p in places.items()})


# Average of amounts with four decimals, rounded half up to eight, in whole numbers.
_AVG = """((2 * sum(CAST(AmountUSD * 10000 AS BIGINT)) * 10000 + count(*)) // (2 * count(*)))::DOUBLE / 100000000"""

_SUMMARY = f"""
    SELECT MerchantId, date_trunc('hour', Timestamp) AS Timestamp, count(*) AS TransactionCount,
           CAST(sum(AmountUSD) AS DOUBLE) AS TotalAmount, {_AVG} AS AvgAmount,
           CAST(max(AmountUSD) AS DOUBLE) AS MaxAmount
    FROM txn GROUP BY 1, 2"""


@query("rt_txn_summary", sql(_SUMMARY, "txn"))
def rt_txn_summary(spark, sf_dir):
    return events.transaction_summary(transactions(spark, sf_dir))


@query(
    "rt_iot_summary",
    sql(
        """SELECT DeviceId, time_bucket(INTERVAL '5 minutes', Timestamp) AS Timestamp,
                  round(avg(TemperatureCelsius), 6) AS AvgTemperature, max(Humidity) AS MaxHumidity,
                  count(*) FILTER (IsAnomaly) AS AnomalyCount
           FROM iot GROUP BY 1, 2""",
        "iot",
    ),
)
def rt_iot_summary(spark, sf_dir):
    return _rounded(events.device_summary(devices(spark, sf_dir)), AvgTemperature=6)


_METRICS = f"""
    SELECT MerchantId, date_trunc('hour', Timestamp) AS Hour, count(*) AS TransactionCount,
           CAST(sum(AmountUSD) AS DOUBLE) AS TotalRevenue, count(DISTINCT UserId) AS UniqueCustomers,
           {_AVG} AS AvgTransactionValue,
           round(count(*) FILTER (Status = 'Fraud') * 100.0::DOUBLE / count(*), 6) AS FraudRate
    FROM txn GROUP BY 1, 2"""


@query("rt_merchant_metrics", sql(_METRICS, "txn"))
def rt_merchant_metrics(spark, sf_dir):
    return _rounded(events.merchant_metrics(transactions(spark, sf_dir)), FraudRate=6)


@query(
    "rt_user_behavior",
    sql(
        """SELECT g.*, v.PageUrl AS MostViewedPage FROM (
             SELECT UserId, date_trunc('hour', Timestamp) AS Hour, count(DISTINCT SessionId) AS SessionCount,
                    count(*) AS PageViews, CAST(floor(avg(DurationMs)) AS BIGINT) AS AvgSessionDuration,
                    round(avg(CAST(IsBounce AS INTEGER)) * 100.0::DOUBLE, 6) AS BounceRate, max(PageUrl) AS TopPage
             FROM web GROUP BY 1, 2) g
           JOIN (SELECT UserId, Hour, PageUrl,
                        row_number() OVER (PARTITION BY UserId, Hour ORDER BY n DESC, PageUrl) AS rn
                 FROM (SELECT UserId, date_trunc('hour', Timestamp) AS Hour, PageUrl, count(*) AS n
                       FROM web GROUP BY 1, 2, 3)) v
             ON g.UserId = v.UserId AND g.Hour = v.Hour AND v.rn = 1""",
        "web",
    ),
)
def rt_user_behavior(spark, sf_dir):
    rows = events.user_behavior(events.clean_web(inputs.web_events(spark, sf_dir)))
    return _rounded(rows, BounceRate=6)


@query(
    "rt_merchant_rollup",
    sql(
        f"""SELECT MerchantId, Hour, sum(TransactionCount)::BIGINT AS TransactionCount,
                   round(sum(TotalRevenue), 4) AS TotalRevenue, sum(UniqueCustomers)::BIGINT AS UniqueCustomers,
                   avg(AvgTransactionValue) AS AvgTransactionValue, round(avg(FraudRate), 4) AS FraudRate
            FROM (SELECT * FROM ({_METRICS}) UNION ALL SELECT * FROM ({_METRICS})) GROUP BY 1, 2""",
        "txn",
    ),
)
def rt_merchant_rollup(spark, sf_dir):
    """Two ingestion batches with the same metric rows."""
    rows = events.merchant_metrics(transactions(spark, sf_dir))
    return _rounded(events.merchant_rollup(rows.unionByName(rows)), TotalRevenue=4, FraudRate=4)


@query(
    "rt_alert_fraud",
    sql(
        """SELECT MerchantId, time_bucket(INTERVAL '5 minutes', Timestamp) AS Timestamp, count(*) AS FraudCount,
                  CAST(sum(AmountUSD) AS DOUBLE) AS TotalFraudAmount
           FROM txn WHERE IsHighValue AND Status = 'Fraud' GROUP BY 1, 2 HAVING count(*) > 1""",
        "txn",
    ),
)
def rt_alert_fraud(spark, sf_dir):
    """With the count lowered to 1, as five-minute bins of these events are sparse."""
    return events.fraud_alert(transactions(spark, sf_dir), 1)


_HIGH = """SELECT TransactionId, UserId, MerchantId, CAST(AmountUSD AS DOUBLE) AS AmountUSD, Timestamp
           FROM txn WHERE AmountUSD > 10000"""


@query("rt_alert_high_value", sql(_HIGH, "txn"))
def rt_alert_high_value(spark, sf_dir):
    return events.high_value_alert(transactions(spark, sf_dir))


@query(
    "rt_alert_device",
    sql(
        """SELECT DeviceId, time_bucket(INTERVAL '5 minutes', Timestamp) AS Timestamp, count(*) AS AnomalyCount
           FROM iot WHERE IsAnomaly GROUP BY 1, 2 HAVING count(*) > 0""",
        "iot",
    ),
)
def rt_alert_device(spark, sf_dir):
    """With the count lowered to 0."""
    return events.device_alert(devices(spark, sf_dir), 0)


@query(
    "rt_alert_pipeline_failure",
    sql(
        """SELECT WindowStart, count(*) AS Failures
           FROM (SELECT time_bucket(INTERVAL '5 minutes', StartTime) - to_minutes(5 * i) AS WindowStart
                 FROM pipeline_runs, (VALUES (0), (1), (2)) AS s(i) WHERE Status = 'FAILED')
           GROUP BY 1""",
        "pipeline_runs",
    ),
)
def rt_alert_pipeline_failure(spark, sf_dir):
    return events.pipeline_failure_alert(inputs.pipeline_runs(spark, sf_dir))


@query("rt_upsert_rollup", sql(_SUMMARY, "txn"))
def rt_upsert_rollup(spark, sf_dir):
    """The hourly rollup kept by a stream in update mode; the table holds every window."""
    rows = inputs.transactions(spark, sf_dir, inputs.stream(spark, sf_dir, "events"))
    rollup = events.transaction_summary(events.clean_transactions(rows))
    layout, keys = bronze(scratch(spark, "lake"), "TransactionsSummary"), ["MerchantId", "Timestamp"]
    tables.upsert_table(rollup, layout, scratch(spark, "checkpoint")).awaitTermination()
    return tables.read_upserted(spark, layout, keys)


# The rollups and windowed alerts once more as streams: the events come in five batches without order, and the tables
# must end up as the batch results. A batch is as many files as tasks run at once, as a small file is read by one task.


def _scattered(spark, sf_dir):
    path, files = scratch(spark, "events"), spark.sparkContext.defaultParallelism
    rows = inputs.table(spark, sf_dir, "events")
    rows.repartition(5 * files, "event_id").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _kept(spark, sf_dir, make, clean, rollup, keys, window, **how):
    base = scratch(spark, "lake")
    rows = clean(make(spark, sf_dir, _scattered(spark, sf_dir)))
    target = bronze(base, "rollup")
    tables.rollup_table(rows, bronze(base, "cleaned"), target, rollup, keys, window, scratch(spark, "checkpoint"), **how).awaitTermination()
    return tables.read_upserted(spark, target, keys)


@query("rt_txn_summary_stream", ORACLES["rt_txn_summary"])
def rt_txn_summary_stream(spark, sf_dir):
    keys = ["MerchantId", "Timestamp"]
    return _kept(spark, sf_dir, inputs.transactions, events.clean_transactions, events.transaction_summary, keys, "Timestamp")


@query("rt_iot_summary_stream", ORACLES["rt_iot_summary"])
def rt_iot_summary_stream(spark, sf_dir):
    keys = ["DeviceId", "Timestamp"]
    rows = _kept(spark, sf_dir, inputs.readings, events.clean_iot, events.device_summary, keys, "Timestamp", width="5 minutes")
    return _rounded(rows, AvgTemperature=6)


@query("rt_merchant_metrics_stream", ORACLES["rt_merchant_metrics"])
def rt_merchant_metrics_stream(spark, sf_dir):
    keys = ["MerchantId", "Hour"]
    rows = _kept(spark, sf_dir, inputs.transactions, events.clean_transactions, events.merchant_metrics, keys, "Hour")
    return _rounded(rows, FraudRate=6)


@query("rt_user_behavior_stream", ORACLES["rt_user_behavior"])
def rt_user_behavior_stream(spark, sf_dir):
    keys = ["UserId", "Hour"]
    rows = _kept(spark, sf_dir, inputs.web_events, events.clean_web, events.user_behavior, keys, "Hour", touched=events.user_hours)
    return _rounded(rows, BounceRate=6)


@query("rt_alert_fraud_stream", ORACLES["rt_alert_fraud"])
def rt_alert_fraud_stream(spark, sf_dir):
    return _kept(
        spark, sf_dir, inputs.transactions, events.clean_transactions, lambda r: events.fraud_alert(r, 1),
        ["MerchantId", "Timestamp"], "Timestamp", width="5 minutes", touched=lambda r: events.fraud_alert(r, 0),
    )


@query("rt_alert_device_stream", ORACLES["rt_alert_device"])
def rt_alert_device_stream(spark, sf_dir):
    return _kept(
        spark, sf_dir, inputs.readings, events.clean_iot, lambda r: events.device_alert(r, 0),
        ["DeviceId", "Timestamp"], "Timestamp", width="5 minutes",
    )
