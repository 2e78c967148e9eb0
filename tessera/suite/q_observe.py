"""Control tables, run history, dashboards and alerts."""

from pyspark.sql import functions as F

from tessera.operators import alerts, observe
from tessera.streaming import events
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import AS_OF, EVENT_AS_OF, sql, table
from tessera.suite.q_realtime import devices, transactions
from tessera.suite.registry import query


@query(
    "ctl_entities_to_process",
    sql(
        """SELECT c_custkey AS EntityId, c_name AS EntityName, n_name AS SourceName, 'SQL' AS SourceType,
                  'dbo' AS SourceSchema, 'bronze' AS TargetLakehouse, 'raw' AS TargetSchema, c_name AS TargetTableName,
                  'INCREMENTAL' AS LoadType, 'ModifiedDate' AS WatermarkColumn, 'DATETIME' AS WatermarkDataType,
                  coalesce(WatermarkAfter, '1900-01-01') AS LastWatermark, n_name AS ConnectionStringRef,
                  NULL::VARCHAR AS SourceFilterClause, 'ManagedIdentity' AS AuthenticationType,
                  2::BIGINT AS ParallelismDegree, (c_custkey % 3)::BIGINT AS Priority
           FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (
               SELECT EntityId, WatermarkAfter,
                      row_number() OVER (PARTITION BY EntityId ORDER BY EndTime DESC, EntityRunId DESC) AS rn
               FROM entity_runs WHERE Status = 'SUCCEEDED') ON EntityId = c_custkey AND rn = 1
           WHERE c_custkey % 5 <> 0 AND n_nationkey <> 3""",
        "entity_runs",
    ),
)
def ctl_entities_to_process(spark, sf_dir):
    text = {
        "EntityType": "TABLE",
        "SourceSchema": "dbo",
        "TargetLakehouse": "bronze",
        "TargetSchema": "raw",
        "LoadType": "INCREMENTAL",
        "WatermarkColumn": "ModifiedDate",
        "WatermarkDataType": "DATETIME",
        "WatermarkOffset": "1900-01-01",
    }
    entities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("EntityId"),
        F.col("c_nationkey").alias("SourceId"),
        F.col("c_name").alias("EntityName"),
        F.col("c_name").alias("TargetTableName"),
        *[F.lit(v).alias(k) for k, v in text.items()],
        F.lit(None).cast("string").alias("SourceFilterClause"),
        F.lit(2).alias("ParallelismDegree"),
        (F.col("c_custkey") % 3).alias("Priority"),
        (F.col("c_custkey") % 5 != 0).alias("IsActive"),
    )
    sources = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("SourceId"),
        F.col("n_name").alias("SourceName"),
        F.lit("SQL").alias("SourceType"),
        F.col("n_name").alias("ConnectionStringRef"),
        F.lit("ManagedIdentity").alias("AuthenticationType"),
        (F.col("n_nationkey") != 3).alias("IsActive"),
    )
    return observe.entities_to_process(entities, sources, inputs.entity_runs(spark, sf_dir))


@query(
    "ctl_run_fold",
    sql(
        """SELECT 'pipeline' AS RunKind, 'r' || o_orderkey AS RunId,
                  CASE WHEN o_orderkey % 4 <> 0 THEN 'p' || (o_orderkey % 4) END AS ParentRunId,
                  o_orderpriority AS Name, StartTime,
                  CASE WHEN o_orderkey % 5 = 0 THEN EndTime + INTERVAL 1 HOUR ELSE EndTime END AS EndTime,
                  CASE WHEN o_orderkey % 5 = 0 AND EndTime IS NOT NULL THEN 'late' ELSE ErrorMessage END AS ErrorMessage,
                  CASE WHEN EndTime IS NOT NULL THEN RowsRead END AS RowsRead,
                  CASE WHEN EndTime IS NOT NULL THEN RowsWritten END AS RowsWritten,
                  NULL::BIGINT AS RowsRejected, 'w' || o_orderkey AS WatermarkBefore,
                  CASE WHEN EndTime IS NOT NULL AND o_orderkey % 5 <> 0 THEN 'w' || o_orderkey END AS WatermarkAfter,
                  CASE WHEN EndTime IS NOT NULL AND o_orderkey % 5 = 0 THEN 'CANCELLED' ELSE Status END AS Status
           FROM runs""",
        "runs",
    ),
    with_nulls=("RowsRead", "RowsWritten", "RowsRejected"),
)
def ctl_run_fold(spark, sf_dir):
    return observe.fold_runs(inputs.run_events(spark, sf_dir))


@query(
    "ctl_pipeline_summary",
    sql("SELECT RunId, PipelineName, Status, StartTime, EndTime, DurationSeconds, RowsRead, RowsWritten, ErrorMessage FROM pipeline_runs", "pipeline_runs"),
)
def ctl_pipeline_summary(spark, sf_dir):
    return observe.pipeline_summary(inputs.pipeline_runs(spark, sf_dir), AS_OF)


@query(
    "ctl_gold_summary",
    sql("SELECT GoldRunId, RunId, ModelName, ModelType, Status, StartTime, EndTime, DurationSeconds, RowsRead, RowsWritten, ErrorMessage FROM gold_runs", "gold_runs"),
)
def ctl_gold_summary(spark, sf_dir):
    return observe.gold_summary(inputs.gold_runs(spark, sf_dir), AS_OF)


_DAY = "StartTime > TIMESTAMP '2001-07-14 00:00:00'"
_OK = "count(*) FILTER (Status = 'SUCCEEDED') * 100.0::DOUBLE / count(*)"


def _round(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    "obs_pipeline_runs_24h",
    sql(
        f"""SELECT PipelineName, count(*) AS TotalRuns, count(*) FILTER (Status = 'SUCCEEDED') AS Successful,
                   count(*) FILTER (Status = 'FAILED') AS Failed, round({_OK}, 6) AS SuccessRate,
                   round(avg(DurationSeconds), 6) AS AvgDuration
            FROM pipeline_runs WHERE {_DAY} GROUP BY PipelineName""",
        "pipeline_runs",
    ),
)
def obs_pipeline_runs_24h(spark, sf_dir):
    return _round(observe.pipeline_runs_24h(inputs.pipeline_runs(spark, sf_dir), AS_OF), "SuccessRate", "AvgDuration")


@query(
    "obs_entity_throughput",
    sql(
        f"""SELECT EntityName, sum(RowsRead)::BIGINT AS TotalRows, sum(RowsWritten)::BIGINT AS TotalWritten,
                   round(avg(DurationSeconds), 6) AS AvgDuration
            FROM entity_runs WHERE {_DAY} GROUP BY EntityName""",
        "entity_runs",
    ),
)
def obs_entity_throughput(spark, sf_dir):
    return _round(observe.entity_throughput(inputs.entity_runs(spark, sf_dir), AS_OF), "AvgDuration")


@query(
    "obs_gold_build_times",
    sql(
        f"""SELECT ModelName, round(avg(DurationSeconds), 6) AS AvgBuildTime, max(DurationSeconds) AS MaxBuildTime,
                   round({_OK}, 6) AS SuccessRate
            FROM gold_runs WHERE StartTime > TIMESTAMP '2001-07-08 00:00:00' GROUP BY ModelName""",
        "gold_runs",
    ),
)
def obs_gold_build_times(spark, sf_dir):
    return _round(observe.gold_build_times(inputs.gold_runs(spark, sf_dir), AS_OF), "AvgBuildTime", "SuccessRate")


@query(
    "obs_dq_trend",
    sql(
        """SELECT EntityId, date_trunc('day', EvaluatedTime) AS Day, round(avg(FailureRate), 4) AS AvgFailureRate,
                  count(*) FILTER (Severity = 'CRITICAL' AND NOT Passed) AS CriticalFailures
           FROM results JOIN rules USING (RuleId) WHERE EvaluatedTime > TIMESTAMP '2001-07-08 00:00:00'
           GROUP BY 1, 2""",
        "results",
        "rules",
    ),
)
def obs_dq_trend(spark, sf_dir):
    trend = observe.quality_trend(inputs.results(spark, sf_dir), inputs.rules(spark, sf_dir), AS_OF)
    return _round(trend, "AvgFailureRate", places=4)


@query(
    "obs_throttling",
    sql(
        """SELECT date_trunc('hour', TimeGenerated) AS Hour, count(*) AS ThrottleEvents FROM capacity
           WHERE MetricName = 'CapacityThrottling' AND Maximum > 0 GROUP BY 1""",
        "capacity",
    ),
)
def obs_throttling(spark, sf_dir):
    return observe.throttling(inputs.capacity(spark, sf_dir))


@query(
    "obs_drift_log",
    f"""SELECT o_custkey AS EntityId, o_orderstatus AS DriftType, 'a,b' || o_orderkey AS AddedColumns,
               '' AS RemovedColumns, o_orderdate + to_seconds(o_orderkey % 86400) AS DetectedTime
        FROM orders WHERE o_orderdate + to_seconds(o_orderkey % 86400) > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR""",
)
def obs_drift_log(spark, sf_dir):
    log = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("EntityId"),
        F.col("o_orderstatus").alias("DriftType"),
        F.array(F.lit("a"), F.concat(F.lit("b"), F.col("o_orderkey"))).alias("AddedColumns"),
        F.array().cast("array<string>").alias("RemovedColumns"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)).alias("DetectedTime"),
    )
    return observe.drift_log_24h(log, AS_OF)


@query(
    "obs_quarantine_hourly",
    sql(
        f"""SELECT PipelineName AS SourceTable, date_trunc('hour', StartTime) AS Hour, count(*) AS QuarantinedCount
            FROM pipeline_runs WHERE {_DAY} GROUP BY 1, 2""",
        "pipeline_runs",
    ),
)
def obs_quarantine_hourly(spark, sf_dir):
    rows = inputs.pipeline_runs(spark, sf_dir).select(
        F.col("PipelineName").alias("SourceTable"), F.col("StartTime").alias("QuarantineTime")
    )
    return observe.quarantine_hourly(rows, AS_OF)


@query("obs_success_rate_24h", sql(f"SELECT round({_OK}, 2) AS SuccessRate FROM pipeline_runs WHERE {_DAY}", "pipeline_runs"))
def obs_success_rate_24h(spark, sf_dir):
    return observe.success_rate_24h(inputs.pipeline_runs(spark, sf_dir), AS_OF)


@query(
    "obs_rows_last_hour",
    sql("SELECT sum(RowsRead)::BIGINT AS TotalRows FROM pipeline_runs WHERE StartTime > TIMESTAMP '2001-07-14 23:00:00'", "pipeline_runs"),
)
def obs_rows_last_hour(spark, sf_dir):
    return observe.rows_last_hour(inputs.pipeline_runs(spark, sf_dir), AS_OF)


@query(
    "obs_capacity_hourly",
    sql(
        """SELECT date_trunc('hour', TimeGenerated) AS Hour, round(avg(CUConsumption), 6) AS AvgCU,
                  max(CUConsumption) AS MaxCU
           FROM capacity WHERE TimeGenerated > TIMESTAMP '2024-01-28 00:00:00' GROUP BY 1""",
        "capacity",
    ),
)
def obs_capacity_hourly(spark, sf_dir):
    return _round(observe.capacity_hourly(inputs.capacity(spark, sf_dir), EVENT_AS_OF), "AvgCU")


@query(
    "obs_quality_score",
    sql(
        """SELECT RuleName, round(s / (100.0::DOUBLE * n), 4) AS AvgFailureRate,
                  ((2 * (10000 * n - s) + n) // (2 * n))::DOUBLE / 100 AS QualityScore
           FROM (SELECT RuleName, sum(FailedRows) AS s, count(*) AS n
                 FROM results JOIN rules USING (RuleId) WHERE EvaluatedTime > TIMESTAMP '2001-07-14 00:00:00' GROUP BY RuleName)""",
        "results",
        "rules",
    ),
)
def obs_quality_score(spark, sf_dir):
    score = observe.quality_score(inputs.results(spark, sf_dir), inputs.rules(spark, sf_dir), AS_OF)
    return score.withColumn("AvgFailureRate", F.round(F.col("AvgFailureRate").cast("double"), 4))


@query(
    "obs_active_alerts",
    """SELECT event_type AS Severity, count(*) AS "Count" FROM events WHERE user_id % 3 = 0 GROUP BY event_type""",
)
def obs_active_alerts(spark, sf_dir):
    raised = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("Severity"),
        F.when(F.col("user_id") % 3 == 0, "Active").otherwise("Resolved").alias("Status"),
    )
    return observe.active_alerts(raised)


@query(
    "obs_sales_5min",
    sql(
        """SELECT time_bucket(INTERVAL '5 minutes', Timestamp) AS Bin, CAST(sum(AmountUSD) AS DOUBLE) AS Revenue
           FROM txn WHERE Timestamp > TIMESTAMP '2024-01-28 23:00:00' GROUP BY 1""",
        "txn",
    ),
)
def obs_sales_5min(spark, sf_dir):
    return observe.sales_5min(transactions(spark, sf_dir), EVENT_AS_OF)


@query(
    "obs_success_rate_hourly",
    sql(f"SELECT date_trunc('hour', StartTime) AS Hour, round({_OK}, 6) AS SuccessRate FROM pipeline_runs GROUP BY 1", "pipeline_runs"),
)
def obs_success_rate_hourly(spark, sf_dir):
    return _round(observe.success_rate_hourly(inputs.pipeline_runs(spark, sf_dir)), "SuccessRate")


@query(
    "obs_top_failing",
    sql(
        """SELECT EntityName, count(*) AS FailureCount FROM entity_runs WHERE Status = 'FAILED'
           GROUP BY EntityName ORDER BY 2 DESC, 1 LIMIT 10""",
        "entity_runs",
    ),
)
def obs_top_failing(spark, sf_dir):
    return observe.top_failing(inputs.entity_runs(spark, sf_dir))


@query(
    "obs_capacity_5min",
    sql(
        """SELECT time_bucket(INTERVAL '5 minutes', TimeGenerated) AS Bin, round(avg(Maximum), 6) AS AvgCU FROM capacity
           WHERE MetricName = 'CapacityUtilization' GROUP BY 1""",
        "capacity",
    ),
)
def obs_capacity_5min(spark, sf_dir):
    return _round(observe.capacity_5min(inputs.capacity(spark, sf_dir)), "AvgCU")


@query(
    "obs_kpi_thresholds",
    sql(
        f"""WITH k AS (
              SELECT 'Pipeline Success Rate' AS metric, {_OK} AS value, 99 AS target, 95 AS lim, TRUE AS more
              FROM pipeline_runs WHERE {_DAY}
              UNION ALL SELECT 'Avg Pipeline Duration', avg(DurationSeconds) / 60.0::DOUBLE, 30, 60, FALSE
              FROM pipeline_runs WHERE {_DAY}
              UNION ALL SELECT 'Data Quality Score', 100 - avg(FailureRate), 98, 95, TRUE
              FROM results WHERE EvaluatedTime > TIMESTAMP '2001-07-14 00:00:00'
              UNION ALL SELECT 'Capacity Utilization', avg(Maximum), 80, 95, FALSE
              FROM capacity WHERE MetricName = 'CapacityUtilization' AND TimeGenerated > TIMESTAMP '2001-07-14 00:00:00'
              UNION ALL SELECT 'Failed Entities/Day', count(DISTINCT EntityName)::DOUBLE, 0, 5, FALSE
              FROM entity_runs WHERE Status = 'FAILED' AND {_DAY})
            SELECT metric, round(value, 4) AS value,
                   CASE WHEN more THEN value > target WHEN target = 0 THEN value <= 0 ELSE value < target END AS on_target,
                   CASE WHEN more THEN value < lim ELSE value > lim END AS alert
            FROM k""",
        "pipeline_runs",
        "entity_runs",
        "results",
        "capacity",
    ).replace("WITH k AS", ", k AS"),
)
def obs_kpi_thresholds(spark, sf_dir):
    values = observe.kpis(
        inputs.pipeline_runs(spark, sf_dir),
        inputs.entity_runs(spark, sf_dir),
        inputs.results(spark, sf_dir),
        inputs.capacity(spark, sf_dir),
        AS_OF,
    )
    return _round(observe.check_kpis(values), "value", places=4)


@query("alert_high_value", sql("SELECT TransactionId, CAST(AmountUSD AS DOUBLE) AS AmountUSD FROM txn WHERE AmountUSD > 10000", "txn"))
def alert_high_value(spark, sf_dir):
    return alerts.high_value(transactions(spark, sf_dir)).select("TransactionId", "AmountUSD")


@query("alert_fraud", sql("SELECT TransactionId, CAST(AmountUSD AS DOUBLE) AS AmountUSD FROM txn WHERE Status = 'Fraud' AND AmountUSD > 5000", "txn"))
def alert_fraud(spark, sf_dir):
    return alerts.fraud(transactions(spark, sf_dir)).select("TransactionId", "AmountUSD")


_ANOMALIES = """SELECT DeviceId, time_bucket(INTERVAL '5 minutes', Timestamp) AS Timestamp,
                       count(*) FILTER (IsAnomaly) AS AnomalyCount
                FROM iot GROUP BY 1, 2 HAVING count(*) FILTER (IsAnomaly) > 0"""


@query("alert_device", sql(_ANOMALIES, "iot"))
def alert_device(spark, sf_dir):
    """With the count lowered to 0."""
    found = alerts.device(events.device_summary(devices(spark, sf_dir)), 0)
    return found.select("DeviceId", "Timestamp", "AnomalyCount")


@query(
    "alert_pipeline_failed",
    sql("SELECT RunId, PipelineName, StartTime FROM pipeline_runs WHERE Status = 'FAILED' AND StartTime > TIMESTAMP '2001-07-14 23:45:00'", "pipeline_runs"),
)
def alert_pipeline_failed(spark, sf_dir):
    return alerts.pipeline_failed(inputs.pipeline_runs(spark, sf_dir), AS_OF).select("RunId", "PipelineName", "StartTime")


@query("alert_dq_drop", sql("SELECT EntityRunId, RuleId, FailureRate FROM results WHERE FailureRate > 5", "results"))
def alert_dq_drop(spark, sf_dir):
    return alerts.quality_drop(inputs.results(spark, sf_dir)).select("EntityRunId", "RuleId", "FailureRate")


@query("alert_throttling", sql("SELECT TimeGenerated, Maximum FROM capacity WHERE MetricName = 'CapacityUtilization' AND Maximum > 95", "capacity"))
def alert_throttling(spark, sf_dir):
    return alerts.capacity(inputs.capacity(spark, sf_dir)).select("TimeGenerated", "Maximum")


@query(
    "alert_feed",
    sql(
        f"""SELECT *, 'Active' AS Status FROM (SELECT 'High Value Transaction Alert' AS RuleName, 'High' AS Severity, TransactionId AS EntityKey,
                   Timestamp AS EventTime, CAST(AmountUSD AS DOUBLE) AS Value FROM txn WHERE AmountUSD > 10000
            UNION ALL SELECT 'Fraud Detection', 'Critical', TransactionId, Timestamp, CAST(AmountUSD AS DOUBLE)
                      FROM txn WHERE Status = 'Fraud' AND AmountUSD > 5000
            UNION ALL SELECT 'IoT Device Anomaly', 'Medium', DeviceId, Timestamp, AnomalyCount::DOUBLE FROM ({_ANOMALIES})
            UNION ALL SELECT 'Pipeline Failure', 'Critical', RunId, StartTime, 1.0::DOUBLE FROM pipeline_runs
                      WHERE Status = 'FAILED' AND StartTime > TIMESTAMP '2001-07-14 23:45:00'
            UNION ALL SELECT 'Data Quality Drop', 'High', CAST(RuleId AS VARCHAR), EvaluatedTime, FailureRate
                      FROM results WHERE FailureRate > 5
            UNION ALL SELECT 'Capacity Throttling', 'Warning', MetricName, TimeGenerated, Maximum FROM capacity
                      WHERE MetricName = 'CapacityUtilization' AND Maximum > 95)""",
        "txn",
        "iot",
        "pipeline_runs",
        "results",
        "capacity",
    ),
)
def alert_feed(spark, sf_dir):
    return alerts.feed(
        transactions(spark, sf_dir),
        events.device_summary(devices(spark, sf_dir)),
        inputs.pipeline_runs(spark, sf_dir),
        inputs.results(spark, sf_dir),
        inputs.capacity(spark, sf_dir),
        AS_OF,
        device_limit=0,
    )


_EPISODES = """SELECT * FROM (WITH f AS (SELECT DISTINCT MerchantId, date_trunc('hour', Timestamp) AS hr FROM txn WHERE AmountUSD > 400 AND Timestamp IS NOT NULL),
        e AS (SELECT *, hr - row_number() OVER (PARTITION BY MerchantId ORDER BY hr) * INTERVAL 1 HOUR AS island FROM f),
        l AS (SELECT date_trunc('hour', max(Timestamp)) AS last FROM txn),
        g AS (SELECT MerchantId, min(hr) AS OpenedAt, max(hr) AS LastAt, count(*) AS Evaluations FROM e GROUP BY MerchantId, island)
   SELECT g.*, CASE WHEN LastAt + INTERVAL 1 HOUR <= last THEN 'Closed' ELSE 'Open' END AS Status FROM g, l)"""


@query("alert_episodes", sql(_EPISODES, "txn"))
def alert_episodes(spark, sf_dir):
    """Hours in which a merchant had a large amount, as episodes: given in three parts without order, one of them twice."""
    rows = transactions(spark, sf_dir)
    last = rows.agg(F.date_trunc("hour", F.max("Timestamp")).cast("timestamp_ntz")).first()[0]
    met = rows.where("AmountUSD > 400").select("MerchantId", F.date_trunc("hour", "Timestamp").cast("timestamp_ntz").alias("At"))
    part = F.pmod(F.xxhash64("MerchantId", "At"), F.lit(3))
    known = None
    for number in (1, 0, 1, 2):
        path = scratch(spark, "episodes")
        alerts.episodes(met.where(part == number), ["MerchantId"], "At", "1 hour", last, known).write.parquet(path)
        known = spark.read.parquet(path)
    return known.drop("ClosedAt")
