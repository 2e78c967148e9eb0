"""Inputs the queries need beyond the given tables, all derived from those by fixed rules.

Each input exists twice, as a DataFrame and as SQL text, so that a query and its comparison start
from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.layout import is_directory

# Run times used by the queries: one inside the order dates, one inside the event times.
AS_OF = "2001-07-15 00:00:00"
EVENT_AS_OF = "2024-01-29 00:00:00"
LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with shuffles sized for it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _seconds(column: str, modulus: int):
    return F.make_dt_interval(secs=F.col(column) % modulus)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with some null nations and malformed e-mail addresses."""
    mail = F.concat(F.lower("c_name"), F.lit("@example.org"))
    bad = F.col("c_custkey") % 11 == 0
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.when(bad, mail).otherwise(F.regexp_replace(mail, "#", "")).alias("Email"),
        F.concat(F.lit("+("), F.col("c_nationkey"), F.lit(") 555-"), F.col("c_custkey")).alias("Phone"),
        F.nullif("c_nationkey", F.lit(0)).cast("long").alias("NationKey"),
        F.col("c_acctbal").alias("Balance"),
        F.col("c_mktsegment").alias("Segment"),
    )


def customers_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a first load, and every tenth again from a second load with another segment."""
    first = customers(spark, sf_dir)
    again = first.where("CustomerID % 10 = 0").withColumn("Segment", F.lit("RELOADED"))

    def loaded(df: DataFrame, at: str) -> DataFrame:
        return df.withColumn("_bronze_ingestion_timestamp", F.lit(at).cast("timestamp_ntz"))

    return loaded(first, LOAD_1).unionByName(loaded(again, LOAD_2))


def customers_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery: changed and nulled segments, new keys, unchanged rows; some keys absent."""
    first = customers(spark, sf_dir).where("CustomerID % 17 <> 3")
    segment = (
        F.when(F.col("CustomerID") % 7 == 0, "CHANGED")
        .when(F.col("CustomerID") % 23 == 1, F.lit(None))
        .otherwise(F.col("Segment"))
    )
    new = customers(spark, sf_dir).where("CustomerID % 50 = 5").withColumn("CustomerID", -F.col("CustomerID"))
    return first.withColumn("Segment", segment).unionByName(new)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "Completed").when(
        F.col("o_orderstatus") == "O", "Open"
    ).otherwise("Pending")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("o_totalprice").alias("OrderTotal"),
        status.alias("Status"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_partkey").alias("PartID"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
        F.col("l_shipdate").alias("ShipDate"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PartID"),
        F.col("p_name").alias("PartName"),
        F.col("p_brand").alias("Brand"),
        F.col("p_size").alias("Size"),
        (F.col("p_partkey") % 10 != 0).alias("IsCurrent"),
    )


def few_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without every thirteenth, so some orders have no customer."""
    return table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0")


def transactions(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if rows is None else rows
    return events.select(
        F.col("event_id").cast("string").alias("TransactionId"),
        F.col("ts").alias("Timestamp"),
        F.col("user_id").cast("string").alias("UserId"),
        (F.col("value") * 100).cast("decimal(18,4)").alias("Amount"),
        F.when(F.col("event_id") % 5 == 0, "EUR").otherwise("USD").alias("Currency"),
        F.concat(F.lit("M"), F.col("user_id") % 20).alias("MerchantId"),
        F.when(F.col("event_type") == "error", "Fraud").otherwise("Completed").alias("Status"),
    )


def web_events(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if rows is None else rows
    page = F.concat(F.lit("/"), "event_type", F.lit("/"), F.get_json_object("props", "$.k"))
    session = F.concat(F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"))
    return events.select(
        F.col("event_id").cast("string").alias("EventId"),
        F.col("ts").alias("Timestamp"),
        F.col("user_id").cast("string").alias("UserId"),
        page.alias("PageUrl"),
        session.alias("SessionId"),
        F.col("event_type").alias("EventType"),
        F.round(F.col("value") * 100).cast("int").alias("DurationMs"),
    )


def readings(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if rows is None else rows
    return events.select(
        F.col("user_id").cast("string").alias("DeviceId"),
        F.col("ts").alias("Timestamp"),
        F.col("value").alias("Temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("Humidity"),
        F.concat(F.lit("L"), F.col("user_id") % 5).alias("Location"),
        F.lit("ok").alias("Status"),
    )


def _run_columns() -> dict:
    start = F.col("o_orderdate") + _seconds("o_orderkey", 86400)
    status = F.col("o_orderstatus")
    return {
        "Status": F.when(status == "F", "FAILED").when(status == "O", "SUCCEEDED").otherwise("RUNNING"),
        "StartTime": start,
        "EndTime": F.when(status != "P", start + _seconds("o_orderkey", 3600)),
        "ErrorMessage": F.when(status == "F", F.lit("failed")),
        "RowsRead": F.floor("o_totalprice"),
        "RowsWritten": F.floor("o_totalprice") - F.col("o_orderkey") % 10,
    }


def _runs(spark: SparkSession, sf_dir: str, columns: dict) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        *[c.alias(n) for n, c in {**columns, **_run_columns()}.items()]
    )


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(
        spark,
        sf_dir,
        {
            "RunId": F.concat(F.lit("r"), F.col("o_orderkey")),
            "PipelineName": F.col("o_orderpriority"),
        },
    )


def entity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(
        spark,
        sf_dir,
        {
            "EntityRunId": F.concat(F.lit("e"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")),
            "RunId": F.concat(F.lit("r"), F.col("o_orderkey") - F.col("o_orderkey") % 10),
            "EntityId": F.col("o_custkey"),
            "EntityName": F.concat(F.lit("entity "), F.col("o_custkey") % 40),
            "WatermarkAfter": F.date_format("o_orderdate", "yyyy-MM-dd"),
        },
    )


def gold_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(
        spark,
        sf_dir,
        {
            "GoldRunId": F.concat(F.lit("g"), F.col("o_orderkey")),
            "RunId": F.concat(F.lit("r"), F.col("o_orderkey") - F.col("o_orderkey") % 10),
            "ModelName": F.concat(F.lit("model "), F.col("o_custkey") % 8),
            "ModelType": F.when(F.col("o_custkey") % 2 == 0, "FACT").otherwise("DIMENSION"),
        },
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule rows with their settings in one text column, as configuration tables carry them."""
    number = F.col("p_partkey") % 5
    kinds = ("NOT_NULL", "RANGE", "REGEX", "REF_INTEGRITY", "UNIQUE")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (number + 1).cast("int"))
    expected = (
        F.when(number == 1, F.concat(F.col("p_size"), F.lit("|"), (F.col("p_size") + 10)))
        .when(number == 2, F.concat(F.lit("^"), F.col("p_type")))
        .when(number == 3, F.lit("customers.CustomerID"))
    )
    severities = F.array(F.lit("WARNING"), F.lit("ERROR"), F.lit("CRITICAL"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("RuleId"),
        F.col("p_size").alias("EntityId"),
        F.col("p_name").alias("RuleName"),
        kind.alias("RuleType"),
        F.col("p_brand").alias("ColumnName"),
        expected.alias("ExpectedValue"),
        F.lit(None).cast("decimal(18,4)").alias("MinValue"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit(1000).cast("decimal(18,4)")).alias("MaxValue"),
        F.lit(None).cast("string").alias("RegexPattern"),
        F.lit(None).cast("string").alias("RefTable"),
        F.lit(None).cast("string").alias("RefColumn"),
        F.element_at(severities, (F.col("p_partkey") % 3 + 1).cast("int")).alias("Severity"),
        (F.col("p_partkey") % 2 == 0).alias("QuarantineEnabled"),
        (F.col("p_partkey") % 7 != 0).alias("IsActive"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = (F.col("o_orderkey") % 1000).cast("decimal(9,2)") / F.lit(100)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("e"), F.col("o_orderkey")).alias("EntityRunId"),
        F.col("o_custkey").cast("int").alias("RuleId"),
        F.lit(1000).cast("long").alias("TotalRows"),
        (F.col("o_orderkey") % 1000).alias("FailedRows"),
        rate.cast("decimal(5,2)").alias("FailureRate"),
        (F.col("o_orderkey") % 1000 == 0).alias("Passed"),
        (F.col("o_orderdate") + _seconds("o_orderkey", 86400)).alias("EvaluatedTime"),
    )


def capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 3 == 0, "CapacityThrottling").otherwise("CapacityUtilization")
    return table(spark, sf_dir, "events").select(
        name.alias("MetricName"),
        F.col("ts").alias("TimeGenerated"),
        F.col("value").alias("CUConsumption"),
        F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(0.0).alias("Maximum"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end events of runs; some runs end twice, the second time without row counts."""
    runs = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", *[c.alias(n) for n, c in _run_columns().items()])
    run = F.concat(F.lit("r"), F.col("o_orderkey"))
    parent = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("p"), F.col("o_orderkey") % 4))
    mark = F.concat(F.lit("w"), F.col("o_orderkey"))

    def events(rows: DataFrame, kind: str, time, status, read, written, before, after, error) -> DataFrame:
        return rows.select(
            F.lit("pipeline").alias("RunKind"),
            run.alias("RunId"),
            parent.alias("ParentRunId"),
            F.col("o_orderpriority").alias("Name"),
            F.lit(kind).alias("EventType"),
            time.alias("EventTime"),
            status.alias("Status"),
            read.cast("long").alias("RowsRead"),
            written.cast("long").alias("RowsWritten"),
            F.lit(None).cast("long").alias("RowsRejected"),
            before.cast("string").alias("WatermarkBefore"),
            after.cast("string").alias("WatermarkAfter"),
            error.cast("string").alias("ErrorMessage"),
        )

    none = F.lit(None)
    starts = events(runs, "start", F.col("StartTime"), F.lit("RUNNING"), none, none, mark, none, none)
    ended = runs.where(F.col("EndTime").isNotNull())
    ends = events(
        ended, "end", F.col("EndTime"), F.col("Status"), F.col("RowsRead"), F.col("RowsWritten"),
        none, mark, F.col("ErrorMessage"),
    )
    again = events(
        ended.where("o_orderkey % 5 = 0"), "end", F.col("EndTime") + F.expr("INTERVAL 1 HOUR"),
        F.lit("CANCELLED"), none, none, none, none, F.lit("late"),
    )
    return starts.unionByName(ends).unionByName(again)


# The same inputs as SQL.
SQL = {
    "customers": """
        SELECT c_custkey AS CustomerID, c_name AS CustomerName,
               CASE WHEN c_custkey % 11 = 0 THEN lower(c_name) || '@example.org'
                    ELSE replace(lower(c_name) || '@example.org', '#', '') END AS Email,
               '+(' || c_nationkey || ') 555-' || c_custkey AS Phone,
               CAST(nullif(c_nationkey, 0) AS BIGINT) AS NationKey,
               c_acctbal AS Balance, c_mktsegment AS Segment
        FROM customer""",
    "customers_twice": """
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS _bronze_ingestion_timestamp FROM customers
        UNION ALL
        SELECT * REPLACE ('RELOADED' AS Segment), TIMESTAMP '2024-02-01 00:00:00'
        FROM customers WHERE CustomerID % 10 = 0""",
    "customers_next": """
        SELECT * REPLACE (CASE WHEN CustomerID % 7 = 0 THEN 'CHANGED'
                               WHEN CustomerID % 23 = 1 THEN NULL ELSE Segment END AS Segment)
        FROM customers WHERE CustomerID % 17 <> 3
        UNION ALL
        SELECT * REPLACE (-CustomerID AS CustomerID) FROM customers WHERE CustomerID % 50 = 5""",
    "sales": """
        SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, o_orderdate AS OrderDate,
               o_totalprice AS OrderTotal,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open'
                    ELSE 'Pending' END AS Status
        FROM orders""",
    "order_lines": """
        SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, l_partkey AS PartID,
               l_extendedprice AS UnitPrice, l_quantity AS Quantity, l_discount AS Discount,
               l_shipdate AS ShipDate
        FROM lineitem""",
    "parts": """
        SELECT p_partkey AS PartID, p_name AS PartName, p_brand AS Brand, p_size AS Size,
               p_partkey % 10 <> 0 AS IsCurrent
        FROM part""",
    "few_customers": "SELECT * FROM customer WHERE c_custkey % 13 <> 0",
    "txn_raw": """
        SELECT CAST(event_id AS VARCHAR) AS TransactionId, ts AS Timestamp,
               CAST(user_id AS VARCHAR) AS UserId, CAST(value * 100 AS DECIMAL(18,4)) AS Amount,
               CASE WHEN event_id % 5 = 0 THEN 'EUR' ELSE 'USD' END AS Currency,
               'M' || (user_id % 20) AS MerchantId,
               CASE WHEN event_type = 'error' THEN 'Fraud' ELSE 'Completed' END AS Status
        FROM events""",
    "txn": """
        SELECT *, AmountUSD > 1000 AS IsHighValue FROM (
            SELECT *, CAST(CASE WHEN Currency = 'USD' THEN Amount
                                ELSE Amount * 1.1 END AS DECIMAL(18,4)) AS AmountUSD
            FROM txn_raw)""",
    "web_raw": """
        SELECT CAST(event_id AS VARCHAR) AS EventId, ts AS Timestamp,
               CAST(user_id AS VARCHAR) AS UserId,
               '/' || event_type || '/' || json_extract_string(props, '$.k') AS PageUrl,
               user_id || '-' || strftime(ts, '%Y-%m-%d') AS SessionId,
               event_type AS EventType, CAST(round(value * 100) AS BIGINT) AS DurationMs
        FROM events""",
    "web": "SELECT *, CAST(hour(Timestamp) AS BIGINT) AS HourOfDay, DurationMs < 5000 AS IsBounce FROM web_raw",
    "iot_raw": """
        SELECT CAST(user_id AS VARCHAR) AS DeviceId, ts AS Timestamp, value AS Temperature,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS Humidity,
               'L' || (user_id % 5) AS Location, 'ok' AS Status
        FROM events""",
    "iot": """
        SELECT *, (Temperature - 32) * 5.0::DOUBLE / 9.0::DOUBLE AS TemperatureCelsius,
               Temperature > 100 OR Temperature < 0 AS IsAnomaly
        FROM iot_raw""",
    "runs": """
        SELECT *, CASE WHEN o_orderstatus <> 'P'
                       THEN StartTime + to_seconds(o_orderkey % 3600) END AS EndTime
        FROM (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, o_orderstatus,
                     CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCEEDED'
                          ELSE 'RUNNING' END AS Status,
                     o_orderdate + to_seconds(o_orderkey % 86400) AS StartTime,
                     CASE WHEN o_orderstatus = 'F' THEN 'failed' END AS ErrorMessage,
                     CAST(floor(o_totalprice) AS BIGINT) AS RowsRead,
                     CAST(floor(o_totalprice) AS BIGINT) - o_orderkey % 10 AS RowsWritten
              FROM orders)""",
    "pipeline_runs": """
        SELECT 'r' || o_orderkey AS RunId, o_orderpriority AS PipelineName, Status, StartTime, EndTime,
               ErrorMessage, RowsRead, RowsWritten,
               CAST(date_diff('second', StartTime, coalesce(EndTime, TIMESTAMP '2001-07-15 00:00:00'))
                    AS BIGINT) AS DurationSeconds
        FROM runs""",
    "entity_runs": """
        SELECT 'e' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS EntityRunId,
               'r' || (o_orderkey - o_orderkey % 10) AS RunId, o_custkey AS EntityId,
               'entity ' || (o_custkey % 40) AS EntityName,
               strftime(o_orderdate, '%Y-%m-%d') AS WatermarkAfter,
               Status, StartTime, EndTime, ErrorMessage, RowsRead, RowsWritten,
               CAST(date_diff('second', StartTime, coalesce(EndTime, TIMESTAMP '2001-07-15 00:00:00'))
                    AS BIGINT) AS DurationSeconds
        FROM runs""",
    "gold_runs": """
        SELECT 'g' || o_orderkey AS GoldRunId, 'r' || (o_orderkey - o_orderkey % 10) AS RunId,
               'model ' || (o_custkey % 8) AS ModelName,
               CASE WHEN o_custkey % 2 = 0 THEN 'FACT' ELSE 'DIMENSION' END AS ModelType,
               Status, StartTime, EndTime, ErrorMessage, RowsRead, RowsWritten,
               CAST(date_diff('second', StartTime, coalesce(EndTime, TIMESTAMP '2001-07-15 00:00:00'))
                    AS BIGINT) AS DurationSeconds
        FROM runs""",
    "rules": """
        SELECT p_partkey AS RuleId, CAST(p_size AS BIGINT) AS EntityId, p_name AS RuleName,
               CASE p_partkey % 5 WHEN 0 THEN 'NOT_NULL' WHEN 1 THEN 'RANGE' WHEN 2 THEN 'REGEX'
                    WHEN 3 THEN 'REF_INTEGRITY' ELSE 'UNIQUE' END AS RuleType,
               p_brand AS ColumnName,
               CASE p_partkey % 5 WHEN 1 THEN p_size || '|' || (p_size + 10) WHEN 2 THEN '^' || p_type
                    WHEN 3 THEN 'customers.CustomerID' END AS ExpectedValue,
               CAST(NULL AS DOUBLE) AS MinValue,
               CASE WHEN p_partkey % 2 = 0 THEN 1000.0::DOUBLE END AS MaxValue,
               CAST(NULL AS VARCHAR) AS RegexPattern, CAST(NULL AS VARCHAR) AS RefTable,
               CAST(NULL AS VARCHAR) AS RefColumn,
               CASE p_partkey % 3 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'ERROR' ELSE 'CRITICAL' END
                   AS Severity,
               p_partkey % 2 = 0 AS QuarantineEnabled, p_partkey % 7 <> 0 AS IsActive
        FROM part""",
    "results": """
        SELECT 'e' || o_orderkey AS EntityRunId, o_custkey AS RuleId, 1000 AS TotalRows,
               o_orderkey % 1000 AS FailedRows, (o_orderkey % 1000) / 100.0::DOUBLE AS FailureRate,
               o_orderkey % 1000 = 0 AS Passed,
               o_orderdate + to_seconds(o_orderkey % 86400) AS EvaluatedTime
        FROM orders""",
    "capacity": """
        SELECT CASE WHEN event_id % 3 = 0 THEN 'CapacityThrottling' ELSE 'CapacityUtilization' END
                   AS MetricName,
               ts AS TimeGenerated, value AS CUConsumption,
               CASE WHEN event_id % 2 = 0 THEN value ELSE 0.0::DOUBLE END AS Maximum
        FROM events""",
}

_NEEDS = {
    "customers_twice": ["customers"],
    "customers_next": ["customers"],
    "txn": ["txn_raw"],
    "web": ["web_raw"],
    "iot": ["iot_raw"],
    "pipeline_runs": ["runs"],
    "entity_runs": ["runs"],
    "gold_runs": ["runs"],
}


def sql(body: str, *names: str) -> str:
    """``body`` with the named inputs, and the inputs those need, as common table expressions."""
    ordered: list[str] = []
    for name in names:
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    parts = ", ".join(f"{n} AS ({SQL[n]})" for n in ordered)
    return f"WITH {parts} {body}" if parts else body
