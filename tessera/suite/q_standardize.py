"""Projections, filters and value clean-up."""

from pyspark.sql import functions as F

from tessera.layout import read_table, silver
from tessera.operators import sinks, standardize
from tessera.session import scratch
from tessera.streaming import events
from tessera.suite import inputs
from tessera.suite.inputs import sql, table
from tessera.suite.registry import query


@query("std_case", "SELECT c_custkey, upper(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer")
def std_case(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows = standardize.case(rows, "c_name", "upper")
    return standardize.case(standardize.case(rows, "c_mktsegment"), "c_name", "other")


@query("std_trim", "SELECT doc_id, trim(text, ' ') AS text FROM documents")
def std_trim(spark, sf_dir):
    padded = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("  "), "text", F.lit("   ")).alias("text")
    )
    return standardize.trim(padded, "text")


@query("std_phone", sql("SELECT CustomerID, regexp_replace(Phone, '[^0-9]', '', 'g') AS Phone FROM customers", "customers"))
def std_phone(spark, sf_dir):
    return standardize.phone(inputs.customers(spark, sf_dir).select("CustomerID", "Phone"), "Phone")


def _date_text(spark, sf_dir):
    """Order dates as text; every ninth is no date."""
    text = F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))


@query("std_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS day FROM orders")
def std_date(spark, sf_dir):
    return standardize.date(_date_text(spark, sf_dir), "day")


@query("std_timestamp", "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN date_trunc('second', ts) END AS at FROM events")
def std_timestamp(spark, sf_dir):
    text = F.when(F.col("event_id") % 9 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("at"))
    return standardize.timestamp(rows, "at")


@query(
    "std_apply",
    sql(
        """SELECT CustomerID, lower(CustomerName) AS CustomerName, upper(Email) AS Email,
                  regexp_replace(Phone, '[^0-9]', '', 'g') AS Phone, Segment FROM customers""",
        "customers",
    ),
)
def std_apply(spark, sf_dir):
    rows = inputs.customers(spark, sf_dir).select("CustomerID", "CustomerName", "Email", "Phone", "Segment")
    kinds = {"CustomerName": "lower", "Email": "upper", "Phone": "phone", "Segment": "trim", "Missing": "lower"}
    return standardize.apply(rows, kinds)


@query("std_null_defaults", sql("SELECT CustomerID, coalesce(NationKey, -1) AS NationKey FROM customers", "customers"))
def std_null_defaults(spark, sf_dir):
    rows = inputs.customers(spark, sf_dir).select("CustomerID", "NationKey")
    return standardize.null_defaults(rows, {"NationKey": -1, "Missing": "x"})


@query(
    "std_safe_cast",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id END AS as_int, value AS as_double,
              date_trunc('day', ts)::TIMESTAMP AS as_date FROM events""",
    with_nulls=("as_int",),
)
def std_safe_cast(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type")).alias("as_int"),
        F.col("value").cast("string").alias("as_double"),
        F.date_format("ts", "yyyy-MM-dd").alias("as_date"),
    )
    for column, target in (("as_int", "int"), ("as_double", "double"), ("as_date", "date")):
        rows = standardize.safe_cast(rows, column, target)
    return rows


@query(
    "std_replace_values",
    "SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Unknown' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END AS c_mktsegment FROM customer",
)
def std_replace_values(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return standardize.replace_values(rows, "c_mktsegment", {"HOUSEHOLD": "Unknown", "MACHINERY": "M"})


@query("std_change_type", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey FROM orders")
def std_change_type(spark, sf_dir):
    return standardize.change_type(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")


@query("std_after_delimiter", sql("SELECT CustomerID, Email, split_part(Email, '@', 2) AS EmailDomain FROM customers", "customers"))
def std_after_delimiter(spark, sf_dir):
    rows = inputs.customers(spark, sf_dir).select("CustomerID", "Email")
    return standardize.after_delimiter(rows, "Email", "@", "EmailDomain")


@query(
    "std_flow_clean_names",
    sql(
        """SELECT CustomerID, CASE CustomerID % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Unknown'
                       ELSE CustomerName END AS CustomerName,
                  Email, split_part(Email, '@', 2) AS EmailDomain
           FROM customers""",
        "customers",
    ),
)
def std_flow_clean_names(spark, sf_dir):
    turn = F.col("CustomerID") % 4
    name = F.when(turn == 0, "NULL").when(turn == 1, "").otherwise(F.concat(F.lit(" "), "CustomerName", F.lit(" ")))
    rows = inputs.customers(spark, sf_dir).select("CustomerID", name.alias("CustomerName"), "Email")
    layout = silver(scratch(spark, "lake"), "customers_dataflow")
    sinks.overwrite(standardize.clean_names(rows), layout)
    return read_table(spark, layout)


@query(
    "json_flatten",
    "SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_flatten(spark, sf_dir):
    return standardize.json_flatten(table(spark, sf_dir, "events").select("event_id", "props"), "props")


@query(
    "expr_calculated_columns",
    sql(
        """SELECT OrderID, LineNumber::BIGINT AS LineNumber, PartID, UnitPrice * Quantity - Discount AS OrderTotal,
                  UnitPrice * Quantity AS Gross FROM order_lines""",
        "order_lines",
    ),
)
def expr_calculated_columns(spark, sf_dir):
    computed = {"OrderTotal": "UnitPrice * Quantity - Discount", "Gross": "UnitPrice * Quantity"}
    rows = standardize.calculated_columns(inputs.order_lines(spark, sf_dir), computed)
    return rows.select("OrderID", "LineNumber", "PartID", "OrderTotal", "Gross")


@query(
    "expr_date_parts",
    """SELECT o_orderkey, o_orderdate, year(o_orderdate)::BIGINT AS o_orderdateYear, month(o_orderdate)::BIGINT AS o_orderdateMonth,
              day(o_orderdate)::BIGINT AS o_orderdateDay, quarter(o_orderdate)::BIGINT AS o_orderdateQuarter FROM orders""",
)
def expr_date_parts(spark, sf_dir):
    return standardize.date_parts(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


@query("filter_current", sql("SELECT PartID, PartName, IsCurrent FROM parts WHERE IsCurrent", "parts"))
def filter_current(spark, sf_dir):
    return standardize.current_rows(inputs.parts(spark, sf_dir)).select("PartID", "PartName", "IsCurrent")


@query(
    "filter_valid_orders",
    sql("SELECT OrderID, PartID, UnitPrice, Quantity - 10 AS Quantity FROM order_lines WHERE Quantity - 10 > 0 AND UnitPrice > 0", "order_lines"),
)
def filter_valid_orders(spark, sf_dir):
    lines = inputs.order_lines(spark, sf_dir).withColumn("Quantity", F.col("Quantity") - 10)
    valid = standardize.keep_where(lines, "Quantity > 0 AND UnitPrice > 0")
    return valid.select("OrderID", "PartID", "UnitPrice", "Quantity")


@query(
    "map_rename_iot",
    sql("SELECT DeviceId, Temperature, Humidity, Timestamp FROM iot_raw", "iot_raw"),
)
def map_rename_iot(spark, sf_dir):
    names = {"deviceId": "DeviceId", "temperature": "Temperature", "humidity": "Humidity", "timestamp": "Timestamp"}
    raw = inputs.readings(spark, sf_dir).withColumnsRenamed({v: k for k, v in names.items()})
    return standardize.rename(raw, names)


@query(
    "iot_clean",
    sql("SELECT DeviceId, Timestamp, Temperature, TemperatureCelsius, IsAnomaly FROM iot", "iot"),
)
def iot_clean(spark, sf_dir):
    rows = events.clean_iot(inputs.readings(spark, sf_dir))
    return rows.select("DeviceId", "Timestamp", "Temperature", "TemperatureCelsius", "IsAnomaly")


@query("web_clean", sql("SELECT EventId, Timestamp, PageUrl, DurationMs, HourOfDay, IsBounce FROM web", "web"))
def web_clean(spark, sf_dir):
    rows = events.clean_web(inputs.web_events(spark, sf_dir))
    return rows.select("EventId", "Timestamp", "PageUrl", "DurationMs", "HourOfDay", "IsBounce")


@query(
    "txn_clean",
    sql("SELECT TransactionId, Currency, CAST(Amount AS DOUBLE) AS Amount, CAST(AmountUSD AS DOUBLE) AS AmountUSD, IsHighValue FROM txn", "txn"),
)
def txn_clean(spark, sf_dir):
    rows = events.clean_transactions(inputs.transactions(spark, sf_dir))
    return rows.select("TransactionId", "Currency", "Amount", "AmountUSD", "IsHighValue")


@query(
    "filter_recent",
    """SELECT '15 minutes' AS span, event_id FROM events WHERE ts > TIMESTAMP '2024-01-28 23:45:00'
       UNION ALL SELECT '1 hour', event_id FROM events WHERE ts > TIMESTAMP '2024-01-28 23:00:00'
       UNION ALL SELECT '24 hours', event_id FROM events WHERE ts > TIMESTAMP '2024-01-28 00:00:00'
       UNION ALL SELECT '7 days', event_id FROM events WHERE ts > TIMESTAMP '2024-01-22 00:00:00'""",
)
def filter_recent(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    parts = [
        standardize.recent(rows, "ts", span, inputs.EVENT_AS_OF).select(F.lit(span).alias("span"), "event_id")
        for span in ("15 minutes", "1 hour", "24 hours", "7 days")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("project_columns", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def project_columns(spark, sf_dir):
    return standardize.project(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_extendedprice"])


@query("secure_rows", sql("SELECT OrderID, CustomerID, OrderDate, OrderTotal, Status FROM sales WHERE Status = 'Completed'", "sales"))
def secure_rows(spark, sf_dir):
    return standardize.secure_rows(inputs.orders(spark, sf_dir), "Status = 'Completed'")


@query("secure_columns", sql("SELECT CustomerID, CustomerName, NationKey, Balance, Segment FROM customers", "customers"), with_nulls=("NationKey",))
def secure_columns(spark, sf_dir):
    return standardize.secure_columns(inputs.customers(spark, sf_dir), ["Email", "Phone"])
