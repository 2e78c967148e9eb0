"""Deduplication, key flags, type-2 history, silver transformations, joins."""

from pyspark.sql import functions as F

from tessera.config import Transformation
from tessera.layout import gold, read_table
from tessera.layout import silver as silver_layout
from tessera.operators import dedup, joins, keyed, scd, silver
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import LOAD_1, LOAD_2, sql, table
from tessera.suite.registry import ORACLES, query

KEYS, TRACKED = ["CustomerID"], ["Segment", "NationKey"]


@query(
    "dedup_latest",
    sql(
        """SELECT CustomerID, Segment, _bronze_ingestion_timestamp FROM (
             SELECT *, row_number() OVER (PARTITION BY CustomerID
                                          ORDER BY _bronze_ingestion_timestamp DESC) AS rn
             FROM customers_twice) WHERE rn = 1""",
        "customers_twice",
    ),
)
def dedup_latest(spark, sf_dir):
    rows = inputs.customers_twice(spark, sf_dir).select("CustomerID", "Segment", "_bronze_ingestion_timestamp")
    return dedup.latest(rows, ["CustomerID"], [F.col("_bronze_ingestion_timestamp").desc()])


# Orders in three deliveries: even keys, then odd ones with some of the even anew, then changes of every seventh.
DELIVERIES = """(SELECT o_orderkey, o_custkey, o_orderpriority,
                        CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 10 = 0 OR o_orderkey % 2 = 1 THEN 2 ELSE 1 END AS delivery,
                        CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1000 WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2
                             ELSE o_totalprice END AS o_totalprice FROM orders)"""


def deliveries(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    twice = F.when(key % 10 == 0, price * 2).otherwise(price)
    parts = [
        orders.where(key % 2 == 0),
        orders.where((key % 2 == 1) | (key % 10 == 0)).withColumn("o_totalprice", twice),
        orders.where(key % 7 == 0).withColumn("o_totalprice", price + 1000),
    ]
    return [rows.withColumn("delivery", F.lit(i)) for i, rows in enumerate(parts, 1)]


@query("dedup_latest_deliveries", f"SELECT o_orderkey, o_totalprice, delivery::BIGINT AS delivery FROM {DELIVERIES}")
def dedup_latest_deliveries(spark, sf_dir):
    """The latest row per key, kept over three deliveries by touched buckets; each delivery is merged twice."""
    latest = silver_layout(scratch(spark, "lake"), "orders")
    for rows in deliveries(spark, sf_dir):
        for _ in range(2):
            keyed.merge_latest(rows, latest, ["o_orderkey"], [F.col("delivery").desc()])
    return read_table(spark, latest).select("o_orderkey", "o_totalprice", "delivery")


@query(
    "gold_aggregate_deliveries",
    f"""SELECT o_orderpriority, round(sum(o_totalprice), 2) AS "Total", round(avg(o_totalprice), 4) AS "Mean", count(o_orderkey) AS "Orders",
               count(DISTINCT o_custkey) AS "Customers", min(o_totalprice) AS "Low", max(o_totalprice) AS "High"
        FROM {DELIVERIES} GROUP BY o_orderpriority""",
)
def gold_aggregate_deliveries(spark, sf_dir):
    """An aggregate that follows the latest rows: what a delivery replaces is taken out of the kept parts."""
    base = scratch(spark, "lake")
    latest, sums, values = silver_layout(base, "orders"), gold(base, "sums"), gold(base, "values")
    grain = ["o_orderpriority"]
    measures = {
        "Total": "SUM(o_totalprice)", "Mean": "AVG(o_totalprice)", "Orders": "COUNT(o_orderkey)",
        "Customers": "COUNT(DISTINCT o_custkey)", "Low": "MIN(o_totalprice)", "High": "MAX(o_totalprice)",
    }
    for number, rows in enumerate(deliveries(spark, sf_dir)):

        def follow(came, left, load=f"r{number}"):
            keyed.follow(came, left, sums, values, load, grain, measures)

        keyed.merge_latest(rows, latest, ["o_orderkey"], [F.col("delivery").desc()], on_change=follow)
    found = keyed.followed(spark, sums, values, grain, measures)
    return found.withColumns({"Total": F.round("Total", 2), "Mean": F.round("Mean", 4)})


@query(
    "fk_flag_silver",
    sql(
        """SELECT o_orderkey, o_custkey, o_orderpriority,
                  o_custkey IN (SELECT c_custkey FROM few_customers) AS _fk_valid_o_custkey,
                  o_orderpriority IS NOT NULL AS _fk_valid_o_orderpriority
           FROM orders""",
        "few_customers",
    ),
)
def fk_flag_silver(spark, sf_dir, large=False):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    keys = [
        {"column": "o_custkey", "ref_table": "customer", "ref_column": "c_custkey"},
        {"column": "o_orderpriority"},
        {"column": "missing", "ref_table": "customer"},
    ]
    return dedup.flag_keys(rows, keys, {"customer": inputs.few_customers(spark, sf_dir)}, large)


@query("fk_flag_silver_large", ORACLES["fk_flag_silver"])
def fk_flag_silver_large(spark, sf_dir):
    """With the plan that large reference tables get, heavy keys salted."""
    return fk_flag_silver(spark, sf_dir, True)


@query("fk_invalid_keys", sql("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM few_customers)", "few_customers"))
def fk_invalid_keys(spark, sf_dir):
    return dedup.invalid_keys(table(spark, sf_dir, "orders"), "o_custkey", inputs.few_customers(spark, sf_dir), "c_custkey")


@query("fk_valid_keys", sql("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM few_customers)", "few_customers"))
def fk_valid_keys(spark, sf_dir):
    return dedup.valid_keys(table(spark, sf_dir, "orders"), "o_custkey", inputs.few_customers(spark, sf_dir), "c_custkey")


_OPEN = "TIMESTAMP '9999-12-31 23:59:59.999'"
_FIRST = f"""SELECT CustomerID, Segment, NationKey, TIMESTAMP '{LOAD_1}' AS ValidFrom, {_OPEN} AS ValidTo,
                    TRUE AS IsCurrent FROM customers"""
_CHANGED = """SELECT n.CustomerID, n.Segment, n.NationKey
              FROM customers_next n LEFT JOIN customers c USING (CustomerID)
              WHERE c.CustomerID IS NULL OR n.Segment IS DISTINCT FROM c.Segment
                 OR n.NationKey IS DISTINCT FROM c.NationKey"""
_EXPIRED = f"""SELECT CustomerID, Segment, NationKey, ValidFrom,
                      CASE WHEN CustomerID IN (SELECT CustomerID FROM ({_CHANGED}))
                           THEN TIMESTAMP '{LOAD_2}' ELSE ValidTo END AS ValidTo,
                      CustomerID NOT IN (SELECT CustomerID FROM ({_CHANGED})) AS IsCurrent
               FROM ({_FIRST})"""


def _first(spark, sf_dir):
    rows = inputs.customers(spark, sf_dir).select("CustomerID", *TRACKED)
    return scd.apply(None, rows, KEYS, TRACKED, LOAD_1)


def _next(spark, sf_dir):
    return inputs.customers_next(spark, sf_dir).select("CustomerID", *TRACKED)


@query("scd2_initial", sql(_FIRST, "customers"), with_nulls=("NationKey",), as_text=("ValidTo",))
def scd2_initial(spark, sf_dir):
    return scd.initial(inputs.customers(spark, sf_dir).select("CustomerID", *TRACKED), LOAD_1)


@query("scd2_detect_changes", sql(_CHANGED, "customers_next"), with_nulls=("NationKey",))
def scd2_detect_changes(spark, sf_dir):
    return scd.detect_changes(_first(spark, sf_dir), _next(spark, sf_dir), KEYS, TRACKED)


@query("scd2_expire", sql(_EXPIRED, "customers_next"), with_nulls=("NationKey",), as_text=("ValidTo",))
def scd2_expire(spark, sf_dir):
    history = _first(spark, sf_dir)
    changed = scd.detect_changes(history, _next(spark, sf_dir), KEYS, TRACKED)
    return scd.expire(history, changed, KEYS, LOAD_2)


@query(
    "scd2_apply",
    sql(f"{_EXPIRED} UNION ALL SELECT *, TIMESTAMP '{LOAD_2}', {_OPEN}, TRUE FROM ({_CHANGED})", "customers_next"),
    with_nulls=("NationKey",), as_text=("ValidTo",),
)
def scd2_apply(spark, sf_dir):
    return scd.apply(_first(spark, sf_dir), _next(spark, sf_dir), KEYS, TRACKED, LOAD_2)


LOGIC = {
    "dedup_key": "CustomerID",
    "null_defaults": {"NationKey": -1},
    "standardize": {"Email": "lower", "Phone": "regex", "Segment": "lower"},
    "foreign_keys": [{"column": "NationKey", "ref_table": "nation", "ref_column": "n_nationkey"}],
}
_STANDARD = f"""
    SELECT CustomerID, CustomerName, lower(Email) AS Email, regexp_replace(Phone, '[^0-9]', '', 'g') AS Phone,
           coalesce(NationKey, -1) AS NationKey, Balance, lower(Segment) AS Segment, _bronze_ingestion_timestamp,
           coalesce(NationKey, -1) IN (SELECT n_nationkey FROM nation) AS _fk_valid_NationKey,
           TIMESTAMP '{LOAD_2}' AS _silver_transform_timestamp, 5::BIGINT AS _silver_transformation_id,
           'run-1' AS _silver_run_id, 'er-1' AS _silver_entity_run_id
    FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY _bronze_ingestion_timestamp DESC) AS rn
          FROM customers_twice) WHERE rn = 1"""


@query("silver_standardize", sql(_STANDARD, "customers_twice"))
def silver_standardize(spark, sf_dir):
    return silver.standardize_table(
        inputs.customers_twice(spark, sf_dir), LOGIC, {"nation": table(spark, sf_dir, "nation")}, 5, "run-1", "er-1", LOAD_2
    )


@query(
    "silver_enrich",
    f"""SELECT event_id, lower(event_type) AS event_type, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               date_trunc('second', ts) AS at, TIMESTAMP '{LOAD_2}' AS _silver_transform_timestamp,
               6::BIGINT AS _silver_transformation_id, 'run-1' AS _silver_run_id, 'er-1' AS _silver_entity_run_id
        FROM events""",
)
def silver_enrich(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    )
    logic = {"standardize": {"event_type": "lower"}, "json_parse": "props", "timestamp_extract": "at"}
    return silver.enrich(rows, logic, {}, 6, "run-1", "er-1", LOAD_2)


AGGREGATION = {
    "group_by": ["o_custkey", "o_orderstatus"],
    "aggregations": [
        {"function": "sum", "column": "o_totalprice", "alias": "total"},
        {"function": "count", "column": "o_orderkey", "alias": "orders"},
        {"function": "max", "column": "o_orderdate", "alias": "last_order"},
        {"function": "min", "column": "o_orderdate", "alias": "first_order"},
        {"function": "avg", "column": "o_totalprice"},
    ],
}


@query(
    "silver_aggregate",
    f"""SELECT o_custkey, o_orderstatus, round(sum(o_totalprice), 2) AS total, count(o_orderkey) AS orders,
               max(o_orderdate) AS last_order, min(o_orderdate) AS first_order,
               TIMESTAMP '{LOAD_2}' AS _silver_transform_timestamp
        FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def silver_aggregate(spark, sf_dir):
    found = silver.aggregate(table(spark, sf_dir, "orders"), AGGREGATION, LOAD_2)
    return found.withColumn("total", F.round("total", 2))


@query(
    "silver_transform_dispatch",
    sql(
        f"""SELECT 'STANDARDIZATION' AS kind, CustomerID, Segment FROM ({_STANDARD})
            UNION ALL SELECT 'SCD2', CustomerID, Segment FROM customers
            UNION ALL SELECT 'SCD2', CustomerID, Segment FROM ({_CHANGED})
            UNION ALL SELECT 'DEDUPLICATION', CustomerID, coalesce(n.Segment, c.Segment)
                      FROM customers c LEFT JOIN (SELECT CustomerID, 'RELOADED' AS Segment FROM customers
                                                  WHERE CustomerID % 10 = 0) n USING (CustomerID)
            UNION ALL SELECT 'AGGREGATION', count(*), Segment FROM customers_twice GROUP BY Segment
            UNION ALL SELECT 'OTHER', CustomerID, Segment FROM customers_twice""",
        "customers_twice",
        "customers_next",
    ),
)
def silver_transform_dispatch(spark, sf_dir):
    twice, nation = inputs.customers_twice(spark, sf_dir), {"nation": table(spark, sf_dir, "nation")}
    grouping = {
        "group_by": ["Segment"],
        "aggregations": [{"function": "count", "column": "CustomerID", "alias": "CustomerID"}],
    }
    steps = [
        (twice, Transformation(1, 1, "STANDARDIZATION", LOGIC), None),
        (_next(spark, sf_dir), Transformation(2, 1, "SCD2", {"scd2_columns": TRACKED}, ("CustomerID",)), _first(spark, sf_dir)),
        (twice, Transformation(3, 1, "DEDUPLICATION", {}, ("CustomerID",)), None),
        (twice, Transformation(4, 1, "AGGREGATION", grouping), None),
        (twice, Transformation(5, 1, "OTHER", {}), None),
    ]
    parts = []
    for rows, step, history in steps:
        found = silver.dispatch(rows, step, nation, "run-1", "er-1", LOAD_2, history)
        parts.append(found.select(F.lit(step.kind).alias("kind"), "CustomerID", "Segment"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "join_inner",
    sql("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN few_customers ON o_custkey = c_custkey", "few_customers"),
)
def join_inner(spark, sf_dir):
    return joins.join(*_orders_and_customers(spark, sf_dir), "o_custkey", "inner")


def _orders_and_customers(spark, sf_dir):
    few = inputs.few_customers(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), few


@query(
    "join_left",
    sql("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN few_customers ON o_custkey = c_custkey", "few_customers"),
)
def join_left(spark, sf_dir):
    return joins.join(*_orders_and_customers(spark, sf_dir), "o_custkey", "left")


@query("join_using_alias", sql("SELECT CustomerID, Segment, NationKey FROM customers_next", "customers_next"), with_nulls=("NationKey",))
def join_using_alias(spark, sf_dir):
    return joins.join_source_side(_next(spark, sf_dir), _first(spark, sf_dir), KEYS)


@query(
    "join_left_anti",
    sql("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM few_customers)", "few_customers"),
)
def join_left_anti(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.anti(rows, inputs.few_customers(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    "join_left_semi",
    sql("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM few_customers)", "few_customers"),
)
def join_left_semi(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.semi(rows, inputs.few_customers(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    "join_lateral_top1",
    sql(
        """SELECT c_custkey AS EntityId, WatermarkAfter
           FROM customer LEFT JOIN (
               SELECT EntityId, WatermarkAfter,
                      row_number() OVER (PARTITION BY EntityId ORDER BY EndTime DESC, EntityRunId DESC) AS rn
               FROM entity_runs WHERE Status = 'SUCCEEDED') ON EntityId = c_custkey AND rn = 1""",
        "entity_runs",
    ),
)
def join_lateral_top1(spark, sf_dir):
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("EntityId"))
    return joins.lateral_latest(entities, inputs.entity_runs(spark, sf_dir))


@query(
    "join_auto_key",
    sql(
        """SELECT l.OrderID, l.PartID, l.Quantity, p.PartName, p.Quantity AS parts_Quantity
           FROM order_lines l LEFT JOIN (SELECT PartID, PartName, Size::BIGINT AS Quantity FROM parts) p USING (PartID)""",
        "order_lines",
        "parts",
    ),
)
def join_auto_key(spark, sf_dir):
    lines = inputs.order_lines(spark, sf_dir).select("OrderID", "PartID", "Quantity")
    parts = inputs.parts(spark, sf_dir).select("PartID", "PartName", F.col("Size").alias("Quantity"))
    return joins.join_dimension(lines, parts, "parts")


@query(
    "join_star",
    sql(
        """SELECT s.OrderID, s.CustomerID, s.OrderDate, s.OrderTotal, c.Segment, year(s.OrderDate)::BIGINT AS Year,
                  'Q' || quarter(s.OrderDate) AS Quarter
           FROM sales s LEFT JOIN customers c ON s.CustomerID = c.CustomerID""",
        "sales",
        "customers",
    ),
)
def join_star(spark, sf_dir):
    from tessera.suite.q_measures import dates

    dimensions = {
        "dim_customers": (inputs.customers(spark, sf_dir).select("CustomerID", "Segment"), "CustomerID", "CustomerID"),
        "Date": (dates(spark, sf_dir).select("Date", "Year", "Quarter"), "OrderDate", "Date"),
    }
    return joins.star(inputs.orders(spark, sf_dir).drop("Status"), dimensions)


@query(
    "join_run_history",
    sql(
        """SELECT c.RunId, ChildRunId, Kind, Name, ChildStatus, PipelineName, p.Status AS PipelineStatus
           FROM (SELECT RunId, EntityRunId AS ChildRunId, 'entity' AS Kind, EntityName AS Name, Status AS ChildStatus
                 FROM entity_runs
                 UNION ALL SELECT RunId, GoldRunId, 'gold', ModelName, Status FROM gold_runs) c
           JOIN pipeline_runs p USING (RunId)""",
        "pipeline_runs",
        "entity_runs",
        "gold_runs",
    ),
)
def join_run_history(spark, sf_dir):
    return joins.run_history(
        inputs.pipeline_runs(spark, sf_dir), inputs.entity_runs(spark, sf_dir), inputs.gold_runs(spark, sf_dir)
    )


@query(
    "join_merge_update",
    sql(
        """SELECT c.CustomerID,
                  CASE WHEN n.CustomerID IS NOT NULL AND n.Segment IS DISTINCT FROM c.Segment
                       THEN n.Segment ELSE c.Segment END AS Segment,
                  c.NationKey
           FROM customers c LEFT JOIN customers_next n USING (CustomerID)""",
        "customers_next",
    ),
    with_nulls=("NationKey",),
)
def join_merge_update(spark, sf_dir):
    target = inputs.customers(spark, sf_dir).select("CustomerID", *TRACKED)
    return scd.merge_update(
        target,
        _next(spark, sf_dir),
        KEYS,
        "NOT (source.Segment <=> target.Segment)",
        {"Segment": F.col("source.Segment")},
    )
