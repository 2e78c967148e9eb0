"""End-to-end jobs over lakes filled from the given tables."""

from pyspark.sql import functions as F

from tessera.config import Entity, Model, Rule, Transformation
from tessera.layout import Layout, bronze, gold, read_table, silver
from tessera.operators import observe, sinks
from tessera.plans import jobs
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import AS_OF, LOAD_1, LOAD_2, sql, table
from tessera.suite.q_drift import _delivery
from tessera.suite.q_gold import _BUILT, AGG, BROKEN, DIM, FACT, lake
from tessera.suite.q_history import LOGIC, TRACKED
from tessera.suite.q_quality import DIRTY_RULES, FAILED_SQL
from tessera.suite.registry import query


def _file(number, name, sf_dir, **extra):
    return Entity(number, f"{name}.parquet", f"adls-{name}", "FILE", f"{sf_dir}/{name}.parquet", **extra)


@query(
    "job_bronze",
    """SELECT 1::BIGINT AS entity_id, 'customer.parquet' AS entity_name, 'SUCCEEDED' AS status, count(*) AS rows_read,
              count(*) AS rows_written, NULL::VARCHAR AS watermark_after FROM customer
       UNION ALL SELECT 2, 'orders.parquet', 'SUCCEEDED', count(*), count(*),
              strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%g') FROM orders
              WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderstatus <> 'P'
       UNION ALL SELECT 3, 'absent.parquet', 'FAILED', 0, 0, '5' FROM orders HAVING count(*) > 0""",
)
def job_bronze(spark, sf_dir):
    orders = {
        "load_type": "INCREMENTAL",
        "watermark_column": "o_orderdate",
        "last_watermark": "1998-01-01",
        "filter_clause": "o_orderstatus <> 'P'",
    }
    entities = [
        _file(1, "customer", sf_dir),
        _file(2, "orders", sf_dir, **orders),
        _file(3, "absent", sf_dir, last_watermark="5"),
    ]
    report = jobs.job_bronze(spark, entities, scratch(spark, "lake"), "run-1", LOAD_1, parallelism=3)
    return report.drop("error")


@query(
    "job_quality",
    sql(
        f"""SELECT 'customers' AS table_name, 'QUARANTINED' AS status, 5::BIGINT AS rules_evaluated,
                   2::BIGINT AS rules_passed, 3::BIGINT AS rules_failed, 1::BIGINT AS critical_failures,
                   count(*) FILTER (failed_rules <> '') AS quarantine_count,
                   count(*) FILTER (failed_rules = '') AS checked_rows,
                   count(*) FILTER (failed_rules <> '') AS quarantine_rows, 5::BIGINT AS result_rows
            FROM ({FAILED_SQL})""",
        "customers",
    ),
)
def job_quality(spark, sf_dir):
    base = scratch(spark, "lake")
    sinks.overwrite(inputs.customers(spark, sf_dir), bronze(base, "customers"))
    report = jobs.job_quality(spark, "customers", DIRTY_RULES, base, "run-1", AS_OF)

    def rows(layout):
        return read_table(spark, layout).agg(F.count(F.lit(1))).scalar()

    return report.drop("requarantined_count").withColumns(
        {
            "checked_rows": rows(jobs.checked_layout(base, "customers")),
            "quarantine_rows": rows(jobs.quarantine(base, "customers")),
            "result_rows": rows(Layout(base, "system", "dq", "results")),
        }
    )


@query(
    "job_silver",
    sql(
        """SELECT 1::BIGINT AS transformation_id, 'STANDARDIZATION' AS transformation_type, 'customers' AS table_name,
                  'SUCCEEDED' AS status, count(*) AS rows_read, count(DISTINCT CustomerID) AS rows_written FROM customers_twice
           UNION ALL SELECT 2, 'SCD2', 'customers_scd2', 'SUCCEEDED', count(*), count(DISTINCT CustomerID) FROM customers_twice
           UNION ALL SELECT 3, 'STANDARDIZATION', 'absent', 'FAILED', 0, 0 FROM customers_twice HAVING count(*) > 0""",
        "customers_twice",
    ),
)
def job_silver(spark, sf_dir):
    base = scratch(spark, "lake")
    sinks.overwrite(inputs.customers_twice(spark, sf_dir), bronze(base, "customers"))
    steps = [
        (Transformation(2, 1, "SCD2", {"scd2_columns": TRACKED}, ("CustomerID",)), "customers", "customers_scd2"),
        (Transformation(1, 1, "STANDARDIZATION", LOGIC), "customers", "customers"),
        (Transformation(3, 1), "absent", "absent"),
    ]
    references = {"nation": table(spark, sf_dir, "nation")}
    return jobs.job_silver(spark, steps, base, "run-1", LOAD_2, references).drop("error")


@query(
    "job_gold",
    sql(
        f"""SELECT 'PARTIAL' AS status, count(*) AS models_processed, count(*) FILTER (status = 'SUCCEEDED') AS succeeded,
                   count(*) FILTER (status = 'FAILED') AS failed FROM ({_BUILT})""",
        "order_lines",
        "parts",
    ),
)
def job_gold(spark, sf_dir):
    report = jobs.job_gold(spark, [AGG, BROKEN, FACT, DIM], lake(spark, sf_dir), "run-1", AS_OF)
    return jobs.overall_status(report)


@query(
    "job_profile",
    """SELECT 'lines' AS table_name, count(*) AS total_rows, count(DISTINCT l_partkey) AS distinct_parts FROM lineitem
       UNION ALL SELECT 'parts', count(*), count(DISTINCT p_partkey) FROM part""",
)
def job_profile(spark, sf_dir):
    base = lake(spark, sf_dir)
    jobs.job_profile(spark, [silver(base, "lines"), silver(base, "parts")], base, AS_OF)
    kept = read_table(spark, Layout(base, "system", "profiles", "data_profiles"))
    parts = kept.where("column_name = 'PartID'")
    return parts.select(F.col("table").alias("table_name"), "total_rows", F.col("distinct_count").alias("distinct_parts"))


@query(
    "job_drift",
    """SELECT 2::BIGINT AS entity_id, 'customer' AS table_name, 'MERGE' AS status, 'ADDED_COLUMNS' AS drift_type,
              1::BIGINT AS added, 0::BIGINT AS removed, 0::BIGINT AS retyped, 2 * count(*) AS held FROM customer
       UNION ALL SELECT 5, 'nation', 'CHECKED', NULL, 0, 0, 0, 2 * count(*) FROM nation
       UNION ALL SELECT 4, 'part', 'REJECTED', 'TYPE_CHANGES', 0, 0, 1, count(*) FROM part""",
)
def job_drift(spark, sf_dir):
    base = scratch(spark, "lake")
    names = {2: "customer", 5: "nation", 4: "part"}
    layouts = {e: bronze(base, name) for e, name in names.items()}
    for e, name in names.items():
        sinks.overwrite(table(spark, sf_dir, name), layouts[e])
    batches = {e: (_delivery(spark, sf_dir, e), layouts[e]) for e in names}
    report = jobs.job_drift(spark, batches, "merge", base, AS_OF)
    held = F.lit(None).cast("long")
    for e, layout in layouts.items():
        rows = read_table(spark, layout).agg(F.count(F.lit(1))).scalar()
        held = F.when(F.col("entity_id") == e, rows).otherwise(held)
    return report.withColumn("held", held)


def _aged_lake(spark, sf_dir):
    """Customers of two loads in six files, and a small gold table."""
    base = scratch(spark, "lake")
    layouts = [bronze(base, "customers"), gold(base, "regions")]
    sinks.overwrite(inputs.customers_twice(spark, sf_dir).repartition(6), layouts[0])
    sinks.overwrite(table(spark, sf_dir, "region").coalesce(1), layouts[1])
    return base, layouts


@query(
    "job_maintenance",
    sql(
        """SELECT 'customers' AS table_name, 'OPTIMIZED' AS optimize, 'COMPACTED' AS compact, 'CLEANED' AS cleanup,
                  count(*) FILTER (_bronze_ingestion_timestamp < TIMESTAMP '2024-01-15') AS removed,
                  count(*) FILTER (_bronze_ingestion_timestamp >= TIMESTAMP '2024-01-15') AS held FROM customers_twice
           UNION ALL SELECT 'regions', 'SKIPPED', 'SKIPPED', 'SKIPPED', 0, count(*) FROM region""",
        "customers_twice",
    ),
)
def job_maintenance(spark, sf_dir):
    _, layouts = _aged_lake(spark, sf_dir)
    report = jobs.job_maintenance(spark, layouts, 90, "2024-04-14 08:00:00", max_files=5)
    held = F.lit(None).cast("long")
    for layout in layouts:
        rows = read_table(spark, layout).agg(F.count(F.lit(1))).scalar()
        held = F.when(F.col("table_name") == layout.table, rows).otherwise(held)
    return report.withColumn("held", held)


@query(
    "job_storage_review",
    sql(
        """SELECT 'bronze' AS layer, 'customers' AS table_name, 6::BIGINT AS num_files, 'DRY_RUN' AS optimize,
                  'DRY_RUN' AS compact, 'DRY_RUN' AS cleanup,
                  count(*) FILTER (_bronze_ingestion_timestamp < TIMESTAMP '2024-01-15') AS removed FROM customers_twice
           UNION ALL SELECT 'gold', 'regions', 1, 'SKIPPED', 'SKIPPED', 'SKIPPED', 0 FROM region HAVING count(*) > 0""",
        "customers_twice",
    ),
)
def job_storage_review(spark, sf_dir):
    base, _ = _aged_lake(spark, sf_dir)
    report = jobs.job_storage_review(
        spark, base, ["bronze", "gold"], "optimize_all", 90, "2024-04-14 08:00:00", dry_run=True, max_files=5
    )
    return report.drop("size_in_bytes")


# The medallion run: customers and orders with rules, history and a star model.
MEDALLION_RULES = {
    1: [Rule(1, "balance range", "RANGE", "c_acctbal", "ERROR", True, 0, 9000), Rule(2, "key unique", "UNIQUE", "c_custkey", "CRITICAL")],
    2: [Rule(3, "price range", "RANGE", "o_totalprice", "ERROR", True, 1000, 400000)],
}
MEDALLION_STEPS = {
    1: [
        (Transformation(1, 1, "STANDARDIZATION", {"standardize": {"c_mktsegment": "lower"}}), "customers"),
        (Transformation(2, 1, "SCD2", {"scd2_columns": ["c_mktsegment"]}, ("c_custkey",)), "customers_scd2"),
    ],
    2: [(Transformation(3, 2, "STANDARDIZATION", {"dedup_key": "o_orderkey"}), "orders")],
}
MEDALLION_MODELS = [
    Model("dim_customers", "DIMENSION", ("customers_scd2",), ("c_custkey",), priority=1),
    Model(
        "fact_orders",
        "FACT",
        ("orders", "dim_customers"),
        ("o_orderkey",),
        {"Net": "o_totalprice * 1 - 0"},
        ("dim_customers",),
        2,
    ),
]


@query(
    "job_medallion",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (c_acctbal BETWEEN 0 AND 9000) AS ok FROM customer),
            o AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice BETWEEN 1000 AND 400000) AS ok FROM orders),
            e AS (SELECT 'pipeline' AS RunKind, 'run-1' AS RunId, NULL::VARCHAR AS ParentRunId, 'medallion' AS Name,
                         'SUCCEEDED' AS Status, NULL::BIGINT AS RowsRead, NULL::BIGINT AS RowsWritten,
                         NULL::BIGINT AS RowsRejected FROM c
                  UNION ALL SELECT 'entity', 'run-1-1', 'run-1', 'customer.parquet', 'SUCCEEDED', n, ok, n - ok FROM c
                  UNION ALL SELECT 'entity', 'run-1-2', 'run-1', 'orders.parquet', 'SUCCEEDED', n, ok, n - ok FROM o
                  UNION ALL SELECT 'gold', 'run-1-dim_customers', 'run-1', 'dim_customers', 'SUCCEEDED', NULL, ok, NULL FROM c
                  UNION ALL SELECT 'gold', 'run-1-fact_orders', 'run-1', 'fact_orders', 'SUCCEEDED', NULL, ok, NULL FROM o)
       SELECT RunKind, RunId, ParentRunId, Name, 'end' AS EventType, Status, RowsRead, RowsWritten, RowsRejected FROM e
       UNION ALL SELECT RunKind, RunId, ParentRunId, Name, 'start', 'RUNNING', NULL, NULL, NULL FROM e""",
    with_nulls=("RowsRead", "RowsWritten", "RowsRejected"),
)
def job_medallion(spark, sf_dir):
    path = scratch(spark, "orders")
    table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey").write.parquet(path)
    orders = Entity(2, "orders.parquet", "adls-orders", "FILE", path)
    report = jobs.job_medallion(
        spark,
        [_file(1, "customer", sf_dir), orders],
        MEDALLION_RULES,
        MEDALLION_STEPS,
        MEDALLION_MODELS,
        scratch(spark, "lake"),
        "run-1",
        AS_OF,
        parallelism=2,
    )
    return report.drop("EventTime", "WatermarkBefore", "WatermarkAfter", "ErrorMessage")


@query(
    "job_medallion_incremental",
    """WITH d AS (SELECT CASE WHEN o_orderdate <= TIMESTAMP '1996-01-01' THEN 'run-1' ELSE 'run-2' END AS RunId, o_orderkey,
                         o_totalprice BETWEEN 1000 AND 400000 AS ok FROM orders)
       SELECT 'event' AS Part, RunId, count(*) AS Rows, count(*) FILTER (ok) AS Good, count(*) FILTER (NOT ok) AS Bad,
              NULL::BIGINT AS Keys FROM d GROUP BY RunId
       UNION ALL SELECT 'checked', RunId, count(*), count(*), 0, sum(o_orderkey)::BIGINT FROM d WHERE ok GROUP BY RunId
       UNION ALL SELECT 'quarantine', RunId, count(*), 0, count(*), sum(o_orderkey)::BIGINT FROM d WHERE NOT ok GROUP BY RunId
       UNION ALL SELECT 'history', 'run-2', count(*), count(*), 0, sum(o_orderkey)::BIGINT FROM d WHERE ok""",
    with_nulls=("Keys",),
)
def job_medallion_incremental(spark, sf_dir):
    """Two deliveries of orders; the second run reads, checks and merges the second delivery only, and is repeated."""
    base, path = scratch(spark, "lake"), scratch(spark, "orders")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    early = F.col("o_orderdate") <= F.lit("1996-01-01").cast("timestamp_ntz")
    steps = {2: [(Transformation(3, 2, "SCD2", {"scd2_columns": ["o_totalprice"]}, ("o_orderkey",)), "orders_scd2")]}
    mark, events = "1900-01-01", []
    for run, rows in (("run-1", orders.where(early)), ("run-2", orders.where(~early))):
        rows.write.mode("append").parquet(path)
        entity = Entity(
            2, "orders.parquet", "adls-orders", "FILE", path, load_type="INCREMENTAL",
            watermark_column="o_orderdate", last_watermark=mark,
        )
        report = jobs.job_medallion(spark, [entity], MEDALLION_RULES, steps, [], base, run, AS_OF)
        end = report.where("EventType = 'end' AND RunKind = 'entity'").first()
        mark = end["WatermarkAfter"]
        events.append(("event", run, end["RowsRead"], end["RowsWritten"], end["RowsRejected"], None))
    jobs.job_quality(spark, "orders", MEDALLION_RULES[2], base, "run-2", AS_OF)  # a repetition adds nothing

    def stored(part, layout, run, good):
        n = F.count(F.lit(1))
        counts = [n, n if good else F.lit(0), F.lit(0) if good else n, F.sum("o_orderkey")]
        return read_table(spark, layout).groupBy(F.lit(part), run).agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(counts)])

    names = ["Part", "RunId", "Rows", "Good", "Bad", "Keys"]
    found = spark.createDataFrame(events, "Part string, RunId string, Rows long, Good long, Bad long, Keys long")
    run = F.col("_bronze_run_id")
    for part, layout, by, good in (
        ("checked", jobs.checked_layout(base, "orders"), run, True),
        ("quarantine", jobs.quarantine(base, "orders"), run, False),
        ("history", silver(base, "orders_scd2"), F.lit("run-2"), True),
    ):
        found = found.unionByName(stored(part, layout, by, good).toDF(*names))
    return found


@query(
    "job_medallion_controlled",
    """WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice BETWEEN 1000 AND 400000) AS ok,
                         strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%g') AS mark FROM orders)
       SELECT 'run-1' AS RunId, 'orders.parquet' AS EntityName, 'SUCCEEDED' AS Status, n AS RowsRead, ok AS RowsWritten,
              '1900-01-01' AS WatermarkBefore, mark AS WatermarkAfter FROM o
       UNION ALL SELECT 'run-2', 'orders.parquet', 'SUCCEEDED', 0, 0, mark, mark FROM o""",
)
def job_medallion_controlled(spark, sf_dir):
    """Two runs from control rows: the second takes its entities and watermarks from the kept events of the first."""
    base = scratch(spark, "lake")
    sources = spark.createDataFrame(
        [(1, "adls-orders", "FILE", "orders-ref", "none", True)],
        "SourceId int, SourceName string, SourceType string, ConnectionStringRef string, AuthenticationType string, IsActive boolean",
    )
    entities = spark.createDataFrame(
        [(2, 1, "orders.parquet", None, "lake", "raw", "orders", "INCREMENTAL", "o_orderdate", "datetime", "1900-01-01", None, 1, 1, True)],
        "EntityId int, SourceId int, EntityName string, SourceSchema string, TargetLakehouse string, TargetSchema string, "
        "TargetTableName string, LoadType string, WatermarkColumn string, WatermarkDataType string, WatermarkOffset string, "
        "SourceFilterClause string, ParallelismDegree int, Priority int, IsActive boolean",
    )
    runs = observe.entity_runs(observe.fold_runs(spark.createDataFrame([], jobs.RUN_EVENTS)))
    for number, run in enumerate(("run-1", "run-2"), 1):
        rows = observe.entities_to_process(entities, sources, runs).collect()  # one row per entity
        wanted = [Entity.from_row(r, {"orders-ref": f"{sf_dir}/orders.parquet"}) for r in rows]
        jobs.job_medallion(spark, wanted, MEDALLION_RULES, {}, [], base, run, f"2001-07-{15 + number} 08:00:00")
        runs = observe.entity_runs(observe.fold_runs(read_table(spark, jobs.run_events_layout(base))))
    return runs.select(
        F.col("PipelineRunId").alias("RunId"), "EntityName", "Status", "RowsRead", "RowsWritten", "WatermarkBefore", "WatermarkAfter"
    )


@query(
    "job_quality_deliveries",
    """WITH d AS (SELECT 'run-1' AS RunId, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0
                  UNION ALL SELECT 'run-2', o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 1),
            n AS (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS held FROM d),
            c AS (SELECT *, held = 1 AND o_totalprice >= 1000 AS ok FROM n)
       SELECT CASE WHEN ok THEN 'checked' ELSE 'quarantine' END AS Part, RunId, count(*) AS Rows, sum(o_orderkey)::BIGINT AS Keys
       FROM c GROUP BY ALL
       UNION ALL SELECT 'unique rule', RunId, rows, rows - keys FROM (
            SELECT 'run-1' AS RunId, count(*) AS rows, count(DISTINCT o_orderkey) AS keys FROM d WHERE RunId = 'run-1'
            UNION ALL SELECT 'run-2', count(*), count(DISTINCT o_orderkey) FROM d)""",
)
def job_quality_deliveries(spark, sf_dir):
    """Keys that come again in a later delivery break a unique rule with all their rows, the earlier ones too."""
    base = scratch(spark, "lake")
    rules = [Rule(1, "key once", "UNIQUE", "o_orderkey", "CRITICAL", True), Rule(2, "dear", "RANGE", "o_totalprice", "ERROR", True, 1000)]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    key = F.col("o_orderkey")
    for run, test in (("run-1", key % 3 != 0), ("run-2", (key % 3 == 0) | (key % 7 == 1))):
        sinks.append(orders.where(test).withColumn("RunId", F.lit(run)), bronze(base, "orders"), load=run)
        jobs.job_quality(spark, "orders", rules, base, run, AS_OF)
    found = []
    for part, layout in (("checked", jobs.checked_layout(base, "orders")), ("quarantine", jobs.quarantine(base, "orders"))):
        counts = read_table(spark, layout).groupBy("RunId").agg(F.count(F.lit(1)).alias("Rows"), F.sum("o_orderkey").alias("Keys"))
        found.append(counts.select(F.lit(part).alias("Part"), "RunId", "Rows", "Keys"))
    results = read_table(spark, Layout(base, "system", "dq", "results")).where("RuleId = 1")
    run = F.regexp_replace("EntityRunId", "-orders$", "").alias("RunId")
    found.append(results.select(F.lit("unique rule").alias("Part"), run, F.col("TotalRows").alias("Rows"), F.col("FailedRows").alias("Keys")))
    return found[0].unionByName(found[1]).unionByName(found[2])
