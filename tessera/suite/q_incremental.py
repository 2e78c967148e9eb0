"""Incremental loading and lineage columns."""

from pyspark.sql import functions as F

from tessera.config import Entity
from tessera.layout import read_table
from tessera.operators import audit, incremental
from tessera.plans import jobs
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import LOAD_1, sql, table
from tessera.suite.registry import query

_ORDERS = "o_orderkey, o_custkey, o_totalprice, o_orderdate"


@query("inc_filter", f"SELECT {_ORDERS} FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01 12:00:00'")
def inc_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return incremental.filter_above(orders, "o_orderdate", "1999-06-01 12:00:00", "datetime")


@query(
    "inc_filter_with_clause",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey > 500
       UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 400000""",
)
def inc_filter_with_clause(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    both = incremental.filter_with_clause(orders, "o_orderstatus = 'O'", "o_orderkey", "500", "bigint")
    alone = incremental.filter_with_clause(orders, "o_totalprice > 400000")
    return both.select("o_orderkey").unionByName(alone.select("o_orderkey"))


@query(
    "inc_max_watermark",
    """SELECT 'events' AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g') AS watermark FROM events
       UNION ALL SELECT 'orders', CAST(max(o_orderkey) AS VARCHAR) FROM orders
       UNION ALL SELECT 'none', '2020-01-01 00:00:00.000'""",
)
def inc_max_watermark(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = {
        "events": incremental.max_watermark(events, "ts"),
        "orders": incremental.max_watermark(table(spark, sf_dir, "orders"), "o_orderkey"),
        "none": incremental.max_watermark(events.where("event_id < 0"), "ts", "2020-01-01 00:00:00.000"),
    }
    parts = [df.select(F.lit(name).alias("source"), "watermark") for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "inc_last_watermark",
    sql(
        """SELECT EntityId, WatermarkAfter FROM (
             SELECT *, row_number() OVER (PARTITION BY EntityId
                                          ORDER BY EndTime DESC, EntityRunId DESC) AS rn
             FROM entity_runs WHERE Status = 'SUCCEEDED') WHERE rn = 1""",
        "entity_runs",
    ),
)
def inc_last_watermark(spark, sf_dir):
    return incremental.last_watermark(inputs.entity_runs(spark, sf_dir))


def _entity(sf_dir, load_type, **extra):
    return Entity(
        7, "orders.parquet", "adls-orders", "FILE", f"{sf_dir}/orders.parquet", load_type=load_type, **extra
    )


def _result(r):
    return (r.entity_name, r.status, r.rows_read, r.rows_written, r.watermark_after)


_RESULT = "load int, entity string, status string, rows_read long, rows_written long, watermark string"


def _report(spark, results, layout):
    """Load results next to the rows the table holds after them."""
    held = read_table(spark, layout).agg(F.count(F.lit(1)).alias("held"))
    rows = spark.createDataFrame([(i, *_result(r)) for i, r in enumerate(results)], _RESULT)
    return rows.withColumn("held", held.scalar())


@query(
    "inc_load_full",
    """SELECT load, 'orders.parquet' AS entity, 'SUCCEEDED' AS status, n AS rows_read, n AS rows_written,
              NULL::VARCHAR AS watermark, n AS held
       FROM (SELECT count(*) AS n FROM orders), (SELECT 0::BIGINT AS load UNION ALL SELECT 1::BIGINT)""",
)
def inc_load_full(spark, sf_dir):
    base, entity = scratch(spark, "lake"), _entity(sf_dir, "FULL")
    results = [jobs.load_entity(spark, entity, base, "run", LOAD_1) for _ in range(2)]
    return _report(spark, results, jobs.target_of(base, entity))


@query(
    "inc_load_incremental",
    """WITH c AS (SELECT count(*) FILTER (o_orderdate > TIMESTAMP '1998-01-01') AS n,
                         strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%g') AS w FROM orders)
       SELECT 0::BIGINT AS load, 'orders.parquet' AS entity, 'SUCCEEDED' AS status, n AS rows_read,
              n AS rows_written, w AS watermark, n AS held FROM c
       UNION ALL SELECT 1::BIGINT, 'orders.parquet', 'SUCCEEDED', 0, 0, w, n FROM c""",
)
def inc_load_incremental(spark, sf_dir):
    base = scratch(spark, "lake")
    first = _entity(sf_dir, "INCREMENTAL", watermark_column="o_orderdate", last_watermark="1998-01-01")
    one = jobs.load_entity(spark, first, base, "run-1", LOAD_1)
    second = _entity(
        sf_dir, "INCREMENTAL", watermark_column="o_orderdate", last_watermark=one.watermark_after
    )
    two = jobs.load_entity(spark, second, base, "run-2", LOAD_1)
    return _report(spark, [one, two], jobs.target_of(base, first))


@query(
    "inc_load_cdc",
    """WITH c AS (SELECT count(*) AS n, upper(lpad(to_hex(max(o_orderkey)), 20, '0')) AS w FROM orders)
       SELECT 0::BIGINT AS load, 'orders.parquet' AS entity, 'SUCCEEDED' AS status, n AS rows_read,
              n AS rows_written, w AS watermark, n AS held FROM c
       UNION ALL SELECT 1::BIGINT, 'orders.parquet', 'SUCCEEDED', 0, 0, w, n FROM c""",
)
def inc_load_cdc(spark, sf_dir):
    path, base = scratch(spark, "changes"), scratch(spark, "lake")
    table(spark, sf_dir, "orders").withColumn(
        "__$start_lsn", F.unhex(F.lpad(F.hex("o_orderkey"), 20, "0"))
    ).write.parquet(path)
    first = Entity(7, "orders.parquet", "adls-orders", "FILE", path, load_type="CDC")
    one = jobs.load_entity(spark, first, base, "run-1", LOAD_1)
    second = Entity(
        7, "orders.parquet", "adls-orders", "FILE", path, load_type="CDC", last_watermark=one.watermark_after
    )
    two = jobs.load_entity(spark, second, base, "run-2", LOAD_1)
    return _report(spark, [one, two], jobs.target_of(base, first))


@query(
    "inc_load_streaming",
    """SELECT 0::BIGINT AS load, 'orders.parquet' AS entity, 'SUCCEEDED' AS status, count(*) AS rows_read,
              count(*) AS rows_written, NULL::VARCHAR AS watermark, count(*) AS held FROM orders""",
)
def inc_load_streaming(spark, sf_dir):
    base, entity = scratch(spark, "lake"), _entity(sf_dir, "STREAMING")
    stream = inputs.stream(spark, sf_dir, "orders")
    one = jobs.load_stream(spark, entity, stream, base, "run", LOAD_1, scratch(spark, "checkpoint"))
    return _report(spark, [one], jobs.target_of(base, entity))


@query(
    "audit_basic",
    """SELECT *, TIMESTAMP '2024-01-01' AS _bronze_ingestion_timestamp, 'run-1' AS _bronze_run_id,
              'shop' AS _bronze_source_name, 'suppliers' AS _bronze_entity_name
       FROM (SELECT s_suppkey, s_name FROM supplier)""",
)
def audit_basic(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return audit.basic(rows, "run-1", LOAD_1, source_name="shop", entity_name="suppliers")


@query(
    "audit_bronze",
    """SELECT s_suppkey, TIMESTAMP '2024-01-01' AS _bronze_ingestion_timestamp, 'shop' AS _bronze_source_name,
              'suppliers' AS _bronze_entity_name, 'run-1' AS _bronze_run_id, 'er-1' AS _bronze_entity_run_id,
              'INCREMENTAL' AS _bronze_load_type, '100' AS _bronze_watermark_before,
              '20240101000000' AS _bronze_batch_id
       FROM supplier""",
)
def audit_bronze(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey")
    return audit.bronze(rows, "shop", "suppliers", "INCREMENTAL", "100", "run-1", "er-1", LOAD_1)


@query(
    "audit_silver",
    """SELECT s_suppkey, TIMESTAMP '2024-01-01' AS _silver_transform_timestamp,
              4::BIGINT AS _silver_transformation_id, 'run-1' AS _silver_run_id, 'er-1' AS _silver_entity_run_id
       FROM supplier""",
)
def audit_silver(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey")
    return audit.silver(rows, 4, "run-1", "er-1", LOAD_1)


@query(
    "audit_gold",
    """SELECT s_suppkey, TIMESTAMP '2024-01-01' AS _gold_load_timestamp, 'run-1' AS _gold_run_id,
              'dim_suppliers' AS _gold_model_name
       FROM supplier""",
)
def audit_gold(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey")
    return audit.gold(rows, "dim_suppliers", "run-1", LOAD_1)
