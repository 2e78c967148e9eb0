"""Sinks: written from the given tables, then read back whole."""

from pyspark.sql import functions as F

from tessera.layout import Layout, bronze, gold, quarantine, read_table
from tessera.operators import profile, sinks
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import sql, table
from tessera.suite.q_quality import DIRTY_RULES, FAILED_SQL
from tessera.suite.q_sources import landed
from tessera.suite.registry import query


@query("sink_overwrite", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def sink_overwrite(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "orders")
    orders = table(spark, sf_dir, "orders")
    sinks.overwrite(orders, layout)
    doubled = read_table(spark, layout).select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))
    sinks.overwrite(doubled, layout)
    return read_table(spark, layout)


@query(
    "sink_append_evolve",
    """SELECT s_suppkey AS id, s_name AS name, NULL::DOUBLE AS balance FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
)
def sink_append_evolve(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "parties")
    first = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name")
    )
    second = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    sinks.append(first, layout)
    sinks.append(second, layout)
    return read_table(spark, layout)


@query("sink_register_table", "SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def sink_register_table(spark, sf_dir):
    layout = gold(scratch(spark, "lake"), "parts")
    name = "tessera_registered_parts"
    sinks.overwrite(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), layout)
    sinks.register(spark, layout, name)
    return spark.table(name)


@query("sink_quarantine", sql(f"SELECT CustomerID, failed_rules FROM ({FAILED_SQL}) WHERE failed_rules <> ''", "customers"))
def sink_quarantine(spark, sf_dir):
    from tessera.operators import quality

    layout = quarantine(scratch(spark, "lake"), "customers")
    _, bad = quality.quarantine_split(inputs.customers(spark, sf_dir), DIRTY_RULES)
    sinks.append(bad, layout)
    rows = read_table(spark, layout)
    return rows.select("CustomerID", F.array_join("_dq_failed_rules", ",").alias("failed_rules"))


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "sink_profile",
    " UNION ALL ".join(
        f"""SELECT TIMESTAMP '2001-07-15' AS profile_timestamp, 'orders' AS "table", '{c}' AS column_name,
                   count(*) AS total_rows, count(DISTINCT {c}) AS distinct_count FROM orders"""
        for c in _ORDERS
    ),
)
def sink_profile(spark, sf_dir):
    layout = Layout(scratch(spark, "lake"), "system", "profiles", "data_profiles")
    found = profile.basic(table(spark, sf_dir, "orders"))
    sinks.append(profile.stamped(found, "bronze", "raw", "orders", inputs.AS_OF), layout)
    return read_table(spark, layout).select(
        "profile_timestamp", "table", "column_name", "total_rows", "distinct_count"
    )


@query(
    "sink_backup_copy",
    """SELECT 'customer' AS table_name, count(*) AS "rows", TRUE AS matches FROM customer
       UNION ALL SELECT 'orders', count(*), TRUE FROM orders""",
)
def sink_backup_copy(spark, sf_dir):
    base, copy = scratch(spark, "lake"), scratch(spark, "backup")
    layouts = [gold(base, name) for name in ("customer", "orders")]
    for layout in layouts:
        sinks.overwrite(table(spark, sf_dir, layout.table), layout)
    return sinks.backup(spark, layouts, copy)


@query("sink_stream_table", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def sink_stream_table(spark, sf_dir):
    return landed(spark, inputs.stream(spark, sf_dir, "events"), "events")
