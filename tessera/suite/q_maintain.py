"""Table upkeep on lake tables written from the given tables."""

from pyspark.sql import functions as F

from tessera.layout import bronze, read_table, silver
from tessera.operators import maintain, sinks
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import sql, table
from tessera.suite.registry import query


def _lake(spark, sf_dir):
    """Orders in four files and customers in one."""
    base = scratch(spark, "lake")
    orders, customers = bronze(base, "orders"), silver(base, "customer")
    sinks.overwrite(table(spark, sf_dir, "orders").repartition(4), orders)
    sinks.overwrite(table(spark, sf_dir, "customer").coalesce(1), customers)
    return base, orders, customers


_FILES = """SELECT 'bronze' AS layer, 'orders' AS table_name, 4::BIGINT AS num_files, count(*) > 0 AS has_bytes FROM orders
            UNION ALL SELECT 'silver', 'customer', 1, count(*) > 0 FROM customer"""


@query("maint_table_stats", _FILES)
def maint_table_stats(spark, sf_dir):
    _, *tables = _lake(spark, sf_dir)
    stats = maintain.table_stats(spark, tables)
    return stats.select("layer", "table_name", "num_files", (F.col("size_in_bytes") > 0).alias("has_bytes"))


@query("maint_catalog_sizes", _FILES)
def maint_catalog_sizes(spark, sf_dir):
    base, *_ = _lake(spark, sf_dir)
    sizes = maintain.catalog_sizes(spark, base)
    return sizes.select("layer", "table_name", "num_files", (F.col("size_mb") >= 0).alias("has_bytes"))


@query("maint_needs_compaction", f"SELECT * FROM ({_FILES}) WHERE num_files > 2")
def maint_needs_compaction(spark, sf_dir):
    _, *tables = _lake(spark, sf_dir)
    flagged = maintain.needs_compaction(maintain.table_stats(spark, tables), 2)
    return flagged.select("layer", "table_name", "num_files", (F.col("size_in_bytes") > 0).alias("has_bytes"))


@query("maint_compact", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def maint_compact(spark, sf_dir):
    _, orders, _ = _lake(spark, sf_dir)
    maintain.compact(spark, orders)
    return read_table(spark, orders).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "maint_compact_report",
    """SELECT 'orders' AS table_name, 4::BIGINT AS pre_files, n AS post_files, 4 - n AS files_reduced
       FROM (SELECT greatest(1, count(*) // 1000000) AS n FROM orders)""",
)
def maint_compact_report(spark, sf_dir):
    _, orders, _ = _lake(spark, sf_dir)
    before = maintain.table_stats(spark, [orders])
    maintain.compact(spark, orders)
    report = maintain.compact_report(before, maintain.table_stats(spark, [orders]))
    return report.select("table_name", "pre_files", "post_files", "files_reduced")


@query("maint_cluster_rewrite", "SELECT l_orderkey, l_partkey, l_shipdate, l_quantity FROM lineitem")
def maint_cluster_rewrite(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "lineitem")
    sinks.overwrite(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity"), layout)
    maintain.cluster_table(spark, layout, ["l_shipdate", "l_partkey"], 8)
    return read_table(spark, layout)


@query(
    "maint_cluster_skip",
    """SELECT 'curve' AS layout, count(*) AS held, TRUE AS skips_on_first, TRUE AS skips_on_second FROM lineitem
       UNION ALL SELECT 'sorted', count(*), TRUE, FALSE FROM lineitem""",
)
def maint_cluster_skip(spark, sf_dir):
    """Whether at most half of the files are read for one value of the first, and of the second, clustering column."""
    base, found = scratch(spark, "lake"), []
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    middle = rows.agg(*[F.percentile_approx(c, 0.4).alias(c) for c in ("l_shipdate", "l_partkey")]).first()
    for name, curve in (("curve", True), ("sorted", False)):
        layout = bronze(base, f"lineitem_{name}")
        sinks.overwrite(rows, layout)
        maintain.cluster_table(spark, layout, ["l_shipdate", "l_partkey"], 16, curve)
        ranges = maintain.file_ranges(spark, layout, ["l_shipdate", "l_partkey"])

        def skips(c, all_files=ranges):
            hit = (F.col(f"min_{c}") <= F.lit(middle[c])) & (F.col(f"max_{c}") >= F.lit(middle[c]))
            return all_files.agg((F.count_if(hit) * 2 <= F.count(F.lit(1)))).scalar()

        held = read_table(spark, layout).agg(F.count(F.lit(1))).scalar()
        found.append(spark.range(1).select(F.lit(name).alias("layout"), held.alias("held"), skips("l_shipdate").alias("skips_on_first"), skips("l_partkey").alias("skips_on_second")))
    return found[0].unionByName(found[1])


@query(
    "maint_retention",
    sql("SELECT CustomerID, Segment, _bronze_ingestion_timestamp FROM customers_twice WHERE _bronze_ingestion_timestamp >= TIMESTAMP '2024-01-15'", "customers_twice"),
)
def maint_retention(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "customers")
    rows = inputs.customers_twice(spark, sf_dir)
    sinks.overwrite(rows.select("CustomerID", "Segment", "_bronze_ingestion_timestamp"), layout)
    maintain.retention(spark, layout, 90, "2024-04-14 08:00:00")
    return read_table(spark, layout)


@query(
    "maint_storage_cost",
    """SELECT 'orders' AS table_name, 4::BIGINT AS num_files, 'OK' AS recommendation, TRUE AS priced FROM orders HAVING count(*) > 0
       UNION ALL SELECT 'customer', 1, 'OK', TRUE FROM customer HAVING count(*) > 0""",
)
def maint_storage_cost(spark, sf_dir):
    _, *tables = _lake(spark, sf_dir)
    stats = maintain.table_stats(spark, tables)
    cost = maintain.storage_cost(stats).join(stats.select("table_name", "size_in_bytes"), "table_name")
    expected = F.round(F.col("size_in_bytes") / (1024.0**3) * 0.023, 4)
    priced = (F.col("monthly_cost_usd") == expected).alias("priced")
    return cost.select("table_name", "num_files", "recommendation", priced)


@query(
    "maint_run_summary",
    """SELECT 'SUCCEEDED' AS status, 2::BIGINT AS processed, 1::BIGINT AS optimized, 1::BIGINT AS compacted,
              0::BIGINT AS failed FROM orders HAVING count(*) > 0""",
)
def maint_run_summary(spark, sf_dir):
    from tessera.plans import jobs

    _, *tables = _lake(spark, sf_dir)
    return maintain.run_summary(jobs.job_maintenance(spark, tables, 90, "2024-01-01", max_files=2))
