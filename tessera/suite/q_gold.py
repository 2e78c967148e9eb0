"""Gold models, aggregates, windows, sorts, top-k and samples."""

from pyspark.sql import functions as F

from tessera.config import Model
from tessera.layout import gold as gold_layout
from tessera.layout import read_table, silver
from tessera.operators import aggregates, dedup, gold, measures, sinks
from tessera.plans import jobs
from tessera.session import scratch
from tessera.suite import inputs
from tessera.suite.inputs import AS_OF, sql, table
from tessera.suite.registry import ORACLES, query

DIM = Model("dim_parts", "DIMENSION", ("parts",), ("PartID",), priority=1)
FACT = Model(
    "fact_lines",
    "FACT",
    ("lines", "dim_parts"),
    ("OrderID",),
    {"LineTotal": "UnitPrice * Quantity - Discount"},
    ("dim_parts",),
    2,
)
AGG = Model(
    "agg_brands",
    "AGGREGATE",
    ("fact_lines",),
    ("Brand", "ShipDateYear"),
    {
        "Revenue": "SUM(LineTotal)",
        "Lines": "COUNT(OrderID)",
        "Orders": "COUNT(DISTINCT OrderID)",
        "AvgQuantity": "AVG(Quantity)",
    },
    ("fact_lines",),
    3,
)
_AUDIT = f"TIMESTAMP '{AS_OF}' AS _gold_load_timestamp, 'run-1' AS _gold_run_id"
_FACT = f"""
    SELECT l.OrderID, l.LineNumber::BIGINT AS LineNumber, l.PartID, l.UnitPrice, l.Quantity, l.Discount, l.ShipDate,
           p.PartName, p.Brand, p.Size::BIGINT AS Size, p.IsCurrent,
           l.UnitPrice * l.Quantity - l.Discount AS LineTotal,
           year(l.ShipDate)::BIGINT AS ShipDateYear, month(l.ShipDate)::BIGINT AS ShipDateMonth,
           day(l.ShipDate)::BIGINT AS ShipDateDay, quarter(l.ShipDate)::BIGINT AS ShipDateQuarter,
           {_AUDIT}, 'fact_lines' AS _gold_model_name
    FROM order_lines l LEFT JOIN (SELECT * FROM parts WHERE IsCurrent) p USING (PartID)"""
_AGG = f"""
    SELECT Brand, ShipDateYear, round(sum(LineTotal), 2) AS Revenue, count(OrderID) AS Lines,
           count(DISTINCT OrderID) AS Orders, round(avg(Quantity), 6) AS AvgQuantity, {_AUDIT},
           'agg_brands' AS _gold_model_name
    FROM ({_FACT}) GROUP BY Brand, ShipDateYear"""


def _sources(spark, sf_dir):
    return {"parts": inputs.parts(spark, sf_dir), "dim_parts": inputs.parts(spark, sf_dir), "lines": inputs.order_lines(spark, sf_dir)}


@query("gold_dimension", sql(f"SELECT PartID, PartName, Brand, Size::BIGINT AS Size, IsCurrent, {_AUDIT}, 'dim_parts' AS _gold_model_name FROM parts WHERE IsCurrent", "parts"))
def gold_dimension(spark, sf_dir):
    return gold.dimension(_sources(spark, sf_dir), DIM, "run-1", AS_OF)


@query("gold_fact", sql(_FACT, "order_lines", "parts"), with_nulls=("Size",), as_text=("IsCurrent",))
def gold_fact(spark, sf_dir):
    return gold.fact(_sources(spark, sf_dir), FACT, "run-1", AS_OF)


@query("gold_aggregate", sql(_AGG, "order_lines", "parts"))
def gold_aggregate(spark, sf_dir):
    fact = gold.fact(_sources(spark, sf_dir), FACT, "run-1", AS_OF)
    rows = gold.aggregate({"fact_lines": fact}, AGG, "run-1", AS_OF)
    return rows.withColumns({"Revenue": F.round("Revenue", 2), "AvgQuantity": F.round("AvgQuantity", 6)})


@query(
    "gold_models_select",
    """SELECT p_partkey AS ModelId, p_name || p_partkey AS ModelName, p_size::BIGINT AS Priority
       FROM part WHERE p_partkey % 3 <> 0""",
)
def gold_models_select(spark, sf_dir):
    models = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ModelId"),
        F.concat("p_name", "p_partkey").alias("ModelName"),
        F.col("p_size").alias("Priority"),
        (F.col("p_partkey") % 3 != 0).alias("IsActive"),
    )
    return gold.select_models(models).drop("IsActive")


def lake(spark, sf_dir):
    """A base folder whose silver layer holds lines and parts."""
    base = scratch(spark, "lake")
    sinks.overwrite(inputs.order_lines(spark, sf_dir), silver(base, "lines"))
    sinks.overwrite(inputs.parts(spark, sf_dir), silver(base, "parts"))
    return base


_BUILT = f"""
    SELECT 'dim_parts' AS model_name, 'DIMENSION' AS model_type, 'SUCCEEDED' AS status, count(*) AS rows_written
    FROM parts WHERE IsCurrent
    UNION ALL SELECT 'fact_lines', 'FACT', 'SUCCEEDED', count(*) FROM order_lines
    UNION ALL SELECT 'agg_brands', 'AGGREGATE', 'SUCCEEDED', count(*) FROM ({_AGG})
    UNION ALL SELECT 'broken', 'FACT', 'FAILED', 0"""
BROKEN = Model("broken", "FACT", ("absent",), priority=9)


@query("gold_build_all", sql(_BUILT, "order_lines", "parts"))
def gold_build_all(spark, sf_dir):
    base = lake(spark, sf_dir)
    report = jobs.build_all(spark, [AGG, BROKEN, FACT, DIM], base, "run-1", AS_OF)
    assert read_table(spark, gold_layout(base, "agg_brands")).columns[:2] == ["Brand", "ShipDateYear"]
    return report.drop("error")


@query(
    "agg_grouped_basic",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, count(l_orderkey) AS n,
              round(avg(l_extendedprice), 4) AS avg_price, max(l_discount) AS max_discount, min(l_tax) AS min_tax
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_grouped_basic(spark, sf_dir):
    specs = [
        {"function": "sum", "column": "l_quantity", "alias": "sum_qty"},
        {"function": "count", "column": "l_orderkey", "alias": "n"},
        {"function": "avg", "column": "l_extendedprice", "alias": "avg_price"},
        {"function": "max", "column": "l_discount", "alias": "max_discount"},
        {"function": "min", "column": "l_tax", "alias": "min_tax"},
    ]
    rows = aggregates.grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], specs)
    return rows.withColumns({"sum_qty": F.round("sum_qty", 2), "avg_price": F.round("avg_price", 4)})


@query("agg_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_returnflag")
def agg_count_distinct(spark, sf_dir):
    return aggregates.distinct_count(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_returnflag"])


@query("agg_dcount", "SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type")
def agg_dcount(spark, sf_dir):
    return aggregates.dcount(table(spark, sf_dir, "events"), "user_id", ["event_type"])


@query(
    "agg_countif",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n,
              round(count(*) FILTER (o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 6) AS rate
       FROM orders GROUP BY o_orderpriority""",
)
def agg_countif(spark, sf_dir):
    rows = aggregates.countif(table(spark, sf_dir, "orders"), "o_orderstatus = 'F'", ["o_orderpriority"])
    return rows.withColumn("rate", F.round("rate", 6))


@query(
    "agg_arg_max",
    sql(
        """SELECT UserId, max(PageUrl) AS top, (SELECT p FROM (
                      SELECT w.PageUrl AS p, count(*) AS n FROM web_raw w WHERE w.UserId = o.UserId
                      GROUP BY w.PageUrl ORDER BY n DESC, p LIMIT 1)) AS most_frequent
           FROM web_raw o GROUP BY UserId""",
        "web_raw",
    ),
)
def agg_arg_max(spark, sf_dir):
    pages = inputs.web_events(spark, sf_dir)
    last = aggregates.arg_max(pages, "PageUrl", ["UserId"])
    return last.join(aggregates.most_frequent(pages, "PageUrl", ["UserId"], "most_frequent"), "UserId")


@query("agg_stddev", "SELECT p_brand, round(stddev_samp(p_retailprice), 6) AS stddev FROM part GROUP BY p_brand")
def agg_stddev(spark, sf_dir):
    rows = aggregates.stddev(table(spark, sf_dir, "part"), "p_retailprice", ["p_brand"])
    return rows.withColumn("stddev", F.round("stddev", 6))


@query(
    "agg_median_approx",
    "SELECT l_returnflag, quantile_disc(l_quantity, 0.5) AS median FROM lineitem GROUP BY l_returnflag",
)
def agg_median_approx(spark, sf_dir):
    """Quantities take few values, so the approximate median equals the exact one."""
    return aggregates.median(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"])


@query("agg_distinct_rows", "SELECT DISTINCT l_partkey FROM lineitem")
def agg_distinct_rows(spark, sf_dir):
    return aggregates.distinct_values(table(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    "win_row_number_latest",
    """SELECT o_custkey, o_orderkey, o_orderdate, rn FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
)
def win_row_number_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup.rank_latest(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("win_count_partition", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem")
def win_count_partition(spark, sf_dir, large=False):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return aggregates.partition_count(rows, ["l_orderkey", "l_linenumber"], always_split=large)


@query("win_count_partition_large", ORACLES["win_count_partition"])
def win_count_partition_large(spark, sf_dir):
    """With the plan that large tables get, heavy keys salted."""
    return win_count_partition(spark, sf_dir, True)


_DAILY = "SELECT o_orderdate, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY o_orderdate"


def _exact(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("revenue")
    return table(spark, sf_dir, "orders").select("o_orderdate", price)


@query(
    "win_ytd_running",
    f"""SELECT o_orderdate, CAST(v AS DOUBLE) AS revenue,
               CAST(sum(v) OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate) AS DOUBLE) AS ytd
        FROM ({_DAILY})""",
)
def win_ytd_running(spark, sf_dir):
    return measures.running_in_year(_exact(spark, sf_dir), "o_orderdate", "revenue")


@query(
    "win_prior_year",
    f"""WITH d AS ({_DAILY})
        SELECT d.o_orderdate, CAST(d.v AS DOUBLE) AS revenue, CAST(p.v AS DOUBLE) AS prior
        FROM d LEFT JOIN d p ON p.o_orderdate = d.o_orderdate - INTERVAL 1 YEAR""",
)
def win_prior_year(spark, sf_dir):
    return measures.prior_year(_exact(spark, sf_dir), "o_orderdate", "revenue")


@query("sort_priority", "SELECT o_orderpriority, o_orderkey FROM orders ORDER BY o_orderpriority, o_orderkey")
def sort_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return aggregates.sorted_by(rows, {"o_orderpriority": "asc", "o_orderkey": "asc"})


@query("sort_desc_metric", "SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey")
def sort_desc_metric(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return aggregates.sorted_by(totals, {"total": "desc"})


@query("topk_values", "SELECT p_name, count(*) AS \"count\" FROM part GROUP BY p_name ORDER BY 2 DESC, 1 LIMIT 10")
def topk_values(spark, sf_dir):
    return aggregates.top_values(table(spark, sf_dir, "part"), "p_name")


@query(
    "topk_failing",
    sql(
        """SELECT EntityName, count(*) AS FailureCount FROM entity_runs WHERE Status = 'FAILED'
           GROUP BY EntityName ORDER BY 2 DESC, 1 LIMIT 10""",
        "entity_runs",
    ),
)
def topk_failing(spark, sf_dir):
    from tessera.operators import observe

    return observe.top_failing(inputs.entity_runs(spark, sf_dir))


@query(
    "sample_fraction",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice FROM lineitem
       WHERE substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) < '19999999'""",
)
def sample_fraction(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return aggregates.sample_fraction(rows, 0.1, ["l_orderkey", "l_linenumber"])
