"""Business measures."""

from pyspark.sql import functions as F

from tessera.operators import measures, observe
from tessera.suite import inputs
from tessera.suite.inputs import AS_OF, sql, table
from tessera.suite.registry import query


def _round(df, column, places=2):
    return df.withColumn(column, F.round(column, places))


def dates(spark, sf_dir, fiscal_start_month=7):
    """Date table over the span of the orders."""
    bounds = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return measures.date_dimension(bounds, fiscal_start_month)


@query("msr_total_revenue", sql("SELECT Status, round(sum(OrderTotal), 2) AS TotalRevenue FROM sales GROUP BY Status", "sales"))
def msr_total_revenue(spark, sf_dir):
    return _round(measures.total_revenue(inputs.orders(spark, sf_dir), ["Status"]), "TotalRevenue")


@query("msr_total_orders", sql("SELECT Status, count(*) AS TotalOrders FROM sales GROUP BY Status", "sales"))
def msr_total_orders(spark, sf_dir):
    return measures.total_orders(inputs.orders(spark, sf_dir), ["Status"])


@query(
    "msr_avg_order_value",
    sql("SELECT Status, round(sum(OrderTotal) / count(*), 4) AS AverageOrderValue FROM sales GROUP BY Status", "sales"),
)
def msr_avg_order_value(spark, sf_dir):
    return _round(measures.average_order_value(inputs.orders(spark, sf_dir), ["Status"]), "AverageOrderValue", 4)


_DAYS = """SELECT d."Date", coalesce(r.revenue, 0) AS revenue
           FROM (SELECT unnest(generate_series(min(OrderDate), max(OrderDate), INTERVAL 1 DAY)) AS "Date" FROM sales) d
           LEFT JOIN (SELECT OrderDate, sum(OrderTotal) AS revenue FROM sales GROUP BY OrderDate) r
             ON r.OrderDate = d."Date\""""


@query(
    "msr_ytd_revenue",
    sql(
        f"""SELECT "Date", round(sum(revenue) OVER (PARTITION BY year("Date") ORDER BY "Date"), 2) AS YTDRevenue
            FROM ({_DAYS})""",
        "sales",
    ),
)
def msr_ytd_revenue(spark, sf_dir):
    return _round(measures.ytd_revenue(inputs.orders(spark, sf_dir), dates(spark, sf_dir)), "YTDRevenue")


@query(
    "msr_yoy_growth",
    sql(
        f"""SELECT c."Date", round(coalesce(CASE WHEN p.revenue <> 0 THEN (c.revenue - p.revenue) / p.revenue END, 0), 6) AS YoYGrowth
            FROM ({_DAYS}) c LEFT JOIN ({_DAYS}) p ON p."Date" = c."Date" - INTERVAL 1 YEAR""",
        "sales",
    ),
)
def msr_yoy_growth(spark, sf_dir):
    return _round(measures.yoy_growth(inputs.orders(spark, sf_dir), dates(spark, sf_dir)), "YoYGrowth", 6)


@query(
    "msr_date_dimension",
    """SELECT d AS "Date", year(d)::BIGINT AS "Year", month(d)::BIGINT AS "Month", day(d)::BIGINT AS "Day",
              'Q' || quarter(d) AS "Quarter", strftime(d, '%B') AS MonthName, strftime(d, '%A') AS DayOfWeek,
              dayofweek(d) IN (0, 6) AS IsWeekend, (year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END)::BIGINT AS FiscalYear
       FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
)
def msr_date_dimension(spark, sf_dir):
    return dates(spark, sf_dir)


def _runs(spark, sf_dir):
    return observe.with_duration(inputs.pipeline_runs(spark, sf_dir), AS_OF)


@query("msr_total_runs", sql("SELECT PipelineName, count(*) AS TotalRuns FROM pipeline_runs GROUP BY 1", "pipeline_runs"))
def msr_total_runs(spark, sf_dir):
    return measures.total_runs(_runs(spark, sf_dir), ["PipelineName"])


@query(
    "msr_success_rate",
    sql(
        """SELECT PipelineName, round(count(*) FILTER (Status = 'SUCCEEDED') / count(*)::DOUBLE, 6) AS SuccessRate
           FROM pipeline_runs GROUP BY 1""",
        "pipeline_runs",
    ),
)
def msr_success_rate(spark, sf_dir):
    return _round(measures.success_rate(_runs(spark, sf_dir), ["PipelineName"]), "SuccessRate", 6)


@query("msr_avg_duration", sql("SELECT PipelineName, round(avg(DurationSeconds), 4) AS AvgDuration FROM pipeline_runs GROUP BY 1", "pipeline_runs"))
def msr_avg_duration(spark, sf_dir):
    return _round(measures.average_duration(_runs(spark, sf_dir), ["PipelineName"]), "AvgDuration", 4)


@query("msr_rows_processed", sql("SELECT PipelineName, sum(RowsRead)::BIGINT AS RowsProcessed FROM pipeline_runs GROUP BY 1", "pipeline_runs"))
def msr_rows_processed(spark, sf_dir):
    return measures.rows_processed(_runs(spark, sf_dir), ["PipelineName"])
