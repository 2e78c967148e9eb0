"""Business measures over the star model and the run history, and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def running_in_year(df: DataFrame, date: str, value: str, output: str = "ytd") -> DataFrame:
    """Year-to-date total per date.

    Values are summed per date first; the window then sees at most 366 rows a year whatever the size
    of the input.
    """
    daily = _daily(df, date, value)
    window = (
        Window.partitionBy(F.year(date))
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn(output, F.sum(value).over(window))


def prior_year(df: DataFrame, date: str, value: str, output: str = "prior") -> DataFrame:
    """Value per date and the value of the same date one year earlier, null where there was none.

    Dates are matched, not row offsets, so gaps do not shift the comparison; 29 February looks at
    28 February.
    """
    daily = _daily(df, date, value)
    before = daily.select(F.col(date).alias("__before"), F.col(value).alias(output))
    shifted = F.add_months(F.col(date).cast("date"), -12)
    return daily.join(before, shifted == F.col("__before").cast("date"), "left").drop("__before")


def _daily(df: DataFrame, date: str, value: str) -> DataFrame:
    return df.groupBy(date).agg(F.sum(value).alias(value))


def total_revenue(orders: DataFrame, by: list[str] = ()) -> DataFrame:
    return orders.groupBy(*by).agg(F.sum("OrderTotal").alias("TotalRevenue"))


def total_orders(orders: DataFrame, by: list[str] = ()) -> DataFrame:
    return orders.groupBy(*by).agg(F.count(F.lit(1)).alias("TotalOrders"))


def _divide(a: Column, b: Column) -> Column:
    """Quotient, 0 where it does not exist."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def average_order_value(orders: DataFrame, by: list[str] = ()) -> DataFrame:
    value = _divide(F.sum("OrderTotal"), F.count(F.lit(1)))
    return orders.groupBy(*by).agg(value.alias("AverageOrderValue"))


def ytd_revenue(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Year-to-date revenue for every date of the date dimension up to the last order."""
    return running_in_year(_on_dates(orders, dates), "Date", "Revenue", "YTDRevenue").drop("Revenue")


def yoy_growth(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Growth of each date's revenue over the same date one year earlier, 0 without a base."""
    compared = prior_year(_on_dates(orders, dates), "Date", "Revenue")
    growth = _divide(F.col("Revenue") - F.col("prior"), F.col("prior"))
    return compared.select("Date", F.coalesce(growth, F.lit(0.0)).alias("YoYGrowth"))


def _on_dates(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per date of the date dimension; dates without orders count 0."""
    daily = orders.groupBy(F.col("OrderDate").cast("date").alias("__day")).agg(
        F.sum("OrderTotal").alias("Revenue")
    )
    return (
        dates.select("Date")
        .join(daily, F.col("Date").cast("date") == F.col("__day"), "left")
        .select("Date", F.coalesce("Revenue", F.lit(0.0)).alias("Revenue"))
    )


def date_dimension(bounds: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """Date table for every day between ``start`` and ``end`` of the one-row ``bounds`` frame.

    The fiscal year is named by the calendar year in which it ends.
    """
    day = F.col("day")
    fiscal = F.year(day)
    if fiscal_start_month > 1:
        fiscal = fiscal + F.when(F.month(day) >= fiscal_start_month, 1).otherwise(0)
    return bounds.select(
        F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date"))).alias("day")
    ).select(
        day.cast("timestamp_ntz").alias("Date"),
        F.year(day).cast("long").alias("Year"),
        F.month(day).cast("long").alias("Month"),
        F.dayofmonth(day).cast("long").alias("Day"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("Quarter"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.date_format(day, "EEEE").alias("DayOfWeek"),
        F.dayofweek(day).isin(1, 7).alias("IsWeekend"),
        fiscal.cast("long").alias("FiscalYear"),
    )


def date_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def total_runs(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    return runs.groupBy(*by).agg(F.count(F.lit(1)).alias("TotalRuns"))


def success_rate(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Succeeded share of all runs, as a fraction."""
    done = F.count_if(F.upper("Status") == "SUCCEEDED")
    return runs.groupBy(*by).agg(_divide(done, F.count(F.lit(1))).alias("SuccessRate"))


def average_duration(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    return runs.groupBy(*by).agg(F.avg("DurationSeconds").alias("AvgDuration"))


def rows_processed(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    return runs.groupBy(*by).agg(F.sum("RowsRead").alias("RowsProcessed"))
