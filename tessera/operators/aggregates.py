"""Grouped aggregates, rankings, samples. All of them combine inside tasks before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import percent
from tessera.plans.lookup import lookup_join

FUNCTIONS = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min}


def grouped(df: DataFrame, group: list[str], specs: list[dict]) -> DataFrame:
    """Aggregates from ``{function, column, alias}`` specs; incomplete or unknown ones are skipped.

    Without any aggregate or grouping column the rows pass unchanged.
    """
    columns = [
        FUNCTIONS[s.get("function", "sum")](s["column"]).alias(s["alias"])
        for s in specs
        if s.get("column") and s.get("alias") and s.get("function", "sum") in FUNCTIONS
    ]
    return df.groupBy(*group).agg(*columns) if columns and group else df


def distinct_count(df: DataFrame, column: str, by: list[str] = (), output: str = "n") -> DataFrame:
    """Exact distinct count: values are made distinct per group before the groups are counted."""
    return df.groupBy(*by).agg(F.count_distinct(column).alias(output))


def dcount(
    df: DataFrame, column: str, by: list[str] = (), exact: bool = True, output: str = "n"
) -> DataFrame:
    """Distinct count, exact in batch jobs, by a fixed-size sketch where a stream needs it."""
    count = F.count_distinct(column) if exact else F.approx_count_distinct(column)
    return df.groupBy(*by).agg(count.alias(output))


def countif(df: DataFrame, predicate: Column | str, by: list[str] = ()) -> DataFrame:
    """Rows meeting a condition and their share in per cent."""
    test = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.groupBy(*by).agg(
        F.count_if(test).alias("n"), percent(F.count_if(test), F.count(F.lit(1))).alias("rate")
    )


def arg_max(df: DataFrame, maximise: str, by: list[str], output: str = "top") -> DataFrame:
    """Largest value of ``maximise`` per group, as the event store's one-argument form returns it."""
    return df.groupBy(*by).agg(F.max(maximise).alias(output))


def most_frequent(df: DataFrame, column: str, by: list[str], output: str = "top") -> DataFrame:
    """Most frequent value per group, ties by name. Values are counted first, then compared."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("order"), F.col(column).alias("value")))
    return counts.groupBy(*by).agg(best.alias("__best")).select(*by, F.col("__best.value").alias(output))


def stddev(df: DataFrame, column: str, by: list[str] = (), output: str = "stddev") -> DataFrame:
    """Sample standard deviation."""
    return df.groupBy(*by).agg(F.stddev(column).alias(output))


def median(
    df: DataFrame, column: str, by: list[str] = (), accuracy: int = 10_000, output: str = "median"
) -> DataFrame:
    """Approximate median with bounded memory: the rank is off by at most 1/accuracy of the rows."""
    return df.groupBy(*by).agg(F.percentile_approx(column, 0.5, accuracy).alias(output))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def partition_count(df: DataFrame, keys: list[str], output: str = "n", always_split: bool = False) -> DataFrame:
    """Every row with the number of rows sharing its key.

    Counts are built with partial sums and looked up, instead of gathering each key in one window
    task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))
    return lookup_join(df, counts, {k: k for k in keys}, [output], null_safe=True, always_split=always_split)


def sorted_by(df: DataFrame, order: dict[str, str]) -> DataFrame:
    """Rows in a total order: ``{column: asc or desc}``, ties by the remaining columns.

    The remaining columns also let Spark cut a frequent sort value into several ranges.
    """
    columns = [F.desc(c) if way == "desc" else F.asc(c) for c, way in order.items()]
    return df.orderBy(*columns, *[F.asc(c) for c in df.columns if c not in order])


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column).limit(k)


def sample_fraction(df: DataFrame, fraction: float, keys: list[str]) -> DataFrame:
    """The rows whose key falls into the given share of all digests.

    The choice depends on the key alone, so it is the same in every run, engine and cut of the data, and
    rows of one key stay together.
    """
    digest = F.substring(F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys]).cast("binary")), 1, 8)
    return df if fraction >= 1 else df.where(digest < f"{int(max(fraction, 0) * 2**32):08x}")
