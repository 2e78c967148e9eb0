"""Column profiles, one row per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import as_time
from tessera.operators.aggregates import sample_fraction

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


#: Text from this length on is counted by its digest.
LONG_TEXT = 64


def _countable(f: T.StructField) -> Column:
    """The value itself, or a digest of 256 bits for long text and nested values, so that shuffled rows stay short."""
    value = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.StringType):
        return F.when(F.length(value) < LONG_TEXT, F.concat(F.lit("="), value)).otherwise(F.sha2(value, 256))
    if isinstance(f.dataType, T.MapType):
        value = F.sort_array(F.map_entries(value))
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.when(value.isNotNull(), F.sha2(F.to_json(F.struct(value.alias("v"))), 256))
    return value


def _fields(df: DataFrame, kinds) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _unpivot(row: DataFrame, fields: list[T.StructField], stats: list[str]) -> DataFrame:
    """One row per column from the one-row aggregate with columns ``<i>_<stat>``."""
    structs = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            *[F.col(f"{i}_{s}").alias(s) for s in stats],
        )
        for i, f in enumerate(fields)
    ]
    return row.select("total_rows", F.inline(F.array(*structs)))


def _profile(df: DataFrame, fields: list[T.StructField], stats: dict) -> DataFrame:
    aggregates = [
        make(F.col(f"`{f.name}`")).alias(f"{i}_{name}")
        for i, f in enumerate(fields)
        for name, make in stats.items()
    ]
    row = df.agg(F.count(F.lit(1)).alias("total_rows"), *aggregates)
    return _unpivot(row, fields, list(stats))


def _share(part: str) -> Column:
    share = F.round(F.try_divide(F.col(part) * 100.0, F.col("total_rows")), 2)
    return F.coalesce(share, F.lit(0.0))


def _value_counts(df: DataFrame, f: T.StructField) -> DataFrame:
    """Rows, nulls and distinct values of one column, from the number of rows per value."""
    value = _countable(f)
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    per_value = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(nulls, F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
    ).select(
        F.lit(f.name).alias("column_name"),
        F.lit(f.dataType.simpleString()).alias("column_type"),
        "*",
    )


def basic(df: DataFrame) -> DataFrame:
    """Type, nulls and exact distinct values of every column, with percentages of the profiled rows.

    Each column is read and counted by value on its own, all in one job: the scans together read the
    table once, rows stay one value wide, and a frequent value is summed inside the tasks.
    """
    parts = [_value_counts(df, f) for f in df.schema.fields]
    if not parts:
        nothing = "column_name string, column_type string, total_rows long, null_count long, distinct_count long"
        parts = [df.sparkSession.createDataFrame([], nothing)]
    return reduce(DataFrame.unionByName, parts).select(
        "column_name",
        "column_type",
        "total_rows",
        "null_count",
        _share("null_count").alias("null_pct"),
        "distinct_count",
        _share("distinct_count").alias("distinct_pct"),
    )


def numeric(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Minimum, maximum, mean, standard deviation and approximate median of the numeric columns."""
    stats = {
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
        "mean": lambda c: F.round(F.avg(c).cast("double"), 4),
        "stddev": lambda c: F.round(F.stddev(c), 4),
        "median": lambda c: F.percentile_approx(c, 0.5, accuracy).cast("double"),
    }
    return _profile(df, _fields(df, T.NumericType), stats).drop("total_rows")


def strings(df: DataFrame) -> DataFrame:
    """Minimum, maximum and average length of the text columns."""
    stats = {
        "min_len": lambda c: F.min(F.length(c)),
        "max_len": lambda c: F.max(F.length(c)),
        "avg_len": lambda c: F.round(F.avg(F.length(c)), 2),
    }
    return _profile(df, _fields(df, T.StringType), stats).drop("total_rows")


def datetimes(df: DataFrame) -> DataFrame:
    """Earliest and latest value of the date and time columns."""
    stats = {
        "min_date": lambda c: F.min(c).cast("timestamp_ntz"),
        "max_date": lambda c: F.max(c).cast("timestamp_ntz"),
    }
    return _profile(df, _fields(df, _TIMES), stats).drop("total_rows")


def top_values(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of every text column, ties by value.

    Values are counted per column before they are ranked, and the rank filter keeps ``k`` rows per
    column in every task.
    """
    names = [f.name for f in _fields(df, T.StringType)]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("value")) for n in names]
    )
    counts = (
        df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    window = Window.partitionBy("column_name").orderBy(F.desc("count"), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).drop("rank")


def sampled(df: DataFrame, fraction: float, keys: list[str]) -> DataFrame:
    """Basic profile of a sample by key, see ``sample_fraction``.

    Percentages are of the sampled rows; ``table_rows`` is the full count.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    return basic(sample_fraction(df, fraction, keys)).withColumn("table_rows", total)


def full(df: DataFrame, k: int = 10) -> DataFrame:
    """Basic profile with the statistics of each type and the most frequent texts, one row per column."""
    result = basic(df)
    for part, kinds in ((numeric, T.NumericType), (strings, T.StringType), (datetimes, _TIMES)):
        if _fields(df, kinds):
            result = result.join(part(df).drop("column_type"), "column_name", "left")
    if _fields(df, T.StringType):
        ranked = F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), "value")))
        top = F.to_json(F.transform(ranked, lambda x: F.struct(x["value"].alias("value"), (-x["n"]).alias("count"))))
        result = result.join(top_values(df, k).groupBy("column_name").agg(top.alias("top_values")), "column_name", "left")
    return result


# --- profiles of growing tables --------------------------------------------------------------------

#: Size of distinct-count sketches, as a power of two: a standard error of 1.04 / sqrt(2^14), 0.8 %.
HLL_SIZE = 14
#: Size of quantile sketches: ranks are within some 0.4 %.
KLL_SIZE = 800
#: Values that a top-value sketch keeps track of; counts are exact while a column has no more different ones.
TOP_ITEMS = 10_000

SKETCH = "total_rows", "null_count", "distinct", "min", "max", "mean", "m2", "quantiles", "shortest", "longest", "chars"


def sketch(df: DataFrame) -> DataFrame:
    """One row per column: counts, extremes and moments, and mergeable sketches of distinct values and quantiles.

    Rows of several deliveries together, see ``merged``, give the profile of their rows without reading them
    again. Columns have the same types whatever the table's are, so all tables fit into one.
    """

    def only(kinds, make, kind: str):
        return lambda f: make(F.col(f"`{f.name}`")).cast(kind) if isinstance(f.dataType, kinds) else F.lit(None).cast(kind)

    numbers, texts = T.NumericType, T.StringType
    stats = {
        "null_count": lambda f: F.count_if(F.col(f"`{f.name}`").isNull()),
        "distinct": lambda f: F.hll_sketch_agg(F.when(F.col(f"`{f.name}`").isNotNull(), F.xxhash64(_countable(f))), HLL_SIZE),
        "min": only(numbers, F.min, "double"),
        "max": only(numbers, F.max, "double"),
        "mean": only(numbers, F.avg, "double"),
        "m2": only(numbers, lambda c: F.var_pop(c) * F.count(c), "double"),
        "quantiles": only(numbers, lambda c: F.kll_sketch_agg_double(c.cast("double"), KLL_SIZE), "binary"),
        "shortest": only(texts, lambda c: F.min(F.length(c)), "long"),
        "longest": only(texts, lambda c: F.max(F.length(c)), "long"),
        "chars": only(texts, lambda c: F.sum(F.length(c)), "long"),
    }
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, T.NullType)]
    columns = [make(f).alias(f"{i}_{name}") for i, f in enumerate(fields) for name, make in stats.items()]
    found = _unpivot(df.agg(F.count(F.lit(1)).alias("total_rows"), *columns), fields, list(stats))
    return found.select("column_name", "column_type", *SKETCH)


def top_sketch(df: DataFrame) -> DataFrame:
    """One row per text column: how often its values occur, for the ``TOP_ITEMS`` most frequent of the delivery at least.

    Values are counted before they are cut, so a column with no more different ones is kept whole.
    """
    return top_values(df, TOP_ITEMS)


def merged(sketches: DataFrame) -> DataFrame:
    """The profile of all rows behind kept sketches: exact but for ``distinct_count`` and ``median``."""
    present = F.col("total_rows") - F.col("null_count")
    moments = F.collect_list(F.when(F.col("mean").isNotNull(), F.struct(present.cast("double").alias("n"), "mean", "m2")))
    rows = sketches.groupBy("column_name", "column_type").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        moments.alias("moments"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.min("shortest").alias("min_len"),
        F.max("longest").alias("max_len"),
        F.sum("chars").alias("chars"),
    )
    n = F.aggregate("moments", F.lit(0.0), lambda a, m: a + m["n"])
    mean = F.try_divide(F.aggregate("moments", F.lit(0.0), lambda a, m: a + m["n"] * m["mean"]), n)
    rows = rows.withColumns({"n": n, "mean": mean})
    spread = F.aggregate("moments", F.lit(0.0), lambda a, m: a + m["m2"] + m["n"] * (m["mean"] - F.col("mean")) ** 2)
    median = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5)))
    return rows.select(
        "column_name",
        "column_type",
        "total_rows",
        "null_count",
        _share("null_count").alias("null_pct"),
        "distinct_count",
        "min",
        "max",
        F.round("mean", 4).alias("mean"),
        F.round(F.sqrt(F.try_divide(spread, F.col("n") - 1)), 4).alias("stddev"),
        median.alias("median"),
        "min_len",
        "max_len",
        F.round(F.try_divide(F.col("chars"), F.col("total_rows") - F.col("null_count")), 2).alias("avg_len"),
    )


def merged_top(counts: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent values over several deliveries' ``top_sketch`` rows."""
    sums = counts.groupBy("column_name", "value").agg(F.sum("count").alias("count"))
    window = Window.partitionBy("column_name").orderBy(F.desc("count"), F.col("value"))
    return sums.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).drop("rank")


def stamped(profile: DataFrame, lakehouse: str, schema: str, table: str, as_of) -> DataFrame:
    """Profile rows as they are kept: with address and run time."""
    return profile.select(
        as_time(as_of).alias("profile_timestamp"),
        F.lit(lakehouse).alias("lakehouse"),
        F.lit(schema).alias("schema"),
        F.lit(table).alias("table"),
        "*",
    )
