"""Column profiles of whole tables."""

from pyspark.sql import functions as F

from tessera.layout import Layout, read_table
from tessera.operators import profile, sinks
from tessera.session import scratch
from tessera.suite.inputs import table
from tessera.suite.registry import query

_SPARK_TYPES = {
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
}


def _per_column(columns, template, frm):
    parts = [
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, {template.format(c=c)} FROM {frm}"
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(parts)


_BASIC = (
    "count(*) AS total_rows, count(*) - count({c}) AS null_count, "
    "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_pct, "
    "count(DISTINCT {c}) AS distinct_count, "
    "round(count(DISTINCT {c}) * 100.0::DOUBLE / count(*), 2) AS distinct_pct"
)


@query("profile_basic", _per_column(_SPARK_TYPES["lineitem"], _BASIC, "lineitem"))
def profile_basic(spark, sf_dir):
    return profile.basic(table(spark, sf_dir, "lineitem"))


_NUMBERS = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}


@query(
    "profile_numeric",
    _per_column(
        _NUMBERS,
        "min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS mean, "
        "round(stddev_samp({c}), 4) AS stddev, quantile_disc({c}, 0.5)::DOUBLE AS median",
        "customer",
    ),
)
def profile_numeric(spark, sf_dir):
    """With the median's accuracy above the number of values at test size, so it is exact there."""
    return profile.numeric(table(spark, sf_dir, "customer"), 100_000)


_TEXTS = {"text": "string", "lang": "string", "source": "string"}


@query(
    "profile_string",
    _per_column(
        _TEXTS,
        "min(length({c})) AS min_len, max(length({c})) AS max_len, round(avg(length({c})), 2) AS avg_len",
        "documents",
    ),
)
def profile_string(spark, sf_dir):
    return profile.strings(table(spark, sf_dir, "documents"))


@query(
    "profile_datetime",
    "SELECT 'o_orderdate' AS column_name, 'timestamp_ntz' AS column_type, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date FROM orders",
)
def profile_datetime(spark, sf_dir):
    return profile.datetimes(table(spark, sf_dir, "orders"))


def _top(column):
    return f"""SELECT * FROM (SELECT '{column}' AS column_name, {column} AS value, count(*) AS "count" FROM part
                              GROUP BY {column} ORDER BY 3 DESC, 2 LIMIT 10)"""


@query("profile_top_values", " UNION ALL ".join(_top(c) for c in ("p_name", "p_brand", "p_type")))
def profile_top_values(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"))


_LINES = ["l_orderkey", "l_linenumber"]
_QUARTER = "substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) < '40000000'"


@query(
    "profile_sampled",
    _per_column(
        _SPARK_TYPES["lineitem"],
        _BASIC + ", (SELECT count(*) FROM lineitem) AS table_rows",
        f"(SELECT * FROM lineitem WHERE {_QUARTER})",
    ),
)
def profile_sampled(spark, sf_dir):
    return profile.sampled(table(spark, sf_dir, "lineitem"), 0.25, _LINES)


@query(
    "profile_basic_nested",
    _per_column({"vec_id": "bigint", "embedding": "array<float>", "label": "int"}, _BASIC, "embeddings"),
)
def profile_basic_nested(spark, sf_dir):
    return profile.basic(table(spark, sf_dir, "embeddings"))


_SKETCHED = {c: t for c, t in _SPARK_TYPES["lineitem"].items() if t in ("bigint", "int", "double")}


@query(
    "profile_sketched",
    _per_column(
        _SKETCHED,
        "count(*) AS total_rows, count(*) - count({c}) AS null_count, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
        "round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, TRUE AS distinct_close, TRUE AS median_close",
        "lineitem",
    ),
)
def profile_sketched(spark, sf_dir):
    """The profile of a table that came in three deliveries, from what was kept of each; estimates against exact values.

    Distinct counts within 4 %, five standard errors; the median's rank within 1 % of the middle.
    """
    rows = table(spark, sf_dir, "lineitem").select(*_SKETCHED)
    kept = Layout(scratch(spark, "lake"), "system", "profiles", "sketches")
    for number in (0, 1, 2, 1):  # a repeated delivery replaces itself
        part = rows.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(3)) == number)
        sinks.append(profile.sketch(part), kept, load=f"r{number}")
    found = profile.merged(read_table(spark, kept))
    exact = profile.basic(rows).select("column_name", F.col("distinct_count").alias("exact"))
    medians = {r["column_name"]: r["median"] for r in found.select("column_name", "median").collect()}
    total = F.count(F.lit(1))
    tests = [((F.count_if(F.col(c) < m) <= total * 0.51) & (F.count_if(F.col(c) <= m) >= total * 0.49)).alias(c) for c, m in medians.items()]
    close = rows.agg(*tests).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("median_close")) for c in medians])))
    found = found.join(exact, "column_name").join(close, "column_name")
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.04 * F.col("exact")
    return found.select(
        "column_name", "column_type", "total_rows", "null_count", "min", "max", "mean", "stddev",
        near.alias("distinct_close"), "median_close",
    )
