"""Lookups: attach the columns of a table with at most one row per key.

There is one plan at every size: a single join of the rows with the lookup table, both keys cast to their
common wider type. Spark broadcasts the lookup table where its estimated size is under the limit. Beyond
that the rows are shuffled by key, and rows of the heaviest keys are spread over several salts, with
their lookup rows repeated once per salt. The heaviest keys come from a bounded sketch and are collected
once, as at most ``MAX_HOT`` hashes; they decide how rows are spread and nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT = 10_000
SKETCH_ITEMS = 100_000
#: A key is heavy if it holds more than one row in so many.
HOT_SHARE = 2_000
#: Parts that the rows of a heavy key are spread over.
SALTS = 32

_HASH, _SALT = "__key_hash", "__salt"


def common_type(spark: SparkSession, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that both can be cast to without loss: text with anything is text, else Spark's wider type."""
    if a == b:
        return a
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType()
    nothing = [F.lit(None).cast(t) for t in (a, b)]
    return spark.range(0).select(F.coalesce(*nothing).alias("x")).schema["x"].dataType


def estimated_bytes(df: DataFrame) -> int:
    """Size estimate of the optimized plan, from file sizes and the pruned columns."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    number = text.lower().rstrip("b") or "0"
    return int(number[:-1]) * units[number[-1]] if number[-1] in units else int(number)


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df)


def heavy_keys(df: DataFrame, keys: list[Column]) -> list[int]:
    """Hashes of keys that hold more than one row in ``HOT_SHARE``, at most ``MAX_HOT``, from one bounded aggregate."""
    sketch = F.expr(f"approx_top_k({_HASH}, {MAX_HOT}, {SKETCH_ITEMS})").alias("top")
    rows = df.select(F.xxhash64(*keys).alias(_HASH)).agg(sketch, F.count(F.lit(1)).alias("rows"))
    found = rows.select("rows", F.inline("top")).where(F.col("count") * HOT_SHARE > F.col("rows"))
    return [r["item"] for r in found.where("count > 1").select("item").collect()]


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    payload: list[str],
    how: str = "left",
    null_safe: bool = False,
    always_split: bool = False,
) -> DataFrame:
    """Left rows with the ``payload`` columns of their ``right`` row.

    ``keys`` maps left columns to right columns; ``right`` holds at most one row per key, in the common
    type of both sides. ``how`` is ``left`` or ``inner``. ``null_safe`` lets null keys meet.
    ``always_split`` spreads heavy keys whatever the size, for tests.
    """
    spark = left.sparkSession
    names = {name: f"__lookup_{i}" for i, name in enumerate(keys)}
    kinds = {
        name: common_type(spark, left.schema[name].dataType, right.schema[other].dataType) for name, other in keys.items()
    }
    ours = [F.col(f"`{name}`").cast(kind) for name, kind in kinds.items()]
    table = right.select(
        *[F.col(f"`{other}`").cast(kinds[name]).alias(names[name]) for name, other in keys.items()], *payload
    )
    pairs = [(a.eqNullSafe if null_safe else a.__eq__)(F.col(n)) for a, n in zip(ours, names.values())]
    rows = left
    if always_split or not fits_broadcast(table):
        hot = heavy_keys(left, ours)
        if hot:
            heavy = F.xxhash64(*ours).isin(hot)
            spread = F.when(heavy, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(left)]), F.lit(SALTS)))
            rows = left.withColumn(_SALT, F.coalesce(spread, F.lit(0)).cast("int"))
            places = F.when(F.xxhash64(*names.values()).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1)))
            table = table.withColumn("__at", F.explode(F.coalesce(places, F.array(F.lit(0)))))
            pairs.append(F.col(_SALT) == F.col("__at"))
    joined = rows.join(table, _all_of(pairs), how)
    return joined.select(*[f"`{c}`" for c in left.columns], *[f"`{c}`" for c in payload])


def _hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed: all but those that hold maps."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def mark_known(
    df: DataFrame,
    column: str,
    reference: DataFrame,
    reference_column: str,
    flag: str,
    always_split: bool = False,
) -> DataFrame:
    """Boolean ``flag``: the value is not null and occurs in the reference column.

    Values are compared in their common type, and made distinct in it.
    """
    kind = common_type(df.sparkSession, df.schema[column].dataType, reference.schema[reference_column].dataType)
    known = (
        reference.select(F.col(f"`{reference_column}`").cast(kind).alias("__known"))
        .where(F.col("__known").isNotNull())
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    base = df.drop(flag)
    joined = lookup_join(base, known, {column: "__known"}, [flag], always_split=always_split)
    return joined.withColumn(flag, F.coalesce(F.col(f"`{flag}`"), F.lit(False)))


def mark_repeated(
    df: DataFrame, columns: list[str], flag: str, always_split: bool = False
) -> DataFrame:
    """Boolean ``flag``: the value occurs in more than one row; nulls count as one value.

    Counting comes first with partial sums, so a value held by a third of all rows never lands in
    one task.
    """
    repeated = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .withColumn(flag, F.lit(True))
    )
    base = df.drop(flag)
    joined = lookup_join(
        base, repeated, {c: c for c in columns}, [flag], null_safe=True, always_split=always_split
    )
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
