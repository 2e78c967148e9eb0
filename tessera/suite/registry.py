"""Registration of queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame, with_nulls: tuple[str, ...] = (), as_text: tuple[str, ...] = ()) -> DataFrame:
    """Columns in the few types both engines share: long, double, text, boolean, timestamp.

    Whole numbers that may be null come out as doubles, and ``as_text`` columns as text, since other
    tools that compare results have no place for such nulls or for times of the year 9999.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in as_text:
            is_time = isinstance(f.dataType, T.TimestampNTZType)
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") if is_time else c.cast("string")
        elif f.name in with_nulls:
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _plain_sql(sql: str, with_nulls: tuple[str, ...], as_text: tuple[str, ...]) -> str:
    """The comparison SQL with the same two conversions."""
    changes = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in with_nulls]
    for c in as_text:
        text = f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S.%g')" if c == "ValidTo" else f'CAST("{c}" AS VARCHAR)'
        changes.append(f'{text} AS "{c}"')
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({sql})" if changes else sql


def query(
    key: str,
    sql: str | None = None,
    with_nulls: tuple[str, ...] = (),
    as_text: tuple[str, ...] = (),
) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows in ANSI SQL."""

    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(make(spark, sf_dir), with_nulls, as_text)

        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = _plain_sql(sql, with_nulls, as_text)
        return make

    return register
