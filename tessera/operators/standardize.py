"""Projections, filters and value clean-up. Every function adds at most one projection."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import as_time, checked_arithmetic, span


def case(df: DataFrame, column: str, kind: str = "lower") -> DataFrame:
    """Lower or upper case; any other kind leaves the column as it is."""
    changes = {"lower": F.lower, "upper": F.upper}
    return df.withColumn(column, changes[kind](column)) if kind in changes else df


def trim(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.trim(column))


def phone(df: DataFrame, column: str) -> DataFrame:
    """Digits only."""
    return df.withColumn(column, _digits(column))


def date(df: DataFrame, column: str, format: str = "yyyy-MM-dd") -> DataFrame:
    """Parse a date; unparsable text becomes null."""
    return df.withColumn(column, _parse_date(column, format))


def timestamp(df: DataFrame, column: str) -> DataFrame:
    """Parse a timestamp; unparsable text becomes null."""
    return df.withColumn(column, F.try_to_timestamp(column))


def _digits(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _parse_date(column: str, format: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(F.col(column).cast("string"), F.lit(format)).cast("date")


# Kinds accepted by the standardization maps; "regex" is the silver-layer name of "phone".
KINDS = {
    "lower": F.lower,
    "upper": F.upper,
    "trim": F.trim,
    "phone": _digits,
    "regex": _digits,
    "date": _parse_date,
    "timestamp": F.try_to_timestamp,
}


def apply(df: DataFrame, config: dict[str, str]) -> DataFrame:
    """Apply a ``{column: kind}`` map in one projection; absent columns and unknown kinds are skipped."""
    changes = {c: KINDS[k](c) for c, k in config.items() if c in df.columns and k in KINDS}
    return df.withColumns(changes) if changes else df


def null_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    changes = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    return df.withColumns(changes) if changes else df


def safe_cast(df: DataFrame, column: str, target: str) -> DataFrame:
    """Cast to a named type; values that do not convert become null."""
    return df.withColumn(column, F.col(column).try_cast(target))


def replace_values(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Exact-value replacement."""
    result = F.col(column)
    for old, new in mapping.items():
        result = F.when(F.col(column) == F.lit(old), F.lit(new)).otherwise(result)
    return df.withColumn(column, result)


def change_type(df: DataFrame, column: str, target: str = "string") -> DataFrame:
    return df.withColumn(column, F.col(column).cast(target))


def after_delimiter(df: DataFrame, column: str, delimiter: str, output: str) -> DataFrame:
    """Text after the first delimiter; without one, empty text."""
    position = F.locate(delimiter, F.col(column))
    rest = F.substring(F.col(column), position + F.lit(len(delimiter)), F.length(column))
    value = F.when(position > 0, rest).when(F.col(column).isNotNull(), F.lit(""))
    return df.withColumn(output, value)


def clean_names(df: DataFrame, name: str = "CustomerName", email: str = "Email") -> DataFrame:
    """Low-code name flow: placeholder names to ``Unknown``, trim, e-mail as text, e-mail domain."""
    df = replace_values(df, name, {"NULL": "Unknown", "": "Unknown"})
    df = change_type(trim(df, name), email)
    return after_delimiter(df, email, "@", "EmailDomain")


def infer_json_schema(df: DataFrame, column: str) -> str:
    """Schema of the JSON text in a column, as DDL.

    One aggregate over all rows merges the field types inside the JVM; the driver gets one string.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema")).first()["schema"]
    if found is None or not found.startswith("OBJECT"):
        return "STRUCT<>"
    ddl = re.sub(r"DECIMAL\(\d+,\d*[1-9]\d*\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    return re.sub(r"DECIMAL\(\d+,0\)", "BIGINT", ddl).replace("VOID", "STRING")


def json_flatten(df: DataFrame, column: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Parse a JSON text column and promote its first-level fields; same-named columns are replaced.

    Give the schema in repeated jobs: inferring it costs a pass over the column.
    """
    if schema is None:
        schema = infer_json_schema(df, column)
    parsed = df.withColumn("__parsed", F.from_json(column, schema))
    fields = parsed.schema["__parsed"].dataType.fieldNames()
    return parsed.withColumns({name: F.col("__parsed").getField(name) for name in fields}).drop("__parsed")


def calculated_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Computed columns from SQL arithmetic over existing columns; an unknown column is an error."""
    return df.withColumns({name: F.expr(checked_arithmetic(text)) for name, text in expressions.items()})


_PARTS = {"Year": F.year, "Month": F.month, "Day": F.dayofmonth, "Quarter": F.quarter}


def date_parts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Year, Month, Day and Quarter of the given columns, by default of every date or time column."""
    if columns is None:
        times = (T.DateType, T.TimestampType, T.TimestampNTZType)
        columns = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, times) and not f.name.startswith("_")
        ]
    parts = {f"{c}{part}": make(c) for c in columns for part, make in _PARTS.items()}
    return df.withColumns(parts) if parts else df


def current_rows(df: DataFrame, flag: str = "IsCurrent") -> DataFrame:
    """Current type-2 rows; a table without the flag passes unchanged."""
    return df.where(F.col(flag)) if flag in df.columns else df


def keep_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows meeting a condition; serves batch and streaming frames."""
    return df.where(condition)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The mapped fields only, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def recent(df: DataFrame, column: str, window: str, as_of) -> DataFrame:
    """Rows newer than ``as_of`` minus the window, compared on the bare column so it is pushed down."""
    return df.where(F.col(column) > as_time(as_of) - span(window))


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def secure_rows(df: DataFrame, predicate: str | Column) -> DataFrame:
    """The rows a role may see."""
    return df.where(predicate)


def secure_columns(df: DataFrame, hidden: list[str]) -> DataFrame:
    """The table without the columns hidden from a role."""
    return df.drop(*hidden)
