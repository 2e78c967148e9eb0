"""Watermark filters and the next watermark."""

from datetime import datetime

import pytest

from tessera.operators import incremental
from tests.conftest import rows


def sample(spark):
    data = [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 12:30:45.123"), (3, "2024-01-03 00:00:00")]
    return spark.createDataFrame(data, "id int, at string").selectExpr("id", "cast(at as timestamp_ntz) at", "cast(at as date) day", "at text")


@pytest.mark.parametrize(
    "column, value, kind, expected",
    [
        (None, "5", "int", [1, 2, 3]),
        ("id", None, "int", [1, 2, 3]),
        ("id", "", "int", [1, 2, 3]),
        ("id", "1", "bigint", [2, 3]),
        ("id", "2", "SMALLINT", [3]),
        ("at", "2024-01-01", "datetime", [2, 3]),
        ("at", "2024-01-02 12:30:45.123", "timestamp", [3]),
        ("day", "2024-01-01", "date", [2, 3]),
        ("text", "2024-01-02", "text", [2, 3]),
        ("text", "2024-01-02", "datetime", [2, 3]),
    ],
)
def test_filter_above(spark, column, value, kind, expected):
    found = incremental.filter_above(sample(spark), column, value, kind)
    assert sorted(r["id"] for r in found.collect()) == expected


def test_invalid_number_is_an_error(spark):
    with pytest.raises(ValueError):
        incremental.filter_above(sample(spark), "id", "x", "int")


def test_lookback_reads_late_rows_again(spark):
    found = incremental.filter_above(sample(spark), "at", "2024-01-03 00:00:00", "datetime", "1 day")
    assert sorted(r["id"] for r in found.collect()) == [2, 3]


def test_clause_and_watermark(spark):
    both = incremental.filter_with_clause(sample(spark), "id < 3", "at", "2024-01-01", "datetime")
    assert [r["id"] for r in both.collect()] == [2]
    assert incremental.filter_with_clause(sample(spark), None).count() == 3


def test_watermark_text(spark):
    df = sample(spark)
    assert incremental.max_watermark(df.where("id < 3"), "at").first()[0] == "2024-01-02 12:30:45.123"
    assert incremental.max_watermark(df, "id").first()[0] == "3"
    assert incremental.max_watermark(df, "day").first()[0] == "2024-01-03"
    assert incremental.max_watermark(df.limit(0), "at", "before").first()[0] == "before"
    assert incremental.max_watermark(df, "absent", "before").first()[0] == "before"
    assert incremental.max_watermark(df, None).first()[0] is None


def test_filter_reaches_the_scan(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_orderdate")
    found = incremental.filter_above(orders, "o_orderdate", "1999-01-01", "datetime")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1999-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_last_watermark(spark):
    runs = spark.createDataFrame(
        [
            (1, "a", "SUCCEEDED", datetime(2024, 1, 1), "w1"),
            (1, "b", "Succeeded", datetime(2024, 1, 2), "w2"),
            (1, "c", "FAILED", datetime(2024, 1, 3), "w3"),
            (2, "d", "RUNNING", None, None),
        ],
        "EntityId int, EntityRunId string, Status string, EndTime timestamp, WatermarkAfter string",
    )
    assert rows(incremental.last_watermark(runs)) == [(1, "w2")]
