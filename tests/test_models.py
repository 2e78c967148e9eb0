"""Gold models, aggregates, measures, profiles and run history on small frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera.config import Model, Transformation
from tessera.operators import aggregates, dedup, gold, joins, measures, observe, profile, silver
from tests.conftest import rows

AT = "2024-01-01 00:00:00"


def test_join_key_is_given_or_common(spark):
    fact = spark.sql("SELECT 1 AS id, 10 AS k, 'f' AS name, 'a' AS _silver_run_id")
    dim = spark.sql("SELECT 'b' AS _silver_run_id, 10 AS k, 'd' AS name, 'x' AS extra")
    assert joins.common_key(fact, dim) == "k"
    found = joins.join_dimension(fact, dim, "dim")
    assert found.columns == ["k", "id", "name", "_silver_run_id", "dim_name", "extra"]
    assert joins.join_dimension(fact, spark.sql("SELECT 1 AS z"), "dim") is fact
    none = joins.join_dimension(fact, dim.where("k = 0"), "dim", "k", "inner")
    assert none.count() == 0


def test_fact_uses_current_rows_and_computes(spark):
    orders = spark.sql("SELECT 1 AS OrderID, 7 AS CustomerID, 2.0D AS UnitPrice, 3.0D AS Quantity, 1.0D AS Discount, DATE'2024-05-06' AS OrderDate")
    customers = spark.sql("SELECT 7 AS CustomerID, 'old' AS Segment, false AS IsCurrent UNION ALL SELECT 7, 'new', true")
    model = Model("f", "FACT", ("orders", "dim"), calculated={"Total": "UnitPrice * Quantity - Discount", "Skipped": "SUM(Total)"})
    row = gold.build({"orders": orders, "dim": customers}, model, "r", AT).first()
    assert (row["Segment"], row["Total"], row["OrderDateQuarter"], row["_gold_model_name"]) == ("new", 5.0, 2, "f")
    assert "Skipped" not in row.asDict()
    bad = Model("f", "FACT", ("orders",), calculated={"x": "Missing * 2"})
    with pytest.raises(Exception):
        gold.build({"orders": orders}, bad, "r", AT)
    with pytest.raises(ValueError):
        gold.build({"orders": orders}, Model("f", "CUBE", ("orders",)), "r", AT)


def test_measure_texts(spark):
    df = spark.sql("SELECT 1 AS g, 2 AS v UNION ALL SELECT 1, 2 UNION ALL SELECT 1, NULL")
    specs = {"s": "SUM(v)", "c": "count(v)", "d": "COUNT(DISTINCT v)", "a": "AVG( v )"}
    row = gold.aggregate({"t": df}, Model("m", "AGGREGATE", ("t",), ("g",), specs), "r", AT).first()
    assert (row["s"], row["c"], row["d"], row["a"]) == (4, 2, 1, 2.0)
    with pytest.raises(ValueError):
        gold.measure("MEDIAN(v)")


def test_build_order():
    models = [Model("c", "FACT", (), depends_on=("b",), priority=1), Model("b", "FACT", (), depends_on=("a", "outside"), priority=2), Model("a", "FACT", (), priority=3)]
    assert [m.name for m in gold.build_order(models)] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        gold.build_order([Model("a", "FACT", (), depends_on=("b",)), Model("b", "FACT", (), depends_on=("a",))])


def test_config_rows():
    row = {"ModelName": "m", "ModelType": "FACT", "SourceTables": '["a","b"]', "GrainColumns": "x, y", "CalculatedColumns": None, "DependencyModels": '["d"]', "Priority": 2}
    model = Model.from_row(row)
    assert (model.sources, model.grain, model.calculated, model.depends_on) == (("a", "b"), ("x", "y"), {}, ("d",))
    row = {"TransformationId": 1, "EntityId": 2, "TransformationType": "SCD2", "TransformationLogicJson": '{"scd2_columns":["a"]}', "BusinessKeyColumns": "k1, k2"}
    step = Transformation.from_row(row)
    assert step.business_keys == ("k1", "k2") and silver.scd_names(step.logic).valid_from == "ValidFrom"


def test_latest_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "c")], "k int, o int, v string")
    assert rows(dedup.latest(df, ["k"], [F.col("o").desc()])) == [(1, 5, "a"), (2, None, "c")]
    plan = dedup.latest(df, ["k"], [F.col("o").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_silver_aggregate_without_config_passes_rows(spark):
    df = spark.range(3).toDF("a")
    assert silver.aggregate(df, {}, AT).count() == 3
    step = Transformation(1, 1, "STANDARDIZATION", {"null_defaults": {"a": 0}})
    assert "_silver_run_id" in silver.dispatch(df, step, as_of=AT).columns


def test_most_frequent_and_counts(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "z"), (2, "y"), (None, "q")], "g int, v string")
    assert rows(aggregates.most_frequent(df, "v", ["g"])) == [(1, "b"), (2, "y"), (None, "q")]
    assert sorted(r["n"] for r in aggregates.partition_count(df, ["g"]).collect()) == [1, 2, 2, 3, 3, 3]
    assert aggregates.dcount(df, "v", exact=False).first()["n"] == 5
    assert [r["v"] for r in aggregates.top_values(df, "v", 2).collect()] == ["b", "a"]


def test_sample_is_a_repeatable_subset(spark):
    df = spark.range(10_000)
    one, two = (aggregates.sample_fraction(d, 0.1, ["id"]) for d in (df, df.repartition(7)))
    assert rows(one) == rows(two) and 800 < one.count() < 1200
    assert one.dropDuplicates().count() == one.count() == one.join(df, "id", "left_semi").count()
    assert aggregates.sample_fraction(df, 2, ["id"]).count() == 10_000


def test_sorted_is_total_and_spread(spark):
    df = spark.range(100).select(F.lit(1).alias("p"), (99 - F.col("id")).alias("id"))
    assert [r["id"] for r in aggregates.sorted_by(df, {"p": "desc"}).collect()] == list(range(100))


def test_leap_day_and_gaps_in_year_comparison(spark):
    data = [("2023-02-28", 10.0), ("2024-02-28", 20.0), ("2024-02-29", 30.0), ("2024-03-05", 5.0)]
    df = spark.createDataFrame(data, "d string, v double").select(F.col("d").cast("date").alias("d"), "v")
    prior = {str(r["d"]): r["prior"] for r in measures.prior_year(df, "d", "v").collect()}
    assert prior == {"2023-02-28": None, "2024-02-28": 10.0, "2024-02-29": 10.0, "2024-03-05": None}
    ytd = {str(r["d"]): r["ytd"] for r in measures.running_in_year(df, "d", "v").collect()}
    assert ytd == {"2023-02-28": 10.0, "2024-02-28": 20.0, "2024-02-29": 50.0, "2024-03-05": 55.0}


def test_measures_of_nothing(spark):
    none = spark.createDataFrame([], "OrderTotal double, OrderDate date")
    assert measures.average_order_value(none).first()[0] == 0.0
    assert measures.success_rate(spark.createDataFrame([], "Status string")).first()[0] == 0.0


def test_date_dimension(spark):
    days = measures.date_dimension(measures.date_bounds(spark, "2024-06-29", "2024-07-01"), 7)
    assert [(r["Day"], r["DayOfWeek"], r["IsWeekend"], r["FiscalYear"], r["Quarter"]) for r in days.orderBy("Date").collect()] == [
        (29, "Saturday", True, 2024, "Q2"),
        (30, "Sunday", True, 2024, "Q2"),
        (1, "Monday", False, 2025, "Q3"),
    ]


def test_profile_keeps_zero_and_counts_nulls(spark):
    df = spark.sql("SELECT cast(x AS smallint) AS x, s FROM VALUES (1, 'a'), (-1, 'bb'), (NULL, NULL) AS t(x, s)")
    basic = {r["column_name"]: r for r in profile.basic(df).collect()}
    assert (basic["x"]["null_count"], basic["x"]["distinct_count"], basic["x"]["null_pct"]) == (1, 2, 33.33)
    numbers = profile.numeric(df).first()
    assert (numbers["column_name"], numbers["mean"], numbers["min"]) == ("x", 0.0, -1.0)
    assert profile.strings(df).first()["avg_len"] == 1.5
    assert profile.full(df).count() == 2
    empty = {r["column_name"]: tuple(r)[2:] for r in profile.basic(df.limit(0)).collect()}
    assert empty["x"] == (0, 0, 0.0, 0, 0.0)


def test_sampled_profile_uses_the_sampled_rows(spark):
    df = spark.range(5_000).select(F.col("id"), F.lit(None).cast("string").alias("n"))
    found = {r["column_name"]: r for r in profile.sampled(df, 0.1, ["id"]).collect()}
    assert found["n"]["null_pct"] == 100.0 and found["id"]["distinct_pct"] == 100.0
    assert 350 < found["id"]["total_rows"] < 650 and found["id"]["table_rows"] == 5_000


def test_profile_covers_every_kind_of_column(spark):
    df = spark.sql(
        "SELECT array(1, 2) AS a, map('k', 1) AS m, struct(1 AS x) AS s, repeat('t', 500) AS t UNION ALL "
        "SELECT array(1, 2), map('k', 2), NULL, repeat('t', 501)"
    )
    found = {r["column_name"]: (r["null_count"], r["distinct_count"]) for r in profile.basic(df).collect()}
    assert found == {"a": (0, 1), "m": (0, 2), "s": (1, 1), "t": (0, 2)}
    assert profile.basic(df.select()).count() == 0
    assert "top_values" in profile.full(df).columns


def test_run_fold_and_durations(spark):
    def event(kind, at, status, read=None, error=None, after=None):
        return ("pipeline", "r", None, "p", kind, datetime.fromisoformat(at), status, read, None, None, None, after, error)

    schema = (
        "RunKind string, RunId string, ParentRunId string, Name string, EventType string, EventTime timestamp, Status string, "
        "RowsRead long, RowsWritten long, RowsRejected long, WatermarkBefore string, WatermarkAfter string, ErrorMessage string"
    )
    events = spark.createDataFrame(
        [event("start", "2024-01-01 00:00:00", "RUNNING"), event("end", "2024-01-01 00:01:00", "FAILED", 5, "boom", "w"), event("end", "2024-01-01 00:02:00", "SUCCEEDED")],
        schema,
    )
    run = observe.fold_runs(events).first()
    assert (run["Status"], run["RowsRead"], run["ErrorMessage"], run["WatermarkAfter"]) == ("SUCCEEDED", 5, None, None)
    open_run = observe.with_duration(observe.fold_runs(events.where("EventType = 'start'")), "2024-01-01 00:00:30").first()
    assert (open_run["Status"], open_run["DurationSeconds"]) == ("RUNNING", 30)


def test_kpi_thresholds(spark):
    values = [("Pipeline Success Rate", 94.0), ("Avg Pipeline Duration", 45.0), ("Failed Entities/Day", 0.0), ("Capacity Utilization", None)]
    found = {r["metric"]: (r["on_target"], r["alert"]) for r in observe.check_kpis(spark.createDataFrame(values, "metric string, value double")).collect()}
    assert found == {
        "Pipeline Success Rate": (False, True),
        "Avg Pipeline Duration": (False, False),
        "Failed Entities/Day": (True, False),
        "Capacity Utilization": (None, None),
    }


def test_sketched_profile_is_close_and_the_same_for_any_deliveries(spark):
    from tessera.operators import profile

    df = spark.range(20_000).select(
        (F.col("id") % 3000).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") * 1e9 + 0.5).alias("b"),
        F.concat(F.lit("v"), F.floor(F.sqrt(F.col("id")))).alias("c"), F.lit(None).cast("string").alias("d"), F.array("id").alias("e"),
    )
    exact = {r.column_name: r for r in profile.full(df).collect()}
    for cuts in (1, 5):
        part = F.pmod(F.xxhash64("a", "c"), F.lit(cuts))
        kept = [profile.sketch(df.where(part == i)) for i in range(cuts)] + [profile.sketch(df.limit(0))]
        sketches = kept[0]
        for k in kept[1:]:
            sketches = sketches.unionByName(k)
        found = {r.column_name: r for r in profile.merged(sketches).collect()}
        assert set(found) == set("abcde")
        for name, r in found.items():
            e = exact[name]
            assert (r.total_rows, r.null_count, r.min_len, r.max_len, r.avg_len) == (20_000, e.null_count, e.min_len, e.max_len, e.avg_len)
            assert (r.min, r.max) == (e.min, e.max)
            assert abs(r.distinct_count - e.distinct_count) <= 0.04 * e.distinct_count
            if e.mean is not None:
                assert abs(r["mean"] - e["mean"]) <= 1e-9 * abs(e["mean"]) and abs(r.stddev - e.stddev) <= 1e-9 * e.stddev
                assert abs(r.median - e.median) <= 0.02 * e.max
        tops = profile.top_sketch(df.where(part == 0))
        for i in range(1, cuts):
            tops = tops.unionByName(profile.top_sketch(df.where(part == i)))
        assert sorted(map(tuple, profile.merged_top(tops, 5).where("column_name = 'c'").collect())) == sorted(
            map(tuple, profile.top_values(df, 5).where("column_name = 'c'").collect())
        )
