"""Loads, appends, drift on append, rewrites."""

import pytest
from pyspark.sql import functions as F

from tessera import layout as lake
from tessera.layout import LOAD, ROWS, bronze, gold, read_table, table_exists
from tessera.operators import drift, maintain, sinks
from tests.conftest import rows


def test_overwrite_reads_its_own_table(spark, base):
    layout = bronze(base, "t")
    assert not table_exists(spark, layout)
    with pytest.raises(FileNotFoundError):
        read_table(spark, layout)
    assert sinks.overwrite(spark.range(10).toDF("a"), layout)[ROWS] == 10
    sinks.overwrite(read_table(spark, layout).where("a < 3").withColumn("b", F.lit("x")), layout)
    assert rows(read_table(spark, layout)) == [(0, "x"), (1, "x"), (2, "x")]


def test_overwrite_without_rows_and_with_other_columns(spark, base):
    layout = bronze(base, "t")
    for i in range(3):
        sinks.append(spark.range(5).toDF("a"), layout, load=f"r{i}")
    assert sinks.overwrite(spark.range(0).toDF("a"), layout, keep_if_empty=True)[ROWS] == 0
    assert read_table(spark, layout).count() == 15
    sinks.overwrite(read_table(spark, layout).where("a < 2"), layout)
    assert read_table(spark, layout).count() == 6 and lake.loads(spark, layout) == ["whole"]
    found = sinks.overwrite(read_table(spark, layout).select(F.col("a").cast("string").alias("b")), layout, {"top": F.max("b")})
    assert found == {ROWS: 6, "top": "1"} and read_table(spark, layout).columns == ["b"]
    sinks.overwrite(spark.range(0).select(F.lit("x").alias("b")), layout)
    assert read_table(spark, layout).count() == 0


def test_a_repeated_load_replaces_itself(spark, base):
    layout = bronze(base, "t")
    for rows_, load in ((4, "r1"), (3, "r2"), (9, "r1"), (0, "r2")):
        sinks.append(spark.range(rows_).toDF("a"), layout, load=load)
    assert lake.loads(spark, layout) == ["r1"] and read_table(spark, layout).count() == 9
    split = bronze(base, "u")
    for rows_ in (4, 2):
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
        sinks.append(spark.range(rows_).withColumn("_lake_day", day), split, load="r1", partitioned=("_lake_day",))
    assert read_table(spark, split).count() == 2 and len(lake.partitions(spark, split)) == 2


def test_loads_are_merged(spark, base):
    layout = bronze(base, "t")
    for i in range(4):
        sinks.append(spark.range(i, i + 1).toDF("a"), layout, load=f"r{i}")
    assert sinks.merge_loads(spark, layout, ["r0", "r1", "r2"], "old") == 3
    assert lake.loads(spark, layout) == ["old", "r3"] and rows(read_table(spark, layout)) == [(0,), (1,), (2,), (3,)]
    with pytest.raises(ValueError):
        sinks.merge_loads(spark, layout, ["r3"], "old")


def test_append_evolves_and_widens(spark, base):
    layout = bronze(base, "t")
    sinks.append(spark.sql("SELECT 1 AS a, 'x' AS b"), layout)
    sinks.append(spark.sql("SELECT 5000000000 AS a, 1.5D AS c"), layout)
    sinks.append(spark.sql("SELECT 3 AS a"), layout)
    assert rows(read_table(spark, layout)) == [(1, "x", None), (3, None, None), (5000000000, None, 1.5)]
    assert read_table(spark, layout).schema["a"].dataType.simpleString() == "bigint"
    with pytest.raises(drift.SchemaDrift):
        sinks.append(spark.sql("SELECT 'text' AS a"), layout)


def test_numbered_batches_apply_once(spark, base):
    layout, df = bronze(base, "t"), spark.range(3).toDF("a")
    for number in (0, 0, 1, 1):
        sinks.append(df, layout, batch=("w", number))
    assert read_table(spark, layout).count() == 6
    assert sinks.append(df.limit(0), layout)[ROWS] == 0
    assert lake.loads(spark, layout) == ["w-000000000000", "w-000000000001"]


def test_compaction_merges_files_and_keeps_rows(spark, base):
    layout = bronze(base, "t")
    for i in range(3):
        sinks.append(spark.range(100 * i, 100 * i + 100).toDF("a").repartition(3), layout)
    before = rows(read_table(spark, layout))
    assert maintain.compact(spark, layout, dry_run=True) == {"status": "DRY_RUN", "partitions": 3, "rows": 0}
    assert maintain.table_stats(spark, [layout]).first()["num_files"] == 9
    assert maintain.compact(spark, layout, 50) == {"status": "COMPACTED", "partitions": 3, "rows": 300}
    assert maintain.table_stats(spark, [layout]).first()["num_files"] == 6 and rows(read_table(spark, layout)) == before
    maintain.compact(spark, layout)
    assert maintain.table_stats(spark, [layout]).first()["num_files"] == 3
    assert maintain.compact(spark, layout)["status"] == "SKIPPED"


def test_compaction_leaves_large_files_alone(spark, base):
    layout = bronze(base, "t")
    sinks.append(spark.range(300_000).select(F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 512).alias("b")).repartition(2), layout)
    large = set(spark.table(layout.name).inputFiles())
    for i in range(2):
        sinks.append(spark.range(10).select(F.col("id").alias("a"), F.lit("x").alias("b")).repartition(2), layout)
    assert maintain.compact(spark, layout, min_file_mb=5)["rows"] == 20
    files = set(spark.table(layout.name).inputFiles())
    assert len(files) == 4 and large <= files and read_table(spark, layout).count() == 300_020


def test_cluster_sorts_and_keeps_copies(spark, base):
    layout = bronze(base, "t")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
    sinks.overwrite(spark.range(3000).select(hot.alias("k"), F.lit(1).alias("same")), layout)
    assert maintain.cluster_table(spark, layout, ["k"], 4) == 3000
    per_file = read_table(spark, layout).groupBy(F.col("_metadata.file_path")).agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n")
    )
    files = sorted(tuple(r)[1:] for r in per_file.collect())
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))
    assert max(f[2] for f in files) < 1500


def test_retention(spark, base):
    layout = bronze(base, "t")
    times = ["2024-01-01 10:00:00", "2024-01-15 00:00:00", "2024-03-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    sinks.overwrite(df.select(F.col("t").cast("timestamp_ntz").alias("_bronze_ingestion_timestamp")), layout)
    dry = maintain.retention(spark, layout, 90, "2024-04-14 23:00:00", dry_run=True)
    assert dry == {"status": "DRY_RUN", "removed": 1} and read_table(spark, layout).count() == 4
    assert maintain.retention(spark, layout, 90, "2024-04-14 23:00:00")["removed"] == 1
    assert read_table(spark, layout).count() == 3
    other = gold(base, "u")
    sinks.overwrite(spark.range(1).toDF("a"), other)
    assert maintain.retention(spark, other, 90, "2024-04-14")["status"] == "SKIPPED"


def test_retention_rewrites_mixed_partitions_only(spark, base):
    layout = bronze(base, "t")
    for i, times in enumerate((["2024-01-01", "2024-01-02"], ["2024-01-03", "2024-03-01"], ["2024-03-02", "2024-03-03"])):
        df = spark.createDataFrame([(t,) for t in times], "t string").coalesce(1)
        sinks.append(df.select(F.col("t").cast("timestamp_ntz").alias("_bronze_ingestion_timestamp")), layout, load=f"r{i}")
    old, mixed, young = sorted(spark.table(layout.name).inputFiles(), key=lambda f: f.split("_load=")[1])
    assert maintain.retention(spark, layout, 90, "2024-04-14")["removed"] == 3
    files = set(spark.table(layout.name).inputFiles())
    assert young in files and old not in files and mixed not in files and lake.loads(spark, layout) == ["r1", "r2"]
    assert read_table(spark, layout).count() == 3
    assert maintain.retention(spark, layout, 1, "2024-04-14")["removed"] == 3
    assert read_table(spark, layout).count() == 0


@pytest.mark.parametrize("curve", [True, False])
def test_curve_serves_filters_on_every_column(spark, base, curve):
    layout = bronze(base, "t")
    df = spark.range(40_000).select((F.col("id") % 200).alias("a"), F.expr("id div 200").alias("b"), F.when(F.col("id") % 7 > 0, F.col("id") % 97).alias("c"))
    sinks.overwrite(df, layout)
    before = rows(read_table(spark, layout).groupBy("a").count())
    assert maintain.cluster_table(spark, layout, ["a", "b"], 16, curve) == 40_000
    assert rows(read_table(spark, layout).groupBy("a").count()) == before
    ranges = maintain.file_ranges(spark, layout, ["a", "b"]).collect()
    read_a, read_b = (sum(r[f"min_{c}"] <= 100 <= r[f"max_{c}"] for r in ranges) for c in "ab")
    assert len(ranges) == 16
    if curve:
        assert read_a <= 8 and read_b <= 8
    else:
        assert read_a <= 2 and read_b == 16


def test_curve_takes_any_type_and_nulls(spark):
    df = spark.sql("SELECT id % 10 AS a, IF(id % 3 = 0, NULL, concat('k', id)) AS b, DATE'2024-01-01' + CAST(id AS INT) AS d, id = 5 AS e FROM range(100)")
    z = df.select("*", maintain.z_value(df, ["a", "b", "d", "e"], 5).alias("z"))
    assert z.where("z IS NULL OR z < 0").count() == 0 and z.select("z").distinct().count() > 50
    assert maintain.cluster(df, ["a", "b", "d"], 4).count() == 100
    empty = df.limit(0)
    assert empty.select(maintain.z_value(empty, ["a", "b"]).alias("z")).count() == 0
    with pytest.raises(ValueError):
        maintain.z_value(df, ["a", "b", "d", "e"], 16)


def test_backup_detects_a_difference(spark, base):
    layout = gold(base, "t")
    sinks.overwrite(spark.range(5).toDF("a"), layout)
    assert rows(sinks.backup(spark, [layout], f"{base}-copy")) == [("t", 5, True)]
    sinks.overwrite(spark.range(1, 6).toDF("a"), layout)
    assert rows(sinks.backup(spark, [layout], f"{base}-copy")) == [("t", 5, False)]


def test_registered_table_follows_the_version(spark, base):
    layout = gold(base, "t")
    sinks.overwrite(spark.range(5).toDF("a"), layout)
    sinks.register(spark, layout, "tessera_test_registered")
    sinks.overwrite(spark.range(2).toDF("a"), layout)
    sinks.register(spark, layout, "tessera_test_registered")
    assert spark.table("tessera_test_registered").count() == 2
    spark.sql("DROP VIEW tessera_test_registered")


def test_listing_and_cost(spark, base):
    for name in ("a", "b"):
        sinks.overwrite(spark.range(3).toDF("x"), bronze(base, name))
    assert [t.table for t in maintain.list_tables(spark, base)] == ["a", "b"]
    assert maintain.list_tables(spark, base, "gold") == []
    stats = spark.createDataFrame([("bronze", "raw", "t", 2000, 2 * 1024**3)], "layer string, schema string, table_name string, num_files long, size_in_bytes long")
    cost = maintain.storage_cost(stats).first()
    assert (cost["size_gb"], cost["monthly_cost_usd"]) == (2.0, 0.046) and cost["recommendation"] != "OK"


def test_drift_kinds(spark):
    a = spark.sql("SELECT 1 AS x, 'a' AS y").schema
    b = spark.sql("SELECT 1L AS x, 'a' AS y, 1 AS z").schema
    c = spark.sql("SELECT 1 AS x").schema
    assert drift.compare(a, None).kind == "NEW_TABLE"
    assert drift.compare(a, a).kind is None
    assert drift.compare(a, c).kind == "ADDED_COLUMNS"
    assert drift.compare(c, a).kind == "REMOVED_COLUMNS"
    assert drift.compare(spark.sql("SELECT 1L AS x").schema, c).kind == "TYPE_CHANGES"
    assert drift.compare(b, a).kind == "MIXED"


def test_drift_strategies(spark):
    batch, target = spark.sql("SELECT 1 AS x, 'n' AS added"), spark.sql("SELECT 2L AS x, 'k' AS kept")
    with pytest.raises(drift.SchemaDrift):
        drift.handle(batch, target, "strict")
    assert drift.handle(batch, target, "alert")[0].columns == ["x", "added"]
    assert drift.handle(batch, target, "ignore")[0].columns == ["x"]
    merged, _ = drift.handle(batch, target, "merge")
    assert merged.columns == ["x", "kept", "added"] and merged.schema["x"].dataType.simpleString() == "bigint"
    assert drift.handle(batch, None, "strict")[1].kind == "NEW_TABLE"
    new, old = drift.merge(batch, target)
    assert new.schema == old.schema or new.columns == old.columns


def test_landed_columns_types(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":null,"c":"x"}'), (1, '{"a":1.5,"b":null,"d":[1]}'), (2, '{"a":true}')], "e int, j string")
    found = {(r["EntityId"], r["column"]): r["type"] for r in drift.landed_columns(df, "e", "j").collect()}
    assert found == {(1, "a"): "double", (1, "b"): None, (1, "c"): "string", (1, "d"): "array", (2, "a"): "boolean"}


def test_parallel_appends_lose_nothing(spark, base):
    from concurrent.futures import ThreadPoolExecutor

    layout = bronze(base, "shared")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: sinks.append(spark.range(i, i + 1), layout), range(8)))
    assert rows(read_table(spark, layout)) == [(i,) for i in range(8)]
    assert len(lake.loads(spark, layout)) == 8


def test_rewrite_keeps_what_was_appended_meanwhile(spark, base):
    layout = bronze(base, "busy")
    sinks.append(spark.range(2), layout)

    def transform(df):
        sinks.append(spark.range(2, 3), layout)
        return df

    sinks.rewrite(spark, layout, transform)
    assert rows(read_table(spark, layout)) == [(0,), (1,), (2,)]


def test_appended_and_empty_tables_are_registered(spark, base):
    layout = bronze(base, "named")
    sinks.append(spark.range(1), layout)
    sinks.register(spark, layout, "named_rows")
    sinks.append(spark.createDataFrame([(5, "x")], "id long, extra string"), layout)
    sinks.register(spark, layout, "named_rows")
    assert rows(spark.table("named_rows")) == [(0, None), (5, "x")]
    sinks.rewrite(spark, layout, lambda df: df.coalesce(1))
    sinks.register(spark, layout, "named_rows")
    assert spark.table("named_rows").count() == 2
    spark.sql("DROP VIEW named_rows")


def test_upkeep_of_a_table_without_rows(spark, base):
    from tessera.plans import jobs

    layout = bronze(base, "gone")
    old = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ '2020-01-01' AS _bronze_ingestion_timestamp")
    sinks.append(old, layout)
    first = jobs.job_maintenance(spark, [layout], 30, "2024-01-01 00:00:00").first()
    assert (first.cleanup, first.removed) == ("CLEANED", 1)
    again = jobs.job_maintenance(spark, [layout], 30, "2024-01-01 00:00:00").first()
    assert (again.cleanup, again.removed) == ("CLEANED", 0)
    assert maintain.table_stats(spark, [layout]).first()["num_files"] == 0
    assert jobs.job_storage_review(spark, base, ["bronze"], "cleanup", 30, "2024-01-01 00:00:00").count() == 1
    assert read_table(spark, layout).count() == 0
    sinks.register(spark, layout, "gone_rows")
    assert spark.table("gone_rows").count() == 0
    spark.sql("DROP VIEW gone_rows")
