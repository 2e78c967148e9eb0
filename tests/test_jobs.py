"""End-to-end jobs run twice over changing deliveries."""

from pyspark.sql import functions as F

from tessera.config import Entity, Model, Rule, Transformation
from tessera.layout import Layout, bronze, gold, quarantine, read_table, silver, table_exists
from tessera.operators import history
from tessera.plans import jobs
from tests.conftest import rows

PEOPLE = "id long, name string, city string, changed timestamp_ntz"


def deliver(spark, path, data, mode="append"):
    df = spark.createDataFrame([(*r[:3], r[3]) for r in data], "id long, name string, city string, t string")
    df.select("id", "name", "city", F.col("t").cast("timestamp_ntz").alias("changed")).write.mode(mode).parquet(path)


def entity(path, watermark):
    return Entity(
        1, "people.parquet", "adls-people", "FILE", path, load_type="INCREMENTAL",
        watermark_column="changed", last_watermark=watermark,
    )


RULES = {1: [Rule(1, "named", "NOT_NULL", "name", "CRITICAL")]}
STEPS = {
    1: [
        (Transformation(1, 1, "STANDARDIZATION", {"dedup_key": "id", "standardize": {"city": "upper"}}), "people"),
        (Transformation(2, 1, "SCD2", {"scd2_columns": ["city"]}, ("id",)), "people_scd2"),
    ]
}
MODELS = [Model("dim_people", "DIMENSION", ("people_scd2",)), Model("none", "FACT", ("absent",))]


def test_medallion_over_two_deliveries(spark, base, tmp_path):
    path = str(tmp_path / "people")
    deliver(spark, path, [(1, "a", "x", "2024-01-01"), (2, "b", "y", "2024-01-01"), (3, None, "z", "2024-01-02")])
    first = jobs.job_medallion(spark, [entity(path, "1900-01-01")], RULES, STEPS, MODELS, base, "run-1", "2024-02-01")
    ends = {r["Name"]: r for r in first.where("EventType = 'end'").collect()}
    assert (ends["people.parquet"]["RowsRead"], ends["people.parquet"]["RowsRejected"]) == (3, 1)
    assert ends["people.parquet"]["WatermarkAfter"] == "2024-01-02 00:00:00.000"
    assert ends["none"]["Status"] == "FAILED" and ends["medallion"]["Status"] == "PARTIAL"
    assert rows(read_table(spark, quarantine(base, "people")).select("id", F.size("_dq_failed_rules"))) == [(3, 1)]

    deliver(spark, path, [(2, "b", "moved", "2024-01-03"), (4, "d", "w", "2024-01-03")])
    mark = ends["people.parquet"]["WatermarkAfter"]
    second = jobs.job_medallion(spark, [entity(path, mark)], RULES, STEPS, MODELS, base, "run-2", "2024-03-01")
    end = second.where("EventType = 'end' AND Name = 'people.parquet'").first()
    assert (end["RowsRead"], end["WatermarkAfter"]) == (2, "2024-01-03 00:00:00.000")
    assert read_table(spark, bronze(base, "people")).count() == 5
    stored = read_table(spark, silver(base, "people_scd2"))
    assert rows(stored.where("IsCurrent").select("id", "city")) == [(1, "x"), (2, "moved"), (4, "w")]
    assert rows(stored.where("NOT IsCurrent").select("id", "city")) == [(2, "y")]
    assert history.read_current(spark, silver(base, "people_scd2")).count() == 3
    assert read_table(spark, gold(base, "dim_people")).count() == 3
    assert rows(read_table(spark, silver(base, "people")).select("id", "city")) == [(1, "X"), (2, "MOVED"), (4, "W")]


def test_failed_load_keeps_the_watermark(spark, base):
    report = jobs.job_bronze(spark, [entity("/absent/folder", "2024-01-01")], base, "run", "2024-02-01").first()
    assert report["status"] == "FAILED" and report["watermark_after"] == "2024-01-01" and report["error"]
    assert not table_exists(spark, bronze(base, "people"))


def test_empty_load_writes_nothing(spark, base, tmp_path):
    path = str(tmp_path / "people")
    deliver(spark, path, [(1, "a", "x", "2024-01-01")])
    full = Entity(1, "people.parquet", "adls-people", "FILE", path)
    assert jobs.load_entity(spark, full, base, "run-1", "2024-02-01").rows_written == 1
    none = Entity(1, "people.parquet", "adls-people", "FILE", path, filter_clause="id < 0")
    assert jobs.load_entity(spark, none, base, "run-2", "2024-02-02").rows_written == 0
    assert read_table(spark, bronze(base, "people")).count() == 1


def test_quality_job_with_no_good_rows(spark, base, tmp_path):
    path = str(tmp_path / "people")
    deliver(spark, path, [(1, None, "x", "2024-01-01"), (2, None, "y", "2024-01-01")])
    jobs.load_entity(spark, Entity(1, "people.parquet", "adls-people", "FILE", path), base, "run", "2024-02-01")
    report = jobs.job_quality(spark, "people", RULES[1], base, "run", "2024-02-01").first()
    assert (report["status"], report["quarantine_count"]) == ("QUARANTINED", 2)
    assert read_table(spark, jobs.checked_layout(base, "people")).count() == 0
    assert read_table(spark, Layout(base, "system", "dq", "results")).count() == 1


def test_drift_job_logs_and_rejects(spark, base):
    from tessera.operators import sinks

    layout = bronze(base, "t")
    sinks.overwrite(spark.sql("SELECT 1 AS a, 'x' AS b"), layout)
    wider = spark.sql("SELECT 2L AS a, 'y' AS b, true AS c")
    assert jobs.job_drift(spark, {1: (wider, layout)}, "strict", base, "2024-02-01").first()["status"] == "REJECTED"
    assert jobs.job_drift(spark, {1: (wider, layout)}, "merge", base, "2024-02-01").first()["status"] == "MERGE"
    assert rows(read_table(spark, layout)) == [(1, "x", None), (2, "y", True)]
    assert jobs.job_drift(spark, {1: (wider, layout)}, "alert", base, "2024-02-01").first()["status"] == "CHECKED"
    log = read_table(spark, Layout(base, "system", "drift", "schema_drift_log"))
    assert [r["DriftType"] for r in log.collect()] == ["MIXED", "MIXED"]


def test_maintenance_and_review(spark, base):
    from tessera.operators import maintain, sinks

    for name, files in (("many", 6), ("one", 1)):
        sinks.overwrite(spark.range(60).toDF("a").repartition(files), bronze(base, name))
    review = jobs.job_storage_review(spark, base, ["bronze"], "analyze", 90, "2024-02-01", dry_run=True, max_files=3)
    assert rows(review.select("table_name", "num_files", "compact", "cleanup")) == [("many", 6, "DRY_RUN", "SKIPPED"), ("one", 1, "SKIPPED", "SKIPPED")]
    report = jobs.job_maintenance(spark, maintain.list_tables(spark, base), 90, "2024-02-01", max_files=3, parallelism=2)
    assert rows(report.select("table_name", "compact")) == [("many", "COMPACTED"), ("one", "SKIPPED")]
    assert tuple(maintain.run_summary(report).first()) == ("SUCCEEDED", 2, 1, 1, 0)


def test_quality_and_history_take_what_arrived_since(spark, base, tmp_path):
    path = str(tmp_path / "people")
    deliver(spark, path, [(i, "a" if i % 2 else None, "x", "2024-01-01") for i in range(10)])
    first = jobs.job_medallion(spark, [entity(path, "1900-01-01")], RULES, STEPS, MODELS[:1], base, "run-1", "2024-02-01")
    deliver(spark, path, [(i, "a" if i % 2 else None, "x", "2024-01-05") for i in range(10, 14)])
    second = jobs.job_medallion(spark, [entity(path, "2024-01-01 00:00:00.000")], RULES, STEPS, MODELS[:1], base, "run-2", "2024-03-01")
    for events, wanted in ((first, (10, 5, 5)), (second, (4, 2, 2))):
        end = events.where("EventType = 'end' AND RunKind = 'entity'").first()
        assert (end["RowsRead"], end["RowsWritten"], end["RowsRejected"]) == wanted
    bad = read_table(spark, quarantine(base, "people"))
    assert sorted(r.id for r in bad.collect()) == list(range(0, 14, 2))
    assert {r["SourceTable"] for r in bad.collect()} == {"bronze.people"}
    assert bad.select("QuarantineTime").distinct().count() == 2
    checked = read_table(spark, jobs.checked_layout(base, "people"))
    assert sorted(r.id for r in checked.collect()) == list(range(1, 14, 2)) and "QuarantineTime" not in checked.columns
    again = jobs.job_quality(spark, "people", RULES[1], base, "run-2", "2024-03-01").first()
    assert again["quarantine_count"] == 0
    assert read_table(spark, quarantine(base, "people")).count() == 7
    assert read_table(spark, jobs.checked_layout(base, "people")).count() == 7


def test_unique_rules_hold_over_all_deliveries(spark, base):
    """After every delivery the tables are what one evaluation of the whole table gives; repetitions change nothing."""
    from tessera.operators import key_counts, quality, sinks

    rules = [Rule(1, "one", "UNIQUE", "id", "CRITICAL"), Rule(2, "named", "NOT_NULL", "name", "ERROR", True)]
    rules = [Rule(*[getattr(r, f) for f in ("rule_id", "name", "kind", "column", "severity")], True) for r in rules]
    deliveries = [[(1, "a"), (2, "b"), (3, None), (None, "n")], [(2, "c"), (4, "d"), (5, "e"), (5, "f")], [(6, "g")], [(6, "h"), (2, "i"), (None, "m"), (1, "a")]]
    raw, gone = bronze(base, "things"), []
    for i, rows_ in enumerate(deliveries):
        sinks.append(spark.createDataFrame(rows_, "id long, name string"), raw, load=f"r{i}")
        for again in range(2):
            report = jobs.job_quality(spark, "things", rules, base, f"r{i}", f"2024-02-0{i + 1}", redo=(f"r{i}",)).first()
            whole = read_table(spark, raw)
            good, bad = quality.quarantine_split(whole, rules)
            assert rows(read_table(spark, jobs.checked_layout(base, "things"))) == rows(good), (i, again)
            found = read_table(spark, quarantine(base, "things")).select("id", "name", F.sort_array("_dq_failed_rules"))
            assert rows(found) == rows(bad.select("id", "name", F.sort_array("_dq_failed_rules"))), (i, again)
            want = quality.evaluate(whole, rules).where("rule_id = 1").first()
            kept = read_table(spark, Layout(base, "system", "dq", "results")).where(f"EntityRunId = 'r{i}-things' AND RuleId = 1").collect()
            assert [(r["TotalRows"], r["FailedRows"]) for r in kept] == [(want["total"], want["failed"])]
            assert report["status"] == ("SUCCEEDED" if want["failed"] == 0 else "QUARANTINED")
            gone.append(report["requarantined_count"])
    assert gone == [0, 0, 1, 0, 0, 0, 3, 0]
    sinks.overwrite(spark.createDataFrame([(2, "x"), (9, "y")], "id long, name string"), raw, load="r9")
    jobs.job_quality(spark, "things", rules, base, "r9", "2024-03-01")
    assert rows(read_table(spark, jobs.checked_layout(base, "things"))) == [(2, "x"), (9, "y")]
    totals = read_table(spark, key_counts.totals_layout(base, "things"))
    assert totals.agg(F.sum("rows"), F.sum("keys")).first()[:] == (2, 2)


def test_a_delivery_reads_the_buckets_of_its_keys(spark, base, monkeypatch):
    from tessera import layout as lake
    from tessera.operators import key_counts, sinks

    monkeypatch.setattr(key_counts, "KEYS_PER_BUCKET", 50)
    raw = bronze(base, "things")
    sinks.append(spark.range(1000).toDF("id"), raw, load="a")
    key_counts.deliver(lake.read_whole(spark, raw), "id", base, "things", ["a"])
    counts = key_counts.counts_layout(base, "things")
    assert len(lake.partitions(spark, counts)) == 32
    before = set(spark.table(counts.name).inputFiles())
    sinks.append(spark.sql("SELECT 7L AS id UNION ALL SELECT 5000L"), raw, load="b")
    found = key_counts.deliver(lake.read_whole(spark, raw).where("_load = 'b'"), "id", base, "things", ["a", "b"])
    assert (found.rows, found.keys, found.loads) == (1002, 1001, ["a"])
    assert found.repeated.count() == 1
    assert len(before - set(spark.table(counts.name).inputFiles())) <= 2


def test_parallel_entities_keep_all_results(spark, base, tmp_path):
    entities, rules = [], {}
    for i in range(8):
        path = str(tmp_path / f"people{i}")
        deliver(spark, path, [(1, "a", "x", "2024-01-01")])
        entities.append(Entity(i, f"people{i}.parquet", "adls-people", "FILE", path))
        rules[i] = [Rule(i, "named", "NOT_NULL", "name", "ERROR", True)]
    events = jobs.job_medallion(spark, entities, rules, {}, [], base, "run-1", "2024-02-01", parallelism=8)
    assert events.where("Status = 'FAILED'").count() == 0
    assert rows(read_table(spark, Layout(base, "system", "dq", "results")).select("RuleId")) == [(i,) for i in range(8)]


def test_repeated_keys_are_counted_once_and_buckets_written_side_by_side(spark, base):
    from tessera import layout as lake
    from tessera.operators import key_counts, sinks

    raw = bronze(base, "things")
    sinks.append(spark.range(1000).select("id"), raw, load="a")
    sinks.append(spark.range(900, 1100).select("id"), raw, load="b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for load, present in (("a", ["a"]), ("b", ["a", "b"])):
            rows_ = lake.read_whole(spark, raw).where(F.col(lake.LOAD) == load)
            found = key_counts.deliver(rows_, "id", base, "things", present)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (found.repeated.count(), found.loads, found.rows, found.keys) == (100, ["a"], 1200, 1100)
    assert "Aggregate" not in found.repeated._jdf.queryExecution().executedPlan().toString()
    assert len(lake.read_whole(spark, key_counts.counts_layout(base, "things")).inputFiles()) > 1
