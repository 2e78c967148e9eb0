"""Streams against the batch results of the same functions."""

import pytest
from pyspark.sql import functions as F

from tessera import layout as lake
from tessera.layout import bronze, read_table
from tessera.streaming import events, tables
from tessera.suite import inputs
from tests.conftest import rows


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """The events in four files, in time order."""
    path = str(tmp_path_factory.mktemp("events"))
    table = inputs.table(spark, small, "events").repartitionByRange(4, "ts").sortWithinPartitions("ts")
    table.write.mode("overwrite").parquet(path)
    return path


def stream(spark, small, folder, files=1):
    schema = inputs.table(spark, small, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def transactions(spark, small, df=None):
    return events.clean_transactions(inputs.transactions(spark, small, df))


ADDITIVE = ["MerchantId", "Timestamp", "TransactionCount", "TotalAmount", "MaxAmount"]


def test_update_mode_equals_batch(spark, small, folder, base):
    """Four micro-batches, each updating windows; the last row per window is the batch row."""
    layout, keys = bronze(base, "summary"), ["MerchantId", "Timestamp"]
    rollup = events.transaction_summary(transactions(spark, small, stream(spark, small, folder)), "40 days")
    tables.upsert_table(rollup, layout, f"{base}/checkpoint").awaitTermination()
    batch = rows(events.transaction_summary(transactions(spark, small)).select(*ADDITIVE))
    assert len(lake.loads(spark, layout)) >= 4
    assert rows(tables.read_upserted(spark, layout, keys).select(*ADDITIVE)) == batch
    tables.fold_upserts(spark, layout, keys)
    assert lake.loads(spark, layout) == ["whole"]
    assert rows(read_table(spark, layout).select(*ADDITIVE)) == batch


def test_append_mode_emits_closed_windows_only(spark, small, folder, base):
    layout = bronze(base, "summary")
    rollup = events.transaction_summary(transactions(spark, small, stream(spark, small, folder, 4)))
    tables.append_table(rollup, layout, f"{base}/checkpoint").awaitTermination()
    found = rows(read_table(spark, layout).select(*ADDITIVE))
    last = inputs.table(spark, small, "events").agg(F.max("ts")).first()[0]
    closed = (F.col("Timestamp") + F.expr("INTERVAL 1 HOUR")) <= F.lit(last) - F.expr("INTERVAL 10 MINUTES")
    batch = events.transaction_summary(transactions(spark, small)).where(closed).select(*ADDITIVE)
    assert found == rows(batch)


def test_restart_appends_nothing_twice(spark, small, folder, base):
    layout = bronze(base, "raw")
    for _ in range(2):
        tables.append_table(stream(spark, small, folder), layout, f"{base}/checkpoint").awaitTermination()
    assert read_table(spark, layout).count() == inputs.table(spark, small, "events").count()
    assert len(lake.loads(spark, layout)) == 4


def test_rollups_of_every_kind_run_as_streams(spark, small, folder, base):
    source = stream(spark, small, folder, 4)
    rollups = {
        "devices": events.device_summary(events.clean_iot(inputs.readings(spark, small, source)), "40 days"),
        "merchants": events.merchant_metrics(transactions(spark, small, source), "40 days"),
        "users": events.user_behavior(events.clean_web(inputs.web_events(spark, small, source)), "40 days"),
        "fraud": events.fraud_alert(transactions(spark, small, source), 0, "40 days"),
        "anomalies": events.device_alert(events.clean_iot(inputs.readings(spark, small, source)), 0, "40 days"),
    }
    batch = {
        "devices": events.device_summary(events.clean_iot(inputs.readings(spark, small))).count(),
        "merchants": events.merchant_metrics(transactions(spark, small)).count(),
        "users": events.user_behavior(events.clean_web(inputs.web_events(spark, small))).count(),
        "fraud": events.fraud_alert(transactions(spark, small), 0).count(),
        "anomalies": events.device_alert(events.clean_iot(inputs.readings(spark, small)), 0).count(),
    }
    for name, rollup in rollups.items():
        layout = bronze(base, name)
        tables.upsert_table(rollup, layout, f"{base}/{name}-checkpoint").awaitTermination()
        assert read_table(spark, layout).count() == batch[name], name


def test_stream_distinct_counts_are_close(spark, small, folder, base):
    layout = bronze(base, "merchants")
    rollup = events.merchant_metrics(transactions(spark, small, stream(spark, small, folder, 4)), "40 days")
    tables.upsert_table(rollup, layout, f"{base}/checkpoint").awaitTermination()
    exact = events.merchant_metrics(transactions(spark, small)).select("MerchantId", "Hour", F.col("UniqueCustomers").alias("e"))
    both = read_table(spark, layout).join(exact, ["MerchantId", "Hour"])
    assert both.where("abs(UniqueCustomers - e) > 0.1 * e").count() == 0


def test_alerts_and_windows(spark):
    data = [("d", "2024-01-01 00:04:59", True)] * 6 + [("d", "2024-01-01 00:05:00", True)] * 5
    df = spark.createDataFrame(data, "DeviceId string, t string, IsAnomaly boolean").withColumn("Timestamp", F.col("t").cast("timestamp_ntz"))
    found = events.device_alert(df).collect()
    assert [(r["AnomalyCount"], str(r["Timestamp"])) for r in found] == [(6, "2024-01-01 00:00:00")]
    runs = spark.createDataFrame([("FAILED", "2024-01-01 00:07:00")], "Status string, s string").withColumn("StartTime", F.col("s").cast("timestamp_ntz"))
    starts = [str(r["WindowStart"]) for r in events.pipeline_failure_alert(runs).orderBy("WindowStart").collect()]
    assert starts == ["2023-12-31 23:55:00", "2024-01-01 00:00:00", "2024-01-01 00:05:00"]


def test_broken_json_gives_nulls(spark):
    df = spark.createDataFrame([('{"deviceId":"a","temperature":1.5}',), ("oops",)], "value string")
    found = events.map_json(df, events.MAPPINGS["IoTDevices"])
    assert [tuple(r)[:3] for r in found.collect()] == [("a", None, 1.5), (None, None, None)]
    assert len(found.columns) == 6


def test_high_value_uses_the_converted_amount(spark):
    df = spark.createDataFrame([("a", 950.0, "EUR"), ("b", 950.0, "USD"), ("c", 1000.0, None)], "i string, a double, Currency string")
    found = events.clean_transactions(df.withColumn("Amount", F.col("a").cast("decimal(18,4)")))
    assert {r["i"]: (float(r["AmountUSD"]), r["IsHighValue"]) for r in found.collect()} == {
        "a": (1045.0, True),
        "b": (950.0, False),
        "c": (1100.0, True),
    }


def test_late_rows_are_dropped_and_counted(spark, base, tmp_path):
    """The second file holds a row of an hour that the first file's watermark has closed."""
    schema = "TransactionId string, Timestamp timestamp_ntz, MerchantId string, AmountUSD decimal(18,4)"

    def land(name, data):
        df = spark.createDataFrame(data, "TransactionId string, t string, MerchantId string, a double")
        df.select("TransactionId", F.col("t").cast("timestamp_ntz").alias("Timestamp"), "MerchantId", F.col("a").cast("decimal(18,4)").alias("AmountUSD")).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run():
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        query = tables.append_table(events.transaction_summary(source), bronze(base, "late"), f"{base}/checkpoint")
        query.awaitTermination()
        return tables.late_rows(query)

    land("1", [("a", "2024-01-01 00:10:00", "m", 1.0), ("b", "2024-01-01 05:00:00", "m", 2.0)])
    assert run() == 0
    land("2", [("c", "2024-01-01 00:20:00", "m", 4.0), ("d", "2024-01-01 09:00:00", "m", 8.0)])
    assert run() == 1
    found = read_table(spark, bronze(base, "late")).select("Timestamp", "TransactionCount")
    assert [(str(r[0]), r[1]) for r in found.orderBy("Timestamp").collect()] == [
        ("2024-01-01 00:00:00", 1),
        ("2024-01-01 05:00:00", 1),
    ]


def test_lasting_conditions_are_one_episode(spark):
    from tessera.operators import alerts

    def met(*minutes):
        data = [("d", f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00") for m in minutes]
        return spark.createDataFrame(data, "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("t"))

    def found(df):
        return sorted((r.OpenedAt.minute, r.LastAt.minute, r.Evaluations, r.ClosedAt and r.ClosedAt.minute, r.Status) for r in df.collect())

    whole = [(0, 20, 5, 25, "Closed"), (35, 35, 1, 40, "Closed"), (45, 50, 2, None, "Open")]
    minutes = [0, 5, 10, 15, 20, 35, 45, 50]
    assert found(alerts.episodes(met(*minutes, 5, 5), ["k"], "t", "5 minutes", "2024-01-01 00:50:00")) == whole
    known = None
    for part in ([10, 50], [0, 20, 35], [35, 10], [15, 5, 45], [20]):
        known = alerts.episodes(met(*part), ["k"], "t", "5 minutes", "2024-01-01 00:50:00", known)
    assert found(known) == whole
    later = alerts.episodes(met(), ["k"], "t", "5 minutes", "2024-01-01 00:55:00", known)
    assert found(later)[2] == (45, 50, 2, 55, "Closed")


def test_rollup_finds_touched_keys_in_the_kept_rows(spark, small, folder, base):
    """The source is parsed once per batch; keys come from the rows of the batch as they were kept."""
    source, kept, seen = events.clean_web(inputs.web_events(spark, small, stream(spark, small, folder))), bronze(base, "kept"), []

    def touched(df):
        files = df.inputFiles()
        seen.append(bool(files) and all(f"/{kept.short_name}/" in f and f"{lake.LOAD}=" in f for f in files))
        return events.user_hours(df)

    keys = ["UserId", "Hour"]
    tables.rollup_table(source, kept, bronze(base, "rollup"), events.user_behavior, keys, "Hour", f"{base}/checkpoint", touched=touched).awaitTermination()
    assert seen == [True] * 4
    batch = events.user_behavior(events.clean_web(inputs.web_events(spark, small)))
    assert rows(tables.read_upserted(spark, bronze(base, "rollup"), keys).select(batch.columns)) == rows(batch)


def test_batches_of_scattered_events_are_many_files(spark, small):
    from tessera.suite.q_realtime import _scattered

    batches = []
    source = _scattered(spark, small).withColumn("file", F.input_file_name())
    query = source.writeStream.foreachBatch(lambda df, n: batches.append((df.select("file").distinct().count(), df.count())))
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == 5 and min(n for n, _ in batches) > 1
    assert sum(n for _, n in batches) == inputs.table(spark, small, "events").count()


def test_user_behavior_with_nulls(spark):
    data = [
        ("u", "00:10:00", "/b", "s1", 10, True), ("u", "00:20:00", "/b", "s2", None, None), ("u", "00:30:00", "/a", "s1", 5, False),
        ("u", "01:10:00", None, None, None, None), ("u", "02:00:00", None, "s", 1, None), ("u", "02:00:01", "/c", None, 2, True),
        (None, "00:10:00", "/a", "s", 1, True), ("v", None, "/a", "s", 1, True),
    ]
    df = spark.createDataFrame(data, "UserId string, t string, PageUrl string, SessionId string, DurationMs int, IsBounce boolean")
    df = df.withColumn("Timestamp", F.to_timestamp_ntz(F.concat(F.lit("2024-01-01 "), "t"), F.lit("yyyy-MM-dd HH:mm:ss")))
    found = events.user_behavior(df).withColumn("Hour", F.hour("Hour"))
    assert rows(found) == [
        ("u", 0, 2, 3, 7, 50.0, "/b", "/b"),
        ("u", 1, 0, 1, None, None, None, None),
        ("u", 2, 1, 2, 1, 100.0, "/c", None),
    ]
