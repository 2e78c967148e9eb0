"""Tables kept by key against computations over everything delivered."""

import random

import pytest
from pyspark.sql import functions as F

from tessera import layout as lake
from tessera.layout import bronze, gold, read_table, silver
from tessera.operators import dedup, keyed, scd
from tests.conftest import rows

SCHEMA = "id long, grp string, amount double, who long, at int"


def delivery(rng, n, at):
    return [
        (rng.choice([None, *range(30)]), rng.choice(["a", "b", None]), rng.choice([None, float(rng.randint(1, 50))]), rng.randint(0, 6), at + rng.randint(0, 2))
        for _ in range(n)
    ]


@pytest.mark.parametrize("per_bucket", [2_000_000, 3])
def test_latest_rows_and_aggregates_follow_deliveries(spark, base, monkeypatch, per_bucket):
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", per_bucket)
    rng, seen = random.Random(per_bucket), []
    latest, sums, values = silver(base, "latest"), gold(base, "sums"), gold(base, "values")
    grain = ["grp"]
    measures = {"Total": "SUM(amount)", "Mean": "AVG(amount)", "N": "COUNT(amount)", "People": "COUNT(DISTINCT who)", "Low": "MIN(amount)", "High": "MAX(amount)"}
    order = [F.col("at").desc()]
    for number in range(4):
        data = delivery(rng, 25, number)
        seen += data
        batch = spark.createDataFrame(data, SCHEMA)
        for again in range(2 if number == 2 else 1):
            if number == 2 and not again:  # a run that ends before the table changes

                def broken(came, left, load=f"r{number}"):
                    keyed.follow(came, left, sums, values, load, grain, measures)
                    raise RuntimeError("ended")

                with pytest.raises(RuntimeError):
                    keyed.merge_latest(batch, latest, ["id"], order, on_change=broken)

            def follow(came, left, load=f"r{number}"):
                keyed.follow(came, left, sums, values, load, grain, measures)

            came, left = keyed.merge_latest(batch, latest, ["id"], order, on_change=follow)
            assert not again or (came.isEmpty() and left.isEmpty())
        whole = dedup.latest(spark.createDataFrame(seen, SCHEMA), ["id"], order)
        assert rows(read_table(spark, latest)) == rows(whole)
        plain = whole.groupBy("grp").agg(
            F.sum("amount").alias("Total"), F.avg("amount").alias("Mean"), F.count("amount").alias("N"),
            F.count_distinct("who").alias("People"), F.min("amount").alias("Low"), F.max("amount").alias("High"),
        )
        assert rows(keyed.followed(spark, sums, values, grain, measures)) == rows(plain)
    assert len(lake.partitions(spark, latest)) == 1 if per_bucket > 3 else len(lake.partitions(spark, latest)) > 3


def test_small_delivery_rewrites_its_buckets_only(spark, base, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", 50)
    latest = silver(base, "latest")
    first = spark.range(1000).select(F.col("id"), F.lit(0).alias("at"))
    keyed.merge_latest(first, latest, ["id"], [F.col("at").desc()])
    before = set(spark.table(latest.name).inputFiles())
    assert len(lake.partitions(spark, latest)) == 32
    second = spark.range(3).select(F.col("id"), F.lit(1).alias("at"))
    came, left = keyed.merge_latest(second, latest, ["id"], [F.col("at").desc()])
    after = set(spark.table(latest.name).inputFiles())
    assert (came.count(), left.count()) == (3, 3) and len(before - after) <= 3
    plan = keyed._held(spark, latest, [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_lake_bucket" in plan and read_table(spark, latest).count() == 1000


def test_history_by_key_equals_the_whole_derivation(spark, base, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", 5)
    rng, seen = random.Random(3), []
    log, history = bronze(base, "changes"), silver(base, "history")
    schema = "id long, v string, n int, t string, op string"
    for number in range(3):
        data = [(rng.choice([None, *range(12)]), rng.choice("xyz"), 100 * number + i, f"2024-01-{rng.randint(1, 28):02d}", rng.choice("UUUD")) for i in range(20)]
        seen += data
        for _ in range(2):  # a repeated batch replaces itself
            how = (["id"], ["v"], "t", [F.col("n").desc()], F.col("op") == "D")
            keyed.merge_changes(spark.createDataFrame(data, schema), log, history, f"b{number}", *how)
        whole = scd.from_changes(spark.createDataFrame(seen, schema), *how)
        assert rows(read_table(spark, history)) == rows(whole)
    assert len(lake.partitions(spark, history)) > 2
