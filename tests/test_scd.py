"""Type-2 history: invariants, both plans, stored history."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera import layout as lake
from tessera.layout import read_table, silver
from tessera.operators import history, maintain, scd
from tests.conftest import rows

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SCHEMA = "id int, name string, city string"


def first(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z"), (4, "d", "w")], SCHEMA)


def second(spark):
    """1 unchanged, 2 from null to a value, 3 to null, 4 absent, 5 new, one row without key, 2 twice."""
    data = [(1, "other", "x"), (2, "b", "y"), (2, "b", "y"), (3, "c", None), (5, "e", "v"), (None, "n", "n")]
    return spark.createDataFrame(data, SCHEMA)


def apply(spark, hist, batch, at, **kwargs):
    return scd.apply(hist, batch, ["id"], ["city"], at, **kwargs)


def check(hist):
    """One current row per key; intervals of a key touch."""
    assert hist.where("IsCurrent").groupBy("id").count().where("count <> 1").count() == 0
    pairs = hist.alias("a").join(hist.alias("b"), (F.col("a.id") == F.col("b.id")) & (F.col("a.ValidFrom") < F.col("b.ValidFrom")))
    assert pairs.where("a.ValidTo > b.ValidFrom").count() == 0


def test_changes_close_and_open_versions(spark):
    hist = apply(spark, apply(spark, None, first(spark), T1), second(spark), T2)
    check(hist)
    current = {r["id"]: (r["city"], r["ValidFrom"]) for r in hist.where("IsCurrent").collect()}
    one, two = datetime.fromisoformat(T1), datetime.fromisoformat(T2)
    assert current == {1: ("x", one), 2: ("y", two), 3: (None, two), 4: ("w", one), 5: ("v", two)}
    closed = {r["id"]: r["ValidTo"] for r in hist.where("NOT IsCurrent").collect()}
    assert closed == {2: two, 3: two}


def test_both_plans_agree(spark):
    hist, batch = apply(spark, None, first(spark), T1), scd.prepare(second(spark), ["id"])
    results = [
        scd.merge_current(hist, batch, ["id"], ["city"], T2, broadcast_batch=choice) for choice in (True, False)
    ]
    assert rows(results[0]) == rows(results[1])


def test_same_batch_again_changes_nothing(spark):
    once = apply(spark, apply(spark, None, first(spark), T1), second(spark), T2)
    assert rows(apply(spark, once, second(spark), T3)) == rows(once)


def test_untracked_change_and_no_tracked_columns(spark):
    hist = apply(spark, None, first(spark), T1)
    kept = scd.apply(hist, second(spark), ["id"], [], T2)
    assert rows(kept.where("id < 5")) == rows(hist)
    assert kept.where("id = 5").count() == 1


def test_null_keys_are_rejected(spark):
    assert rows(scd.rejected(second(spark), ["id"])) == [(None, "n", "n")]
    assert scd.prepare(second(spark), ["id"]).count() == 4


def test_latest_row_of_the_batch_wins(spark):
    batch = spark.createDataFrame([(1, "old", "p", 1), (1, "new", "q", 2)], f"{SCHEMA}, at int")
    found = scd.prepare(batch, ["id"], [F.col("at").desc()])
    assert [r["city"] for r in found.collect()] == ["q"]


def test_keys_are_needed(spark):
    with pytest.raises(ValueError):
        scd.apply(None, first(spark), [], [], T1)


def test_stored_history_adds_closed_rows_and_skips_repeats(spark, base):
    layout = silver(base, "people")
    assert history.merge_into(first(spark), layout, ["id"], ["city"], T1, writer=("w", 0)) == {"current": 4, "closed": 0}
    counts = history.merge_into(second(spark), layout, ["id"], ["city"], T2, writer=("w", 1))
    assert counts == {"current": 5, "closed": 2}
    again = history.merge_into(second(spark), layout, ["id"], ["city"], T3, writer=("w", 1))
    assert again == {"current": 0, "closed": 0}
    stored = read_table(spark, layout)
    assert rows(stored) == rows(apply(spark, apply(spark, None, first(spark), T1), second(spark), T2))
    third = spark.createDataFrame([(2, "b", "new")], SCHEMA)
    history.merge_into(third, layout, ["id"], ["city"], T3, writer=("w", 2))
    check(read_table(spark, layout))
    parts = [p["_lake_part"] for p in lake.partitions(spark, layout)]
    assert sorted(parts) == ["closed", "closed", "current"]


def test_compaction_keeps_the_parts_of_a_history(spark, base):
    layout = silver(base, "people")
    history.merge_into(first(spark), layout, ["id"], ["city"], T1, writer=("w", 0))
    history.merge_into(second(spark), layout, ["id"], ["city"], T2, writer=("w", 1))
    before = rows(read_table(spark, layout))
    maintain.compact(spark, layout)
    assert rows(read_table(spark, layout)) == before
    assert history.read_current(spark, layout).count() == 5
    assert lake.marked(spark, layout, "batch.w") == "1"


def test_merge_update(spark):
    target, source = first(spark), second(spark).where("name <> 'n'").dropDuplicates()
    found = scd.merge_update(target, source, ["id"], "NOT (source.city <=> target.city)", {"city": F.col("source.city")})
    assert {r["id"]: r["city"] for r in found.collect()} == {1: "x", 2: "y", 3: None, 4: "w"}
    assert {r["id"]: r["name"] for r in found.collect()}[1] == "a"


def test_both_merge_plans_keep_types_and_new_columns(spark):
    history = scd.initial(spark.createDataFrame([(1, "a")], "k int, v string"), "2024-01-01")
    batch = spark.createDataFrame([(2**40, "b", "new"), (1, "c", None)], "k long, v string, extra string")
    results = [scd.merge_current(history, batch, ["k"], ["v"], "2024-02-01", broadcast_batch=b) for b in (True, False)]
    assert results[0].schema.simpleString() == results[1].schema.simpleString()
    assert "k:bigint" in results[0].schema.simpleString() and "extra:string" in results[0].schema.simpleString()
    assert rows(results[0]) == rows(results[1])
    assert results[0].where("extra = 'new' AND IsCurrent").count() == 1


def test_changes_give_one_history_however_they_are_ordered(spark):
    log = [("k", "a", "2024-01-01", 1, "I"), ("k", "b", "2024-01-02", 2, "U"), ("k", "b", "2024-01-03", 3, "U"),
           ("k", "a", "2024-01-03", 4, "U"), ("k", "a", "2024-01-05", 5, "D"), ("k", "a", "2024-01-07", 6, "I"),
           (None, "x", "2024-01-01", 7, "I")]
    want = [("a", 1, 2, False), ("b", 2, 3, False), ("a", 3, 5, False), ("a", 7, None, True)]
    for order in (log, log[::-1]):
        df = spark.createDataFrame(order, "id string, v string, t string, n int, op string")
        found = scd.from_changes(df, ["id"], ["v"], "t", [F.col("n").desc()], F.col("op") == "D")
        days = found.orderBy("ValidFrom").select("v", F.day("ValidFrom"), F.when(~F.col("IsCurrent"), F.day("ValidTo")), "IsCurrent")
        assert [tuple(r) for r in days.collect()] == want
