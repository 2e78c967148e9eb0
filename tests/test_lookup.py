"""Lookups: the split plan for large tables gives what the plain join gives, hot keys included."""

import pytest
from pyspark.sql import functions as F

from tessera.config import Rule
from tessera.operators import quality
from tessera.plans import lookup
from tests.conftest import rows


def skewed(spark, n=3000):
    """A third of the rows share key 0, a tenth have no key, identical copies included."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(n).select(key.cast("long").alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_split_lookup_equals_plain_join(spark, monkeypatch, hot):
    monkeypatch.setattr(lookup, "MAX_HOT", hot)
    left = skewed(spark)
    right = spark.range(0, 500, 2).select(F.col("id").cast("int").alias("key"), (F.col("id") * 10).alias("x"))
    for how in ("left", "inner"):
        plain = left.join(right, left.k == right.key, how).select("k", "v", "x")
        split = lookup.lookup_join(left, right, {"k": "key"}, ["x"], how, always_split=True)
        small = lookup.lookup_join(left, right, {"k": "key"}, ["x"], how)
        assert rows(split) == rows(plain) == rows(small)


def test_large_lookup_is_one_join(spark):
    """Without automatic broadcast rows and lookup table meet in one shuffle join, heavy keys spread."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.range(500).select(F.col("id").alias("key"), F.lit(True).alias("x"))
        joined = lookup.lookup_join(skewed(spark), right, {"k": "key"}, ["x"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "Union" not in plan and "NestedLoop" not in plan
        assert joined.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_heavy_keys_are_bounded_and_found(spark):
    hot = lookup.heavy_keys(skewed(spark), [F.col("k")])
    zero = spark.range(1).select(F.xxhash64(F.col("id")).alias("h")).first()["h"]
    assert len(hot) <= lookup.MAX_HOT and zero in hot


@pytest.mark.parametrize("split", [False, True])
def test_keys_meet_in_their_wider_type(spark, split):
    def failed(left, kind, values, ref_kind):
        rows_ = spark.createDataFrame([(v,) for v in left], "k string").select(F.col("k").cast(kind))
        reference = spark.createDataFrame([(v,) for v in values], "r string").select(F.col("r").cast(ref_kind))
        rule = [Rule(1, "known", "REF_INTEGRITY", "k", ref_table="t", ref_column="r")]
        result = quality.evaluate(rows_, rule, {"t": reference}, split).first()
        broken = quality.failed_rules(rows_, rule, {"t": reference}, split)
        assert broken.count() == len(left)
        assert broken.where(F.size("_dq_failed_rules") > 0).count() == result["failed"]
        return result["total"], result["failed"]

    assert failed(["1", "2"], "int", ["1.2", "1.7"], "double") == (2, 2)
    assert failed(["2024-01-01"], "date", ["2024-01-01 05:00:00", "2024-01-01 06:00:00"], "timestamp") == (1, 1)
    assert failed(["1", "x", "2"], "string", ["1"], "int") == (3, 2)


def test_scans_grow_linearly_with_the_rules(spark, small):
    rows_ = spark.read.parquet(f"{small}/lineitem.parquet")
    part = spark.read.parquet(f"{small}/part.parquet")
    scans = []
    for n in range(1, 7):
        rules = [Rule(i, f"r{i}", "REF_INTEGRITY", "l_partkey", ref_table="p", ref_column="p_partkey") for i in range(n)]
        broken = quality.failed_rules(rows_, rules, {"p": part}, True)
        scans.append(broken._jdf.queryExecution().sparkPlan().toString().count("FileScan"))
    assert scans == [1 + n for n in range(1, 7)]


def test_null_safe_lookup_lets_nulls_meet(spark):
    left = skewed(spark)
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for split in (False, True):
        found = lookup.lookup_join(left, counts, {"k": "k"}, ["n"], null_safe=True, always_split=split)
        assert found.where("k is null").select("n").distinct().first()["n"] == left.where("k is null").count()
        assert found.where("n is null").count() == 0


def test_mark_known_and_repeated_in_both_plans(spark):
    left = skewed(spark)
    reference = spark.createDataFrame([(0,), (4,), (None,), (4,)], "r long")
    for split in (False, True):
        known = lookup.mark_known(left, "k", reference, "r", "known", split)
        assert known.where("known").select("k").distinct().orderBy("k").collect() == [(0,), (4,)]
        assert known.where("k is null and known").count() == 0
        assert known.count() == left.count()
        repeated = lookup.mark_repeated(spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "a int"), ["a"], "f", split)
        assert rows(repeated) == rows(spark.createDataFrame([(1, False), (2, True), (2, True), (None, True), (None, True)], "a int, f boolean"))


@pytest.mark.parametrize("hot", [2, 10_000])
def test_quality_plans_agree(spark, monkeypatch, hot):
    monkeypatch.setattr(lookup, "MAX_HOT", hot)
    rules = [
        Rule(1, "unique", "UNIQUE", "k"),
        Rule(2, "known", "REF_INTEGRITY", "k", ref_table="r", ref_column="r"),
        Rule(3, "set", "NOT_NULL", "k"),
    ]
    references = {"r": spark.range(100).select(F.col("id").alias("r"))}
    left = skewed(spark)
    assert rows(quality.evaluate(left, rules, references)) == rows(quality.evaluate(left, rules, references, True))
    plain = quality.failed_rules(left, rules, references)
    assert rows(plain) == rows(quality.failed_rules(left, rules, references, True))


def test_broadcast_limit_reads_sizes(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.range(1)
    for text, expected in (("10485760b", 10485760), ("10MB", 10485760), ("-1", -1), ("5k", 5120)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert lookup.broadcast_limit(df) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
