"""Our plans next to the straightforward shape of the same work, on the same rows.

The straightforward shapes are those a first version has: one count job per rule, several jobs per
profiled column, reference keys collected into a list, a window over every value, the result counted
before and after it is written. Prints one line per operator with the median seconds of both.
"""

from __future__ import annotations

import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import gold, profile, quality
from tessera.operators import sinks
from tessera.layout import gold as gold_layout
from tessera.plans.lookup import mark_known
from tessera.session import build_session, scratch
from tessera.suite import inputs
from tessera.suite.q_gold import FACT, _sources
from tessera.suite.q_quality import ORDER_RULES


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def rules_by_count(orders, customers) -> None:
    known = [r[0] for r in customers.select("c_custkey").distinct().collect()]
    tests = [
        F.col("o_orderkey").isNull(),
        ~F.col("o_orderpriority").rlike("^[12]-"),
        (F.col("o_totalprice") < 1000) | (F.col("o_totalprice") > 400000),
        ~F.col("o_custkey").isin(known),
    ]
    for test in tests:
        orders.count()
        orders.where(test).count()
    for column in ("o_orderkey", "o_custkey"):
        orders.count()
        orders.select(column).distinct().count()


def profile_by_column(df) -> None:
    df.count()
    for f in df.schema.fields:
        df.where(F.col(f.name).isNull()).count()
        df.select(f.name).distinct().count()


def unique_by_window(df) -> None:
    run(df.withColumn("u", F.count("l_orderkey").over(Window.partitionBy("l_orderkey")) == 1))


def keys_by_list(orders, customers) -> None:
    missing = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    bad = [r[0] for r in missing.select("o_custkey").distinct().collect()]
    run(orders.withColumn("ok", ~F.col("o_custkey").isin(bad) & F.col("o_custkey").isNotNull()))


def fact_counted(spark, sf_dir) -> None:
    df = gold.fact(_sources(spark, sf_dir), FACT, "r", inputs.AS_OF)
    df.count()
    df.write.parquet(scratch(spark, "fact"))
    df.count()


def fact_observed(spark, sf_dir) -> None:
    df = gold.fact(_sources(spark, sf_dir), FACT, "r", inputs.AS_OF)
    sinks.overwrite(df, gold_layout(scratch(spark, "lake"), "fact"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    spark = build_session("shapes", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    orders, lines = (inputs.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    customers = inputs.few_customers(spark, sf_dir)
    pairs = {
        "dq_evaluate": (
            lambda: rules_by_count(orders, customers),
            lambda: quality.evaluate(orders, ORDER_RULES, {"customer": customers}).collect(),
        ),
        "profile_basic": (lambda: profile_by_column(lines), lambda: profile.basic(lines).collect()),
        "dq_row_unique": (lambda: unique_by_window(lines), lambda: run(quality.unique(lines, "l_orderkey"))),
        "dq_row_foreign_key": (
            lambda: keys_by_list(orders, customers),
            lambda: run(mark_known(orders, "o_custkey", customers, "c_custkey", "ok")),
        ),
        "gold_fact": (lambda: fact_counted(spark, sf_dir), lambda: fact_observed(spark, sf_dir)),
    }
    for name, both in pairs.items():
        medians = []
        for work in both:
            times = []
            for _ in range(6):
                start = time.perf_counter()
                work()
                times.append(time.perf_counter() - start)
            medians.append(statistics.median(times[1:]))
        print(f"{name}: straightforward {medians[0]:.2f} s, ours {medians[1]:.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
