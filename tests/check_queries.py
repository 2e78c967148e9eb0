"""Run queries against their SQL from the command line: ``check_queries.py [sf_dir] [key ...]``.

``CHECK_BROADCAST=-1`` turns automatic broadcasts off, so every lookup takes its large-table plan.
"""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main(sf_dir: str, keys: list[str]) -> int:
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    if "CHECK_BROADCAST" in os.environ:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", os.environ["CHECK_BROADCAST"])
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for key in keys or queries:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracles:
                found = differences(df, con, oracles[key])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} of {len(keys or queries)} failed; {len(oracles)} with SQL")
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
