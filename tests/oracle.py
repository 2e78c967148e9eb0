"""Comparison of a query with its SQL on the same tables, run in an in-process engine."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple("" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12) or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def differences(df, con, sql: str) -> list[str]:
    """What differs: columns, types, row counts, values; empty when the results agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = []
    for f in df.schema.fields:
        kind = kinds[names.index(f.name)]
        if TYPES.get(f.dataType.simpleString()) != kind and kind not in ("NULL", '"NULL"'):
            found.append(f"type of {f.name}: {f.dataType.simpleString()} != {kind}")
    ours = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(ours) != len(theirs):
        return [*found, f"rows {len(ours)} != {len(theirs)}"]
    ours, theirs = sorted(ours, key=_key), sorted(theirs, key=_key)
    bad = [(a, b) for a, b in zip(ours, theirs) if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        found.append(f"{len(bad)} of {len(ours)} rows differ, first: {bad[0]}")
    return found
