"""Schema drift of landed JSON rows against the tables they belong to."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.layout import Layout, bronze, read_table
from tessera.operators import drift, sinks
from tessera.session import scratch
from tessera.suite.inputs import AS_OF, table
from tessera.suite.registry import query

# What a second delivery changed: entity -> (table, dropped column, retyped column, added column).
CHANGES = {
    1: ("orders", "o_orderpriority", "o_totalprice", "o_channel"),
    2: ("customer", None, None, "c_country"),
    3: ("supplier", "s_acctbal", None, None),
    4: ("part", None, "p_partkey", None),
    5: ("nation", None, None, None),
}


def _delivery(spark, sf_dir, entity) -> DataFrame:
    """The changed second delivery of an entity."""
    name, dropped, retyped, added = CHANGES[entity]
    rows = table(spark, sf_dir, name)
    times = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "timestamp_ntz"]
    rows = rows.withColumns({c: F.col(c).cast("string") for c in times}) if times else rows
    if retyped:
        rows = rows.withColumn(retyped, F.concat(F.lit("#"), F.col(retyped).cast("string")))
    if added:
        rows = rows.withColumn(added, F.lit("web"))
    return rows.drop(dropped) if dropped else rows


def _landed(spark, sf_dir) -> DataFrame:
    """All deliveries as landed JSON rows, and a sixth entity that has no table yet."""
    parts = [
        _delivery(spark, sf_dir, e).select(F.lit(e).alias("EntityId"), F.to_json(F.struct("*")).alias("json"))
        for e in CHANGES
    ]
    new = table(spark, sf_dir, "region").select(F.lit(6).alias("EntityId"), F.to_json(F.struct("*")).alias("json"))
    return reduce(DataFrame.unionByName, [*parts, new])


def _targets(spark, sf_dir) -> DataFrame:
    """Columns of the tables, in the types JSON can express."""
    json_types = {"int": "bigint", "timestamp_ntz": "string"}
    schemas = {e: table(spark, sf_dir, name).schema for e, (name, *_) in CHANGES.items()}
    return drift.column_frame(spark, schemas).replace(json_types, subset="type")


_DETECTED = """
    SELECT 1::BIGINT AS EntityId, 'o_orderpriority' AS "column", 'REMOVED' AS change, NULL AS source_type,
           'string' AS target_type, FALSE AS new_table
    UNION ALL SELECT 1, 'o_totalprice', 'RETYPED', 'string', 'double', FALSE
    UNION ALL SELECT 1, 'o_channel', 'ADDED', 'string', NULL, FALSE
    UNION ALL SELECT 2, 'c_country', 'ADDED', 'string', NULL, FALSE
    UNION ALL SELECT 3, 's_acctbal', 'REMOVED', NULL, 'double', FALSE
    UNION ALL SELECT 4, 'p_partkey', 'RETYPED', 'string', 'bigint', FALSE
    UNION ALL SELECT 6, 'r_regionkey', 'ADDED', 'bigint', NULL, TRUE
    UNION ALL SELECT 6, 'r_name', 'ADDED', 'string', NULL, TRUE"""


@query("drift_detect", _DETECTED)
def drift_detect(spark, sf_dir):
    found = drift.landed_columns(_landed(spark, sf_dir), "EntityId", "json")
    return drift.detect(found, _targets(spark, sf_dir))


_CLASSIFIED = f"""
    SELECT EntityId, CASE WHEN bool_or(new_table) THEN 'NEW_TABLE' WHEN count(DISTINCT change) > 1 THEN 'MIXED'
                          WHEN min(change) = 'ADDED' THEN 'ADDED_COLUMNS'
                          WHEN min(change) = 'REMOVED' THEN 'REMOVED_COLUMNS' ELSE 'TYPE_CHANGES' END AS DriftType,
           count(*) FILTER (change = 'ADDED') AS Added, count(*) FILTER (change = 'REMOVED') AS Removed,
           count(*) FILTER (change = 'RETYPED') AS Retyped
    FROM ({_DETECTED}) GROUP BY EntityId"""


@query("drift_classify", _CLASSIFIED)
def drift_classify(spark, sf_dir):
    return drift.classify(drift_detect(spark, sf_dir))


@query(
    "drift_scan_entities",
    f"""SELECT c.EntityId, c.DriftType, coalesce(l.added, '') AS AddedColumns, coalesce(l.removed, '') AS RemovedColumns,
               c.Retyped, TIMESTAMP '{AS_OF}' AS DetectedTime
        FROM ({_CLASSIFIED}) c
        JOIN (SELECT EntityId, string_agg("column", ',' ORDER BY "column") FILTER (change = 'ADDED') AS added,
                     string_agg("column", ',' ORDER BY "column") FILTER (change = 'REMOVED') AS removed
              FROM ({_DETECTED}) GROUP BY EntityId) l USING (EntityId)""",
)
def drift_scan_entities(spark, sf_dir):
    found = drift.landed_columns(_landed(spark, sf_dir), "EntityId", "json")
    log = drift.scan_entities(found, _targets(spark, sf_dir), AS_OF)
    return log.withColumn("Retyped", F.size("TypeChanges")).drop("TypeChanges")


@query("drift_strict", "SELECT o_orderkey, o_totalprice, FALSE AS accepted FROM orders")
def drift_strict(spark, sf_dir):
    """A drifted batch is refused, so the target keeps its rows."""
    target = table(spark, sf_dir, "orders")
    try:
        drift.strict(_delivery(spark, sf_dir, 1), target)
        accepted = True
    except drift.SchemaDrift:
        accepted = False
    return target.select("o_orderkey", "o_totalprice", F.lit(accepted).alias("accepted"))


@query(
    "drift_alert",
    """SELECT c_custkey, c_name, 'web' AS c_country, 'ADDED_COLUMNS' AS logged FROM customer""",
)
def drift_alert(spark, sf_dir):
    """The batch passes as it is and the drift is logged."""
    log = Layout(scratch(spark, "lake"), "system", "drift", "schema_drift_log")
    rows, found = drift.handle(_delivery(spark, sf_dir, 2), table(spark, sf_dir, "customer"), "alert")
    sinks.append(drift.log_entry(spark, 2, found, AS_OF), log)
    logged = read_table(spark, log).select("DriftType").scalar()
    return rows.select("c_custkey", "c_name", "c_country").withColumn("logged", logged)


@query(
    "drift_merge",
    """SELECT c_custkey, c_acctbal, 'web' AS c_country FROM customer
       UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer""",
)
def drift_merge(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "customer")
    sinks.overwrite(table(spark, sf_dir, "customer"), layout)
    batch, _ = drift.merge(_delivery(spark, sf_dir, 2), read_table(spark, layout))
    sinks.append(batch, layout)
    return read_table(spark, layout).select("c_custkey", "c_acctbal", "c_country")


@query("drift_ignore", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drift_ignore(spark, sf_dir):
    return drift.ignore(_delivery(spark, sf_dir, 2), table(spark, sf_dir, "customer"))
