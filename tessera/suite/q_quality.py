"""Data quality over dirty customers, orders with orphans, and rule tables."""

from pyspark.sql import functions as F

from tessera.config import Rule
from tessera.operators import quality
from tessera.suite import inputs
from tessera.suite.inputs import AS_OF, sql, table
from tessera.suite.registry import ORACLES, query

EMAIL = "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$"


@query(
    "dq_row_not_null",
    sql("SELECT CustomerID, NationKey, NationKey IS NOT NULL AS _dq_NationKey_not_null FROM customers", "customers"),
    with_nulls=("NationKey",),
)
def dq_row_not_null(spark, sf_dir):
    return quality.not_null(inputs.customers(spark, sf_dir).select("CustomerID", "NationKey"), "NationKey")


@query(
    "dq_row_unique",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, pair,
              count(pair) OVER (PARTITION BY pair) = 1 AS _dq_pair_unique
       FROM (SELECT l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS pair FROM lineitem)""",
)
def dq_row_unique(spark, sf_dir, large=False):
    pair = F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pair.alias("pair"))
    return quality.unique(rows, "pair", large)


@query(
    "dq_row_range",
    sql("SELECT CustomerID, Balance, Balance >= 0 AND Balance <= 9000 AS _dq_Balance_range FROM customers", "customers"),
)
def dq_row_range(spark, sf_dir):
    return quality.value_range(inputs.customers(spark, sf_dir).select("CustomerID", "Balance"), "Balance", 0, 9000)


@query(
    "dq_row_regex",
    sql(f"SELECT CustomerID, Email, regexp_matches(Email, '{EMAIL}') AS _dq_Email_regex FROM customers", "customers"),
)
def dq_row_regex(spark, sf_dir):
    return quality.regex(inputs.customers(spark, sf_dir).select("CustomerID", "Email"), "Email", EMAIL)


@query(
    "dq_row_foreign_key",
    sql(
        """SELECT o_orderkey, o_custkey, o_custkey IN (SELECT c_custkey FROM few_customers) AS _dq_o_custkey_fk
           FROM orders""",
        "few_customers",
    ),
)
def dq_row_foreign_key(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return quality.foreign_key(rows, "o_custkey", inputs.few_customers(spark, sf_dir), "c_custkey")


@query(
    "dq_row_all",
    sql(
        f"""SELECT *, _dq_NationKey_not_null AND _dq_Segment_unique AND _dq_Balance_range AND _dq_Email_regex
                      AND _dq_CustomerID_fk AS _dq_all_passed
            FROM (SELECT CustomerID, NationKey IS NOT NULL AS _dq_NationKey_not_null,
                         count(Segment) OVER (PARTITION BY Segment) = 1 AS _dq_Segment_unique,
                         Balance >= 100 AS _dq_Balance_range,
                         regexp_matches(Email, '{EMAIL}') AS _dq_Email_regex,
                         CustomerID IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
                             AS _dq_CustomerID_fk
                  FROM customers)""",
        "customers",
    ),
)
def dq_row_all(spark, sf_dir):
    checks = [
        {"type": "not_null", "column": "NationKey"},
        {"type": "unique", "column": "Segment"},
        {"type": "range", "column": "Balance", "params": {"min": 100}},
        {"type": "regex", "column": "Email", "params": {"pattern": EMAIL}},
        {"type": "foreign_key", "column": "CustomerID", "params": {"ref_table": "o", "ref_column": "o_custkey"}},
        {"type": "other", "column": "Email"},
    ]
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    flagged = quality.apply_all(inputs.customers(spark, sf_dir), checks, {"o": finished})
    return flagged.select("CustomerID", *[c for c in flagged.columns if c.startswith("_dq_")])


DIRTY_RULES = [
    Rule(1, "nation set", "NOT_NULL", "NationKey", "CRITICAL"),
    Rule(2, "mail form", "EMAIL_FORMAT", "Email"),
    Rule(3, "balance range", "RANGE", "Balance", "ERROR", True, 0, 9000),
    Rule(4, "name unique", "UNIQUE", "CustomerName"),
    Rule(5, "segment form", "REGEX", "Segment", "WARNING", False, pattern="^[A-Z]+$"),
]

FAILED_SQL = f"""
    SELECT *, concat_ws(',', CASE WHEN NationKey IS NULL THEN 'nation set' END,
                       CASE WHEN NOT regexp_matches(Email, '{EMAIL}') THEN 'mail form' END,
                       CASE WHEN Balance < 0 OR Balance > 9000 THEN 'balance range' END,
                       CASE WHEN count(*) OVER (PARTITION BY CustomerName) > 1 THEN 'name unique' END)
              AS failed_rules
    FROM customers"""


def _one(rule, rows, failed, frm, condition=""):
    """Comparison SQL of a single rule: total, failed, rate, passed."""
    return f"""
        SELECT {rule.rule_id}::BIGINT AS rule_id, '{rule.kind}' AS rule_type, {rows} AS total, failed,
               round(failed * 100.0::DOUBLE / {rows}, 2) AS failure_rate, failed = 0 AS passed
        FROM (SELECT count(*) AS n, ({failed})::BIGINT AS failed FROM {frm} {condition})"""


def _evaluated(df, *rules, **references):
    return quality.evaluate(df, list(rules), references).select(
        "rule_id", "rule_type", "total", "failed", "failure_rate", "passed"
    )


@query("dq_rule_not_null", sql(_one(DIRTY_RULES[0], "n", "count(*) FILTER (NationKey IS NULL)", "customers"), "customers"))
def dq_rule_not_null(spark, sf_dir):
    return _evaluated(inputs.customers(spark, sf_dir), DIRTY_RULES[0])


PART_NAME = Rule(6, "part name unique", "UNIQUE", "p_name")


@query("dq_rule_unique", _one(PART_NAME, "n", "count(*) - count(DISTINCT p_name)", "part"))
def dq_rule_unique(spark, sf_dir):
    return _evaluated(table(spark, sf_dir, "part"), PART_NAME)


PRIORITY = Rule(7, "urgent or high", "REGEX", "o_orderpriority", pattern="^[12]-")


@query("dq_rule_regex", _one(PRIORITY, "n", "count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[12]-'))", "orders"))
def dq_rule_regex(spark, sf_dir):
    return _evaluated(table(spark, sf_dir, "orders"), PRIORITY)


@query("dq_rule_email", sql(_one(DIRTY_RULES[1], "n", f"count(*) FILTER (NOT regexp_matches(Email, '{EMAIL}'))", "customers"), "customers"))
def dq_rule_email(spark, sf_dir):
    return _evaluated(inputs.customers(spark, sf_dir), DIRTY_RULES[1])


PRICE = Rule(8, "price range", "RANGE", "o_totalprice", min_value=1000, max_value=400000)


@query("dq_rule_range", _one(PRICE, "n", "count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000)", "orders"))
def dq_rule_range(spark, sf_dir):
    return _evaluated(table(spark, sf_dir, "orders"), PRICE)


KNOWN = Rule(9, "customer known", "REF_INTEGRITY", "o_custkey", "CRITICAL", ref_table="customer", ref_column="c_custkey")


@query(
    "dq_rule_ref_integrity",
    sql(_one(KNOWN, "n", "count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM few_customers))", "orders"), "few_customers"),
)
def dq_rule_ref_integrity(spark, sf_dir):
    return _evaluated(table(spark, sf_dir, "orders"), KNOWN, customer=inputs.few_customers(spark, sf_dir))


_RULES = "RuleId, EntityId, RuleName, RuleType, ColumnName, ExpectedValue, MinValue, MaxValue, RegexPattern, RefTable, RefColumn, Severity, QuarantineEnabled"


@query("dq_rules_load", sql(f"SELECT {_RULES} FROM rules WHERE EntityId = 7 AND IsActive", "rules"))
def dq_rules_load(spark, sf_dir):
    return quality.rules_of(inputs.rules(spark, sf_dir), 7)


@query(
    "dq_rules_expected_value",
    sql(
        """SELECT RuleId, RuleType,
                  CASE WHEN RuleType = 'RANGE' THEN split_part(ExpectedValue, '|', 1)::DOUBLE END AS MinValue,
                  coalesce(MaxValue, CASE WHEN RuleType = 'RANGE'
                                          THEN split_part(ExpectedValue, '|', 2)::DOUBLE END) AS MaxValue,
                  CASE WHEN RuleType = 'REGEX' THEN ExpectedValue END AS RegexPattern,
                  CASE WHEN RuleType = 'REF_INTEGRITY' THEN 'customers' END AS RefTable,
                  CASE WHEN RuleType = 'REF_INTEGRITY' THEN 'CustomerID' END AS RefColumn
           FROM rules""",
        "rules",
    ),
)
def dq_rules_expected_value(spark, sf_dir):
    typed = quality.expected_values(inputs.rules(spark, sf_dir))
    return typed.select("RuleId", "RuleType", "MinValue", "MaxValue", "RegexPattern", "RefTable", "RefColumn")


ORDER_RULES = [
    Rule(1, "key set", "NOT_NULL", "o_orderkey", "CRITICAL"),
    Rule(2, "key unique", "UNIQUE", "o_orderkey", "CRITICAL"),
    Rule(3, "customer unique", "UNIQUE", "o_custkey", "WARNING", False),
    PRIORITY,
    PRICE,
    KNOWN,
    Rule(10, "missing table", "REF_INTEGRITY", "o_custkey", ref_table="absent", ref_column="x"),
    Rule(11, "own code", "CUSTOM", "o_custkey"),
]

_EVALUATED = """
    SELECT rule_id::BIGINT AS rule_id, rule_name, rule_type, severity, status, n AS total, failed::BIGINT AS failed,
           round(failed * 100.0::DOUBLE / n, 2) AS failure_rate, failed = 0 AS passed
    FROM (SELECT count(*) AS n,
                 count(*) - count(DISTINCT o_custkey) AS dup,
                 count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[12]-')) AS prio,
                 count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) AS price,
                 count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM few_customers)) AS orphan
          FROM orders) AS c,
         LATERAL (VALUES (1, 'key set', 'NOT_NULL', 'CRITICAL', 'EVALUATED', 0),
                         (2, 'key unique', 'UNIQUE', 'CRITICAL', 'EVALUATED', 0),
                         (3, 'customer unique', 'UNIQUE', 'WARNING', 'EVALUATED', c.dup),
                         (7, 'urgent or high', 'REGEX', 'ERROR', 'EVALUATED', c.prio),
                         (8, 'price range', 'RANGE', 'ERROR', 'EVALUATED', c.price),
                         (9, 'customer known', 'REF_INTEGRITY', 'CRITICAL', 'EVALUATED', c.orphan),
                         (10, 'missing table', 'REF_INTEGRITY', 'ERROR', 'SKIPPED', 0),
                         (11, 'own code', 'CUSTOM', 'ERROR', 'UNSUPPORTED', 0)
                 ) AS r(rule_id, rule_name, rule_type, severity, status, failed)"""


def _orders_evaluated(spark, sf_dir, large=False):
    references = {"customer": inputs.few_customers(spark, sf_dir)}
    return quality.evaluate(table(spark, sf_dir, "orders"), ORDER_RULES, references, large)


@query("dq_evaluate", sql(_EVALUATED, "few_customers"))
def dq_evaluate(spark, sf_dir):
    return _orders_evaluated(spark, sf_dir).drop("column_name", "quarantine")


@query(
    "dq_status",
    sql(
        f"""SELECT CASE WHEN critical_failures > 0 THEN 'QUARANTINED' ELSE 'SUCCEEDED' END AS status, *
            FROM (SELECT count(*) FILTER (status = 'EVALUATED') AS rules_evaluated,
                         count(*) FILTER (status = 'EVALUATED' AND passed) AS rules_passed,
                         count(*) FILTER (status = 'EVALUATED' AND NOT passed) AS rules_failed,
                         count(*) FILTER (severity = 'CRITICAL' AND NOT passed) AS critical_failures
                  FROM ({_EVALUATED}))""",
        "few_customers",
    ),
)
def dq_status(spark, sf_dir):
    return quality.status(_orders_evaluated(spark, sf_dir))


@query(
    "dq_quarantine_split",
    sql(
        f"""SELECT CustomerID, CASE WHEN failed_rules = '' THEN 'good' ELSE 'bad' END AS part, failed_rules
            FROM ({FAILED_SQL})""",
        "customers",
    ),
)
def dq_quarantine_split(spark, sf_dir, large=False):
    good, bad = quality.quarantine_split(inputs.customers(spark, sf_dir), DIRTY_RULES, always_split=large)
    kept = good.select("CustomerID", F.lit("good").alias("part"), F.lit("").alias("failed_rules"))
    names = F.array_join("_dq_failed_rules", ",").alias("failed_rules")
    return kept.unionByName(bad.select("CustomerID", F.lit("bad").alias("part"), names))


@query(
    "dq_results_table",
    sql(
        f"""SELECT 'run-1' AS EntityRunId, rule_id AS RuleId, total AS TotalRows, failed AS FailedRows,
                   failure_rate AS FailureRate, passed AS Passed, TIMESTAMP '{AS_OF}' AS EvaluatedTime
            FROM ({_EVALUATED}) WHERE status = 'EVALUATED'""",
        "few_customers",
    ),
)
def dq_results_table(spark, sf_dir):
    return quality.results_table(_orders_evaluated(spark, sf_dir), "run-1", AS_OF)


# The same with the plan that large tables get, heavy keys salted.


@query("dq_row_unique_large", ORACLES["dq_row_unique"])
def dq_row_unique_large(spark, sf_dir):
    return dq_row_unique(spark, sf_dir, True)


@query("dq_quarantine_split_large", ORACLES["dq_quarantine_split"])
def dq_quarantine_split_large(spark, sf_dir):
    return dq_quarantine_split(spark, sf_dir, True)


@query("dq_evaluate_large", ORACLES["dq_evaluate"])
def dq_evaluate_large(spark, sf_dir):
    return _orders_evaluated(spark, sf_dir, True).drop("column_name", "quarantine")
