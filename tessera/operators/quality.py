"""Data quality: row flags, rule evaluation, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Rule
from tessera.functions.columns import EMAIL_PATTERN, all_of, as_time
from tessera.operators.key_counts import digest as key_digest
from tessera.plans.lookup import common_type, fits_broadcast, lookup_join, mark_known, mark_repeated

# --- row flags -------------------------------------------------------------------------------------


def _in_range(column: str, low, high) -> Column:
    """Inside the bounds; a missing bound is open, null is outside."""
    bounds = [F.col(column).isNotNull()]
    if low is not None:
        bounds.append(F.col(column) >= F.lit(low))
    if high is not None:
        bounds.append(F.col(column) <= F.lit(high))
    return all_of(bounds)


def _matches(column: str, pattern: str) -> Column:
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"_dq_{column}_not_null", F.col(column).isNotNull())


def unique(df: DataFrame, column: str, always_split: bool = False) -> DataFrame:
    """Flag: the value occurs once; null is false."""
    marked = mark_repeated(df, [column], "__repeated", always_split)
    flag = ~F.col("__repeated") & F.col(column).isNotNull()
    return marked.withColumn(f"_dq_{column}_unique", flag).drop("__repeated")


def value_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.withColumn(f"_dq_{column}_range", _in_range(column, low, high))


def regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.withColumn(f"_dq_{column}_regex", _matches(column, pattern))


def foreign_key(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    return mark_known(df, column, reference, reference_column, f"_dq_{column}_fk")


def apply_all(
    df: DataFrame, checks: list[dict], references: dict[str, DataFrame] | None = None
) -> DataFrame:
    """All flags of a list of ``{type, column, params}`` checks, and ``_dq_all_passed``.

    Flags that look at one row share a projection; checks of unknown type are skipped. No flags, no
    change.
    """
    local: dict[str, Column] = {}
    names: list[str] = []
    for check in checks:
        kind, column, params = check.get("type"), check.get("column"), check.get("params", {})
        if kind == "not_null":
            flag, value = f"_dq_{column}_not_null", F.col(column).isNotNull()
        elif kind == "range":
            flag, value = f"_dq_{column}_range", _in_range(column, params.get("min"), params.get("max"))
        elif kind == "regex":
            flag, value = f"_dq_{column}_regex", _matches(column, params["pattern"])
        elif kind == "unique":
            df, flag, value = unique(df, column), f"_dq_{column}_unique", None
        elif kind == "foreign_key":
            reference = (references or {})[params["ref_table"]]
            df = foreign_key(df, column, reference, params.get("ref_column", column))
            flag, value = f"_dq_{column}_fk", None
        else:
            continue
        names.append(flag)
        if value is not None:
            local[flag] = value
    if not names:
        return df
    return df.withColumns(local).withColumn("_dq_all_passed", all_of([F.col(n) for n in names]))


# --- rules -----------------------------------------------------------------------------------------

RULE_COLUMNS = [
    "RuleId",
    "EntityId",
    "RuleName",
    "RuleType",
    "ColumnName",
    "ExpectedValue",
    "MinValue",
    "MaxValue",
    "RegexPattern",
    "RefTable",
    "RefColumn",
    "Severity",
    "QuarantineEnabled",
]

# The rules used when an entity's rules cannot be read.
DEFAULT_RULES = [
    Rule(1, "Primary Key Not Null", "NOT_NULL", "CustomerID", "CRITICAL"),
    Rule(2, "Email Format", "EMAIL_FORMAT", "Email", "ERROR", pattern=EMAIL_PATTERN),
    Rule(3, "Order Amount Range", "RANGE", "OrderAmount", "ERROR", True, 0, 999999),
]


def rules_of(rules: DataFrame, entity_id: int) -> DataFrame:
    """Active rules of an entity."""
    return rules.where((F.col("EntityId") == entity_id) & F.col("IsActive")).select(*RULE_COLUMNS)


def expected_values(rules: DataFrame) -> DataFrame:
    """Typed bounds, pattern and reference, from the typed columns or else from ``ExpectedValue``.

    The text holds ``min|max`` for ranges, the pattern for regex rules, ``table.column`` for
    references.
    """
    text = F.col("ExpectedValue")

    def part(kind: str, separator: str, position: int) -> Column:
        piece = F.element_at(F.split(text, separator), position)
        return F.when(F.col("RuleType") == kind, F.nullif(piece, F.lit("")))

    pattern = F.when(F.col("RuleType") == "REGEX", text)
    return rules.withColumns(
        {
            "MinValue": F.coalesce("MinValue", part("RANGE", "\\|", 1).try_cast("decimal(18,4)")),
            "MaxValue": F.coalesce("MaxValue", part("RANGE", "\\|", 2).try_cast("decimal(18,4)")),
            "RegexPattern": F.coalesce("RegexPattern", pattern),
            "RefTable": F.coalesce("RefTable", part("REF_INTEGRITY", "\\.", 1)),
            "RefColumn": F.coalesce("RefColumn", part("REF_INTEGRITY", "\\.", 2)),
        }
    )


def load_rules(rules: DataFrame | None, entity_id: int) -> list[Rule]:
    """The entity's rules as configuration objects; the default rules when there is no rule table."""
    if rules is None:
        return list(DEFAULT_RULES)

    def number(value):
        return None if value is None else float(value)

    return [
        Rule(
            r["RuleId"],
            r["RuleName"],
            r["RuleType"],
            r["ColumnName"],
            r["Severity"],
            r["QuarantineEnabled"],
            number(r["MinValue"]),
            number(r["MaxValue"]),
            r["RegexPattern"],
            r["RefTable"],
            r["RefColumn"],
        )
        for r in expected_values(rules_of(rules, entity_id)).orderBy("RuleId").collect()
    ]


def _row_failure(rule: Rule) -> Column | None:
    """Failure test of a rule that looks at a single row."""
    if rule.kind == "NOT_NULL":
        return F.col(rule.column).isNull()
    if rule.kind == "RANGE":
        return ~_in_range(rule.column, rule.min_value, rule.max_value)
    if rule.kind == "REGEX":
        return ~_matches(rule.column, rule.pattern or ".*")
    if rule.kind == "EMAIL_FORMAT":
        return ~_matches(rule.column, EMAIL_PATTERN)
    return None


RESULT = (
    "rule_id int, rule_name string, rule_type string, column_name string, severity string, "
    "quarantine boolean, status string, total long, failed long"
)


def _result(rule: Rule, status: str, total: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.kind).alias("rule_type"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.quarantine).alias("quarantine"),
        F.lit(status).alias("status"),
        total.cast("long").alias("total"),
        failed.cast("long").alias("failed"),
    )


def _reference_counts(df: DataFrame, rule: Rule, reference: DataFrame) -> DataFrame:
    """Rows and failures of a reference rule, for a reference too large to broadcast.

    Rows are counted per key first, so the join with the reference sees every key once.
    """
    kind = common_type(df.sparkSession, df.schema[rule.column].dataType, reference.schema[rule.ref_column].dataType)
    known = reference.select(F.col(rule.ref_column).cast(kind).alias("__known")).distinct()
    per_key = df.groupBy(F.col(rule.column).cast(kind).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    matched = per_key.join(known, F.col("__key") == F.col("__known"), "left")
    missing = F.when(F.col("__known").isNull(), F.col("__n")).otherwise(0)
    return matched.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("failed"),
    )


def evaluate(
    df: DataFrame,
    rules: list[Rule],
    references: dict[str, DataFrame] | None = None,
    always_split: bool = False,
) -> DataFrame:
    """One result row per rule.

    All rules share a single aggregate over one scan. Reference tables join as markers while they can
    be broadcast; larger ones are checked on pre-counted keys. A rule without its reference table is
    SKIPPED, a rule of unknown type UNSUPPORTED; both count no failure.
    """
    references = references or {}
    shared = df
    counts: dict[str, Column] = {"total": F.count(F.lit(1))}
    outcome: list[tuple[Rule, str, Column | None]] = []
    separate: list[DataFrame] = []
    for i, rule in enumerate(rules):
        name = f"failed_{i}"
        test = _row_failure(rule)
        if test is not None:
            counts[name] = F.count_if(test)
        elif rule.kind == "UNIQUE":
            any_null = F.max(F.col(rule.column).isNull().cast("int"))
            distinct = F.count_distinct(F.col(rule.column)) + F.coalesce(any_null, F.lit(0))
            counts[name] = F.count(F.lit(1)) - distinct
        elif rule.kind == "REF_INTEGRITY" and references.get(rule.ref_table) is not None:
            reference = references[rule.ref_table].select(rule.ref_column)
            if always_split or not fits_broadcast(reference):
                found = _reference_counts(df, rule, reference)
                row = _result(rule, "EVALUATED", F.col("total"), F.col("failed"))
                separate.append(found.select(F.inline(F.array(row))))
                continue
            marker = f"__known_{i}"
            shared = mark_known(shared, rule.column, reference, rule.ref_column, marker)
            counts[name] = F.count_if(~F.col(marker))
        else:
            status = "SKIPPED" if rule.kind == "REF_INTEGRITY" else "UNSUPPORTED"
            outcome.append((rule, status, None))
            continue
        outcome.append((rule, "EVALUATED", F.col(name)))
    parts = list(separate)
    if outcome:
        one_row = shared.agg(*[e.alias(n) for n, e in counts.items()])
        results = [
            _result(rule, status, F.col("total"), failed if failed is not None else F.lit(0))
            for rule, status, failed in outcome
        ]
        parts.insert(0, one_row.select(F.inline(F.array(*results))))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT).transform(_with_rate)
    return _with_rate(reduce(DataFrame.unionByName, parts))


def unique_results(spark: SparkSession, found: dict[int, tuple[Rule, int, int]]) -> DataFrame:
    """Result rows of unique rules from counts of the whole table, (rule, rows, different keys) by rule id."""
    rows = [
        (r.rule_id, r.name, r.kind, r.column, r.severity, r.quarantine, "EVALUATED", n, n - keys) for r, n, keys in found.values()
    ]
    return _with_rate(spark.createDataFrame(rows, RESULT))


def _with_rate(results: DataFrame) -> DataFrame:
    rate = F.coalesce(F.round(F.try_divide(F.col("failed") * 100.0, F.col("total")), 2), F.lit(0.0))
    return results.withColumns({"failure_rate": rate, "passed": F.col("failed") == 0})


def status(results: DataFrame) -> DataFrame:
    """One row: QUARANTINED when a critical rule fails, and the counts of evaluated rules."""
    evaluated = F.col("status") == "EVALUATED"
    critical = F.count_if(~F.col("passed") & (F.col("severity") == "CRITICAL"))
    counts = results.agg(
        F.count_if(evaluated).alias("rules_evaluated"),
        F.count_if(evaluated & F.col("passed")).alias("rules_passed"),
        F.count_if(evaluated & ~F.col("passed")).alias("rules_failed"),
        critical.alias("critical_failures"),
    )
    overall = F.when(F.col("critical_failures") > 0, "QUARANTINED").otherwise("SUCCEEDED")
    return counts.select(overall.alias("status"), *counts.columns)


def failed_rules(
    df: DataFrame,
    rules: list[Rule],
    references: dict[str, DataFrame] | None = None,
    always_split: bool = False,
    repeated: dict[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Every row with ``_dq_failed_rules``: names of the quarantine-enabled rules it breaks.

    A unique rule is broken by every row of a repeated value. ``repeated`` gives, by column, the digests of
    repeated keys where ``df`` is only a part of the table; see ``key_counts``.
    """
    references = references or {}
    broken: list[Column] = []
    helpers: list[str] = []
    for i, rule in enumerate(r for r in rules if r.quarantine):
        test = _row_failure(rule)
        marker = f"__rule_{i}"
        if test is None and rule.kind == "UNIQUE" and rule.column in (repeated or {}) and repeated[rule.column] is None:
            test = F.lit(False)
        elif test is None and rule.kind == "UNIQUE" and rule.column in (repeated or {}):
            told = repeated[rule.column].withColumn(marker, F.lit(True))
            kept = df.columns
            keyed = df.withColumn("__digest", key_digest(rule.column))
            df = lookup_join(keyed, told, {"__digest": "key"}, [marker], always_split=always_split).select(*[f"`{c}`" for c in kept], marker)
            test = F.coalesce(F.col(marker), F.lit(False))
        elif test is None and rule.kind == "UNIQUE":
            df = mark_repeated(df, [rule.column], marker, always_split)
            test = F.col(marker)
        elif test is None and rule.kind == "REF_INTEGRITY" and rule.ref_table in references:
            reference = references[rule.ref_table]
            df = mark_known(df, rule.column, reference, rule.ref_column, marker, always_split)
            test = ~F.col(marker)
        if test is None:
            continue
        if marker in df.columns:
            helpers.append(marker)
        broken.append(F.when(test, F.lit(rule.name)))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("_dq_failed_rules", names).drop(*helpers)


def quarantine_split(
    df: DataFrame,
    rules: list[Rule],
    references: dict[str, DataFrame] | None = None,
    always_split: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a row is bad exactly when it breaks a quarantine-enabled rule."""
    checked = failed_rules(df, rules, references, always_split)
    clean = F.size("_dq_failed_rules") == 0
    return checked.where(clean).drop("_dq_failed_rules"), checked.where(~clean)


def results_table(results: DataFrame, entity_run_id: str, as_of) -> DataFrame:
    """Result rows in the shape of the results table; empty inputs leave no row."""
    return results.where((F.col("total") != 0) & (F.col("status") == "EVALUATED")).select(
        F.lit(entity_run_id).alias("EntityRunId"),
        F.col("rule_id").alias("RuleId"),
        F.col("total").alias("TotalRows"),
        F.col("failed").alias("FailedRows"),
        F.col("failure_rate").cast("decimal(5,2)").alias("FailureRate"),
        F.col("passed").alias("Passed"),
        as_time(as_of).alias("EvaluatedTime"),
    )
