"""Data quality on nulls, duplicates, open bounds and empty input."""

from tessera.config import Rule
from tessera.operators import quality
from tests.conftest import rows

SCHEMA = "id int, email string, amount double"


def sample(spark):
    data = [(1, "a@b.co", 5.0), (1, "bad", -1.0), (2, None, None), (None, "c@d.org", 10.0), (None, "e@f.net", 99.0)]
    return spark.createDataFrame(data, SCHEMA)


def results(df, *rules, **references):
    return {r["rule_id"]: r for r in quality.evaluate(df, list(rules), references).collect()}


def test_rules_count_failures(spark):
    found = results(
        sample(spark),
        Rule(1, "n", "NOT_NULL", "id"),
        Rule(2, "u", "UNIQUE", "id"),
        Rule(3, "e", "EMAIL_FORMAT", "email"),
        Rule(4, "r", "RANGE", "amount", min_value=0, max_value=10),
        Rule(5, "low", "RANGE", "amount", min_value=0),
        Rule(6, "open", "RANGE", "amount"),
        Rule(7, "x", "REGEX", "email", pattern="@"),
    )
    # ids 1, 1, 2, null, null: three values, so two rows too many
    assert {k: r["failed"] for k, r in found.items()} == {1: 2, 2: 2, 3: 2, 4: 3, 5: 2, 6: 1, 7: 2}
    assert found[1]["failure_rate"] == 40.0 and not found[1]["passed"] and found[1]["total"] == 5


def test_missing_reference_and_unknown_rule_are_reported(spark):
    found = results(sample(spark), Rule(1, "f", "REF_INTEGRITY", "id", ref_table="absent", ref_column="x"), Rule(2, "c", "CUSTOM", "id"))
    assert [(r["status"], r["passed"]) for r in found.values()] == [("SKIPPED", True), ("UNSUPPORTED", True)]


def test_reference_keys_with_nulls_do_not_hide_valid_rows(spark):
    reference = spark.createDataFrame([(1,), (None,)], "k int")
    found = results(sample(spark), Rule(1, "f", "REF_INTEGRITY", "id", ref_table="r", ref_column="k"), r=reference)
    assert found[1]["failed"] == 3
    flagged = quality.foreign_key(sample(spark), "id", reference, "k")
    assert sorted(r["_dq_id_fk"] for r in flagged.collect()) == [False, False, False, True, True]


def test_empty_input(spark):
    found = results(sample(spark).limit(0), Rule(1, "n", "NOT_NULL", "id"), Rule(2, "u", "UNIQUE", "id"))
    assert all(r["total"] == 0 and r["failed"] == 0 and r["failure_rate"] == 0.0 and r["passed"] for r in found.values())
    assert quality.evaluate(sample(spark), []).count() == 0
    assert quality.results_table(quality.evaluate(sample(spark).limit(0), [Rule(1, "n", "NOT_NULL", "id")]), "r", "2024-01-01").count() == 0


def test_split_is_complete_and_names_the_broken_rules(spark):
    rules = [
        Rule(1, "set", "NOT_NULL", "id", "CRITICAL"),
        Rule(2, "once", "UNIQUE", "id"),
        Rule(3, "mail", "EMAIL_FORMAT", "email"),
        Rule(4, "ignored", "RANGE", "amount", quarantine=False, min_value=1000),
    ]
    df = sample(spark).unionByName(spark.createDataFrame([(7, "g@h.io", 1.0)], SCHEMA))
    good, bad = quality.quarantine_split(df, rules)
    assert rows(good) == [(7, "g@h.io", 1.0)]
    assert good.count() + bad.count() == df.count()
    broken = {(r["id"], r["email"]): r["_dq_failed_rules"] for r in bad.collect()}
    assert broken[(1, "bad")] == ["once", "mail"]
    assert broken[(2, None)] == ["mail"]
    assert broken[(None, "c@d.org")] == ["set", "once"]


def test_status(spark):
    failing = quality.evaluate(sample(spark), [Rule(1, "n", "NOT_NULL", "id", "CRITICAL"), Rule(2, "o", "RANGE", "id", "ERROR")])
    assert tuple(quality.status(failing).first()) == ("QUARANTINED", 2, 0, 2, 1)
    passing = quality.evaluate(sample(spark), [Rule(1, "n", "REGEX", "email", "ERROR", pattern="zzz")])
    assert quality.status(passing).first()["status"] == "SUCCEEDED"


def test_all_checks_and_flags(spark):
    checks = [{"type": "not_null", "column": "id"}, {"type": "unique", "column": "id"}, {"type": "nothing", "column": "id"}]
    flagged = quality.apply_all(sample(spark), checks)
    assert [c for c in flagged.columns if c.startswith("_dq")] == ["_dq_id_unique", "_dq_id_not_null", "_dq_all_passed"]
    assert [r["id"] for r in flagged.where("_dq_all_passed").collect()] == [2]
    same = sample(spark)
    assert quality.apply_all(same, []).columns == same.columns


def test_rules_from_a_table(spark):
    schema = (
        "RuleId int, EntityId int, RuleName string, RuleType string, ColumnName string, ExpectedValue string, "
        "MinValue decimal(18,4), MaxValue decimal(18,4), RegexPattern string, RefTable string, RefColumn string, "
        "Severity string, QuarantineEnabled boolean, IsActive boolean"
    )
    blank = (None,) * 5
    table = spark.createDataFrame(
        [
            (1, 1, "r", "RANGE", "amount", "0|999999999.99", *blank, "ERROR", True, True),
            (2, 1, "x", "REGEX", "email", "^a|b$", *blank, "ERROR", True, True),
            (3, 1, "f", "REF_INTEGRITY", "id", "customers.CustomerID", *blank, "CRITICAL", True, True),
            (4, 1, "low", "RANGE", "amount", "0|", *blank, "ERROR", True, True),
            (5, 1, "off", "RANGE", "amount", "0|1", *blank, "ERROR", True, False),
            (6, 2, "other", "NOT_NULL", "id", None, *blank, "ERROR", True, True),
        ],
        schema,
    )
    found = {r.rule_id: r for r in quality.load_rules(table, 1)}
    assert list(found) == [1, 2, 3, 4]
    assert (found[1].min_value, found[1].max_value) == (0.0, 999999999.99)
    assert found[2].pattern == "^a|b$"
    assert (found[3].ref_table, found[3].ref_column) == ("customers", "CustomerID")
    assert (found[4].min_value, found[4].max_value) == (0.0, None)
    assert [r.kind for r in quality.load_rules(None, 1)] == ["NOT_NULL", "EMAIL_FORMAT", "RANGE"]
