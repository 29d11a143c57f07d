import pytest
from conftest import count_jobs, plan, rows
from pyspark.sql import functions as F

from featurelake.operators import quality as q


@pytest.fixture(scope="module")
def frame(spark):
    data = [(i, [1.0, None, 3.0, None, 5.0][i], ["active", "inactive", "unknown", None, "active"][i]) for i in range(5)]
    return spark.createDataFrame(data, "id int, col_a double, status string").cache()


def passed(df, *rules):
    return [r["passed"] for r in q.report(df, list(rules)).collect()]


def test_rules(frame):
    assert passed(frame, q.not_null("col_a"), q.not_null("col_a", 0.4)) == [False, True]
    assert passed(frame, q.in_set("status", ["active", "inactive"])) == [False]
    assert passed(frame, q.in_set("status", ["active", "inactive", "unknown"])) == [True]  # NULL is no violation
    assert passed(frame, q.in_range("col_a", 1, 5), q.in_range("col_a", 2), q.in_range("col_a", 2, None, 0.2)) == [
        True, False, True]
    assert passed(frame, q.unique("id"), q.unique("status")) == [True, False]
    assert passed(frame, q.row_count(5), q.row_count(6), q.row_count(1, 4)) == [True, False, False]
    assert passed(frame, q.custom("sum", F.sum("id"), lambda n, s: s == 10)) == [True]


def test_schema(frame, spark):
    good = frame.select("id", "status").schema
    assert passed(frame, q.schema_match(good), q.schema_match(good, allow_extra_columns=False)) == [True, False]
    other = spark.createDataFrame([], "id string, more int").schema
    row = q.report(frame, [q.schema_match(other)]).first()
    assert not row["passed"] and "more" in row["details"]["missing_columns"] and "id" in row["details"]["type_mismatches"]


def test_outliers(spark):
    df = spark.range(100).select(F.when(F.col("id") < 10, 1e6).otherwise(F.col("id").cast("double")).alias("x"))
    assert passed(df, q.iqr_outliers("x"), q.iqr_outliers("x", max_outlier_fraction=0.15)) == [False, True]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    assert passed(df, q.not_null("a"), q.in_range("a", 0, 1), q.iqr_outliers("a"), q.unique("a"), q.row_count(1)) == [
        True, True, True, True, False]


def test_all_rules_run_in_one_aggregate(spark, frame):
    rules = [q.not_null("col_a"), q.in_range("col_a", 0), q.in_set("status", ["active"]), q.row_count(1)]
    frame.count()
    assert count_jobs(spark, lambda: q.report(frame, rules).collect()) <= 2  # one shuffle of one row
    assert plan(q.report(frame, rules)).count("Scan") <= 2


def test_broken_rule_counts_as_failed(frame):
    rows_ = {r["rule_name"]: r for r in q.report(frame, [q.not_null("nope"), q.iqr_outliers("nope"), q.row_count(1)]).collect()}
    assert not rows_["not_null_nope"]["passed"] and "error" in rows_["not_null_nope"]["details"]
    assert not rows_["outlier_iqr_nope"]["passed"] and rows_["row_count"]["passed"]


def test_rule_failing_at_run_time(spark, frame):
    bad = q.custom("boom", F.sum(F.col("status").cast("int")), lambda n, s: s > 0)
    got = {r["rule_name"]: r["passed"] for r in q.validate(frame, [bad, q.row_count(1)], False).collect()}
    assert got == {"boom": False, "row_count": True}


def test_summary_and_critical(frame):
    rules = [q.not_null("col_a"), q.row_count(1), q.in_set("status", ["x"], q.INFO), q.unique("status")]
    s = q.summarize(q.validate(frame, rules, fail_on_critical=False)).first()
    assert (s["total_rules"], s["passed_rules"], s["critical_failures"], s["warning_failures"]) == (4, 1, 1, 1)
    assert s["quality_score"] == 25.0 and s["is_valid"] is False
    with pytest.raises(ValueError, match="not_null_col_a"):
        q.validate(frame, rules)
    empty = q.summarize(q.report(frame, [])).first()
    assert empty["quality_score"] == 0.0 and empty["is_valid"]


def test_quarantine(spark):
    df = spark.createDataFrame([(5.0, "visa"), (-1.0, "visa"), (2e6, "x"), (None, "visa")], "amount double, card string")
    good, bad = q.quarantine(df, q.request_constraints("amount", 100000, {"card": ["visa"]}))
    assert rows(good) == [(5.0, "visa")]
    got = {r["amount"]: r["reasons"] for r in bad.collect()}
    assert got[2e6] == ["amount_at_most_100000", "card_known"] and len(got[None]) == 2
