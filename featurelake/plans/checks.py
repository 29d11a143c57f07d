"""Queries over data quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from .registry import SPARSE_SQL, query, sparse_events, table

FIELDS = ["rule_name", "severity", "passed", "total", "violations", "fraction"]


def _report(df, *rules):
    return q.report(df, list(rules)).select(*FIELDS)


def _sql(name, severity, bad, passed, source="sparse", with_=SPARSE_SQL):
    head = f"WITH {with_} " if with_ else ""
    return f"""{head}SELECT '{name}' AS rule_name, '{severity}' AS severity, {passed} AS passed, n AS total, bad AS violations,
      round(bad::DOUBLE / n, 6) AS fraction FROM (SELECT count(*) AS n, {bad} AS bad FROM {source})"""


@query("check_not_null", _sql("not_null_value", "critical", "count(*) FILTER (value IS NULL)", "bad::DOUBLE / n <= 0.2"))
def check_not_null(spark, d):
    return _report(sparse_events(spark, d), q.not_null("value", 0.2))


@query(
    "check_range",
    _sql("range_value", "warning", "count(*) FILTER (value < 1 OR value > 100)", "bad::DOUBLE / n <= 0.05"),
)
def check_range(spark, d):
    return _report(sparse_events(spark, d), q.in_range("value", 1, 100, 0.05))


@query(
    "check_in_set",
    _sql("in_set_event_type", "warning", "count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase'))", "bad = 0"),
)
def check_in_set(spark, d):
    return _report(sparse_events(spark, d), q.in_set("event_type", ["view", "click", "purchase"]))


@query(
    "check_unique",
    _sql("unique_value", "warning", "count(value) - count(DISTINCT value)", "bad = 0"),
)
def check_unique(spark, d):
    return _report(sparse_events(spark, d), q.unique("value"))


@query("check_schema", "SELECT 'schema_match' AS rule_name, 'critical' AS severity, true AS passed, count(*) AS total, "
       "NULL::BIGINT AS violations, NULL::DOUBLE AS fraction FROM orders")
def check_schema(spark, d):
    orders = table(spark, d, "orders")
    return _report(orders, q.schema_match(orders.select("o_orderkey", "o_totalprice").schema))


FENCE = """(SELECT value, quantile_cont(value, 0.25) OVER () AS a, quantile_cont(value, 0.75) OVER () AS b FROM sparse)"""
OUTSIDE = "count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a))"


@query("check_outliers_iqr", _sql("outlier_iqr_value", "warning", OUTSIDE, "bad::DOUBLE / n <= 0.05", FENCE))
def check_outliers_iqr(spark, d):
    return _report(sparse_events(spark, d), q.iqr_outliers("value"))


@query(
    "check_row_count",
    "SELECT 'row_count' AS rule_name, 'critical' AS severity, n >= 100 AS passed, n AS total, NULL::BIGINT AS violations, "
    "NULL::DOUBLE AS fraction FROM (SELECT count(*) AS n FROM events)",
)
def check_row_count(spark, d):
    return _report(table(spark, d, "events"), q.row_count(100))


@query("custom_rule", _sql("few_users", "warning", "count(DISTINCT user_id)", "bad < n / 10"))
def custom_rule(spark, d):
    rule = q.custom("few_users", F.count_distinct("user_id"), lambda total, users: users < total / 10)
    return _report(sparse_events(spark, d), rule)


def suite():
    return [
        q.row_count(100), q.not_null("value", 0.2), q.not_null("event_type"), q.in_range("value", 0, 100),
        q.in_set("event_type", ["view", "click", "purchase", "signup", "error"]), q.unique("event_id"),
        q.iqr_outliers("value"),
    ]


@query(
    "validation_report",
    f"""WITH {SPARSE_SQL}, f AS {FENCE}, r AS (SELECT count(*) AS n, count(*) FILTER (value IS NULL) AS a,
          count(*) FILTER (event_type IS NULL) AS b, count(*) FILTER (value < 0 OR value > 100) AS c,
          count(event_id) - count(DISTINCT event_id) AS u FROM sparse), o AS (SELECT {OUTSIDE} AS o FROM f),
        v AS (SELECT 'critical' AS s, n >= 100 AS p FROM r UNION ALL SELECT 'critical', a::DOUBLE / n <= 0.2 FROM r
          UNION ALL SELECT 'critical', b = 0 FROM r UNION ALL SELECT 'warning', c = 0 FROM r
          UNION ALL SELECT 'warning', true FROM r UNION ALL SELECT 'warning', u = 0 FROM r
          UNION ALL SELECT 'warning', o::DOUBLE / n <= 0.05 FROM o, r)
        SELECT count(*) AS total_rules, count(*) FILTER (p) AS passed_rules, count(*) FILTER (NOT p) AS failed_rules,
          count(*) FILTER (NOT p AND s = 'critical') AS critical_failures,
          count(*) FILTER (NOT p AND s = 'warning') AS warning_failures,
          round(count(*) FILTER (p) * 100.0::DOUBLE / count(*), 2) AS quality_score,
          count(*) FILTER (NOT p AND s = 'critical') = 0 AS is_valid FROM v""",
)
def validation_report(spark, d):
    return q.summarize(q.report(sparse_events(spark, d), suite()))


@query(
    "fail_on_critical",
    f"""WITH {SPARSE_SQL} SELECT 'not_null_event_type' AS rule_name, count(*) AS total, count(*) - count(event_type) AS violations
        FROM sparse HAVING count(*) > count(event_type)""",
)
def fail_on_critical(spark, d):
    """The critical failures for which validation raises; it raises here as well, naming them."""
    rows = sparse_events(spark, d)
    results = q.validate(rows, suite(), fail_on_critical=False)
    broken = results.filter("NOT passed AND severity = 'critical'").select("rule_name", "total", "violations")
    try:
        q.validate(rows, suite())
    except ValueError as error:
        names = [r["rule_name"] for r in broken.collect()]
        if not all(n in str(error) for n in names):
            raise
    return broken


@query(
    "request_constraints",
    f"""WITH {SPARSE_SQL}, m AS (SELECT event_id, list_filter([
          CASE WHEN NOT coalesce(value > 0, false) THEN 'value_positive' END,
          CASE WHEN NOT coalesce(value <= 100, false) THEN 'value_at_most_100' END,
          CASE WHEN NOT coalesce(event_type IN ('view', 'click', 'purchase'), false) THEN 'event_type_known' END],
          lambda x: x IS NOT NULL) AS reasons FROM sparse)
        SELECT event_id, array_to_string(reasons, ',') AS reasons FROM m WHERE len(reasons) > 0""",
)
def request_constraints(spark, d):
    rules = q.request_constraints("value", 100, {"event_type": ["view", "click", "purchase"]})
    _, bad = q.quarantine(sparse_events(spark, d), rules)
    return bad.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    "request_constraints_valid",
    f"""WITH {SPARSE_SQL} SELECT event_id, event_type, value FROM sparse
        WHERE value > 0 AND value <= 100 AND event_type IN ('view', 'click', 'purchase')""",
)
def request_constraints_valid(spark, d):
    rules = q.request_constraints("value", 100, {"event_type": ["view", "click", "purchase"]})
    good, _ = q.quarantine(sparse_events(spark, d), rules)
    return good.select("event_id", "event_type", "value")


FRAUD = """(SELECT event_id AS transaction_id, value AS amount, (event_type = 'error')::INT AS is_fraud, event_type AS card_type,
  quantile_cont(value, 0.25) OVER () AS a, quantile_cont(value, 0.75) OVER () AS b FROM events)"""


@query(
    "fraud_suite",
    f"""WITH r AS (SELECT count(*) AS n, count(*) - count(transaction_id) AS k, count(*) - count(amount) AS m,
          count(*) - count(is_fraud) AS l, count(*) FILTER (amount < 0 OR amount > 50000) AS g,
          count(*) FILTER (card_type NOT IN ('visa', 'mastercard', 'amex', 'discover')) AS c,
          count(*) FILTER (amount < a - 1.5 * (b - a) OR amount > b + 1.5 * (b - a)) AS o FROM {FRAUD})
        SELECT unnest(['row_count', 'not_null_transaction_id', 'not_null_amount', 'not_null_is_fraud', 'range_amount',
                       'in_set_card_type', 'outlier_iqr_amount']) AS rule_name,
          unnest(['critical', 'critical', 'critical', 'critical', 'warning', 'warning', 'warning']) AS severity,
          unnest([n >= 100, k = 0, m = 0, l = 0, g = 0, c = 0, o::DOUBLE / n <= 0.15]) AS passed, n AS total,
          unnest([NULL, k, m, l, g, c, o]) AS violations,
          unnest([NULL, round(k::DOUBLE / n, 6), round(m::DOUBLE / n, 6), round(l::DOUBLE / n, 6), round(g::DOUBLE / n, 6),
                  round(c::DOUBLE / n, 6), round(o::DOUBLE / n, 6)]) AS fraction FROM r""",
)
def fraud_suite(spark, d):
    rows = table(spark, d, "events").select(
        F.col("event_id").alias("transaction_id"), F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"), F.col("event_type").alias("card_type"))
    return _report(rows, *q.fraud_suite())
