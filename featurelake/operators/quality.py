"""Declarative quality rules that run together in one aggregate over the table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_of, as_list, measured
from ..functions.quantiles import quantiles

CRITICAL, WARNING, INFO = "critical", "warning", "info"

RESULT = (
    "rule_name string, severity string, passed boolean, total bigint, violations bigint, "
    "fraction double, details map<string,string>"
)


@dataclass(frozen=True)
class Rule:
    """One rule: an aggregate that counts violations, and what number of them still passes."""

    name: str
    severity: str
    violations: Callable[[DataFrame, dict], Column] | None
    passes: Callable[[Column, Column], Column]
    details: dict = field(default_factory=dict)
    fence: tuple[str, float] | None = None  # column and multiplier of an IQR rule
    schema: Callable[[T.StructType], tuple[bool, dict]] | None = None
    apart: Callable[[DataFrame], DataFrame] | None = None  # counts violations by a grouping of its own: one row, one number


def _share(limit: float) -> Callable[[Column, Column], Column]:
    return lambda total, bad: (total == 0) | (bad / total <= limit)


def not_null(column: str, max_null_fraction: float = 0.0, severity: str = CRITICAL) -> Rule:
    return Rule(
        f"not_null_{column}", severity, lambda df, _: F.count_if(measured(df, column).isNull()),
        _share(max_null_fraction), {"column": column, "threshold": max_null_fraction},
    )


def in_range(
    column: str, min_value=None, max_value=None, max_out_of_range_fraction: float = 0.0, severity: str = WARNING
) -> Rule:
    """Inclusive bounds; NULL and NaN are never outside but count in the denominator."""

    def bad(df, _):
        outside = [F.lit(False)]
        if min_value is not None:
            outside.append(measured(df, column) < min_value)
        if max_value is not None:
            outside.append(measured(df, column) > max_value)
        return F.count_if(any_of(outside))

    return Rule(
        f"range_{column}", severity, bad, _share(max_out_of_range_fraction),
        {"column": column, "min_value": min_value, "max_value": max_value, "threshold": max_out_of_range_fraction},
    )


def in_set(column: str, allowed_values, severity: str = WARNING) -> Rule:
    """NULL is not a violation, as in SQL."""
    allowed = list(allowed_values)
    return Rule(
        f"in_set_{column}", severity, lambda df, _: F.count_if(~F.col(column).isin(allowed)),
        lambda total, bad: bad == 0, {"column": column, "allowed_values": allowed},
    )


def unique(column: str, severity: str = WARNING) -> Rule:
    """No value twice; NULLs are not compared.

    Values are counted in two steps beside the shared aggregate: inside it, every distinct value would carry the buffers
    of all other rules through the shuffle, and two such rules would read every row twice.
    """

    def repeats(df: DataFrame) -> DataFrame:
        counts = df.select(column).filter(F.col(column).isNotNull()).groupBy(column).agg((F.count(F.lit(1)) - 1).alias("n"))
        return counts.agg(F.coalesce(F.sum("n"), F.lit(0)))

    return Rule(f"unique_{column}", severity, None, lambda total, bad: bad == 0, {"column": column}, apart=repeats)


def iqr_outliers(
    column: str, iqr_multiplier: float = 1.5, max_outlier_fraction: float = 0.05, severity: str = WARNING
) -> Rule:
    def bad(df, fences):
        low, high = fences[(column, iqr_multiplier)]
        return F.count_if((measured(df, column) < low) | (measured(df, column) > high))

    return Rule(
        f"outlier_iqr_{column}", severity, bad, _share(max_outlier_fraction),
        {"column": column, "threshold": max_outlier_fraction}, fence=(column, iqr_multiplier),
    )


def row_count(min_count: int = 1, max_count: int | None = None, severity: str = CRITICAL) -> Rule:
    def ok(total, _):
        inside = total >= min_count
        return inside & (total <= max_count) if max_count is not None else inside

    return Rule(
        "row_count", severity, None, ok, {"min_count": min_count, "max_count": max_count}
    )


def custom(name: str, measure: Column, passes: Callable[[Column, Column], Column], severity: str = WARNING) -> Rule:
    """Own aggregate (one number per table) and a predicate over (row count, number)."""
    return Rule(name, severity, lambda df, _: measure, passes)


def schema_match(expected: T.StructType, allow_extra_columns: bool = True, severity: str = CRITICAL) -> Rule:
    """Names and types; needs no job."""

    def check(actual: T.StructType):
        have = {f.name: f.dataType for f in actual}
        want = {f.name: f.dataType for f in expected}
        missing = sorted(set(want) - set(have))
        extra = sorted(set(have) - set(want))
        differ = {
            c: f"{want[c].simpleString()} expected, {have[c].simpleString()} found"
            for c in sorted(set(want) & set(have))
            if want[c] != have[c]
        }
        passed = not missing and not differ and (allow_extra_columns or not extra)
        return passed, {"missing_columns": missing, "extra_columns": extra, "type_mismatches": differ}

    return Rule("schema_match", severity, None, lambda t, b: F.lit(True), schema=check)


def find_fences(df: DataFrame, rules) -> dict[tuple[str, float], tuple[float | None, float | None]]:
    """IQR fences of all outlier rules together."""
    pairs = {r.fence for r in rules if r.fence and r.fence[0] in df.columns}
    found = quantiles(df, {c: [0.25, 0.75] for c, _ in pairs})
    out = {}
    for c, k in pairs:
        q1, q3 = found[c]
        out[(c, k)] = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def _text(value) -> Column:
    return F.lit(None if value is None else str(value)).cast("string")


def report(df: DataFrame, rules: list[Rule], fences: dict | None = None) -> DataFrame:
    """One row per rule, from one aggregate over ``df``. IQR rules cost one earlier pass for fences.

    A rule that cannot be resolved against the frame is reported as failed, with the error.
    """
    fences = find_fences(df, rules) if fences is None else fences
    total = F.col("__total")
    aggs, items = [F.count(F.lit(1)).alias("__total")], []
    for i, rule in enumerate(rules):
        details = {k: _text(v) for k, v in rule.details.items()}
        passed, bad = None, F.lit(None).cast("bigint")
        try:
            if rule.schema:
                ok, found = rule.schema(df.schema)
                passed = F.lit(ok)
                details |= {k: _text(v) for k, v in found.items()}
            else:
                if rule.violations:
                    measure = rule.violations(df, fences).alias(f"__v{i}")
                    df.agg(measure)  # resolves the expression; runs nothing
                    aggs.append(measure)
                    bad = F.col(f"__v{i}")
                elif rule.apart:
                    bad = rule.apart(df).scalar()
                passed = F.coalesce(rule.passes(total, bad), F.lit(False))
            if rule.fence:
                low, high = fences[rule.fence]
                details |= {"lower_bound": _text(low), "upper_bound": _text(high)}
        except (PySparkException, KeyError, ValueError) as error:
            passed, bad = F.lit(False), F.lit(None).cast("bigint")
            details["error"] = _text(str(error).split("\n")[0])
        pairs = [x for k, v in details.items() for x in (F.lit(k), v)]
        items.append(
            F.struct(
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.severity).alias("severity"),
                passed.alias("passed"),
                total.alias("total"),
                bad.cast("bigint").alias("violations"),
                F.round(F.try_divide(bad.cast("double"), total), 6).alias("fraction"),
                (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<string,string>").alias("details"),
            )
        )
    if not items:
        return df.sparkSession.createDataFrame([], RESULT)
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def summarize(results: DataFrame) -> DataFrame:
    """Score and verdict over a result frame, as one row."""
    failed = ~F.col("passed")
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total_rules"),
        F.count_if("passed").alias("passed_rules"),
        F.count_if(failed).alias("failed_rules"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("critical_failures"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warning_failures"),
        F.round(F.coalesce(F.try_divide(F.count_if("passed") * 100.0, total), F.lit(0.0)), 2).alias("quality_score"),
        (F.count_if(failed & (F.col("severity") == CRITICAL)) == 0).alias("is_valid"),
    )


def validate(df: DataFrame, rules: list[Rule], fail_on_critical: bool = True) -> DataFrame:
    """Run the rules once and return the (tiny) result rows as a local frame.

    Should the joint job fail at run time, rules run one by one, so that only the faulty one fails.
    """
    spark = df.sparkSession
    try:
        rows = report(df, rules).collect()
    except PySparkException:
        rows = []
        for rule in rules:
            try:
                rows += report(df, [rule]).collect()
            except PySparkException as error:
                text = {"error": str(error).split("\n")[0]}
                rows.append((rule.name, rule.severity, False, None, None, None, text))
    results = spark.createDataFrame(rows, RESULT)
    if fail_on_critical:
        broken = [r[0] for r in rows if not r[2] and r[1] == CRITICAL]
        if broken:
            score = 100.0 * sum(1 for r in rows if r[2]) / len(rows)
            raise ValueError(f"critical validation failures: {broken}; quality score {score:.1f}%")
    return results


def with_reasons(df: DataFrame, constraints: dict[str, Column], column: str = "reasons") -> DataFrame:
    """Add the names of the constraints each row breaks; a constraint that is NULL is broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in constraints.items()]
    return df.withColumn(column, F.array_compact(F.array(*broken)))


def quarantine(df: DataFrame, constraints: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with the reasons."""
    marked = with_reasons(df, constraints)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def request_constraints(amount: str, maximum: float, sets: dict[str, list]) -> dict[str, Column]:
    """A positive, bounded amount and columns limited to known values."""
    rules = {
        f"{amount}_positive": F.col(amount) > 0,
        f"{amount}_at_most_{maximum:g}": F.col(amount) <= maximum,
    }
    return rules | {f"{c}_known": F.col(c).isin(as_list(values)) for c, values in sets.items()}


def fraud_suite(
    key: str = "transaction_id", amount: str = "amount", label: str = "is_fraud", card: str = "card_type",
    cards=("visa", "mastercard", "amex", "discover"),
) -> list[Rule]:
    """The standard suite for transactions."""
    return [
        row_count(min_count=100),
        not_null(key),
        not_null(amount),
        not_null(label),
        in_range(amount, 0.0, 50000.0),
        in_set(card, list(cards)),
        iqr_outliers(amount, max_outlier_fraction=0.15),
    ]
