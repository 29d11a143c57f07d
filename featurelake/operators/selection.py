"""Ranking, comparison and summary of model candidates over the long metric table.

The table may hold any number of runs: ``run_id, model_name, metric_name, metric_value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_list
from ..functions.skew import HOT_ROWS
from .series import running_total
from .training import TrainingResult, score

SMALLEST = 1e-9


def candidate_rank(
    metrics: DataFrame, primary_metric: str, higher_is_better: bool = True, run="run_id", model: str = "model_name",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rank the candidates of every run by the metric, 1 is best; ties by name.

    A model without the metric counts as 0. The rank is a running count, which is cut into pieces
    for runs with very many candidates.
    """
    keys = as_list(run)
    value = F.coalesce(F.max(F.when(F.col("metric_name") == primary_metric, F.col("metric_value"))), F.lit(0.0))
    scored = metrics.groupBy(*keys, model).agg(value.alias("metric_value"))
    sign = -F.col("metric_value") if higher_is_better else F.col("metric_value")
    ordered = scored.withColumns({"__at": sign, "__one": F.lit(1)})
    return running_total(ordered, keys, ["__at", model], {"rank": "__one"}, hot_rows=hot_rows).drop("__at", "__one")


def select_best(
    metrics: DataFrame, primary_metric: str, threshold: float, higher_is_better: bool = True, run="run_id",
    model: str = "model_name", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The winner of every run and whether it meets the threshold."""
    ranked = candidate_rank(metrics, primary_metric, higher_is_better, run, model, hot_rows)
    met = F.col("metric_value") >= threshold if higher_is_better else F.col("metric_value") <= threshold
    return ranked.filter(F.col("rank") == 1).select(
        *as_list(run), F.col(model).alias("winner"), "metric_value", met.alias("threshold_met")
    )


def select_trained(
    results: list[TrainingResult], primary_metric: str, threshold: float, higher_is_better: bool = True,
    validation_df: DataFrame | None = None, label: str = "label", task_type: str = "classification",
) -> tuple[TrainingResult, list[tuple[int, str, float]], bool]:
    """Best of a few trained models, scored again on validation data if given."""
    usable = [r for r in results if r.model is not None]
    if not usable:
        raise ValueError("no training results to compare")
    values = []
    for r in usable:
        found = score(r.model, validation_df, label, task_type) if validation_df is not None else (
            r.validation_metrics or r.train_metrics)
        values.append((r, float(found.get(primary_metric, 0.0))))
    values.sort(key=lambda rv: (-rv[1] if higher_is_better else rv[1], rv[0].algorithm))
    best, top = values[0]
    met = top >= threshold if higher_is_better else top <= threshold
    return best, [(i, r.algorithm, v) for i, (r, v) in enumerate(values, 1)], met


def compare_with_baseline(
    metrics: DataFrame, baseline: DataFrame, keys, primary_metric: str, higher_is_better: bool = True,
    improvement_threshold: float = 0.01, digits: int = 6,
) -> DataFrame:
    """Absolute and relative change of every metric against the baseline's.

    ``baseline``: metric_name, baseline_value, one row per metric, joined by Spark's choice. The
    primary metric's row also says whether the change reaches the threshold.
    """
    diff = F.col("candidate") - F.col("baseline")
    relative = diff / F.greatest(F.abs("baseline"), F.lit(SMALLEST))
    better = diff > 0 if higher_is_better else diff < 0
    return (
        metrics.select(*as_list(keys), "metric_name", F.col("metric_value").alias("candidate"))
        .join(baseline.select("metric_name", F.col("baseline_value").alias("baseline")), "metric_name")
        .select(
            *as_list(keys), "metric_name", "baseline", "candidate",
            F.round(diff, digits).alias("absolute_diff"),
            F.round(relative, digits).alias("relative_change"),
            F.when(better, "improvement").otherwise("regression").alias("verdict"),
            F.when(F.col("metric_name") == primary_metric, relative >= improvement_threshold).alias("passes_threshold"),
        )
    )


def selection_summary(
    ranked: DataFrame, cv_scores: DataFrame | None = None, run="run_id", model: str = "model_name", digits: int = 6,
    cv_digits: int = 4,
) -> DataFrame:
    """Per run: candidates, winner, spread between first and last; with fold scores the mean and
    population deviation of the winner's folds."""
    keys = as_list(run)
    first, last = F.min_by("metric_value", "rank"), F.max_by("metric_value", "rank")
    out = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.min_by(model, "rank").alias("winner"),
        F.round(first, digits).alias("winner_metric"),
        F.round(F.abs(first - last), digits).alias("metric_spread"),
    )
    if cv_scores is None:
        return out
    folds = cv_scores.groupBy(*keys, F.col(model).alias("winner")).agg(
        F.round(F.avg("metric_value"), cv_digits).alias("cv_mean"), F.round(F.stddev_pop("metric_value"), cv_digits).alias("cv_std")
    )
    return out.join(folds, [*keys, "winner"], "left")
