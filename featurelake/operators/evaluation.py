"""Model evaluation from counts: confusion cells carry all class metrics, so rows are read once."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_list, one_row
from ..functions.quantiles import quantiles
from ..functions.ranges import laid_out, part_of, written
from ..functions.scalars import key_label

LOSS_FLOOR = 1e-15


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def binary_cells(df: DataFrame, label: str = "label", prediction: str = "prediction", positive=1) -> DataFrame:
    """TP, TN, FP, FN as one row."""
    y, p = F.col(label) == positive, F.col(prediction) == positive
    return df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
    )


def _per_class(cells: DataFrame, label: str, prediction: str, by=()) -> DataFrame:
    """Support, predicted count and hits per class from confusion cells."""
    hit = F.when(F.col(label).cast("double") == F.col(prediction).cast("double"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col(label).cast("double").alias("class"), F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col(prediction).cast("double").alias("class"), F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    counts = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    return counts.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1",
        F.coalesce(
            F.try_divide(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall")), F.lit(0.0)
        ),
    )


def _weighted(field: str) -> Column:
    return F.try_divide(F.sum(F.col(field) * F.col("support")), F.sum("support"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages.

    Grouping twice over the counted classes only; the table itself is read once.
    """
    return report_of(confusion_matrix(df, label, prediction), label, prediction)


def report_of(cells: DataFrame, label: str, prediction: str) -> DataFrame:
    """The report from confusion cells."""
    classes = _per_class(cells, label, prediction)
    rows = classes.groupBy(F.col("class").cast("string").alias("class")).agg(
        *[F.max(f).alias(f) for f in ("precision", "recall", "f1", "support")]
    )
    parts = [rows]
    for name, mean in (("macro avg", F.avg), ("weighted avg", _weighted)):
        parts.append(
            classes.agg(
                F.lit(name).alias("class"), mean("precision").alias("precision"), mean("recall").alias("recall"),
                mean("f1").alias("f1"), F.sum("support").alias("support"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _true_probability(df: DataFrame, label: str, probability: str) -> Column:
    kind = df.schema[probability].dataType
    y = F.col(label).cast("int")
    if isinstance(kind, VectorUDT):
        return F.get(vector_to_array(probability), y)
    if kind.typeName() == "array":
        return F.get(F.col(probability), y)
    return F.when(y == 1, F.col(probability)).otherwise(1 - F.col(probability))


def _score(df: DataFrame, probability: str) -> Column:
    """The probability of class 1."""
    kind = df.schema[probability].dataType
    if isinstance(kind, VectorUDT):
        return F.get(vector_to_array(probability), F.lit(1))
    return F.get(F.col(probability), F.lit(1)) if kind.typeName() == "array" else F.col(probability)


def _losses(df: DataFrame, label: str, probability: str | None) -> Column:
    """Log loss of a row; NULL without probabilities."""
    if probability is None or probability not in df.columns:
        return F.lit(None).cast("double")
    p = F.least(F.greatest(_true_probability(df, label, probability), F.lit(LOSS_FLOOR)), F.lit(1.0))
    return -F.log(p)


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", probability: str | None = "probability",
    digits: int = 6,
) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, hamming loss; log loss and AUC if there are
    probabilities (AUC for two classes only). One row."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"), F.sum(_losses(df, label, probability)).alias("loss"))
    out = metrics_of(cells, label, prediction)
    if probability is not None and probability in df.columns:
        out = _with_areas(out, df.select(F.col(label).alias("y"), _score(df, probability).alias("s")))
    else:
        out = out.drop("logLoss")
    return out.select(*[F.round(c, digits).alias(c) for c in out.columns])


def metrics_of(cells: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row of metrics from confusion cells with ``n`` and ``loss``."""
    classes = _per_class(cells, label, prediction)
    out = classes.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("weightedPrecision"),
        _weighted("recall").alias("weightedRecall"),
        _weighted("f1").alias("f1"),
        (1 - F.try_divide(F.sum("hits"), F.sum("support"))).alias("hammingLoss"),
    )
    loss = cells.agg(F.try_divide(F.sum("loss"), F.sum("n")))
    return out.withColumn("logLoss", loss.scalar())


def _with_areas(out: DataFrame, rows: DataFrame) -> DataFrame:
    """The areas added, if there are two classes; the labels are looked at in the very grouping that the areas are made from."""
    counts = ranged_scores(rows)
    if counts.filter("other > 0").isEmpty():
        areas = areas_of(counts)
        out = out.select("*", one_row(areas).alias("__auc")).select("*", "__auc.*").drop("__auc")
    return out


def ranged_scores(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per distinct score: rows, positives, and rows of other labels than 0 and 1; from (y, s), dealt in ranges from the
    highest score down and written."""
    y = F.col("y").cast("double")
    counts = rows.groupBy((-F.col("s").cast("double")).alias("__at")).agg(
        F.sum(F.when(y == 1.0, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n"),
        F.sum(F.when(y.isin(0.0, 1.0), 0).otherwise(F.when(y.isNotNull(), 1).otherwise(0))).alias("other"))
    return laid_out(counts, ["__at"], "__place", partitions).withColumn("__part", part_of("__place"))


def binary_auc(
    df: DataFrame, label: str = "label", score: str = "score", digits: int | None = 6, partitions: int | None = None
) -> DataFrame:
    """Exact areas under the ROC and precision-recall curves, every distinct score a threshold."""
    out = areas_of(ranged_scores(df.select(F.col(label).alias("y"), F.col(score).alias("s")), partitions))
    return out if digits is None else out.select(*[F.round(c, digits).alias(c) for c in out.columns])


def areas_of(laid: DataFrame) -> DataFrame:
    """The areas from scores counted and dealt in ranges.

    What stands above a score is the sum of all earlier ranges, from
    a table of one row per range, and of the rows before it in its own, so no task sees more than its range.
    """
    sums = laid.groupBy("__part").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    parts = Window.partitionBy(F.lit(0))  # one row per range
    earlier = parts.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("__part").alias("__p"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"above_{c}") for c in ("pos", "n")],
        *[F.sum(c).over(parts).alias(f"total_{c}") for c in ("pos", "n")])
    ranked = laid.join(F.broadcast(sums), F.col("__part") == F.col("__p"))  # one row per range
    here = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumns({f"cum_{c}": F.sum(c).over(here) + F.col(f"above_{c}") for c in ("pos", "n")})
    neg = F.col("n") - F.col("pos")
    before = F.col("cum_pos") - F.col("pos")
    roc = F.try_divide(neg * (before + F.col("pos") / 2), F.col("total_pos") * (F.col("total_n") - F.col("total_pos")))
    at = F.col("cum_pos") / F.col("cum_n")
    previous = F.coalesce(F.try_divide(before, F.col("cum_n") - F.col("n")), at)
    pr = F.try_divide(F.col("pos"), F.col("total_pos")) * (at + previous) / 2
    return ranked.agg(F.sum(roc).alias("areaUnderROC"), F.sum(pr).alias("areaUnderPR"))


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6, ddof: int = 1,
    approx: bool = False,
) -> DataFrame:
    """RMSE, MSE, MAE, R2, explained variance, error mean, deviation and quantiles, as one row."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    errors = df.select(y.alias("y"), p.alias("p"), (p - y).alias("e"), F.abs(p - y).alias("a"))
    median, p95 = quantiles(errors, {"a": [0.5, 0.95]}, approx=approx)["a"]
    n = F.count(F.lit(1))
    mse = F.avg(F.col("e") * F.col("e"))
    deviation = F.stddev_samp("e") if ddof else F.stddev_pop("e")
    # explained variance is the mean of (p - avg(y))^2, written with moments to stay in one pass
    explained = F.var_pop("p") + F.pow(F.avg("p") - F.avg("y"), 2)
    out = errors.agg(
        F.sqrt(mse).alias("rmse"), mse.alias("mse"), F.avg("a").alias("mae"),
        (1 - F.try_divide(mse, F.var_pop("y"))).alias("r2"), explained.alias("var"),
        F.avg("e").alias("mean_error"), F.coalesce(deviation, F.lit(0.0)).alias("std_error"),
        F.max(F.lit(median).cast("double")).alias("median_abs_error"),
        F.max(F.lit(p95).cast("double")).alias("p95_abs_error"), n.alias("n"),
    )
    return out.select(*[F.round(c, digits).alias(c) if c != "n" else F.col(c) for c in out.columns])


def prediction_distribution(
    df: DataFrame, label: str = "label", prediction: str = "prediction", task_type: str = "classification"
) -> DataFrame:
    """Counts per value of prediction and label, or moments of the prediction for regression."""
    if task_type == "classification":
        return distribution_of(confusion_matrix(df, label, prediction), label, prediction)
    p = F.col(prediction).cast("double")
    return df.agg(
        *[F.round(f(p), 4).alias(name) for name, f in
          (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))]
    )


def distribution_of(cells: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts per value of either side, from confusion cells."""
    sides = F.array(
        F.struct(F.lit("prediction").alias("side"), F.col(prediction).cast("double").alias("value"), "n"),
        F.struct(F.lit("label").alias("side"), F.col(label).cast("double").alias("value"), "n"),
    )
    return cells.select(F.inline(sides)).groupBy("side", "value").agg(F.sum("n").alias("n"))


def stratified_metrics(
    df: DataFrame, columns, label: str = "label", prediction: str = "prediction",
    task_type: str = "classification", digits: int = 6,
) -> DataFrame:
    """F1 or RMSE and row count for every value of the given columns, keyed ``column=value``.

    All columns and values come from one grouping, whatever their number.
    """
    names = [c for c in as_list(columns) if c in df.columns]
    keys = F.array_compact(F.array(*[key_label(c) for c in names]))
    rows = df.select(
        F.col(label).alias("y"), F.col(prediction).alias("p"), F.explode(keys).alias("stratum")
    )
    if task_type == "classification":
        return strata_of(rows.groupBy("stratum", "y", "p").agg(F.count(F.lit(1)).alias("n")), digits)
    e = F.col("p").cast("double") - F.col("y").cast("double")
    return rows.groupBy("stratum").agg(
        F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"), F.count(F.lit(1)).alias("n")
    )


def gate_passes(value: Column, operator: Column, threshold: Column) -> Column:
    """Unknown operators act as ``>=``; a missing value fails."""
    verdict = (
        F.when(operator == "<=", value <= threshold)
        .when(operator == ">", value > threshold)
        .when(operator == "<", value < threshold)
        .when(operator == "==", F.abs(value - threshold) < 1e-9)
        .otherwise(value >= threshold)
    )
    return F.coalesce(verdict, F.lit(False))


def quality_gates(metrics: DataFrame, gates: DataFrame, keys) -> DataFrame:
    """Check every gate against every model or run of a long metric table.

    ``gates``: gate, metric_name, operator, threshold; a configured list. One output row per key and
    gate; a metric that was not computed fails its gate. One grouping picks the gated metrics, then
    each key's row is unfolded into its gates: no join.
    """
    rules = gates.select("gate", "metric_name", "operator", "threshold").collect()  # configuration
    names = sorted({r["metric_name"] for r in rules})
    picked = [
        F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(f"__m{i}") for i, n in enumerate(names)
    ]
    items = [
        F.struct(
            F.lit(r["gate"]).alias("gate"), F.lit(r["metric_name"]).alias("metric_name"),
            F.lit(r["operator"]).alias("operator"), F.lit(r["threshold"]).cast("double").alias("threshold"),
            F.col(f"__m{names.index(r['metric_name'])}").cast("double").alias("actual"),
        )
        for r in rules
    ]
    rows = metrics.groupBy(*as_list(keys)).agg(*picked).select(*as_list(keys), F.inline(F.array(*items)))
    return rows.withColumn("passed", gate_passes(F.col("actual"), F.col("operator"), F.col("threshold")))


def strata_of(cells: DataFrame, digits: int = 6) -> DataFrame:
    """F1 and rows per stratum, from cells (stratum, y, p, n)."""
    return _per_class(cells, "y", "p", ["stratum"]).groupBy("stratum").agg(
        F.round(_weighted("f1"), digits).alias("f1"), F.sum("support").alias("n"))


def evaluate(
    model, test_df: DataFrame, label: str = "label", task_type: str = "classification", stratify_columns=(),
    gates: DataFrame | None = None, model_name: str = "model", probability: str | None = "probability", digits: int = 6,
) -> dict[str, DataFrame]:
    """Score once and derive all evaluation frames: metrics, distribution, confusion and report (classes), strata, gates.

    For classes, one grouping by (stratum, label, prediction), all rows being one more stratum, is written; every frame
    but the areas comes from its cells, and the areas from the counted scores. For numbers, label, prediction and strata
    are written. Nothing stays cached and no stratum is collected, so strata may be as many as there are users.
    """
    scored, names = model.transform(test_df), [c for c in as_list(stratify_columns) if c in test_df.columns]
    strata = F.array_compact(F.array(*[key_label(c) for c in names])) if names else F.array().cast("array<string>")
    kept = [F.col(label).alias("y"), F.col("prediction").alias("p"), strata.alias("strata")]
    if task_type != "classification":
        rows = written(scored.select(*kept), "scored")
        out = {
            "metrics": regression_metrics(rows, "y", "p", digits),
            "distribution": prediction_distribution(rows, "y", "p", task_type),
        }
        e = F.col("p").cast("double") - F.col("y").cast("double")
        if names:
            out["strata"] = rows.select(e.alias("e"), F.explode("strata").alias("stratum")).groupBy("stratum").agg(
                F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), digits).alias("rmse"), F.count(F.lit(1)).alias("n"))
    else:
        has_p = probability is not None and probability in scored.columns
        score = _score(scored, probability).cast("double") if has_p else F.lit(None).cast("double")
        rows = written(scored.select(*kept, score.alias("s"), _losses(scored, label, probability).alias("loss")), "scored")
        every = F.concat(F.array(F.lit(None).cast("string")), "strata")  # NULL: all rows
        cells = rows.select("y", "p", "loss", F.explode(every).alias("stratum")).groupBy("stratum", "y", "p")
        cells = written(cells.agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")), "cells")
        all_rows = cells.filter("stratum IS NULL").drop("stratum")
        metrics = metrics_of(all_rows, "y", "p")
        if has_p:
            metrics = _with_areas(metrics, rows.select("y", "s"))
        else:
            metrics = metrics.drop("logLoss")
        out = {
            "metrics": metrics.select(*[F.round(c, digits).alias(c) for c in metrics.columns]),
            "distribution": distribution_of(all_rows, "y", "p"),
            "confusion": all_rows.select(F.col("y").alias(label), F.col("p").alias("prediction"), "n"),
            "report": report_of(all_rows, "y", "p"),
        }
        if names:
            out["strata"] = strata_of(cells.filter("stratum IS NOT NULL"), digits)
    if gates is not None:
        row = out["metrics"].first().asDict()  # one row of numbers
        long = test_df.sparkSession.createDataFrame(
            [(model_name, k, float(v)) for k, v in row.items() if v is not None],
            "model_name string, metric_name string, metric_value double",
        )
        out["gates"] = quality_gates(long, gates, "model_name")
    return out
