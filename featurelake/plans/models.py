"""Queries over splits, training, evaluation and model selection.

Evaluation and selection run on predictions made by a rule, so that SQL can follow them: an event
is predicted to be an error if its value is above 40, with a score that grows with the value.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..functions import encoding
from ..functions.ranges import written
from ..functions.scalars import temporal_features
from ..operators import evaluation, selection, splits, training
from .registry import query, rounded, table

SQL_BUCKET = "('0x' || substr(md5({key} || '#42'), 1, 8))::BIGINT % 10000"


@query(
    "split_random",
    f"""SELECT event_id, CASE WHEN b < 8000 THEN 'train' WHEN b < 9000 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT event_id, {SQL_BUCKET.format(key='event_id::VARCHAR')} AS b FROM events)""",
)
def split_random(spark, d):
    return splits.assign_split(table(spark, d, "events"), "event_id").select("event_id", "split")


@query(
    "split_stratified",
    f"""SELECT event_id, event_type, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT event_id, event_type, {SQL_BUCKET.format(key="event_id || '#' || event_type")} AS b FROM events)""",
)
def split_stratified(spark, d):
    return splits.assign_split_stratified(table(spark, d, "events"), "event_id", "event_type").select(
        "event_id", "event_type", "split")


@query(
    "imbalanced_sample",
    """SELECT event_id, is_error FROM (
         SELECT event_id, (event_type = 'error')::INTEGER AS is_error, row_number() OVER (PARTITION BY event_type = 'error'
           ORDER BY ('0x' || substr(md5(event_id || '#42'), 1, 13))::BIGINT) AS rn FROM events)
       WHERE rn <= CASE is_error WHEN 1 THEN 20 ELSE 380 END""",
)
def imbalanced_sample(spark, d):
    rows = table(spark, d, "events").withColumn("is_error", F.when(F.col("event_type") == "error", 1).otherwise(0))
    return splits.imbalanced_sample(rows, F.col("is_error") == 1, "event_id", 0.05, 400).select("event_id", "is_error")


def predictions(spark, d):
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("value") > 40, 1.0).otherwise(0.0).alias("prediction"),
        (F.col("value") / (F.col("value") + 40)).alias("probability"),
    )


PRED = """p AS (SELECT event_id, user_id, event_type, (event_type = 'error')::INT::DOUBLE AS label,
  (value > 40)::INT::DOUBLE AS prediction, value / (value + 40) AS probability FROM events)"""

PER_CLASS = """c AS (SELECT cls, sum(s) AS support, sum(q) AS predicted, sum(h) AS hits FROM (
    SELECT label AS cls, 1 AS s, 0 AS q, (label = prediction)::INT AS h FROM p
    UNION ALL SELECT prediction, 0, 1, 0 FROM p) GROUP BY 1),
  m AS (SELECT cls, support::BIGINT AS support, hits, coalesce(hits / nullif(predicted, 0), 0) AS pr,
          coalesce(hits / nullif(support, 0), 0) AS re FROM c),
  f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM m)"""


@query("confusion_matrix", f"WITH {PRED} SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return evaluation.confusion_matrix(predictions(spark, d))


@query(
    "confusion_cells",
    f"""WITH {PRED} SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
          count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
          count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM p""",
)
def confusion_cells(spark, d):
    return evaluation.binary_cells(predictions(spark, d))


@query(
    "prediction_distribution",
    f"""WITH {PRED} SELECT 'prediction' AS side, prediction AS value, count(*) AS n FROM p GROUP BY 2
        UNION ALL SELECT 'label', label, count(*) FROM p GROUP BY 2""",
)
def prediction_distribution(spark, d):
    return evaluation.prediction_distribution(predictions(spark, d))


@query(
    "prediction_distribution_regression",
    """SELECT round(avg(1000 * l_quantity), 4) AS mean, round(stddev_samp(1000 * l_quantity), 4) AS stddev,
         min(1000 * l_quantity) AS min, max(1000 * l_quantity) AS max FROM lineitem""",
)
def prediction_distribution_regression(spark, d):
    return evaluation.prediction_distribution(priced(spark, d), task_type="regression")


@query(
    "classification_metrics",
    f"""WITH {PRED}, {PER_CLASS}, t AS (SELECT probability AS s, sum(label) AS pos, count(*) AS n FROM p GROUP BY 1),
        r AS (SELECT pos, n, sum(pos) OVER w AS cp, sum(n) OVER w AS cn, sum(pos) OVER () AS tp, sum(n) OVER () AS tn
              FROM t WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
        auc AS (SELECT sum((n - pos) * (cp - pos + pos / 2) / (tp * (tn - tp))) AS roc,
              sum(pos / tp * (cp / cn + coalesce((cp - pos) / nullif(cn - n, 0), cp / cn)) / 2) AS pr FROM r),
        l AS (SELECT avg(-ln(greatest(CASE WHEN label = 1 THEN probability ELSE 1 - probability END, 1e-15))) AS loss FROM p)
        SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS "weightedPrecision",
          round(sum(re * support) / sum(support), 6) AS "weightedRecall", round(sum(f1 * support) / sum(support), 6) AS f1,
          round(1 - sum(hits) / sum(support), 6) AS "hammingLoss", (SELECT round(loss, 6) FROM l) AS "logLoss",
          (SELECT round(roc, 6) FROM auc) AS "areaUnderROC", (SELECT round(pr, 6) FROM auc) AS "areaUnderPR" FROM f""",
)
def classification_metrics(spark, d):
    return evaluation.classification_metrics(predictions(spark, d))


@query(
    "classification_report",
    f"""WITH {PRED}, {PER_CLASS}
        SELECT cls::VARCHAR AS class, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1, support FROM f
        UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
        UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f""",
)
def classification_report(spark, d):
    return rounded(evaluation.classification_report(predictions(spark, d)), 6, "precision", "recall", "f1")


def priced(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1000).alias("prediction"), "l_returnflag", "l_linestatus")


PRICED = """p AS (SELECT l_extendedprice AS y, 1000 * l_quantity AS p, 1000 * l_quantity - l_extendedprice AS e,
  l_returnflag, l_linestatus FROM lineitem)"""


@query(
    "regression_metrics",
    f"""WITH {PRICED} SELECT round(sqrt(avg(e * e)), 3) AS rmse, round(avg(e * e), 1) AS mse, round(avg(abs(e)), 3) AS mae,
          round(1 - avg(e * e) / var_pop(y), 6) AS r2, round(var_pop(p) + power(avg(p) - avg(y), 2), 1) AS var,
          round(avg(e), 3) AS mean_error, round(stddev_samp(e), 3) AS std_error,
          round(quantile_cont(abs(e), 0.5), 3) AS median_abs_error, round(quantile_cont(abs(e), 0.95), 3) AS p95_abs_error,
          count(*) AS n FROM p""",
)
def regression_metrics(spark, d):
    out = evaluation.regression_metrics(priced(spark, d))
    out = rounded(out, 3, "rmse", "mae", "mean_error", "std_error", "median_abs_error", "p95_abs_error")
    return rounded(out, 1, "mse", "var")


@query(
    "stratified_metrics",
    f"""WITH {PRED}, s AS (SELECT 'event_type=' || event_type AS stratum, label, prediction FROM p
          UNION ALL SELECT 'user_id=' || user_id, label, prediction FROM p),
        c AS (SELECT stratum, cls, sum(s) AS support, sum(q) AS predicted, sum(h) AS hits FROM (
            SELECT stratum, label AS cls, 1 AS s, 0 AS q, (label = prediction)::INT AS h FROM s
            UNION ALL SELECT stratum, prediction, 0, 1, 0 FROM s) GROUP BY 1, 2),
        m AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS pr, coalesce(hits / nullif(support, 0), 0) AS re FROM c)
        SELECT stratum, round(sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * support) / sum(support), 6) AS f1,
          sum(support)::BIGINT AS n FROM m GROUP BY 1""",
)
def stratified_metrics(spark, d):
    return evaluation.stratified_metrics(predictions(spark, d), ["event_type", "user_id"])


@query(
    "stratified_metrics_regression",
    f"""WITH {PRICED} SELECT 'l_returnflag=' || l_returnflag AS stratum, round(sqrt(avg(e * e)), 3) AS rmse, count(*) AS n
        FROM p GROUP BY 1 UNION ALL SELECT 'l_linestatus=' || l_linestatus, round(sqrt(avg(e * e)), 3), count(*) FROM p GROUP BY 1""",
)
def stratified_metrics_regression(spark, d):
    out = evaluation.stratified_metrics(priced(spark, d), ["l_returnflag", "l_linestatus"], task_type="regression")
    return rounded(out, 3, "rmse")


# --- selection: the users are the runs, the event types are the candidates -------------------------


def model_metrics(spark, d):
    """Long metric table: per run and model the mean and the largest value."""
    value = F.col("value").cast("decimal(18,2)")
    wide = table(spark, d, "events").groupBy(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("model_name")
    ).agg(
        F.round(F.sum(value).cast("double") / F.count("value"), 6).alias("f1"), F.max("value").alias("peak")
    )
    return wide.unpivot(["run_id", "model_name"], ["f1", "peak"], "metric_name", "metric_value")


METRICS = """w AS (SELECT user_id AS run_id, event_type AS model_name,
    round(sum(value::DECIMAL(18,2))::DOUBLE / count(value), 6) AS f1, max(value) AS peak FROM events GROUP BY 1, 2),
  m AS (SELECT run_id, model_name, 'f1' AS metric_name, f1 AS metric_value FROM w
        UNION ALL SELECT run_id, model_name, 'peak', peak FROM w),
  r AS (SELECT run_id, model_name, f1 AS metric_value,
          row_number() OVER (PARTITION BY run_id ORDER BY f1 DESC, model_name) AS rank FROM w)"""


@query("candidate_rank", f"WITH {METRICS} SELECT run_id, model_name, metric_value, rank FROM r")
def candidate_rank(spark, d):
    return selection.candidate_rank(model_metrics(spark, d), "f1")


@query(
    "select_best",
    f"WITH {METRICS} SELECT run_id, model_name AS winner, metric_value, metric_value >= 60 AS threshold_met FROM r WHERE rank = 1",
)
def select_best(spark, d):
    return selection.select_best(model_metrics(spark, d), "f1", 60)


@query(
    "compare_with_baseline",
    f"""WITH {METRICS}, b AS (SELECT metric_name, round(avg(metric_value), 6) AS baseline FROM m GROUP BY 1)
        SELECT m.run_id, m.model_name, m.metric_name, b.baseline, m.metric_value AS candidate,
          round(m.metric_value - b.baseline, 6) AS absolute_diff,
          round((m.metric_value - b.baseline) / greatest(abs(b.baseline), 1e-9), 6) AS relative_change,
          CASE WHEN m.metric_value > b.baseline THEN 'improvement' ELSE 'regression' END AS verdict,
          CASE WHEN m.metric_name = 'f1' THEN (m.metric_value - b.baseline) / greatest(abs(b.baseline), 1e-9) >= 0.01 END AS passes_threshold
        FROM m JOIN b USING (metric_name)""",
)
def compare_with_baseline(spark, d):
    metrics = model_metrics(spark, d)
    base = metrics.groupBy("metric_name").agg(F.round(F.avg("metric_value"), 6).alias("baseline_value"))
    return selection.compare_with_baseline(metrics, base, ["run_id", "model_name"], "f1")


@query(
    "selection_summary",
    f"""WITH {METRICS}, cv AS (SELECT run_id, model_name, round(avg(metric_value), 8) AS cv_mean,
          round(stddev_pop(metric_value), 8) AS cv_std FROM m GROUP BY 1, 2)
        SELECT r.run_id, count(*) AS candidates, arg_min(r.model_name, rank) AS winner,
          round(arg_min(r.metric_value, rank), 6) AS winner_metric,
          round(abs(arg_min(r.metric_value, rank) - arg_max(r.metric_value, rank)), 6) AS metric_spread,
          arg_min(cv.cv_mean, rank) AS cv_mean, arg_min(cv.cv_std, rank) AS cv_std
        FROM r JOIN cv USING (run_id, model_name) GROUP BY 1""",
)
def selection_summary(spark, d):
    """The two metrics of a model stand in for its fold scores."""
    metrics = model_metrics(spark, d)
    return selection.selection_summary(selection.candidate_rank(metrics, "f1"), metrics, cv_digits=8)


GATES = [
    ("mean_floor", "f1", ">=", 30.0), ("mean_ceiling", "f1", "<=", 60.0), ("peak_high", "peak", ">", 100.0),
    ("peak_low", "peak", "<", 400.0), ("exact", "f1", "==", 50.0), ("odd", "peak", "~", 150.0), ("absent", "auc", ">=", 0.5),
]


@query(
    "quality_gates",
    f"""WITH {METRICS}, g AS (SELECT * FROM (VALUES {', '.join(str(g) for g in GATES)}) t(gate, metric_name, operator, threshold)),
        k AS (SELECT DISTINCT run_id, model_name FROM m)
        SELECT k.run_id, k.model_name, g.gate, g.metric_name, g.operator, g.threshold::DOUBLE AS threshold, m.metric_value AS actual,
          coalesce(CASE g.operator WHEN '<=' THEN metric_value <= threshold WHEN '>' THEN metric_value > threshold
            WHEN '<' THEN metric_value < threshold WHEN '==' THEN abs(metric_value - threshold) < 1e-9
            ELSE metric_value >= threshold END, false) AS passed
        FROM k CROSS JOIN g LEFT JOIN m ON m.run_id = k.run_id AND m.model_name = k.model_name AND m.metric_name = g.metric_name""",
)
def quality_gates(spark, d):
    gates = spark.createDataFrame(GATES, "gate string, metric_name string, operator string, threshold double")
    return evaluation.quality_gates(model_metrics(spark, d), gates, ["run_id", "model_name"])


# --- training ------------------------------------------------------------------------------------


def training_frame(spark, d):
    """Errors to be told from other events by value, hour and payload."""
    rows = temporal_features(table(spark, d, "events"), "ts", ["hour", "day_of_week"])
    rows = rows.withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    rows = rows.withColumn("label", F.when(F.col("value") + F.col("k") > 80, 1.0).otherwise(0.0))
    out, _ = encoding.assemble_features(rows, ["value", "k", "ts_hour", "ts_day_of_week"])
    return out.select("event_id", "event_type", "value", "k", "label", "features")


#: Rows of the training frame with their part and fold: label y as a number, b as a class; feature v, and x that is 0 or 1.
ROWS = f"""r AS (SELECT event_id, value AS v, k, value + k AS y, (value + k > 80)::INT AS b, (value > 45)::INT AS x, s, fold,
    CASE WHEN s < 8000 THEN 'train' WHEN s < 9000 THEN 'validation' ELSE 'test' END AS part
  FROM (SELECT event_id, value, json_extract_string(props, '$.k')::DOUBLE AS k, {SQL_BUCKET.format(key="event_id::VARCHAR")} AS s,
          ('0x' || substr(md5(event_id || '#42'), 1, 8))::BIGINT % 5 AS fold FROM events) WHERE k IS NOT NULL)"""


def line_sql(candidates: list[tuple], source: str, by: str) -> str:
    """Slope and intercept of y by v for each candidate (model, reg, net) and group of ``source``.

    One feature has a closed form: with both sides scaled to deviation 1 the coefficient is the correlation, shrunk by the
    absolute penalty and divided by one plus the squared one, each in deviations of the label.
    """
    rows = ", ".join(f"('{m}', {i}, {reg}::DOUBLE, {net}::DOUBLE)" for m, i, reg, net in candidates)
    return f"""(SELECT {by}, model, i, reg, w * sy / sx AS slope, my - w * sy / sx * mx AS base FROM (
      SELECT *, sign(rho) * greatest(abs(rho) - reg * net / sy, 0) / (1 + reg * (1 - net) / sy) AS w
      FROM (SELECT {by}, avg(v) AS mx, avg(y) AS my, stddev_pop(v) AS sx, stddev_pop(y) AS sy, corr(v, y) AS rho FROM {source} GROUP BY {by}),
        (VALUES {rows}) c(model, i, reg, net)))"""


def _grid(model: str) -> list[tuple]:
    grid = training.DEFAULT_GRIDS[model]
    pairs = [(reg, net) for reg in grid["regParam"] for net in grid.get("elasticNetParam", [0.0])]
    return [(model, i, reg, net) for i, (reg, net) in enumerate(pairs)]


LINES = _grid("linear_regression") + _grid("ridge")


def _folds(candidates: list[tuple], rows: str = "t") -> str:
    """Held-out root mean square error per candidate: the mean over five folds, each by the line of the other four."""
    return f"""o AS (SELECT h.held, r.v, r.y FROM (SELECT DISTINCT fold AS held FROM {rows}) h JOIN {rows} r ON r.fold <> h.held),
  lines AS (SELECT * FROM {line_sql(candidates, 'o', 'held')}),
  cv AS (SELECT model, i, any_value(reg) AS reg, avg(e) AS score FROM (
    SELECT l.model, l.i, l.held, any_value(l.reg) AS reg, sqrt(avg((l.slope * r.v + l.base - r.y) ** 2)) AS e
    FROM lines l JOIN {rows} r ON r.fold = l.held GROUP BY l.model, l.i, l.held) GROUP BY model, i)"""


def one_feature(spark, d):
    frame = training_frame(spark, d).filter("k IS NOT NULL").withColumn("label", F.col("value") + F.col("k")).drop("features")
    return encoding.assemble_features(frame, ["value"])[0]


CLASSES = ["accuracy", "f1", "logLoss"]


def _shares(train: str, rows: str, by: str, on: str) -> str:
    """Rows with the fitted chance of their x: a logistic regression on one 0/1 feature gives the share of its class."""
    return f"""(SELECT r.{by}, r.b, f.p, (f.p > 0.5)::INT AS c FROM {rows} r JOIN
      (SELECT {on} x, avg(b) AS p FROM {train} GROUP BY ALL) f ON {'f.held = r.fold AND ' if 'held' in on else ''}f.x = r.x)"""


def _class_metrics(source: str, by: str) -> str:
    return f"""(SELECT {by}, (a + d) / n AS accuracy, ((a + e) * coalesce(2 * a / nullif(2 * a + e + g, 0), 0)
        + (d + g) * coalesce(2 * d / nullif(2 * d + e + g, 0), 0)) / n AS f1, loss AS "logLoss" FROM (
      SELECT {by}, count(*)::DOUBLE AS n, count(*) FILTER (b = 1 AND c = 1)::DOUBLE AS a, count(*) FILTER (b = 0 AND c = 0)::DOUBLE AS d,
        count(*) FILTER (b = 1 AND c = 0)::DOUBLE AS e, count(*) FILTER (b = 0 AND c = 1)::DOUBLE AS g,
        avg(-ln(CASE WHEN b = 1 THEN p ELSE 1 - p END)) AS loss FROM {source} GROUP BY {by}))"""


@query(
    "train_classifiers",
    f"""WITH {ROWS}, t AS (SELECT * FROM r WHERE part = 'train'),
        o AS (SELECT h.held, r.x, r.b FROM (SELECT DISTINCT fold AS held FROM t) h JOIN t r ON r.fold <> h.held),
        m AS (SELECT * FROM {_class_metrics(_shares('t', "(SELECT * FROM r WHERE part <> 'test')", 'part', ''), 'part')})
        SELECT 'run' AS run_id, 'logistic_regression' AS model_name, part AS dataset, name AS metric_name, round(value, 3) AS metric_value
        FROM m UNPIVOT (value FOR name IN (accuracy, f1, "logLoss"))
        UNION ALL SELECT 'run', 'logistic_regression', 'cv', 'cv_0', round(avg(f1), 3)
        FROM {_class_metrics(_shares('o', 't', 'fold', 'held,'), 'fold')}""",
)
def train_classifiers(spark, d):
    """Five folds; one 0/1 feature, for which the fitted chances are known in closed form."""
    frame = training_frame(spark, d).filter("k IS NOT NULL").drop("features")
    frame = encoding.assemble_features(frame.withColumn("x", F.when(F.col("value") > 45, 1.0).otherwise(0.0)), ["x"])[0]
    train, valid, _ = splits.split_random(frame, "event_id")
    results = training.train(
        train, ["logistic_regression"], validation_df=valid, grids={"logistic_regression": {"regParam": [0.0]}}, row_key="event_id")
    rows = training.metric_rows(spark, "run", results).filter(F.col("metric_name").isin(*CLASSES) | (F.col("dataset") == "cv"))
    return rounded(rows, 3, "metric_value")


@query(
    "train_regressors",
    f"""WITH {ROWS}, t AS (SELECT * FROM r WHERE part = 'train'), {_folds(LINES)},
        best AS (SELECT model, arg_min(i, score) AS i FROM cv GROUP BY model),
        fit AS (SELECT l.* FROM {line_sql(LINES, "(SELECT *, 0 AS g FROM t)", 'g')} l JOIN best USING (model, i)),
        e AS (SELECT model, part, y, slope * v + base - y AS e FROM fit, r WHERE part <> 'test'),
        m AS (SELECT model, part, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2 FROM e GROUP BY 1, 2)
        SELECT 'run' AS run_id, model AS model_name, part AS dataset, name AS metric_name, round(value, 3) AS metric_value
        FROM m UNPIVOT (value FOR name IN (rmse, mae, r2))
        UNION ALL SELECT 'run', model, 'cv', 'cv_' || i, round(score, 3) FROM cv""",
)
def train_regressors(spark, d):
    """Default grids, five folds; one feature, for which every candidate has a closed form."""
    train, valid, _ = splits.split_random(one_feature(spark, d), "event_id")
    results = training.train(train, ["linear_regression", "ridge"], task_type="regression", validation_df=valid, row_key="event_id")
    rows = training.metric_rows(spark, "run", results)
    rows = rows.filter(F.col("metric_name").isin("rmse", "mae", "r2") | (F.col("dataset") == "cv"))
    return rounded(rows, 3, "metric_value")


@query("train_tree_models")
def train_tree_models(spark, d):
    """Forests and boosted trees of either task; a small grid, as the default one is 27 models by five folds each."""
    frame = training_frame(spark, d).filter("k IS NOT NULL").drop("event_type")
    train, valid, _ = splits.split_random(written(frame, "frame"), "event_id")  # both tasks read it, in parts
    some = {"folds": 2, "max_iter": 5, "validation_df": valid, "row_key": "event_id"}
    results = training.train(train, ["random_forest", "gradient_boosted_trees"], grids={"random_forest": {"numTrees": [5]}}, **some)
    numbers = [f.withColumn("label", F.col("value") + F.col("k")) for f in (train, valid)]
    results += training.train(
        numbers[0], ["random_forest_regressor", "gradient_boosted_trees_regressor"], task_type="regression",
        grids={"random_forest_regressor": {"numTrees": [5]}}, **some | {"validation_df": numbers[1]})
    return rounded(training.metric_rows(spark, "run", [r for r in results if r.model is not None]), 4, "metric_value")


def ridge(spark, d):
    est = training.make_estimator("ridge", "regression", "features", "label")
    return training.cross_validate(
        one_feature(spark, d), est, "regression", "label", training.DEFAULT_GRIDS["ridge"], folds=5, row_key="event_id")


@query(
    "cross_validate_grid",
    f"WITH {ROWS}, {_folds(_grid('ridge'), 'r')} SELECT i AS candidate, round(score, 4) AS rmse FROM cv",
)
def cross_validate_grid(spark, d):
    rows = [(i, float(m)) for i, m in enumerate(ridge(spark, d).avgMetrics)]
    return rounded(spark.createDataFrame(rows, "candidate int, rmse double"), 4, "rmse")


@query(
    "best_params",
    f"""WITH {ROWS}, {_folds(_grid('ridge'), 'r')}
        SELECT 'regParam' AS parameter, arg_min(reg, score) AS value FROM cv UNION ALL SELECT 'elasticNetParam', 0.0""",
)
def best_params(spark, d):
    chosen = training.best_params(ridge(spark, d).bestModel)
    return spark.createDataFrame([(k, float(chosen[k])) for k in ("regParam", "elasticNetParam")], "parameter string, value double")


@query(
    "feature_importance",
    f"""WITH {ROWS}, {_folds(_grid('ridge'), 'r')}, best AS (SELECT arg_min(i, score) AS i FROM cv)
        SELECT 'value' AS feature, round(abs(slope), 4) AS importance
        FROM {line_sql(_grid('ridge'), "(SELECT *, 0 AS g FROM r)", 'g')} JOIN best USING (i)""",
)
def feature_importance(spark, d):
    return rounded(training.feature_importance(ridge(spark, d).bestModel, ["value"], spark), 4, "importance")


@query(
    "cross_val_scores",
    f"""WITH {ROWS}, {_folds([('linear_regression', 0, 0.0, 0.0)], 'r')},
        e AS (SELECT r.fold, r.y, l.slope * r.v + l.base - r.y AS e FROM lines l JOIN r ON r.fold = l.held),
        m AS (SELECT fold, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2, avg(e) AS mean_error FROM e GROUP BY fold)
        SELECT fold::INTEGER AS fold, name AS metric_name, round(value, 3) AS metric_value FROM m UNPIVOT (value FOR name IN (rmse, mae, r2, mean_error))""",
)
def cross_val_scores(spark, d):
    out = training.cross_val_scores(one_feature(spark, d), "linear_regression", "regression", "event_id")
    return rounded(out.filter(F.col("metric_name").isin("rmse", "mae", "r2", "mean_error")), 3, "metric_value")


EVALUATED = [("enough", "accuracy", ">=", 0.5), ("sharp", "areaUnderROC", ">", 0.9), ("calm", "logLoss", "<=", 5.0)]


@query(
    "evaluate",
    f"""WITH {PRED}, {PER_CLASS}, t AS (SELECT probability AS s, sum(label) AS pos, count(*) AS n FROM p GROUP BY 1),
        w AS (SELECT pos, n, sum(pos) OVER w AS cp, sum(pos) OVER () AS tp, sum(n) OVER () AS tn
              FROM t WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
        v AS (SELECT sum(hits) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1,
          (SELECT avg(-ln(greatest(CASE WHEN label = 1 THEN probability ELSE 1 - probability END, 1e-15))) FROM p) AS "logLoss",
          (SELECT sum((n - pos) * (cp - pos + pos / 2) / (tp * (tn - tp))) FROM w) AS "areaUnderROC" FROM f),
        u AS (SELECT name, value FROM v UNPIVOT (value FOR name IN (accuracy, f1, "logLoss", "areaUnderROC"))),
        s AS (SELECT 'event_type=' || event_type AS k, label, prediction FROM p UNION ALL SELECT 'user_id=' || user_id, label, prediction FROM p),
        g AS (SELECT k, sum((label = 1 AND prediction = 1)::INT)::DOUBLE AS a, sum((label = 0 AND prediction = 0)::INT)::DOUBLE AS d,
          sum((label <> prediction)::INT)::DOUBLE AS w, sum((label = 1)::INT)::DOUBLE AS y, count(*) AS n FROM s GROUP BY k)
        SELECT 'metrics' AS frame, name AS name, 'value' AS field, round(value, 4) AS value FROM u
        UNION ALL SELECT 'gates', gate, 'passed', CASE WHEN op = '<=' THEN (value <= h)::INT WHEN op = '>' THEN (value > h)::INT ELSE (value >= h)::INT END::DOUBLE
        FROM (VALUES {', '.join(str(g) for g in EVALUATED)}) q(gate, name, op, h) JOIN u USING (name)
        UNION ALL SELECT 'report', cls::VARCHAR, 'f1', round(f1, 4) FROM f UNION ALL SELECT 'report', cls::VARCHAR, 'support', support::DOUBLE FROM f
        UNION ALL SELECT 'confusion', label::VARCHAR || ' ' || prediction::VARCHAR, 'n', count(*)::DOUBLE FROM p GROUP BY label, prediction
        UNION ALL SELECT 'distribution', 'label ' || label::VARCHAR, 'n', count(*)::DOUBLE FROM p GROUP BY label
        UNION ALL SELECT 'distribution', 'prediction ' || prediction::VARCHAR, 'n', count(*)::DOUBLE FROM p GROUP BY prediction
        UNION ALL SELECT 'strata', k, 'f1', round((y * coalesce(2 * a / nullif(2 * a + w, 0), 0) + (n - y) * coalesce(2 * d / nullif(2 * d + w, 0), 0)) / n, 4) FROM g
        UNION ALL SELECT 'strata', k, 'n', n::DOUBLE FROM g""",
)
def evaluate(spark, d):
    """Every frame of an evaluation in one table; the model is a rule, so that SQL can follow it."""
    rule = SQLTransformer(statement="""SELECT *, CASE WHEN event_type = 'error' THEN 1.0D ELSE 0.0D END AS label,
        CASE WHEN value > 40 THEN 1.0D ELSE 0.0D END AS prediction, value / (value + 40) AS probability FROM __THIS__""")
    gates = spark.createDataFrame(EVALUATED, "gate string, metric_name string, operator string, threshold double")
    out = evaluation.evaluate(rule, table(spark, d, "events"), stratify_columns=["event_type", "user_id"], gates=gates, digits=12)

    def rows(frame, name, **fields):
        items = [F.struct(F.lit(k).alias("field"), c.cast("double").alias("value")) for k, c in fields.items()]
        return out[frame].select(F.lit(frame).alias("frame"), name.cast("string").alias("name"), F.inline(F.array(*items)))

    metrics = out["metrics"]
    numbers = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("accuracy", "f1", "logLoss", "areaUnderROC")]))
    parts = [
        metrics.select(numbers.alias("m")).select(F.lit("metrics").alias("frame"), "m.name", F.lit("value").alias("field"), "m.value"),
        rows("gates", F.col("gate"), passed=F.col("passed")),
        rows("report", F.col("class"), f1=F.col("f1"), support=F.col("support")).filter("name NOT LIKE '%avg'"),
        rows("confusion", F.concat_ws(" ", "label", "prediction"), n=F.col("n")),
        rows("distribution", F.concat_ws(" ", "side", "value"), n=F.col("n")),
        rows("strata", F.col("stratum"), f1=F.col("f1"), n=F.col("n")),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return rounded(whole, 4, "value")
