import random

import pytest
from conftest import plan, rows
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from featurelake.functions.encoding import assemble_features
from featurelake.operators import evaluation, monitor, selection, splits, training


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        p = round(rng.random(), 2)
        y = 1.0 if rng.random() < p else 0.0
        data.append((i, y, 1.0 if p > 0.5 else 0.0, p, Vectors.dense([1 - p, p]), rng.choice(["x", "y", None])))
    return spark.createDataFrame(data, ["id", "label", "prediction", "p", "probability", "seg"]).repartition(4).cache()


@pytest.fixture(scope="module")
def ml(spark):
    rng = random.Random(1)
    data = []
    for i in range(300):
        f1, f2 = rng.gauss(0, 1), rng.gauss(5, 2)
        data.append((i, f1, f2, rng.uniform(0, 10), 1.0 if f1 + f2 > 5 else 0.0))
    df = spark.createDataFrame(data, "id int, f1 double, f2 double, f3 double, label double")
    return assemble_features(df, ["f1", "f2", "f3"])[0].cache()


def test_metrics_match_spark(scored):
    got = evaluation.classification_metrics(scored).first().asDict()
    for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1", "hammingLoss", "logLoss"):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(scored), abs=1e-6)
    for name in ("areaUnderROC", "areaUnderPR"):
        want = BinaryClassificationEvaluator(rawPredictionCol="p", metricName=name, numBins=0).evaluate(scored)
        assert got[name] == pytest.approx(want, abs=1e-6)


def test_auc_in_pieces(scored):
    assert evaluation.binary_auc(scored, "label", "p", partitions=9).first() == evaluation.binary_auc(
        scored, "label", "p", partitions=1).first()
    text = plan(evaluation.binary_auc(scored, "label", "p", partitions=9))
    assert text.count("SinglePartition") <= 2  # the result, and a table of one row per range
    several = scored.withColumn("label", F.col("id") % 3)
    assert "areaUnderROC" not in evaluation.classification_metrics(several).columns


def test_auc_of_one_class(scored):
    row = evaluation.binary_auc(scored.filter("label = 1"), "label", "p").first()
    assert row["areaUnderROC"] is None and row["areaUnderPR"] == 1.0


def test_regression_matches_spark(scored):
    df = scored.select((F.col("p") * 10).alias("label"), (F.col("p") * 9 + F.col("id") % 3).alias("prediction"))
    got = evaluation.regression_metrics(df).first().asDict()
    for name in ("rmse", "mse", "mae", "r2", "var"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df), abs=1e-5)


def test_stratified_matches_spark(scored):
    got = {r["stratum"]: (r["f1"], r["n"]) for r in evaluation.stratified_metrics(scored, ["seg", "absent"]).collect()}
    assert set(got) == {"seg=x", "seg=y"}
    part = scored.filter("seg = 'x'")
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(part)
    assert got["seg=x"] == (pytest.approx(want, abs=1e-6), part.count())


def test_report_averages(scored):
    got = {r["class"]: r for r in evaluation.classification_report(scored).collect()}
    assert set(got) == {"0.0", "1.0", "macro avg", "weighted avg"}
    assert got["macro avg"]["f1"] == pytest.approx((got["0.0"]["f1"] + got["1.0"]["f1"]) / 2)
    assert got["weighted avg"]["support"] == 600


def test_gates(spark):
    metrics = spark.createDataFrame([("m", "f1", 0.8)], "model string, metric_name string, metric_value double")
    gates = spark.createDataFrame(
        [("a", "f1", ">=", 0.8), ("b", "f1", "<", 0.8), ("c", "auc", ">=", 0.1), ("d", "f1", "?", 0.5), ("e", "f1", "==", 0.8 + 1e-10)],
        "gate string, metric_name string, operator string, threshold double")
    got = dict(rows(evaluation.quality_gates(metrics, gates, "model"), "gate", "passed"))
    assert got == {"a": True, "b": False, "c": False, "d": True, "e": True}


def test_split_is_stable(spark, scored):
    def parts(df):
        return [sorted(r["id"] for r in p.collect()) for p in splits.split_random(df, "id")]

    a = parts(scored)
    assert a == parts(scored.repartition(7).orderBy(F.desc("p")))
    assert sum(map(len, a)) == 600 and 430 < len(a[0]) < 530


def test_stratified_shares(spark):
    df = spark.range(20000).withColumn("y", F.when(F.col("id") % 20 == 0, 1).otherwise(0))
    marked = splits.assign_split_stratified(df, "id", "y")
    shares = {(r["y"], r["split"]): r["count"] for r in marked.groupBy("y", "split").count().collect()}
    assert shares[(1, "train")] / 1000 == pytest.approx(0.7, abs=0.05)
    assert shares[(0, "train")] / 19000 == pytest.approx(0.7, abs=0.02)


def test_imbalanced_sample_is_exact(spark):
    df = spark.range(3000).withColumn("y", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    got = splits.imbalanced_sample(df, F.col("y") == 1, "id", 0.02, 500)
    assert dict(rows(got.groupBy("y").count())) == {0: 490, 1: 10}
    assert rows(got) == rows(splits.imbalanced_sample(df.repartition(5), F.col("y") == 1, "id", 0.02, 500))
    short = splits.imbalanced_sample(df, F.col("y") == 1, "id", 0.9, 1000)
    assert dict(rows(short.groupBy("y").count())) == {0: 100, 1: 300}


def test_training(spark, ml):
    train, valid, _ = splits.split_random(ml, "id")
    options = dict(algorithms=["random_forest", "logistic_regression", "nonsense"], folds=2, max_iter=5,
                   grids={"random_forest": {"numTrees": [3, 5]}}, validation_df=valid, row_key="id")
    results = training.train(train, **options)
    ok = {r.algorithm: r for r in results if r.error is None}
    assert set(ok) == {"random_forest", "logistic_regression"}
    assert "unknown algorithm" in next(r for r in results if r.algorithm == "nonsense").error
    for r in ok.values():
        assert 0 <= r.validation_metrics["f1"] <= 1 and len(r.cv_scores) >= 1
    assert len(ok["random_forest"].cv_scores) == 2
    best, ranking, met = selection.select_trained(results, "f1", 0.5)
    assert ranking[0][1] == best.algorithm and met
    long = training.metric_rows(spark, "r1", list(ok.values()))
    assert selection.select_best(long.filter("dataset = 'validation'"), "f1", 0.5).count() == 1
    importance = training.feature_importance(ok["random_forest"].model, ["f1", "f2", "f3"], spark)
    values = [r["importance"] for r in importance.collect()]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    with pytest.raises(ValueError, match="no training results"):
        selection.select_trained([], "f1", 0.5)


def test_same_seed_same_metrics(ml):
    est = training.make_estimator("random_forest", "classification", "features", "label", seed=3)
    a = training.cross_validate(ml, est, "classification", "label", {"numTrees": [3]}, folds=2, row_key="id").avgMetrics
    b = training.cross_validate(ml, est, "classification", "label", {"numTrees": [3]}, folds=2, row_key="id").avgMetrics
    assert a == b


def counted(spark, ml):
    """The frame behind a function that counts the rows it makes."""
    made = spark.sparkContext.accumulator(0)

    def same(i):
        made.add(1)
        return i

    return ml.withColumn("id", F.udf(same, "int")("id")), made


def test_linear_search_equals_that_over_rows(spark, ml):
    frame, made = counted(spark, ml.withColumn("label", F.col("f1") * 2 + F.col("f2") * F.col("f3") + 1000))
    grid = {"regParam": [0.0, 0.1, 2.0], "elasticNetParam": [0.0, 0.5, 1.0]}
    est = training.make_estimator("linear_regression", "regression", "features", "label")
    got = training.cross_validate(frame, est, "regression", "label", grid, row_key="id")
    assert made.value == 300  # not once and more per fold
    rows_ = training.laid(frame, ["features", "label"], "id")
    want = CrossValidator(estimator=Pipeline(stages=[est]), estimatorParamMaps=training.make_grid(est, grid), numFolds=5,
                          evaluator=RegressionEvaluator(), foldCol=training.FOLD).fit(rows_)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-9) and got.stdMetrics == pytest.approx(want.stdMetrics, rel=1e-6)
    assert training.best_params(got.bestModel) == training.best_params(want.bestModel)
    assert got.bestModel.stages[-1].coefficients.toArray() == pytest.approx(want.bestModel.stages[-1].coefficients.toArray(), rel=1e-9)
    assert got.bestModel.stages[-1].summary.numInstances == 300


def test_rows_are_searched_where_moments_do_not_do(ml):
    folded = training.laid(ml, ["features", "label", "f1"], "id", folds=2)
    assert training.fold_points(folded, "features", "label").groupBy().sum(training.WEIGHT).first()[0] == pytest.approx(300)
    assert training.fold_points(folded.withColumn("label", F.lit(1.0)), "features", "label") is None
    assert training.fold_points(folded.withColumn("label", F.when(F.col("f1") > 0, 1.0)), "features", "label") is None
    lasso = training.make_estimator("linear_regression", "regression", "features", "label")
    assert not training.by_moments(lasso, "regression", "mae", {}) and training.by_moments(lasso, "regression", None, {"regParam": [1.0]})
    got = training.cross_validate(ml, lasso, "regression", "label", {"regParam": [0.0]}, folds=2, metric="mae", row_key="id")
    assert 0 < got.avgMetrics[0] < 1


def test_training_makes_rows_once(spark, ml):
    frame, made = counted(spark, ml)
    results = training.train(frame, ["random_forest", "logistic_regression"], grids={"random_forest": {"numTrees": [2]}}, folds=2, max_iter=2,
                             validation_df=frame, row_key="id")
    assert all(r.error is None and r.validation_metrics for r in results) and made.value <= 600


def test_estimators():
    assert training.make_estimator("logistic_regression", "classification", "f", "y", max_iter=7).getMaxIter() == 7
    assert training.make_estimator("ridge", "regression", "f", "y").getElasticNetParam() == 0.0
    with pytest.raises(ValueError, match="task type"):
        training.make_estimator("ridge", "clustering", "f", "y")
    with pytest.raises(ValueError, match="no parameter"):
        training.make_grid(training.make_estimator("ridge", "regression", "f", "y"), {"trees": [1]})


def test_evaluate(spark, ml):
    model = training.make_estimator("logistic_regression", "classification", "features", "label").fit(ml)
    gates = spark.createDataFrame([("g", "f1", ">=", 0.5)], "gate string, metric_name string, operator string, threshold double")
    out = evaluation.evaluate(model, ml.withColumn("seg", F.lit("s")), stratify_columns=["seg"], gates=gates)
    assert set(out) == {"metrics", "distribution", "confusion", "report", "strata", "gates"}
    assert out["gates"].first()["passed"] and out["strata"].first()["n"] == 300
    done = model.transform(ml)
    assert out["metrics"].first() == evaluation.classification_metrics(done).first()
    assert rows(out["report"]) == rows(evaluation.classification_report(done))
    assert rows(out["distribution"]) == rows(evaluation.prediction_distribution(done))
    assert rows(out["confusion"]) == rows(evaluation.confusion_matrix(done))


def test_evaluate_numbers_and_many_strata(spark, ml):
    model = training.make_estimator("linear_regression", "regression", "features", "label").fit(ml)
    frame = ml.withColumn("user", F.col("id").cast("string"))
    out = evaluation.evaluate(model, frame, task_type="regression", stratify_columns=["user", "absent"])
    done = model.transform(frame)
    assert out["metrics"].first() == evaluation.regression_metrics(done).first()
    assert rows(out["strata"]) == rows(evaluation.stratified_metrics(done, ["user"], task_type="regression")) and out["strata"].count() == 300
    rule = SQLTransformer(statement="SELECT *, CAST(f1 > 0 AS DOUBLE) AS prediction FROM __THIS__")
    plain = evaluation.evaluate(rule, frame, stratify_columns=["user"])
    assert "logLoss" not in plain["metrics"].columns and plain["strata"].count() == 300


def test_store_and_logistic_regression_share_a_session(spark, ml, base):
    """Guards against session state that makes models unserialisable (see clean_data)."""
    from featurelake.operators.store import FeatureStore

    store = FeatureStore(spark, base)
    store.register("g", "id", "f1")
    store.write(ml.select("id", "f1"), "g")
    model = training.make_estimator("logistic_regression", "classification", "features", "label", max_iter=2).fit(ml)
    assert model.transform(ml).filter("prediction >= 0").count() == 300


def test_ranks(spark):
    data = [("r", m, "f1", v) for m, v in (("a", 0.5), ("b", 0.9), ("c", 0.9))] + [("r", "d", "other", 1.0)]
    metrics = spark.createDataFrame(data, "run_id string, model_name string, metric_name string, metric_value double")
    got = rows(selection.candidate_rank(metrics, "f1"), "model_name", "rank")
    assert got == [("a", 3), ("b", 1), ("c", 2), ("d", 4)]
    assert rows(selection.candidate_rank(metrics, "f1", hot_rows=2), "model_name", "rank") == got
    low = selection.select_best(metrics.filter("metric_name = 'f1'"), "f1", 0.6, higher_is_better=False).first()
    assert (low["winner"], low["threshold_met"]) == ("a", True)


def test_monitor(spark, base):
    rows_ = [monitor.duration_row("load", 12.5), monitor.duration_row("load", 14.0)]
    for i, status in enumerate(["completed", "completed", "failed"]):
        rows_ += monitor.run_rows(f"r{i}", status, 1.0, [{"stage": "x", "status": status, "duration_seconds": 2.0}])
    rows_ += monitor.volume_rows("load", 10, 2, 100) + [monitor.model_row("m", "f1", 0.8)]
    monitor.record(spark, f"{base}/m", rows_[:3])
    monitor.record(spark, f"{base}/m", rows_[3:])
    table = spark.read.schema(monitor.METRICS).parquet(f"{base}/m")
    assert table.count() == len(rows_)
    stats = {r["stage"]: r for r in monitor.stage_statistics(table.filter("type = 'stage_duration'")).collect()}
    assert (stats["load"]["total_runs"], stats["load"]["mean"], stats["x"]["total_runs"]) == (2, 13.25, 2)
    one_run = monitor.stage_statistics(spark.createDataFrame([("s", 1.0, 1)], "stage string, value double, ts int")).first()
    assert one_run["std"] == 0.0
    limits = spark.createDataFrame(
        [("stage_load_duration", None, 13.0, "warning")], "metric_name string, min_value double, max_value double, alert_level string")
    alerts = monitor.threshold_alerts(table, limits)
    assert alerts.first()["reason"] == "stage_load_duration=14.0000 above maximum 13.0"
    report = monitor.health_report(table, alerts).first()
    assert (report["success_rate_pct"], report["failed_runs"], report["status"]) == (66.67, 1, "degraded")
    assert monitor.health_report(table, alerts.limit(0)).first()["status"] == "healthy"
    summary = {(r["type"], r["key"]): r for r in monitor.metrics_summary(table).collect()}
    assert summary[("model_metric", "m_f1")]["latest"] == 0.8
