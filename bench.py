"""Time the headline queries: prints one JSON line.

Every query runs once to warm up, then ``BENCH_RUNS`` times (default 3); the median counts. Results
are counted in full by the noop sink. ``--naive`` also times the plain Spark form of the methods
listed in SURVEY section 4.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from featurelake.plans import QUERIES
from featurelake.plans.registry import sparse_events, table

HEADLINE = [
    "read_table", "filter_and", "dedupe", "clean_data", "fill_median", "fill_forward", "clip_iqr",
    "normalize_standard", "join_inner", "join_on_pair", "join_group_stats", "point_in_time_join", "training_set",
    "aggregate", "group_features", "null_profile", "numeric_profile", "categorical_profile", "drift_report",
    "rolling_mean", "rolling_stddev", "lag_features", "latest_per_user", "temporal_features", "interaction_features",
    "encode_label", "encode_frequency", "assemble_scaled", "validation_report", "request_constraints", "split_random",
    "imbalanced_sample", "classification_metrics", "regression_metrics", "stratified_metrics", "candidate_rank",
    "quality_gates", "stage_statistics", "metrics_summary", "upsert_features", "stream_append",
]


def naive_validation(spark, d):
    """Two jobs per rule."""
    df = sparse_events(spark, d)
    bad = [
        F.col("value").isNull(), F.col("event_type").isNull(), (F.col("value") < 0) | (F.col("value") > 100),
        ~F.col("event_type").isin("view", "click"),
    ]
    for condition in bad:
        df.count()
        df.filter(condition).count()
    df.count()
    df.select("event_id").distinct().count()
    q1, q3 = df.approxQuantile("value", [0.25, 0.75], 0.01)
    return df.filter((F.col("value") < q1) | (F.col("value") > q3)).agg(F.count(F.lit(1)))


def naive_median(spark, d):
    """One quantile job per column."""
    df = table(spark, d, "lineitem")
    fills = {c: df.approxQuantile(c, [0.5], 0.01)[0] for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    return df.fillna(fills)


def naive_rolling(spark, d):
    """One withColumn per feature."""
    df = table(spark, d, "events")
    for n in (3, 10):
        w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-(n - 1), 0)
        df = df.withColumn(f"value_w{n}_mean", F.avg("value").over(w))
    return df


def naive_asof(spark, d):
    """Inequality join that pairs every event with its whole past, then a rank."""
    e = table(spark, d, "events")
    buys = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = e.filter("event_type = 'view'").select(
        F.col("user_id").alias("u"), F.col("ts").alias("t"), F.col("value").alias("amount"))
    joined = buys.join(views, (F.col("user_id") == F.col("u")) & (F.col("t") <= F.col("ts")), "left")
    w = Window.partitionBy("user_id", "ts").orderBy(F.col("t").desc())
    return joined.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("event_id", "amount")


def naive_strata(spark, d):
    """Three jobs per value."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from featurelake.plans.models import predictions

    p = predictions(spark, d).drop("probability")
    f1 = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    rows = []
    for r in p.select("event_type").distinct().collect():
        part = p.filter(F.col("event_type") == r[0])
        if part.count():
            rows.append((r[0], f1.evaluate(part), part.count()))
    return spark.createDataFrame(rows, "stratum string, f1 double, n bigint")


def naive_counts(spark, d):
    """A count for the log before the work itself."""
    df = table(spark, d, "events")
    df.count()
    return df.filter("event_type = 'purchase' AND value > 50").select("event_id", "user_id", "value")


NAIVE = {
    "validation_report": naive_validation, "fill_median": naive_median, "rolling_mean": naive_rolling,
    "point_in_time_join": naive_asof, "stratified_metrics": naive_strata, "read_table": naive_counts,
}


def timed(fn, spark, sf_dir, runs: int) -> float:
    times = []
    for i in range(runs + 1):
        start = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        if i or not runs:
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    queries, naive = {}, {}
    for name in chosen:
        queries[name] = timed(QUERIES[name], spark, sf_dir, runs)
        if "--naive" in sys.argv and name in NAIVE:  # side by side, so that both meet the same warm JVM
            naive[name] = timed(NAIVE[name], spark, sf_dir, runs)
    out = {
        "metric": "headline_total", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if naive:
        out["naive"] = naive
    out["rows_per_sec"] = {
        n: round(table(spark, sf_dir, t).count() / queries[n])
        for n, t in (("rolling_mean", "events"), ("dedupe", "lineitem"), ("aggregate", "lineitem")) if n in queries
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
