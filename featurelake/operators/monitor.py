"""Monitoring over one long, append-only metric table.

Layout: ``type, run_id, stage, model_name, metric_name, value, status, ts``, where type is
stage_duration, data_volume, model_metric, pipeline_run or transform.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_list, one_row
from ..functions.quantiles import group_quantiles
from ..functions.skew import HOT_ROWS, attach, hot_keys

METRICS = (
    "type string, run_id string, stage string, model_name string, metric_name string, "
    "value double, status string, ts timestamp"
)


def metric_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows given by name; missing fields are NULL, a missing time is now."""
    now = datetime.now(timezone.utc)
    names = [f.split()[0] for f in METRICS.split(", ")]
    data = [tuple(float(v) if n == "value" and v is not None else v for n in names for v in [
        r.get(n, now if n == "ts" else None)]) for r in rows]
    return spark.createDataFrame(data, METRICS)


def duration_row(stage: str, seconds: float, status: str = "completed", run_id: str | None = None) -> dict:
    return {
        "type": "stage_duration", "stage": stage, "metric_name": f"stage_{stage}_duration",
        "value": round(seconds, 3), "status": status, "run_id": run_id,
    }


def volume_rows(stage: str, row_count: int, column_count: int = 0, size_bytes: int = 0, run_id: str | None = None):
    values = {"rows": row_count, "columns": column_count, "bytes": size_bytes}
    return [
        {"type": "data_volume", "stage": stage, "metric_name": f"data_{stage}_{k}", "value": v, "run_id": run_id}
        for k, v in values.items()
    ]


def model_row(model_name: str, metric_name: str, value: float, run_id: str | None = None) -> dict:
    return {
        "type": "model_metric", "model_name": model_name, "metric_name": metric_name, "value": round(value, 6),
        "run_id": run_id,
    }


def run_rows(run_id: str, status: str, seconds: float, stages: list[dict]) -> list[dict]:
    """A run and the durations of its completed stages."""
    done = [s for s in stages if s.get("status") == "completed"]
    out = [duration_row(s["stage"], s.get("duration_seconds", 0.0), "completed", run_id) for s in done]
    return out + [{"type": "pipeline_run", "run_id": run_id, "status": status, "value": seconds}]


def record(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Append rows to the metric table."""
    metric_frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def long_metrics(df: DataFrame, keys, metrics, name: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Wide metric columns to one row per metric."""
    return df.unpivot(as_list(keys), as_list(metrics), name, value)


def stage_statistics(
    metrics: DataFrame, stage: str = "stage", value: str = "value", ts="ts", digits: int = 3,
    hot_rows: int | None = HOT_ROWS // 4,
) -> DataFrame:
    """Runs, mean, median, range, sample deviation (0 for one run) and last value per stage."""
    stats = metrics.groupBy(stage).agg(
        F.count(value).alias("total_runs"),
        F.round(F.avg(value), digits).alias("mean"),
        F.round(F.min(value), digits).alias("min"),
        F.round(F.max(value), digits).alias("max"),
        F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), digits).alias("std"),
        F.round(F.max_by(value, F.struct(*as_list(ts))), digits).alias("last"),
    )
    middle = group_quantiles(metrics, stage, {value: {"median": 0.5}}, hot_rows)
    out = attach(stats, middle, [stage], hot_keys(stats, [stage], None))
    return out.withColumn("median", F.round("median", digits))


def threshold_alerts(metrics: DataFrame, thresholds: DataFrame, metric: str = "metric_name", value: str = "value") -> DataFrame:
    """Rows below the minimum or above the maximum, with level and reason.

    ``thresholds``: metric_name, min_value, max_value, alert_level. Spark sends it to all executors if its size allows.
    """
    limits = thresholds.withColumnRenamed("metric_name", "__m")
    low, high = F.col(value) < F.col("min_value"), F.col(value) > F.col("max_value")
    text = F.format_string("%.4f", F.col(value))
    reason = F.when(
        low, F.concat(F.col(metric), F.lit("="), text, F.lit(" below minimum "), F.col("min_value").cast("string"))
    ).otherwise(
        F.concat(F.col(metric), F.lit("="), text, F.lit(" above maximum "), F.col("max_value").cast("string"))
    )
    return (
        metrics.join(limits, F.col(metric) == F.col("__m"))
        .filter(F.coalesce(low, F.lit(False)) | F.coalesce(high, F.lit(False)))
        .withColumn("reason", reason)
        .withColumnRenamed("alert_level", "level")
        .drop("__m", "min_value", "max_value")
    )


def recent_alerts(alerts: DataFrame, order, limit: int = 50, level: str | None = None) -> DataFrame:
    kept = alerts if level is None else alerts.filter(F.col("level") == level)
    return kept.orderBy(*[F.col(o).desc() for o in as_list(order)]).limit(limit)


def health_report(metrics: DataFrame, alerts: DataFrame) -> DataFrame:
    """Runs, failures, success rate and alerts as one row; degraded with any warning or critical."""
    is_run = F.col("type") == "pipeline_run"
    runs = metrics.agg(
        F.count_if(is_run).alias("total_runs"),
        F.count_if(is_run & (F.col("status") == "failed")).alias("failed_runs"),
        F.count(F.lit(1)).alias("total_metrics"),
    )
    active = alerts.agg(
        F.count_if(F.col("level").isin("warning", "critical")).alias("active_alerts"),
        F.count(F.lit(1)).alias("total_alerts"),
    )
    rate = (F.col("total_runs") - F.col("failed_runs")) / F.greatest("total_runs", F.lit(1)) * 100
    return runs.select("*", one_row(active).alias("__a")).select("*", "__a.*").select(
        "total_runs", "failed_runs", F.round(rate, 2).alias("success_rate_pct"), "active_alerts", "total_alerts",
        "total_metrics", F.when(F.col("active_alerts") > 0, "degraded").otherwise("healthy").alias("status"),
    )


def metrics_summary(metrics: DataFrame, order="ts") -> DataFrame:
    """Per type and key (stage, or model and metric): count, mean, total and latest value."""
    key = F.when(F.col("type") == "model_metric", F.concat_ws("_", "model_name", "metric_name")).otherwise(F.col("stage"))
    return metrics.groupBy("type", key.alias("key")).agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.floor(F.avg("value")).alias("mean_whole"),
        F.sum("value").alias("total"),
        F.round(F.max_by("value", F.struct(*as_list(order))), 6).alias("latest"),
    )
