"""Queries over the monitoring table: event types stand for stages and models, values for measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import monitor
from .registry import query, rounded, scratch, table


def metric_table(spark, d):
    """Errors and signups are pipeline runs, purchases model metrics, the others stage durations."""
    kind = (
        F.when(F.col("event_type").isin("error", "signup"), "pipeline_run")
        .when(F.col("event_type") == "purchase", "model_metric")
        .otherwise("stage_duration")
    )
    return table(spark, d, "events").select(
        kind.alias("type"), "event_id", F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"),
        F.lit("m").alias("model_name"), F.concat(F.lit("stage_"), F.col("event_type"), F.lit("_duration")).alias("metric_name"),
        "value", F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), "ts")


TABLE = """t AS (SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'pipeline_run' WHEN event_type = 'purchase' THEN 'model_metric'
      ELSE 'stage_duration' END AS type, event_id, event_type AS stage, 'm' AS model_name,
    'stage_' || event_type || '_duration' AS metric_name, value,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, ts FROM events)"""

LIMITS = [
    ("stage_view_duration", 1.0, 200.0, "warning"), ("stage_click_duration", None, 250.0, "critical"),
    ("stage_purchase_duration", 0.5, None, "info"),
]

ALERTS = """a AS (SELECT t.event_id, t.metric_name, t.value, t.ts, l.level,
    t.metric_name || '=' || format('{:.4f}', t.value) || CASE WHEN t.value < l.lo THEN ' below minimum ' || l.lo ELSE ' above maximum ' || l.hi END AS reason
  FROM t JOIN (VALUES ('stage_view_duration', 1.0::DOUBLE, 200.0::DOUBLE, 'warning'), ('stage_click_duration', NULL, 250.0, 'critical'),
    ('stage_purchase_duration', 0.5, NULL, 'info')) l(m, lo, hi, level) ON t.metric_name = l.m
  WHERE t.value < l.lo OR t.value > l.hi)"""


def alerts(spark, d):
    limits = spark.createDataFrame(
        LIMITS, "metric_name string, min_value double, max_value double, alert_level string")
    return monitor.threshold_alerts(metric_table(spark, d), limits)


@query(
    "stage_statistics",
    """SELECT event_type AS stage, count(value) AS total_runs, round(avg(value), 3) AS mean, round(quantile_cont(value, 0.5), 3) AS median,
         round(min(value), 3) AS min, round(max(value), 3) AS max, round(stddev_samp(value), 3) AS std,
         arg_max(value, (ts, event_id)) AS last FROM events GROUP BY 1""",
)
def stage_statistics(spark, d):
    return monitor.stage_statistics(metric_table(spark, d), ts=["ts", "event_id"])


@query("threshold_alerts", f"WITH {TABLE}, {ALERTS} SELECT event_id, metric_name, value, level, reason FROM a")
def threshold_alerts(spark, d):
    return alerts(spark, d).select("event_id", "metric_name", "value", "level", "reason")


@query(
    "recent_alerts",
    f"WITH {TABLE}, {ALERTS} SELECT event_id, level, value FROM a WHERE level = 'warning' ORDER BY ts DESC, event_id DESC LIMIT 10",
)
def recent_alerts(spark, d):
    return monitor.recent_alerts(alerts(spark, d), ["ts", "event_id"], 10, "warning").select("event_id", "level", "value")


@query(
    "health_report",
    f"""WITH {TABLE}, {ALERTS}, r AS (SELECT count(*) FILTER (type = 'pipeline_run') AS total_runs,
          count(*) FILTER (type = 'pipeline_run' AND status = 'failed') AS failed_runs, count(*) AS total_metrics FROM t),
        x AS (SELECT count(*) FILTER (level IN ('warning', 'critical')) AS active_alerts, count(*) AS total_alerts FROM a)
        SELECT total_runs, failed_runs, round((total_runs - failed_runs) / greatest(total_runs, 1) * 100, 2) AS success_rate_pct,
          active_alerts, total_alerts, total_metrics, CASE WHEN active_alerts > 0 THEN 'degraded' ELSE 'healthy' END AS status FROM r, x""",
)
def health_report(spark, d):
    return monitor.health_report(metric_table(spark, d), alerts(spark, d))


@query(
    "metrics_summary",
    f"""WITH {TABLE} SELECT type, CASE WHEN type = 'model_metric' THEN model_name || '_' || metric_name ELSE stage END AS key,
          count(value) AS count, round(avg(value), 6) AS mean, floor(avg(value))::BIGINT AS mean_whole, round(sum(value), 2) AS total,
          round(arg_max(value, (ts, event_id)), 6) AS latest FROM t GROUP BY 1, 2""",
)
def metrics_summary(spark, d):
    return rounded(monitor.metrics_summary(metric_table(spark, d), ["ts", "event_id"]), 2, "total")


@query(
    "record_metrics",
    """SELECT 'data_volume' AS type, 'data_' || event_type || '_' || field AS metric_name, max(value)::DOUBLE AS value
       FROM (SELECT event_type, unnest(['rows', 'columns', 'bytes']) AS field, unnest([count(*), 0, 0]) AS value FROM events GROUP BY event_type)
       GROUP BY event_type, field""",
)
def record_metrics(spark, d):
    """One volume row per stage, appended twice over (half of the stages each) and read back."""
    path = scratch(spark, "monitor")
    counts = [r for r in table(spark, d, "events").groupBy("event_type").count().collect()]  # one row per stage
    for part in (counts[::2], counts[1::2]):
        monitor.record(spark, path, [row for r in part for row in monitor.volume_rows(r["event_type"], r["count"])])
    return spark.read.schema(monitor.METRICS).parquet(path).select("type", "metric_name", "value")
