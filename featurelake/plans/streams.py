"""Queries over streams. Each runs to the end of its input (availableNow) and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..operators.store import FeatureStore
from ..streaming import events as ev
from ..streaming import sinks
from .registry import query, scratch, table
from .tables import envelopes


def event_stream(spark, d, max_files: int | None = None):
    reader = spark.readStream.schema(table(spark, d, "events").schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("pathGlobFilter", "events.parquet").parquet(d)


def replay(spark, d, files: int = 3):
    """Kafka-shaped files derived from the events, as a stream."""
    path = scratch(spark, "replay")
    envelopes(spark, d).repartitionByRange(files, "offset").write.parquet(path)
    return ev.read_envelopes(spark, path, max_files_per_trigger=1)


def run(df, name, **options):
    """Run a query to its end and return the folder it wrote."""
    base = scratch(df.sparkSession, name)
    query_handle = sinks.start_stream(
        df, name, f"{base}/out", checkpoint_root=f"{base}/ckpt", available_now=True, **options)
    query_handle.awaitTermination()
    return f"{base}/out"


@query(
    "stream_parse",
    """SELECT user_id::VARCHAR AS kafka_key, event_type AS kafka_topic, event_id AS kafka_offset,
         (props->>'$.k')::INTEGER AS k FROM events""",
)
def stream_parse(spark, d):
    parsed = ev.parse_stream(replay(spark, d), "k INT", "kafka_timestamp", "10 seconds")
    out = run(parsed.select("kafka_key", "kafka_topic", "kafka_offset", "k"), "stream_parse")
    return spark.read.parquet(out)


@query("stream_append", "SELECT event_id, event_type, value FROM events WHERE value > 20")
def stream_append(spark, d):
    rows = event_stream(spark, d).filter("value > 20").select("event_id", "event_type", "value")
    return spark.read.parquet(run(rows, "stream_append", partition_columns="event_type")).select(
        "event_id", "event_type", "value")


@query("stream_sink", "SELECT user_id, event_id, value FROM events")
def stream_sink(spark, d):
    rows = event_stream(spark, d).select("user_id", "event_id", "value")
    return spark.read.parquet(run(rows, "stream_sink")).select("user_id", "event_id", "value")


@query("stream_trigger", "SELECT event_type AS kafka_topic, event_id AS kafka_offset FROM events")
def stream_trigger(spark, d):
    """Micro-batches by processing time, one file each, until all input is worked off."""
    base = scratch(spark, "trigger")
    rows = ev.deserialize_events(replay(spark, d), "k INT").select("kafka_topic", "kafka_offset")
    handle = sinks.start_stream(rows, "trigger", f"{base}/out", trigger_interval="1 second", checkpoint_root=base)
    try:
        handle.processAllAvailable()
    finally:
        handle.stop()
    return spark.read.parquet(f"{base}/out")


def _latest_counts(spark, d, name, mode):
    """Counts per type as the last micro-batch left them, kept by a per-batch function."""
    target = scratch(spark, name)

    def keep(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{target}/e={epoch}")

    rows = replay(spark, d).groupBy(F.col("topic").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))
    base = scratch(spark, name)
    sinks.start_stream(
        rows, name, output_mode=mode, foreach_batch=keep, checkpoint_root=base, available_now=True
    ).awaitTermination()
    return spark.read.parquet(target)


@query("stream_update", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_update(spark, d):
    out = _latest_counts(spark, d, "stream_update", "update")
    return out.groupBy("event_type").agg(F.max_by("n", "epoch").alias("n"))


@query("stream_complete", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_complete(spark, d):
    out = _latest_counts(spark, d, "stream_complete", "complete")
    return out.filter(F.col("epoch") == out.agg(F.max("epoch")).scalar()).select("event_type", "n")


@query("stream_checkpoint", "SELECT event_id, value FROM events")
def stream_checkpoint(spark, d):
    """Stopped and started again with the same checkpoint: nothing is lost, nothing comes twice."""
    base = scratch(spark, "restart")
    rows = event_stream(spark, d).select("event_id", "value")
    for _ in range(2):
        sinks.start_stream(
            rows, "restart", f"{base}/out", checkpoint_root=base, available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("rate_limited_stream", "SELECT event_id AS kafka_offset, event_type AS kafka_topic FROM events")
def rate_limited_stream(spark, d):
    """At most one file per micro-batch."""
    parsed = ev.deserialize_events(replay(spark, d), "k INT").select("kafka_offset", "kafka_topic")
    return spark.read.parquet(run(parsed, "rate_limited"))


@query(
    "stream_validate",
    """SELECT event_id, array_to_string(list_filter([CASE WHEN value <= 0 THEN 'value_positive' END,
         CASE WHEN value > 100 THEN 'value_at_most_100' END,
         CASE WHEN event_type NOT IN ('view', 'click') THEN 'event_type_known' END], lambda x: x IS NOT NULL), ',') AS reasons
       FROM events WHERE value <= 0 OR value > 100 OR event_type NOT IN ('view', 'click')""",
)
def stream_validate(spark, d):
    base = scratch(spark, "validate")
    rules = quality.request_constraints("value", 100, {"event_type": ["view", "click"]})
    write = sinks.validating_batch(
        rules, f"{base}/good", f"{base}/bad", [quality.not_null("event_id")], f"{base}/report")
    sinks.start_stream(
        event_stream(spark, d), "validate", foreach_batch=write, checkpoint_root=base, available_now=True
    ).awaitTermination()
    return spark.read.parquet(f"{base}/bad").select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query("foreach_batch", "SELECT event_id, round(value, 2) AS value FROM events")
def foreach_batch(spark, d):
    """Micro-batches upserted into a feature group; a repeated batch number is skipped."""
    store = FeatureStore(spark, scratch(spark, "stream_store"))
    store.register("events", "event_id", "ts")
    write = sinks.upserting_batch(store, "events")
    sinks.start_stream(
        event_stream(spark, d).select("event_id", "ts", "value"), "upserts", foreach_batch=write,
        checkpoint_root=scratch(spark, "upserts"), available_now=True,
    ).awaitTermination()
    return store.read("events").select("event_id", F.round("value", 2).alias("value"))


@query(
    "watermark",
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events, round(sum(value::DECIMAL(18,2))::DOUBLE, 2) AS value_sum
       FROM events GROUP BY 1, 2""",
)
def watermark(spark, d):
    """Hourly counts with a watermark. The last windows are still open at the end of the input, so
    their state is taken in update mode."""
    rows = ev.with_event_time(event_stream(spark, d), "ts", "10 seconds")
    counts = ev.tumbling_counts(
        rows.withColumn("value", F.col("value").cast("decimal(18,2)")), "ts", "1 hour", "event_type", "value")
    closed = _windows(spark, counts)
    return closed.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events",
        F.round(F.col("value_sum").cast("double"), 2).alias("value_sum"))


def _windows(spark, counts):
    """Final state of every window, taken in update mode, where open windows are shown too."""
    target = scratch(spark, "windows")

    def keep(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{target}/e={epoch}")

    sinks.start_stream(
        counts, "windows", output_mode="update", foreach_batch=keep, checkpoint_root=scratch(spark, "windows_ckpt"),
        available_now=True,
    ).awaitTermination()
    out = spark.read.parquet(target)
    return out.groupBy("window_start", "event_type").agg(
        F.max_by("events", "epoch").alias("events"), F.max_by("value_sum", "epoch").alias("value_sum"))


@query("stream_dedup", "SELECT DISTINCT event_type FROM events")
def stream_dedup(spark, d):
    rows = ev.with_event_time(event_stream(spark, d), "ts", "60 days")
    return spark.read.parquet(run(ev.drop_repeats(rows, "event_type").select("event_type"), "dedup"))


@query(
    "message_id",
    """SELECT event_id, coalesce(json_extract_string(props, '$.trade_id'),
         CASE WHEN event_id % 3 = 0 THEN json_extract_string(props, '$.k') END, 'offset_' || event_id) AS id FROM events""",
)
def message_id(spark, d):
    """The first id field that a message has, else its offset; only every third message keeps its field."""
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise("{}").alias("value"))
    return rows.select("event_id", ev.message_id("value", ["trade_id", "k"], "event_id").alias("id"))
