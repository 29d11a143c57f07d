from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from featurelake.operators import quality
from featurelake.operators.store import FeatureStore
from featurelake.streaming import events as ev
from featurelake.streaming import sinks

SCHEMA = "id int, ts timestamp, kind string, value double"


def put(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(minute, second=0):
    return datetime(2024, 1, 1, 10, minute, second)


def start(spark, base, df, name="q", **options):
    q = sinks.start_stream(df, name, checkpoint_root=base, available_now=True, **options)
    q.awaitTermination()
    return q


def source(spark, base, **options):
    return spark.readStream.schema(SCHEMA).options(**options).parquet(f"{base}/in")


def test_restart_goes_on(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0)])
    start(spark, base, source(spark, base), output_path=f"{base}/out")
    put(spark, f"{base}/in", [(2, at(1), "a", 2.0)])
    for _ in range(2):
        start(spark, base, source(spark, base), output_path=f"{base}/out")
    assert rows(spark.read.parquet(f"{base}/out"), "id") == [(1,), (2,)]


def test_late_events_are_dropped_behind_the_watermark(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0), (2, at(30), "a", 2.0)])
    counts = ev.tumbling_counts(ev.with_event_time(source(spark, base), "ts", "5 minutes"), "ts", "10 minutes", "kind")
    start(spark, base, counts, output_path=f"{base}/out")
    put(spark, f"{base}/in", [(3, at(1), "a", 9.0), (4, at(50), "a", 1.0)])  # 3 is late
    start(spark, base, counts, output_path=f"{base}/out")
    got = rows(spark.read.parquet(f"{base}/out"), "window_start", "events")
    assert (at(0), 1) in got and (at(30), 1) in got and len(got) == 2


def test_watermark_needs_its_column(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0)])
    df = source(spark, base)
    assert ev.with_event_time(df, "absent") is df
    ntz = ev.with_event_time(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts")
    assert dict(ntz.dtypes)["ts"] == "timestamp"


def test_dedup_inside_watermark(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0), (1, at(0), "a", 1.0), (2, at(1), "a", 1.0)])
    df = ev.drop_repeats(ev.with_event_time(source(spark, base), "ts", "1 hour"), "id")
    start(spark, base, df, output_path=f"{base}/out")
    assert rows(spark.read.parquet(f"{base}/out"), "id") == [(1,), (2,)]


def test_validating_batch_can_be_repeated(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0), (2, at(0), "b", -1.0)])
    write = sinks.validating_batch(
        {"positive": F.col("value") > 0}, f"{base}/good", f"{base}/bad", [quality.not_null("id")], f"{base}/report")
    batch = spark.read.parquet(f"{base}/in")
    write(batch, 0)
    write(batch, 0)
    assert rows(spark.read.parquet(f"{base}/good"), "id") == [(1,)]
    assert [r["reasons"] for r in spark.read.parquet(f"{base}/bad").collect()] == [["positive"]]
    assert spark.read.parquet(f"{base}/report").count() == 1


def test_upserting_batch_skips_known_epochs(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0)])
    store = FeatureStore(spark, f"{base}/store")
    store.register("g", "id", "ts")
    write = sinks.upserting_batch(store, "g")
    batch = spark.read.parquet(f"{base}/in")
    write(batch, 0)
    write(batch, 0)
    write(batch.withColumn("value", F.lit(5.0)), 1)
    assert store.history("g").count() == 2 and rows(store.read("g"), "value") == [(5.0,)]


def test_sink_needs_a_path(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0)])
    with pytest.raises(ValueError, match="output_path"):
        sinks.start_stream(source(spark, base), "q", checkpoint_root=base)


def test_memory_sink_and_trigger(spark, base):
    put(spark, f"{base}/in", [(1, at(0), "a", 1.0)])
    q = sinks.start_stream(
        source(spark, base, maxFilesPerTrigger=1), "mem", format_type="memory", trigger_interval="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.table("mem").count() == 1
