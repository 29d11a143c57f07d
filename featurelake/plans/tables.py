"""Queries over sources, sinks and the versioned store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import one_row
from ..functions.scalars import content_fingerprint
from ..operators import features, monitor
from ..operators.store import STAMP, FeatureStore, merge_latest
from ..sources import batch
from ..streaming import events as ev
from .registry import query, scratch, table


@query(
    "read_table",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50",
)
def read_table(spark, d):
    return batch.read_table(
        spark, f"{d}/events.parquet", ["event_id", "user_id", "value"], "event_type = 'purchase' AND value > 50"
    )


def order_store(spark, d) -> FeatureStore:
    """Two versions of the orders: as they are, and with open orders repriced."""
    store = FeatureStore(spark, scratch(spark, "store"))
    store.register("orders", "o_orderkey", "o_orderdate", "orders by key", {"owner": "sales"})
    orders = table(spark, d, "orders")
    store.write(orders, "orders", "overwrite")
    open_price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice"))
    store.write(orders.withColumn("o_totalprice", open_price), "orders", "overwrite")
    return store


@query("read_version", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_version(spark, d):
    return order_store(spark, d).read("orders", version=1, columns=["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("read_as_of_timestamp", "SELECT o_orderkey, o_totalprice FROM orders")
def read_as_of_timestamp(spark, d):
    store = order_store(spark, d)
    first = store.history("orders").filter("version = 1").first()["created_at"]
    return store.read("orders", as_of=first, columns=["o_orderkey", "o_totalprice"])


@query(
    "read_features",
    """SELECT o_orderkey, round(CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100 ELSE o_totalprice END, 2)
         AS o_totalprice
       FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def read_features(spark, d):
    df = order_store(spark, d).read(
        "orders", columns=["o_orderkey", "o_totalprice"], filter_condition="o_orderpriority = '1-URGENT'"
    )
    return df.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(
    "list_feature_groups",
    "SELECT 'orders' AS name, 'o_orderkey' AS entity_key, 2 AS latest_version, count(*) AS total_rows FROM orders",
)
def list_feature_groups(spark, d):
    return order_store(spark, d).list_groups().select("name", "entity_key", "latest_version", "total_rows")


@query(
    "version_history",
    """SELECT v.version, 'overwrite' AS operation, n.n AS row_count, 7 AS column_count
       FROM (SELECT unnest([1, 2]) AS version) v, (SELECT count(*) AS n FROM orders) n""",
)
def version_history(spark, d):
    return order_store(spark, d).history("orders").select("version", "operation", "row_count", "column_count")


ORDER_HASH = """md5(concat_ws(chr(31), o_custkey::VARCHAR, o_orderdate::VARCHAR, o_orderkey::VARCHAR,
    o_orderpriority, o_orderstatus, o_totalprice::VARCHAR))"""


@query(
    "write_version",
    f"""SELECT 1 AS version, count(*) AS row_count,
         sum(('0x' || substr({ORDER_HASH}, 1, 8))::BIGINT)::DECIMAL(38,0) AS hash_sum
       FROM orders""",
)
def write_version(spark, d):
    return order_store(spark, d).history("orders").filter("version = 1").select("version", "row_count", "hash_sum")


@query(
    "content_fingerprint",
    f"""SELECT sum(('0x' || substr({ORDER_HASH}, 1, 8))::BIGINT)::DECIMAL(38,0) AS hash_sum,
         count(*) AS row_count FROM orders""",
)
def fingerprint(spark, d):
    return content_fingerprint(table(spark, d, "orders"))


@query(
    "write_features",
    "SELECT event_type, 2 * count(*) AS n, round(2 * sum(value::DECIMAL(18,2))::DOUBLE, 2) AS total "
    "FROM events GROUP BY 1",
)
def write_features(spark, d):
    store = FeatureStore(spark, scratch(spark, "append"))
    store.register("events", "event_id", "ts")
    rows = table(spark, d, "events").repartition("event_type")
    store.write(rows, "events", "append", partition_columns=["event_type"])
    store.write(rows, "events", "append")
    return store.read("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("value").cast("decimal(18,2)")).cast("double"), 2).alias("total"),
    )


@query(
    "upsert_features",
    """SELECT o_orderkey, o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice
       FROM orders
       UNION ALL
       SELECT o_orderkey + 1000000000, o_orderpriority, 0.0 FROM orders WHERE o_orderstatus = 'P'""",
)
def upsert_features(spark, d):
    """Partial orders are repriced and as many new ones inserted; partitions without them keep their files."""
    store = FeatureStore(spark, scratch(spark, "upsert"))
    store.register("orders", "o_orderkey", "o_orderdate")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    parts = ["o_orderstatus"]
    store.upsert(orders.repartition(*parts), "orders", parts)
    changed = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    fresh = changed.withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    store.upsert(changed.unionByName(fresh).repartition(*parts), "orders", parts)
    return store.read("orders", columns=["o_orderkey", "o_orderpriority", "o_totalprice"])


@query(
    "compact_table",
    "SELECT 2 AS version, 4::BIGINT AS file_count, count(*) AS row_count FROM orders",
)
def compact_table(spark, d):
    store = FeatureStore(spark, scratch(spark, "compact"))
    store.register("orders", "o_orderkey", "o_orderdate")
    store.write(table(spark, d, "orders").repartition(12), "orders", "overwrite")
    store.compact("orders", 4)
    return store.history("orders").filter("version = 2").select("version", "file_count", "row_count")


@query(
    "compact_partitioned",
    """SELECT o_orderstatus, count(*) AS n, round(sum(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE o_totalprice END), 2) AS total,
         4 AS version, 0::BIGINT AS deltas, true AS fewer_files
       FROM orders GROUP BY o_orderstatus""",
)
def compact_partitioned(spark, d):
    """Two upserts of single partitions are folded into files by partition."""
    store = FeatureStore(spark, scratch(spark, "compact_parts"))
    store.register("orders", "o_orderkey", "o_orderdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    store.write(orders.repartition(8), "orders", "overwrite", "o_orderstatus")
    for price in (0.0, 1.0):
        store.upsert(orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(price)), "orders")
    store.compact("orders", 3)
    last = store.history("orders").filter("version >= 3").agg(
        F.max("version").alias("version"), F.max_by(F.size(F.filter("writes", lambda w: w["delta"])), "version").cast("long").alias("deltas"),
        (F.max_by("file_count", "version") < F.min_by("file_count", "version")).alias("fewer_files"))
    total = store.read("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return total.select("*", one_row(last).alias("last")).select("o_orderstatus", "n", "total", "last.*")


@query(
    "late_lookback",
    """WITH late AS (SELECT event_id, ts, user_id, value + 1 AS value FROM events
         WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 48 HOURS)
       SELECT e.event_id, e.user_id, round(coalesce(l.value, e.value), 2) AS value
       FROM events e LEFT JOIN late l USING (event_id)""",
)
def late_lookback(spark, d):
    """Late corrections are read with a lookback and merged; running it twice changes nothing."""
    rows = table(spark, d, "events").select("event_id", "ts", "user_id", "value")
    corrected = rows.withColumn("value", F.col("value") + 1)
    late = batch.incremental_load(corrected, "ts", datetime(2024, 1, 20), lookback_hours=48)
    once = merge_latest(rows, late, ["event_id"], ["ts"])
    twice = merge_latest(once, late, ["event_id"], ["ts"])
    return twice.select("event_id", "user_id", F.round("value", 2).alias("value"))


@query(
    "read_partitioned",
    """SELECT event_id, event_type, value FROM events
       WHERE event_type IN ('view', 'click') AND value BETWEEN 10 AND 60""",
)
def read_partitioned(spark, d):
    path = scratch(spark, "parts")
    table(spark, d, "events").repartition("event_type").write.partitionBy("event_type").parquet(path)
    return batch.read_partitioned(
        spark, path, {"event_type": ["view", "click"], "value": (10, 60)}, ["event_id", "event_type", "value"]
    )


@query(
    "incremental_load",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 36 HOURS""",
)
def incremental_load(spark, d):
    return batch.incremental_load(
        table(spark, d, "events"), "ts", datetime(2024, 1, 25), lookback_hours=36, columns=["event_id", "ts", "value"]
    )


@query(
    "schema_enforce",
    """SELECT c_custkey::VARCHAR AS c_custkey, TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment,
         NULL::DATE AS c_since, c_acctbal FROM customer""",
)
def schema_enforce(spark, d):
    expected = T.StructType(
        [
            T.StructField("c_custkey", T.StringType()),
            T.StructField("c_mktsegment", T.DoubleType()),
            T.StructField("c_since", T.DateType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    return batch.enforce_schema(table(spark, d, "customer"), expected)


@query("table_metadata", "SELECT count(*) AS row_count, 5::BIGINT AS file_count, true AS bytes_agree FROM lineitem")
def table_metadata(spark, d):
    """Of the line items written as five files; the bytes are those that a listing of the files gives."""
    path = scratch(spark, "metadata")
    batch.write_files(table(spark, d, "lineitem"), path, 5)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length"))
    meta = batch.table_metadata(spark.read.parquet(path), rows=True)
    return meta.select("row_count", "file_count", (F.col("size_bytes") == listed.scalar()).alias("bytes_agree"))


@query("load_audit", "SELECT 'append' AS operation, count(*) AS record_count FROM events")
def load_audit(spark, d):
    base = scratch(spark, "audit")
    batch.write_audited(table(spark, d, "events"), f"{base}/events", f"{base}/audit", source="events")
    return spark.read.schema(batch.AUDIT).parquet(f"{base}/audit").select("operation", "record_count")


def envelopes(spark, d):
    """Events in the layout of the Kafka source."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query(
    "deserialize_events",
    """SELECT user_id::VARCHAR AS kafka_key, event_type AS kafka_topic, (user_id % 4)::INTEGER AS kafka_partition,
         event_id AS kafka_offset, ts AS kafka_timestamp, (props->>'$.k')::INTEGER AS k, NULL::VARCHAR AS bad
       FROM events""",
)
def deserialize_events(spark, d):
    out = ev.deserialize_events(envelopes(spark, d), "k INT")
    return out.withColumnRenamed("_corrupt", "bad").withColumn(
        "kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz")
    )


@query(
    "latest_offsets",
    """SELECT event_type AS kafka_topic, (user_id % 4)::INTEGER AS kafka_partition, count(*) AS messages,
         min(event_id) AS first_offset, max(event_id) AS last_offset, arg_max(props, event_id) AS last_value
       FROM events GROUP BY 1, 2""",
)
def latest_offsets(spark, d):
    return _offsets(spark, d)


def _offsets(spark, d):
    rows = table(spark, d, "events").select(
        F.col("event_type").alias("kafka_topic"), (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"), F.col("props").alias("value"),
    )
    return ev.latest_offsets(rows)


@query(
    "topic_totals",
    "SELECT event_type AS kafka_topic, count(*) AS messages FROM events GROUP BY 1",
)
def topic_totals(spark, d):
    return ev.topic_totals(_offsets(spark, d))


@query(
    "newest_message",
    """SELECT event_type AS kafka_topic, (user_id % 4)::INTEGER AS kafka_partition, event_id AS last_offset,
         props AS last_value FROM events ORDER BY event_id DESC LIMIT 1""",
)
def newest_message(spark, d):
    return ev.newest_message(_offsets(spark, d))


@query(
    "kafka_payload",
    """SELECT user_id::VARCHAR AS key,
         '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","value":' || value || '}'
           AS value
       FROM events""",
)
def kafka_payload(spark, d):
    return ev.kafka_payload(table(spark, d, "events"), "user_id", ["event_id", "ts", "value"])


@query(
    "metrics_long_sink",
    """WITH m AS (SELECT event_type AS model_name, count(*)::DOUBLE AS runs, min(value) AS lowest, max(value) AS highest
         FROM events GROUP BY 1)
       SELECT model_name, 'runs' AS metric_name, runs AS metric_value FROM m
       UNION ALL SELECT model_name, 'lowest', lowest FROM m
       UNION ALL SELECT model_name, 'highest', highest FROM m""",
)
def metrics_long_sink(spark, d):
    path = scratch(spark, "metrics")
    wide = table(spark, d, "events").groupBy(F.col("event_type").alias("model_name")).agg(
        F.count(F.lit(1)).cast("double").alias("runs"), F.min("value").alias("lowest"), F.max("value").alias("highest")
    )
    monitor.long_metrics(wide, "model_name", ["runs", "lowest", "highest"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query(
    "row_set_diff",
    """WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
            b AS (SELECT o_orderkey, o_orderstatus,
                    CASE WHEN o_orderstatus = 'P' THEN -1.0 ELSE o_totalprice END AS o_totalprice FROM orders)
       SELECT o_orderkey, o_orderstatus, o_totalprice, 'removed' AS change, 1::BIGINT AS copies
         FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
       UNION ALL
       SELECT o_orderkey, o_orderstatus, o_totalprice, 'added', 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
       UNION ALL
       SELECT o_orderkey, o_orderstatus, o_totalprice, 'common', 1
         FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b)""",
)
def row_set_diff(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = a.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.lit(-1.0)).otherwise(F.col("o_totalprice"))
    )
    return features.row_set_diff(a, b)


@query(
    "version_diff",
    """WITH b AS (SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100 ELSE o_totalprice END AS p FROM orders),
       s AS (SELECT count(*) AS n, round(avg(p) - avg(o_totalprice), 4) AS pm, round(stddev(p) - stddev(o_totalprice), 4) AS ps FROM b)
       SELECT c.column_name, 'common' AS status, s.n AS rows_a, s.n AS rows_b, 0::BIGINT AS row_diff,
         CASE c.column_name WHEN 'o_totalprice' THEN s.pm WHEN 'o_orderkey' THEN 0.0 WHEN 'o_custkey' THEN 0.0 END AS mean_diff,
         CASE c.column_name WHEN 'o_totalprice' THEN s.ps WHEN 'o_orderkey' THEN 0.0 WHEN 'o_custkey' THEN 0.0 END AS std_diff
       FROM s, (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
                               'o_orderpriority']) AS column_name) c""",
)
def version_diff(spark, d):
    out = order_store(spark, d).compare("orders", 1, 2)
    return out.withColumns({c: F.round(c, 4) for c in ("mean_diff", "std_diff")})


__all__ = ["STAMP", "envelopes", "order_store"]
