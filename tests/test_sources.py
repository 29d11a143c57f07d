import json

import pytest
from conftest import plan, rows
from pyspark.sql import types as T

from featurelake.sources import batch, jdbc
from featurelake.streaming import events as ev


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(batch.read_table(spark, f"{sf_dir}/events.parquet", ["event_id"], "value > 50"))
    assert "GreaterThan(value,50.0)" in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_partition_pruning(spark, sf_dir, base):
    spark.read.parquet(f"{sf_dir}/events.parquet").write.partitionBy("event_type").parquet(f"{base}/e")
    df = batch.read_partitioned(spark, f"{base}/e", {"event_type": ["view"], "user_id": (1, 5), "event_id": 7})
    text = plan(df)
    assert "PartitionFilters: [isnotnull(event_type" in text or "PartitionFilters: [(event_type" in text
    assert "GreaterThanOrEqual(user_id,1)" in text
    with pytest.raises(ValueError, match="two bounds"):
        batch.partition_filter("x", (1, 2, 3))


def test_incremental_is_inclusive_and_pushed_down(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = batch.incremental_load(events, "ts", "2024-01-20 00:00:00", 24, ["event_id"])
    assert "GreaterThanOrEqual(ts,2024-01-19T00:00)" in plan(df)
    at = events.selectExpr("max(ts)").first()[0]
    assert batch.incremental_load(events, "ts", at).count() == 1
    with pytest.raises(ValueError, match="required"):
        batch.incremental_load(events, "ts", None)


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", 2, "x")], "a string, b int, extra string")
    expected = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.IntegerType()),
                             T.StructField("c", T.DateType())])
    out = batch.enforce_schema(df, expected)
    assert out.schema.names == ["b", "a", "c"] and rows(out) == [(2, 1, None)]
    with pytest.raises(ValueError, match="missing"):
        batch.enforce_schema(df, expected, strict=True)
    assert rows(batch.enforce_schema(df, T.StructType([T.StructField("b", T.IntegerType())]), True)) == [(2,)]


def test_metadata_and_audit(spark, base):
    df = spark.range(30).repartition(3)
    assert batch.write_audited(df, f"{base}/t", f"{base}/audit", source="range") == 30
    assert batch.write_audited(df, f"{base}/t", f"{base}/audit") == 30
    meta = batch.table_metadata(spark.read.parquet(f"{base}/t"), rows=True).first()
    assert meta["file_count"] == 6 and meta["row_count"] == 60 and meta["size_bytes"] > 0
    with pytest.raises(Exception, match="_metadata"):
        batch.table_metadata(df)
    assert [r["record_count"] for r in spark.read.parquet(f"{base}/audit").collect()] == [30, 30]
    assert batch.column_types(df) == {"id": "bigint"}


def test_files_of_a_given_number(spark, base):
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "cast(id % 7 AS string) AS s")
    for name, frame in (("one", df), ("more", df.repartition(9))):
        batch.write_files(frame, f"{base}/{name}", 5)
        back = spark.read.parquet(f"{base}/{name}")
        meta = batch.table_metadata(back, rows=True).first()
        assert (meta["file_count"], meta["row_count"]) == (5, 1000) and rows(back) == rows(df)
    batch.write_files(df.limit(0), f"{base}/none", 5)
    assert spark.read.schema(df.schema).parquet(f"{base}/none").count() == 0
    assert spark.conf.get(batch.UNION, "true") == "true"


def test_jdbc_options():
    assert jdbc.jdbc_options("u", table="t")["dbtable"] == "t"
    assert jdbc.jdbc_options("u", query="select 1")["query"] == "select 1"
    got = jdbc.jdbc_options("u", query="select 1", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=4)
    assert got["dbtable"] == "(select 1) t" and "query" not in got and got["numPartitions"] == "4"
    with pytest.raises(ValueError, match="lower_bound"):
        jdbc.jdbc_options("u", table="t", partition_column="id")
    with pytest.raises(ValueError, match="either"):
        jdbc.jdbc_options("u")
    assert jdbc.postgres_url("h", 5432, "d") == "jdbc:postgresql://h:5432/d"


def test_kafka_options():
    plain = ev.KafkaSource("h:9092", ["a", "b"]).options()
    assert plain["subscribe"] == "a,b" and plain["maxOffsetsPerTrigger"] == "10000"
    assert plain["failOnDataLoss"] == "false" and "kafka.sasl.mechanism" not in plain
    secure = ev.KafkaSource("h", ["a"], sasl_mechanism="PLAIN", username="u", password='p"w', extra={"x": "y"})
    assert 'password="p\\"w"' in secure.options()["kafka.sasl.jaas.config"] and secure.options()["x"] == "y"
    assert "subscribe" not in secure.connection()


def test_avro_schema():
    record = json.loads("""{"type": "record", "name": "e", "fields": [
      {"name": "id", "type": "string"}, {"name": "n", "type": ["null", "long"]}, {"name": "ok", "type": "boolean"},
      {"name": "xs", "type": {"type": "array", "items": "double"}}, {"name": "odd", "type": {"type": "enum"}},
      {"name": "m", "type": {"type": "map", "values": "int"}},
      {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
      {"name": "sub", "type": {"type": "record", "name": "s", "fields": [{"name": "f", "type": "float"}]}}]}""")
    got = ev.avro_schema(record)
    assert got["id"].dataType == T.StringType() and not got["id"].nullable
    assert got["n"].dataType == T.LongType() and got["n"].nullable
    assert got["ok"].dataType == T.BooleanType() and got["odd"].dataType == T.StringType()
    assert got["xs"].dataType == T.ArrayType(T.DoubleType(), False) and isinstance(got["sub"].dataType, T.StructType)
    assert got["at"].dataType == T.TimestampType() and isinstance(got["m"].dataType, T.MapType)


def envelope(spark, values):
    data = [(b"k", v, "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, ev.KAFKA_SCHEMA)


def test_malformed_messages_are_kept(spark):
    good = b'{"event_id": "e1", "timestamp": "2024-01-01T00:00:00Z", "feature_values": [1.0, null], "label": 1}'
    out = {r["kafka_offset"]: r for r in ev.deserialize_events(envelope(spark, [good, b"{oops", None])).collect()}
    assert out[0]["event_id"] == "e1" and out[0]["feature_values"] == [1.0, None] and out[0]["_corrupt"] is None
    assert out[1]["event_id"] is None and out[1]["_corrupt"] == "{oops"
    assert out[2]["event_id"] is None


def test_message_id(spark):
    df = spark.createDataFrame([('{"transaction_id": "t1"}', 1), ('{"x": 1}', 2)], "value string, offset bigint")
    got = df.select(ev.message_id("value", ["trade_id", "transaction_id"], "offset").alias("m"))
    assert rows(got) == [("offset_2",), ("t1",)]


def test_payload_round_trip(spark):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-01-01 10:00:00' AS ts, CAST(NULL AS DOUBLE) AS x")
    out = ev.kafka_payload(df, "id").first()
    assert out["key"] == "1"
    assert json.loads(out["value"]) == {"id": 1, "ts": "2024-01-01T10:00:00.000000Z", "x": None}
