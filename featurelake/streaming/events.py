"""Event streams: Kafka options, parsing, watermarks, offsets, outgoing payloads.

Everything but the connector itself works on any frame with the Kafka columns, streaming or not.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_list

# The default event layout.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("feature_values", T.ArrayType(T.DoubleType())),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("label", T.DoubleType()),
        T.StructField("metadata", T.StringType()),
    ]
)

# The frame layout of the Kafka source.
KAFKA_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

# Avro primitive types.
AVRO_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


@dataclass
class KafkaSource:
    """Connection settings; ``options()`` are those of Spark's Kafka reader."""

    bootstrap_servers: str
    topics: list[str]
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 10_000
    fail_on_data_loss: bool = False
    security_protocol: str = "PLAINTEXT"
    sasl_mechanism: str | None = None
    username: str | None = None
    password: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        out = {
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "failOnDataLoss": "true" if self.fail_on_data_loss else "false",
        }
        return out | self.connection() | self.extra

    def connection(self) -> dict[str, str]:
        """Options the reader and the writer share."""
        out = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.security.protocol": self.security_protocol,
        }
        if self.sasl_mechanism:
            out["kafka.sasl.mechanism"] = self.sasl_mechanism
        if self.username and self.password:
            login = "org.apache.kafka.common.security.plain.PlainLoginModule"
            user, word = (x.replace("\\", "\\\\").replace('"', '\\"') for x in (self.username, self.password))
            out["kafka.sasl.jaas.config"] = f'{login} required username="{user}" password="{word}";'
        return out


def read_kafka(spark: SparkSession, source: KafkaSource, streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    options = source.options()
    if not streaming:
        options.pop("maxOffsetsPerTrigger")
    return reader.format("kafka").options(**options).load()


def read_envelopes(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of Kafka-shaped rows from parquet files, for replays and tests."""
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def avro_type(spec) -> tuple[T.DataType, bool]:
    """Spark type of an Avro type and whether it may be NULL; unknown types are text."""
    if isinstance(spec, list):
        kinds = [s for s in spec if s != "null"]
        inner, deeper = avro_type(kinds[0]) if len(kinds) == 1 else (T.StringType(), False)
        return inner, deeper or "null" in spec
    if isinstance(spec, str):
        return AVRO_TYPES.get(spec, T.StringType()), False
    kind = spec.get("type")
    logical = spec.get("logicalType", "")
    if logical.startswith("timestamp"):
        return T.TimestampType(), False
    if logical == "date":
        return T.DateType(), False
    if logical == "decimal":
        return T.DecimalType(spec.get("precision", 38), spec.get("scale", 0)), False
    if kind == "array":
        item, nullable = avro_type(spec.get("items", "string"))
        return T.ArrayType(item, nullable), False
    if kind == "map":
        value, nullable = avro_type(spec.get("values", "string"))
        return T.MapType(T.StringType(), value, nullable), False
    if kind == "record":
        return avro_schema(spec), False
    return avro_type(kind) if isinstance(kind, (str, list, dict)) else (T.StringType(), False)


def avro_schema(record: dict) -> T.StructType:
    """StructType of an Avro record."""
    fields = []
    for f in record.get("fields", []):
        kind, nullable = avro_type(f["type"])
        fields.append(T.StructField(f["name"], kind, nullable))
    return T.StructType(fields)


def deserialize_events(
    raw: DataFrame, schema: T.StructType | str | None = None, corrupt_column: str = "_corrupt"
) -> DataFrame:
    """JSON values to columns next to the envelope; text that does not parse is kept in ``_corrupt``.

    Fields are read as nullable, because a message may lack them whatever its schema says.
    """
    schema = schema or EVENT_SCHEMA
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    text = F.col("value").cast("string")
    wide = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    wide = wide.add(corrupt_column, T.StringType(), True)
    data = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column})
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        data.alias("data"),
    ).select("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "data.*")


def with_event_time(df: DataFrame, column: str = "timestamp", delay: str = "10 seconds") -> DataFrame:
    """Watermark on the column if the frame has it; other time types are cast, as Spark requires."""
    if column not in df.columns:
        return df
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withWatermark(column, delay)


def parse_stream(
    raw: DataFrame, schema=None, event_time_column: str = "timestamp", watermark_delay: str = "10 seconds"
) -> DataFrame:
    return with_event_time(deserialize_events(raw, schema), event_time_column, watermark_delay)


def latest_offsets(df: DataFrame, topic="kafka_topic", partition="kafka_partition", offset="kafka_offset", value="value") -> DataFrame:
    """Per topic and partition: messages, first and last offset, last value."""
    return df.groupBy(topic, partition).agg(
        F.count(F.lit(1)).alias("messages"),
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
        F.max_by(value, offset).alias("last_value"),
    )


def topic_totals(offsets: DataFrame, topic: str = "kafka_topic") -> DataFrame:
    return offsets.groupBy(topic).agg(F.sum("messages").alias("messages"))


def newest_message(offsets: DataFrame, topic: str = "kafka_topic", partition: str = "kafka_partition") -> DataFrame:
    """The last message over all topics: highest offset, ties by topic and partition."""
    at = F.struct("last_offset", topic, partition)
    return offsets.agg(
        F.max_by(topic, at).alias(topic),
        F.max_by(partition, at).alias(partition),
        F.max("last_offset").alias("last_offset"),
        F.max_by("last_value", at).alias("last_value"),
    )


def message_id(value: Column | str, fields, offset: Column | str) -> Column:
    """First id field a JSON message has, else its offset."""
    text = F.col(value) if isinstance(value, str) else value
    at = F.col(offset) if isinstance(offset, str) else offset
    return F.coalesce(
        *[F.get_json_object(text, f"$.{f}") for f in as_list(fields)],
        F.concat(F.lit("offset_"), at.cast("string")),
    )


def kafka_payload(df: DataFrame, key: str | None = None, columns=None) -> DataFrame:
    """Rows as ``key, value`` messages with a JSON value; times in ISO form."""
    kept = as_list(columns) or df.columns
    options = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "ignoreNullFields": "false",
    }
    value = F.to_json(F.struct(*kept), options)
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(name.alias("key"), value.alias("value"))


def write_kafka(df: DataFrame, source: KafkaSource, topic: str) -> None:
    """Send a batch of ``key, value`` rows."""
    df.write.format("kafka").options(**source.connection()).option("topic", topic).save()


def tumbling_counts(df: DataFrame, column: str, width: str, by=(), value: str | None = None) -> DataFrame:
    """Events per time window (an addition of this library; works on streams and tables)."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value:
        aggs.append(F.sum(value).alias(f"{value}_sum"))
    grouped = df.groupBy(F.window(column, width).alias("w"), *as_list(by)).agg(*aggs)
    names = [a for a in grouped.columns if a != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), *names)


def drop_repeats(df: DataFrame, keys) -> DataFrame:
    """Stream deduplication inside the watermark (an addition of this library)."""
    return df.dropDuplicatesWithinWatermark(as_list(keys)) if df.isStreaming else df.dropDuplicates(as_list(keys))
