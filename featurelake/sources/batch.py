"""Batch reads: pruned scans, partition filters, incremental loads, schema enforcement, metadata."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_list, present
from ..session import checkpoint_dir


def read_table(
    spark: SparkSession, path: str, columns=None, filter_condition: str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """Scan with filter and column pruning, both of which reach the file reader.

    The filter comes first, so it may use columns that are not selected.
    """
    df = spark.read.format(fmt).options(**options).load(path)
    if filter_condition:
        df = df.filter(filter_condition)
    return df.select(*as_list(columns)) if columns else df


def partition_filter(column: str, wanted) -> Column:
    """List means membership, pair means inclusive range, anything else equality."""
    c = F.col(column)
    if isinstance(wanted, (list, set, frozenset)):
        return c.isin(list(wanted))
    if isinstance(wanted, tuple):
        if len(wanted) != 2:
            raise ValueError(f"a range needs two bounds: {wanted!r}")
        return c.between(*wanted)
    return c == wanted


def read_partitioned(spark: SparkSession, path: str, partition_filters: dict, columns=None, fmt: str = "parquet") -> DataFrame:
    """Read only the matching partition directories."""
    df = spark.read.format(fmt).load(path)
    for column, wanted in partition_filters.items():
        df = df.filter(partition_filter(column, wanted))
    return df.select(*as_list(columns)) if columns else df


def cutoff_for(last_loaded_at: datetime, lookback_hours: float = 0) -> datetime:
    return last_loaded_at - timedelta(hours=lookback_hours)


def incremental_load(
    source: DataFrame, timestamp_column: str, last_loaded_at, lookback_hours: float = 0, columns=None
) -> DataFrame:
    """Rows at or after ``last_loaded_at - lookback``; the cutoff is a literal, so it is pushed down."""
    if last_loaded_at is None:
        raise ValueError("last_loaded_at is required; pass an explicit time for the first load")
    if isinstance(last_loaded_at, str):
        last_loaded_at = datetime.fromisoformat(last_loaded_at)
    cutoff = F.lit(cutoff_for(last_loaded_at, lookback_hours).isoformat(" ")).cast(
        source.schema[timestamp_column].dataType
    )
    df = source.filter(F.col(timestamp_column) >= cutoff)
    return df.select(*as_list(columns)) if columns else df


def enforce_schema(df: DataFrame, expected: T.StructType, strict: bool = False) -> DataFrame:
    """Expected columns in expected order and type; extras dropped.

    Strict: a missing column or another type raises. Otherwise missing columns are NULL and other
    types are cast, failures giving NULL.
    """
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in expected if f.name not in have]
    differ = [f.name for f in expected if f.name in have and have[f.name] != f.dataType]
    if strict and (missing or differ):
        raise ValueError(f"schema mismatch: missing {missing}, other type {differ}")
    out = []
    for f in expected:
        if f.name in missing:
            col = F.lit(None).cast(f.dataType)
        elif f.name in differ:
            col = F.col(f.name).try_cast(f.dataType)
        else:
            col = F.col(f.name)
        out.append(col.alias(f.name))
    return df.select(*out)


def table_metadata(df: DataFrame, rows: bool = False) -> DataFrame:
    """Files and bytes behind a file-based frame, as one row, and with ``rows`` its row count.

    From the files' metadata columns: a scan of the footers that reads no data column, and is combined per file where it
    runs. Files without rows are not seen. A frame that is not read from files raises.
    """
    per_file = df.groupBy(F.col("_metadata.file_path")).agg(F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    facts = [F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes")]
    return per_file.agg(*facts, *([F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")] if rows else []))


UNION = "spark.sql.unionOutputPartitioning"


def write_files(df: DataFrame, path: str, files: int) -> None:
    """The frame written as so many parquet files (fewer if it has fewer rows).

    One task writes a file, so it reads its share of the rows. They are dealt to compressed column files by the tasks that
    make them, of which a share takes far fewer bytes than as rows of a shuffle.
    """
    spark, dealt = df.sparkSession, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/dealt-{uuid.uuid4().hex}"
    share = F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
    df.withColumn("__file", share).write.partitionBy("__file").option("compression", "zstd").parquet(dealt)
    rows = spark.read.schema(T.StructType([*df.schema, T.StructField("__file", T.IntegerType())])).parquet(dealt)
    shares = [rows.filter(F.col("__file") == i).drop("__file").coalesce(1) for i in range(files)]
    plain = spark.conf.get(UNION, "true")
    spark.conf.set(UNION, "false")  # else a union of single partitions is one partition
    try:
        reduce(DataFrame.union, shares).write.parquet(path)
    finally:
        spark.conf.set(UNION, plain)


def column_types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


AUDIT = "path string, operation string, record_count bigint, loaded_at timestamp, details map<string,string>"


def write_audited(
    df: DataFrame, path: str, audit_path: str, mode: str = "append", partition_columns=None, source: str | None = None
) -> int:
    """Write the frame as one load and append one audit row.

    Every load is a ``_load`` partition of its own, so its rows are counted from the footers of its
    own files, without another run of ``df`` and without reading earlier loads.
    """
    load = f"load-{uuid.uuid4().hex}"
    parts = ["_load", *as_list(partition_columns)]
    df.withColumn("_load", F.lit(load)).write.mode(mode).partitionBy(*parts).parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/_load={load}").count()
    append_audit(df.sparkSession, audit_path, path, mode, rows, {"source": source or "", "load": load})
    return rows


def append_audit(spark: SparkSession, audit_path: str, path: str, operation: str, rows: int, details: dict | None = None):
    row = (path, operation, rows, datetime.now(timezone.utc), {k: str(v) for k, v in (details or {}).items()})
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(audit_path)


__all__ = [
    "append_audit", "column_types", "cutoff_for", "enforce_schema", "incremental_load", "partition_filter",
    "present", "read_partitioned", "read_table", "table_metadata", "write_audited", "write_files",
]
