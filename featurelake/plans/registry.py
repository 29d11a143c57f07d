"""Registry of runnable queries and of the ANSI SQL each is checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name; ``sql`` is its equivalent over the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint area, for queries about sinks and stores."""
    return f"{checkpoint_dir(spark).rstrip('/')}/featurelake/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with some values and types missing; the star tables hold no NULLs of their own."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


SPARSE_SQL = """sparse AS (
  SELECT event_id, ts, user_id,
    CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 7 <> 0 THEN value END AS value
  FROM events)"""
