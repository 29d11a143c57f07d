"""Rows laid out along an order: ranges of equal size whatever the keys, with places and ranks.

A range partition holds consecutive rows of the whole order, so a series of any length is dealt over as many
partitions as its rows need, with bounds that Spark samples from the data: no key is looked up, and text, decimals and
times are cut alike. The layout is written to the shared folder, because bounds sampled anew would differ between two
readers of the same plan, and so that lost executors cost nothing but a reread.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, cut_lineage
from .columns import all_of
from .skew import hashable, spread

AT = "__at"
PART_BITS = 33  # of monotonically_increasing_id: the partition stands above the row number


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the folder that all executors share."""
    spark = df.sparkSession
    if any(isinstance(f.dataType, (T.NullType, T.CalendarIntervalType)) for f in df.schema):
        return cut_lineage(df)  # kinds that no file format holds
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def laid_out(df: DataFrame, columns, at: str = AT, partitions: int | None = None) -> DataFrame:
    """The rows, range-partitioned by ``columns`` and written in that order, with a place ``at`` that grows along it.

    Rows equal in all columns are dealt over partitions too; their order among themselves is arbitrary, but fixed once
    written. NULLs come first. ``columns`` are names or sort expressions.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in columns]
    tie = spread(hashable(df))
    dealt = df.withColumn("__tie", tie)
    order = [*by, F.col("__tie")]
    dealt = dealt.repartitionByRange(partitions, *order) if partitions else dealt.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()).drop("__tie")
    return written(placed, "layout")


def part_of(at: str = AT) -> Column:
    """The range partition that a place lies in."""
    return F.shiftright(at, PART_BITS)


def ranked(df: DataFrame, by, order, rank: str = "rank", size: str = "size") -> DataFrame:
    """Add the rank of each row within its group, from 0, and the rows of the group; one range shuffle.

    A rank is the row's number within its range partition plus the rows of the group in earlier partitions, which a
    table of one row per group and partition knows. Groups of any size are ranked in parallel; NULL keys are a group.
    """
    by = list(by)
    laid = laid_out(df, [*by, *order]).withColumn("__part", part_of())
    runs = laid.groupBy(*by, "__part").agg(F.min(AT).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"__run_{k}") for k in by], F.col("__part").alias("__run"),
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias(size))
    same = [F.col(k).eqNullSafe(F.col(f"__run_{k}")) for k in by] + [F.col("__part") == F.col("__run")]
    joined = laid.join(runs, all_of(same), "left").withColumn(rank, F.col(AT) + F.col("__shift"))
    return joined.drop(AT, "__part", "__run", "__shift", *[f"__run_{k}" for k in by])
