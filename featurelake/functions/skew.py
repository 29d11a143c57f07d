"""Hot keys: find them with two bounded jobs, spread them over many tasks.

A key is hot when it owns more rows than one task should sort (``hot_rows``). Rows are first counted per hash bucket of
the key, in BUCKETS counters that every task combines by itself; only keys of heavy buckets are then counted one by one.
So even keys cost one job that shuffles counters, never the keys.

What is collected or broadcast is bounded by the share of the rows that a hot key owns at least: one in SHARES, or
``hot_rows`` if that is more, so there are at most SHARES of them. A key below that is smaller than the pieces that hot
keys are cut into. No row is ever dropped, and results do not depend on which keys are split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import as_list, same_keys

HOT_ROWS = 2_000_000
BUCKETS = 1 << 16
SHARES = 1 << 14


# Profiles by plan, keys and threshold, so that several features over one frame count its keys once.
# A profile that has grown old costs speed only: results do not depend on which keys are split.
_PROFILES: dict = {}


@dataclass
class HotKeys:
    """Hot keys of a frame, with the number of pieces each is cut into; ``rows`` of the whole frame."""

    names: list[str]
    frame: DataFrame | None
    largest: int = 0
    rows: int = 0
    piece: int = HOT_ROWS

    def __bool__(self) -> bool:
        return self.frame is not None


def hot_keys(df: DataFrame, names, hot_rows: int | None = HOT_ROWS) -> HotKeys:
    """The keys that own more rows than ``hot_rows`` and one in SHARES of all.

    ``hot_rows=None`` skips the job, for callers that know their keys are even.
    """
    names = as_list(names)
    if hot_rows is None:
        return HotKeys(names, None)
    known = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(names), hot_rows)
    if known not in _PROFILES:
        if len(_PROFILES) >= 512:
            _PROFILES.pop(next(iter(_PROFILES)))
        _PROFILES[known] = _heavy(df, names, hot_rows)
    rows, total = _PROFILES[known]
    return _cut(df, names, rows, total, hot_rows)


def hot_of(counts: DataFrame, names, count: str, hot_rows: int = HOT_ROWS) -> HotKeys:
    """The same from a table that has the rows of each key already."""
    names = as_list(names)
    total = counts.agg(F.sum(count)).first()[0] or 0
    heavy = counts.filter(F.col(count) > _least(total, hot_rows)).select(*names, F.col(count).alias("__n"))
    return _cut(counts, names, heavy.collect(), total, hot_rows)  # at most SHARES rows


def _least(total: int, hot_rows: int) -> int:
    return max(hot_rows, total // SHARES)


def _cut(df: DataFrame, names: list[str], rows: list, total: int, hot_rows: int) -> HotKeys:
    if not rows:
        return HotKeys(names, None, rows=total, piece=hot_rows)
    piece = _least(total, hot_rows)
    schema = T.StructType(
        [T.StructField(n, df.schema[n].dataType) for n in names]
        + [T.StructField("__splits", T.IntegerType())]
    )
    data = [tuple(r[n] for n in names) + (max(2, math.ceil(r["__n"] / piece)),) for r in rows]
    return HotKeys(names, df.sparkSession.createDataFrame(data, schema), max(r["__n"] for r in rows), total, hot_rows)


def _heavy(df: DataFrame, names: list[str], hot_rows: int) -> tuple[list, int]:
    """(hot keys with their rows, rows of all keys)."""
    bucket = F.pmod(F.xxhash64(*names), F.lit(BUCKETS)).cast("int")
    counts = df.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    large = F.collect_list(F.when(F.col("__n") > hot_rows, F.struct("__n", "__bucket")))  # at most BUCKETS numbers
    total, large = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)), large).first()
    least = _least(total, hot_rows)
    heavy = [(r["__bucket"],) for r in large if r["__n"] > least]
    if not heavy:
        return [], total
    small = F.broadcast(df.sparkSession.createDataFrame(heavy, "__heavy int"))  # at most SHARES numbers
    keys = df.select(*names).join(small, bucket == F.col("__heavy"), "left_semi")
    found = keys.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > least)
    return found.collect(), total  # at most SHARES rows


def spread(columns) -> Column:
    """A number that differs between rows, and between equal rows of different input partitions.

    Copies of one row hash alike, so the input partition is mixed in. Both parts stay the same
    when a task is run again, unlike a random number.
    """
    return F.xxhash64(F.spark_partition_id(), *columns)


def hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema if not _holds_map(f.dataType)]


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def attach(
    df: DataFrame,
    other: DataFrame,
    names,
    hot: HotKeys,
    how: str = "left",
    null_safe: bool = True,
) -> DataFrame:
    """Join ``other`` on like-named keys, which come out once; hot keys of ``df`` are salted.

    ``how`` is inner or left. Rows of ``other`` with a hot key are repeated once per piece
    of it, as many as its rows need; all other rows go through one plain equi join.
    """
    names = as_list(names)
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be salted")
    renamed = {n: f"__key_{n}" for n in names}
    other = other.withColumnsRenamed(renamed)

    def matches(left: DataFrame, right: DataFrame) -> list[Column]:
        pairs = [(left[n], right[renamed[n]]) for n in names]
        return [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]

    if not hot:
        condition = matches(df, other)
        out = df.join(other, _and(condition), how)
        return out.drop(*renamed.values())
    small = F.broadcast(hot.frame.withColumnsRenamed({n: f"__hot_{n}" for n in names}))
    left = df.join(small, _and([df[n].eqNullSafe(small[f"__hot_{n}"]) for n in names]), "left")
    left = left.withColumn(
        "__salt",
        F.when(
            F.col("__splits").isNotNull(), F.pmod(spread(hashable(df)), F.col("__splits")).cast("int")
        ).otherwise(0),
    ).drop("__splits", *[f"__hot_{n}" for n in names])
    right = other.join(
        small, _and([other[renamed[n]].eqNullSafe(small[f"__hot_{n}"]) for n in names]), "left"
    )
    right = right.withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__splits"), F.lit(1)) - 1))
    ).drop("__splits", *[f"__hot_{n}" for n in names])
    out = left.join(right, _and(matches(left, right) + [left["__salt"] == right["__copy"]]), how)
    return out.drop("__salt", "__copy", *renamed.values())


def _and(conditions) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def group_attach(df: DataFrame, stats: DataFrame, names, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Left join per-group values back to the rows of ``df``, safe for hot groups."""
    return attach(df, stats, names, hot_keys(df, names, hot_rows), "left", null_safe=True)


__all__ = ["HOT_ROWS", "HotKeys", "attach", "group_attach", "hot_keys", "hot_of", "same_keys", "spread"]
