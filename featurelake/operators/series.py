"""Ordered work per entity: rolling windows, lags, carried values, running totals.

A plain window puts a whole entity in one task. Where some entity has too many rows, the frame is laid out by range
partitions of (entity, order) instead (``functions.ranges``): a series then lies in as many partitions as its rows need,
whatever the types of its order columns, and its rows in one partition are a piece, a window partition of its own.
What has to cross a border travels as rows put in front of (or behind) a piece, and taken out again:

* ``windowed``       the last ``reach`` rows before the piece,
* ``carry_last``     one row with the last non-NULL values before the piece,
* ``running_total``  one row with the sums of all earlier pieces.

Only the first and the last entity of a partition can cross a border, so these rows come from a table of at most two
rows per partition. Frames without hot entities keep the plain one-shuffle plan. Ties of the order are broken
arbitrarily, as in any SQL window, but in one way for all that reads the layout.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import all_of, as_list
from ..functions.ranges import AT, laid_out, part_of
from ..functions.skew import HOT_ROWS, HotKeys, hot_keys

PIECE, HALO = "__piece", "__halo"
BEFORE, AFTER = -1, (1 << 63) - 1  # places in front of and behind all rows


def cut_series(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys) -> DataFrame:
    """The rows with their place and piece; a partition holds about as many rows as a hot key may have."""
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(hot.rows / hot.piece))
    return laid_out(df, [*keys, *order], AT, partitions).withColumn(PIECE, part_of())


def crossing_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the pieces of series that lie in several partitions."""
    names = [f"__edge_{i}" for i in range(len(keys))]
    key = F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    ends = rows.groupBy(PIECE).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ends = ends.select(F.col(PIECE).alias("__edge"), F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    ends = ends.select("__edge", "key.*").withColumn("__pieces", F.count(F.lit(1)).over(Window.partitionBy(*names)))
    edges = F.broadcast(ends.filter("__pieces > 1"))  # at most two rows per partition
    here = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return rows.join(edges, all_of([F.col(PIECE) == F.col("__edge"), *here]), "left_semi")


def piece_window(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys, PIECE).orderBy(AT)


def with_halo(rows: DataFrame, halo: DataFrame) -> DataFrame:
    rows = rows.withColumn(HALO, F.lit(False))
    return rows.unionByName(halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True)


def without_halo(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col(HALO)).drop(HALO, PIECE, AT)


def windowed(
    df: DataFrame,
    keys,
    order,
    reach: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    needs,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``build(window)`` columns that look back at most ``reach`` rows.

    ``needs`` are the columns the expressions read; only those are copied across borders.
    """
    keys, order = as_list(keys), as_list(order)
    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    rows = cut_series(df, keys, order, hot)
    if reach <= 0:
        return rows.withColumns(build(piece_window(keys))).drop(PIECE, AT)
    carried = [AT, *[n for n in dict.fromkeys(as_list(needs)) if n not in keys]]
    newest = Window.partitionBy(*keys, PIECE).orderBy(F.col(AT).desc())
    tails = (
        crossing_rows(rows, keys)
        .select(*keys, PIECE, *carried)
        .withColumn("__back", F.row_number().over(newest))
        .filter(F.col("__back") <= reach)
        .groupBy(*keys, PIECE)
        .agg(F.sort_array(F.collect_list(F.struct(*carried))).alias("__tail"))
    )
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(-reach, -1)
    earlier = F.slice(F.reverse(F.flatten(F.collect_list("__tail").over(before))), 1, reach)
    halo = tails.select(*keys, PIECE, earlier.alias("__earlier")).select(*keys, PIECE, F.inline("__earlier"))
    return without_halo(with_halo(rows, halo).withColumns(build(piece_window(keys))))


def carry_last(
    df: DataFrame, keys, order, targets: dict[str, str], hot_rows: int | None = HOT_ROWS,
    backward: bool = False, hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``{new: source}``: the last non-NULL source value up to and including each row.

    ``backward`` takes the next value instead. ``hot`` are the known hot keys of the series.
    """
    keys, order = as_list(keys), as_list(order)
    pick = F.first if backward else F.last
    span = (Window.currentRow, Window.unboundedFollowing) if backward else (
        Window.unboundedPreceding, Window.currentRow)
    hot = hot or hot_keys(df, keys, hot_rows)

    def filled(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({new: pick(src, ignorenulls=True).over(w.rowsBetween(*span)) for new, src in targets.items()})

    if not hot:
        return filled(df, Window.partitionBy(*keys).orderBy(*order))
    rows, sources = cut_series(df, keys, order, hot), list(dict.fromkeys(targets.values()))
    best = F.min_by if backward else F.max_by
    ends = crossing_rows(rows, keys).groupBy(*keys, PIECE).agg(
        *[best(src, F.when(F.col(src).isNotNull(), F.col(AT))).alias(src) for src in sources])
    others = Window.partitionBy(*keys).orderBy(PIECE)
    others = others.rowsBetween(1, Window.unboundedFollowing) if backward else others.rowsBetween(
        Window.unboundedPreceding, -1)
    halo = ends.select(
        *keys, PIECE, F.lit(AFTER if backward else BEFORE).cast("long").alias(AT),
        *[pick(src, ignorenulls=True).over(others).alias(src) for src in sources])
    return without_halo(filled(with_halo(rows, halo), piece_window(keys)))


def running_total(
    df: DataFrame, keys, order, sums: dict[str, str], totals: dict[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add inclusive running sums ``{new: source}`` and whole-series sums ``totals``."""
    keys, order = as_list(keys), as_list(order)
    totals = totals or {}
    hot = hot_keys(df, keys, hot_rows)
    span = (Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    plain = df.withColumns(
        {new: F.sum(src).over(whole.orderBy(*order).rowsBetween(*span)) for new, src in sums.items()}
        | {new: F.sum(src).over(whole) for new, src in totals.items()}
    )
    if not hot:
        return plain
    every = {**sums, **totals}
    kinds = {new: plain.schema[new].dataType for new in every}
    rows = cut_series(df, keys, order, hot).withColumns({f"__add_{n}": F.col(s).cast(kinds[n]) for n, s in every.items()})
    ends = crossing_rows(rows, keys).groupBy(*keys, PIECE).agg(*[F.sum(f"__add_{n}").alias(f"__add_{n}") for n in every])
    ordered = whole.orderBy(PIECE)
    earlier, later = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(1, Window.unboundedFollowing)

    def others(c: str) -> Column:
        before, after = F.sum(c).over(earlier), F.sum(c).over(later)
        return F.coalesce(before + after, before, after)

    halo = ends.select(
        *keys, PIECE, F.lit(BEFORE).cast("long").alias(AT),
        *[F.sum(f"__add_{n}").over(earlier).cast(kinds[n]).alias(f"__add_{n}") for n in sums],
        *[others(f"__add_{n}").cast(kinds[n]).alias(f"__add_{n}") for n in totals])
    here = Window.partitionBy(*keys, PIECE)
    out = with_halo(rows, halo).withColumns(
        {n: F.sum(f"__add_{n}").over(here.orderBy(AT).rowsBetween(*span)).cast(kinds[n]) for n in sums}
        | {n: F.sum(f"__add_{n}").over(here).cast(kinds[n]) for n in totals})
    return without_halo(out).drop(*[f"__add_{n}" for n in every])
