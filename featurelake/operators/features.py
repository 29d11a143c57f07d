"""Rolling, lag and difference features, ranking, top-k, feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_list, measured, numeric_columns, text_columns
from ..functions.skew import HOT_ROWS
from .aggregate import correlation_with_target, variances
from .series import windowed

ROLLING = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev_samp,
    "count": F.count,
}


def rolling_features(
    df: DataFrame,
    partition_columns,
    order_column,
    value_columns,
    window_sizes,
    aggregations=("mean", "stddev", "min", "max"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``{column}_w{n}_{function}`` over the current row and the n-1 rows before it.

    NaN counts as missing. All frames share one partitioning and order, so Spark sorts once whatever their number.
    """
    sizes = [window_sizes] if isinstance(window_sizes, int) else list(window_sizes)
    values = as_list(value_columns)
    fns = ["stddev" if a == "std" else a for a in as_list(aggregations)]

    def build(w):
        return {
            f"{c}_w{n}_{fn}": ROLLING[fn](measured(df, c)).over(w.rowsBetween(-(n - 1), 0))
            for n in sizes
            for c in values
            for fn in fns
            if fn in ROLLING
        }

    return windowed(df, partition_columns, order_column, max(sizes) - 1, build, values, hot_rows)


def lag_features(
    df: DataFrame,
    partition_columns,
    order_column,
    value_columns,
    lag_sizes,
    with_diff: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``{column}_lag_{k}`` and ``{column}_diff_{k}``."""
    lags = [lag_sizes] if isinstance(lag_sizes, int) else list(lag_sizes)
    values = as_list(value_columns)

    def build(w):
        out = {}
        for c in values:
            for k in lags:
                back = F.lag(c, k).over(w)
                out[f"{c}_lag_{k}"] = back
                if with_diff:
                    out[f"{c}_diff_{k}"] = F.col(c) - back
        return out

    return windowed(df, partition_columns, order_column, max(lags), build, values, hot_rows)


def last_observation(df: DataFrame, keys, order, value: str, alias: str | None = None) -> DataFrame:
    """Most recent value per series, by partial aggregation."""
    at = F.struct(*as_list(order))
    return df.groupBy(*as_list(keys)).agg(F.max_by(value, at).alias(alias or f"{value}_last"))


def sort_series(df: DataFrame, partition_columns, order_column, globally: bool = True) -> DataFrame:
    """Sorted by series and order; ``globally=False`` only sorts inside partitions that hold
    whole ranges of series, which is enough to write them out ordered."""
    cols = as_list(partition_columns) + as_list(order_column)
    if globally:
        return df.orderBy(*cols)
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """Most frequent values; equal counts in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(n)


def latest_rows(df: DataFrame, order_column, n: int = 50, where=None) -> DataFrame:
    """Newest n rows, optionally of one user (``where``)."""
    kept = df if where is None else df.filter(where)
    return kept.orderBy(*[F.col(o).desc() for o in as_list(order_column)]).limit(n)


def latest_per_key(df: DataFrame, keys, order_column, n: int) -> DataFrame:
    """Newest n rows of each key; each input partition keeps at most n per key before the shuffle."""
    w = Window.partitionBy(*as_list(keys)).orderBy(*[F.col(o).desc() for o in as_list(order_column)])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def row_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows added, removed and common between two versions, as a multiset, labelled in ``change``.

    One pass: rows of both versions are counted per side by one shuffle.
    """
    columns = a.columns
    sided = a.withColumns({"__a": F.lit(1), "__b": F.lit(0)}).unionByName(
        b.select(*columns).withColumns({"__a": F.lit(0), "__b": F.lit(1)})
    )
    counts = sided.groupBy(*columns).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    parts = F.array(
        F.struct(F.lit("removed").alias("change"), F.greatest(F.col("__a") - F.col("__b"), F.lit(0)).alias("copies")),
        F.struct(F.lit("added").alias("change"), F.greatest(F.col("__b") - F.col("__a"), F.lit(0)).alias("copies")),
        F.struct(F.lit("common").alias("change"), F.least("__a", "__b").alias("copies")),
    )
    return counts.select(*columns, F.inline(parts)).filter(F.col("copies") > 0)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def score_features(df: DataFrame, target: str, method: str, exclude=()) -> DataFrame:
    """``column_name, score`` of every candidate: absolute correlation or variance."""
    names = numeric_columns(df, exclude=[target, *exclude])
    if method == "correlation":
        scored = correlation_with_target(df, target, names)
        return scored.select("column_name", F.abs("correlation").alias("score"))
    return variances(df, names).select("column_name", F.col("variance").alias("score"))


def select_features(
    df: DataFrame,
    target_column: str,
    method: str = "correlation",
    top_k: int = 20,
    threshold: float = 0.01,
    exclude=(),
) -> tuple[DataFrame, list[str]]:
    """Best candidates by correlation or variance; any other method takes the first k.

    Text and other non-numeric columns, excluded columns and the target are kept.
    """
    names = numeric_columns(df, exclude=[target_column, *exclude])
    if method in ("correlation", "variance"):
        rows = (
            score_features(df, target_column, method, exclude)
            .filter(F.col("score") >= threshold)
            .orderBy(F.desc("score"), "column_name")
            .limit(top_k)
            .collect()  # one row per chosen column
        )
        chosen = [r["column_name"] for r in rows]
    else:
        chosen = names[:top_k]
    kept = [c for c in df.columns if c not in names and c != target_column]
    return df.select(*kept, *chosen, target_column), chosen


__all__ = [
    "distinct_values", "lag_features", "last_observation", "latest_per_key", "latest_rows",
    "rolling_features", "row_set_diff", "score_features", "select_features", "sort_series",
    "text_columns", "top_values",
]
