"""Grouped aggregation, group features, profiles, version comparison, drift."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_list, measured, numeric_columns, one_row, present, text_columns
from ..functions.quantiles import group_quantiles, quantiles
from ..functions.skew import HOT_ROWS, attach, group_attach, hot_keys
from ..sources.batch import table_metadata

# Aggregate names and their Spark functions.
AGGREGATES = {
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "stddev": F.stddev_samp,
    "var": F.var_samp,
    "nunique": F.count_distinct,
}


def _one(df: DataFrame, column: str, fn: str, order) -> Column:
    value = measured(df, column)
    if fn in ("first", "last"):
        if not order:
            raise ValueError(f"{fn} needs order_by: rows of a table have no order")
        at = F.when(value.isNotNull(), F.struct(*order))
        return (F.min_by if fn == "first" else F.max_by)(value, at)
    if fn not in AGGREGATES:
        raise ValueError(f"unknown aggregate {fn!r}")
    return AGGREGATES[fn](value)


def aggregate(
    df: DataFrame,
    group_columns,
    aggregations: dict[str, list[str]],
    order_by=None,
    drop_null_keys: bool = False,
    hot_rows: int | None = HOT_ROWS // 4,
) -> DataFrame:
    """Grouped aggregation with columns named ``{column}_{function}``.

    NaN counts as missing. All functions but the median combine on the map side. Medians are exact: groups too large for
    one buffer are ranked by counted values instead. Distinct values are counted in two steps, apart from the rest: inside
    one aggregate every distinct value would carry the buffers of all others through the shuffle.
    """
    keys, order = as_list(group_columns), as_list(order_by)
    if drop_null_keys:
        df = df.dropna(subset=keys)
    plain, medians, distinct, names = [], {}, {}, list(keys)
    for column, fns in aggregations.items():
        for fn in as_list(fns):
            name = f"{column}_{fn}"
            names.append(name)
            if fn == "median":
                medians[column] = {name: 0.5}
            elif fn == "nunique":
                distinct[column] = name
            else:
                plain.append(_one(df, column, fn, order).alias(name))
    parts = [df.groupBy(*keys).agg(*plain)] if plain else []
    if medians:
        parts.append(group_quantiles(df, keys, medians, hot_rows))
    for column, name in distinct.items():
        values = df.select(*keys, measured(df, column).alias("__v")).distinct()
        parts.append(values.groupBy(*keys).agg(F.count("__v").alias(name)))
    out = parts[0]
    for part in parts[1:]:  # one row per group on either side
        out = attach(out, part, keys, hot_keys(out, keys, None))
    return out.select(*names)


def group_features(
    df: DataFrame, group_columns, value_columns, aggregations=("mean", "sum", "count"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left join every row to the statistics of its group, as ``{column}_grp_{function}``.

    Aggregate first, join second: a window over the group would sort all of its rows in one task.
    """
    keys = as_list(group_columns)
    stats = df.groupBy(*keys).agg(
        *[
            AGGREGATES[fn](measured(df, c)).alias(f"{c}_grp_{fn}")
            for c in as_list(value_columns)
            for fn in as_list(aggregations)
            if fn in AGGREGATES
        ]
    )
    return group_attach(df, stats, keys, hot_rows)


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Share of each value among the non-NULL values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", (F.col("n") / total).alias("frequency"))


def distinct_count(df: DataFrame, columns, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, as one row.

    Each column is counted in two steps by a subquery of its own that reads that column only; one aggregate for several
    would send every row through the shuffle once per column. ``approx`` needs one pass (see ``states`` for counts that merge).
    """
    names = as_list(columns)
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"{c}_distinct") for c in names])
    counts = [df.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar() for c in names]
    return df.sparkSession.range(1).select(*[n.alias(f"{c}_distinct") for n, c in zip(counts, names, strict=True)])


def _rows_per_column(row: DataFrame, columns, fields: list[str]) -> DataFrame:
    """One wide aggregate row to one row per column; values sit in ``{column}__{field}``."""
    items = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields])
        for c in columns
    ]
    return row.select(F.inline(F.array(*items)))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column, from one aggregate."""
    total = F.count(F.lit(1))
    aggs = []
    for c in df.columns:
        empty = F.count_if(F.col(c).isNull())
        aggs += [
            empty.alias(f"{c}__null_count"),
            F.round(F.try_divide(empty * 100.0, total), 2).alias(f"{c}__null_pct"),
        ]
    return _rows_per_column(df.agg(*aggs), df.columns, ["null_count", "null_pct"])


def adjusted_skewness(col: Column) -> Column:
    """Bias-adjusted sample skewness; NULL below three values."""
    n = F.count(col).cast("double")
    return F.when(n > 2, F.skewness(col) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(col: Column) -> Column:
    """Bias-adjusted excess kurtosis; NULL below four values."""
    n = F.count(col).cast("double")
    return F.when(
        n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col) + 6)
    )


def numeric_profile(df: DataFrame, columns=None, digits: int = 4, approx: bool = False) -> DataFrame:
    """Mean, deviation, range, median, skewness and kurtosis per numeric column."""
    names = present(df, columns) or numeric_columns(df)
    medians = quantiles(df, {c: [0.5] for c in names}, approx=approx)
    aggs = []
    for c in names:
        x = measured(df, c).cast("double")
        for field, value in [
            ("mean", F.avg(x)),
            ("std", F.stddev_samp(x)),
            ("min", F.min(x)),
            ("max", F.max(x)),
            ("median", F.max(F.lit(medians[c][0]).cast("double"))),
            ("skewness", adjusted_skewness(x)),
            ("kurtosis", adjusted_kurtosis(x)),
        ]:
            aggs.append(F.round(value, digits).alias(f"{c}__{field}"))
    return _rows_per_column(
        df.agg(*aggs), names, ["mean", "std", "min", "max", "median", "skewness", "kurtosis"]
    )


def categorical_profile(df: DataFrame, columns=None, top: int = 5) -> DataFrame:
    """Distinct count and the most frequent values per text column, one row per kept value.

    Values are counted before anything is ranked; the ranking keeps ``top`` rows per input
    partition (window group limit), so a column with very many values is not gathered.
    """
    names = present(df, columns) or text_columns(df)
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in names]))
    ).filter(F.col("value").isNotNull())
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    sizes = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("unique_count"))
    sizes = F.broadcast(sizes.withColumnRenamed("column_name", "__c"))  # one row per column
    return best.join(sizes, F.col("column_name") == F.col("__c")).drop("__c")


def data_profile(df: DataFrame, top: int = 5, approx: bool = False) -> DataFrame:
    """The whole profile as ``column_name, section, field, value`` rows (values as text)."""
    def fact(column, section: str, field: str, value: Column) -> Column:
        return F.struct(
            F.lit(column).cast("string").alias("column_name"), F.lit(section).alias("section"),
            F.lit(field).alias("field"), value.cast("string").alias("value"),
        )

    facts = [fact(None, "shape", "rows", F.col("rows")), fact(None, "shape", "columns", F.lit(len(df.columns)))]
    facts += [fact(f.name, "dtype", "type", F.lit(f.dataType.simpleString())) for f in df.schema]
    shape = df.agg(F.count(F.lit(1)).alias("rows"))
    parts = [shape.select(F.inline(F.array(*facts)))]
    try:
        size = table_metadata(df)
        parts.append(size.select(F.inline(F.array(fact(None, "shape", "bytes", F.col("size_bytes"))))))
    except AnalysisException:
        pass  # not read from files

    def long(frame: DataFrame, section: str, fields: list[str]) -> DataFrame:
        items = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
        return frame.select("column_name", F.lit(section).alias("section"), F.inline(F.array(*items)))

    parts.append(long(null_profile(df), "nulls", ["null_count", "null_pct"]))
    if numeric_columns(df):
        parts.append(
            long(
                numeric_profile(df, approx=approx), "numeric",
                ["mean", "std", "min", "max", "median", "skewness", "kurtosis"],
            )
        )
    if text_columns(df):
        cats = categorical_profile(df, top=top)
        parts.append(
            cats.select(
                "column_name", F.lit("top_values").alias("section"), F.col("value").alias("field"),
                F.col("n").cast("string").alias("value"),
            )
        )
        parts.append(long(cats.filter("rank = 1"), "categorical", ["unique_count"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def correlation_with_target(df: DataFrame, target: str, columns=None) -> DataFrame:
    """Pearson correlation of every numeric column with the target, from one aggregate."""
    names = [c for c in (present(df, columns) or numeric_columns(df)) if c != target]
    y = measured(df, target).cast("double")
    row = df.agg(*[_corr(measured(df, c).cast("double"), y).alias(f"{c}__correlation") for c in names])
    return _rows_per_column(row, names, ["correlation"])


def _corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows that have both values; NULL for a constant column, where
    ``corr`` divides by zero under ANSI."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def variances(df: DataFrame, columns=None) -> DataFrame:
    names = present(df, columns) or numeric_columns(df)
    row = df.agg(*[F.var_samp(measured(df, c).cast("double")).alias(f"{c}__variance") for c in names])
    return _rows_per_column(row, names, ["variance"])


def version_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per column of either version: where it exists, how mean and deviation moved,
    and the row counts of both. One aggregate per version."""
    shared = [c for c in numeric_columns(a) if c in b.columns]
    names = list(dict.fromkeys(a.columns + b.columns))

    def stats(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias(f"rows_{tag}"),
            *[F.avg(measured(df, c).cast("double")).alias(f"{c}__mean_{tag}") for c in shared if c in df.columns],
            *[F.stddev_samp(measured(df, c).cast("double")).alias(f"{c}__std_{tag}") for c in shared],
        )

    both = stats(a, "a").select("*", one_row(stats(b, "b")).alias("__b")).select("*", "__b.*")
    items = []
    for c in names:
        status = "common" if c in a.columns and c in b.columns else "added" if c in b.columns else "removed"
        known = c in shared
        items.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(status).alias("status"),
                F.col("rows_a"),
                F.col("rows_b"),
                (F.col("rows_b") - F.col("rows_a")).alias("row_diff"),
                (
                    F.col(f"`{c}__mean_b`") - F.col(f"`{c}__mean_a`") if known else F.lit(None).cast("double")
                ).alias("mean_diff"),
                (
                    F.col(f"`{c}__std_b`") - F.col(f"`{c}__std_a`") if known else F.lit(None).cast("double")
                ).alias("std_diff"),
            )
        )
    return both.select(F.inline(F.array(*items)))


def drift_report(
    df: DataFrame, batch: Column, columns, baseline, batch_name: str = "batch"
) -> DataFrame:
    """Mean shift per batch and column against the baseline batch, in baseline deviations."""
    columns = as_list(columns)
    grouped = df.groupBy(batch.alias(batch_name)).agg(
        *[F.avg(measured(df, c)).alias(f"{c}__mean") for c in columns],
        *[F.stddev_samp(measured(df, c)).alias(f"{c}__std") for c in columns],
    )
    items = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns
    ]
    stats = grouped.select(batch_name, F.inline(F.array(*items)))
    base = stats.filter(F.col(batch_name) == baseline).select(
        F.col("column_name").alias("__c"), F.col("mean").alias("base_mean"), F.col("std").alias("base_std")
    )
    return (
        stats.join(F.broadcast(base), F.col("column_name") == F.col("__c"), "left")  # one row per column
        .drop("__c")
        .withColumn("mean_shift", F.try_divide(F.col("mean") - F.col("base_mean"), F.col("base_std")))
        .withColumn("std_ratio", F.try_divide(F.col("std"), F.col("base_std")))
    )
