"""Projection, predicates, casts, NULL filling, outlier clipping, normalisation.

Operators that learn something from the data come in two parts: ``fit_*`` runs one or two
aggregates and returns plain parameters, ``apply_*`` uses them on any frame (also on test data
and streams). The short form does both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FLOATING, all_of, any_of, as_list, measured, numeric_columns, present
from ..functions.quantiles import quantiles
from ..functions.scalars import clip
from ..functions.skew import HOT_ROWS
from .series import carry_last

# Names of column types accepted by cast_types, with the Spark type of each.
CAST_TYPES = {
    "float": "double",
    "float64": "double",
    "float32": "float",
    "int": "bigint",
    "int64": "bigint",
    "int32": "int",
    "datetime": "timestamp",
    "timestamp": "timestamp",
    "str": "string",
    "string": "string",
    "object": "string",
    "category": "string",
    "bool": "boolean",
    "boolean": "boolean",
}

COMPARE = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
    "not_in": lambda c, v: ~c.isin(list(v)),
    "between": lambda c, v: c.between(v[0], v[1]),
}


def project(df: DataFrame, columns) -> DataFrame:
    """Column subset; unknown names are skipped."""
    return df.select(*present(df, columns))


def filter_sql(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(condition)


def condition_for(column: str, spec) -> Column:
    """``(operator, value)`` or a bare value, which means equality."""
    if isinstance(spec, tuple) and len(spec) == 2:
        op, value = spec
        if op not in COMPARE:
            raise ValueError(f"unknown operator {op!r}; use one of {sorted(COMPARE)}")
        return COMPARE[op](F.col(column), value)
    return F.col(column) == spec


def filter_rows(df: DataFrame, conditions: dict, mode: str = "and") -> DataFrame:
    """Filter by ``{column: (operator, value)}``; unknown columns are skipped, no condition keeps all."""
    masks = [condition_for(c, spec) for c, spec in conditions.items() if c in df.columns]
    if not masks:
        return df
    return df.filter(all_of(masks) if mode == "and" else any_of(masks))


def nan_as_null(df: DataFrame, columns=None) -> DataFrame:
    """NaN to NULL in floating columns, for sources that write missing values as NaN."""
    names = present(df, columns) or [f.name for f in df.schema if isinstance(f.dataType, FLOATING)]
    return df.withColumns({n: measured(df, n) for n in names}) if names else df


def _try_cast(col: Column, source: T.DataType, target: str) -> Column:
    if target in ("int", "bigint") and isinstance(source, T.StringType):
        number = col.try_cast("double")  # text such as "3.0" is a number first
        return F.coalesce(col.try_cast(target), F.when(number == F.floor(number), number.try_cast(target)))
    return col.try_cast(target)


def cast_types(df: DataFrame, type_mapping: dict[str, str], errors: str = "coerce") -> DataFrame:
    """Cast columns; failures become NULL (coerce), raise, or leave the column as it was (ignore)."""
    names = {c: CAST_TYPES.get(t, t) for c, t in type_mapping.items() if c in df.columns}
    if errors == "raise":
        return df.withColumns({c: F.col(c).cast(t) for c, t in names.items()})
    tried = {c: _try_cast(F.col(c), df.schema[c].dataType, t) for c, t in names.items()}
    if errors == "ignore" and tried:
        lost = df.agg(
            *[F.count_if(F.col(c).isNotNull() & t.isNull()).alias(c) for c, t in tried.items()]
        ).first()
        tried = {c: t for c, t in tried.items() if lost[c] == 0}
    return df.withColumns(tried) if tried else df


def derive_columns(df: DataFrame, derivations: dict) -> DataFrame:
    """Add columns from Columns, SQL text, or functions of the frame that return a Column."""
    out = {}
    for name, rule in derivations.items():
        if isinstance(rule, str):
            out[name] = F.expr(rule)
        else:
            out[name] = rule if isinstance(rule, Column) else rule(df)
    return df.withColumns(out) if out else df


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are NULL in every row (one aggregate over the table)."""
    names = df.columns
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return df.drop(*[c for i, c in enumerate(names) if row[f"n{i}"] == 0])


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def drop_sparse_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Keep rows whose share of NULL values is at most the threshold."""
    if threshold >= 1:
        return df
    empty = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.filter(empty / F.lit(len(df.columns)) <= threshold)


def dedupe(df: DataFrame, subset=None, order_by=None) -> DataFrame:
    """Drop duplicates. With a subset the first row in ``order_by`` order stays (default: all columns).

    Both forms reduce before the shuffle: ``distinct`` by partial aggregation, ``row_number = 1``
    by Spark's per-partition window group limit, so a group with very many copies stays small.
    """
    keys = as_list(subset)
    if not keys:
        return df.distinct()
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = as_list(order_by) or [c for c in sortable if c not in keys] or keys
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def clean_data(
    df: DataFrame,
    drop_duplicates: bool = True,
    subset_for_duplicates=None,
    drop_all_null_rows: bool = True,
    drop_all_null_cols: bool = False,
    null_threshold_row: float = 0.5,
    order_by=None,
    observe=None,
) -> DataFrame:
    """The cleaning steps in order. ``observe=(before, after)`` are names of metrics, or Observations,
    that receive the row counts from the job that runs the frame, without a count of their own.

    Mind that in Spark 4.1 a session that ever used an Observation can no longer apply logistic
    regression models: their training summary drags the session into the task. Use names, read by
    a query listener, or a session of its own.
    """
    if observe:
        df = df.observe(observe[0], F.count(F.lit(1)).alias("rows"))
    if drop_all_null_cols:
        df = drop_null_columns(df)
    if drop_all_null_rows:
        df = drop_null_rows(df)
    df = drop_sparse_rows(df, null_threshold_row)
    if drop_duplicates:
        df = dedupe(df, subset_for_duplicates, order_by)
    return df.observe(observe[1], F.count(F.lit(1)).alias("rows")) if observe else df


# --- filling -------------------------------------------------------------------------------


def fit_fill(df: DataFrame, strategy: str, columns=None, approx: bool = False) -> dict:
    """Fill values per column for mean, median and mode."""
    names = present(df, columns) or numeric_columns(df)
    if strategy == "mean":
        row = df.agg(*[F.avg(measured(df, c)).alias(c) for c in names]).first()
        return {c: row[c] for c in names if row[c] is not None}
    if strategy == "median":
        found = quantiles(df, {c: [0.5] for c in names}, approx=approx)
        return {c: v[0] for c, v in found.items() if v[0] is not None}
    if strategy == "mode":
        return {c: value for c, value in modes(df, names).items()}
    raise ValueError(f"unknown strategy {strategy!r}")


def modes(df: DataFrame, columns) -> dict:
    """Most frequent value per column, the smallest of ties; 0 for a column without values.

    All columns are counted in one round: a row gives a value per column, each in the field of its type, and values of
    one column are counted where they are before they are shuffled.
    """
    names = as_list(columns)
    if not names:
        return {}
    kinds = list(dict.fromkeys(df.schema[c].dataType for c in names))
    fields = [f"v{k}" for k in range(len(kinds))]
    items = [
        F.struct(F.lit(i).alias("at"), *[
            (measured(df, c) if df.schema[c].dataType == kind else F.lit(None).cast(kind)).alias(v) for kind, v in zip(kinds, fields, strict=True)])
        for i, c in enumerate(names)]
    values = df.select(F.inline(F.array(*items))).filter(F.coalesce(*[F.col(v).isNotNull() | F.lit(None) for v in fields], F.lit(False)))
    counts = values.groupBy("at", *fields).agg((-F.count(F.lit(1))).alias("n"))
    best = counts.groupBy("at").agg(F.min(F.struct("n", *fields)).alias("b")).collect()  # one row per column
    found = {names[r["at"]]: next(r["b"][v] for v in fields if r["b"][v] is not None) for r in best}
    return {c: found.get(c, 0) for c in names}


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULL and NaN by the given value; whole-number columns widen if the value needs it."""
    out = {}
    for c, v in values.items():
        if c not in df.columns:
            continue
        fill = F.lit(v)
        if isinstance(df.schema[c].dataType, T.IntegralType) and isinstance(v, float) and v.is_integer():
            fill = F.lit(v).cast(df.schema[c].dataType)
        elif isinstance(df.schema[c].dataType, FLOATING):
            fill = F.lit(v).cast(df.schema[c].dataType)
        out[c] = F.coalesce(measured(df, c), fill)
    return df.withColumns(out) if out else df


def fill_nulls(
    df: DataFrame,
    strategy: str = "median",
    columns=None,
    fill_values: dict | None = None,
    partition_by=None,
    order_by=None,
    approx: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Fill NULLs: custom, zero, mean, median, mode, ffill or bfill.

    ffill and bfill need ``partition_by`` and ``order_by``: without them one task would have to
    hold the table.
    """
    if strategy == "custom":
        return apply_fill(df, fill_values or {})
    if strategy == "zero":
        return df.fillna(0, subset=present(df, columns) or numeric_columns(df))
    if strategy in ("ffill", "bfill"):
        keys, order = as_list(partition_by), as_list(order_by)
        if not keys or not order:
            raise ValueError(f"{strategy} needs partition_by and order_by")
        names = present(df, columns) or [c for c in df.columns if c not in keys + order]
        filled = carry_last(
            df, keys, order, {f"__f_{c}": c for c in names}, hot_rows, backward=strategy == "bfill"
        )
        return filled.select(*[F.col(f"__f_{c}").alias(c) if c in names else F.col(c) for c in df.columns])
    return apply_fill(df, fit_fill(df, strategy, columns, approx))


# --- clipping and scaling --------------------------------------------------------------------


def fit_clip(
    df: DataFrame,
    columns=None,
    method: str = "iqr",
    iqr_multiplier: float = 1.5,
    lower_percentile: float = 0.01,
    upper_percentile: float = 0.99,
    approx: bool = False,
) -> dict[str, tuple[float, float]]:
    names = present(df, columns) or numeric_columns(df)
    ps = [0.25, 0.75] if method == "iqr" else [lower_percentile, upper_percentile]
    bounds = {}
    for c, (a, b) in quantiles(df, {c: ps for c in names}, approx=approx).items():
        if a is None:
            continue
        reach = iqr_multiplier * (b - a) if method == "iqr" else 0.0
        bounds[c] = (a - reach, b + reach)
    return bounds


def apply_clip(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()}) if bounds else df


def clip_outliers(df: DataFrame, columns=None, method: str = "iqr", **options) -> DataFrame:
    return apply_clip(df, fit_clip(df, columns, method, **options))


def fit_scale(
    df: DataFrame, columns=None, method: str = "standard", ddof: int = 1, approx: bool = False
) -> dict[str, dict[str, float]]:
    """Parameters per column, with the shift and width that ``apply_scale`` uses."""
    names = present(df, columns) or numeric_columns(df)
    params: dict[str, dict[str, float]] = {}
    if method == "robust":
        for c, (q1, med, q3) in quantiles(df, {c: [0.25, 0.5, 0.75] for c in names}, approx=approx).items():
            if med is not None:
                params[c] = {
                    "median": med, "q1": q1, "q3": q3, "iqr": q3 - q1, "shift": med, "width": q3 - q1
                }
        return params
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown method {method!r}")
    deviation = F.stddev_samp if ddof else F.stddev_pop
    pair = (F.avg, deviation) if method == "standard" else (F.min, F.max)
    row = df.agg(
        *[f(measured(df, c)).alias(f"{c}__{i}") for c in names for i, f in enumerate(pair)]
    ).first()
    for c in names:
        a, b = row[f"{c}__0"], row[f"{c}__1"]
        if a is None:
            continue
        a, b = float(a), float(b) if b is not None else 0.0
        if method == "standard":
            params[c] = {"mean": a, "std": b, "shift": a, "width": b}
        else:
            params[c] = {"min": a, "max": b, "shift": a, "width": b - a}
    return params


def apply_scale(df: DataFrame, params: dict[str, dict[str, float]], unit_width: bool = False) -> DataFrame:
    """``(x - shift) / width``. A column without width is left alone, or only shifted if ``unit_width``."""
    out = {}
    for c, p in params.items():
        if p["width"] > 0:
            out[c] = (F.col(c) - F.lit(p["shift"])) / F.lit(p["width"])
        elif unit_width:
            out[c] = F.col(c) - F.lit(p["shift"])
    return df.withColumns(out) if out else df


def normalize_columns(df: DataFrame, columns=None, method: str = "standard", approx: bool = False):
    """Normalised frame and the parameters; standard uses the sample deviation."""
    params = fit_scale(df, columns, method, ddof=1, approx=approx)
    return apply_scale(df, params), params


def scale_features(df: DataFrame, columns=None, method: str = "standard", approx: bool = False):
    """Scaled frame and the parameters; standard uses the population deviation, and a constant
    column is shifted to zero."""
    params = fit_scale(df, columns, method, ddof=0, approx=approx)
    return apply_scale(df, params, unit_width=True), params


def parameter_frame(spark, params: dict[str, dict[str, float]]) -> DataFrame:
    rows = [(c, k, float(v)) for c, p in params.items() for k, v in p.items()]
    return spark.createDataFrame(rows, "column_name string, parameter string, value double")


def concat_batches(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
