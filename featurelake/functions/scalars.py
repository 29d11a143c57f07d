"""Column-level feature functions: calendar parts, products, ratios, ids, JSON, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import as_list

# Names of calendar parts.
CALENDAR = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "day_of_week": F.weekday,  # Monday is 0
    "day_of_year": F.dayofyear,
    "week_of_year": F.weekofyear,
    "quarter": F.quarter,
    "is_weekend": lambda ts: flag(F.weekday(ts) >= 5),
}


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def flag_in(col: Column | str, values) -> Column:
    return flag((F.col(col) if isinstance(col, str) else col).isin(list(values)))


def temporal_features(df: DataFrame, timestamp_column: str, features=None) -> DataFrame:
    """Add ``{timestamp}_{part}`` columns; unknown part names are skipped."""
    wanted = [f for f in (features or CALENDAR) if f in CALENDAR]
    ts = F.col(timestamp_column)
    return df.withColumns({f"{timestamp_column}_{f}": CALENDAR[f](ts) for f in wanted})


def interaction_features(df: DataFrame, column_pairs) -> DataFrame:
    """Add ``a_x_b = a * b`` for each pair."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in column_pairs})


def ratio(numerator, denominator, fill_value: float = 0.0) -> Column:
    """Quotient; ``fill_value`` where the denominator is zero, NULL where it is NULL."""
    n, d = (F.col(x) if isinstance(x, str) else x for x in (numerator, denominator))
    return F.when(d == 0, F.lit(float(fill_value))).otherwise(n / F.nullif(d, F.lit(0)))


def ratio_features(df: DataFrame, numerator_denominator_pairs, fill_value: float = 0.0) -> DataFrame:
    """Add ``a_per_b`` for each pair."""
    return df.withColumns(
        {f"{a}_per_{b}": ratio(a, b, fill_value) for a, b in numerator_denominator_pairs}
    )


def clip(col: Column | str, lower=None, upper=None) -> Column:
    """Bounded value; NULL and NaN stay (greatest and least would skip the one and take the other for the largest)."""
    c = F.col(col) if isinstance(col, str) else col
    bounded = c
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(F.isnan(c.cast("double")), c).when(c.isNotNull(), bounded)


def signed_error(prediction: str, label: str) -> Column:
    return F.col(prediction) - F.col(label)


def abs_error(prediction: str, label: str, digits: int | None = None) -> Column:
    error = F.abs(signed_error(prediction, label))
    return error if digits is None else F.round(error, digits)


def padded_id(prefix: str, col: str, width: int = 6) -> Column:
    """Composite id such as ``user_000001``; longer numbers are kept whole."""
    text = F.col(col).cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    )


def key_label(col: str) -> Column:
    """``column=value`` key."""
    return F.concat(F.lit(f"{col}="), F.col(col).cast("string"))


def first_id(*columns, fallback: Column | None = None) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.coalesce(*parts, *([fallback] if fallback is not None else []))


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Parse a JSON text column once and add the named fields (``{name: type}``)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    parsed = df.withColumn("__json", F.from_json(column, schema))
    return parsed.withColumns({n: F.col(f"__json.{n}") for n in fields}).drop("__json")


def json_row(*columns) -> Column:
    return F.to_json(F.struct(*columns) if columns else F.struct("*"))


def named_features(names: str, values: str) -> Column:
    """Parallel arrays of names and values as one map."""
    return F.map_from_arrays(names, values)


def widen_features(df: DataFrame, names: str, values: str, features) -> DataFrame:
    """One column per wanted feature out of the parallel arrays; missing ones are NULL."""
    where = {f: F.array_position(F.col(names), F.lit(f)).cast("int") for f in as_list(features)}
    return df.withColumns(
        {f: F.when(at > 0, F.try_element_at(F.col(values), at)) for f, at in where.items()}
    )


def melt_features(df: DataFrame, keys, names: str, values: str) -> DataFrame:
    """One row per feature: keys, name, value."""
    pairs = F.arrays_zip(F.col(names).alias("name"), F.col(values).alias("value"))
    return df.select(*as_list(keys), F.inline(pairs).alias("name", "value"))


def canonical(columns) -> Column:
    """Row text for hashing: fields joined by a unit separator, NULL written as ``\\N``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\\N")) for c in columns]
    return F.concat_ws("\x1f", *parts)


def row_hash(columns) -> Column:
    return F.md5(canonical(columns))


def hash_number(columns, digits: int = 8) -> Column:
    """The first hex digits of the row hash as a whole number."""
    return F.conv(F.substring(row_hash(columns), 1, digits), 16, 10).cast("bigint")


def fingerprint_columns(columns) -> tuple[Column, Column]:
    """Aggregates that identify a table whatever the order of its rows: hash sum and row count.

    Every NaN, zero and timestamp is hashed by its text, so equal rows hash alike.
    """
    total = F.sum(hash_number(columns).cast("decimal(20,0)"))
    return F.coalesce(total, F.lit(0)).cast("decimal(38,0)"), F.count(F.lit(1))


def content_fingerprint(df: DataFrame) -> DataFrame:
    total, rows = fingerprint_columns(sorted(df.columns))
    return df.agg(total.alias("hash_sum"), rows.alias("row_count"))
