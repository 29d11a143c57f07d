"""Small helpers over columns and schemas used by every operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)


def as_list(value) -> list:
    """One name or many names, as a list."""
    if value is None:
        return []
    return [value] if isinstance(value, (str, Column)) else list(value)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    skip = set(as_list(exclude))
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, names) -> list[str]:
    """The given names that the frame has; unknown ones are skipped."""
    have = set(df.columns)
    return [n for n in as_list(names) if n in have]


def measured(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that statistics skip it."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(col), col)
    return col


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def same_keys(left: DataFrame, right: DataFrame, names, null_safe: bool = True) -> Column:
    """Equality of like-named keys; NULL equals NULL when ``null_safe``."""
    if null_safe:
        return all_of([left[n].eqNullSafe(right[n]) for n in names])
    return all_of([left[n] == right[n] for n in names])


def one_row(df: DataFrame) -> Column:
    """The single row of an aggregate as a struct column: a scalar subquery, evaluated once."""
    return df.select(F.struct("*")).scalar()
