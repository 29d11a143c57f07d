"""Statistics of a load as a small state that merges with those of other loads.

A state has a row per column: counts, central moments, extremes, a KLL sketch of the values and a HyperLogLog sketch of
the distinct ones. It is made in one pass over the load and written beside it, so that the profile of all loads, or the
drift of a new one against the others, reads the new load only and some rows of state.

Counts, moments and extremes are exact. A quantile is off by at most RANK_ERROR of the rows in rank (99 % of the time), a
distinct count by about DISTINCT_ERROR (one deviation). NaN counts as missing in numbers, as everywhere in this library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import measured, present

RANK_ERROR, DISTINCT_ERROR = 0.0165, 0.02
GRID = 200  # ranks of the baseline that a drift looks at
STATE = (
    "column_name string, total bigint, missing bigint, n bigint, mean double, m2 double, m3 double, m4 double, "
    "least double, most double, quantiles binary, distinct binary"
)
FIELDS = [c.split()[0] for c in STATE.split(", ")][1:]


def column_states(df: DataFrame, columns=None) -> DataFrame:
    """The state of every column (all but nested ones if none are given); one aggregate over the frame."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    names = present(df, columns) or [f.name for f in df.schema if not isinstance(f.dataType, nested)]
    items = []
    for c in names:
        value = measured(df, c)
        number = isinstance(df.schema[c].dataType, T.NumericType)
        x = value.cast("double") if number else F.lit(None).cast("double")
        varies = F.min(x) < F.max(x)
        n, m2 = F.count(value), F.when(varies, F.var_pop(x) * F.count(x)).otherwise(0.0)
        items.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("total"), (F.count(F.lit(1)) - n).alias("missing"), n.alias("n"),
            F.avg(x).alias("mean"), m2.alias("m2"),
            F.when(varies, F.skewness(x) * F.pow(m2, 1.5) / F.sqrt(n)).otherwise(0.0).alias("m3"),
            F.when(varies, (F.kurtosis(x) + 3) * m2 * m2 / n).otherwise(0.0).alias("m4"),
            F.min(x).alias("least"), F.max(x).alias("most"),
            F.when(F.count(x) > 0, F.kll_sketch_agg_double(x)).alias("quantiles"),
            F.when(n > 0, F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)))).alias("distinct")))
    if not names:
        return df.sparkSession.createDataFrame([], STATE)
    return df.agg(F.array(*items).alias("items")).select(F.inline("items"))


def write_states(df: DataFrame, folder: str, load: str, columns=None) -> None:
    """Write the state of a load; a load written again replaces its own."""
    column_states(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{folder}/load={load}")


def read_states(spark: SparkSession, folder: str) -> DataFrame:
    """States of all loads, with the load they are of."""
    return spark.read.schema(f"{STATE}, load string").option("basePath", folder).parquet(folder)


def merged_states(states: DataFrame) -> DataFrame:
    """One state per column, as if all loads had been one."""
    w = Window.partitionBy("column_name")  # a row per load
    mean = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(w)
    rows = states.select(*FIELDS, "column_name", mean.alias("whole"))
    d, n = F.coalesce(F.col("mean") - F.col("whole"), F.lit(0.0)), F.col("n")
    m2, m3, m4 = F.col("m2"), F.col("m3"), F.col("m4")
    return rows.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("total", "missing", "n")], F.max("whole").alias("mean"),
        F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"),
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.when(F.count("quantiles") > 0, F.kll_merge_agg_double("quantiles")).alias("quantiles"),
        F.when(F.count("distinct") > 0, F.hll_union_agg("distinct")).alias("distinct"),
    ).select("column_name", *FIELDS)


def quantile(p: float) -> Column:
    """The value of rank ``p`` of a state; NULL without numbers."""
    return F.when(F.col("quantiles").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))


def profile_from(states: DataFrame, digits: int = 4) -> DataFrame:
    """Profile per column of merged states; skewness and kurtosis are adjusted for the sample, as in ``numeric_profile``."""
    n = F.col("n").cast("double")
    varies = F.col("least") < F.col("most")  # sums of a constant differ from zero by rounding
    spread = F.try_divide(F.when(varies, F.col("m2")).otherwise(0.0), n - 1)
    skew = F.when((n > 2) & varies, F.sqrt(n) * F.col("m3") / F.pow("m2", 1.5) * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when((n > 3) & varies, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (n * F.col("m4") / (F.col("m2") * F.col("m2")) - 3) + 6))
    numbers = F.col("mean").isNotNull()
    values = {
        "mean": F.col("mean"), "std": F.when(numbers & (n > 1), F.sqrt(spread)), "min": F.col("least"), "max": F.col("most"),
        "q1": quantile(0.25), "median": quantile(0.5), "q3": quantile(0.75), "skewness": skew, "kurtosis": kurt}
    return states.select(
        "column_name", F.col("total").alias("rows"), F.col("missing").alias("null_count"),
        F.round(F.try_divide(F.col("missing") * 100.0, "total"), 2).alias("null_pct"),
        F.when(F.col("distinct").isNull(), 0).otherwise(F.hll_sketch_estimate("distinct")).alias("distinct_estimate"),
        *[F.round(v, digits).alias(k) for k, v in values.items()])


def drift_from(states: DataFrame, baseline: DataFrame, steps: int = 20) -> DataFrame:
    """How one state differs from another, per column of both: shift of the mean in deviations of the baseline, ratio of the
    deviations, difference of the missing shares, and the largest difference in rank at ``steps`` quantiles (the
    Kolmogorov-Smirnov distance, as far as the sketches tell)."""
    old = baseline.select(*[F.col(c).alias(f"b_{c}") for c in ("column_name", *FIELDS)])
    both = states.join(old, F.col("column_name") == F.col("b_column_name"))
    spread, before = (
        F.sqrt(F.try_divide(F.when(F.col(f"{p}least") < F.col(f"{p}most"), F.col(f"{p}m2")), F.col(f"{p}n") - 1)) for p in ("", "b_"))
    known = F.col("quantiles").isNotNull() & F.col("b_quantiles").isNotNull()
    marks = [(2 * k + 1) / (2 * GRID) for k in range(GRID)]
    theirs = F.kll_sketch_get_quantile_double("b_quantiles", F.array(*[F.lit(m) for m in marks]))

    def distance(k: int) -> Column:
        """A quantile has as its rank in the baseline any from the share of marks below it to that of marks up to it."""
        here = quantile(k / steps)
        below, upto = (F.size(F.filter(theirs, f)) / GRID for f in (lambda v: v < here, lambda v: v <= here))
        return F.greatest(below - k / steps, k / steps - upto, F.lit(0.0))

    return both.select(
        "column_name", F.col("total").alias("rows"), F.col("b_total").alias("base_rows"),
        F.try_divide(F.col("mean") - F.col("b_mean"), before).alias("mean_shift"),
        F.when(F.col("mean").isNotNull(), F.try_divide(spread, before)).alias("std_ratio"),
        (F.try_divide("missing", "total") - F.try_divide("b_missing", "b_total")).alias("missing_diff"),
        F.when(known, F.greatest(*[distance(k) for k in range(1, steps)])).alias("rank_distance"))
