"""Exact quantiles with linear interpolation, on data of any size.

Values are counted by bucket, the bucket of each wanted rank becomes the next range, and rounds repeat until a range
is a single value. A round is one grouped count of all columns together: every task sends a row per bucket
at most, and the driver gets ``BUCKETS`` rows per range at most, however many rows there are. Each round narrows a
range about ``BUCKETS`` times, so 10^12 rows need four or five. There is no sketch and no buffer of values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import running_total
from .columns import as_list, measured
from .skew import HOT_ROWS, attach, hot_keys

BUCKETS = 4096
ACCURACY = 10_000  # of approximate quantiles
LARGEST = 710.0  # above the logarithm of every finite number


def sample_position(count: int, p: float) -> tuple[int, int, float]:
    """Ranks around quantile p among ``count`` sorted values, and the share of the upper one."""
    at = p * (count - 1)
    low = math.floor(at)
    return low, math.ceil(at), at - low


def quantiles(
    df: DataFrame, wanted: dict[str, list[float]], approx: bool = False, buckets: int = BUCKETS
) -> dict[str, list[float | None]]:
    """``{column: [p, …]}`` to ``{column: [value, …]}``; NULL and NaN are skipped.

    ``approx`` takes Spark's sketch instead, which one task merges.
    """
    if not wanted:
        return {}
    cols = {c: measured(df, c).cast("double") for c in wanted}
    names = list(wanted)
    if approx:
        row = df.agg(*[F.percentile_approx(cols[c], list(wanted[c]), ACCURACY).alias(c) for c in names]).first()
        return {c: list(row[c]) if row[c] else [None] * len(wanted[c]) for c in names}
    spans = _spans(df, cols)
    count = {c: spans[c][3] for c in names}
    ranks = {(c, r): r for c in names if count[c] for p in wanted[c] for r in sample_position(count[c], p)[:2]}
    found = _values(df, cols, ranks, spans, buckets)
    out: dict[str, list[float | None]] = {}
    for c in names:
        spots = [sample_position(count[c], p) if count[c] else None for p in wanted[c]]
        out[c] = [s and between(found[(c, s[0])], found[(c, s[1])], s[2]) for s in spots]
    return out


def between(low: float, high: float, share: float) -> float:
    return low if low == high or not share else low + (high - low) * share


def order_values(df: DataFrame, columns: dict[str, Column], ranks: dict, buckets: int = BUCKETS) -> dict:
    """The exact value at each 0-based rank: ``{(column, …): rank}`` to ``{(column, …): value}``."""
    return _values(df, columns, ranks, _spans(df, columns), buckets)


def _spans(df: DataFrame, columns: dict[str, Column]) -> dict:
    """(least, largest, rows below, rows inside) of the whole of each column."""
    row = df.agg(*[
        F.struct(F.min(v).alias("a"), F.max(v).alias("b"), F.count(v).alias("n")).alias(f"c{i}")
        for i, v in enumerate(columns.values())
    ]).first()
    return {c: (row[f"c{i}"]["a"], row[f"c{i}"]["b"], 0, row[f"c{i}"]["n"]) for i, c in enumerate(columns)}


def _values(df: DataFrame, columns: dict[str, Column], ranks: dict, spans: dict, buckets: int) -> dict:
    state, found, by_log = {k: spans[k[0]] for k in ranks}, {}, False
    while True:
        found |= {k: s[0] for k, s in state.items() if s[0] == s[1]}
        state = {k: s for k, s in state.items() if k not in found}
        if not state:
            return found
        ranges = list(dict.fromkeys((k[0], *s) for k, s in state.items()))
        items = []
        for c in dict.fromkeys(r[0] for r in ranges):
            v, item = columns[c], F.lit(None)
            for i, (own, low, high, _, _) in enumerate(ranges):
                if own == c:
                    inside = (v >= low) & (v <= high)
                    item = F.when(inside, F.struct(F.lit(i).alias("i"), _bucket(v, low, high, by_log, buckets).alias("b"), v.alias("v"))).otherwise(item)
            items.append(item)
        counted = df.select(F.inline(F.array(*items))).filter("i IS NOT NULL").groupBy("i", "b")
        rows = counted.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).collect()
        by_range: dict = {}
        for r in sorted(rows, key=lambda r: (r["i"], r["b"])):
            by_range.setdefault(r["i"], []).append(r)
        for k, s in list(state.items()):
            below = s[2]
            for r in by_range[ranges.index((k[0], *s))]:
                if ranks[k] < below + r["n"]:
                    state[k] = (r["low"], r["high"], below, r["n"])
                    break
                below += r["n"]
        by_log = not by_log


def _bucket(v: Column, low: float, high: float, by_log: bool, buckets: int) -> Column:
    """A number below ``buckets`` that never falls as v grows from ``low`` to ``high``, 0 at the one and the last at the other.

    Rounds take the value and its logarithm in turn, so that neither far outliers nor crowds near zero cost many.
    """
    a, b = (math.copysign(min(math.log1p(abs(x)), LARGEST), x) for x in (low, high))
    if (by_log or not math.isfinite(high - low)) and a < b:
        v, low, high = F.signum(v) * F.least(F.log1p(F.abs(v)), F.lit(LARGEST)), a, b
    share = (v - F.lit(low)) / F.lit(high - low)
    return F.least(F.greatest(F.floor(share * buckets), F.lit(0)), F.lit(buckets - 1)).cast("int")


def group_quantiles(
    df: DataFrame, keys, wanted: dict[str, dict[str, float]], hot_rows: int | None = HOT_ROWS // 4
) -> DataFrame:
    """One row per group with ``{column: {new_name: p}}`` exact quantiles.

    Groups that fit one task use ``percentile``. If some group does not, values are counted
    first and the ranks found by running totals cut into pieces (see ``operators.series``).
    """
    keys = as_list(keys)
    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return df.groupBy(*keys).agg(
            *[
                F.percentile(measured(df, c).cast("double"), p).alias(name)
                for c, parts in wanted.items()
                for name, p in parts.items()
            ]
        )
    out = df.select(*keys).distinct()
    for c, parts in wanted.items():
        counts = (
            df.select(*keys, measured(df, c).cast("double").alias("__v"))
            .filter(F.col("__v").isNotNull())
            .groupBy(*keys, "__v")
            .agg(F.count(F.lit(1)).alias("__c"))
        )
        ranked = running_total(counts, keys, "__v", {"__to": "__c"}, {"__n": "__c"}, hot_rows)
        picks = []
        for name, p in parts.items():
            at = F.lit(float(p)) * (F.col("__n") - 1)
            low, high = F.floor(at), F.ceil(at)

            def value(rank):
                return F.max(
                    F.when((rank < F.col("__to")) & (rank >= F.col("__to") - F.col("__c")), F.col("__v"))
                )

            a, b, share = value(low), value(high), F.max(at - low)
            picks.append(F.when((a == b) | (share == 0), a).otherwise(a + (b - a) * share).alias(name))
        out = attach(out, ranked.groupBy(*keys).agg(*picks), keys, hot_keys(out, keys, None))
    return out
