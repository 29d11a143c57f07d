"""Equi joins with suffix handling, and the point-in-time (as-of) join."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_list, same_keys
from ..functions.skew import HOT_ROWS, attach, group_attach, hot_keys
from .series import carry_last


def join(
    left: DataFrame,
    right: DataFrame,
    on=None,
    left_on=None,
    right_on=None,
    how: str = "inner",
    suffix: str = "_right",
    null_safe: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Equi join; overlapping columns of the right side get the suffix.

    With ``on`` the keys come out once and first; with ``left_on`` and ``right_on`` both sides keep theirs. Then come the
    other columns of the left side and those of the right. Spark picks broadcast or sort-merge by size, and AQE splits
    skewed partitions where the kind of join lets it. With ``hot_rows`` set, keys of either side above it are salted
    instead, for every kind of join.
    """
    lks, rks = (as_list(on),) * 2 if on is not None else (as_list(left_on), as_list(right_on))
    overlap = [c for c in right.columns if c in left.columns and not (on is not None and c in lks)]
    right = right.withColumnsRenamed({c: f"{c}{suffix}" for c in overlap})
    rks = [f"{c}{suffix}" if c in overlap else c for c in rks]
    how = {"full": "outer", "left_outer": "left", "right_outer": "right", "full_outer": "outer"}.get(how, how)
    if how in ("semi", "left_semi", "leftsemi", "anti", "left_anti", "leftanti"):
        pairs = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in zip(lks, rks, strict=True)]
        return left.join(right, _all(pairs), how)
    names = [f"__k{i}" for i in range(len(lks))]
    one = left.select(F.struct(*left.columns).alias("__l"), *[F.col(k).alias(n) for k, n in zip(lks, names, strict=True)])
    two = right.select(F.struct(*right.columns).alias("__r"), *[F.col(k).alias(n) for k, n in zip(rks, names, strict=True)])
    hot = [hot_keys(side, names, hot_rows) for side in (one, two)] if hot_rows else []
    if any(hot):
        out = _salted(one, two, names, hot, how, null_safe)
        l, r = (lambda c: F.col(f"__l.`{c}`")), (lambda c: F.col(f"__r.`{c}`"))
    else:
        renamed = {c: f"__r_{c}" for c in right.columns}
        two = right.withColumnsRenamed(renamed)
        pairs = [(left[a], two[renamed[b]]) for a, b in zip(lks, rks, strict=True)]
        out = left.join(two, _all([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]), how)
        l, r = (lambda c: left[c]), (lambda c: two[renamed[c]])
    if on is None:
        return out.select(*[l(c).alias(c) for c in left.columns], *[r(c).alias(c) for c in right.columns])
    key = {"right": lambda k: r(k), "outer": lambda k: F.coalesce(l(k), r(k))}.get(how, l)
    return out.select(
        *[key(k).alias(k) for k in lks], *[l(c).alias(c) for c in left.columns if c not in lks],
        *[r(c).alias(c) for c in right.columns if c not in rks])


def _salted(one: DataFrame, two: DataFrame, names: list[str], hot, how: str, null_safe: bool) -> DataFrame:
    """Matched rows by a salted inner join, and the rows of either side that the kind of join keeps without a match.

    The side with the larger hot key is dealt out. Distinct keys tell which rows have no match.
    """
    first, other, keys = (one, two, hot[0]) if hot[0].largest >= hot[1].largest else (two, one, hot[1])
    out = attach(first, other, names, keys, "inner", null_safe).select("__l", "__r")
    for side, opposite, kinds in ((one, two, ("left", "outer")), (two, one, ("right", "outer"))):
        if how in kinds:
            known = opposite.select(*names).distinct().withColumnsRenamed({n: f"{n}_known" for n in names})
            pairs = [side[n].eqNullSafe(known[f"{n}_known"]) if null_safe else side[n] == known[f"{n}_known"] for n in names]
            out = out.unionByName(side.join(known, _all(pairs), "left_anti").drop(*names), allowMissingColumns=True)
    return out


def _all(pairs):
    out = pairs[0]
    for p in pairs[1:]:
        out = out & p
    return out


@dataclass(frozen=True)
class FeatureView:
    """A table of feature rows: who they describe, when they became known, what they hold."""

    name: str
    frame: DataFrame
    timestamp_column: str
    columns: list[str] | None = None
    tie_break: list[str] = field(default_factory=list)


def point_in_time_join(
    entities: DataFrame,
    view: FeatureView,
    entity_key,
    event_timestamp_column: str,
    prefix: str = "",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """For each entity row the latest feature row with feature time <= event time.

    Both sides are stacked and the last feature row is carried forward along time: one shuffle and
    one sort, O(n log n), where an inequality join would pair each event with its whole past. A
    feature known at the very instant of the event counts. Every entity row is kept, unmatched ones
    with NULLs. An entity with too many rows is reduced to its instants and cut in time.
    """
    return _join_views(entities, [(view, prefix)], as_list(entity_key), event_timestamp_column, hot_rows)


def _sortable(df: DataFrame, name: str) -> Column:
    """The column, or for a map its sorted entries."""
    return F.array_sort(F.map_entries(name)) if isinstance(df.schema[name].dataType, T.MapType) else F.col(name)


def _join_views(entities: DataFrame, views, keys: list[str], at: str, hot_rows) -> DataFrame:
    """As-of join of several views; all sides are stacked once, so the entities are shuffled once."""
    feats, names = [], []
    for i, (view, prefix) in enumerate(views):
        time = view.timestamp_column
        wanted = view.columns or [c for c in view.frame.columns if c not in keys + [time]]
        ties = [t for t in view.tie_break if t in view.frame.columns]
        ordered = ties + [c for c in wanted if c not in ties]
        known = F.col(time).isNotNull() & _all([F.col(k).isNotNull() for k in keys])
        columns = [*keys, F.col(time).alias("__ts"), F.struct(*ordered).alias(f"__feature_{i}")]
        if any(isinstance(view.frame.schema[c].dataType, T.MapType) for c in ordered):
            columns.append(F.struct(*[_sortable(view.frame, c).alias(c) for c in ordered]).alias(f"__rank_{i}"))
        feats.append(view.frame.filter(known).select(*columns))
        names.append({c: f"{prefix}{c}" for c in wanted})
    instants = entities.select(*keys, F.col(at).alias("__ts"))
    for f in feats:
        instants = instants.unionByName(f.select(*keys, "__ts"))
    hot = hot_keys(instants, keys, hot_rows)
    if not hot:
        return _carry_features(entities, feats, keys, at, names, None)
    # Copies of one instant cannot be cut apart in time. Both sides are reduced to one row per key and
    # instant before the shuffle, matched, and joined back to the entities with hot pairs salted.
    newest = []
    for i, f in enumerate(feats):
        rank = f"__rank_{i}" if f"__rank_{i}" in f.columns else f"__feature_{i}"
        best = [F.max_by(c, rank).alias(c) for c in f.columns if c.startswith(("__feature_", "__rank_"))]
        newest.append(f.groupBy(*keys, "__ts").agg(*best))
    matched = _carry_features(entities.select(*keys, at).distinct(), newest, keys, at, names, hot)
    return group_attach(entities, matched, [*keys, at], hot_rows)


def _carry_features(entities, feats, keys, at, names: list[dict[str, str]], hot) -> DataFrame:
    """Stack all sides and carry the last feature row of each view along time.

    With ``hot`` keys a view has one row per instant, so that the order needs no values.
    """
    kept = [c for c in entities.columns if c not in keys]
    stacked = entities.select(
        *keys, F.col(at).alias("__ts"), F.lit(1).alias("__kind"), F.struct(*kept).alias("__entity")
    )
    for f in feats:
        stacked = stacked.unionByName(f.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    # features come before entities of the same instant; of several features of a view the largest
    # (tie-break columns, then all values) is last and wins
    ranks = [] if hot else [f"__rank_{i}" if f"__rank_{i}" in f.columns else f"__feature_{i}" for i, f in enumerate(feats)]
    targets = {f"__match_{i}": f"__feature_{i}" for i in range(len(feats))}
    carried = carry_last(stacked, keys, ["__ts", "__kind", *ranks], targets, None, hot=hot)
    hit = F.col("__ts").isNotNull() & _all([F.col(k).isNotNull() for k in keys])
    return carried.filter(F.col("__kind") == 1).select(
        *[F.col(k) if c is None else F.col(f"__entity.`{c}`").alias(c) for c, k in _layout(entities, keys)],
        *[F.when(hit, F.col(f"__match_{i}")[c]).alias(n) for i, own in enumerate(names) for c, n in own.items()],
    )


def _layout(entities: DataFrame, keys: list[str]):
    return [(None, c) if c in keys else (c, None) for c in entities.columns]


def training_set(
    entities: DataFrame,
    views: list[FeatureView],
    entity_key,
    event_timestamp_column: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """As-of join of several feature tables; columns are prefixed by the table's name."""
    return _join_views(
        entities, [(v, f"{v.name}_") for v in views], as_list(entity_key), event_timestamp_column, hot_rows
    )


__all__ = ["FeatureView", "join", "point_in_time_join", "same_keys", "training_set"]
