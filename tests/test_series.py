"""Series cut into pieces must give what one plain window, or brute force, gives."""

import bisect
import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from featurelake.functions import encoding, ranges, skew
from featurelake.operators import aggregate, clean, features, joins, series

START = datetime(2024, 1, 1)


def build(spark, n=400, seed=1, hot=0.6):
    """A third or more of the rows belong to one key; some keys, times and values are NULL or tied."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        ts = START + timedelta(seconds=rng.randrange(200))
        data.append((i, key, ts if rng.random() < 0.97 else None, rng.choice([None, rng.uniform(0, 9), 3.0])))
    return spark.createDataFrame(data, "id int, key string, ts timestamp, value double").repartition(4)


ORDER = ["ts", "id"]


@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_pieces(spark, seed):
    df = build(spark, seed=seed)
    args = ("key", ORDER, "value", [2, 7], ["mean", "sum", "min", "max", "stddev", "count"])
    assert rows(features.rolling_features(df, *args, hot_rows=15)) == rows(
        features.rolling_features(df, *args, hot_rows=None))


def test_window_longer_than_pieces(spark):
    df = build(spark, n=120)
    args = ("key", ORDER, "value", [40], ["sum", "count"])
    assert rows(features.rolling_features(df, *args, hot_rows=2)) == rows(
        features.rolling_features(df, *args, hot_rows=None))


def test_rolling_brute_force(spark):
    df = build(spark)
    got = {r["id"]: r["value_w5_sum"] for r in features.rolling_features(
        df, "key", ORDER, "value", 5, ["sum"], hot_rows=10).collect()}
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r["key"], []).append(r)
    for group in by_key.values():
        group.sort(key=lambda r: (r["ts"] is not None, r["ts"] or START, r["id"]))
        for i, r in enumerate(group):
            seen = [x["value"] for x in group[max(0, i - 4) : i + 1] if x["value"] is not None]
            want = sum(seen) if seen else None
            assert (got[r["id"]] is None) == (want is None)
            if want is not None:
                assert math.isclose(got[r["id"]], want, abs_tol=1e-9)


def test_lag_pieces(spark):
    df = build(spark, seed=3)
    args = ("key", ORDER, "value", [1, 3, 11])
    assert rows(features.lag_features(df, *args, hot_rows=12)) == rows(features.lag_features(df, *args, hot_rows=None))


@pytest.mark.parametrize("strategy", ["ffill", "bfill"])
def test_fill_pieces(spark, strategy):
    df = build(spark, seed=4)
    options = dict(strategy=strategy, columns=["value"], partition_by="key", order_by=ORDER)
    assert rows(clean.fill_nulls(df, hot_rows=9, **options)) == rows(clean.fill_nulls(df, hot_rows=None, **options))


def test_one_instant_is_cut_along_the_second_column(spark):
    """Most rows of the hot key share one time; they are cut by the id."""
    df = build(spark, n=500, seed=12).withColumn(
        "ts", F.when(F.col("id") % 5 > 0, F.lit(datetime(2024, 1, 1, 0, 1))).otherwise(F.col("ts")))
    cut = series.cut_series(df, ["key"], ORDER, skew.hot_keys(df, "key", 20))
    sizes = [r["count"] for r in cut.filter("key = 'hot'").groupBy("key", series.PIECE).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 0.3 * sum(sizes)
    args = ("key", ORDER, "value", [1, 4])
    assert rows(features.lag_features(df, *args, hot_rows=20)) == rows(features.lag_features(df, *args, hot_rows=None))
    options = dict(strategy="ffill", columns=["value"], partition_by="key", order_by=ORDER)
    assert rows(clean.fill_nulls(df, hot_rows=20, **options)) == rows(clean.fill_nulls(df, hot_rows=None, **options))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date", "bigint", "double", "decimal(12,3)", "string", "binary"])
def test_order_types(spark, kind):
    df = build(spark, seed=5)
    if kind in ("timestamp_ntz", "date"):
        at = F.col("ts").cast(kind) if kind == "timestamp_ntz" else F.date_add(F.lit("2024-01-01"), F.col("id"))
    else:
        at = F.col("id") * 3 % 101
        at = at.cast("string").cast(kind) if kind == "binary" else at.cast(kind)
    df = df.withColumn("at", at)
    args = ("key", ["at", "id"], "value", [1, 2])
    assert rows(features.lag_features(df, *args, hot_rows=12)) == rows(features.lag_features(df, *args, hot_rows=None))


def test_running_total_pieces(spark):
    df = build(spark, seed=6).withColumn("one", F.lit(1))
    args = ("key", ORDER, {"rank": "one"}, {"n": "one"})
    got = series.running_total(df, *args, hot_rows=10)
    assert rows(got) == rows(series.running_total(df, *args, hot_rows=None))
    assert got.columns == [*df.columns, "rank", "n"]


def test_series_and_ranks_of_any_length(spark):
    """Ranks by range partitions, with NULL groups, ties and empty frames; pieces of one row each."""
    df = build(spark, n=150, seed=13)
    w = Window.partitionBy("key").orderBy("ts", "id")
    plain = df.withColumns({"rank": F.row_number().over(w).cast("long") - 1, "size": F.count(F.lit(1)).over(Window.partitionBy("key"))})
    assert rows(ranges.ranked(df, ["key"], ["ts", "id"]), *plain.columns) == rows(plain)
    assert ranges.ranked(df.filter("id < 0"), ["key"], ["ts", "id"]).count() == 0
    assert sorted(r["rank"] for r in ranges.ranked(df, [], ["ts"]).collect()) == list(range(150))
    args = ("key", ORDER, "value", [1, 2])
    assert rows(features.lag_features(df, *args, hot_rows=1)) == rows(features.lag_features(df, *args, hot_rows=None))


def test_kinds_that_files_do_not_hold(spark):
    df = build(spark, n=60).withColumn("nothing", F.lit(None))
    args = ("key", ORDER, "value", [1])
    assert rows(features.lag_features(df, *args, hot_rows=9)) == rows(features.lag_features(df, *args, hot_rows=None))


def brute_asof(entities, feats):
    known = {}
    for f in feats:
        if f["ts"] is not None and f["key"] is not None:
            known.setdefault(f["key"], []).append((f["ts"], f["score"]))
    out = []
    for e in entities:
        past = sorted(known.get(e["key"], []))
        hit = None
        if e["ts"] is not None and past:
            i = bisect.bisect_right([p[0] for p in past], e["ts"])
            hit = past[i - 1][1] if i else None
        out.append((e["id"], hit))
    return sorted(out)


@pytest.mark.parametrize("hot_rows", [None, 7])
def test_asof_brute_force(spark, hot_rows):
    """Duplicate entity rows are all kept, ties in feature time go to the largest value, NULLs never match."""
    entities = build(spark, seed=7).select("id", "key", "ts")
    entities = entities.unionByName(entities.filter("id < 50").withColumn("id", F.col("id") + 1000))
    feats = build(spark, seed=8).select("key", "ts", F.col("id").cast("double").alias("score"))
    got = joins.point_in_time_join(entities, joins.FeatureView("f", feats, "ts"), "key", "ts", hot_rows=hot_rows)
    assert got.columns == ["id", "key", "ts", "score"]
    assert sorted((r["id"], r["score"]) for r in got.collect()) == brute_asof(entities.collect(), feats.collect())


def test_asof_feature_row_with_null_value_counts(spark):
    """The latest feature row is taken as it is, even if its value is NULL."""
    e = spark.createDataFrame([("a", 3)], "key string, ts int")
    f = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None)], "key string, ts int, score double")
    got = joins.point_in_time_join(e, joins.FeatureView("f", f, "ts"), "key", "ts")
    assert got.first()["score"] is None


def test_asof_tie_break(spark):
    e = spark.createDataFrame([("a", 3)], "key string, ts int")
    f = spark.createDataFrame([("a", 3, 9.0, 1), ("a", 3, 1.0, 2)], "key string, ts int, score double, updated int")
    view = joins.FeatureView("f", f, "ts", ["score"], ["updated"])
    assert joins.point_in_time_join(e, view, "key", "ts").first()["score"] == 1.0


def test_training_set_prefixes(spark):
    e = spark.createDataFrame([("a", 5), ("z", 5)], "key string, ts int")
    f = spark.createDataFrame([("a", 1, 2.0)], "key string, at int, score double")
    views = [joins.FeatureView("x", f, "at"), joins.FeatureView("y", f, "at")]
    assert rows(joins.training_set(e, views, "key", "ts")) == [("a", 5, 2.0, 2.0), ("z", 5, None, None)]


def test_asof_empty_sides(spark):
    e = spark.createDataFrame([("a", 5)], "key string, ts int")
    f = spark.createDataFrame([], "key string, ts int, score double")
    view = joins.FeatureView("f", f, "ts")
    assert rows(joins.point_in_time_join(e, view, "key", "ts")) == [("a", 5, None)]
    assert joins.point_in_time_join(e.limit(0), view, "key", "ts").count() == 0


def test_group_features_salted(spark):
    df = build(spark, seed=9)
    args = ("key", "value", ["mean", "sum", "count", "min", "max", "stddev"])
    got = aggregate.group_features(df, *args, hot_rows=20)
    assert rows(got) == rows(aggregate.group_features(df, *args, hot_rows=None))
    assert got.columns[: len(df.columns)] == df.columns


def test_group_features_copies(spark):
    """Equal rows are spread as well: the salt mixes in the input partition."""
    df = spark.range(2000).select(F.lit("hot").alias("key"), F.lit(1.0).alias("value")).repartition(8)
    hot = skew.hot_keys(df, "key", 50)
    assert hot and hot.largest == 2000
    salted = df.withColumn("salt", F.pmod(skew.spread(skew.hashable(df)), F.lit(16)))
    assert salted.select("salt").distinct().count() > 3


def test_hot_keys_by_buckets(spark):
    """Two rounds find what a count of every key finds; the second only where a bucket is heavy."""
    df = build(spark, n=900, seed=14).withColumn("other", F.col("id") % 7)
    for names in (["key"], ["key", "other"]):
        counts = df.groupBy(*names).count().filter("count > 30").collect()
        hot = skew.hot_keys(df, names, 30)
        assert sorted(tuple(r)[:-1] for r in hot.frame.collect() if None not in tuple(r)) == sorted(
            tuple(r)[:-1] for r in counts if None not in tuple(r))
        assert hot.frame.count() == len(counts) and hot.rows == 900 and hot.largest == max(r["count"] for r in counts)
    assert not skew.hot_keys(df, "id", 30) and skew.hot_keys(df, "id", 30).rows == 900
    known = skew.hot_of(df.groupBy("key").count(), "key", "count", 30)
    assert rows(known.frame) == rows(skew.hot_keys(df, "key", 30).frame)


@pytest.mark.parametrize("how", ["inner", "left", "outer"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join(spark, how, null_safe):
    left = build(spark, seed=10).select("id", "key")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("b", 3), (None, 4), ("new", 5)], "key string, w int")
    got = joins.join(left, right, "key", how=how, null_safe=null_safe, hot_rows=20)
    assert rows(got, "id", "key", "w") == rows(joins.join(left, right, "key", how=how, null_safe=null_safe), "id", "key", "w")


def test_group_median_pieces(spark):
    df = build(spark, seed=11)
    args = ("key", {"value": ["median", "mean", "count"]})
    assert rows(aggregate.aggregate(df, *args, hot_rows=10)) == rows(aggregate.aggregate(df, *args, hot_rows=None))


def test_dictionary_codes(spark):
    df = spark.range(500).select(F.concat(F.lit("v"), (F.col("id") % 90).cast("string")).alias("c"))
    counts = {f"v{k}": len(range(k, 500, 90)) for k in range(90)}
    for by_frequency, order in ((False, sorted(counts)), (True, sorted(counts, key=lambda v: (-counts[v], v)))):
        expected = sorted((v, i, counts[v]) for i, v in enumerate(order))
        assert sorted(tuple(r) for r in encoding.fit_codes(df, "c", by_frequency).collect()) == expected


def test_even_keys_keep_one_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = features.rolling_features(events, "user_id", ["ts", "event_id"], "value", [3, 10])
    text = plan(out)
    assert text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in text


def test_hot_window_has_no_single_task(spark):
    df = build(spark)
    text = plan(features.rolling_features(df, "key", ORDER, "value", [3], hot_rows=20))
    assert "SinglePartition" not in text and "Window" in text


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["h", "h", "h", "a"]), st.integers(0, 12), st.one_of(st.none(), st.integers(0, 5))),
             min_size=1, max_size=60),
    st.integers(1, 6),
)
def test_lag_any_data(spark, data, reach):
    df = spark.createDataFrame(
        [(i, k, t, None if v is None else float(v)) for i, (k, t, v) in enumerate(data)],
        "id int, key string, ts int, value double")
    args = ("key", ["ts", "id"], "value", [reach])
    assert rows(features.lag_features(df, *args, hot_rows=3)) == rows(features.lag_features(df, *args, hot_rows=None))
