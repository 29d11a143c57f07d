"""Exact quantiles against numpy, with few and many buckets."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featurelake.functions import quantiles as q

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


@pytest.mark.parametrize("limit", [2, 5, 4096])
@pytest.mark.parametrize("kind", ["spread", "copies", "two", "one", "tails", "infinite"])
def test_against_numpy(spark, kind, limit):
    rng = random.Random(kind)
    values = {
        "spread": [rng.gauss(0, 100) for _ in range(3000)],
        "copies": [7.5] * 1500 + [rng.gauss(0, 100) for _ in range(1501)],
        "two": [1.0] * 700 + [2.0] * 701,
        "one": [4.0],
        "tails": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(1000)],
        "infinite": [float("-inf")] * 40 + [rng.gauss(0, 1) for _ in range(920)] + [float("inf")] * 41,
    }[kind]
    got = q.quantiles(frame(spark, values), {"x": PS}, buckets=limit)["x"]
    ordered = sorted(values)
    spots = [q.sample_position(len(values), p) for p in PS]
    assert got == [q.between(ordered[a], ordered[b], share) for a, b, share in spots]  # to the last digit
    if kind != "infinite":
        assert got == pytest.approx(list(np.quantile(values, PS)), rel=1e-12)


def test_null_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "x double, y double")
    got = q.quantiles(df, {"x": [0.5], "y": [0.5]})
    assert got == {"x": [2.0], "y": [None]}
    assert q.quantiles(df.limit(0), {"x": [0.5]}) == {"x": [None]}


def test_approx(spark):
    got = q.quantiles(frame(spark, [float(i) for i in range(1001)]), {"x": [0.5]}, approx=True)["x"][0]
    assert abs(got - 500) <= 10


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-4, 4), min_size=1, max_size=80), st.integers(2, 4))
def test_any_data(spark, values, limit):
    got = q.quantiles(frame(spark, [float(v) for v in values]), {"x": PS}, buckets=limit)["x"]
    assert got == pytest.approx(list(np.quantile(values, PS)), rel=1e-9, abs=1e-9)


def test_order_values(spark):
    values = random.Random(2).sample(range(10_000), 2000)
    df = frame(spark, [float(v) for v in values])
    ranks = {("x", r): r for r in (0, 1, 999, 1998, 1999)}
    from pyspark.sql import functions as F

    found = q.order_values(df, {"x": F.col("x")}, ranks, buckets=2)
    assert [found[k] for k in ranks] == [float(sorted(values)[r]) for r in ranks.values()]
