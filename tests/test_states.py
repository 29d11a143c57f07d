"""States of loads merge into what one pass over all rows gives."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from featurelake.operators import aggregate, states


@pytest.fixture(scope="module")
def loads(spark):
    rng = random.Random(4)
    data = [
        (rng.choice([None, float("nan"), rng.gauss(5, 2), rng.gauss(5, 2), rng.expovariate(0.1)]), rng.choice([None, "a", f"t{i}"]), i, 7)
        for i in range(6000)]
    frame = spark.createDataFrame(data, "x double, name string, k int, same int")
    return [frame.filter("k < 900"), frame.filter("k BETWEEN 900 AND 4999"), frame.filter("k >= 5000"), frame.filter("k < 0")]


def test_merged_profile(spark, loads, tmp_path):
    for i, df in enumerate(loads):
        states.write_states(df, f"{tmp_path}/states", str(i))
    merged = states.merged_states(states.read_states(spark, f"{tmp_path}/states"))
    got = {r.column_name: r for r in states.profile_from(merged).collect()}
    whole = loads[0].unionByName(loads[1]).unionByName(loads[2])
    exact = {r.column_name: r for r in aggregate.numeric_profile(whole).collect()}
    assert (got["same"]["std"], got["same"]["skewness"]) == (0.0, None)
    for c in ("x", "k"):
        for field in ("mean", "std", "min", "max", "skewness", "kurtosis"):
            a, b = got[c][field], exact[c][field]
            assert a == b or math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-4), (c, field)
    assert got["x"]["null_count"] == whole.filter("x IS NULL OR isnan(x)").count() and got["name"]["mean"] is None
    values = sorted(r.x for r in whole.filter("x IS NOT NULL AND NOT isnan(x)").collect())
    for p, field in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
        rank = sum(v <= got["x"][field] for v in values) / len(values)
        assert abs(rank - p) <= states.RANK_ERROR
    for c in ("name", "k"):
        exact_count = whole.select(c).filter(f"{c} IS NOT NULL").distinct().count()
        assert abs(got[c]["distinct_estimate"] - exact_count) <= 4 * states.DISTINCT_ERROR * exact_count
    assert got["same"]["distinct_estimate"] == 1


def test_drift_reads_one_load(spark, loads, tmp_path):
    for i, df in enumerate(loads):
        df.write.parquet(f"{tmp_path}/data/load={i}")
    for i in range(2):
        states.write_states(loads[i], f"{tmp_path}/states", str(i))
    new = states.column_states(spark.read.parquet(f"{tmp_path}/data/load=2"))
    base = states.merged_states(states.read_states(spark, f"{tmp_path}/states"))
    drift = states.drift_from(new, base)
    read = {f.split(f"{tmp_path}/")[1].rsplit("/", 1)[0] for f in drift.inputFiles()}
    assert read == {"data/load=2", "states/load=0", "states/load=1"}
    got = {r.column_name: r for r in drift.collect()}
    old = loads[0].unionByName(loads[1]).agg(F.avg("k"), F.stddev("k")).first()
    now = loads[2].agg(F.avg("k"), F.stddev("k")).first()
    assert math.isclose(got["k"].mean_shift, (now[0] - old[0]) / old[1], rel_tol=1e-9)
    assert math.isclose(got["k"].std_ratio, now[1] / old[1], rel_tol=1e-9)
    assert got["k"].rank_distance > 0.9 and got["x"].rank_distance < 0.1
    assert abs(got["x"].missing_diff) < 0.1 and got["same"].mean_shift is None
    same = {r.column_name: r for r in states.drift_from(base, base).collect()}
    assert same["x"].mean_shift == 0 and same["x"].rank_distance <= 0.03


def test_states_of_nothing(spark, loads):
    empty = states.profile_from(states.merged_states(states.column_states(loads[3])))
    assert rows(empty, "column_name", "rows", "distinct_estimate") == [("k", 0, 0), ("name", 0, 0), ("same", 0, 0), ("x", 0, 0)]
    assert states.column_states(loads[0].select(F.array("k").alias("a"))).count() == 0
