"""Known answers and edge cases of cleaning, encoding and scalar functions."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import count_jobs, plan, rows
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.functions import encoding, scalars
from featurelake.operators import aggregate, clean, features


def one(spark, values, kind="double", name="a"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def test_dedupe_on_subset(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 30)], "id int, value int")
    assert rows(clean.dedupe(df, "id")) == [(1, 10), (2, 20), (3, 30)]
    assert clean.dedupe(df).count() == 3


def test_dedupe_limits_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert "WindowGroupLimit" in plan(clean.dedupe(df, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@pytest.mark.parametrize("strategy,values,want", [
    ("median", [1.0, None, 3.0, None, 5.0], 3.0), ("mean", [2.0, None, 4.0], 3.0),
    ("mode", [2.0, 1.0, 2.0, 1.0, None], 1.0), ("zero", [2.0, None], 0.0), ("mode", [None, None], 0.0),
])
def test_fill(spark, strategy, values, want):
    out = clean.fill_nulls(one(spark, values), strategy)
    assert [r["a"] for r in out.collect()] == [want if v is None else v for v in values]


def test_fill_skips_nan_and_all_null(spark):
    df = spark.createDataFrame([(float("nan"), None), (2.0, None), (4.0, None)], "a double, b double")
    assert rows(clean.fill_nulls(df, "mean")) == [(2.0, None), (3.0, None), (4.0, None)]
    assert clean.fill_nulls(df.limit(0), "median").count() == 0


def test_fill_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    out = clean.fill_nulls(df, "median")
    assert out.schema["a"].dataType == T.IntegerType() and rows(out) == [(1,), (2,), (3,)]


def test_fill_along_needs_keys(spark):
    with pytest.raises(ValueError, match="partition_by"):
        clean.fill_nulls(one(spark, [1.0]), "ffill")


def test_fit_on_train_apply_to_test(spark):
    train, test = one(spark, [1.0, 2.0, 3.0]), one(spark, [None, 10.0])
    assert rows(clean.apply_fill(test, clean.fit_fill(train, "median"))) == [(10.0,), (2.0,)]
    params = clean.fit_scale(train)
    assert rows(clean.apply_scale(test, params))[0] == (8.0,)


def test_clip_iqr(spark):
    values = list(np.random.RandomState(0).normal(100, 10, 100)) + [500.0, -200.0, None]
    out = [r["a"] for r in clean.clip_outliers(one(spark, [None if v is None else float(v) for v in values])).collect()]
    assert max(v for v in out if v is not None) < 500 and min(v for v in out if v is not None) > -200
    assert out.count(None) == 1


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_constant_column(spark, method):
    df = one(spark, [4.0, 4.0])
    assert rows(clean.normalize_columns(df, method=method)[0]) == [(4.0,), (4.0,)]
    assert rows(clean.scale_features(df, method=method)[0]) == [(0.0,), (0.0,)]


def test_normalize_standard(spark):
    values = np.random.RandomState(0).normal(50, 10, 100)
    out, params = clean.normalize_columns(one(spark, [float(v) for v in values]))
    got = out.agg(F.avg("a"), F.stddev_samp("a")).first()
    assert abs(got[0]) < 1e-9 and abs(got[1] - 1) < 1e-9
    assert math.isclose(params["a"]["mean"], values.mean())
    assert clean.parameter_frame(spark, params).count() == 4


def test_filter_rules(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, c string")
    assert clean.filter_rows(df, {}).count() == 3
    assert rows(clean.filter_rows(df, {"c": ("not_in", ["x"])}), "id") == [(3,)]
    assert rows(clean.filter_rows(df, {"id": ("==", 1), "c": "y"}, "or"), "id") == [(1,), (3,)]
    with pytest.raises(ValueError, match="operator"):
        clean.filter_rows(df, {"id": ("like", 1)})


def test_cast_modes(spark):
    df = spark.createDataFrame([("1", "2024-01-02", "true"), ("x", "bad", "maybe")], "n string, t string, b string")
    got = clean.cast_types(df, {"n": "int", "t": "datetime", "b": "bool", "none": "int"})
    assert [f.dataType for f in got.schema] == [T.LongType(), T.TimestampType(), T.BooleanType()]
    assert got.filter("n IS NULL AND t IS NULL AND b IS NULL").count() == 1
    kept = clean.cast_types(df, {"n": "int"}, errors="ignore")
    assert kept.schema["n"].dataType == T.StringType()
    with pytest.raises(PySparkException):
        clean.cast_types(df, {"n": "int"}, errors="raise").collect()


def test_cast_number_text(spark):
    assert rows(clean.cast_types(one(spark, ["3.0", "4", "2.5", None], "string"), {"a": "int"})) == [
        (3,), (4,), (None,), (None,)]


def test_derive_with_pandas_udf(spark):
    @F.pandas_udf("double")
    def half(s: pd.Series) -> pd.Series:
        return s / 2

    out = clean.derive_columns(one(spark, [4.0]), {"h": half("a"), "d": "a * 2", "f": lambda df: df.a + 1})
    assert rows(out) == [(4.0, 2.0, 8.0, 5.0)]
    with pytest.raises(PySparkException):
        clean.derive_columns(one(spark, [4.0]), {"bad": "no_such + 1"})


def test_clean_data_counts_without_a_count_job(spark):
    from pyspark.sql import Observation

    spark = spark.newSession()  # see clean_data on Observations and logistic regression
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, 5)], "a int, b int")
    before, after = Observation(), Observation()
    out = clean.clean_data(df, observe=(before, after))
    assert rows(out) == [(1, None), (2, 5)]
    assert (before.get["rows"], after.get["rows"]) == (4, 2)


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert clean.drop_null_columns(df).columns == ["a"]


def test_concat_fills_missing(spark):
    out = clean.concat_batches(one(spark, [1.0]), one(spark, [2.0], name="b"))
    assert rows(out) == [(1.0, None), (None, 2.0)]


def test_aggregate_known_answer(spark):
    df = spark.createDataFrame([("a", 10), ("a", 20), ("b", 30), ("b", 40), (None, 1)], "g string, value int")
    out = aggregate.aggregate(df, "g", {"value": ["sum", "mean"]}, drop_null_keys=True)
    assert rows(out) == [("a", 30, 15.0), ("b", 70, 35.0)]
    assert aggregate.aggregate(df, "g", {"value": ["sum"]}).count() == 3
    with pytest.raises(ValueError, match="order_by"):
        aggregate.aggregate(df, "g", {"value": ["first"]})


def test_profile_of_empty_and_null(spark):
    df = spark.createDataFrame([], "a double, c string")
    assert rows(aggregate.null_profile(df), "column_name", "null_count") == [("a", 0), ("c", 0)]
    assert aggregate.numeric_profile(df).first()["mean"] is None
    full = aggregate.data_profile(spark.createDataFrame([(1.0, "x"), (None, "x")], "a double, c string"))
    got = {(r["column_name"], r["section"], r["field"]): r["value"] for r in full.collect()}
    assert got[("a", "nulls", "null_pct")] == "50.0" and got[("c", "top_values", "x")] == "2"


def test_skew_kurtosis_match_pandas(spark):
    values = [1.0, 2.0, 2.5, 9.0, 11.0, 3.0]
    row = aggregate.numeric_profile(one(spark, values)).first()
    s = pd.Series(values)
    assert row["skewness"] == round(s.skew(), 4) and row["kurtosis"] == round(s.kurtosis(), 4)


def test_profile_of_constants(spark):
    row = aggregate.numeric_profile(one(spark, [2.0, 2.0, 2.0, 2.0])).first()
    assert row["std"] == 0.0 and row["mean"] == 2.0
    assert aggregate.numeric_profile(one(spark, [2.0])).first()["skewness"] is None


def test_temporal(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-06 13:05:00' AS ts")
    got = scalars.temporal_features(df, "ts").first().asDict()
    assert (got["ts_day_of_week"], got["ts_is_weekend"], got["ts_hour"], got["ts_week_of_year"]) == (5, 1, 13, 1)
    assert scalars.temporal_features(df, "ts", ["hour", "nope"]).columns == ["ts", "ts_hour"]


def test_interaction_and_ratio(spark):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a int, b int")
    assert [r[2] for r in scalars.interaction_features(df, [("a", "b")]).collect()] == [4, 10, 18]
    df = spark.createDataFrame([(10.0, 2.0), (20.0, 5.0) , (30.0, 0.0), (1.0, None)], "num double, den double")
    got = [r["num_per_den"] for r in scalars.ratio_features(df, [("num", "den")], 7.0).collect()]
    assert got == [5.0, 4.0, 7.0, None]


def test_arrays(spark):
    df = spark.createDataFrame([(1, ["x", "y"], [1.0, 2.0]), (2, None, None)], "id int, n array<string>, v array<double>")
    assert rows(scalars.widen_features(df, "n", "v", ["y", "z"]), "id", "y", "z") == [(1, 2.0, None), (2, None, None)]
    assert rows(scalars.melt_features(df, "id", "n", "v")) == [(1, "x", 1.0), (1, "y", 2.0)]
    assert df.select(scalars.named_features("n", "v")).first()[0] == {"x": 1.0, "y": 2.0}


def test_padded_id_keeps_long_numbers(spark):
    df = spark.createDataFrame([(1,), (1234567,)], "id bigint")
    assert [r[0] for r in df.select(scalars.padded_id("user_", "id")).collect()] == ["user_000001", "user_1234567"]


def test_fingerprint_ignores_row_order(spark):
    df = spark.range(50).select("id", F.when(F.col("id") % 3 > 0, F.col("id") * 1.5).alias("x"))
    a = scalars.content_fingerprint(df).first()
    assert a == scalars.content_fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a != scalars.content_fingerprint(df.withColumn("x", F.col("x") + 1)).first()
    assert scalars.content_fingerprint(df.limit(0)).first()["row_count"] == 0


def test_label_encoding(spark):
    df = one(spark, ["red", "blue", "green", "red", "blue", None], "string", "color")
    assert [r[1] for r in sorted(encoding.encode_label(df, "color").collect(), key=str)] .count(None) == 1
    codes = dict(rows(encoding.encode_label(df, "color").distinct()))
    assert codes == {"blue": 0, "green": 1, "red": 2, None: None}


def test_index_encoding_matches_ml(spark):
    df = one(spark, ["b", "a", "b", "c", "a", None], "string", "color").repartition(3)
    indexer = StringIndexer(inputCol="color", outputCol="color_indexed", handleInvalid="keep")
    assert rows(encoding.encode_index(df, "color")) == rows(indexer.fit(df).transform(df))
    encoder = OneHotEncoder(inputCol="color_indexed", outputCol="color_encoded")
    want = Pipeline(stages=[indexer, encoder]).fit(df)
    out, fitted = encoding.encode_categorical(df, "color", "onehot")
    assert rows(out) == rows(want.transform(df))
    new = one(spark, ["c", "new", None], "string", "color")
    assert rows(fitted.transform(new)) == rows(want.transform(new))
    no_null = df.filter("color IS NOT NULL")
    assert rows(encoding.encode_categorical(no_null, "color", "onehot")[0]) == rows(
        Pipeline(stages=[indexer, encoder]).fit(no_null).transform(no_null))


def test_modes_in_one_round(spark):
    data = [(1, 2.5, "b", None, True), (1, 2.5, "a", None, False), (2, float("nan"), "a", None, False), (None, 1.5, "b", None, None), (2, 1.5, None, None, None)]
    df = spark.createDataFrame(data, "i int, x double, s string, n long, b boolean")
    assert clean.modes(df, df.columns) == {"i": 1, "x": 1.5, "s": "a", "n": 0, "b": False}
    assert clean.modes(df, []) == {} and count_jobs(spark, lambda: clean.modes(df, df.columns)) <= 3


def test_onehot_columns(spark):
    df = one(spark, ["red", "blue", None], "string", "color")
    out = encoding.encode_onehot_columns(df, "color", drop_original=True)
    assert out.columns == ["color_blue", "color_red"] and rows(out) == [(0, 0), (0, 1), (1, 0)]
    fitted = encoding.encode_onehot_columns(df, "color", {"color": ["red", "teal"]})
    assert fitted.columns == ["color", "color_red", "color_teal"]
    with pytest.raises(ValueError, match="more than"):
        encoding.categories(df, "color", 1)


def test_unseen_category_on_new_data(spark):
    codes = encoding.fit_codes(one(spark, ["a", "b"], "string"), "a")
    got = encoding.apply_codes(one(spark, ["b", "zz", None], "string"), codes, "a", "code", unseen=-1)
    assert rows(got) == [("b", 1), ("zz", -1), (None, -1)]


def test_assemble_keeps_null_as_nan(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    out, model = encoding.assemble_features(df, ["a", "b"])
    got = [r[0] for r in out.select(vector_to_array("features")).collect()]
    assert math.isnan(got[0][1]) and got[1] == [2.0, 3.0]
    assert model.transform(df.limit(1)).count() == 1


def test_select_features(spark):
    rng = np.random.RandomState(0)
    data = [(float(v), 1.0, f"t{i}", float(v) + 0.1 * float(rng.rand())) for i, v in enumerate(rng.normal(0, 5, 50))]
    df = spark.createDataFrame(data, "high_var double, low_var double, note string, target double")
    out, chosen = features.select_features(df, "target", "variance", threshold=0.01)
    assert chosen == ["high_var"] and out.columns == ["note", "high_var", "target"]
    assert features.select_features(df, "target", "correlation", threshold=0.5)[1] == ["high_var"]
    assert features.select_features(df, "target", "first", top_k=1)[1] == ["high_var"]
