from datetime import datetime, timedelta, timezone

import pytest
from conftest import count_jobs, rows
from pyspark.sql import functions as F

from featurelake.operators.store import STAMP, FeatureStore, merge_latest


@pytest.fixture
def store(spark, base):
    out = FeatureStore(spark, base)
    out.register("g", "id", "ts", "a group", {"team": "x"})
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id int, ts int, val int, part string")


def test_versions(spark, store):
    store.write(frame(spark, [(1, 1, 10, "a")]), "g", "overwrite")
    store.write(frame(spark, [(1, 1, 11, "a"), (2, 1, 22, "b")]), "g", "overwrite")
    assert store.read("g").count() == 2 and rows(store.read("g", version=1), "val") == [(10,)]
    assert rows(store.read("g", columns=["id", "nope"], filter_condition="val > 20")) == [(2,)]
    assert [r["row_count"] for r in store.history("g").collect()] == [1, 2]
    top = store.list_groups().first()
    assert (top["latest_version"], top["total_rows"], top["tags"]) == (2, 2, {"team": "x"})
    diff = {r["column_name"]: r for r in store.compare("g", 1, 2).collect()}
    assert diff["val"]["mean_diff"] == 6.5 and diff["val"]["row_diff"] == 1


def test_errors(spark, store):
    with pytest.raises(ValueError, match="exists"):
        store.register("g", "id", "ts")
    with pytest.raises(ValueError, match="not registered"):
        store.read("other")
    with pytest.raises(ValueError, match="no version"):
        store.read("g")
    store.write(frame(spark, [(1, 1, 10, "a")]), "g", "overwrite")
    with pytest.raises(ValueError, match="no version"):
        store.read("g", version=9)
    with pytest.raises(ValueError, match="several rows"):
        store.upsert(frame(spark, [(1, 1, 1, "a"), (1, 1, 2, "a")]), "g")


def test_as_of(spark, store):
    store.write(frame(spark, [(1, 1, 10, "a")]), "g", "overwrite")
    first = datetime.now(timezone.utc)
    store.write(frame(spark, [(1, 1, 11, "a")]), "g", "overwrite")
    assert rows(store.read("g", as_of=first), "val") == [(10,)]
    with pytest.raises(ValueError):
        store.read("g", as_of=first - timedelta(days=1))


@pytest.mark.parametrize("parts", [None, ["part"]])
def test_upsert(spark, store, parts):
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b"), (3, 1, 30, "c")]), "g", partition_columns=parts)
    store.write(frame(spark, [(2, 1, 21, "b"), (4, 1, 40, "a")]), "g", partition_columns=parts)
    assert rows(store.read("g"), "id", "val", "part") == [(1, 10, "a"), (2, 21, "b"), (3, 30, "c"), (4, 40, "a")]
    assert store.history("g").collect()[-1]["row_count"] == 4
    if parts:
        first, second = store.history("g").collect()
        assert [w["rows"] for w in second["writes"]] == [3, 2] and second["writes"][0] == first["writes"][0]  # nothing is rewritten


def test_upsert_moves_a_row_between_partitions(spark, store):
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")]), "g", partition_columns=["part"])
    store.write(frame(spark, [(1, 1, 11, "b")]), "g", partition_columns=["part"])
    assert rows(store.read("g"), "id", "val", "part") == [(1, 11, "b"), (2, 20, "b")]


def test_partition_values_keep_their_type(spark, store):
    store.write(frame(spark, [(1, 1, 10, "001"), (2, 1, 20, None)]), "g", partition_columns=["part"])
    store.write(frame(spark, [(2, 1, 21, None)]), "g", partition_columns=["part"])
    assert rows(store.read("g"), "id", "val", "part") == [(1, 10, "001"), (2, 21, None)]


def test_append_and_compact(spark, store):
    many = spark.range(100).select(
        F.col("id").cast("int"), F.lit(1).alias("ts"), F.lit(5).alias("val"), F.lit("a").alias("part")).repartition(10)
    store.write(many, "g", "append")
    store.write(many, "g", "append")
    assert store.read("g").count() == 200
    store.compact("g", 2)
    last = store.history("g").collect()[-1]
    assert (last["file_count"], last["row_count"]) == (2, 200) and store.read("g").count() == 200
    assert store.read("g", version=1).count() == 100


def test_failed_write_is_invisible(spark, store):
    store.write(frame(spark, [(1, 1, 10, "a")]), "g", "overwrite")
    broken = frame(spark, [(2, 1, 0, "a")]).withColumn("val", F.lit(1) / F.col("val"))
    with pytest.raises(Exception):
        store.write(broken, "g", "overwrite")
    assert rows(store.read("g"), "id") == [(1,)]
    store.write(frame(spark, [(3, 1, 3, "a")]), "g", "overwrite")
    assert rows(store.read("g"), "id") == [(3,)]


def test_fingerprint_identifies_content(spark, store):
    data = frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")])
    for df in (data, data.orderBy(F.desc("id")), data.withColumn("val", F.col("val") + 1)):
        store.write(df, "g", "overwrite")
    a, b, c = [r["hash_sum"] for r in store.history("g").collect()]
    assert a == b != c


def test_fingerprint_of_a_partly_rewritten_version(spark, store):
    first, change = frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")]), frame(spark, [(2, 1, 21, "b")])
    store.write(first, "g", partition_columns=["part"])
    store.write(change, "g", partition_columns=["part"])
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 21, "b")]), "g", "overwrite")
    a, b, c = [r["hash_sum"] for r in store.history("g").collect()]
    assert b == c != a


def test_deltas_hide_what_came_before_them(spark, store):
    """Upserts and appends in turn: an upsert hides earlier rows of its keys, appended ones too, not later ones."""
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")]), "g", "overwrite")
    store.write(frame(spark, [(1, 1, 11, "a"), (1, 1, 12, "a")]), "g", "append")
    store.write(frame(spark, [(1, 1, 13, "a"), (3, 1, 30, "c")]), "g")
    store.write(frame(spark, [(1, 1, 14, "a")]), "g", "append")
    assert rows(store.read("g"), "id", "val") == [(1, 13), (1, 14), (2, 20), (3, 30)]
    store.write(frame(spark, [(2, 1, 21, "b")]), "g")
    assert rows(store.read("g"), "id", "val") == [(1, 13), (1, 14), (2, 21), (3, 30)]
    assert rows(store.read("g", version=3), "id", "val") == [(1, 13), (2, 20), (3, 30)]
    before = store.history("g").collect()
    assert [r["row_count"] for r in before] == [2, 4, 3, 4, 4]
    store.compact("g", 1)
    last = store.history("g").collect()[-1]
    assert len(last["writes"]) == 1 and (last["row_count"], last["hash_sum"]) == (4, before[-1]["hash_sum"])
    assert rows(store.read("g"), "id", "val") == [(1, 13), (1, 14), (2, 21), (3, 30)]


def test_repeated_keys_and_folding(spark, store):
    for k in range(5):
        source = frame(spark, [(1, 1, k, "a"), (1, 1, k + 100, "b"), (k, 2, k, None), (k, 2, k, None)])
        store.upsert(source, "g", order_by=["val"], fold_after=3, count=k != 1)
    assert rows(store.read("g"), "id", "ts", "val") == [(0, 2, 0), (1, 1, 104), (1, 2, 1), (2, 2, 2), (3, 2, 3), (4, 2, 4)]
    found = [(r["operation"], r["row_count"], sum(w["delta"] for w in r["writes"])) for r in store.history("g").collect()]
    assert found == [("merge", 2, 1), ("merge", None, 2), ("merge", None, 3), ("merge", None, 4), ("compact", 5, 0), ("merge", 6, 1)]
    with pytest.raises(ValueError, match="change types"):
        store.write(frame(spark, [(9, 9, 9, "z")]).withColumn("val", F.lit("text")), "g")
    store.write(frame(spark, [(9, 9, 9, "z")]).withColumn("more", F.lit(1.5)).drop("part"), "g")
    assert rows(store.read("g"), "id", "part", "more")[-1] == (9, None, 1.5)


def test_two_writers(spark, store, monkeypatch):
    """The second writer commits while the first is writing; both versions survive, with facts that fit."""
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")]), "g", "overwrite")
    other, write = FeatureStore(spark, store.base), FeatureStore._write

    def late(self, *args, **options):
        made = write(self, *args, **options)
        if self is store:
            other.write(frame(spark, [(2, 1, 22, "b"), (3, 1, 30, "c")]), "g")
        return made

    monkeypatch.setattr(FeatureStore, "_write", late)
    info = store.write(frame(spark, [(3, 1, 33, "c"), (4, 1, 40, "d")]), "g")
    assert (info.version, info.row_count) == (3, 4)
    assert rows(store.read("g"), "id", "val") == [(1, 10), (2, 22), (3, 33), (4, 40)]
    assert rows(store.read("g", version=2), "id", "val") == [(1, 10), (2, 22), (3, 30)]
    store.write(frame(spark, [(5, 1, 50, "a")]), "g", "append")
    assert [r["row_count"] for r in store.history("g").collect()] == [2, 3, 4, 4, 5]


def test_commits_are_exclusive(spark, store):
    """Many threads create versions at once: every number is given out once."""
    from concurrent.futures import ThreadPoolExecutor

    made = {"id": "x", "delta": False, "files": 1, "bytes": 1, "rows": 1, "hash": 1}
    schema = frame(spark, []).schema
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda k: store._commit("g", {"version": k % 4}, "append", made, schema, []), range(32)))
    assert sorted(v.version for v in found if v) == [1, 2, 3, 4]


def test_upsert_jobs(spark, store):
    store.write(frame(spark, [(1, 1, 10, "a"), (2, 1, 20, "b")]), "g")
    assert count_jobs(spark, lambda: store.write(frame(spark, [(2, 1, 21, "b")]), "g")) < 12


def test_point_in_time_from_store(spark, store):
    store.register("h", "id", "at")
    store.write(frame(spark, [(1, 1, 10, "a"), (1, 5, 50, "a")]), "g", "overwrite")
    store.write(spark.createDataFrame([(1, 2, 7.0)], "id int, at int, score double"), "h", "overwrite")
    e = spark.createDataFrame([(1, 1), (1, 6), (2, 6)], "id int, event_ts int")
    got = store.point_in_time_join(e, ["g", "h"], "id", "event_ts", {"g": ["val"]})
    assert got.columns == ["id", "event_ts", "g_val", "h_score"]
    assert rows(got) == [(1, 1, 10, None), (1, 6, 50, 7.0), (2, 6, None, None)]
    assert STAMP in store.read("g").columns


def test_merge_latest_is_idempotent(spark):
    target = frame(spark, [(1, 1, 10, "a")])
    source = frame(spark, [(1, 2, 11, "a"), (1, 3, 12, "a"), (2, 1, 20, "b")])
    once = merge_latest(target, source, "id", "ts")
    assert rows(once) == rows(merge_latest(once, source, "id", "ts")) == [(1, 3, 12, "a"), (2, 1, 20, "b")]
