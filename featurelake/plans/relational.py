"""Queries over joins, aggregation, profiles, windows, sorting and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import encoding, scalars
from ..operators import aggregate as agg
from ..operators import features, joins, states
from .registry import SPARSE_SQL, query, rounded, scratch, sparse_events, table

# --- joins ---------------------------------------------------------------------------------


def _join(spark, d, how):
    """Customers against orders under doubled numbers: both sides have rows without partner."""
    left = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    right = table(spark, d, "orders").select(
        (F.col("o_custkey") * 2).alias("key"), F.col("o_totalprice").alias("amount"), "o_orderkey")
    return joins.join(left, right, on="key", how=how)


for _how, _sql in (("inner", "JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN"), ("outer", "FULL JOIN")):

    @query(
        f"join_{_how}",
        f"""SELECT coalesce(l.key, r.key) AS key, l.amount, r.amount AS amount_right, r.o_orderkey
            FROM (SELECT c_custkey AS key, c_acctbal AS amount FROM customer) l
            {_sql} (SELECT o_custkey * 2 AS key, o_totalprice AS amount, o_orderkey FROM orders) r ON l.key = r.key""",
    )
    def join(spark, d, how=_how):
        return _join(spark, d, how)


@query(
    "join_on_pair",
    """SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_mktsegment, n.n_name
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_on_pair(spark, d):
    rows = joins.join(table(spark, d, "orders"), table(spark, d, "customer"), left_on="o_custkey", right_on="c_custkey")
    rows = joins.join(rows, table(spark, d, "nation"), left_on="c_nationkey", right_on="n_nationkey")
    return rows.select("o_orderkey", "o_custkey", "c_custkey", "c_mktsegment", "n_name")


@query(
    "join_group_stats",
    """SELECT l_orderkey, l_linenumber, l_quantity, round(avg(l_quantity) OVER w, 6) AS l_quantity_grp_mean,
         count(l_quantity) OVER w AS l_quantity_grp_count
       FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""",
)
def join_group_stats(spark, d):
    out = agg.group_features(table(spark, d, "lineitem"), "l_suppkey", "l_quantity", ["mean", "count"])
    return rounded(out, 6, "l_quantity_grp_mean").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_quantity_grp_mean", "l_quantity_grp_count")


def _view(spark, d, kind):
    rows = table(spark, d, "events").filter(F.col("event_type") == kind)
    rows = rows.select("user_id", "ts", F.col("value").alias("amount"), F.col("event_id").alias("source_id"))
    return joins.FeatureView(kind, rows, "ts", ["amount", "source_id"])


def _buys(spark, d):
    return table(spark, d, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")


ASOF = "ASOF LEFT JOIN (SELECT user_id, ts, value, event_id FROM events WHERE event_type = '{k}') {k} ON e.user_id = {k}.user_id AND e.ts >= {k}.ts"


@query(
    "point_in_time_join",
    f"""SELECT e.event_id, e.user_id, e.ts, view.value AS amount, view.event_id AS source_id
        FROM (SELECT * FROM events WHERE event_type = 'purchase') e {ASOF.format(k='view')}""",
)
def point_in_time_join(spark, d):
    return joins.point_in_time_join(_buys(spark, d), _view(spark, d, "view"), "user_id", "ts")


@query(
    "training_set",
    f"""SELECT e.event_id, e.user_id, e.ts, view.value AS view_amount, view.event_id AS view_source_id,
          click.value AS click_amount, click.event_id AS click_source_id
        FROM (SELECT * FROM events WHERE event_type = 'purchase') e {ASOF.format(k='view')} {ASOF.format(k='click')}""",
)
def training_set(spark, d):
    views = [_view(spark, d, "view"), _view(spark, d, "click")]
    return joins.training_set(_buys(spark, d), views, "user_id", "ts")


# --- aggregation ---------------------------------------------------------------------------


@query(
    "aggregate",
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS l_quantity_count,
         round(sum(l_quantity), 2) AS l_quantity_sum, round(avg(l_extendedprice), 4) AS l_extendedprice_mean,
         min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max,
         round(stddev_samp(l_extendedprice), 4) AS l_extendedprice_std, round(var_samp(l_quantity), 4) AS l_quantity_var,
         round(quantile_cont(l_extendedprice, 0.5), 4) AS l_extendedprice_median,
         count(DISTINCT l_suppkey) AS l_suppkey_nunique
       FROM lineitem GROUP BY 1, 2""",
)
def aggregate(spark, d):
    out = agg.aggregate(
        table(spark, d, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "l_quantity": ["count", "sum", "var"],
            "l_extendedprice": ["mean", "min", "max", "std", "median"],
            "l_suppkey": ["nunique"],
        },
    )
    out = rounded(out, 4, "l_extendedprice_mean", "l_extendedprice_std", "l_quantity_var", "l_extendedprice_median")
    return rounded(out, 2, "l_quantity_sum")


@query(
    "aggregate_first_last",
    """SELECT user_id, arg_min(value, event_id) AS value_first, arg_max(value, event_id) AS value_last,
         arg_max(event_type, event_id) AS event_type_last FROM events GROUP BY 1""",
)
def aggregate_first_last(spark, d):
    return agg.aggregate(
        table(spark, d, "events"), "user_id", {"value": ["first", "last"], "event_type": ["last"]}, ["event_id"])


@query(
    "group_features",
    """SELECT event_id, user_id, round(avg(value) OVER w, 6) AS value_grp_mean, round(sum(value) OVER w, 4) AS value_grp_sum,
         count(value) OVER w AS value_grp_count, min(value) OVER w AS value_grp_min, max(value) OVER w AS value_grp_max,
         round(stddev_samp(value) OVER w, 6) AS value_grp_stddev
       FROM events WINDOW w AS (PARTITION BY user_id)""",
)
def group_features(spark, d):
    out = agg.group_features(
        table(spark, d, "events"), "user_id", "value", ["mean", "sum", "count", "min", "max", "stddev"])
    out = rounded(rounded(out, 6, "value_grp_mean", "value_grp_stddev"), 4, "value_grp_sum")
    return out.drop("ts", "event_type", "value", "props")


@query(
    "null_profile",
    f"""WITH {SPARSE_SQL}, c AS (SELECT count(*) AS n, count(event_id) AS a, count(ts) AS b, count(user_id) AS c,
          count(event_type) AS e, count(value) AS f FROM sparse),
        l AS (SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value']) AS column_name,
                unnest([n - a, n - b, n - c, n - e, n - f]) AS null_count, n FROM c)
        SELECT column_name, null_count, round(null_count * 100.0::DOUBLE / n, 2) AS null_pct FROM l""",
)
def null_profile(spark, d):
    return agg.null_profile(sparse_events(spark, d))


def _stats_sql(col):
    return f"""SELECT '{col}' AS column_name, round(avg({col}), 4) AS mean, round(stddev_samp({col}), 4) AS std,
      round(min({col}), 4) AS min, round(max({col}), 4) AS max, round(quantile_cont({col}, 0.5), 4) AS median,
      round(skewness({col}), 4) AS skewness, round(kurtosis({col}), 4) AS kurtosis FROM lineitem"""


@query(
    "numeric_profile",
    " UNION ALL ".join(_stats_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)
def numeric_profile(spark, d):
    return agg.numeric_profile(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def _top_sql(col, t="orders"):
    return f"""SELECT '{col}' AS column_name, {col} AS value, count(*) AS n,
      row_number() OVER (ORDER BY count(*) DESC, {col})::INTEGER AS rank,
      count(*) OVER () AS unique_count FROM {t} GROUP BY {col} QUALIFY rank <= 5"""


@query("categorical_profile", " UNION ALL ".join(f"({_top_sql(c)})" for c in ("o_orderstatus", "o_orderpriority")))
def categorical_profile(spark, d):
    return agg.categorical_profile(table(spark, d, "orders"))


@query(
    "data_profile",
    """WITH s AS (SELECT count(*)::VARCHAR AS n, count(DISTINCT s_name)::VARCHAR AS u FROM supplier),
       cols AS (SELECT unnest(['s_suppkey', 's_name', 's_nationkey', 's_acctbal']) AS c,
                       unnest(['bigint', 'string', 'int', 'double']) AS t)
       SELECT NULL::VARCHAR AS column_name, 'shape' AS section, 'rows' AS field, n AS value FROM s
       UNION ALL SELECT NULL, 'shape', 'columns', '4'
       UNION ALL SELECT c, 'dtype', 'type', t FROM cols
       UNION ALL SELECT c, 'nulls', 'null_count', '0' FROM cols
       UNION ALL SELECT c, 'nulls', 'null_pct', '0.0' FROM cols
       UNION ALL SELECT 's_name', 'categorical', 'unique_count', u FROM s
       UNION ALL (SELECT 's_name', 'top_values', s_name, count(*)::VARCHAR FROM supplier GROUP BY s_name
                  ORDER BY count(*) DESC, s_name LIMIT 5)
       UNION ALL SELECT NULL, 'shape', 'bytes', 'some'
       UNION ALL SELECT c, 'numeric', unnest(['mean', 'std', 'min', 'max', 'median', 'skewness', 'kurtosis']), unnest([
         round(avg(x), 4)::VARCHAR, round(stddev_samp(x), 4)::VARCHAR, round(min(x), 4)::VARCHAR, round(max(x), 4)::VARCHAR,
         round(quantile_cont(x, 0.5), 4)::VARCHAR, (round(skewness(x), 4) + 0.0)::VARCHAR, (round(kurtosis(x), 4) + 0.0)::VARCHAR])
       FROM (SELECT unnest(['s_suppkey', 's_nationkey', 's_acctbal']) AS c, unnest([s_suppkey::DOUBLE, s_nationkey::DOUBLE, s_acctbal]) AS x
             FROM supplier) GROUP BY c""",
)
def data_profile(spark, d):
    """The full profile; of the bytes, which SQL does not know, that there are some."""
    out = agg.data_profile(table(spark, d, "supplier"))
    some = F.when(F.col("field") == "bytes", F.when(F.col("value").cast("long") > 0, "some"))
    zero = F.when(F.col("value") == "-0.0", "0.0")
    return out.withColumn("value", F.coalesce(some, zero, F.col("value")))


@query(
    "distinct_count",
    "SELECT count(DISTINCT l_partkey) AS l_partkey_distinct, count(DISTINCT l_suppkey) AS l_suppkey_distinct FROM lineitem",
)
def distinct_count(spark, d):
    return agg.distinct_count(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "join_null_safe",
    f"""WITH {SPARSE_SQL}, n AS (SELECT event_type, count(*) AS n FROM sparse GROUP BY 1)
        SELECT event_id, s.event_type, n FROM sparse s JOIN n ON s.event_type IS NOT DISTINCT FROM n.event_type""",
)
def join_null_safe(spark, d):
    """NULL keys meet, and keys of over 100 rows are salted."""
    events = sparse_events(spark, d).select("event_id", "event_type")
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return joins.join(events, counts, "event_type", null_safe=True, hot_rows=100).select("event_id", "event_type", "n")


@query(
    "aggregate_drop_null_keys",
    f"""WITH {SPARSE_SQL} SELECT event_type, count(DISTINCT user_id) AS user_id_nunique, count(DISTINCT value) AS value_nunique,
          round(quantile_cont(value, 0.5), 6) AS value_median, count(value) AS value_count
        FROM sparse WHERE event_type IS NOT NULL GROUP BY event_type""",
)
def aggregate_drop_null_keys(spark, d):
    out = agg.aggregate(
        sparse_events(spark, d), "event_type", {"user_id": ["nunique"], "value": ["nunique", "median", "count"]}, drop_null_keys=True)
    return rounded(out, 6, "value_median")


def order_loads(spark, d):
    """Line items as two loads, by the parity of the order."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    return [lines.filter(F.col("l_orderkey") % 2 == k) for k in (0, 1)]


@query(
    "incremental_profile",
    """SELECT c AS column_name, count(*) AS rows, 0::BIGINT AS null_count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
         round(min(x), 4) AS min, round(max(x), 4) AS max, round(skewness(x), 3) AS skewness, round(kurtosis(x), 3) AS kurtosis
       FROM (SELECT unnest(['l_quantity', 'l_extendedprice']) AS c, unnest([l_quantity, l_extendedprice]) AS x FROM lineitem)
       GROUP BY c""",
)
def incremental_profile(spark, d):
    """The profile of all loads from the states written beside each; quantiles and distinct counts are estimates and left out."""
    folder = scratch(spark, "states")
    for k, load in enumerate(order_loads(spark, d)):
        states.write_states(load, folder, str(k), ["l_quantity", "l_extendedprice"])
    out = states.profile_from(states.merged_states(states.read_states(spark, folder)))
    names = ["column_name", "rows", "null_count", "mean", "std", "min", "max"]
    return out.select(*names, F.round("skewness", 3).alias("skewness"), F.round("kurtosis", 3).alias("kurtosis"))


@query(
    "incremental_drift",
    """WITH l AS (SELECT l_orderkey % 2 AS k, unnest(['l_quantity', 'l_extendedprice']) AS c, unnest([l_quantity, l_extendedprice]) AS x
         FROM lineitem),
       s AS (SELECT c, k, count(*) AS n, avg(x) AS m, stddev_samp(x) AS sd FROM l GROUP BY c, k)
       SELECT b.c AS column_name, b.n AS rows, a.n AS base_rows, round((b.m - a.m) / a.sd, 6) AS mean_shift,
         round(b.sd / a.sd, 6) AS std_ratio, 0.0::DOUBLE AS missing_diff, true AS ranks_agree
       FROM s a JOIN s b ON a.c = b.c AND a.k = 0 AND b.k = 1""",
)
def incremental_drift(spark, d):
    """A new load against the written state of the one before; only the new load is read. Both loads are alike in rank."""
    before, new = order_loads(spark, d)
    folder = scratch(spark, "states")
    states.write_states(before, folder, "0", ["l_quantity", "l_extendedprice"])
    out = states.drift_from(states.column_states(new, ["l_quantity", "l_extendedprice"]), states.merged_states(states.read_states(spark, folder)))
    close = F.col("rank_distance") <= 2 * states.RANK_ERROR + 0.05
    return rounded(out.withColumn("ranks_agree", close).drop("rank_distance"), 6, "mean_shift", "std_ratio", "missing_diff")


@query(
    "correlation_with_target",
    """SELECT 'l_quantity' AS column_name, round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem
       UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM lineitem
       UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM lineitem""",
)
def correlation_with_target(spark, d):
    out = agg.correlation_with_target(
        table(spark, d, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return rounded(out, 6, "correlation")


@query(
    "variances",
    """SELECT 'l_quantity' AS column_name, round(var_samp(l_quantity), 6) AS variance FROM lineitem
       UNION ALL SELECT 'l_discount', round(var_samp(l_discount), 6) FROM lineitem
       UNION ALL SELECT 'l_tax', round(var_samp(l_tax), 6) FROM lineitem""",
)
def variances(spark, d):
    return rounded(agg.variances(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]), 6, "variance")


@query(
    "value_frequency",
    "SELECT l_suppkey, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS frequency FROM lineitem GROUP BY 1",
)
def value_frequency(spark, d):
    return rounded(agg.value_frequency(table(spark, d, "lineitem"), "l_suppkey"), 9, "frequency")


@query(
    "drift_report",
    """WITH s AS (SELECT year(o_orderdate)::INTEGER AS batch, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std
         FROM orders GROUP BY 1), b AS (SELECT * FROM s WHERE batch = 1996)
       SELECT s.batch, 'o_totalprice' AS column_name, round(s.mean, 4) AS mean, round(s.std, 4) AS std,
         round(b.mean, 4) AS base_mean, round(b.std, 4) AS base_std, round((s.mean - b.mean) / b.std, 6) AS mean_shift,
         round(s.std / b.std, 6) AS std_ratio FROM s, b""",
)
def drift_report(spark, d):
    out = agg.drift_report(table(spark, d, "orders"), F.year("o_orderdate"), "o_totalprice", 1996)
    return rounded(rounded(out, 4, "mean", "std", "base_mean", "base_std"), 6, "mean_shift", "std_ratio")


# --- windows ------------------------------------------------------------------------------


@query(
    "rolling_mean",
    """SELECT event_id, round(avg(value) OVER (w ROWS 2 PRECEDING), 6) AS value_w3_mean,
         round(avg(value) OVER (w ROWS 9 PRECEDING), 6) AS value_w10_mean
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def rolling_mean(spark, d):
    out = features.rolling_features(
        table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", [3, 10], ["mean"])
    return rounded(out, 6, "value_w3_mean", "value_w10_mean").select("event_id", "value_w3_mean", "value_w10_mean")


for _fn, _call in (("sum", "sum"), ("min", "min"), ("max", "max"), ("stddev", "stddev_samp"), ("count", "count")):

    @query(
        f"rolling_{_fn}",
        f"""SELECT event_id, {f'round({_call}(value) OVER w, 6)' if _fn in ('sum', 'stddev') else f'{_call}(value) OVER w'}
              AS value_w7_{_fn}
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 6 PRECEDING)""",
    )
    def rolling(spark, d, fn=_fn):
        out = features.rolling_features(table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", 7, [fn])
        name = f"value_w7_{fn}"
        return (rounded(out, 6, name) if fn in ("sum", "stddev") else out).select("event_id", name)


@query(
    "lag_features",
    """SELECT event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 7) OVER w AS value_lag_7
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_features(spark, d):
    out = features.lag_features(
        table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", [1, 7], with_diff=False)
    return out.select("event_id", "value_lag_1", "value_lag_7")


@query(
    "diff_features",
    """SELECT event_id, round(value - lag(value, 1) OVER w, 6) AS value_diff_1, round(value - lag(value, 3) OVER w, 6) AS value_diff_3
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def diff_features(spark, d):
    out = features.lag_features(table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", [1, 3])
    return rounded(out, 6, "value_diff_1", "value_diff_3").select("event_id", "value_diff_1", "value_diff_3")


@query("last_observation", "SELECT user_id, arg_max(value, (ts, event_id)) AS value_last FROM events GROUP BY 1")
def last_observation(spark, d):
    return features.last_observation(table(spark, d, "events"), "user_id", ["ts", "event_id"], "value")


# --- sort, top-k, selection ------------------------------------------------------------------


@query("sort_series", "SELECT user_id, ts, event_id, value FROM events ORDER BY user_id, ts, event_id")
def sort_series(spark, d):
    return features.sort_series(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select(
        "user_id", "ts", "event_id", "value")


@query(
    "top_values",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def top_values(spark, d):
    return features.top_values(table(spark, d, "lineitem"), "l_partkey", 5)


def _select_sql(score, cols):
    parts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {score.format(c=c)} AS score FROM lineitem" for c in cols)
    return f"""SELECT column_name, row_number() OVER (ORDER BY score DESC, column_name)::INTEGER AS position
      FROM ({parts}) WHERE score >= {{t}} ORDER BY score DESC, column_name LIMIT 3"""


CANDIDATES = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey")


def _selected(spark, d, method, threshold):
    rows = table(spark, d, "lineitem").select(*CANDIDATES, "l_extendedprice")
    _, names = features.select_features(rows, "l_extendedprice", method, 3, threshold)
    return spark.createDataFrame([(n, i) for i, n in enumerate(names, 1)], "column_name string, position int")


@query(
    "select_features_correlation",
    _select_sql("abs(corr({c}, l_extendedprice))", CANDIDATES).format(t=0.0001),
)
def select_features_correlation(spark, d):
    return _selected(spark, d, "correlation", 0.0001)


@query("select_features_variance", _select_sql("var_samp({c})", CANDIDATES).format(t=0.01))
def select_features_variance(spark, d):
    return _selected(spark, d, "variance", 0.01)


@query(
    "latest_per_user",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)::INTEGER AS rank
       FROM events QUALIFY rank <= 5""",
)
def latest_per_user(spark, d):
    out = features.latest_per_key(table(spark, d, "events"), "user_id", ["ts", "event_id"], 5)
    return out.select("event_id", "user_id", "rank")


@query(
    "latest_of_user",
    "SELECT event_id, ts, value FROM events WHERE user_id = 8 ORDER BY ts DESC, event_id DESC LIMIT 50",
)
def latest_of_user(spark, d):
    return features.latest_rows(table(spark, d, "events"), ["ts", "event_id"], 50, F.col("user_id") == 8).select(
        "event_id", "ts", "value")


@query("distinct_values", "SELECT DISTINCT l_shipdate FROM lineitem")
def distinct_values(spark, d):
    return features.distinct_values(table(spark, d, "lineitem"), "l_shipdate")


# --- scalar functions --------------------------------------------------------------------------


@query(
    "temporal_features",
    """SELECT event_id, year(ts)::INTEGER AS ts_year, month(ts)::INTEGER AS ts_month, day(ts)::INTEGER AS ts_day,
         hour(ts)::INTEGER AS ts_hour, minute(ts)::INTEGER AS ts_minute, (isodow(ts) - 1)::INTEGER AS ts_day_of_week,
         dayofyear(ts)::INTEGER AS ts_day_of_year, weekofyear(ts)::INTEGER AS ts_week_of_year,
         quarter(ts)::INTEGER AS ts_quarter, (isodow(ts) >= 6)::INTEGER AS ts_is_weekend FROM events""",
)
def temporal_features(spark, d):
    return scalars.temporal_features(table(spark, d, "events"), "ts").drop(
        "ts", "user_id", "event_type", "value", "props")


@query(
    "interaction_features",
    """SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
         round(l_extendedprice * l_tax, 6) AS l_extendedprice_x_l_tax FROM lineitem""",
)
def interaction_features(spark, d):
    out = scalars.interaction_features(
        table(spark, d, "lineitem"), [("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")])
    names = ("l_quantity_x_l_discount", "l_extendedprice_x_l_tax")
    return rounded(out, 6, *names).select("l_orderkey", "l_linenumber", *names)


@query(
    "ratio_features",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_tax = 0 THEN 0 ELSE l_extendedprice / l_tax END, 7) AS l_extendedprice_per_l_tax,
         round(l_extendedprice / l_quantity, 7) AS l_extendedprice_per_l_quantity FROM lineitem""",
)
def ratio_features(spark, d):
    out = scalars.ratio_features(
        table(spark, d, "lineitem"), [("l_extendedprice", "l_tax"), ("l_extendedprice", "l_quantity")])
    names = ("l_extendedprice_per_l_tax", "l_extendedprice_per_l_quantity")
    return rounded(out, 7, *names).select("l_orderkey", "l_linenumber", *names)


@query(
    "conditional_flag",
    """SELECT event_id, (event_type IN ('error', 'signup'))::INTEGER AS rare, (value > 100)::INTEGER AS large FROM events""",
)
def conditional_flag(spark, d):
    return table(spark, d, "events").select(
        "event_id", scalars.flag_in("event_type", ["error", "signup"]).alias("rare"),
        scalars.flag(F.col("value") > 100).alias("large"))


@query(
    "abs_round_error",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice - 1000 * l_quantity, 4) AS error,
         round(abs(l_extendedprice - 1000 * l_quantity), 4) AS abs_error FROM lineitem""",
)
def abs_round_error(spark, d):
    rows = table(spark, d, "lineitem").withColumn("guess", F.col("l_quantity") * 1000)
    return rows.select(
        "l_orderkey", "l_linenumber", F.round(scalars.signed_error("l_extendedprice", "guess"), 4).alias("error"),
        scalars.abs_error("l_extendedprice", "guess", 4).alias("abs_error"))


@query(
    "clip_value",
    f"""WITH {SPARSE_SQL} SELECT event_id, CASE WHEN value IS NOT NULL THEN least(greatest(value, 10.0), 90.0) END AS value
        FROM sparse""",
)
def clip_value(spark, d):
    return sparse_events(spark, d).select("event_id", scalars.clip("value", 10.0, 90.0).alias("value"))


@query("json_extract", "SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events")
def json_extract(spark, d):
    return scalars.json_fields(table(spark, d, "events"), "props", {"k": "INT"}).select("event_id", "k")


@query(
    "json_encode",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_acctbal":' || c_acctbal || '}'
         AS payload FROM customer""",
)
def json_encode(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", scalars.json_row("c_custkey", "c_mktsegment", "c_acctbal").alias("payload"))


@query(
    "array_features",
    """SELECT vec_id, 'f' || (i - 1) AS name, round(embedding[i]::DOUBLE, 6) AS value
       FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(i)""",
)
def array_features(spark, d):
    rows = table(spark, d, "embeddings").withColumn(
        "names", F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("f"), i)))
    out = scalars.melt_features(rows, "vec_id", "names", "embedding")
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(
    "array_features_wide",
    "SELECT vec_id, embedding[1] AS f0, embedding[4] AS f3, NULL::FLOAT AS absent FROM embeddings",
)
def array_features_wide(spark, d):
    rows = table(spark, d, "embeddings").withColumn(
        "names", F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("f"), i)))
    return scalars.widen_features(rows, "names", "embedding", ["f0", "f3", "absent"]).select(
        "vec_id", "f0", "f3", "absent")


@query(
    "string_id",
    "SELECT c_custkey, 'user_' || lpad(c_custkey::VARCHAR, 6, '0') AS id, 'c_mktsegment=' || c_mktsegment AS key FROM customer",
)
def string_id(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", scalars.padded_id("user_", "c_custkey").alias("id"), scalars.key_label("c_mktsegment").alias("key"))


@query(
    "coalesce_id",
    f"WITH {SPARSE_SQL} SELECT event_id, coalesce(event_type, value::VARCHAR, 'offset_' || event_id) AS id FROM sparse",
)
def coalesce_id(spark, d):
    return sparse_events(spark, d).select(
        "event_id",
        scalars.first_id(
            "event_type", F.col("value").cast("string"), fallback=F.concat(F.lit("offset_"), F.col("event_id"))
        ).alias("id"))


@query(
    "row_hash",
    f"""WITH {SPARSE_SQL} SELECT event_id, md5(concat_ws(chr(31), event_id::VARCHAR, coalesce(event_type, '\\N'),
          coalesce(value::VARCHAR, '\\N'))) AS h FROM sparse""",
)
def row_hash(spark, d):
    return sparse_events(spark, d).select("event_id", scalars.row_hash(["event_id", "event_type", "value"]).alias("h"))


# --- encoding --------------------------------------------------------------------------------


@query(
    "encode_label",
    f"""WITH {SPARSE_SQL}, c AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code
          FROM (SELECT DISTINCT event_type FROM sparse WHERE event_type IS NOT NULL))
        SELECT s.event_id, c.code AS event_type_encoded FROM sparse s LEFT JOIN c USING (event_type)""",
)
def encode_label(spark, d):
    return encoding.encode_label(sparse_events(spark, d), "event_type").select("event_id", "event_type_encoded")


@query(
    "encode_index",
    f"""WITH {SPARSE_SQL}, c AS (SELECT event_type, (row_number() OVER (ORDER BY count(*) DESC, event_type) - 1)::DOUBLE AS code
          FROM sparse WHERE event_type IS NOT NULL GROUP BY 1)
        SELECT s.event_id, coalesce(c.code, (SELECT count(*) FROM c)) AS event_type_indexed
        FROM sparse s LEFT JOIN c USING (event_type)""",
)
def encode_index(spark, d):
    return encoding.encode_index(sparse_events(spark, d), "event_type").select("event_id", "event_type_indexed")


@query(
    "encode_onehot_vector",
    f"""WITH {SPARSE_SQL}, c AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS code, count(*) OVER () AS size
          FROM sparse WHERE event_type IS NOT NULL GROUP BY event_type)
        SELECT event_id, coalesce(code, size) AS code, CASE WHEN code IS NULL THEN 0 ELSE 1 END AS entries, code::INTEGER AS position,
          CASE WHEN code IS NOT NULL THEN 1.0::DOUBLE END AS value, (SELECT any_value(size) FROM c)::INTEGER AS size
        FROM (SELECT s.event_id, c.code, (SELECT any_value(size) FROM c) AS size FROM sparse s LEFT JOIN c USING (event_type))""",
)
def encode_onehot_vector(spark, d):
    """The vector as its only entry (position and value), if it has one, and its size."""
    out, _ = encoding.encode_categorical(sparse_events(spark, d), "event_type", "onehot")
    text = F.col("event_type_encoded").cast("string")  # (size,[positions],[values])
    part = [F.regexp_extract(text, r"^\((\d+),\[(\d*)\],\[([\d.]*)\]\)$", k) for k in (1, 2, 3)]
    given = [F.when(p != "", p) for p in part]
    return out.select(
        "event_id", F.col("event_type_indexed").cast("long").alias("code"), F.when(part[1] != "", 1).otherwise(0).alias("entries"),
        given[1].cast("int").alias("position"), given[2].cast("double").alias("value"), given[0].cast("int").alias("size"))


@query(
    "encode_onehot_columns",
    f"""WITH {SPARSE_SQL} SELECT event_id, {', '.join(f"(coalesce(event_type, '') = '{t}')::INTEGER AS event_type_{t}"
        for t in ('click', 'error', 'purchase', 'signup', 'view'))} FROM sparse""",
)
def encode_onehot_columns(spark, d):
    return encoding.encode_onehot_columns(sparse_events(spark, d), "event_type").drop(
        "ts", "user_id", "value", "event_type")


@query(
    "encode_frequency",
    f"""WITH {SPARSE_SQL} SELECT event_id, round(CASE WHEN event_type IS NOT NULL THEN count(event_type) OVER (PARTITION BY event_type)
          / count(event_type) OVER () END, 9) AS event_type_freq FROM sparse""",
)
def encode_frequency(spark, d):
    return rounded(encoding.encode_frequency(sparse_events(spark, d), "event_type"), 9, "event_type_freq").select(
        "event_id", "event_type_freq")


@query("drop_original", "SELECT * EXCLUDE (o_orderpriority), CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 "
       "WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 ELSE 4 END::BIGINT AS o_orderpriority_encoded FROM orders")
def drop_original(spark, d):
    return encoding.encode_categorical(table(spark, d, "orders"), "o_orderpriority", "label", drop_original=True)


def _vector_sql(cols, expr):
    return "[" + ", ".join(expr.format(c=c) for c in cols) + "]"


@query(
    "assemble_features",
    """SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2 FROM lineitem""",
)
def assemble_features(spark, d):
    from pyspark.ml.functions import vector_to_array

    out, _ = encoding.assemble_features(
        table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    v = vector_to_array("features")
    return out.select("l_orderkey", "l_linenumber", *[F.get(v, F.lit(i)).alias(f"f{i}") for i in range(3)])


@query(
    "assemble_scaled",
    """WITH q AS (SELECT avg(l_quantity) AS a, stddev_samp(l_quantity) AS b, avg(l_extendedprice) AS c,
         stddev_samp(l_extendedprice) AS e FROM lineitem)
       SELECT l_orderkey, l_linenumber, round((l_quantity - a) / b, 6) AS f0, round((l_extendedprice - c) / e, 6) AS f1
       FROM lineitem, q""",
)
def assemble_scaled(spark, d):
    from pyspark.ml.functions import vector_to_array

    out, _ = encoding.assemble_features(
        table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], with_scaling=True)
    v = vector_to_array("features")
    return out.select(
        "l_orderkey", "l_linenumber", *[F.round(F.get(v, F.lit(i)), 6).alias(f"f{i}") for i in range(2)])
