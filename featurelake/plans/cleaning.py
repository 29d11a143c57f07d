"""Queries over projection, predicates, cleaning, filling, clipping and normalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import as_list
from ..operators import clean
from .registry import SPARSE_SQL, query, rounded, sparse_events, table


@query("project", "SELECT c_custkey, c_mktsegment FROM customer")
def project(spark, d):
    return clean.project(table(spark, d, "customer"), ["c_custkey", "c_mktsegment", "no_such_column"])


@query("filter_sql", "SELECT * FROM orders WHERE o_totalprice > 200000 AND o_orderpriority LIKE '1%'")
def filter_sql(spark, d):
    return clean.filter_sql(table(spark, d, "orders"), "o_totalprice > 200000 AND o_orderpriority LIKE '1%'")


def _filter(spark, d, conditions, mode="and"):
    return clean.filter_rows(table(spark, d, "events"), conditions, mode).select("event_id", "event_type", "value")


E = "SELECT event_id, event_type, value FROM events WHERE "


@query("filter_compare", E + "value >= 10 AND event_type <> 'error' AND user_id < 1000")
def filter_compare(spark, d):
    return _filter(spark, d, {"value": (">=", 10), "event_type": ("!=", "error"), "user_id": ("<", 1000)})


@query("filter_in", E + "event_type IN ('view', 'click')")
def filter_in(spark, d):
    return _filter(spark, d, {"event_type": ("in", ["view", "click"])})


@query(
    "filter_not_in",
    f"WITH {SPARSE_SQL} SELECT event_id, event_type FROM sparse WHERE event_type NOT IN ('view', 'click')",
)
def filter_not_in(spark, d):
    kept = clean.filter_rows(sparse_events(spark, d), {"event_type": ("not_in", ["view", "click"])})
    return kept.select("event_id", "event_type")


@query("filter_between", E + "value BETWEEN 20 AND 80")
def filter_between(spark, d):
    return _filter(spark, d, {"value": ("between", (20, 80))})


@query("filter_and", E + "event_type = 'view' AND value < 50")
def filter_and(spark, d):
    return _filter(spark, d, {"event_type": "view", "value": ("<", 50), "unknown": 1})


@query("filter_or", E + "event_type = 'view' OR value < 5")
def filter_or(spark, d):
    return _filter(spark, d, {"event_type": "view", "value": ("<", 5)}, "or")


@query(
    "cast_types",
    """SELECT event_id::VARCHAR AS event_id, value::BIGINT AS value, TRY_CAST(event_type AS DOUBLE) AS event_type,
         (user_id <> 0) AS user_id FROM (SELECT event_id, floor(value) AS value, event_type, user_id FROM events)""",
)
def cast_types(spark, d):
    rows = table(spark, d, "events").select("event_id", F.floor("value").cast("string").alias("value"), "event_type", "user_id")
    return clean.cast_types(
        rows, {"event_id": "string", "value": "int", "event_type": "float", "user_id": "bool", "absent": "int"}
    )


@query(
    "cast_types_ignore",
    """SELECT event_id::BIGINT AS event_id, event_type, floor(value)::VARCHAR::DOUBLE::BIGINT AS value FROM events""",
)
def cast_types_ignore(spark, d):
    """A column that would lose values stays as it is; the others are cast, and casts that must succeed raise otherwise."""
    rows = table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.floor("value").cast("string").alias("value"))
    kept = clean.cast_types(rows, {"event_type": "int", "value": "int"}, errors="ignore")
    return clean.cast_types(kept, {"event_id": "int"}, errors="raise")


@query(
    "derive_columns",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS net,
         (l_tax > 0.04)::INTEGER AS high_tax FROM lineitem""",
)
def derive_columns(spark, d):
    out = clean.derive_columns(
        table(spark, d, "lineitem"),
        {
            "net": lambda df: F.round(df.l_extendedprice * (1 - df.l_discount), 6),
            "high_tax": "cast(l_tax > 0.04 AS int)",
        },
    )
    return out.select("l_orderkey", "l_linenumber", "net", "high_tax")


@query("drop_null_columns", "SELECT c_custkey, c_acctbal FROM customer")
def drop_null_columns(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.lit(None).cast("string").alias("empty"), "c_acctbal")
    return clean.drop_null_columns(rows)


HOLES = """holes AS (SELECT CASE WHEN event_id % 6 > 0 THEN event_type END AS a, CASE WHEN event_id % 6 > 1 THEN value END AS b,
    CASE WHEN event_id % 6 > 2 THEN user_id END AS c FROM events)"""


def _holes(spark, d):
    k = F.col("event_id") % 6
    return table(spark, d, "events").select(
        F.when(k > 0, F.col("event_type")).alias("a"), F.when(k > 1, F.col("value")).alias("b"),
        F.when(k > 2, F.col("user_id")).alias("c"),
    )


@query("drop_null_rows", f"WITH {HOLES} SELECT * FROM holes WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL")
def drop_null_rows(spark, d):
    return clean.drop_null_rows(_holes(spark, d))


@query(
    "drop_sparse_rows",
    f"WITH {HOLES} SELECT * FROM holes WHERE (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT <= 1.5",
)
def drop_sparse_rows(spark, d):
    return clean.drop_sparse_rows(_holes(spark, d), 0.5)


@query(
    "dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dedupe(spark, d):
    out = clean.dedupe(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("dedupe_rows", "SELECT DISTINCT text FROM documents")
def dedupe_rows(spark, d):
    return clean.dedupe(table(spark, d, "documents").select("text"))


@query(
    "clean_data",
    f"""WITH {HOLES} SELECT DISTINCT a, b, c FROM holes
        WHERE (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT <= 1.5""",
)
def clean_data(spark, d):
    return clean.clean_data(_holes(spark, d), drop_all_null_cols=True)


def _fill(spark, d, strategy, **options):
    return clean.fill_nulls(sparse_events(spark, d), strategy, **options)


@query(
    "fill_custom",
    f"""WITH {SPARSE_SQL} SELECT event_id, coalesce(event_type, 'none') AS event_type, coalesce(value, -1) AS value
        FROM sparse""",
)
def fill_custom(spark, d):
    return _fill(spark, d, "custom", fill_values={"event_type": "none", "value": -1.0}).select(
        "event_id", "event_type", "value")


@query("fill_zero", f"WITH {SPARSE_SQL} SELECT event_id, event_type, coalesce(value, 0) AS value FROM sparse")
def fill_zero(spark, d):
    return _fill(spark, d, "zero").select("event_id", "event_type", "value")


@query(
    "fill_mean",
    f"""WITH {SPARSE_SQL} SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM sparse)), 6) AS value
        FROM sparse""",
)
def fill_mean(spark, d):
    return rounded(_fill(spark, d, "mean", columns=["value"]), 6, "value").select("event_id", "value")


@query(
    "fill_median",
    f"""WITH {SPARSE_SQL} SELECT event_id,
          round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM sparse)), 6) AS value FROM sparse""",
)
def fill_median(spark, d):
    return rounded(_fill(spark, d, "median", columns=["value"]), 6, "value").select("event_id", "value")


@query(
    "fill_mode",
    f"""WITH {SPARSE_SQL}, m AS (SELECT value FROM sparse WHERE value IS NOT NULL GROUP BY value
          ORDER BY count(*) DESC, value LIMIT 1)
        SELECT event_id, coalesce(value, (SELECT value FROM m)) AS value FROM sparse""",
)
def fill_mode(spark, d):
    return _fill(spark, d, "mode", columns=["value"]).select("event_id", "value")


for _name, _pick, _frame in (
    ("fill_forward", "last_value", "UNBOUNDED PRECEDING AND CURRENT ROW"),
    ("fill_backward", "first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING"),
):

    @query(
        _name,
        f"""WITH {SPARSE_SQL} SELECT event_id, {_pick}(value IGNORE NULLS) OVER (PARTITION BY user_id
              ORDER BY ts, event_id ROWS BETWEEN {_frame}) AS value FROM sparse""",
    )
    def fill_along(spark, d, strategy="ffill" if _name == "fill_forward" else "bfill"):
        return _fill(
            spark, d, strategy, columns=["value"], partition_by="user_id", order_by=["ts", "event_id"]
        ).select("event_id", "value")


@query(
    "clip_iqr",
    f"""WITH {SPARSE_SQL}, q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM sparse)
        SELECT event_id, round(CASE WHEN value IS NOT NULL
          THEN least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a)) END, 6) AS value FROM sparse, q""",
)
def clip_iqr(spark, d):
    return rounded(clean.clip_outliers(sparse_events(spark, d), ["value"]), 6, "value").select("event_id", "value")


@query(
    "clip_percentile",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.99) AS b,
          quantile_cont(l_quantity, 0.01) AS c, quantile_cont(l_quantity, 0.99) AS e FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, a), b), 6) AS l_extendedprice,
         round(least(greatest(l_quantity, c), e), 6) AS l_quantity FROM lineitem, q""",
)
def clip_percentile(spark, d):
    out = clean.clip_outliers(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], "percentile")
    return rounded(out, 6, "l_extendedprice", "l_quantity").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


def _normalized(spark, d, method, scaler):
    out, _ = scaler(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], method)
    return rounded(out, 6, "l_extendedprice", "l_quantity").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


def _scale_sql(shift: str, width: str) -> str:
    stats = ", ".join(
        f"{expr.format(c=c)} AS {tag}_{c}" for c in ("l_extendedprice", "l_quantity") for tag, expr in (("s", shift), ("w", width))
    )
    cols = ", ".join(
        f"round(({c} - s_{c}) / w_{c}, 6) AS {c}" for c in as_list(("l_extendedprice", "l_quantity"))
    )
    return f"WITH q AS (SELECT {stats} FROM lineitem) SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, q"


IQR_SQL = "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"

for _name, _method, _scaler, _shift, _width in (
    ("normalize_standard", "standard", clean.normalize_columns, "avg({c})", "stddev_samp({c})"),
    ("normalize_minmax", "minmax", clean.normalize_columns, "min({c})", "max({c}) - min({c})"),
    ("normalize_robust", "robust", clean.normalize_columns, "quantile_cont({c}, 0.5)", IQR_SQL),
    ("scale_standard", "standard", clean.scale_features, "avg({c})", "stddev_pop({c})"),
    ("scale_minmax", "minmax", clean.scale_features, "min({c})", "max({c}) - min({c})"),
    ("scale_robust", "robust", clean.scale_features, "quantile_cont({c}, 0.5)", IQR_SQL),
):

    @query(_name, _scale_sql(_shift, _width))
    def normalize(spark, d, method=_method, scaler=_scaler):
        return _normalized(spark, d, method, scaler)


@query(
    "concat_batches",
    """SELECT event_id, event_type, value, NULL::BIGINT AS n_chars FROM events
       UNION ALL SELECT doc_id, NULL, NULL, n_chars FROM documents""",
)
def concat_batches(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("event_id"), "n_chars")
    return clean.concat_batches(table(spark, d, "events").select("event_id", "event_type", "value"), docs)
