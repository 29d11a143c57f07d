"""Compare a registered query with its SQL run by DuckDB: names, types, rows and values."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]).upper() for c in cur.description}
    expected = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(names)}"
    for f in df.schema:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString())
        if want and kinds[f.name] != want:
            return f"type of {f.name}: {want} expected {kinds[f.name]}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0]}" if wrong else None
