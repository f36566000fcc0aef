"""Run a registered Spark query and its DuckDB oracle side by side and compare
row count, column names and the multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                  "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck_type(t) -> str:
    """The DuckDB type name a Spark column type corresponds to."""
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper()
    if s.startswith("array<"):
        return duck_type(t.elementType) + "[]"
    return _SPARK_TO_DUCK.get(s, s)


def compare(spark, con, name, qfn, sql, sf_dir):
    sdf = qfn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: duck_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return problems, len(s_rows), len(d_rows)
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if type_diff:
        problems.append(f"types {type_diff}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:3]
        only_d = [r for r in b if r not in sa][:3]
        problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    return problems, len(s_rows), len(d_rows)
