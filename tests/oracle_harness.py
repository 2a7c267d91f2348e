"""Side-by-side check of a Spark query and its DuckDB text.

Mirrors the round's correctness gate: same column names (compared sorted),
same row count, same multiset of rows after normalising values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import numpy as np

from framewise.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = bool(__import__("os").environ.get("FRAMEWISE_STRICT"))


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        f = float(v)
        if math.isnan(f):
            return None
        return (f + 0.0) if STRICT else round(f, 6) + 0.0
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, np.datetime64)):
        return str(v)
    try:
        import pandas as pd
        if v is pd.NaT:
            return None
        if isinstance(v, pd.Timestamp):
            return str(v.to_pydatetime())
    except Exception:
        pass
    return v


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=repr)


def _spark_family(dt) -> str:
    name = dt.typeName()
    if name == "array":
        return "list<" + _spark_family(dt.elementType) + ">"
    return {"integer": "int32", "long": "int64", "short": "int16", "byte": "int8",
            "double": "float64", "float": "float32", "string": "str", "boolean": "bool",
            "timestamp": "ts", "timestamp_ntz": "ts", "date": "date", "binary": "bytes",
            "struct": "struct"}.get(name, name)


def _duck_family(t) -> str:
    s = str(t)
    if s.endswith("[]"):
        return "list<" + _duck_family(s[:-2]) + ">"
    return {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8",
            "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "str", "BOOLEAN": "bool",
            "TIMESTAMP": "ts", "TIMESTAMP WITH TIME ZONE": "ts", "DATE": "date", "BLOB": "bytes",
            "HUGEINT": "int128"}.get(s, s)


def type_diffs(spark_df, rel) -> list[str]:
    st = {f.name: _spark_family(f.dataType) for f in spark_df.schema.fields}
    dt = {c: _duck_family(t) for c, t in zip(rel.columns, rel.types)}
    return [f"{c}: spark {st[c]} vs duck {dt.get(c)}" for c in st if c in dt and st[c] != dt[c]]


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_cols = sorted(spark_df.columns)
    s_rows = [r.asDict(recursive=True) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_raw = rel.fetchall()
    d_rows = [dict(zip(rel.columns, r)) for r in d_raw]
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    td = type_diffs(spark_df, rel)
    return True, f"{len(a)} rows" + (f"  TYPES {td}" if td else "")
