"""Run a registered query and its DuckDB oracle side by side (test helper).

Comparison mirrors the driver contract: column names (sorted), row count and
an order-insensitive multiset of rows.  Floats must match exactly; a relative
tolerance pass is reported separately to tell drift from real errors.
"""

from __future__ import annotations

import math
import os
from decimal import Decimal

from pyspark.sql import SparkSession

from panelkit.plans.catalog import ORACLE, QUERIES, load_all
from panelkit.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return v.item()
        except Exception:  # noqa: BLE001
            return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def _close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return a == b
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return a == b or abs(a - b) <= rel * max(abs(a), abs(b), 1e-12)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, rel) for x, y in zip(a, b))
    return a == b


def compare(spark: SparkSession, name: str, sf_dir: str, con=None) -> dict:
    load_all()
    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    res = {"query": name, "spark_rows": len(s_rows)}
    if name not in ORACLE:
        res["status"] = "no-oracle"
        return res
    con = con or duckdb_connection(sf_dir)
    rel = con.sql(ORACLE[name])
    o_cols = list(rel.columns)
    o_raw = rel.fetchall()
    o_sorted = sorted(o_cols)
    idx = [o_cols.index(c) for c in o_sorted]
    o_rows = [tuple(_norm(r[i]) for i in idx) for r in o_raw]
    res["oracle_rows"] = len(o_rows)
    if s_cols != o_sorted:
        res["status"] = f"columns differ: spark-only {sorted(set(s_cols) - set(o_sorted))} oracle-only {sorted(set(o_sorted) - set(s_cols))}"
        return res
    if len(s_rows) != len(o_rows):
        res["status"] = "row count differs"
        return res
    a, b = sorted(s_rows, key=_key), sorted(o_rows, key=_key)
    if a == b:
        res["status"] = "exact"
        return res
    bad = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    if not bad:
        diffs = [(s_cols[i], x[i], y[i]) for x, y in zip(a, b) for i in range(len(x)) if x[i] != y[i]]
        res["status"] = "close"
        res["example"] = diffs[:3]
    else:
        res["status"] = "values differ"
        res["example"] = [dict(zip(s_cols, bad[0][0])), dict(zip(s_cols, bad[0][1]))]
        res["n_bad"] = len(bad)
    return res
