"""SQL text helpers for the DuckDB oracle queries.

They spell the same formulas as the Spark expressions in ``functions.exprs``
(rounding through DECIMAL, guarded division, numpy histogram edges, md5 buckets),
so the oracle checks the plan, not a second set of definitions.
"""

from __future__ import annotations

from panelkit.functions.exprs import sql_hex_bucket, sql_hist_bin, sql_hist_edge, sql_rnd
from panelkit.sources.testdata import SPLIT_BUCKETS, SPLIT_SEED, YEARS

__all__ = ["sql_rnd", "sql_hist_bin", "sql_hist_edge", "sql_hex_bucket", "s_pct", "s_pct0", "s_ratio", "s_cnt",
           "PANEL_CTE", "panel_long", "panel_pairs", "lineitem_split_sql", "predictions_cte", "status_sql"]


def s_ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def s_pct(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) * 100.0 / CAST(NULLIF({den}, 0) AS DOUBLE))"


def s_pct0(num: str, den: str) -> str:
    return f"COALESCE({s_pct(num, den)}, 0.0)"


def s_cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def status_sql(n: str) -> str:
    return f"CAST(CASE WHEN {n} = 0 THEN -2 WHEN {n} = 1 THEN -1 ELSE least({n} - 2, 9) END AS INTEGER)"


def _panel_cte() -> str:
    lp = ",\n    ".join(
        f"SUM(CASE WHEN year(l_shipdate) = {y} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS lp_{i}"
        for i, y in enumerate(YEARS, 1))
    b = ",\n    ".join(
        f"SUM(CASE WHEN year(o_orderdate) = {y} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS b_{i}"
        for i, y in enumerate(YEARS, 1))
    n = ",\n    ".join(f"COUNT(CASE WHEN year(o_orderdate) = {y} THEN 1 END) AS n_{i}" for i, y in enumerate(YEARS, 1))
    p = ",\n    ".join(f"SUM(lp_{i}) AS p_{i}" for i in range(1, len(YEARS) + 1))
    cols = [
        "c_custkey", "CAST(c_acctbal < 0 AS INTEGER) AS target", "CAST(c_nationkey AS BIGINT) AS c_nationkey",
        "c_mktsegment", "CAST(COALESCE(n_orders, 0) AS BIGINT) AS n_orders_total",
        "CAST(COALESCE(n_lines, 0) AS BIGINT) AS n_lines_total"]
    cols += [f"{status_sql(f'COALESCE(n_{i}, 0)')} AS status_{i}" for i in range(1, len(YEARS) + 1)]
    cols += [f"CAST(COALESCE(b_{i}, 0) AS DECIMAL(18,2)) AS bill_{i}" for i in range(1, len(YEARS) + 1)]
    cols += [f"CAST(COALESCE(p_{i}, 0) AS DECIMAL(18,2)) AS pay_{i}" for i in range(1, len(YEARS) + 1)]
    cols += [f"CAST(COALESCE(p_{i}, 0) - COALESCE(b_{i}, 0) AS DECIMAL(18,2)) AS net_{i}" for i in range(1, len(YEARS) + 1)]
    cols += [f"CAST(p_{i} AS DOUBLE) AS paid_{i}" for i in range(1, len(YEARS) + 1)]  # NaN counts as missing
    sel = ",\n    ".join(cols)
    return f"""per_order AS (
  SELECT l_orderkey,
    {lp},
    COUNT(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey
), per_cust AS (
  SELECT o_custkey,
    {b},
    {n},
    {p},
    COUNT(*) AS n_orders, SUM(n_lines) AS n_lines
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  GROUP BY o_custkey
), panel AS MATERIALIZED (
  SELECT
    {sel}
  FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey
)"""


PANEL_CTE = _panel_cte()


def panel_long(channels=("status", "bill", "pay", "net"), extra: tuple[str, ...] = ()) -> str:
    """UNION ALL unpivot of the panel: (c_custkey, target, t, period, <channels>)."""
    parts = []
    for i, y in enumerate(YEARS, 1):
        chans = ", ".join(f"{ch}_{i} AS {ch}" for ch in channels)
        ex = "".join(f", {e}" for e in extra)
        parts.append(f"SELECT c_custkey, target{ex}, {i} AS t, '{y}' AS period, {chans} FROM panel")
    return "\n  UNION ALL ".join(parts)


def panel_pairs(channel: str) -> str:
    """Adjacent pairs: (c_custkey, target, pair_index, source_period, destination_period, src, dst)."""
    parts = []
    for i in range(1, len(YEARS)):
        parts.append(f"SELECT c_custkey, target, {i} AS pair_index, '{YEARS[i - 1]}' AS source_period, "
                     f"'{YEARS[i]}' AS destination_period, {channel}_{i} AS src, {channel}_{i + 1} AS dst FROM panel")
    return "\n  UNION ALL ".join(parts)


def lineitem_split_sql() -> str:
    b = sql_hex_bucket(f"('{SPLIT_SEED}|' || CAST(l_orderkey AS VARCHAR))", SPLIT_BUCKETS)
    return f"(CASE WHEN {b} < 5 THEN 'test' WHEN {b} < 9 THEN 'validation' ELSE 'train' END)"


def predictions_cte(splits=("validation", "test")) -> str:
    in_list = ", ".join(f"'{s}'" for s in splits)
    return f"""pred_base AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ID,
         {lineitem_split_sql()} AS split,
         CAST(l_returnflag = 'R' AS BIGINT) AS y_true,
         l_quantity / 50.0 AS p_a, l_extendedprice / 105000.0 AS p_b, l_discount * 10.0 AS p_c
  FROM lineitem
), preds AS (
  SELECT 'model_a' AS model_name, split, ID, y_true, p_a AS probability_default FROM pred_base WHERE split IN ({in_list})
  UNION ALL SELECT 'model_b', split, ID, y_true, p_b FROM pred_base WHERE split IN ({in_list})
  UNION ALL SELECT 'model_c', split, ID, y_true, p_c FROM pred_base WHERE split IN ({in_list})
)"""
