"""Amount-panel queries (M*) on the customer-year panel.

Bill policy runs on the signed ``net`` channel (pay - bill, both signs),
payment policy on the ``pay`` channel; correlation and change histograms use
``bill``.
"""

from __future__ import annotations

from panelkit.operators import amounts as M
from panelkit.plans.catalog import register
from panelkit.plans.sql import PANEL_CTE, panel_long, panel_pairs, s_cnt, s_pct, s_pct0, s_ratio, sql_hist_bin, sql_hist_edge, sql_rnd
from panelkit.sources.testdata import PANEL_SPEC, YEARS, customer_panel
from panelkit.spec import BILL_POLICY, PAYMENT_POLICY

PERIODS_SQL = "(VALUES " + ", ".join(f"({i}, '{y}')" for i, y in enumerate(YEARS, 1)) + ") AS pd(t, period)"
PAIRS_SQL = "(VALUES " + ", ".join(f"({i}, '{YEARS[i - 1]}', '{YEARS[i]}')" for i in range(1, len(YEARS))) + \
    ") AS pd(pair_index, source_period, destination_period)"
CLASSES_SQL = "(VALUES (0), (1)) AS cl(target)"
R = lambda e: sql_rnd(e, 6)


def _long(ch):
    return f"{PANEL_CTE}, long AS (SELECT c_custkey, target, t, period, {ch} AS v FROM ({panel_long((ch,))}))"


def _stats_sql(keys: str, probs: dict, src: str = "long") -> str:
    qs = ", ".join(f"quantile_cont(CAST(v AS DOUBLE), {p}) AS {n}" for n, p in probs.items())
    return (f"SELECT {keys}, COUNT(*) AS rws, COUNT(v) AS n_obs, CAST(SUM(v) AS DOUBLE) / CAST(NULLIF(COUNT(v), 0) AS DOUBLE) AS mean, "
            f"STDDEV_SAMP(CAST(v AS DOUBLE)) AS std, CAST(MIN(v) AS DOUBLE) AS mn, CAST(MAX(v) AS DOUBLE) AS mx, "
            f"{s_cnt('v < 0')} AS neg, {s_cnt('v = 0')} AS zer, {s_cnt('v > 0')} AS pos, {qs} FROM {src} GROUP BY {keys}")


def _join_on(keys: list[str], a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _summary_sql(ch: str, policy) -> str:
    probs = M.SUMMARY_PROBS
    count = "rws" if policy.count_all_rows else "n_obs"
    return f"""
WITH {_long(ch)},
s AS ({_stats_sql('t, period', probs)}),
f AS (SELECT *, p75 - p25 AS iqr, p25 - 1.5 * (p75 - p25) AS lf, p75 + 1.5 * (p75 - p25) AS uf FROM s),
e AS (SELECT long.t, {s_cnt('v < lf')} AS below, {s_cnt('v > uf')} AS above FROM long JOIN f ON long.t = f.t GROUP BY long.t)
SELECT CAST(f.t AS BIGINT) AS chronological_index, period, CAST({count} AS BIGINT) AS count,
  CAST(rws - n_obs AS BIGINT) AS missing_count, {R('mean')} AS mean, {R('std')} AS std, {R('mn')} AS min,
  {', '.join(f"{R(n)} AS {n}" for n in probs)}, {R('mx')} AS max, {R('iqr')} AS iqr,
  neg AS negative_count, zer AS zero_count, pos AS positive_count,
  {R(s_pct0('neg', 'n_obs'))} AS negative_percentage, {R(s_pct0('zer', 'n_obs'))} AS zero_percentage,
  {R(s_pct0('pos', 'n_obs'))} AS positive_percentage, {R('lf')} AS lower_fence, {R('uf')} AS upper_fence,
  below AS below_lower_fence_count, above AS above_upper_fence_count,
  CAST(below + above AS BIGINT) AS total_potential_extreme_count
FROM f JOIN e ON f.t = e.t"""


def _by_target_sql(ch: str, policy) -> str:
    probs = M.CLASS_PROBS
    k = ["t", "period", "target"]
    if policy.skip_empty_class:
        base = "SELECT * FROM f WHERE n_obs > 0"
    else:
        base = f"SELECT d.t, d.period, d.target, f.* EXCLUDE (t, period, target) FROM (SELECT * FROM {PERIODS_SQL}, {CLASSES_SQL}) d LEFT JOIN f ON {_join_on(k, 'd', 'f')}"
    count = "rws" if policy.count_all_rows else "n_obs"
    miss = "CAST(COALESCE(rws, 0) - COALESCE(n_obs, 0) AS BIGINT) AS missing_count, " if policy.count_all_rows else ""
    return f"""
WITH {_long(ch)},
s AS ({_stats_sql('t, period, target', probs)}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM s),
e AS (SELECT long.t, long.target, {s_cnt('v < lf OR v > uf')} AS ext FROM long JOIN f ON long.t = f.t AND long.target = f.target
      GROUP BY long.t, long.target),
b AS ({base})
SELECT CAST(b.t AS BIGINT) AS chronological_index, b.period, CAST(b.target AS BIGINT) AS target,
  CAST(COALESCE({count}, 0) AS BIGINT) AS count, {miss}{R('mean')} AS mean, {R('std')} AS std, {R('mn')} AS min,
  {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3, {R('mx')} AS max, {R('iqr')} AS iqr,
  CAST(COALESCE(neg, 0) AS BIGINT) AS negative_count, CAST(COALESCE(zer, 0) AS BIGINT) AS zero_count,
  CAST(COALESCE(pos, 0) AS BIGINT) AS positive_count, CAST(COALESCE(e.ext, 0) AS BIGINT) AS potential_extreme_count
FROM b LEFT JOIN e ON b.t = e.t AND b.target = e.target"""


@register("panel_summary", _summary_sql("net", BILL_POLICY))
def q_panel_summary(spark, sf_dir):
    return M.panel_summary(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


@register("payment_summary", _summary_sql("paid", PAYMENT_POLICY))
def q_payment_summary(spark, sf_dir):
    return M.panel_summary(customer_panel(spark, sf_dir), PANEL_SPEC, "paid", PAYMENT_POLICY)


@register("panel_summary_by_target", _by_target_sql("net", BILL_POLICY))
def q_panel_summary_by_target(spark, sf_dir):
    return M.panel_summary_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


@register("payment_summary_by_target", _by_target_sql("paid", PAYMENT_POLICY))
def q_payment_summary_by_target(spark, sf_dir):
    return M.panel_summary_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "paid", PAYMENT_POLICY)


def _sign_expr(policy) -> str:
    tail = "ELSE 'zero'" if policy.null_sign_is_zero else "WHEN v = 0 THEN 'zero'"
    return f"(CASE WHEN v < 0 THEN 'negative' WHEN v > 0 THEN 'positive' {tail} END)"


SIGNS_SQL = "(VALUES ('negative'), ('zero'), ('positive')) AS sg(sign_category)"


def _sign_sql(ch: str, policy) -> str:
    denom = "rws" if policy.null_sign_is_zero else "n_obs"
    caution = "tot > 0 AND tot < 200" if policy.caution_requires_observed else "tot < 200"
    observed = "tot > 0 AS observed_combination, " if policy.caution_requires_observed else ""
    return f"""
WITH {_long(ch)},
sg AS (SELECT t, target, v, {_sign_expr(policy)} AS sign_category FROM long),
g AS (SELECT t, sign_category, COUNT(*) AS total_count, {s_cnt('target = 1')} AS dc, {s_cnt('target = 0')} AS ndc
      FROM sg GROUP BY t, sign_category),
pt AS (SELECT t, COUNT(*) AS rws, COUNT(v) AS n_obs FROM long GROUP BY t),
d AS (SELECT * FROM {PERIODS_SQL}, {SIGNS_SQL}),
j AS (SELECT d.t, d.period, d.sign_category, CAST(COALESCE(g.total_count, 0) AS BIGINT) AS tot, dc, ndc, rws, n_obs
      FROM d LEFT JOIN g ON d.t = g.t AND d.sign_category = g.sign_category LEFT JOIN pt ON d.t = pt.t)
SELECT CAST(t AS BIGINT) AS chronological_index, period, sign_category, tot AS total_count,
  {R(s_pct0('tot', denom))} AS population_percentage, CAST(COALESCE(dc, 0) AS BIGINT) AS default_count,
  CAST(COALESCE(ndc, 0) AS BIGINT) AS non_default_count, {R(s_ratio('dc', 'tot'))} AS default_rate,
  {observed}{caution} AS caution_flag
FROM j"""


def _sign_target_sql(ch: str, policy) -> str:
    return f"""
WITH {_long(ch)},
sg AS (SELECT t, target, {_sign_expr(policy)} AS sign_category FROM long),
g AS (SELECT t, target, sign_category, COUNT(*) AS cnt FROM sg GROUP BY ALL),
c AS (SELECT t, target, COUNT(*) AS class_total FROM sg GROUP BY ALL),
d AS (SELECT * FROM {PERIODS_SQL}, {CLASSES_SQL}, {SIGNS_SQL})
SELECT CAST(d.t AS BIGINT) AS chronological_index, d.period, CAST(d.target AS BIGINT) AS target, d.sign_category,
  CAST(COALESCE(cnt, 0) AS BIGINT) AS count, {R(s_pct0('COALESCE(cnt, 0)', 'class_total'))} AS percentage
FROM d LEFT JOIN g ON d.t = g.t AND d.target = g.target AND d.sign_category = g.sign_category
LEFT JOIN c ON d.t = c.t AND d.target = c.target"""


@register("sign_summary", _sign_sql("net", BILL_POLICY))
def q_sign_summary(spark, sf_dir):
    return M.sign_summary(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


@register("payment_sign_summary", _sign_sql("paid", PAYMENT_POLICY))
def q_payment_sign_summary(spark, sf_dir):
    return M.sign_summary(customer_panel(spark, sf_dir), PANEL_SPEC, "paid", PAYMENT_POLICY)


@register("sign_by_target", _sign_target_sql("net", BILL_POLICY))
def q_sign_by_target(spark, sf_dir):
    return M.sign_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


def _change_sql(ch: str, policy, by_target: bool) -> str:
    k = ["pair_index", "source_period", "destination_period"] + (["target"] if by_target else [])
    keys = ", ".join(k)
    n = "rws" if policy.change_over_all_rows else "n_obs"
    if by_target:
        base = (f"SELECT d.*, s.* EXCLUDE ({keys}) FROM (SELECT * FROM {PAIRS_SQL}, {CLASSES_SQL}) d "
                f"LEFT JOIN s ON {_join_on(k, 'd', 's')}")
    else:
        base = "SELECT * FROM s"
    sfx = policy.quartile_suffix
    tcol = "CAST(target AS BIGINT) AS target, " if by_target else ""
    return f"""
WITH {PANEL_CTE}, pairs AS (SELECT pair_index, source_period, destination_period, target, dst - src AS v
  FROM ({panel_pairs(ch)})),
s AS ({_stats_sql(keys, M.CLASS_PROBS, 'pairs')}),
b AS ({base})
SELECT CAST(pair_index AS BIGINT) AS pair_index, source_period, destination_period, {tcol}
  CAST(COALESCE({n}, 0) AS BIGINT) AS count, {R('mean')} AS mean_change, {R('std')} AS std_change,
  {R('mn')} AS min_change, {R('q1')} AS q1{sfx}, {R('median')} AS median_change, {R('q3')} AS q3{sfx},
  {R('mx')} AS max_change, CAST(COALESCE(neg, 0) AS BIGINT) AS negative_change_count,
  CAST(COALESCE(zer, 0) AS BIGINT) AS zero_change_count, CAST(COALESCE(pos, 0) AS BIGINT) AS positive_change_count,
  {R(s_pct0('COALESCE(neg, 0)', f'COALESCE({n}, 0)'))} AS negative_change_percentage,
  {R(s_pct0('COALESCE(zer, 0)', f'COALESCE({n}, 0)'))} AS zero_change_percentage,
  {R(s_pct0('COALESCE(pos, 0)', f'COALESCE({n}, 0)'))} AS positive_change_percentage
FROM b"""


@register("adjacent_change", _change_sql("net", BILL_POLICY, False))
def q_adjacent_change(spark, sf_dir):
    return M.adjacent_change(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


@register("adjacent_change_by_target", _change_sql("net", BILL_POLICY, True))
def q_adjacent_change_by_target(spark, sf_dir):
    return M.adjacent_change_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "net", BILL_POLICY)


@register("payment_change_by_target", _change_sql("paid", PAYMENT_POLICY, True))
def q_payment_change_by_target(spark, sf_dir):
    return M.adjacent_change_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "paid", PAYMENT_POLICY)


def corr_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    a2, b2 = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    return f"(COVAR_SAMP({a2}, {b2}) / NULLIF(STDDEV_SAMP({a2}) * STDDEV_SAMP({b2}), 0))"


def _corr_sql(ch: str) -> str:
    parts = []
    for i in range(len(YEARS)):
        for j in range(len(YEARS)):
            a, b = min(i, j), max(i, j)
            parts.append(f"SELECT CAST({i + 1} AS BIGINT) AS row_index, '{YEARS[i]}' AS row_period, "
                         f"CAST({j + 1} AS BIGINT) AS column_index, '{YEARS[j]}' AS column_period, "
                         f"{R(f'c_{a}_{b}')} AS correlation FROM agg")
    aggs = ", ".join(f"{corr_sql(f'{ch}_{i + 1}', f'{ch}_{j + 1}')} AS c_{i}_{j}" for i in range(len(YEARS)) for j in range(i, len(YEARS)))
    return f"WITH {PANEL_CTE}, agg AS (SELECT {aggs} FROM panel)\n" + "\nUNION ALL ".join(parts)


@register("correlation_matrix", _corr_sql("bill"))
def q_correlation_matrix(spark, sf_dir):
    return M.correlation_matrix(customer_panel(spark, sf_dir), PANEL_SPEC, "bill")


def _range_cte(lo_p, hi_p, src="long"):
    return (f"rg AS (SELECT quantile_cont(CAST(v AS DOUBLE), {lo_p}) AS lo, quantile_cont(CAST(v AS DOUBLE), {hi_p}) AS hi "
            f"FROM {src} WHERE v IS NOT NULL)")


def display_range_sql(ch: str) -> str:
    return f"""
WITH {_long(ch)}, {_range_cte(0.01, 0.99)},
g AS (SELECT t, period, COUNT(*) AS total_count, {s_cnt('CAST(v AS DOUBLE) < lo')} AS below,
        {s_cnt('CAST(v AS DOUBLE) > hi')} AS above FROM long, rg GROUP BY ROLLUP (t, period)
      HAVING GROUPING(t, period) IN (0, 3))
SELECT CAST(COALESCE(t, 0) AS BIGINT) AS chronological_index, COALESCE(period, 'Global') AS period,
  {R('(SELECT lo FROM rg)')} AS global_low_percentile, {R('(SELECT hi FROM rg)')} AS global_high_percentile,
  CAST(total_count AS BIGINT) AS total_count, below AS below_range_count, above AS above_range_count,
  CAST(below + above AS BIGINT) AS outside_range_count, {R(s_pct('below + above', 'total_count'))} AS outside_range_percentage
FROM g"""


@register("display_range", display_range_sql("net"))
def q_display_range(spark, sf_dir):
    return M.display_range(customer_panel(spark, sf_dir), PANEL_SPEC, "net")


def _range_hist_sql(ch: str, n: int) -> str:
    binx = sql_hist_bin("CAST(v AS DOUBLE)", "rg.lo", "rg.hi", n)
    return f"""
WITH {_long(ch)}, {_range_cte(0.01, 0.99)},
bn AS (SELECT t, {binx} AS bin FROM long, rg WHERE v IS NOT NULL),
c AS (SELECT t, bin, COUNT(*) AS cnt FROM bn WHERE bin IS NOT NULL GROUP BY t, bin),
sd AS (SELECT t, {s_cnt('CAST(v AS DOUBLE) < lo')} AS below, {s_cnt('CAST(v AS DOUBLE) > hi')} AS above
       FROM long, rg WHERE v IS NOT NULL GROUP BY t),
d AS (SELECT pd.t, pd.period, b.bin FROM {PERIODS_SQL}, range(0, {n}) AS b(bin))
SELECT CAST(d.t AS BIGINT) AS chronological_index, d.period, CAST(d.bin AS BIGINT) AS bin_index,
  {R(sql_hist_edge('d.bin', 'rg.lo', 'rg.hi', n))} AS bin_left, {R(sql_hist_edge('d.bin + 1', 'rg.lo', 'rg.hi', n))} AS bin_right,
  CAST(COALESCE(cnt, 0) AS BIGINT) AS count, CAST(COALESCE(below, 0) AS BIGINT) AS below_count,
  CAST(COALESCE(above, 0) AS BIGINT) AS above_count
FROM d CROSS JOIN rg LEFT JOIN c ON d.t = c.t AND d.bin = c.bin LEFT JOIN sd ON d.t = sd.t"""


@register("range_histogram", _range_hist_sql("pay", 50))
def q_range_histogram(spark, sf_dir):
    return M.range_histogram(customer_panel(spark, sf_dir), PANEL_SPEC, "pay", 50)


def _range_hist_target_sql(ch: str, n: int) -> str:
    binx = sql_hist_bin("CAST(v AS DOUBLE)", "rg.lo", "rg.hi", n)
    return f"""
WITH {_long(ch)}, {_range_cte(0.01, 0.99)},
bn AS (SELECT t, target, {binx} AS bin FROM long, rg WHERE v IS NOT NULL),
c AS (SELECT t, target, bin, COUNT(*) AS cnt FROM bn WHERE bin IS NOT NULL GROUP BY ALL),
cl AS (SELECT t, target, COUNT(*) AS class_n, {s_cnt('CAST(v AS DOUBLE) < lo')} AS below,
         {s_cnt('CAST(v AS DOUBLE) > hi')} AS above FROM long, rg WHERE v IS NOT NULL GROUP BY ALL),
d AS (SELECT pd.t, pd.period, cl.target, b.bin FROM {PERIODS_SQL}, {CLASSES_SQL}, range(0, {n}) AS b(bin))
SELECT CAST(d.t AS BIGINT) AS chronological_index, d.period, CAST(d.target AS BIGINT) AS target,
  CAST(d.bin AS BIGINT) AS bin_index, {R(s_pct0('COALESCE(cnt, 0)', 'class_n'))} AS percentage,
  {R(s_pct0('COALESCE(below, 0)', 'class_n'))} AS below_percentage,
  {R(s_pct0('COALESCE(above, 0)', 'class_n'))} AS above_percentage
FROM d LEFT JOIN c ON d.t = c.t AND d.target = c.target AND d.bin = c.bin
LEFT JOIN cl ON d.t = cl.t AND d.target = cl.target"""


@register("range_histogram_by_target", _range_hist_target_sql("net", 50))
def q_range_histogram_by_target(spark, sf_dir):
    return M.range_histogram_by_target(customer_panel(spark, sf_dir), PANEL_SPEC, "net", 50)


@register("change_histogram", f"""
WITH {PANEL_CTE}, pairs AS (SELECT pair_index, dst - src AS v FROM ({panel_pairs('bill')}) WHERE dst - src IS NOT NULL),
{_range_cte(0.05, 0.95, 'pairs')},
bn AS (SELECT pair_index, {sql_hist_bin('CAST(v AS DOUBLE)', 'rg.lo', 'rg.hi', 40)} AS bin FROM pairs, rg),
c AS (SELECT pair_index, bin, COUNT(*) AS cnt FROM bn WHERE bin IS NOT NULL GROUP BY ALL),
sd AS (SELECT pair_index, COUNT(*) AS n, {s_cnt('CAST(v AS DOUBLE) < lo')} AS below, {s_cnt('CAST(v AS DOUBLE) > hi')} AS above
       FROM pairs, rg GROUP BY pair_index),
d AS (SELECT p.pair_index, b.bin FROM range(1, {len(YEARS)}) AS p(pair_index), range(0, 40) AS b(bin))
SELECT CAST(d.pair_index AS BIGINT) AS pair_index, CAST(d.bin AS BIGINT) AS bin_index,
  {R(sql_hist_edge('d.bin', 'rg.lo', 'rg.hi', 40))} AS bin_left, {R(sql_hist_edge('d.bin + 1', 'rg.lo', 'rg.hi', 40))} AS bin_right,
  CAST(COALESCE(cnt, 0) AS BIGINT) AS count, {R(s_pct0('COALESCE(below, 0)', 'n'))} AS below_percentage,
  {R(s_pct0('COALESCE(above, 0)', 'n'))} AS above_percentage
FROM d CROSS JOIN rg LEFT JOIN c ON d.pair_index = c.pair_index AND d.bin = c.bin LEFT JOIN sd ON d.pair_index = sd.pair_index""")
def q_change_histogram(spark, sf_dir):
    return M.change_histogram(customer_panel(spark, sf_dir), PANEL_SPEC, "bill", 40)
