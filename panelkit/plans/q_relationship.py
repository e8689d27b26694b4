"""Bill x payment relationship queries (R*) on the customer-year panel."""

from __future__ import annotations

from panelkit.operators import relationship as REL
from panelkit.plans.catalog import register
from panelkit.plans.q_amounts import CLASSES_SQL, PERIODS_SQL, corr_sql
from panelkit.plans.sql import PANEL_CTE, panel_long, s_cnt, s_pct0, s_ratio, sql_hist_bin, sql_rnd
from panelkit.sources.testdata import PANEL_SPEC, customer_panel
from panelkit.spec import RELATIONSHIP_CATEGORIES

R = lambda e: sql_rnd(e, 6)
PAIRS = f"{PANEL_CTE}, long AS (SELECT t, period, target, bill AS b, pay AS p FROM ({panel_long(('bill', 'pay'))}))"


def _mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / CAST(NULLIF(COUNT({x}), 0) AS DOUBLE))"


def _med(x: str) -> str:
    return f"quantile_cont(CAST({x} AS DOUBLE), 0.5)"


BOTH = "b IS NOT NULL AND p IS NOT NULL"


@register("relationship_summary", f"""
WITH {PAIRS}
SELECT CAST(t AS BIGINT) AS chronological_index, period, CAST(COUNT(*) AS BIGINT) AS total_count,
  {R(_mean('b'))} AS bill_mean, {R(_med('b'))} AS bill_median, {R(_mean('p'))} AS payment_mean,
  {R(_med('p'))} AS payment_median, {R(corr_sql('b', 'p'))} AS pearson_correlation,
  {s_cnt(f'{BOTH} AND p = 0')} AS zero_payment_count, {s_cnt(f'{BOTH} AND b > 0')} AS positive_bill_count,
  {s_cnt(f'{BOTH} AND b <= 0')} AS nonpositive_bill_count,
  {s_cnt(f'{BOTH} AND b > 0 AND p = 0')} AS positive_bill_and_zero_payment_count,
  {s_cnt(f'{BOTH} AND b > 0 AND p > 0')} AS positive_bill_and_positive_payment_count,
  {R(_mean(f'CASE WHEN {BOTH} THEN p - b END'))} AS same_index_difference_mean,
  {R(_med(f'CASE WHEN {BOTH} THEN p - b END'))} AS same_index_difference_median
FROM long GROUP BY t, period""")
def q_relationship_summary(spark, sf_dir):
    return REL.relationship_summary(customer_panel(spark, sf_dir), PANEL_SPEC)


@register("relationship_by_target", f"""
WITH {PAIRS},
g AS (SELECT t, target, COUNT(*) AS n, {corr_sql('b', 'p')} AS r, {s_cnt(f'{BOTH} AND p = 0')} AS zp,
        {s_cnt(f'{BOTH} AND b > 0 AND p = 0')} AS pbzp, {_med(f'CASE WHEN {BOTH} THEN b END')} AS bm,
        {_med(f'CASE WHEN {BOTH} THEN p END')} AS pm, {_med(f'CASE WHEN {BOTH} THEN p - b END')} AS dm
      FROM long GROUP BY t, target),
d AS (SELECT * FROM {PERIODS_SQL}, {CLASSES_SQL})
SELECT CAST(d.t AS BIGINT) AS chronological_index, d.period, CAST(d.target AS BIGINT) AS target,
  CAST(COALESCE(n, 0) AS BIGINT) AS count, {R('bm')} AS bill_median, {R('pm')} AS payment_median,
  {R('r')} AS pearson_correlation, CAST(COALESCE(zp, 0) AS BIGINT) AS zero_payment_count,
  {R(s_pct0('COALESCE(zp, 0)', 'COALESCE(n, 0)'))} AS zero_payment_percentage,
  CAST(COALESCE(pbzp, 0) AS BIGINT) AS positive_bill_and_zero_payment_count,
  {R(s_pct0('COALESCE(pbzp, 0)', 'COALESCE(n, 0)'))} AS positive_bill_and_zero_payment_percentage,
  {R('dm')} AS same_index_difference_median
FROM d LEFT JOIN g ON d.t = g.t AND d.target = g.target""")
def q_relationship_by_target(spark, sf_dir):
    return REL.relationship_by_target(customer_panel(spark, sf_dir), PANEL_SPEC)


def _ratio_sql(by_target: bool) -> str:
    k = "t, period, target" if by_target else "t, period"
    qs = ", ".join(f"quantile_cont(ratio, {p}) AS {n}" for n, p in REL.RATIO_PROBS.items())
    base = (f"SELECT d.t, d.period, d.target, g.* EXCLUDE (t, period, target) FROM (SELECT * FROM {PERIODS_SQL}, {CLASSES_SQL}) d "
            f"LEFT JOIN g ON d.t = g.t AND d.target = g.target") if by_target else "SELECT * FROM g"
    st = lambda c, m=1: f"CASE WHEN COALESCE(elig, 0) >= {m} THEN {R(c)} END AS {c}"
    tcol = "CAST(target AS BIGINT) AS target, " if by_target else ""
    return f"""
WITH {PAIRS},
rt AS (SELECT *, CASE WHEN b > 0 THEN CAST(p AS DOUBLE) / CAST(b AS DOUBLE) END AS ratio FROM long WHERE {BOTH}),
g AS (SELECT {k}, COUNT(*) AS tot, {s_cnt('b > 0')} AS elig, AVG(ratio) AS ratio_mean, STDDEV_SAMP(ratio) AS ratio_std,
        MIN(ratio) AS ratio_min, MAX(ratio) AS ratio_max, {s_cnt('ratio = 0')} AS zc, {s_cnt('ratio = 1')} AS oc,
        {s_cnt('ratio > 1')} AS ac, {qs} FROM rt GROUP BY {k}),
b AS ({base})
SELECT CAST(t AS BIGINT) AS chronological_index, period, {tcol}CAST(COALESCE(elig, 0) AS BIGINT) AS eligible_count,
  CAST(COALESCE(tot, 0) - COALESCE(elig, 0) AS BIGINT) AS ineligible_count,
  {R(s_pct0('COALESCE(elig, 0)', 'COALESCE(tot, 0)'))} AS eligible_percentage,
  {st('ratio_mean')}, {st('ratio_std', 2)}, {st('ratio_min')}, {', '.join(st(n) for n in REL.RATIO_PROBS)}, {st('ratio_max')},
  CASE WHEN COALESCE(elig, 0) >= 1 THEN {R('ratio_p75 - ratio_p25')} END AS ratio_iqr,
  CAST(COALESCE(zc, 0) AS BIGINT) AS ratio_zero_count, CAST(COALESCE(oc, 0) AS BIGINT) AS ratio_equal_one_count,
  CAST(COALESCE(ac, 0) AS BIGINT) AS ratio_above_one_count
FROM b"""


@register("ratio_summary", _ratio_sql(False))
def q_ratio_summary(spark, sf_dir):
    return REL.ratio_summary(customer_panel(spark, sf_dir), PANEL_SPEC)


@register("ratio_by_target", _ratio_sql(True))
def q_ratio_by_target(spark, sf_dir):
    return REL.ratio_by_target(customer_panel(spark, sf_dir), PANEL_SPEC)


def _cat_sql() -> str:
    c = RELATIONSHIP_CATEGORIES
    cat = (f"CASE WHEN b <= 0 AND p = 0 THEN '{c[0]}' WHEN b <= 0 AND p > 0 THEN '{c[1]}' "
           f"WHEN b > 0 AND p = 0 THEN '{c[2]}' WHEN b > 0 AND p > 0 THEN '{c[3]}' END")
    cats = "(VALUES " + ", ".join(f"('{x}')" for x in c) + ") AS ct(category)"
    return f"""
WITH {PAIRS},
c AS (SELECT t, target, {cat} AS category FROM long),
g AS (SELECT t, category, COUNT(*) AS tot, {s_cnt('target = 1')} AS dc, {s_cnt('target = 0')} AS ndc FROM c GROUP BY ALL),
n AS (SELECT t, COUNT(*) AS n FROM c GROUP BY t),
d AS (SELECT * FROM {PERIODS_SQL}, {cats})
SELECT CAST(d.t AS BIGINT) AS chronological_index, d.period, d.category, CAST(COALESCE(tot, 0) AS BIGINT) AS total_count,
  {R(s_pct0('COALESCE(tot, 0)', 'n'))} AS population_percentage, CAST(COALESCE(dc, 0) AS BIGINT) AS default_count,
  CAST(COALESCE(ndc, 0) AS BIGINT) AS non_default_count, {R(s_ratio('dc', 'COALESCE(tot, 0)'))} AS default_rate,
  COALESCE(tot, 0) > 0 AND COALESCE(tot, 0) < 200 AS caution_flag
FROM d LEFT JOIN g ON d.t = g.t AND d.category = g.category LEFT JOIN n ON d.t = n.t"""


@register("relationship_categories", _cat_sql())
def q_relationship_categories(spark, sf_dir):
    return REL.relationship_categories(customer_panel(spark, sf_dir), PANEL_SPEC)


@register("density_2d", f"""
WITH {PAIRS},
c AS (SELECT * FROM long WHERE {BOTH}),
rg AS (SELECT quantile_cont(CAST(b AS DOUBLE), 0.01) AS blo, quantile_cont(CAST(b AS DOUBLE), 0.99) AS bhi,
         quantile_cont(CAST(p AS DOUBLE), 0.01) AS plo, quantile_cont(CAST(p AS DOUBLE), 0.99) AS phi FROM c),
cells AS (SELECT t, period, {sql_hist_bin('CAST(b AS DOUBLE)', 'blo', 'bhi', 50)} AS x_bin,
            {sql_hist_bin('CAST(p AS DOUBLE)', 'plo', 'phi', 50)} AS y_bin FROM c, rg)
SELECT CAST(t AS BIGINT) AS chronological_index, period, CAST(x_bin AS BIGINT) AS x_bin, CAST(y_bin AS BIGINT) AS y_bin,
  CAST(COUNT(*) AS BIGINT) AS count
FROM cells WHERE x_bin IS NOT NULL AND y_bin IS NOT NULL GROUP BY ALL""")
def q_density_2d(spark, sf_dir):
    return REL.density_2d(customer_panel(spark, sf_dir), PANEL_SPEC)
