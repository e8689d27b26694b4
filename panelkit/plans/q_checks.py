"""Check-suite, model and facts queries (C*, L*, N1).  ML and rule outputs have no SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import evaluate as E
from panelkit.operators import facts as N
from panelkit.operators import features as FT
from panelkit.operators import models as L
from panelkit.operators import network as NET
from panelkit.operators import split as G
from panelkit.operators import status as Q
from panelkit.operators import suites as C
from panelkit.operators.checks import union_checks
from panelkit.plans.catalog import register
from panelkit.plans.q_evaluate import _val
from panelkit.plans.q_features import PREDICTORS, STATIC_CAT, STATIC_CONT, TAB_CAT, TAB_CONT, split_panel
from panelkit.sources.testdata import PANEL_SPEC, customer_panel, lineitem_rows
from panelkit.spec import BILL_POLICY, KNOWN_STATUS_CODES, PAYMENT_POLICY
from panelkit.operators import profile as P


def _checks_status_sql() -> str:
    from panelkit.plans.q_status import BY_TARGET_SQL, PATTERNS_CTE, STATUS_BY_PERIOD_SQL, TRANSITIONS_SQL
    from panelkit.plans.sql import PANEL_CTE, s_cnt
    n = "(SELECT n FROM nn)"
    return f"""WITH q2 AS MATERIALIZED ({STATUS_BY_PERIOD_SQL.strip()}), q4 AS MATERIALIZED ({BY_TARGET_SQL.strip()}), q5 AS MATERIALIZED ({TRANSITIONS_SQL.strip()}),
q6 AS (WITH {PATTERNS_CTE} SELECT * FROM pats), nn AS (WITH {PANEL_CTE} SELECT COUNT(*) AS n, SUM(target) AS pos FROM panel),
pm AS (SELECT chronological_month_index, SUM(total_count) AS s, SUM(population_percentage) AS p FROM q2 GROUP BY 1),
bc AS (SELECT chronological_month_index AS m, raw_status_value AS v, SUM(status_count) AS c FROM q4 GROUP BY 1, 2),
bs AS (SELECT chronological_pair_index, source_raw_status, SUM(transition_count) AS s, MAX(source_status_total) AS t,
         SUM(percentage_within_source_status) AS p FROM q5 GROUP BY 1, 2),
cl AS (SELECT chronological_month_index, target_class, SUM(percentage_within_target_class) AS p, SUM(status_count) AS c
       FROM q4 GROUP BY 1, 2),
pr AS (SELECT chronological_pair_index, SUM(transition_count) AS s FROM q5 GROUP BY 1)
SELECT 'month_totals_equal_population' AS check_name, COALESCE(bool_and(s = {n}), FALSE) AS passed,
  printf('%d months checked', COUNT(*)) AS detail FROM pm
UNION ALL SELECT 'class_percentages_sum_to_100',
  COALESCE(bool_and(CASE WHEN c > 0 THEN abs(p - 100.0) <= 1e-3 ELSE TRUE END), FALSE),
  printf('max deviation %.6f', MAX(abs(p - 100.0))) FROM cl
UNION ALL SELECT 'defaults_plus_non_defaults_equal_total', {s_cnt('default_count + non_default_count <> total_count')} = 0,
  printf('%d rows off', {s_cnt('default_count + non_default_count <> total_count')}) FROM q2
UNION ALL SELECT 'default_rates_in_unit_interval', {s_cnt('default_rate < 0 OR default_rate > 1')} = 0, '' FROM q2
UNION ALL SELECT 'codes_0_and_minus2_observed', ({s_cnt('raw_status_value = 0 AND observed_combination')} > 0)
  AND ({s_cnt('raw_status_value = -2 AND observed_combination')} > 0), '' FROM q2
UNION ALL SELECT 'population_percentages_sum_to_100', COALESCE(bool_and(CASE WHEN s > 0 THEN abs(p - 100.0) <= 1e-4 ELSE TRUE END), FALSE), '' FROM pm
UNION ALL SELECT 'observed_means_counted', {s_cnt('observed_combination <> (total_count > 0)')} = 0, '' FROM q2
UNION ALL SELECT 'default_rates_match_counts',
  {s_cnt('observed_combination AND COALESCE(abs(default_rate - CAST(default_count AS DOUBLE) / CAST(NULLIF(total_count, 0) AS DOUBLE)) > 1e-6, TRUE)')} = 0, '' FROM q2
UNION ALL SELECT 'class_counts_equal_totals', COALESCE(bool_and(c = default_count + non_default_count), FALSE), ''
  FROM q2 JOIN bc ON chronological_month_index = m AND raw_status_value = v
UNION ALL SELECT 'transitions_dense', COUNT(*) = {(PANEL_SPEC.n_periods - 1) * len(KNOWN_STATUS_CODES) ** 2}, '' FROM q5
UNION ALL SELECT 'transition_defaults_add_up', {s_cnt('default_count + non_default_count <> transition_count')} = 0, '' FROM q5
UNION ALL SELECT 'source_percentages_match_counts', COALESCE(bool_and(CASE WHEN t > 0 THEN abs(p - 100.0 * s / t) <= 1e-4 ELSE TRUE END), FALSE), '' FROM bs
UNION ALL SELECT 'pattern_defaults_equal_positives', COALESCE(SUM(default_count) = (SELECT pos FROM nn), FALSE), '' FROM q6
UNION ALL SELECT 'pair_totals_within_known_codes', COALESCE(bool_and(s = {n}), FALSE),
  printf('max pair total %d of %d', MAX(s), {n}) FROM pr
UNION ALL SELECT 'pattern_totals_equal_population', COALESCE(SUM(total_count) = {n}, FALSE), printf('%d', SUM(total_count)) FROM q6
UNION ALL SELECT 'patterns_have_all_periods', {s_cnt(f"len(string_split(sequence_pattern, '|')) <> {PANEL_SPEC.n_periods}")} = 0, '' FROM q6"""


def _checks_relationship_sql() -> str:
    from panelkit.plans import q_relationship  # noqa: F401 - registers the statements used below
    from panelkit.plans.catalog import ORACLE
    from panelkit.plans.sql import PANEL_CTE, s_cnt
    return f"""WITH r1 AS MATERIALIZED ({ORACLE['relationship_summary']}), r3 AS MATERIALIZED ({ORACLE['ratio_summary']}),
r4 AS MATERIALIZED ({ORACLE['relationship_categories']}), nn AS (WITH {PANEL_CTE} SELECT COUNT(*) AS n FROM panel),
j AS (SELECT r1.*, r3.eligible_count, r3.ineligible_count, r3.ratio_max FROM r1 JOIN r3
      ON r1.chronological_index = r3.chronological_index AND r1.period = r3.period),
cats AS (SELECT chronological_index, SUM(total_count) AS s, SUM(population_percentage) AS p FROM r4 GROUP BY 1),
cl AS (SELECT chronological_index, SUM(count) AS c FROM ({ORACLE['relationship_by_target']}) GROUP BY 1)
SELECT 'eligible_plus_ineligible_equals_pairs' AS check_name,
  {s_cnt('eligible_count + ineligible_count <> positive_bill_count + nonpositive_bill_count')} = 0 AS passed, '' AS detail FROM j
UNION ALL SELECT 'eligible_equals_positive_bill', {s_cnt('eligible_count <> positive_bill_count')} = 0, '' FROM j
UNION ALL SELECT 'ratio_finite', {s_cnt("abs(ratio_max) = CAST('inf' AS DOUBLE)")} = 0, '' FROM j
UNION ALL SELECT 'correlation_finite_or_null', {s_cnt('isnan(pearson_correlation)')} = 0, '' FROM j
UNION ALL SELECT 'period_count', COUNT(*) = {PANEL_SPEC.n_periods}, '' FROM j
UNION ALL SELECT 'period_totals_equal_population', COALESCE(bool_and(total_count = (SELECT n FROM nn)), FALSE), '' FROM j
UNION ALL SELECT 'class_counts_equal_population', COALESCE(bool_and(c = (SELECT n FROM nn)), FALSE), '' FROM cl
UNION ALL SELECT 'category_defaults_add_up', {s_cnt('default_count + non_default_count <> total_count')} = 0, '' FROM r4
UNION ALL SELECT 'category_rates_in_unit_interval', {s_cnt('default_rate < 0 OR default_rate > 1')} = 0, '' FROM r4
UNION ALL SELECT 'category_percentages_match_counts', COALESCE(bool_and(abs(p - 100.0 * s / (SELECT n FROM nn)) <= 1e-4), FALSE), '' FROM cats
UNION ALL SELECT 'categories_cover_complete_pairs', COALESCE(bool_and(s = (SELECT n FROM nn)), FALSE), '' FROM cats"""


@register("checks_status", _checks_status_sql())
def q_checks_status(spark, sf_dir):
    return C.status_checks(customer_panel(spark, sf_dir), PANEL_SPEC)


def _amount_checks_sql(ch: str, policy, tag: str) -> str:
    """SELECTs of ``suites.amount_checks`` for one channel (CTE names suffixed with ``tag``)."""
    from panelkit.plans.q_amounts import _change_sql, _corr_sql, _summary_sql, display_range_sql
    from panelkit.plans.sql import s_cnt
    miss = " - missing_count" if policy.count_all_rows else ""
    rows = "count" if policy.count_all_rows else "(count + missing_count)"
    pct_dev = "abs(negative_percentage + zero_percentage + positive_percentage - 100.0)"
    s, c, r, d = f"s{tag}", f"c{tag}", f"r{tag}", f"d{tag}"
    ctes = (f"{s} AS MATERIALIZED ({_summary_sql(ch, policy).strip()}), {c} AS MATERIALIZED ({_change_sql(ch, policy, False).strip()}), "
            f"{r} AS MATERIALIZED ({_corr_sql(ch).strip()}), {d} AS MATERIALIZED ({display_range_sql(ch).strip()})")
    t = f"(SELECT a.correlation AS ac, b.correlation AS bc, a.row_index AS ri, a.column_index AS ci FROM {r} a JOIN {r} b " \
        f"ON a.row_index = b.column_index AND a.column_index = b.row_index)"
    close = "((ac IS NULL AND bc IS NULL) OR abs(ac - bc) <= 1e-9)"
    per = f"(SELECT SUM(total_count) AS pt, SUM(outside_range_count) AS po FROM {d} WHERE chronological_index > 0)"
    sel = f"""SELECT 'sign_counts_sum_to_observed' AS check_name,
  {s_cnt(f'negative_count + zero_count + positive_count <> count{miss}')} = 0 AS passed, '' AS detail FROM {s}
UNION ALL SELECT 'sign_percentages_sum_to_100', COALESCE(MAX({pct_dev}) <= 1e-5, FALSE), printf('%.8f', MAX({pct_dev})) FROM {s}
UNION ALL SELECT 'iqr_non_negative', COALESCE(MIN(iqr) >= 0, FALSE), '' FROM {s}
UNION ALL SELECT 'fence_formula', COALESCE(MAX(abs(lower_fence - (p25 - 1.5 * iqr))) <= 1e-5, FALSE), '' FROM {s}
UNION ALL SELECT 'period_count', COUNT(*) = {PANEL_SPEC.n_periods}, '' FROM {s}
UNION ALL SELECT 'percentiles_ordered', COALESCE(bool_and(min <= p01 AND p01 <= p25 AND p25 <= median AND median <= p75 AND p75 <= p99 AND p99 <= max), FALSE), '' FROM {s}
UNION ALL SELECT 'iqr_is_quartile_distance', COALESCE(MAX(abs(iqr - (p75 - p25))) <= 1e-5, FALSE), '' FROM {s}
UNION ALL SELECT 'upper_fence_formula', COALESCE(MAX(abs(upper_fence - (p75 + 1.5 * iqr))) <= 1e-5, FALSE), '' FROM {s}
UNION ALL SELECT 'extremes_are_both_tails', {s_cnt('below_lower_fence_count + above_upper_fence_count <> total_potential_extreme_count')} = 0, '' FROM {s}
UNION ALL SELECT 'rows_equal_population', COALESCE(bool_and({rows} = (SELECT n FROM nn)), FALSE), '' FROM {s}
UNION ALL SELECT 'change_counts_equal_population', COALESCE(bool_and(count = (SELECT n FROM nn)), FALSE), '' FROM {c}
UNION ALL SELECT 'change_signs_sum_to_observed', COALESCE(bool_and(negative_change_count + zero_change_count + positive_change_count = (SELECT n FROM nn)), FALSE), '' FROM {c}
UNION ALL SELECT 'pair_count', COUNT(*) = {PANEL_SPEC.n_periods - 1}, '' FROM {c}
UNION ALL SELECT 'correlation_matrix_square', COUNT(*) = {PANEL_SPEC.n_periods ** 2}, printf('%d cells', COUNT(*)) FROM {t}
UNION ALL SELECT 'correlation_symmetric', {s_cnt(f'NOT {close}')} = 0, '' FROM {t}
UNION ALL SELECT 'correlation_unit_diagonal', {s_cnt('ri = ci AND (ac IS NULL OR abs(ac - 1.0) > 1e-6)')} = 0, '' FROM {t}
UNION ALL SELECT 'correlations_within_unit', {s_cnt('abs(ac) > 1.0 + 1e-9')} = 0, '' FROM {t}
UNION ALL SELECT 'low_percentile_below_high', COALESCE(bool_and(global_low_percentile < global_high_percentile), FALSE), ''
  FROM {d} WHERE chronological_index = 0
UNION ALL SELECT 'global_equals_sum_of_periods', COALESCE(bool_and(total_count = p.pt AND outside_range_count = p.po), FALSE), ''
  FROM {d}, {per} p WHERE chronological_index = 0"""
    return ctes, sel


def _checks_panel_sql() -> str:
    from panelkit.plans.sql import PANEL_CTE
    c1, s1 = _amount_checks_sql("net", BILL_POLICY, "n")
    c2, s2 = _amount_checks_sql("pay", PAYMENT_POLICY, "p")
    return f"WITH nn AS (WITH {PANEL_CTE} SELECT COUNT(*) AS n FROM panel), {c1}, {c2}\n{s1}\nUNION ALL {s2}"


@register("checks_panel", _checks_panel_sql())
def q_checks_panel(spark, sf_dir):
    p = customer_panel(spark, sf_dir)
    return union_checks(C.amount_checks(p, PANEL_SPEC, "net", BILL_POLICY),
                        C.amount_checks(p, PANEL_SPEC, "pay", PAYMENT_POLICY))


@register("checks_relationship", _checks_relationship_sql())
def q_checks_relationship(spark, sf_dir):
    return C.relationship_checks(customer_panel(spark, sf_dir), PANEL_SPEC)


def _checks_split_sql() -> str:
    from panelkit.plans.q_features import SP
    from panelkit.plans.q_split import manifest_checks_sql
    return manifest_checks_sql(SP, "SELECT c_custkey AS ID, split, target, gid AS predictor_group_id FROM sp",
                               "SELECT c_custkey AS ID, target AS raw_t, gid AS raw_g FROM pg")


@register("checks_split", _checks_split_sql())
def q_checks_split(spark, sf_dir):
    p = G.with_group_id(customer_panel(spark, sf_dir), PREDICTORS)
    manifest = G.stratified_group_split(p, id_col="c_custkey", target="target", mode="hash")
    return G.verify_manifest(manifest, customer_panel(spark, sf_dir).withColumnRenamed("c_custkey", "ID"),
                             "ID", "target", PREDICTORS)


def _prepared(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    params = FT.fit_robust(tr, TAB_CONT)
    cats = FT.fit_one_hot(tr, TAB_CAT)
    return sp.select("c_custkey", "split", "target", FT.tabular_representation(TAB_CONT, params, cats).alias("tabular"))


def _fit_score(spark, sf_dir, name, fit):
    prep = L.to_ml(_prepared(spark, sf_dir), "tabular")
    train = L.with_weights(prep.where(F.col("split") == "train"))
    val = prep.where(F.col("split") == "validation")
    return L.score(fit(train), val, name, "c_custkey")


@register("model_logistic_regression")
def q_model_logistic_regression(spark, sf_dir):
    return _fit_score(spark, sf_dir, "logistic_regression", L.logistic_regression)


_GBT: dict = {}


def _gbt(spark, sf_dir):
    """Fit the GBT once per session and folder (two queries read it)."""
    key = (id(spark), sf_dir)
    if key not in _GBT:
        prep = L.to_ml(_prepared(spark, sf_dir), "tabular")
        train = L.with_weights(prep.where(F.col("split") == "train"))
        # validation loss is unweighted (every row weight 1)
        val = prep.where(F.col("split") == "validation").withColumn(L.WEIGHT, F.lit(1.0))
        _GBT[key] = (L.gradient_boosting(train), val)
    return _GBT[key]


@register("model_gradient_boosting")
def q_model_gradient_boosting(spark, sf_dir):
    model, val = _gbt(spark, sf_dir)
    return L.score(model, val, "gradient_boosting", "c_custkey")


@register("model_sequence_mlp")
def q_model_sequence_mlp(spark, sf_dir):
    """L3: the weighted two-block network over the temporal tensor and the static features."""
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    ch, params, cats = FT.fit_channel_scalers(tr, PANEL_SPEC), FT.fit_robust(tr, STATIC_CONT), FT.fit_one_hot(tr, STATIC_CAT)
    prep = sp.select("c_custkey", "split", F.col("target").cast("long").alias(L.LABEL), "target", FT.temporal_representation(PANEL_SPEC, ch).alias("temporal"),
                     FT.static_representation(sp, STATIC_CONT, params, cats).alias("static"))
    train, val = L.with_weights(prep.where(F.col("split") == "train")), prep.where(F.col("split") == "validation")
    shape = NET.Shape(PANEL_SPEC.n_periods, 3, len(STATIC_CONT) + sum(map(len, cats.values())))
    return NET.fit(train, val, shape).score(val, "c_custkey", name="sequence_mlp")


@register("early_stop_epoch")
def q_early_stop_epoch(spark, sf_dir):
    model, val = _gbt(spark, sf_dir)
    return L.early_stop(L.gbt_history(model, val, "gradient_boosting"))


def _facts_sql() -> str:
    from panelkit.plans import q_evaluate, q_profile, q_status  # noqa: F401 - registers the statements used below
    from panelkit.plans.catalog import ORACLE
    from panelkit.plans.q_evaluate import VAL, search_cte

    def rows(src: str, section: str, subject: str, metrics: list[str]) -> str:
        return "\n  UNION ALL ".join(
            f"SELECT '{section}' AS section, CAST({subject} AS VARCHAR) AS subject, '{m}' AS metric, "
            f"CAST({m} AS DOUBLE) AS value FROM ({src})" for m in metrics)
    best = f"{VAL}, {search_cte('v')} SELECT * FROM best"
    parts = [rows(ORACLE["target_summary"], "static", "class_label", ["count", "percentage",
                                                                      "imbalance_ratio_majority_to_minority"]),
             rows(ORACLE["sequence_coverage"], "status", "'sequences'", ["code_0_total", "code_minus2_total",
                                                                         "distinct_patterns", "topk_count", "topk_percentage"]),
             rows(ORACLE["modal_status"], "status", "concat_ws(':', period, target_class)",
                  ["raw_status_value", "percentage_within_target_class"]),
             rows(best, "evaluation", "model_name", ["threshold", "default_f1", "pr_auc", "roc_auc"])]
    return "\nUNION ALL ".join(parts)


@register("facts", _facts_sql())
def q_facts(spark, sf_dir):
    p = customer_panel(spark, sf_dir)
    li = lineitem_rows(spark, sf_dir)
    ts = P.target_summary(li, "target")
    cov = Q.sequence_coverage(p, PANEL_SPEC)
    modal = Q.modal_status(Q.status_by_period_target(p, PANEL_SPEC))
    best = E.best_threshold(E.threshold_search(_val(spark, sf_dir)))
    return N.facts([
        N.fact_rows(ts, "static", "class_label", ["count", "percentage", "imbalance_ratio_majority_to_minority"]),
        N.fact_rows(cov, "status", F.lit("sequences"), ["code_0_total", "code_minus2_total", "distinct_patterns",
                                                        "topk_count", "topk_percentage"]),
        N.fact_rows(modal, "status", F.concat_ws(":", "period", "target_class"),
                    ["raw_status_value", "percentage_within_target_class"]),
        N.fact_rows(best, "evaluation", "model_name", ["threshold", "default_f1", "pr_auc", "roc_auc"]),
    ])


def _checks_static_sql() -> str:
    from panelkit.plans import q_profile  # noqa: F401 - registers the statements used below
    from panelkit.plans.catalog import ORACLE
    from panelkit.plans.sql import s_cnt
    return f"""WITH ts AS ({ORACLE['target_summary']}), rates AS ({ORACLE['categorical_default_rates']}),
pf AS (SELECT feature, SUM(total_count) AS s, SUM(default_count) AS d FROM rates GROUP BY feature),
nn AS (SELECT COUNT(*) AS n, {s_cnt("l_returnflag = 'R'")} AS pos FROM lineitem)
SELECT 'target_total_equals_rows' AS check_name, COALESCE(SUM(count) = (SELECT n FROM nn), FALSE) AS passed,
  printf('%d', SUM(count)) AS detail FROM ts
UNION ALL SELECT 'percentages_sum_to_100', COALESCE(abs(SUM(percentage) - 100.0) <= 1e-3, FALSE), '' FROM ts
UNION ALL SELECT 'defaults_plus_non_defaults_equal_total',
  {s_cnt('default_count + non_default_count <> total_count')} = 0, '' FROM rates
UNION ALL SELECT 'default_rates_in_unit_interval', {s_cnt('default_rate < 0 OR default_rate > 1')} = 0, '' FROM rates
UNION ALL SELECT 'category_totals_equal_rows', COALESCE(bool_and(s = (SELECT n FROM nn)), FALSE),
  printf('%d features', COUNT(*)) FROM pf
UNION ALL SELECT 'grouped_defaults_equal_positives', COALESCE(bool_and(d = (SELECT pos FROM nn)), FALSE), '' FROM pf"""


@register("checks_static", _checks_static_sql())
def q_checks_static(spark, sf_dir):
    from panelkit.sources.testdata import LINEITEM_CODEBOOK
    return C.static_checks(lineitem_rows(spark, sf_dir), ["l_linestatus", "l_linenumber"], "target", LINEITEM_CODEBOOK)


def _shape_checks_sql() -> str:
    from panelkit.plans import q_features  # noqa: F401 - registers the statements used below
    from panelkit.plans.catalog import ORACLE
    from panelkit.plans.q_features import SP, TAB_CAT, TAB_CONT, _cats_sql
    from panelkit.plans.sql import s_cnt
    width = f"({len(TAB_CONT)} + " + " + ".join(f"len({c}_cats)" for c in TAB_CAT) + ")"
    n = PANEL_SPEC.n_periods
    return f"""WITH tab AS ({ORACLE['tabular_features']}), tem AS ({ORACLE['temporal_features']}),
{SP}, {_cats_sql(TAB_CAT)}, w AS (SELECT {width} AS width FROM cats)
SELECT 'tabular_length_' || CAST((SELECT width FROM w) AS VARCHAR) AS check_name,
  {s_cnt('len(tabular) <> (SELECT width FROM w)')} = 0 AS passed,
  printf('%d rows off', {s_cnt('len(tabular) <> (SELECT width FROM w)')}) AS detail FROM tab
UNION ALL SELECT 'temporal_length_{n}', {s_cnt(f'len(temporal) <> {n}')} = 0, printf('%d rows off', {s_cnt(f'len(temporal) <> {n}')}) FROM tem
UNION ALL SELECT 'temporal_flat_length_{n * 3}', {s_cnt(f'len(flatten(temporal)) <> {n * 3}')} = 0,
  printf('%d rows off', {s_cnt(f'len(flatten(temporal)) <> {n * 3}')}) FROM tem"""


@register("shape_checks", _shape_checks_sql())
def q_shape_checks(spark, sf_dir):
    """Every prepared row has the expected tabular width and a periods x 3 tensor."""
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    params = FT.fit_robust(tr, TAB_CONT)
    cats = FT.fit_one_hot(tr, TAB_CAT)
    ch = FT.fit_channel_scalers(tr, PANEL_SPEC)
    width = len(TAB_CONT) + sum(len(v) for v in cats.values())
    rep = sp.select(FT.tabular_representation(TAB_CONT, params, cats).alias("tabular"),
                    FT.temporal_representation(PANEL_SPEC, ch).alias("temporal"),
                    F.flatten(FT.temporal_representation(PANEL_SPEC, ch)).alias("temporal_flat"))
    return L.shape_checks(rep, {"tabular": width, "temporal": PANEL_SPEC.n_periods,
                                "temporal_flat": PANEL_SPEC.n_periods * 3})


@register("prediction_reconciliation")
def q_prediction_reconciliation(spark, sf_dir):
    """E15 on the scored logistic-regression predictions."""
    return C.reconciliation_checks(q_model_logistic_regression(spark, sf_dir))
