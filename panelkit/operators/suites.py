"""Quality-check suites (C1-C10) over operator outputs.

Every suite evaluates its rules as one aggregation per (small) result table via
``checks.run_checks`` and returns ``(check_name, passed, detail)`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if
from panelkit.operators import amounts as M
from panelkit.operators import relationship as REL
from panelkit.operators import status as Q
from panelkit.operators.checks import Rule, close, run_checks, union_checks
from panelkit.session import track
from panelkit.spec import BILL_POLICY, KNOWN_STATUS_CODES, PanelSpec


def _fmt(fmt: str, *cols) -> F.Column:
    return F.format_string(fmt, *cols)


def status_checks(df: DataFrame, spec: PanelSpec, channel: str = "status") -> DataFrame:
    """Month sums and %, class sums and %, adds-up, rates, pair sums, dense transitions and their %, pattern
    sums and width, codes 0 / -2 seen."""
    n = df.select(F.count(F.lit(1))).scalar()
    q2 = Q.status_by_period(df, spec, channel)
    per_month = q2.groupBy("chronological_month_index").agg(F.sum("total_count").alias("s"), F.sum("population_percentage").alias("p"))
    q4 = Q.status_by_period_target(df, spec, channel)
    cls = q4.groupBy("chronological_month_index", "target_class").agg(
        F.sum("percentage_within_target_class").alias("p"), F.sum("status_count").alias("c"))
    q5 = Q.status_transitions(df, spec, channel)
    pair = q5.groupBy("chronological_pair_index").agg(F.sum("transition_count").alias("s"))
    both_known = F.col("src").isin(*KNOWN_STATUS_CODES) & F.col("dst").isin(*KNOWN_STATUS_CODES)
    known = spec.pairs_long(df, channel).groupBy((F.col("pair_index") - 1).alias("_pi")).agg(count_if(both_known).alias("known"))
    pair = pair.join(known, pair["chronological_pair_index"] == known["_pi"], "left")  # one row a pair
    q6 = Q.sequence_patterns(df, spec, channel)
    width = spec.n_periods
    positives = df.select(count_if(F.col(spec.target) == spec.positive)).scalar()
    by_code = q4.groupBy(F.col("chronological_month_index").alias("_m"), F.col("raw_status_value").alias("_v")).agg(F.sum("status_count").alias("c"))
    classes = q2.join(by_code, (F.col("chronological_month_index") == F.col("_m")) & (F.col("raw_status_value") == F.col("_v")))  # one row a code of a period
    by_source = q5.groupBy("chronological_pair_index", "source_raw_status").agg(
        F.sum("transition_count").alias("s"), F.max("source_status_total").alias("t"), F.sum("percentage_within_source_status").alias("p"))
    off = F.col("default_rate") - F.try_divide(F.col("default_count").cast("double"), F.col("total_count").cast("double"))
    return union_checks(
        run_checks(per_month, [Rule("month_totals_equal_population", F.min(F.col("s") == n) & F.max(F.col("s") == n),
                                    _fmt("%d months checked", F.count(F.lit(1)))),
                               Rule("population_percentages_sum_to_100",
                                    F.min(F.when(F.col("s") > 0, F.abs(F.col("p") - 100.0) <= 1e-4).otherwise(F.lit(True))), F.lit(""))]),
        run_checks(cls, [Rule("class_percentages_sum_to_100",
                              F.min(F.when(F.col("c") > 0, F.abs(F.col("p") - 100.0) <= 1e-3).otherwise(F.lit(True))),
                              _fmt("max deviation %.6f", F.max(F.abs(F.col("p") - 100.0))))]),
        run_checks(q2, [
            Rule("defaults_plus_non_defaults_equal_total",
                 count_if(F.col("default_count") + F.col("non_default_count") != F.col("total_count")) == 0,
                 _fmt("%d rows off", count_if(F.col("default_count") + F.col("non_default_count") != F.col("total_count")))),
            Rule("default_rates_in_unit_interval",
                 count_if((F.col("default_rate") < 0) | (F.col("default_rate") > 1)) == 0, F.lit("")),
            Rule("codes_0_and_minus2_observed",
                 (count_if((F.col("raw_status_value") == 0) & F.col("observed_combination")) > 0)
                 & (count_if((F.col("raw_status_value") == -2) & F.col("observed_combination")) > 0), F.lit("")),
            Rule("observed_means_counted", count_if(F.col("observed_combination") != (F.col("total_count") > 0)) == 0, F.lit("")),
            Rule("default_rates_match_counts", count_if(F.col("observed_combination") & F.coalesce(F.abs(off) > 1e-6, F.lit(True))) == 0, F.lit("")),
        ]),
        run_checks(classes, [Rule("class_counts_equal_totals", F.min(F.col("c") == F.col("default_count") + F.col("non_default_count")), F.lit(""))]),
        run_checks(pair, [Rule("pair_totals_within_known_codes", F.min(F.col("s") == F.coalesce("known", F.lit(0))),
                               _fmt("max pair total %d of %d", F.max("s"), F.max("known")))]),
        run_checks(q5, [
            Rule("transitions_dense", F.count(F.lit(1)) == (width - 1) * len(KNOWN_STATUS_CODES) ** 2, F.lit("")),
            Rule("transition_defaults_add_up", count_if(F.col("default_count") + F.col("non_default_count") != F.col("transition_count")) == 0, F.lit("")),
        ]),
        run_checks(by_source, [Rule("source_percentages_match_counts", F.min(F.when(
            F.col("t") > 0, F.abs(F.col("p") - F.try_divide(100.0 * F.col("s"), F.col("t"))) <= 1e-4).otherwise(F.lit(True))), F.lit(""))]),
        run_checks(q6, [Rule("pattern_defaults_equal_positives", F.sum("default_count") == positives, F.lit("")),
                        Rule("pattern_totals_equal_population", F.sum("total_count") == n, _fmt("%d", F.sum("total_count"))),
                        Rule("patterns_have_all_periods",
                             count_if(F.size(F.split(F.col("sequence_pattern"), r"\|")) != width) == 0, F.lit(""))]),
    )


def amount_checks(df: DataFrame, spec: PanelSpec, channel: str, policy=BILL_POLICY) -> DataFrame:
    """Sign sums, % sums, fence formula, IQR >= 0, change counts, correlation shape,
    display-range order and global = sum of periods, no percentage-change column."""
    s = M.panel_summary(df, spec, channel, policy)
    ch = M.adjacent_change(df, spec, channel, policy)
    M.assert_no_percentage_change(ch)
    # a few rows each, read by several rules
    corr = track(M.correlation_matrix(df, spec, channel))
    dr = track(M.display_range(df, spec, channel))
    n = df.select(F.count(F.lit(1))).scalar()
    # one row a pair: all rows, and those with both values
    pairs = spec.pairs_long(df, channel).groupBy("pair_index").agg(
        F.count(F.lit(1)).alias("all_pairs"), count_if(F.col("src").isNotNull() & F.col("dst").isNotNull()).alias("observed_pairs"))
    sign_sum = F.col("negative_count") + F.col("zero_count") + F.col("positive_count")
    pct_sum = F.col("negative_percentage") + F.col("zero_percentage") + F.col("positive_percentage")
    fence_lo = F.col("p25") - 1.5 * F.col("iqr")
    t = corr.alias("a").join(corr.alias("b"), (F.col("a.row_index") == F.col("b.column_index"))
                             & (F.col("a.column_index") == F.col("b.row_index")))
    glob = dr.where(F.col("chronological_index") == 0)
    per = dr.where(F.col("chronological_index") > 0).agg(F.sum("total_count").alias("t"), F.sum("outside_range_count").alias("o"))
    per_t, per_o = per.select("t").scalar(), per.select("o").scalar()
    return union_checks(
        run_checks(s, [
            Rule("sign_counts_sum_to_observed", count_if(sign_sum != F.col("count") - (F.col("missing_count") if policy.count_all_rows else F.lit(0))) == 0, F.lit("")),
            Rule("sign_percentages_sum_to_100", F.max(F.abs(pct_sum - 100.0)) <= 1e-5, _fmt("%.8f", F.max(F.abs(pct_sum - 100.0)))),
            Rule("iqr_non_negative", F.min("iqr") >= 0, F.lit("")),
            Rule("fence_formula", F.max(F.abs(F.col("lower_fence") - fence_lo)) <= 1e-5, F.lit("")),
            Rule("period_count", F.count(F.lit(1)) == spec.n_periods, F.lit("")),
            Rule("percentiles_ordered", F.min((F.col("min") <= F.col("p01")) & (F.col("p01") <= F.col("p25")) & (F.col("p25") <= F.col("median"))
                                              & (F.col("median") <= F.col("p75")) & (F.col("p75") <= F.col("p99")) & (F.col("p99") <= F.col("max"))), F.lit("")),
            Rule("iqr_is_quartile_distance", F.max(F.abs(F.col("iqr") - (F.col("p75") - F.col("p25")))) <= 1e-5, F.lit("")),
            Rule("upper_fence_formula", F.max(F.abs(F.col("upper_fence") - (F.col("p75") + 1.5 * F.col("iqr")))) <= 1e-5, F.lit("")),
            Rule("extremes_are_both_tails", count_if(F.col("below_lower_fence_count") + F.col("above_upper_fence_count") != F.col("total_potential_extreme_count")) == 0, F.lit("")),
            Rule("rows_equal_population", F.min((F.col("count") if policy.count_all_rows else F.col("count") + F.col("missing_count")) == n), F.lit("")),
        ]),
        run_checks(ch.join(pairs, "pair_index", "left"), [
            Rule("change_counts_equal_population", F.min(F.col("count") == F.col("all_pairs" if policy.change_over_all_rows else "observed_pairs")), F.lit("")),
            Rule("change_signs_sum_to_observed", F.min(F.col("negative_change_count") + F.col("zero_change_count") + F.col("positive_change_count") == F.col("observed_pairs")), F.lit("")),
            Rule("pair_count", F.count(F.lit(1)) == spec.n_periods - 1, F.lit("")),
        ]),
        run_checks(t, [
            Rule("correlation_matrix_square", F.count(F.lit(1)) == spec.n_periods ** 2, _fmt("%d cells", F.count(F.lit(1)))),
            Rule("correlation_symmetric", count_if(~close(F.col("a.correlation"), F.col("b.correlation"), 1e-9)) == 0, F.lit("")),
            Rule("correlation_unit_diagonal",
                 count_if((F.col("a.row_index") == F.col("a.column_index"))
                          & F.coalesce(F.abs(F.col("a.correlation") - 1.0) > 1e-6, F.lit(True))) == 0, F.lit("")),
            Rule("correlations_within_unit", count_if(F.abs(F.col("a.correlation")) > 1.0 + 1e-9) == 0, F.lit("")),
        ]),
        run_checks(glob, [
            Rule("low_percentile_below_high", F.min(F.col("global_low_percentile") < F.col("global_high_percentile")), F.lit("")),
            Rule("global_equals_sum_of_periods", F.min((F.col("total_count") == per_t) & (F.col("outside_range_count") == per_o)), F.lit("")),
        ]),
    )


def relationship_checks(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay") -> DataFrame:
    """Periods and their totals, class sums, eligible + ineligible = total, eligible = positive-bill count, no
    infinite ratio, category totals, % and default counts, rate bounds, r finite.  (A negative payment fails the job.)"""
    n = df.select(F.count(F.lit(1))).scalar()
    r1 = REL.relationship_summary(df, spec, bill, pay)
    r3 = REL.ratio_summary(df, spec, bill, pay)
    r4 = REL.relationship_categories(df, spec, bill, pay)
    j = r1.join(r3, ["chronological_index", "period"])
    cats = r4.groupBy("chronological_index").agg(F.sum("total_count").alias("s"), F.sum("population_percentage").alias("p"))
    classes = REL.relationship_by_target(df, spec, bill, pay).groupBy("chronological_index").agg(F.sum("count").alias("c"))
    complete = spec.to_long(df, [bill, pay]).groupBy(F.col("t").alias("_t")).agg(count_if(F.col(bill).isNotNull() & F.col(pay).isNotNull()).alias("complete"))
    cats = cats.join(complete, cats["chronological_index"] == complete["_t"], "full_outer")  # one row a period
    return union_checks(
        run_checks(j, [
            Rule("eligible_plus_ineligible_equals_pairs",
                 count_if(F.col("eligible_count") + F.col("ineligible_count")
                          != F.col("positive_bill_count") + F.col("nonpositive_bill_count")) == 0, F.lit("")),
            Rule("eligible_equals_positive_bill", count_if(F.col("eligible_count") != F.col("positive_bill_count")) == 0, F.lit("")),
            Rule("ratio_finite", count_if(F.abs(F.col("ratio_max")) == F.lit(float("inf"))) == 0, F.lit("")),
            Rule("correlation_finite_or_null", count_if(F.isnan("pearson_correlation")) == 0, F.lit("")),
            Rule("period_count", F.count(F.lit(1)) == spec.n_periods, F.lit("")),
            Rule("period_totals_equal_population", F.min(F.col("total_count") == n), F.lit("")),
        ]),
        run_checks(classes, [Rule("class_counts_equal_population", F.min(F.col("c") == n), F.lit(""))]),
        run_checks(r4, [
            Rule("category_defaults_add_up", count_if(F.col("default_count") + F.col("non_default_count") != F.col("total_count")) == 0, F.lit("")),
            Rule("category_rates_in_unit_interval", count_if((F.col("default_rate") < 0) | (F.col("default_rate") > 1)) == 0, F.lit("")),
        ]),
        run_checks(cats, [Rule("category_percentages_match_counts", F.min(F.coalesce(F.abs(F.col("p") - F.try_divide(100.0 * F.col("s"), n)) <= 1e-4, F.lit(False))), F.lit("")),
                          Rule("categories_cover_complete_pairs", F.min(F.coalesce(F.col("s") == F.col("complete"), F.lit(False))), F.lit(""))]),
    )


def static_checks(df: DataFrame, cat_cols: list[str], target: str, codebook) -> DataFrame:
    """Target total, category totals per feature, defaults + non-defaults = total, rates in [0, 1]."""
    from panelkit.operators import profile as P
    n = df.select(F.count(F.lit(1))).scalar()
    ts = P.target_summary(df, target)
    rates = P.categorical_default_rates(df, cat_cols, target, codebook)
    per_feature = rates.groupBy("feature").agg(F.sum("total_count").alias("s"), F.sum("default_count").alias("d"))
    pos = df.select(count_if(F.col(target) == 1)).scalar()
    return union_checks(
        run_checks(ts, [Rule("target_total_equals_rows", F.sum("count") == n, _fmt("%d", F.sum("count"))),
                        Rule("percentages_sum_to_100", F.abs(F.sum("percentage") - 100.0) <= 1e-3, F.lit(""))]),
        run_checks(rates, [
            Rule("defaults_plus_non_defaults_equal_total",
                 count_if(F.col("default_count") + F.col("non_default_count") != F.col("total_count")) == 0, F.lit("")),
            Rule("default_rates_in_unit_interval",
                 count_if((F.col("default_rate") < 0) | (F.col("default_rate") > 1)) == 0, F.lit("")),
        ]),
        run_checks(per_feature, [
            Rule("category_totals_equal_rows", F.min(F.col("s") == n), _fmt("%d features", F.count(F.lit(1)))),
            Rule("grouped_defaults_equal_positives", F.min(F.col("d") == pos), F.lit("")),
        ]),
    )


def reconciliation_checks(preds: DataFrame) -> DataFrame:
    """Stored 0.5 predictions equal the recomputed ones and are binary."""
    recomputed = (F.col("probability_default") >= 0.5).cast("int")
    return run_checks(preds, [
        Rule("prediction_at_0_5_reconciles", count_if(F.col("prediction_at_0_5") != recomputed) == 0,
             _fmt("%d mismatches", count_if(F.col("prediction_at_0_5") != recomputed))),
        Rule("predictions_binary", count_if(~F.col("prediction_at_0_5").isin(0, 1)) == 0, F.lit("")),
    ])
