"""NaN and null are missing alike; the panel holds all rows of its tables; check rules that can fail."""

import pytest
from pyspark.sql import functions as F

from panelkit.functions.quantiles import value_counts
from panelkit.operators import amounts as M
from panelkit.operators import profile as P
from panelkit.operators import relationship as REL
from panelkit.operators import status as Q
from panelkit.operators import suites as C
from panelkit.sources.tables import read_table
from panelkit.sources.testdata import PANEL_SPEC, customer_panel
from panelkit.spec import BILL_POLICY, PAYMENT_POLICY, PanelSpec

NAN = float("nan")
SF = "/root/testdata/sf0.001"


def test_nan_is_missing_as_pandas_has_it(spark):
    df = spark.createDataFrame([(1.0, 0), (NAN, 1), (3.0, 1), (5.0, 0), (None, 0)], "x double, target int")
    r = P.describe_numeric(df, ["x"]).first()
    assert (r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (3, 3.0, 2.0, 1.0, 2.0, 3.0, 4.0, 5.0)
    s = P.numeric_summary(df, ["x"]).first()
    assert (s["count"], s["mean"], s["median"], s["max"]) == (3, 3.0, 3.0, 5.0)
    by = {t["target_value"]: t["count"] for t in P.numeric_by_target(df, ["x"], "target").collect()}
    assert by == {0: 2, 1: 1}
    a = {x["column"]: x for x in P.audit_columns(df).collect()}["x"]
    assert (a["missing_count"], a["unique_count"]) == (2, 3)
    assert sum(b["count"] for b in P.class_histogram(df, "x", "target", 4).collect()) == 3
    assert {b["target"]: b["count"] for b in P.box_stats(df, ["x"], "target").collect()} == {0: 2, 1: 1}
    assert sorted(v["_v"] for v in value_counts(df, [], "x").collect()) == [1.0, 3.0, 5.0]


SPEC = PanelSpec("ID", "target", ("p1", "p2"), {"pay": ("a", "b")})


@pytest.mark.parametrize("missing", [NAN, None])
def test_panel_operators_take_nan_for_null(spark, missing):
    df = spark.createDataFrame([(1, 0, 1.0, 2.0), (2, 1, missing, 4.0), (3, 0, -3.0, missing), (4, 1, 0.0, 8.0), (5, 0, 4.0, 1.0)], "ID int, target int, a double, b double")
    s = {r["period"]: r for r in M.panel_summary(df, SPEC, "pay", PAYMENT_POLICY).collect()}
    assert (s["p1"]["count"], s["p1"]["missing_count"], s["p1"]["mean"], s["p1"]["max"]) == (5, 1, 0.5, 4.0)
    c = M.adjacent_change(df, SPEC, "pay", PAYMENT_POLICY).first()
    assert (c["count"], c["positive_change_count"], c["negative_change_count"]) == (3, 2, 1)
    assert M.correlation_matrix(df, SPEC, "pay").where("row_index = 1 AND column_index = 1").first()["correlation"] == 1.0
    signs = {(r["period"], r["sign_category"]): r["total_count"] for r in M.sign_summary(df, SPEC, "pay", PAYMENT_POLICY).collect()}
    assert sum(n for (p, _), n in signs.items() if p == "p1") == 4
    assert {r["passed"] for r in C.amount_checks(df, SPEC, "pay", PAYMENT_POLICY).where("check_name LIKE 'change%' OR check_name LIKE 'rows%'").collect()} == {True}


def test_panel_totals_equal_the_tables(spark):
    p = customer_panel(spark, SF)
    total = lambda ch: sum(F.coalesce(F.sum(c), F.lit(0)) for c in PANEL_SPEC.columns(ch))
    got = p.agg(total("bill").alias("bill"), total("pay").alias("pay"), F.sum("n_orders_total").alias("orders")).first()
    orders, lines = read_table(spark, SF, "orders"), read_table(spark, SF, "lineitem")
    money = lambda df, c: df.agg(F.sum(F.col(c).cast("decimal(18,2)"))).first()[0]
    own = orders.join(customer_panel(spark, SF).select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    assert got["bill"] == money(own, "o_totalprice") and got["orders"] == own.count()
    assert got["pay"] == money(lines.join(own, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"), "l_extendedprice")
    assert {r["period"] for r in Q.status_by_period(p, PANEL_SPEC).collect()} == {str(y) for y in range(1995, 2002)}
    assert any(r["missing_count"] > 0 for r in M.panel_summary(p, PANEL_SPEC, "paid", PAYMENT_POLICY).collect())


def failed(checks):
    return {r["check_name"] for r in checks.collect() if not r["passed"]}


def edited(table, **columns):
    """The operator with some columns replaced by SQL expressions."""
    return lambda *args, **kw: table(*args, **kw).withColumns({c: F.expr(e) for c, e in columns.items()})


AMOUNT_BREAKS = {
    "change_counts_equal_population": ("adjacent_change", {"count": "count - 1"}), "change_signs_sum_to_observed": ("adjacent_change", {"zero_change_count": "zero_change_count + 1"}),
    "sign_counts_sum_to_observed": ("panel_summary", {"zero_count": "zero_count + 1"}), "iqr_non_negative": ("panel_summary", {"iqr": "-1.0D"}),
    "fence_formula": ("panel_summary", {"lower_fence": "lower_fence + 1"}), "upper_fence_formula": ("panel_summary", {"upper_fence": "upper_fence + 1"}),
    "percentiles_ordered": ("panel_summary", {"median": "max + 1"}), "iqr_is_quartile_distance": ("panel_summary", {"iqr": "iqr + 1"}),
    "extremes_are_both_tails": ("panel_summary", {"total_potential_extreme_count": "-1L"}), "rows_equal_population": ("panel_summary", {"count": "count - 1"}),
    "sign_percentages_sum_to_100": ("panel_summary", {"zero_percentage": "zero_percentage + 1"}), "correlation_unit_diagonal": ("correlation_matrix", {"correlation": "CAST(NULL AS DOUBLE)"}),
    "correlations_within_unit": ("correlation_matrix", {"correlation": "1.5D"}), "low_percentile_below_high": ("display_range", {"global_low_percentile": "global_high_percentile"}),
    "global_equals_sum_of_periods": ("display_range", {"total_count": "IF(chronological_index = 0, 7L, total_count)"})}


@pytest.mark.parametrize("rule", [None, *AMOUNT_BREAKS])
def test_amount_rules_can_fail(spark, monkeypatch, rule):
    random = __import__("random").Random(1)
    df = spark.createDataFrame([(i, i % 2, random.gauss(0, 9), random.gauss(1, 9)) for i in range(60)], "ID int, target int, a double, b double")
    if rule:
        name, columns = AMOUNT_BREAKS[rule]
        monkeypatch.setattr(M, name, edited(getattr(M, name), **columns))
    found = failed(C.amount_checks(df, SPEC, "pay", BILL_POLICY))
    assert found == set() if rule is None else rule in found


STATUS_BREAKS = {
    "population_percentages_sum_to_100": ("status_by_period", {"population_percentage": "population_percentage + 1"}),
    "observed_means_counted": ("status_by_period", {"observed_combination": "true"}), "default_rates_match_counts": ("status_by_period", {"default_rate": "default_rate / 2 + 0.1D"}),
    "class_counts_equal_totals": ("status_by_period_target", {"status_count": "status_count + 1"}), "transitions_dense": None,
    "transition_defaults_add_up": ("status_transitions", {"default_count": "default_count + 1"}),
    "source_percentages_match_counts": ("status_transitions", {"percentage_within_source_status": "percentage_within_source_status / 2"}),
    "pattern_defaults_equal_positives": ("sequence_patterns", {"default_count": "default_count + 1"}),
    "pair_totals_within_known_codes": ("status_transitions", {"transition_count": "transition_count * 2"})}
RELATIONSHIP_BREAKS = {
    "period_totals_equal_population": ("relationship_summary", {"total_count": "total_count - 1"}), "period_count": ("ratio_summary", {"period": "'p1'"}),
    "class_counts_equal_population": ("relationship_by_target", {"count": "count + 1"}), "category_defaults_add_up": ("relationship_categories", {"default_count": "default_count + 1"}),
    "category_rates_in_unit_interval": ("relationship_categories", {"default_rate": "2.0D"}),
    "category_percentages_match_counts": ("relationship_categories", {"population_percentage": "population_percentage / 2"}),
    "categories_cover_complete_pairs": ("relationship_categories", {"total_count": "0L"})}


def status_panel(spark):
    spec = PanelSpec("ID", "target", ("p1", "p2"), {"status": ("s1", "s2"), "bill": ("b1", "b2"), "pay": ("c1", "c2")})
    return spec, spark.createDataFrame([(i, i % 2, (0, -2, 1)[i % 3], (0, 2, -1)[i % 3], float(i), float(i % 4), 1.0 + i, float(i % 5)) for i in range(30)],
                                       "ID int, target int, s1 int, s2 int, b1 double, c1 double, b2 double, c2 double")


@pytest.mark.parametrize("rule", [None, *STATUS_BREAKS])
def test_status_rules_can_fail(spark, monkeypatch, rule):
    spec, df = status_panel(spark)
    if rule == "transitions_dense":
        whole = Q.status_transitions
        monkeypatch.setattr(Q, "status_transitions", lambda *a: whole(*a).where("transition_count > 0"))
    elif rule:
        name, columns = STATUS_BREAKS[rule]
        monkeypatch.setattr(Q, name, edited(getattr(Q, name), **columns))
    found = failed(C.status_checks(df, spec))
    assert found == set() if rule is None else rule in found


@pytest.mark.parametrize("rule", [None, *RELATIONSHIP_BREAKS])
def test_relationship_rules_can_fail(spark, monkeypatch, rule):
    spec, df = status_panel(spark)
    if rule:
        name, columns = RELATIONSHIP_BREAKS[rule]
        monkeypatch.setattr(REL, name, edited(getattr(REL, name), **columns))
    found = failed(C.relationship_checks(df, spec))
    assert found == set() if rule is None else rule in found
