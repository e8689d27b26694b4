"""Amount / relationship / status operators on the small panel frames (FIXTURES §3, §5) and NULL traps."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import amounts as M
from panelkit.operators import relationship as REL
from panelkit.operators import status as Q
from panelkit.spec import BILL_POLICY, PAYMENT_POLICY, PanelSpec

PERIODS = ("April", "May", "June", "July", "August", "September")
SPEC = PanelSpec("ID", "target", PERIODS, {
    "bill": tuple(f"BILL_AMT{i}" for i in range(6, 0, -1)),
    "pay": tuple(f"PAY_AMT{i}" for i in range(6, 0, -1)),
    "status": ("PAY_6", "PAY_5", "PAY_4", "PAY_3", "PAY_2", "PAY_0"),
})
COLS = ["ID", "target"] + list(SPEC.columns("bill")) + list(SPEC.columns("pay")) + list(SPEC.columns("status"))


def _frame(spark, rows):
    schema = ", ".join(f"{c} double" if "AMT" in c else f"{c} long" for c in COLS)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def outlier(spark):
    t0 = [10, 20, 30, 40, 50, 60, 70, 80, 90, 1000]
    rows = []
    for i in range(10):
        amt = [float(t0[i]), float(i + 1), 1.0, 1.0, 1.0, 1.0]
        rows.append(tuple([i + 1, 0] + amt + amt + [0] * 6))
    return _frame(spark, rows)


def test_monthly_fences_and_extremes(outlier):
    r = {x["chronological_index"]: x for x in M.panel_summary(outlier, SPEC, "bill").collect()}[1]
    assert (r["p25"], r["p75"], r["iqr"]) == (32.5, 77.5, 45.0)
    assert (r["lower_fence"], r["upper_fence"]) == (-35.0, 145.0)
    assert r["above_upper_fence_count"] == 1 and r["below_lower_fence_count"] == 0


def test_constant_column_correlation_is_null(outlier):
    c = M.correlation_matrix(outlier, SPEC, "bill").collect()
    cell = [x for x in c if x["row_index"] == 3 and x["column_index"] == 4][0]
    assert cell["correlation"] is None  # constant columns: NULL, not an ANSI error
    diag = [x for x in c if x["row_index"] == 1 and x["column_index"] == 1][0]
    assert diag["correlation"] == 1.0


def test_by_target_policies_on_single_class(outlier):
    bill = M.panel_summary_by_target(outlier, SPEC, "bill", BILL_POLICY).collect()
    pay = M.panel_summary_by_target(outlier, SPEC, "pay", PAYMENT_POLICY).collect()
    assert {r["target"] for r in bill} == {0}            # bill skips the empty class
    assert {r["target"] for r in pay} == {0, 1}          # payment reports it with count 0
    assert [r["count"] for r in pay if r["target"] == 1] == [0] * 6


def test_null_sign_policies(spark):
    rows = [tuple([1, 0] + [None] + [1.0] * 5 + [None] + [1.0] * 5 + [0] * 6),
            tuple([2, 1] + [-5.0] + [1.0] * 5 + [0.0] + [1.0] * 5 + [0] * 6)]
    df = _frame(spark, rows)
    b = {(r["chronological_index"], r["sign_category"]): r for r in M.sign_summary(df, SPEC, "bill", BILL_POLICY).collect()}
    p = {(r["chronological_index"], r["sign_category"]): r for r in M.sign_summary(df, SPEC, "pay", PAYMENT_POLICY).collect()}
    assert b[(1, "zero")]["total_count"] == 1          # NULL bill falls through to zero
    assert p[(1, "zero")]["total_count"] == 1          # the 0.0 payment only; NULL excluded
    assert p[(1, "zero")]["population_percentage"] == 100.0  # over non-null rows
    assert b[(1, "negative")]["population_percentage"] == 50.0  # over all rows
    s = {r["chronological_index"]: r for r in M.panel_summary(df, SPEC, "bill", BILL_POLICY).collect()}
    sp = {r["chronological_index"]: r for r in M.panel_summary(df, SPEC, "pay", PAYMENT_POLICY).collect()}
    assert s[1]["count"] == 1 and s[1]["missing_count"] == 1
    assert sp[1]["count"] == 2 and sp[1]["missing_count"] == 1


def test_change_denominators(spark):
    rows = [tuple([1, 0] + [1.0, None, 1.0, 1.0, 1.0, 1.0] * 2 + [0] * 6),
            tuple([2, 0] + [1.0, 3.0, 1.0, 1.0, 1.0, 1.0] * 2 + [0] * 6)]
    df = _frame(spark, rows)
    b = {r["pair_index"]: r for r in M.adjacent_change(df, SPEC, "bill", BILL_POLICY).collect()}
    p = {r["pair_index"]: r for r in M.adjacent_change(df, SPEC, "pay", PAYMENT_POLICY).collect()}
    assert b[1]["count"] == 2 and b[1]["positive_change_percentage"] == 50.0   # bill: all rows
    assert p[1]["count"] == 1 and p[1]["positive_change_percentage"] == 100.0  # payment: non-null diffs
    assert "q1" in b[1].asDict() and "q1_change" in p[1].asDict()


def test_range_histogram_no_clipping(spark):
    vals = [-10.0, 5.0, 50.0, 120.0, 100.0]
    from panelkit.functions.exprs import hist_bin
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    bins = [r["b"] for r in df.select(hist_bin("v", F.lit(0.0), F.lit(100.0), 10).alias("b")).collect()]
    assert bins == [None, 0, 5, None, 9]


@pytest.fixture(scope="module")
def ratio_frame(spark):
    base = [(100.0, 50.0, 0), (0.0, 50.0, 0), (-100.0, 50.0, 1), (200.0, 0.0, 1)]
    rows = []
    for i, (b, p, t) in enumerate(base):
        rows.append(tuple([i + 1, t] + [b] + [1.0] * 5 + [p] + [1.0] * 5 + [0] * 6))
    return _frame(spark, rows)


def test_ratio_eligibility(ratio_frame):
    r = {x["chronological_index"]: x for x in REL.ratio_summary(ratio_frame, SPEC, "bill", "pay").collect()}[1]
    assert (r["eligible_count"], r["ineligible_count"], r["ratio_max"], r["ratio_zero_count"]) == (2, 2, 0.5, 1)
    t = {(x["chronological_index"], x["target"]): x for x in REL.ratio_by_target(ratio_frame, SPEC, "bill", "pay").collect()}
    assert t[(1, 0)]["eligible_count"] == 1 and t[(1, 0)]["ratio_std"] is None


def test_relationship_categories(ratio_frame):
    c = {x["category"]: x["total_count"] for x in REL.relationship_categories(ratio_frame, SPEC, "bill", "pay").collect()
         if x["chronological_index"] == 1}
    assert c == {"bill_nonpositive_payment_zero": 0, "bill_nonpositive_payment_positive": 2,
                 "bill_positive_payment_zero": 1, "bill_positive_payment_positive": 1}


def test_negative_payment_fails(spark, ratio_frame):
    bad = ratio_frame.withColumn("PAY_AMT6", F.lit(-1.0))
    with pytest.raises(Exception, match="Negative payment"):
        REL.relationship_categories(bad, SPEC, "bill", "pay").collect()


def test_status_dense_and_unobserved(spark):
    rows = [tuple([1, 0] + [1.0] * 12 + [0, 0, 0, 0, 0, 0]), tuple([2, 1] + [1.0] * 12 + [-2, -1, 0, 1, 2, 11])]
    df = _frame(spark, rows)
    q2 = Q.status_by_period(df, SPEC)
    sep = {r["raw_status_value"]: r for r in q2.collect() if r["chronological_month_index"] == 5}
    assert 11 in sep and sep[11]["total_count"] == 1           # outside the known set: kept (T7)
    assert sep[5]["population_percentage"] is None and not sep[5]["observed_combination"]
    q4 = Q.status_by_period_target(df, SPEC).collect()
    assert all(r["raw_status_value"] != 11 for r in q4)          # dropped when conditioned on target
    q5 = {(r["chronological_pair_index"], r["source_raw_status"], r["destination_raw_status"]): r
          for r in Q.status_transitions(df, SPEC).collect()}
    assert q5[(0, 0, 0)]["transition_count"] == 1
    assert q5[(0, 0, 5)]["percentage_within_source_status"] == 0.0    # observed source -> 0.0
    assert q5[(0, 5, 5)]["percentage_within_source_status"] is None   # unseen source -> NULL
    pats = {r["sequence_pattern"]: r["total_count"] for r in Q.sequence_patterns(df, SPEC).collect()}
    assert pats == {"0|0|0|0|0|0": 1, "-2|-1|0|1|2|11": 1}


@pytest.mark.parametrize("limit", ["0", "2000000"])
def test_fences_follow_one_interpolation(spark, limit):
    """Fence counts of values at which formulas that differ in the last bits disagree (pandas: 2 below)."""
    from panelkit.functions.quantiles import group_quantiles
    values = [-29.9, -25.1, 13.0, 13.8, 15.2, 20.8, 27.7, 41.9]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    spark.conf.set("panelkit.prefix.inMemoryLimit", limit)
    try:
        q = group_quantiles(frame, [], "v", {"q1": 0.25, "q3": 0.75}).first()
    finally:
        spark.conf.unset("panelkit.prefix.inMemoryLimit")
    assert sum(v < q["q1"] - 1.5 * (q["q3"] - q["q1"]) for v in values) == 2


def test_one_hot_has_no_width_limit(spark):
    from panelkit.operators.features import fit_one_hot
    with pytest.warns(UserWarning, match="10001 categories"):
        assert len(fit_one_hot(spark.range(10_001).selectExpr("id as c"), ["c"])["c"]) == 10_001
