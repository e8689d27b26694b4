"""Static-profile operators on the 6-row static frame and the histogram vector (FIXTURES §2, §4)."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import profile as P
from panelkit.spec import CodeBook

ROWS = [(1, 0, 10000, 25, 1, 1, 1), (2, 0, 50000, 30, 2, 2, 2), (3, 0, 100000, 40, 1, 3, 3),
        (4, 1, 20000, 22, 2, 1, 1), (5, 1, 60000, 35, 1, 2, 2), (6, 1, 200000, 50, 2, 4, 3)]
SCHEMA = "ID long, target long, LIMIT_BAL long, AGE long, SEX long, EDUCATION long, MARRIAGE long"
BOOK = CodeBook({"SEX": (1, 2), "EDUCATION": (1, 2, 3, 4), "MARRIAGE": (1, 2, 3)})


@pytest.fixture(scope="module")
def static(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_target_summary_counts(static):
    rows = {r["class_value"]: r for r in P.target_summary(static, "target").collect()}
    assert rows[0]["count"] == 3 and rows[1]["count"] == 3
    assert rows[1]["class_label"] == "default" and rows[0]["percentage"] == 50.0
    assert rows[0]["imbalance_ratio_majority_to_minority"] == 1.0


def test_categorical_default_rates_sex(static):
    out = {r["raw_value"]: r for r in P.categorical_default_rates(static, ["SEX"], "target", BOOK).collect()}
    assert out["1"]["total_count"] == 3 and out["1"]["default_count"] == 1
    assert out["2"]["default_count"] == 2 and out["2"]["default_rate"] == pytest.approx(0.666667)
    assert out["1"]["documentation_status"] == "documented" and out["1"]["small_sample_warning"]


def test_missing_column_raises(static):
    with pytest.raises(ValueError, match="Required column"):
        P.categorical_default_rates(static, ["NOPE"], "target", BOOK)


def test_numeric_summary_quantiles_and_note(static):
    r = P.numeric_summary(static, ["LIMIT_BAL"]).first()
    # pandas linear quantiles of [10k, 20k, 50k, 60k, 100k, 200k]
    assert (r["q25"], r["median"], r["q75"]) == (27500.0, 55000.0, 90000.0)
    assert r["std"] == pytest.approx(69761.4985, abs=1e-3)  # sample std (ddof 1)
    assert r["potential_extreme_note"].startswith("0 values outside 3×IQR fences [")


def test_numeric_by_target_per_class_fences(static):
    rows = {r["target_value"]: r for r in P.numeric_by_target(static, ["AGE"], "target").collect()}
    assert rows[0]["median"] == 30.0 and rows[1]["median"] == 35.0
    assert rows[1]["target_label"] == "default"


def test_class_histogram_edges_and_closed_last_bin(spark):
    df = spark.createDataFrame([(0.0, 0), (50.0, 0), (100.0, 1), (100.0, 1)], "v double, target long")
    h = P.class_histogram(df, "v", "target", n_bins=10).collect()
    last = [r for r in h if r["target"] == 1 and r["bin_index"] == 9][0]
    assert last["count"] == 2 and last["percentage"] == 100.0
    assert min(r["bin_left"] for r in h) == 0.0 and max(r["bin_right"] for r in h) == 100.0


def test_flat_histogram_widens(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 1)], "v double, target long")
    h = P.class_histogram(df, "v", "target", n_bins=4).collect()
    assert min(r["bin_left"] for r in h) == 4.5 and max(r["bin_right"] for r in h) == 5.5
    assert sum(r["count"] for r in h) == 2


def test_box_stats_whiskers(spark):
    vals = [10, 20, 30, 40, 50, 60, 70, 80, 90, 1000]
    df = spark.createDataFrame([(float(v), 0) for v in vals], "v double, target long")
    r = P.box_stats(df, ["v"], "target").first()
    assert r["q1"] == 32.5 and r["q3"] == 77.5
    assert r["whisker_high"] == 90.0 and r["flier_count"] == 1


def test_audit_duplicates_scopes(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 6, "b")], "ID long, x long, y string")
    out = {r["scope"]: r for r in P.audit_duplicates(df, "ID").collect()}
    assert out["all_columns_including_ID"]["rows_involved"] == 0
    assert out["all_columns_excluding_ID"]["rows_involved"] == 2
    assert out["all_columns_excluding_ID"]["duplicate_rows_excl_first"] == 1


def test_audit_columns_missing_and_distinct(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "a long, b double")
    out = {r["column"]: r for r in P.audit_columns(df).collect()}
    assert out["a"]["unique_count"] == 3 and out["a"]["all_unique"]
    assert out["b"]["missing_count"] == 2


def test_undocumented_values(static):
    df = static.withColumn("EDUCATION", F.when(F.col("ID") == 1, F.lit(5)).otherwise(F.col("EDUCATION")))
    out = P.undocumented_values(df, ["EDUCATION"], BOOK).collect()
    assert [(r["value"], r["count"]) for r in out] == [("5", 1)]
