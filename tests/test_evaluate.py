"""Evaluation operators on the prediction vectors and selection frames (FIXTURES §6, §7, §10)."""

import random

from pyspark.sql import functions as F

import pytest

from panelkit.operators import evaluate as E


def _preds(spark, y, p, model="m"):
    return spark.createDataFrame([(model, str(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "model_name string, ID string, y_true long, probability_default double")


def test_threshold_metrics_vector(spark):
    r = E.threshold_metrics(_preds(spark, [0, 1, 0, 1, 1], [.1, .9, .4, .8, .4]), 0.5).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (2, 0, 1, 2)
    assert r["default_precision"] == 1.0 and r["default_recall"] == pytest.approx(0.666667)
    assert r["accuracy"] == 0.8


def test_threshold_inclusive(spark):
    df = _preds(spark, [0, 1, 0, 1], [.1, .9, .4, .4])
    a = E.threshold_metrics(df, 0.5).first()
    b = E.threshold_metrics(df, 0.3).first()
    assert (a["tp"], a["fn"], a["default_recall"]) == (1, 1, 0.5)
    assert (b["tp"], b["tn"], b["fp"], b["fn"], b["default_recall"]) == (2, 1, 1, 0, 1.0)


def test_ranking_metrics_with_ties(spark):
    r = E.ranking_metrics(_preds(spark, [0, 1, 0, 1, 1], [.1, .9, .4, .8, .4])).first()
    assert r["roc_auc"] == pytest.approx(5.5 / 6, abs=1e-6)
    assert r["pr_auc"] == pytest.approx(11 / 12, abs=1e-6)


def _brute_auc(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    s = sum(1.0 if x > z else 0.5 if x == z else 0.0 for x in pos for z in neg)
    return s / (len(pos) * len(neg))


def _brute_ap(y, p):
    order = sorted(set(p), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for a, b in zip(y, p) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, p) if b >= t and a == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_ranking_matches_brute_force_small_and_distributed(spark):
    rnd = random.Random(7)
    y = [rnd.randint(0, 1) for _ in range(400)]
    p = [round(rnd.random(), 2) for _ in range(400)]  # many ties
    df = _preds(spark, y, p)
    small = E.ranking_metrics(df).first()
    spark.conf.set("panelkit.prefix.inMemoryLimit", "0")  # force the range-partitioned path
    try:
        big = E.ranking_metrics(df).first()
    finally:
        spark.conf.unset("panelkit.prefix.inMemoryLimit")
    for r in (small, big):
        assert r["roc_auc"] == pytest.approx(_brute_auc(y, p), abs=1e-6)
        assert r["pr_auc"] == pytest.approx(_brute_ap(y, p), abs=1e-6)


def test_single_class_fallbacks(spark):
    r = E.ranking_metrics(_preds(spark, [0, 0, 0], [.1, .2, .3])).first()
    assert r["roc_auc"] == 0.5 and r["pr_auc"] == 0.0


def test_grid_matches_numpy_and_bucketing(spark):
    import numpy as np
    grid = np.arange(0.050, 0.955, 0.005)
    got = [r[0] for r in spark.range(181).select(E.grid_value("id")).collect()]
    assert got == list(grid)
    ps = [0.0, 0.05, 0.0499999, 0.5, float(grid[90]), 0.95, 1.0, 0.5449999999999998]
    df = spark.createDataFrame([(x,) for x in ps], "p double")
    buckets = [r[0] for r in df.select(E.grid_bucket("p")).collect()]
    expect = [int(np.searchsorted(grid, x, side="right")) - 1 for x in ps]
    assert buckets == expect


def test_threshold_search_equals_direct(spark):
    rnd = random.Random(3)
    y = [rnd.randint(0, 1) for _ in range(300)]
    p = [rnd.random() for _ in range(300)]
    df = _preds(spark, y, p)
    s = {r["grid_index"]: r for r in E.threshold_search(df).collect()}
    for i in (0, 37, 90, 180):
        d = E.threshold_metrics(df, float(s[i]["threshold"])).first()
        assert (s[i]["tp"], s[i]["fp"], s[i]["fn"], s[i]["tn"]) == (d["tp"], d["fp"], d["fn"], d["tn"])


def test_family_winners_and_primary(spark):
    rows = [("mod1", "baseline", .5, .6, .5, 100), ("mod2", "baseline", .6, .6, .5, 100),
            ("mod3", "recurrent", .8, .8, .8, 100), ("mod4", "cnn", .9, .9, .9, 100)]
    df = spark.createDataFrame(rows, "model_name string, family string, default_f1 double, pr_auc double, "
                                     "default_recall double, parameter_count long")
    assert sorted(r["model_name"] for r in E.family_winners(df).collect()) == ["mod2", "mod3", "mod4"]
    sel = spark.createDataFrame([("logistic_regression", .60, .6, .6), ("gru_deep", .60, .7, .6),
                                 ("conv1d_multiscale", .55, .5, .5)],
                                "model_name string, default_f1 double, pr_auc double, default_recall double")
    best = E.primary_candidate(sel, {"logistic_regression": 92, "conv1d_multiscale": 6049, "gru_deep": 43713}).first()
    assert best["model_name"] == "gru_deep"


def test_golden_degenerate_confusion(spark):
    df = spark.createDataFrame([(76, 0, 24, 0)], "tn long, fp long, fn long, tp long")
    r = df.select(*E.metric_columns()).first()
    assert (r["accuracy"], r["default_precision"], r["default_recall"], r["default_f1"]) == (0.76, 0.0, 0.0, 0.0)
    assert r["macro_f1"] == pytest.approx(0.431818, abs=1e-6)
    assert r["weighted_f1"] == pytest.approx(0.656364, abs=1e-6)


def test_golden_test_confusion_formulas(spark):
    # logistic_regression at the selected threshold on the published test table
    df = spark.createDataFrame([(4039, 634, 611, 716)], "tn long, fp long, fn long, tp long")
    r = df.select(*E.metric_columns()).first()
    assert r["default_f1"] == pytest.approx(0.5349, abs=1e-4)
    assert r["default_precision"] == pytest.approx(0.5304, abs=1e-4)
    assert r["accuracy"] == pytest.approx(0.7925, abs=1e-4)


def test_metrics_invariant_under_repartition(spark):
    """Metamorphic: shuffling rows / changing partitioning never changes a metric."""
    rnd = random.Random(9)
    rows = [(m, str(i), rnd.randint(0, 1), round(rnd.random(), 3)) for m in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "model_name string, ID string, y_true long, probability_default double")
    other = df.orderBy(F.rand(5)).repartition(11)
    for fn in (E.ranking_metrics, E.threshold_search, lambda d: E.threshold_metrics(d, 0.37)):
        a, b = fn(df), fn(other)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
