"""Binary-classifier evaluation on a long prediction table.

Input: ``(model_name, ID, y_true, probability_default[, split])``.

* Confusion counts at any threshold are one conditional-count aggregation.
* ROC-AUC (ties ½) and average precision are exact: rows collapse to distinct
  (model, score) with positive / negative counts, and the running totals come
  from ``ordered_prefix`` (range-partitioned when large, so one model's scores
  are never sorted in one task).
* The 181-point threshold search never joins rows with the grid: each score is
  bucketed to the largest grid point <= score, counts are taken per
  (model, bucket), and a reverse running sum over at most 182 buckets per model
  gives the confusion counts at every grid point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.exprs import broadcast_small, count_if, ratio, rnd
from panelkit.functions.ordered import ordered_prefix
from panelkit.session import track
from panelkit.spec import FIXED_THRESHOLD, GRID_SIZE, GRID_START, GRID_STEP

# numpy.arange(0.050, 0.955, 0.005) fills start + i * ((start + step) - start)
GRID_DELTA = (GRID_START + GRID_STEP) - GRID_START


def grid_value(i) -> Column:
    i = F.col(i) if isinstance(i, str) else i
    return F.lit(GRID_START) + i.cast("double") * F.lit(GRID_DELTA)


def grid_bucket(p) -> Column:
    """Largest grid index i with grid[i] <= p (-1 below the grid), exact against the grid doubles."""
    p = F.col(p) if isinstance(p, str) else p
    raw = F.floor((p - F.lit(GRID_START)) / F.lit(GRID_DELTA))
    cand = F.least(F.greatest(raw, F.lit(-1)), F.lit(GRID_SIZE - 1)).cast("int")
    down = (cand >= 0) & (p < grid_value(cand))
    up = (cand < GRID_SIZE - 1) & (p >= grid_value(cand + 1))
    return F.when(down, cand - 1).when(up, cand + 1).otherwise(cand)


def sql_grid_bucket(p: str) -> str:
    g = lambda k: f"({GRID_START!r} + CAST({k} AS DOUBLE) * {GRID_DELTA!r})"
    cand = f"CAST(least(greatest(floor(({p} - {GRID_START!r}) / {GRID_DELTA!r}), -1), {GRID_SIZE - 1}) AS INTEGER)"
    return (f"(CASE WHEN {cand} >= 0 AND {p} < {g(cand)} THEN {cand} - 1 "
            f"WHEN {cand} < {GRID_SIZE - 1} AND {p} >= {g(cand + ' + 1')} THEN {cand} + 1 ELSE {cand} END)")


def predict(p, threshold) -> Column:
    """prediction = probability >= threshold."""
    p = F.col(p) if isinstance(p, str) else p
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (p >= t).cast("int")


# ---------------------------------------------------------------------------
# E2 / E3
# ---------------------------------------------------------------------------

def metric_columns(tn="tn", fp="fp", fn="fn", tp="tp", digits: int | None = 6) -> list[Column]:
    """E3 algebra on confusion counts (zero_division -> 0), sklearn definitions."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in (tn, fp, fn, tp))
    n = tn + fp + fn + tp
    z = lambda num, den: F.coalesce(F.try_divide(num, den), F.lit(0.0))
    f1 = z(2.0 * tp, 2.0 * tp + fp + fn)
    f0 = z(2.0 * tn, 2.0 * tn + fp + fn)
    cols = {
        "accuracy": z(tp + tn, n), "default_precision": z(tp, tp + fp), "default_recall": z(tp, tp + fn),
        "default_f1": f1, "macro_f1": (f0 + f1) / 2.0, "weighted_f1": z(f0 * (tn + fp) + f1 * (tp + fn), n),
    }
    out = [(rnd(v, digits) if digits is not None else v).alias(k) for k, v in cols.items()]
    out.append((tp + fp).cast("long").alias("predicted_default_count"))
    pdp = z(tp + fp, n)
    out.append((rnd(pdp, digits) if digits is not None else pdp).alias("predicted_default_percentage"))
    return out


def confusion(preds: DataFrame, threshold=FIXED_THRESHOLD, keys=("model_name",)) -> DataFrame:
    """Tn / fp / fn / tp per key at a fixed threshold (labels ordered [0, 1])."""
    yhat = predict("probability_default", threshold)
    y = F.col("y_true")
    return preds.groupBy(*keys).agg(count_if((y == 0) & (yhat == 0)).alias("tn"), count_if((y == 0) & (yhat == 1)).alias("fp"),
                                    count_if((y == 1) & (yhat == 0)).alias("fn"), count_if((y == 1) & (yhat == 1)).alias("tp"))


def threshold_metrics(preds: DataFrame, threshold=FIXED_THRESHOLD, keys=("model_name",)) -> DataFrame:
    """Confusion counts plus accuracy / precision / recall / F1 / macro / weighted F1."""
    c = confusion(preds, threshold, keys)
    return c.select(*keys, F.lit(float(threshold)).alias("threshold"), "tn", "fp", "fn", "tp", *metric_columns())


# ---------------------------------------------------------------------------
# E4 / E5 / E6 ranking metrics
# ---------------------------------------------------------------------------

def score_counts(preds: DataFrame, keys=("model_name",)) -> DataFrame:
    """Distinct (keys, score) with positive / negative counts (map-side partial aggregation)."""
    y = F.col("y_true")
    return preds.groupBy(*keys, F.col("probability_default").alias("s")).agg(
        count_if(y == 1).alias("pos"), count_if(y == 0).alias("neg"))


def _with_running(preds: DataFrame, keys, sc: DataFrame | None = None) -> DataFrame:
    sc = sc if sc is not None else score_counts(preds, keys)
    return _with_totals(ordered_prefix(sc, list(keys), "s", ["pos", "neg"]), sc, keys)


def ranking_metrics(preds: DataFrame, keys=("model_name",), digits: int | None = 6,
                    sc: DataFrame | None = None) -> DataFrame:
    """ROC-AUC with ties counted ½ (0.5 if one class is absent) and step-wise average
    precision (0.0 without positives), exact, per key.

    AUC = Σ_s neg(s)·(2·pos_above(s) + pos(s)) / (2·P·N), summed as DECIMAL(38,0).
    AP  = Σ_s pos(s) · TP(s) / (TP(s) + FP(s)) / P with TP / FP counted at score >= s.
    """
    r = _with_running(preds, keys, sc)
    pos_above = F.col("P") - F.col("pos_before") - F.col("pos")
    term = (F.col("neg").cast("decimal(38,0)") * (2 * pos_above + F.col("pos")).cast("decimal(38,0)"))
    tp = (F.col("P") - F.col("pos_before")).cast("double")
    fp = (F.col("N") - F.col("neg_before")).cast("double")
    ap_term = F.col("pos").cast("double") * tp / (tp + fp)
    g = r.groupBy(*keys).agg(F.sum(term).alias("u2"), F.sum(ap_term).alias("ap_sum"),
                             F.first("P").alias("P"), F.first("N").alias("N"))
    pn = F.col("P").cast("double") * F.col("N").cast("double")
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u2").cast("double") / (2.0 * pn)).otherwise(F.lit(0.5))
    ap = F.when(F.col("P") > 0, F.col("ap_sum") / F.col("P").cast("double")).otherwise(F.lit(0.0))
    rd = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    return g.select(*keys, rd(auc).alias("roc_auc"), rd(ap).alias("pr_auc"))


def roc_pr_curve(preds: DataFrame, keys=("model_name",), digits: int = 6) -> DataFrame:
    """One curve point per distinct score (descending thresholds): tpr, fpr, precision, recall."""
    r = _with_running(preds, keys)
    tp = F.col("P") - F.col("pos_before")
    fp = F.col("N") - F.col("neg_before")
    z = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    return r.select(*keys, rnd("s", digits).alias("threshold"), tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
                    rnd(z(tp, F.col("P")), digits).alias("tpr"), rnd(z(fp, F.col("N")), digits).alias("fpr"),
                    rnd(z(tp, tp + fp), digits).alias("precision"), rnd(z(tp, F.col("P")), digits).alias("recall"))


def _with_totals(pref: DataFrame, sc: DataFrame, keys) -> DataFrame:
    tot = sc.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return pref.join(broadcast_small(tot), list(keys))  # one row per model


def _end_points(sc: DataFrame, keys, **values) -> DataFrame:
    """One more curve point for every key."""
    return sc.select(*keys).distinct().select(*keys, *[F.lit(v).cast(kind).alias(c) for c, (v, kind) in values.items()])


def roc_curve(preds: DataFrame, keys=("model_name",), drop_collinear: bool = True) -> DataFrame:
    """ROC curve points (threshold, fp, tp, fpr, tpr), one per distinct score, from the point (0, 0) at an infinite threshold on.

    A point on the straight line between its neighbours is dropped: the step to it and the step after it have the same counts.  The neighbour
    of a range partition's last score stands in another partition; ``ordered_prefix`` hands over one row a
    partition.  A rate without rows of its class is null.
    """
    sc = track(score_counts(preds, keys))
    r = _with_totals(ordered_prefix(sc, list(keys), "s", ["pos", "neg"], neighbours=["pos", "neg"]), sc, keys)
    if drop_collinear:  # falling thresholds: the step after a point is that of the next lower score
        ends = F.col("_prev").isNull() | F.col("_next").isNull()
        r = r.where(ends | (F.col("_prev.pos") != F.col("pos")) | (F.col("_prev.neg") != F.col("neg")))
    tp, fp = F.col("P") - F.col("pos_before"), F.col("N") - F.col("neg_before")
    points = r.select(*keys, F.col("s").alias("threshold"), fp.cast("long").alias("fp"), tp.cast("long").alias("tp"),
                      ratio(fp, F.col("N")).alias("fpr"), ratio(tp, F.col("P")).alias("tpr"))
    start = sc.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).select(
        *keys, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("tp"),
        ratio(F.lit(0), F.col("N")).alias("fpr"), ratio(F.lit(0), F.col("P")).alias("tpr"))
    return points.unionByName(start)


def pr_curve(preds: DataFrame, keys=("model_name",)) -> DataFrame:
    """Precision-recall points (threshold, precision, recall), one per distinct score, and the end point (1, 0), which has no
    threshold.  Without positives every recall is 1."""
    sc = track(score_counts(preds, keys))
    r = _with_totals(ordered_prefix(sc, list(keys), "s", ["pos", "neg"]), sc, keys)
    tp, fp = F.col("P") - F.col("pos_before"), F.col("N") - F.col("neg_before")
    points = r.select(*keys, F.col("s").alias("threshold"), F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
                      F.coalesce(ratio(tp, F.col("P")), F.lit(1.0)).alias("recall"))
    return points.unionByName(_end_points(sc, keys, threshold=(None, "double"), precision=(1.0, "double"), recall=(0.0, "double")))


# ---------------------------------------------------------------------------
# E7 / E8 threshold search and selection
# ---------------------------------------------------------------------------

def threshold_search(preds: DataFrame, keys=("model_name",), with_ranking: bool = True) -> DataFrame:
    """Metrics at each of the 181 grid thresholds per model, plus ranking metrics."""
    # one scan: distinct (model, score) counts feed both the grid buckets (a function of
    # the score) and the ranking metrics
    sc = track(score_counts(preds, keys))
    b = sc.groupBy(*keys, grid_bucket("s").alias("bucket")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    b = track(b)  # at most 182 rows per model: read by the domain and by the counts
    # dense (model, bucket) domain: 182 buckets generated per distinct model
    dense = b.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(-1), F.lit(GRID_SIZE - 1))).alias("bucket"))
    d = dense.join(b, [*keys, "bucket"], "left").fillna(0, ["pos", "neg"])
    w_rev = Window.partitionBy(*keys).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*keys)
    d = d.select(*keys, "bucket", F.sum("pos").over(w_rev).alias("tp"), F.sum("neg").over(w_rev).alias("fp"),
                 F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"))
    d = d.where(F.col("bucket") >= 0).select(
        *keys, F.col("bucket").cast("long").alias("grid_index"), grid_value("bucket").alias("threshold"),
        (F.col("N") - F.col("fp")).cast("long").alias("tn"), F.col("fp").cast("long").alias("fp"),
        (F.col("P") - F.col("tp")).cast("long").alias("fn"), F.col("tp").cast("long").alias("tp"))
    out = d.select(*keys, "grid_index", "threshold", "tn", "fp", "fn", "tp", *metric_columns(digits=None))
    if with_ranking:
        out = out.join(ranking_metrics(preds, keys, sc=sc), list(keys), "left")
    return out


def _rounded(df: DataFrame, cols, digits=6) -> DataFrame:
    return df.select(*[rnd(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


METRIC_COLS = ("accuracy", "default_precision", "default_recall", "default_f1", "macro_f1", "weighted_f1",
               "predicted_default_percentage", "roc_auc", "pr_auc")


def best_threshold(search: DataFrame, keys=("model_name",)) -> DataFrame:
    """Per model, F1 desc, recall desc, precision desc, |t - 0.5| asc, t asc."""
    w = Window.partitionBy(*keys).orderBy(F.col("default_f1").desc(), F.col("default_recall").desc(),
                                          F.col("default_precision").desc(),
                                          F.abs(F.col("threshold") - F.lit(FIXED_THRESHOLD)).asc(), F.col("threshold").asc())
    return search.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def complexity_map(mapping: dict[str, int], default: int = 99999) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(m[F.col("model_name")], F.lit(default)).cast("long")


def primary_candidate(selected: DataFrame, complexity: dict[str, int]) -> DataFrame:
    """Selected-threshold F1 desc, PR-AUC desc, recall desc, complexity asc, name asc (one row)."""
    s = selected.withColumn("complexity", complexity_map(complexity))
    order = [F.col("default_f1").desc(), F.col("pr_auc").desc(), F.col("default_recall").desc(),
             F.col("complexity").asc(), F.col("model_name").asc()]
    return s.orderBy(*order).limit(1)


def family_winners(results: DataFrame) -> DataFrame:
    """Best model per family: F1 desc, PR-AUC desc, recall desc, parameter count asc, name asc."""
    w = Window.partitionBy("family").orderBy(F.col("default_f1").desc(), F.col("pr_auc").desc(),
                                             F.col("default_recall").desc(), F.col("parameter_count").asc(),
                                             F.col("model_name").asc())
    return results.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def leaderboard(results: DataFrame) -> DataFrame:
    """All models by F1 desc (PR-AUC, recall, name as tie-breaks) with an explicit rank."""
    order = [F.col("default_f1").desc(), F.col("pr_auc").desc(), F.col("default_recall").desc(), F.col("model_name").asc()]
    # one row per model: the ranking window covers a tiny frame
    return results.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"), "*")


def final_metrics(test: DataFrame, selected: DataFrame) -> DataFrame:
    """Test metrics per model at 0.5 and at the validation-selected threshold (E16: test is
    only ever scored, never used for selection), ranking metrics repeated on both rows."""
    thr = selected.select("model_name", F.col("threshold").alias("selected_threshold"))
    modes = thr.select("model_name", F.inline(F.array(
        F.struct(F.lit("0.5").alias("threshold_mode"), F.lit(FIXED_THRESHOLD).alias("threshold")),
        F.struct(F.lit("validation_selected").alias("threshold_mode"), F.col("selected_threshold").alias("threshold")))))
    # one scan of the test predictions: distinct (model, score) counts give both the
    # confusion counts at each threshold and the ranking metrics.  ``modes`` has two
    # rows per model and is broadcast once that size is proven.
    sc = track(score_counts(test))
    j = sc.join(broadcast_small(modes), "model_name")
    above = F.col("s") >= F.col("threshold")
    c = j.groupBy("model_name", "threshold_mode", "threshold").agg(
        F.sum(F.when(~above, F.col("neg")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~above, F.col("pos")).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).cast("long").alias("tp"))
    m = c.select("model_name", "threshold_mode", "threshold", "tn", "fp", "fn", "tp", *metric_columns())
    return m.join(ranking_metrics(test, sc=sc), "model_name", "left")


def validation_vs_test(selected_validation: DataFrame, final: DataFrame) -> DataFrame:
    """Long (model, split, F1) at the selected threshold."""
    v = selected_validation.select("model_name", F.lit("validation").alias("split"), rnd("default_f1", 6).alias("default_f1"))
    t = final.where(F.col("threshold_mode") == "validation_selected").select(
        "model_name", F.lit("test").alias("split"), "default_f1")
    return v.unionByName(t)


def prediction_checks(preds: DataFrame, expected_models: list[str], expected_rows: int | None = None) -> DataFrame:
    """Per-model row counts, identical ID sets and labels across models,
    finite probabilities in [0, 1], binary labels, expected model set.  Returns the checks table."""
    from panelkit.operators.checks import Rule, run_checks
    spark = preds.sparkSession
    k = len(expected_models)
    # (id, model) first: plain partial aggregates instead of two distinct counts an id
    per_pair = preds.groupBy("ID", "model_name").agg(F.count(F.lit(1)).alias("n"), F.min("y_true").alias("low"), F.max("y_true").alias("high"))
    several = F.when(F.min("low").isNull(), 0).when(F.min("low") == F.max("high"), 1).otherwise(2)
    per_id = per_pair.groupBy("ID").agg(F.count("model_name").alias("nm"), several.alias("ny"), F.sum("n").alias("nr"))
    id_checks = run_checks(per_id, [
        Rule("ids_identical_across_models", F.min("nm") == k, F.format_string("min models per id %d", F.min("nm"))),
        Rule("labels_identical_across_models", F.max("ny") <= 1, F.format_string("max labels per id %d", F.max("ny"))),
        Rule("one_row_per_model_and_id", F.max("nr") == F.max("nm"), F.format_string("max rows per id %d", F.max("nr"))),
    ])
    p = F.col("probability_default")
    row_rules = [
        Rule("probabilities_finite_in_unit_interval",
             count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)) == 0,
             F.format_string("%d bad probabilities", count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)))),
        Rule("labels_binary", count_if(~F.col("y_true").isin(0, 1)) == 0,
             F.format_string("%d non-binary labels", count_if(~F.col("y_true").isin(0, 1)))),
    ]
    counts = preds.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    exp = spark.createDataFrame([(m,) for m in expected_models], "model_name string")
    cand = exp.join(counts, "model_name", "full_outer")
    cand_rules = [Rule("candidate_set_matches", count_if(F.col("n").isNull()) == 0,
                       F.format_string("%d expected models missing", count_if(F.col("n").isNull())))]
    same_n = F.min("n") == F.max("n")
    if expected_rows is not None:
        same_n = same_n & (F.min("n") == F.lit(int(expected_rows)))
    cand_rules.append(Rule("rows_per_model", same_n, F.format_string("rows per model %d..%d", F.min("n"), F.max("n"))))
    cand_rules.append(Rule("no_unexpected_models", F.sum(F.when(~F.col("model_name").isin(*expected_models), 1).otherwise(0)) == 0,
                           F.lit("model names outside the expected set")))
    return id_checks.unionByName(run_checks(preds, row_rules)).unionByName(run_checks(cand, cand_rules))


def final_report(final: DataFrame, family: dict[str, str], params: dict[str, int], primary: DataFrame) -> DataFrame:
    """Enrich final rows with family / parameter count / primary flag and rank the
    validation-selected rows by test F1 (name as tie-break)."""
    fam = F.create_map(*[x for k, v in family.items() for x in (F.lit(k), F.lit(v))])
    p = primary.select(F.col("_primary")).scalar()
    w = Window.partitionBy("threshold_mode").orderBy(F.col("default_f1").desc(), F.col("model_name").asc())
    return final.select("*", fam[F.col("model_name")].alias("family"), complexity_map(params).alias("parameter_count"),
                        (F.col("model_name") == p).alias("is_primary"),
                        F.when(F.col("threshold_mode") == "validation_selected",
                               F.row_number().over(w).cast("long")).alias("test_rank"))


def decision_record(report: DataFrame, selected_validation: DataFrame) -> DataFrame:
    """One row; the ranking string orders models by test rank (bounded by the model list)."""
    sel = report.where(F.col("threshold_mode") == "validation_selected")
    prim = sel.where(F.col("is_primary"))
    val = selected_validation.join(prim.select("model_name"), "model_name")
    ranking = sel.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("test_rank", "model_name"))),
                                               lambda x: x["model_name"]), " > ").alias("r")).select("r").scalar()
    return prim.select(
        F.col("model_name").alias("primary_model"), F.col("threshold").alias("selected_threshold"),
        val.select(rnd("default_f1", 6)).scalar().alias("validation_f1"), val.select("pr_auc").scalar().alias("validation_pr_auc"),
        F.col("default_f1").alias("test_f1"), F.col("default_recall").alias("test_recall"),
        F.col("pr_auc").alias("test_pr_auc"), ranking.alias("test_ranking"))
