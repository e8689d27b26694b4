"""Check suites over experiments, final evaluation and stored predictions.

Rules that compare all rows are aggregations; nothing of the size of the predictions is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if
from panelkit.operators import evaluate as E
from panelkit.operators import hashtree as H
from panelkit.operators import reconcile as R
from panelkit.operators.checks import Rule, run_checks, union_checks
from panelkit.session import track


def _bad_probability() -> F.Column:
    p = F.col("probability_default")
    return p.isNull() | F.isnan(p) | (p < 0) | (p > 1)


def _zero(name: str, condition: F.Column, what: str) -> Rule:
    n = F.coalesce(count_if(F.coalesce(condition, F.lit(True))), F.lit(0))
    return Rule(name, (F.count(F.lit(1)) > 0) & (n == 0), F.format_string(f"%d {what}", n))


def _per_model(preds: DataFrame, models: int, rows: int) -> DataFrame:
    counts = preds.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    return run_checks(counts, [
        Rule("model_count", F.count(F.lit(1)) == models, F.format_string("%d models", F.count(F.lit(1)))),
        Rule("predictions_per_model", (F.min("n") == rows) & (F.max("n") == rows), F.format_string("%d..%d rows a model", F.min("n"), F.max("n")))])


def experiment_checks(results: DataFrame, preds: DataFrame, families: dict[str, str], candidates: DataFrame, rows: int) -> DataFrame:
    """Expected models, predictions per model, valid probabilities, binary predictions, one candidate a family, and the
    default F1 of every model recomputed from its predictions.

    ``results`` (model_name, default_f1), ``preds`` with ``prediction_at_0_5``, ``candidates`` (model_name, family).
    """
    wanted = sorted(set(families.values()))
    again = E.threshold_metrics(preds).select("model_name", F.col("default_f1").alias("f1_again"))
    both = results.select("model_name", "default_f1").join(again, "model_name", "full_outer")  # one row a model
    off = F.coalesce(F.abs(F.col("default_f1") - F.col("f1_again")) > 1e-8 + 1e-5 * F.abs("f1_again"), F.lit(True))
    per_family = candidates.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    return union_checks(
        _per_model(preds, len(families), rows),
        run_checks(preds, [_zero("probabilities_valid", _bad_probability(), "bad probabilities"),
                           _zero("predictions_binary", ~F.col("prediction_at_0_5").isin(0, 1), "predictions that are not 0 or 1")]),
        run_checks(per_family, [Rule("one_candidate_per_family", (F.count(F.lit(1)) == len(wanted)) & (F.max("n") == 1) & (count_if(~F.col("family").isin(*wanted)) == 0),
                                     F.format_string("%d families", F.count(F.lit(1))))]),
        run_checks(both, [_zero("metrics_recomputed", off, "models whose F1 differs")]))


def evaluation_checks(preds: DataFrame, results: DataFrame, models: int, rows: int, locked: F.Column | None = None) -> DataFrame:
    """Test isolation flag, total and per-model rows, valid probabilities, two result rows a model, confusion counts that add up."""
    total = F.count(F.lit(1))
    cells = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return union_checks(
        run_checks(preds, [Rule("test_isolated", F.max(locked) if locked is not None else F.lit(True), F.lit("")),
                           Rule("total_rows", total == models * rows, F.format_string("%d rows", total)),
                           _zero("probabilities_valid", _bad_probability(), "bad probabilities")]),
        _per_model(preds, models, rows),
        run_checks(results, [Rule("two_results_per_model", total == 2 * models, F.format_string("%d result rows", total)),
                             _zero("confusion_counts_add_up", cells != rows, "result rows that don't add up")]))


def final_checks(preds: DataFrame, recomputed: DataFrame, models: int, rows: int, id_root: str, target_root: str) -> DataFrame:
    """The data side of the final verification of stored predictions.

    Besides the rules of C9 on rows and probabilities: the same ids and the same labels under every model (one aggregation a key, no
    distinct counts), binary predictions at both thresholds, both predictions equal to ``recomputed`` ones by a keyed difference
    of the two tables, and the hash-tree roots of ids and of labels equal to the recorded ones.
    """
    total = F.count(F.lit(1))
    per_id = track(preds.groupBy("ID").agg(F.count(F.lit(1)).alias("n"), F.min("y_true").alias("low"), F.max("y_true").alias("high")))  # read by the rules and both trees
    keys, cols = ["model_name", "ID"], ["prediction_at_0_5", "prediction_at_selected_threshold"]
    s = R.summary(preds.select(*keys, *cols), recomputed.select(*keys, *cols), keys, cols)
    bad = F.col("left_only") + F.col("right_only") + F.col("duplicate_key") + F.col("value")
    one = per_id.select("ID", F.col("low").alias("y_true"))
    spark = preds.sparkSession
    roots = [H.root(H.hash_tree(one, ["ID"])), H.root(H.hash_tree(one, ["ID"], ["y_true"]))]
    known = spark.createDataFrame([(roots[0], id_root, roots[1], target_root)], "a string, b string, c string, d string")
    return union_checks(
        run_checks(preds, [Rule("total_rows", total == models * rows, F.format_string("%d rows", total)),
                           _zero("probabilities_valid", _bad_probability(), "bad probabilities"),
                           _zero("predictions_binary", ~F.col("prediction_at_0_5").isin(0, 1) | ~F.col("prediction_at_selected_threshold").isin(0, 1), "predictions that are not 0 or 1")]),
        _per_model(preds, models, rows),
        run_checks(per_id, [_zero("ids_identical", F.col("n") != models, "ids that some model lacks or repeats"),
                            _zero("targets_identical", F.col("low") != F.col("high"), "ids with several labels")]),
        run_checks(s, [Rule("predictions_reconcile", F.max(bad) == 0, F.format_string("%d differences", F.max(bad)))]),
        run_checks(known, [Rule("id_population_known", F.max(F.col("a").eqNullSafe(F.col("b"))), F.lit("")),
                           Rule("target_population_known", F.max(F.col("c").eqNullSafe(F.col("d"))), F.lit(""))]))
