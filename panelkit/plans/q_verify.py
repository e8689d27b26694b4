"""Queries of reconciliation, anchors, publication, prepared stages, model suites and sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.exprs import hex_bucket, rnd, sql_hex_bucket
from panelkit.operators import anchors as AN
from panelkit.operators import categories as CAT
from panelkit.operators import evaluate as E
from panelkit.operators import hashtree as H
from panelkit.operators import models as L
from panelkit.operators import prepare as PREP
from panelkit.operators import publish as PUB
from panelkit.operators import reconcile as R
from panelkit.operators import sketches as SK
from panelkit.operators import split as G
from panelkit.operators import suites_models as CM
from panelkit.plans.catalog import ORACLE, register
from panelkit.plans.q_evaluate import MODEL_FAMILY, MODEL_PARAMS, _results, _test, _val, search_cte
from panelkit.plans.q_features import PREDICTORS, SP, STATIC_CAT, STATIC_CONT, _cats_sql, _onehot, _robust_sql, _scaled, _temporal_sql, split_panel
from panelkit.plans.sql import PANEL_CTE, predictions_cte, sql_rnd
from panelkit.session import ensure_checkpoint_dir, stored, track
from panelkit.sources.tables import read_table
from panelkit.sources.testdata import PANEL_SPEC, customer_panel
from panelkit.spec import PAYMENT_POLICY

N_MODELS = len(MODEL_PARAMS)


# --- two stored tables -------------------------------------------------------

_COPY = f"""copy AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN {sql_hex_bucket("'p' || CAST(o_orderkey AS VARCHAR)", 50)} = 0 THEN o_totalprice + 0.004 WHEN {sql_hex_bucket("'p' || CAST(o_orderkey AS VARCHAR)", 50)} = 1 THEN o_totalprice + 1.0
       WHEN {sql_hex_bucket("'p' || CAST(o_orderkey AS VARCHAR)", 50)} = 2 THEN NULL ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE {sql_hex_bucket("'d' || CAST(o_orderkey AS VARCHAR)", 100)} <> 0)"""


def _edited_orders(spark, sf_dir):
    """A copy of ``orders`` with rows taken out and prices moved, stored and read back."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    p = hex_bucket(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")), 50)
    price = F.when(p == 0, F.col("o_totalprice") + 0.004).when(p == 1, F.col("o_totalprice") + 1.0).when(p == 2, F.lit(None)).otherwise(F.col("o_totalprice"))
    kept = o.where(hex_bucket(F.concat(F.lit("d"), F.col("o_orderkey").cast("string")), 100) != 0)
    return o, stored(kept.withColumn("o_totalprice", price), "edited-orders")


@register("table_difference", f"""WITH {_COPY}
SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN 'left_only' WHEN o.o_orderkey IS NULL THEN 'right_only' ELSE 'value' END AS kind,
  CASE WHEN c.o_orderkey IS NOT NULL AND o.o_orderkey IS NOT NULL THEN 'o_totalprice' END AS column
FROM orders o FULL JOIN copy c USING (o_orderkey)
WHERE c.o_orderkey IS NULL OR o.o_orderkey IS NULL OR (o.o_totalprice IS NULL) <> (c.o_totalprice IS NULL) OR abs(o.o_totalprice - c.o_totalprice) > 0.005""")
def q_table_difference(spark, sf_dir):
    """Rows taken out, moved within and beyond the tolerance, and nulls, found in a stored copy of all orders."""
    a, b = _edited_orders(spark, sf_dir)
    return R.difference(a, b, ["o_orderkey"], tolerance={"o_totalprice": 0.005}).select("o_orderkey", "kind", "column")


_STORED = f"""WITH {predictions_cte()}, v AS (SELECT * FROM preds WHERE split = 'validation'), {search_cte('v')}, te AS (SELECT * FROM preds WHERE split = 'test')"""


def _thresholds(spark, sf_dir):
    best = E.best_threshold(E.threshold_search(_val(spark, sf_dir), with_ranking=False))
    return {r["model_name"]: r["threshold"] for r in best.select("model_name", "threshold").collect()}  # one row a model


def stored_predictions(spark, sf_dir, thresholds):
    """Test predictions at both thresholds as the pipeline stores them."""
    t = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])[F.col("model_name")]
    p = _test(spark, sf_dir).withColumn("selected_threshold", t)
    p = p.select("model_name", "ID", "y_true", "probability_default", "selected_threshold", E.predict("probability_default", 0.5).alias("prediction_at_0_5"),
                 E.predict("probability_default", F.col("selected_threshold")).alias("prediction_at_selected_threshold"))
    return stored(p, "predictions")


def recomputed_predictions(spark, sf_dir, thresholds):
    """The same predictions by SQL text over ``lineitem`` alone: scores, split and labels of no operator."""
    li = read_table(spark, sf_dir, "lineitem")
    split = "pmod(CAST(conv(substring(md5(concat('42|', CAST(l_orderkey AS STRING))), 1, 8), 16, 10) AS BIGINT), 25)"
    scores = {"model_a": "l_quantity / 50D", "model_b": "l_extendedprice / 105000D", "model_c": "l_discount * 10D"}
    models = ", ".join(f"""struct('{m}' AS model_name, IF({x} < 0.5D, 0, 1) AS prediction_at_0_5,
                           IF({x} < {float(thresholds[m])!r}D, 0, 1) AS prediction_at_selected_threshold)""" for m, x in scores.items())
    return spark.sql(f"""SELECT model.model_name, ID, model.prediction_at_0_5, model.prediction_at_selected_threshold FROM (
                         SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ID, explode(array({models})) AS model FROM {{li}} WHERE {split} < 5)""", li=li)


@register("prediction_difference", f"""{_STORED}
SELECT (SELECT count(*) FROM te) AS left_rows, (SELECT count(*) FROM te) AS right_rows, CAST(0 AS BIGINT) AS left_only, CAST(0 AS BIGINT) AS right_only,
  CAST(0 AS BIGINT) AS duplicate_key, CAST(0 AS BIGINT) AS value""")
def q_prediction_difference(spark, sf_dir):
    """E15 at both thresholds: stored test predictions against recomputed ones."""
    t = _thresholds(spark, sf_dir)
    return R.summary(stored_predictions(spark, sf_dir, t), recomputed_predictions(spark, sf_dir, t), ["model_name", "ID"], ["prediction_at_0_5", "prediction_at_selected_threshold"])


# --- C8, C9, C10 -------------------------------------------------------------

def _rows_of(preds) -> int:
    return preds.where(F.col("model_name") == "model_a").count()


def _verdicts(checks):
    return checks.select("check_name", "passed")


def _passed(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, TRUE AS passed" for n in names)


@register("checks_experiments", _passed("model_count", "predictions_per_model", "probabilities_valid", "predictions_binary", "one_candidate_per_family", "metrics_recomputed"))
def q_checks_experiments(spark, sf_dir):
    """C8 over the validation predictions of the three models."""
    v = _val(spark, sf_dir).withColumn("prediction_at_0_5", E.predict("probability_default", 0.5))
    results = _results(spark, sf_dir)
    return _verdicts(CM.experiment_checks(results, v, MODEL_FAMILY, E.family_winners(results).select("model_name", "family"), _rows_of(v)))


@register("checks_evaluation", _passed("test_isolated", "total_rows", "probabilities_valid", "model_count", "predictions_per_model", "two_results_per_model", "confusion_counts_add_up"))
def q_checks_evaluation(spark, sf_dir):
    """C9 over the test predictions; isolation: no test id is a validation id."""
    test, sel = _test(spark, sf_dir), E.best_threshold(E.threshold_search(_val(spark, sf_dir), with_ranking=False))
    shared = test.join(_val(spark, sf_dir).select("ID").distinct(), "ID", "left_semi").select(F.count(F.lit(1))).scalar()
    return _verdicts(CM.evaluation_checks(test, E.final_metrics(test, sel), N_MODELS, _rows_of(test), shared == 0))


@register("checks_final", _passed("total_rows", "probabilities_valid", "predictions_binary", "model_count", "predictions_per_model", "ids_identical", "targets_identical",
                                  "predictions_reconcile", "id_population_known", "target_population_known"))
def q_checks_final(spark, sf_dir):
    """C10 over stored test predictions; the recorded roots are those of the rows of ``lineitem`` in the test split."""
    t = _thresholds(spark, sf_dir)
    known = track(_test(spark, sf_dir).where(F.col("model_name") == "model_a").select("ID", "y_true"))  # read by both trees
    roots = H.root(H.hash_tree(known.select("ID"), ["ID"])), H.root(H.hash_tree(known, ["ID"], ["y_true"]))
    preds = stored_predictions(spark, sf_dir, t)
    return _verdicts(CM.final_checks(preds, recomputed_predictions(spark, sf_dir, t), N_MODELS, _rows_of(preds), *roots))


# --- C6 ----------------------------------------------------------------------

def _anchor_sql(ch: str) -> str:
    cols, spec = PANEL_SPEC.columns(ch), PANEL_SPEC
    parts = []
    for name, c in ((spec.periods[0], cols[0]), (spec.periods[-1], cols[-1])):
        x = f"CAST({c} AS DOUBLE)"
        q = {k: f"min((SELECT quantile_cont({x}, {p}) FROM panel))" for k, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))}
        iqr, r = f"({q['p75']} - {q['p25']})", {k: v[4:-1] for k, v in q.items()}
        values = {"count": f"count({c})", "mean": f"avg({x})", **q, "iqr": iqr, "negative_count": f"count(*) FILTER ({c} < 0)", "zero_count": f"count(*) FILTER ({c} = 0)",
                  "positive_count": f"count(*) FILTER ({c} > 0)", "total_potential_extreme_count": f"count(*) FILTER ({x} < {r['p25']} - 1.5 * ({r['p75']} - {r['p25']}) OR {x} > {r['p75']} + 1.5 * ({r['p75']} - {r['p25']}))"}
        parts += [f"SELECT '{name}_{k}' AS anchor_name, CAST({v} AS DOUBLE) AS value FROM panel" for k, v in values.items()]
    d = f"CAST({cols[-1]} - {cols[-2]} AS DOUBLE)"
    values = {"mean_change": f"avg({d})", "median_change": f"quantile_cont({d}, 0.5)", "negative_change_count": f"count(*) FILTER ({d} < 0)",
              "zero_change_count": f"count(*) FILTER ({d} = 0)", "positive_change_count": f"count(*) FILTER ({d} > 0)"}
    parts += [f"SELECT 'last_{k}', CAST({v} AS DOUBLE) FROM panel" for k, v in values.items()]
    lo, hi = ("(SELECT quantile_cont(x, 0.01) FROM flat)", "(SELECT quantile_cont(x, 0.99) FROM flat)")
    values = {"total_count": "count(x)", "low_percentile": f"min({lo})", "high_percentile": f"min({hi})", "below_range_count": f"count(*) FILTER (x < {lo})",
              "above_range_count": f"count(*) FILTER (x > {hi})", "outside_range_count": f"count(*) FILTER (x < {lo} OR x > {hi})"}
    parts += [f"SELECT 'global_{k}', CAST({v} AS DOUBLE) FROM flat" for k, v in values.items()]
    flat = " UNION ALL ".join(f"SELECT CAST({c} AS DOUBLE) AS x FROM panel" for c in cols)
    return f"WITH {PANEL_CTE}, flat AS ({flat}), a AS ({' UNION ALL '.join(parts)}) SELECT anchor_name, {sql_rnd('value', 4)} AS expected_value, {sql_rnd('value', 4)} AS direct_value, {sql_rnd('value', 4)} AS pipeline_value, TRUE AS passed FROM a"


@register("anchors", _anchor_sql("pay"))
def q_anchors(spark, sf_dir):
    """C6 on the payment channel.  The expected values are the second algorithm's on a panel that is built anew from the raw tables by SQL text."""
    p = customer_panel(spark, sf_dir)
    raw = {t: read_table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")}
    sums = ", ".join(f"CAST(coalesce(sum(CASE WHEN year(l_shipdate) = {y} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DECIMAL(18,2)) AS {c}"
                     for y, c in zip(PANEL_SPEC.periods, PANEL_SPEC.columns("pay")))
    again = spark.sql(f"SELECT c_custkey, {sums} FROM {{customer}} LEFT JOIN {{orders}} ON c_custkey = o_custkey LEFT JOIN {{lineitem}} ON o_orderkey = l_orderkey GROUP BY c_custkey", **raw)
    expected = AN.direct_amounts(stored(again, "raw-panel"), PANEL_SPEC, "pay")
    out = AN.compare(expected, AN.direct_amounts(p, PANEL_SPEC, "pay"), AN.pipeline_amounts(p, PANEL_SPEC, "pay", PAYMENT_POLICY))
    return out.select("anchor_name", *[rnd(c, 4).alias(c) for c in ("expected_value", "direct_value", "pipeline_value")], "passed")


# --- G5 / G9 -----------------------------------------------------------------

def _manifest_sql() -> str:
    return f"""WITH {SP} SELECT split, count(*) AS total_count, CAST(sum(target) AS BIGINT) AS default_count, TRUE AS reused FROM sp GROUP BY split"""


@register("manifest_reuse", _manifest_sql())
def q_manifest_reuse(spark, sf_dir):
    """The split manifest is published once, verified by its checks, and reused by the second call."""
    p = customer_panel(spark, sf_dir)
    fingerprint = H.root(H.hash_tree(p, ["c_custkey"], ["target"]))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/manifest-{spark.sparkContext.applicationId}-{fingerprint[:16]}"

    def build():
        return G.stratified_group_split(G.with_group_id(p, PREDICTORS), id_col="c_custkey", target="target", mode="hash")

    def checks(manifest):
        return G.verify_manifest(manifest, p.withColumnRenamed("c_custkey", "ID"), "ID", "target", PREDICTORS)

    PUB.reuse_or_create(spark, path, fingerprint, build, checks)
    df, reused = PUB.reuse_or_create(spark, path, fingerprint, build, checks)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("total_count"), F.sum(F.col("target").cast("long")).alias("default_count")).withColumn("reused", F.lit(reused))


# --- A7 ----------------------------------------------------------------------

@register("prepared_panel", f"""WITH tem AS ({_temporal_sql()}),
sta AS (WITH {SP}, stp AS MATERIALIZED ({_robust_sql({c: [c] for c in STATIC_CONT})}), {_cats_sql(STATIC_CAT)}
  SELECT c_custkey, [{', '.join(_scaled(c, 'stp', c) for c in STATIC_CONT)}] || {_onehot(STATIC_CAT)} AS static FROM sp)
SELECT c_custkey, temporal, static FROM tem JOIN sta USING (c_custkey)""")
def q_prepared_panel(spark, sf_dir):
    """A7 with F3-F5: fitted on train rows, saved, loaded and applied to the whole panel."""
    sp = split_panel(spark, sf_dir)
    fitted = PREP.PanelPreparer.of(PANEL_SPEC, STATIC_CONT, STATIC_CAT).fit(sp.where("split = 'train'"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepared-{fitted.uid}"
    fitted.write().overwrite().save(path)
    out = PREP.PreparedPanel.load(path).transform(sp)
    size = len(STATIC_CONT) + fitted.dictionary.width
    return out.select("c_custkey", "temporal", CAT.dense(size, F.col("static_indices"), F.col("static_values")).alias("static"))


# --- P5 ----------------------------------------------------------------------

_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag"]


@register("distinct_estimates", " UNION ALL ".join(f"SELECT '{c}' AS column, count({c}) AS n, count(DISTINCT {c}) AS distinct_count, TRUE AS within_three_errors FROM lineitem" for c in _SKETCHED))
def q_distinct_estimates(spark, sf_dir):
    """P5: sketches of every year of ``lineitem``, stored, united and estimated, beside the exact counts."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    by_year = stored(SK.distinct_sketches(li, _SKETCHED, ["year"]), "sketches")
    exact = li.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in _SKETCHED]))).groupBy("column", "value").count()
    exact = exact.where("value IS NOT NULL").groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) / F.col("distinct_count")
    return SK.estimates(SK.united(by_year)).join(exact, "column").select("column", "n", "distinct_count", (off <= 3 * SK.standard_error()).alias("within_three_errors"))


# --- L7 ----------------------------------------------------------------------

def _early_sql() -> str:
    delta, patience = repr(L.EARLY_STOP_MIN_DELTA), L.EARLY_STOP_PATIENCE
    return f"""WITH RECURSIVE h AS (SELECT CAST(o_custkey % 40 AS VARCHAR) AS model_name, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS epoch,
    {sql_rnd('CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 100000.0', 3)} AS loss FROM orders GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY epoch) AS k, count(*) OVER (PARTITION BY model_name) AS n FROM h),
r AS (SELECT model_name, CAST(0 AS BIGINT) AS k, CAST('inf' AS DOUBLE) AS best, CAST(-1 AS BIGINT) AS best_epoch, 0 AS wait, CAST(NULL AS BIGINT) AS stop_epoch FROM o WHERE k = 1
  UNION ALL SELECT o.model_name, o.k, CASE WHEN o.loss < r.best - {delta} THEN o.loss ELSE r.best END, CASE WHEN o.loss < r.best - {delta} THEN o.epoch ELSE r.best_epoch END,
    CASE WHEN o.loss < r.best - {delta} THEN 0 ELSE r.wait + 1 END,
    CASE WHEN NOT o.loss < r.best - {delta} AND r.wait + 1 >= {patience} THEN o.epoch END
  FROM r JOIN o ON o.model_name = r.model_name AND o.k = r.k + 1 WHERE r.stop_epoch IS NULL)
SELECT r.model_name, best_epoch, best AS best_validation_loss, stop_epoch, n AS epochs_available FROM r JOIN o USING (model_name, k)
QUALIFY row_number() OVER (PARTITION BY r.model_name ORDER BY r.k DESC) = 1"""


@register("early_stop_histories", _early_sql())
def q_early_stop_histories(spark, sf_dir):
    """The stopping rule over forty loss histories that come from all orders, one epoch a month."""
    o = read_table(spark, sf_dir, "orders")
    loss = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 100000.0
    h = o.groupBy((F.col("o_custkey") % 40).cast("string").alias("model_name"), ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("long").alias("epoch")).agg(
        rnd(loss, 3).alias("validation_loss"))
    return L.early_stop(h)


def _lineage_sql() -> str:
    from panelkit.plans.q_features import TAB_CAT, TAB_CONT
    n = len(TAB_CONT)
    parts = [f"SELECT 'tabular' AS representation, {i} AS output_index, '{c}' AS source_column, '' AS source_period, 'continuous' AS source_type, 'robust_scaler' AS transformation, 'train' AS fitted_on, '{c}' AS output_feature_name" for i, c in enumerate(TAB_CONT)]
    for k, c in enumerate(TAB_CAT):
        before = " + ".join([str(n), *(f"(SELECT count(DISTINCT {d}) FROM train)" for d in TAB_CAT[:k])])
        parts.append(f"SELECT 'tabular', CAST({before} + row_number() OVER (ORDER BY v) - 1 AS INTEGER), '{c}', '', 'categorical', 'one_hot', 'train', '{c}_' || CAST(v AS VARCHAR) FROM (SELECT DISTINCT {c} AS v FROM train WHERE {c} IS NOT NULL)")
    k = 0
    for i in range(PANEL_SPEC.n_periods):
        for ch in ("status", "bill", "pay"):
            kind, how = ("status", "standard_scaler") if ch == "status" else ("continuous", "robust_scaler")
            parts.append(f"SELECT 'temporal', {k}, '{PANEL_SPEC.columns(ch)[i]}', '{PANEL_SPEC.periods[i]}', '{kind}', '{how}', 'train', '{ch}_t{i}'")
            k += 1
    return f"WITH {SP} {' UNION ALL '.join(parts)}"


ORACLE["feature_lineage"] = _lineage_sql()
