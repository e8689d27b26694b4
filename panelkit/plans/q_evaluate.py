"""Evaluation queries (E*) on the lineitem-derived prediction table.

Three fixed score columns play three models; ``validation`` and ``test`` come
from the hash group split on ``l_orderkey``.  Selection only reads validation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import evaluate as E
from panelkit.plans.catalog import register
from panelkit.plans.sql import predictions_cte, s_cnt, sql_rnd
from panelkit.session import track
from panelkit.sources.testdata import prediction_table

# Fixed model metadata of the test mapping (family, parameter count / complexity).
MODEL_FAMILY = {"model_a": "baseline", "model_b": "baseline", "model_c": "recurrent"}
MODEL_PARAMS = {"model_a": 2, "model_b": 3, "model_c": 5}
MODELS = ["model_a", "model_b", "model_c"]


def _val(spark, sf_dir):
    return prediction_table(spark, sf_dir, ("validation",))


def _test(spark, sf_dir):
    return prediction_table(spark, sf_dir, ("test",))


def sql_metrics(digits: int | None = 6) -> str:
    """SQL of ``evaluate.metric_columns`` over columns tn, fp, fn, tp (same operation order)."""
    tn, fp, fn, tp = ("CAST(tn AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)", "CAST(tp AS DOUBLE)")
    z = lambda a, b: f"COALESCE(({a}) / NULLIF({b}, 0), 0.0)"
    n = f"({tn} + {fp} + {fn} + {tp})"
    f1 = z(f"2.0 * {tp}", f"2.0 * {tp} + {fp} + {fn}")
    f0 = z(f"2.0 * {tn}", f"2.0 * {tn} + {fp} + {fn}")
    cols = {"accuracy": z(f"{tp} + {tn}", n), "default_precision": z(tp, f"{tp} + {fp}"),
            "default_recall": z(tp, f"{tp} + {fn}"), "default_f1": f1, "macro_f1": f"(({f0}) + ({f1})) / 2.0",
            "weighted_f1": z(f"({f0}) * ({tn} + {fp}) + ({f1}) * ({tp} + {fn})", n)}
    r = (lambda e: sql_rnd(e, digits)) if digits is not None else (lambda e: f"({e})")
    out = [f"{r(v)} AS {k}" for k, v in cols.items()]
    out.append(f"CAST({tp} + {fp} AS BIGINT) AS predicted_default_count")
    out.append(f"{r(z(f'{tp} + {fp}', n))} AS predicted_default_percentage")
    return ", ".join(out)


CONF = (f"{s_cnt('y_true = 0 AND probability_default < {t}')} AS tn, {s_cnt('y_true = 0 AND probability_default >= {t}')} AS fp, "
        f"{s_cnt('y_true = 1 AND probability_default < {t}')} AS fn, {s_cnt('y_true = 1 AND probability_default >= {t}')} AS tp")


def _conf(t: str) -> str:
    return CONF.replace("{t}", t)


VAL = f"WITH {predictions_cte()}, v AS (SELECT * FROM preds WHERE split = 'validation')"


@register("confusion", f"{VAL} SELECT model_name, {_conf('0.5')} FROM v GROUP BY model_name")
def q_confusion(spark, sf_dir):
    return E.confusion(_val(spark, sf_dir), 0.5)


@register("threshold_metrics", f"""{VAL}, c AS (SELECT model_name, {_conf('0.5')} FROM v GROUP BY model_name)
SELECT model_name, 0.5::DOUBLE AS threshold, tn, fp, fn, tp, {sql_metrics()} FROM c""")
def q_threshold_metrics(spark, sf_dir):
    return E.threshold_metrics(_val(spark, sf_dir), 0.5)


def ranking_cte(src: str, digits: int | None = 6) -> str:
    r = (lambda e: sql_rnd(e, digits)) if digits is not None else (lambda e: f"({e})")
    return f"""sc AS (SELECT model_name, probability_default AS s, {s_cnt('y_true = 1')} AS pos, {s_cnt('y_true = 0')} AS neg
        FROM {src} GROUP BY ALL),
run AS (SELECT *, COALESCE(SUM(pos) OVER w, 0) AS pos_before, COALESCE(SUM(neg) OVER w, 0) AS neg_before,
          SUM(pos) OVER (PARTITION BY model_name) AS P, SUM(neg) OVER (PARTITION BY model_name) AS N
        FROM sc WINDOW w AS (PARTITION BY model_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
agg AS (SELECT model_name,
          SUM(CAST(neg AS DECIMAL(38,0)) * CAST(2 * (P - pos_before - pos) + pos AS DECIMAL(38,0))) AS u2,
          SUM(CAST(pos AS DOUBLE) * CAST(P - pos_before AS DOUBLE)
              / (CAST(P - pos_before AS DOUBLE) + CAST(N - neg_before AS DOUBLE))) AS ap_sum,
          ANY_VALUE(P) AS P, ANY_VALUE(N) AS N FROM run GROUP BY model_name),
rank_m AS (SELECT model_name,
  {r("CASE WHEN P > 0 AND N > 0 THEN CAST(u2 AS DOUBLE) / (2.0 * (CAST(P AS DOUBLE) * CAST(N AS DOUBLE))) ELSE 0.5 END")} AS roc_auc,
  {r("CASE WHEN P > 0 THEN ap_sum / CAST(P AS DOUBLE) ELSE 0.0 END")} AS pr_auc FROM agg)"""


@register("ranking_metrics", f"{VAL}, {ranking_cte('v')} SELECT * FROM rank_m")
def q_ranking_metrics(spark, sf_dir):
    return E.ranking_metrics(_val(spark, sf_dir))


@register("roc_pr_curve", f"""{VAL}, {ranking_cte('v')}
SELECT model_name, {sql_rnd('s', 6)} AS threshold, CAST(P - pos_before AS BIGINT) AS tp, CAST(N - neg_before AS BIGINT) AS fp,
  {sql_rnd('CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P, 0) AS DOUBLE)', 6)} AS tpr,
  {sql_rnd('CAST(N - neg_before AS DOUBLE) / CAST(NULLIF(N, 0) AS DOUBLE)', 6)} AS fpr,
  {sql_rnd('CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P - pos_before + N - neg_before, 0) AS DOUBLE)', 6)} AS precision,
  {sql_rnd('CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P, 0) AS DOUBLE)', 6)} AS recall
FROM run""")
def q_roc_pr_curve(spark, sf_dir):
    return E.roc_pr_curve(_val(spark, sf_dir))


def search_cte(src: str) -> str:
    g = lambda k: f"({E.GRID_START!r} + CAST({k} AS DOUBLE) * {E.GRID_DELTA!r})"
    return f"""{ranking_cte(src)},
bk AS (SELECT model_name, {E.sql_grid_bucket('probability_default')} AS bucket, y_true FROM {src}),
bc AS (SELECT model_name, bucket, {s_cnt('y_true = 1')} AS pos, {s_cnt('y_true = 0')} AS neg FROM bk GROUP BY ALL),
dom AS (SELECT m.model_name, r.bucket FROM (SELECT DISTINCT model_name FROM bc) m, range(-1, {E.GRID_SIZE}) AS r(bucket)),
d AS (SELECT dom.model_name, dom.bucket, COALESCE(pos, 0) AS pos, COALESCE(neg, 0) AS neg
      FROM dom LEFT JOIN bc ON dom.model_name = bc.model_name AND dom.bucket = bc.bucket),
cum AS (SELECT model_name, bucket,
          SUM(pos) OVER (PARTITION BY model_name ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
          SUM(neg) OVER (PARTITION BY model_name ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cfp,
          SUM(pos) OVER (PARTITION BY model_name) AS P, SUM(neg) OVER (PARTITION BY model_name) AS N FROM d),
cf AS (SELECT model_name, bucket AS grid_index, {g('bucket')} AS threshold, CAST(N - cfp AS BIGINT) AS tn,
         CAST(cfp AS BIGINT) AS fp, CAST(P - ctp AS BIGINT) AS fn, CAST(ctp AS BIGINT) AS tp FROM cum WHERE bucket >= 0),
search AS (SELECT cf.model_name, grid_index, threshold, tn, fp, fn, tp, {sql_metrics(None)}, roc_auc, pr_auc
           FROM cf LEFT JOIN rank_m ON cf.model_name = rank_m.model_name),
best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY default_f1 DESC,
           default_recall DESC, default_precision DESC, abs(threshold - 0.5) ASC, threshold ASC) AS rn FROM search) WHERE rn = 1)"""


@register("threshold_search", f"{VAL}, {search_cte('v')} SELECT * FROM search")
def q_threshold_search(spark, sf_dir):
    return E.threshold_search(_val(spark, sf_dir))


@register("best_threshold", f"{VAL}, {search_cte('v')} SELECT * FROM best")
def q_best_threshold(spark, sf_dir):
    return E.best_threshold(E.threshold_search(_val(spark, sf_dir)))


def _map_sql(mapping: dict, default, col: str = "model_name") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" if not isinstance(v, str) else f"WHEN '{k}' THEN '{v}'"
                     for k, v in mapping.items())
    d = repr(default) if not isinstance(default, str) else f"'{default}'"
    return f"(CASE {col} {whens} ELSE {d} END)"


@register("primary_candidate", f"""{VAL}, {search_cte('v')}
SELECT *, CAST({_map_sql(MODEL_PARAMS, 99999)} AS BIGINT) AS complexity FROM best
ORDER BY default_f1 DESC, pr_auc DESC, default_recall DESC, complexity ASC, model_name ASC LIMIT 1""")
def q_primary_candidate(spark, sf_dir):
    return E.primary_candidate(E.best_threshold(E.threshold_search(_val(spark, sf_dir))), MODEL_PARAMS)


def _results(spark, sf_dir):
    v = _val(spark, sf_dir)
    m = E.threshold_metrics(v, 0.5).join(E.ranking_metrics(v), "model_name")
    fam = F.create_map(*[x for k, val in MODEL_FAMILY.items() for x in (F.lit(k), F.lit(val))])
    return m.withColumn("family", fam[F.col("model_name")]).withColumn("parameter_count", E.complexity_map(MODEL_PARAMS))


RESULTS = f"""{VAL}, {ranking_cte('v')},
c AS (SELECT model_name, {_conf('0.5')} FROM v GROUP BY model_name),
results AS (SELECT c.model_name, 0.5::DOUBLE AS threshold, tn, fp, fn, tp, {sql_metrics()}, roc_auc, pr_auc,
  {_map_sql(MODEL_FAMILY, None, "c.model_name").replace("ELSE None", "ELSE NULL")} AS family,
  CAST({_map_sql(MODEL_PARAMS, 99999, "c.model_name")} AS BIGINT) AS parameter_count
  FROM c JOIN rank_m ON c.model_name = rank_m.model_name)"""


@register("family_winners", f"""{RESULTS}
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY default_f1 DESC, pr_auc DESC,
  default_recall DESC, parameter_count ASC, model_name ASC) AS rn FROM results) WHERE rn = 1""")
def q_family_winners(spark, sf_dir):
    return E.family_winners(_results(spark, sf_dir))


@register("leaderboard", f"""{RESULTS}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY default_f1 DESC, pr_auc DESC, default_recall DESC, model_name ASC) AS BIGINT) AS rank, *
FROM results""")
def q_leaderboard(spark, sf_dir):
    return E.leaderboard(_results(spark, sf_dir))


def _final_sql() -> str:
    # the test-side ranking CTEs need their own names inside the subquery
    te_rank = ranking_cte("te").replace("sc AS", "tsc AS").replace("FROM sc", "FROM tsc") \
        .replace("run AS", "trun AS").replace("FROM run", "FROM trun") \
        .replace("agg AS", "tagg AS").replace("FROM agg", "FROM tagg").replace("rank_m AS", "trank AS")
    return f"""WITH {predictions_cte()}, v AS (SELECT * FROM preds WHERE split = 'validation'), {search_cte('v')},
te AS (SELECT * FROM preds WHERE split = 'test'), {te_rank},
modes AS (SELECT model_name, '0.5' AS threshold_mode, 0.5::DOUBLE AS threshold FROM best
          UNION ALL SELECT model_name, 'validation_selected', threshold FROM best),
fc AS (SELECT te.model_name, threshold_mode, modes.threshold,
         {s_cnt('y_true = 0 AND probability_default < modes.threshold')} AS tn,
         {s_cnt('y_true = 0 AND probability_default >= modes.threshold')} AS fp,
         {s_cnt('y_true = 1 AND probability_default < modes.threshold')} AS fn,
         {s_cnt('y_true = 1 AND probability_default >= modes.threshold')} AS tp
       FROM te JOIN modes ON te.model_name = modes.model_name GROUP BY ALL),
final AS (SELECT fc.model_name, threshold_mode, threshold, tn, fp, fn, tp, {sql_metrics()}, trank.roc_auc, trank.pr_auc
          FROM fc LEFT JOIN trank ON fc.model_name = trank.model_name)"""


@register("final_metrics", _final_sql() + " SELECT * FROM final")
def q_final_metrics(spark, sf_dir):
    # selection reads F1 / recall / precision / threshold only: no ranking metrics needed here
    sel = E.best_threshold(E.threshold_search(_val(spark, sf_dir), with_ranking=False))
    return E.final_metrics(_test(spark, sf_dir), sel)


@register("validation_vs_test", _final_sql() + f"""
SELECT model_name, 'validation' AS split, {sql_rnd('default_f1', 6)} AS default_f1 FROM best
UNION ALL SELECT model_name, 'test', default_f1 FROM final WHERE threshold_mode = 'validation_selected'""")
def q_validation_vs_test(spark, sf_dir):
    sel = E.best_threshold(E.threshold_search(_val(spark, sf_dir), with_ranking=False))
    return E.validation_vs_test(sel, E.final_metrics(_test(spark, sf_dir), sel))


PRED_CHECKS_SQL = f"""{VAL},
per_id AS (SELECT ID, COUNT(DISTINCT model_name) AS nm, COUNT(DISTINCT y_true) AS ny, COUNT(*) AS nr FROM v GROUP BY ID),
counts AS (SELECT model_name, COUNT(*) AS n FROM v GROUP BY model_name),
ex AS (SELECT * FROM (VALUES {', '.join(f"('{m}')" for m in MODELS)}) AS e(model_name)),
cand AS (SELECT COALESCE(ex.model_name, counts.model_name) AS model_name, n
         FROM ex FULL OUTER JOIN counts ON ex.model_name = counts.model_name),
bad AS (SELECT {s_cnt('probability_default IS NULL OR isnan(probability_default) OR probability_default < 0 OR probability_default > 1')} AS bp,
          {s_cnt('y_true NOT IN (0, 1)')} AS bl FROM v)
SELECT 'ids_identical_across_models' AS check_name, COALESCE(MIN(nm) = {len(MODELS)}, FALSE) AS passed,
  printf('min models per id %d', MIN(nm)) AS detail FROM per_id
UNION ALL SELECT 'labels_identical_across_models', COALESCE(MAX(ny) <= 1, FALSE), printf('max labels per id %d', MAX(ny)) FROM per_id
UNION ALL SELECT 'one_row_per_model_and_id', COALESCE(MAX(nr) = MAX(nm), FALSE), printf('max rows per id %d', MAX(nr)) FROM per_id
UNION ALL SELECT 'probabilities_finite_in_unit_interval', bp = 0, printf('%d bad probabilities', bp) FROM bad
UNION ALL SELECT 'labels_binary', bl = 0, printf('%d non-binary labels', bl) FROM bad
UNION ALL SELECT 'candidate_set_matches', {s_cnt('n IS NULL')} = 0, printf('%d expected models missing', {s_cnt('n IS NULL')}) FROM cand
UNION ALL SELECT 'rows_per_model', COALESCE(MIN(n) = MAX(n), FALSE), printf('rows per model %d..%d', MIN(n), MAX(n)) FROM cand
UNION ALL SELECT 'no_unexpected_models', COALESCE(SUM(CASE WHEN model_name NOT IN ({', '.join(f"'{m}'" for m in MODELS)}) THEN 1 ELSE 0 END) = 0, FALSE),
  'model names outside the expected set' FROM cand"""


@register("prediction_checks", PRED_CHECKS_SQL)
def q_prediction_checks(spark, sf_dir):
    return E.prediction_checks(_val(spark, sf_dir), MODELS)



def _selected(spark, sf_dir):
    """The selected threshold of every model: one row a model, read by several parts of a report."""
    return track(E.best_threshold(E.threshold_search(_val(spark, sf_dir))))


def _final_report(spark, sf_dir, sel=None):
    sel = _selected(spark, sf_dir) if sel is None else sel
    primary = E.primary_candidate(sel, MODEL_PARAMS).select(F.col("model_name").alias("_primary"))
    final = E.final_metrics(_test(spark, sf_dir), sel)
    return E.final_report(final, MODEL_FAMILY, MODEL_PARAMS, primary)


REPORT_SQL = _final_sql() + f""",
prim AS (SELECT model_name AS primary_model FROM best
         ORDER BY default_f1 DESC, pr_auc DESC, default_recall DESC,
           CAST({_map_sql(MODEL_PARAMS, 99999)} AS BIGINT) ASC, model_name ASC LIMIT 1),
report AS (SELECT final.*, {_map_sql(MODEL_FAMILY, None).replace("ELSE None", "ELSE NULL")} AS family,
  CAST({_map_sql(MODEL_PARAMS, 99999)} AS BIGINT) AS parameter_count,
  model_name = (SELECT primary_model FROM prim) AS is_primary,
  CASE WHEN threshold_mode = 'validation_selected' THEN CAST(ROW_NUMBER() OVER (PARTITION BY threshold_mode
    ORDER BY default_f1 DESC, model_name ASC) AS BIGINT) END AS test_rank FROM final)"""


@register("final_report", REPORT_SQL + " SELECT * FROM report")
def q_final_report(spark, sf_dir):
    """Final metrics with family, parameter count, primary flag and the test ranking."""
    return _final_report(spark, sf_dir)


@register("decision_record", REPORT_SQL + f"""
SELECT (SELECT primary_model FROM prim) AS primary_model,
  (SELECT threshold FROM report WHERE is_primary AND threshold_mode = 'validation_selected') AS selected_threshold,
  (SELECT {sql_rnd('default_f1', 6)} FROM best WHERE model_name = (SELECT primary_model FROM prim)) AS validation_f1,
  (SELECT pr_auc FROM best WHERE model_name = (SELECT primary_model FROM prim)) AS validation_pr_auc,
  (SELECT default_f1 FROM report WHERE is_primary AND threshold_mode = 'validation_selected') AS test_f1,
  (SELECT default_recall FROM report WHERE is_primary AND threshold_mode = 'validation_selected') AS test_recall,
  (SELECT pr_auc FROM report WHERE is_primary AND threshold_mode = 'validation_selected') AS test_pr_auc,
  (SELECT string_agg(model_name, ' > ' ORDER BY test_rank) FROM report WHERE threshold_mode = 'validation_selected')
    AS test_ranking""")
def q_decision_record(spark, sf_dir):
    """One-row decision record (primary model, threshold, validation evidence, test metrics, ranking)."""
    sel = _selected(spark, sf_dir)
    return E.decision_record(_final_report(spark, sf_dir, sel), sel)
