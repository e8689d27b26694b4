"""Feature-preparation queries (F*) on the customer panel with a hash group split.

Fits read ``split = 'train'`` only; transforms are applied to every split.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import features as FT
from panelkit.operators import split as G
from panelkit.plans.catalog import register
from panelkit.plans.sql import PANEL_CTE, sql_hex_bucket, sql_rnd
from panelkit.sources.testdata import PANEL_SPEC, customer_panel

STATIC_CONT = ["n_orders_total", "n_lines_total"]
STATIC_CAT = ["c_nationkey", "c_mktsegment"]
TAB_CONT = STATIC_CONT + list(PANEL_SPEC.columns("bill")) + list(PANEL_SPEC.columns("pay"))
TAB_CAT = STATIC_CAT + list(PANEL_SPEC.columns("status"))
PANEL_COLS = (["c_nationkey", "c_mktsegment", "n_orders_total", "n_lines_total"]
              + [f"{ch}_{i}" for ch in ("status", "bill", "pay", "net") for i in range(1, PANEL_SPEC.n_periods + 1)])
PREDICTORS = sorted(PANEL_COLS)


def split_panel(spark, sf_dir):
    """Panel rows with ``split`` from the hash group split on their predictor group."""
    p = G.with_group_id(customer_panel(spark, sf_dir), PREDICTORS)
    return G.with_hash_split(p)


GID = "md5(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'nan')" for c in PREDICTORS) + "))"
SPLIT_CASE = (f"CASE WHEN {sql_hex_bucket(chr(39) + '42|' + chr(39) + ' || gid', 25)} < 5 THEN 'test' "
              f"WHEN {sql_hex_bucket(chr(39) + '42|' + chr(39) + ' || gid', 25)} < 9 THEN 'validation' ELSE 'train' END")
SP = f"""{PANEL_CTE}, pg AS MATERIALIZED (SELECT *, {GID} AS gid FROM panel), sp AS MATERIALIZED (SELECT *, {SPLIT_CASE} AS split FROM pg),
train AS (SELECT * FROM sp WHERE split = 'train')"""


@register("class_weights", f"""WITH {SP},
g AS (SELECT CAST(target AS BIGINT) AS class_value, CAST(COUNT(*) AS BIGINT) AS count FROM train GROUP BY 1)
SELECT class_value, count,
  {sql_rnd('CAST(SUM(count) OVER () AS DOUBLE) / CAST(NULLIF(count * 2, 0) AS DOUBLE)', 6)} AS class_weight,
  {sql_rnd('COALESCE(CAST(SUM(CASE WHEN class_value = 0 THEN count ELSE 0 END) OVER () AS DOUBLE) / '
           'CAST(NULLIF(SUM(CASE WHEN class_value = 1 THEN count ELSE 0 END) OVER (), 0) AS DOUBLE), 1.0)', 6)} AS pos_weight
FROM g""")
def q_class_weights(spark, sf_dir):
    return FT.class_weights(split_panel(spark, sf_dir).where(F.col("split") == "train"))


def _stack_sql(named: dict[str, list[str]], src: str = "train") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS c, CAST({col} AS DOUBLE) AS x FROM {src}"
                              for n, cols in named.items() for col in cols)


def _robust_sql(named: dict[str, list[str]]) -> str:
    return (f"SELECT c AS name, quantile_cont(x, 0.5) AS center, CASE WHEN quantile_cont(x, 0.75) - quantile_cont(x, 0.25) = 0 "
            f"THEN 1.0 ELSE quantile_cont(x, 0.75) - quantile_cont(x, 0.25) END AS scale FROM ({_stack_sql(named)}) GROUP BY c")


CHANNEL_PARAMS = f"""chp AS MATERIALIZED (
  SELECT c AS name, 'standard' AS method, AVG(x) AS center,
    CASE WHEN STDDEV_POP(x) = 0 THEN 1.0 ELSE STDDEV_POP(x) END AS scale
  FROM ({_stack_sql({'status': list(PANEL_SPEC.columns('status'))})}) GROUP BY c
  UNION ALL
  SELECT name, 'robust', center, scale FROM ({_robust_sql({ch: list(PANEL_SPEC.columns(ch)) for ch in ('bill', 'pay')})}))"""


@register("fit_channel_scalers", f"""WITH {SP}, {CHANNEL_PARAMS}
SELECT name, method, {sql_rnd('center', 6)} AS center, {sql_rnd('scale', 6)} AS scale FROM chp""")
def q_fit_channel_scalers(spark, sf_dir):
    tr = split_panel(spark, sf_dir).where(F.col("split") == "train")
    f = FT.channel_scaler_frame(tr, PANEL_SPEC)
    return f.select("name", "method", FT.rnd("center", 6).alias("center"), FT.rnd("scale", 6).alias("scale"))


def _scaled(col: str, params: str, name: str) -> str:
    return (f"CAST({sql_rnd(f'(CAST({col} AS DOUBLE) - (SELECT center FROM {params} WHERE name = {chr(39)}{name}{chr(39)})) / '
                             f'(SELECT scale FROM {params} WHERE name = {chr(39)}{name}{chr(39)})', 6)} AS FLOAT)")


def _onehot(cols: list[str]) -> str:
    parts = [f"list_transform((SELECT {c}_cats FROM cats), lambda v: CAST(CASE WHEN {c} = v THEN 1.0 ELSE 0.0 END AS FLOAT))"
             for c in cols]
    return " || ".join(parts)


def _cats_sql(cols: list[str]) -> str:
    return "cats AS MATERIALIZED (SELECT " + ", ".join(f"list_sort(list_distinct(list({c}))) AS {c}_cats" for c in cols) + " FROM train)"


@register("scale_static", f"""WITH {SP}, stp AS MATERIALIZED ({_robust_sql({c: [c] for c in STATIC_CONT})})
SELECT c_custkey, split, {', '.join(f"CAST({_scaled(c, 'stp', c)} AS DOUBLE) AS {c}_scaled" for c in STATIC_CONT)} FROM sp""")
def q_scale_static(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    params = FT.fit_robust(sp.where(F.col("split") == "train"), STATIC_CONT)
    return sp.select("c_custkey", "split", *[FT._f32(params.apply(c, F.col(c))).cast("double").alias(f"{c}_scaled")
                                            for c in STATIC_CONT])


@register("static_features", f"""WITH {SP}, stp AS MATERIALIZED ({_robust_sql({c: [c] for c in STATIC_CONT})}), {_cats_sql(STATIC_CAT)}
SELECT c_custkey, split, [{', '.join(_scaled(c, 'stp', c) for c in STATIC_CONT)}] || {_onehot(STATIC_CAT)} AS static FROM sp""")
def q_static_features(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    params = FT.fit_robust(tr, STATIC_CONT)
    cats = FT.fit_one_hot(tr, STATIC_CAT)
    return sp.select("c_custkey", "split", FT.static_representation(sp, STATIC_CONT, params, cats).alias("static"))


@register("one_hot_static", f"""WITH {SP}, {_cats_sql(STATIC_CAT)}
SELECT c_custkey, split, {_onehot(STATIC_CAT)} AS one_hot FROM sp""")
def q_one_hot_static(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    cats = FT.fit_one_hot(sp.where(F.col("split") == "train"), STATIC_CAT)
    return sp.select("c_custkey", "split", F.array(*FT.one_hot_columns(cats)).alias("one_hot"))


@register("tabular_features", f"""WITH {SP}, tp AS MATERIALIZED ({_robust_sql({c: [c] for c in TAB_CONT})}), {_cats_sql(TAB_CAT)}
SELECT c_custkey, split, [{', '.join(_scaled(c, 'tp', c) for c in TAB_CONT)}] || {_onehot(TAB_CAT)} AS tabular FROM sp""")
def q_tabular_features(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    params = FT.fit_robust(tr, TAB_CONT)
    cats = FT.fit_one_hot(tr, TAB_CAT)
    return sp.select("c_custkey", "split", FT.tabular_representation(TAB_CONT, params, cats).alias("tabular"))


def _temporal_sql() -> str:
    rows = []
    for i in range(1, PANEL_SPEC.n_periods + 1):
        rows.append("[" + ", ".join(_scaled(f"{ch}_{i}", "chp", ch) for ch in ("status", "bill", "pay")) + "]")
    return f"WITH {SP}, {CHANNEL_PARAMS} SELECT c_custkey, split, [{', '.join(rows)}] AS temporal FROM sp"


@register("temporal_features", _temporal_sql())
def q_temporal_features(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    params = FT.fit_channel_scalers(sp.where(F.col("split") == "train"), PANEL_SPEC)
    return sp.select("c_custkey", "split", FT.temporal_representation(PANEL_SPEC, params).alias("temporal"))


def _window_sql() -> str:
    cols, n = ["c_custkey"], PANEL_SPEC.n_periods
    for ch in ("bill", "pay"):
        a = [f"CAST({ch}_{i} AS DOUBLE)" for i in range(1, n + 1)]
        diffs = [f"{a[i + 1]} - {a[i]}" for i in range(n - 1)]
        mean2 = [f"({a[i]} + {a[i + 1]}) / 2.0" for i in range(n - 1)]
        max3 = [f"greatest({a[i]}, {a[i + 1]}, {a[i + 2]})" for i in range(n - 2)]
        mean3 = [f"({a[i]} + {a[i + 1]} + {a[i + 2]}) / 3.0" for i in range(n - 2)]
        cols += [f"{sql_rnd('greatest(' + ', '.join(diffs) + ')', 6)} AS {ch}_max_step_up",
                 f"{sql_rnd('least(' + ', '.join(diffs) + ')', 6)} AS {ch}_max_step_down",
                 f"{sql_rnd('greatest(' + ', '.join(mean2) + ')', 6)} AS {ch}_max_mean2",
                 f"{sql_rnd('greatest(' + ', '.join(max3) + ')', 6)} AS {ch}_max_max3",
                 f"{sql_rnd('least(' + ', '.join(mean3) + ')', 6)} AS {ch}_min_mean3",
                 f"{sql_rnd(mean3[-1], 6)} AS {ch}_last_mean3"]
    return f"WITH {PANEL_CTE} SELECT {', '.join(cols)} FROM panel"


@register("temporal_window_features", _window_sql())
def q_temporal_window_features(spark, sf_dir):
    return FT.temporal_window_features(customer_panel(spark, sf_dir), PANEL_SPEC)


@register("feature_lineage")
def q_feature_lineage(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    cats = FT.fit_one_hot(sp.where(F.col("split") == "train"), TAB_CAT)
    tab = [(c, c, "", "continuous") for c in TAB_CONT] + \
        [(n, n.rsplit("_", 1)[0], "", "categorical") for n in FT.one_hot_names(cats)]
    temporal = [(f"{ch}_t{i}", PANEL_SPEC.columns(ch)[i], PANEL_SPEC.periods[i], "status" if ch == "status" else "continuous")
                for i in range(PANEL_SPEC.n_periods) for ch in ("status", "bill", "pay")]
    return FT.feature_lineage(spark, {"tabular": tab, "temporal": temporal})


def _feature_checks_sql() -> str:
    from panelkit.plans.catalog import ORACLE
    from panelkit.plans.sql import s_cnt
    bad = "list_bool_or(list_transform({arr}, lambda x: x IS NULL OR isnan(x) OR abs(x) = CAST('inf' AS FLOAT)))"
    tb, tm = bad.format(arr="tabular"), bad.format(arr="flatten(temporal)")
    return f"""WITH tab AS ({ORACLE['tabular_features']}), tem AS ({ORACLE['temporal_features']})
SELECT 'tabular_finite' AS check_name, {s_cnt(tb)} = 0 AS passed,
  printf('%d rows with non-finite values', {s_cnt(tb)}) AS detail FROM tab
UNION ALL SELECT 'temporal_finite', {s_cnt(tm)} = 0, printf('%d rows with non-finite values', {s_cnt(tm)}) FROM tem"""


@register("feature_checks", _feature_checks_sql())
def q_feature_checks(spark, sf_dir):
    sp = split_panel(spark, sf_dir)
    tr = sp.where(F.col("split") == "train")
    params = FT.fit_robust(tr, TAB_CONT)
    cats = FT.fit_one_hot(tr, TAB_CAT)
    ch = FT.fit_channel_scalers(tr, PANEL_SPEC)
    rep = sp.select(FT.tabular_representation(TAB_CONT, params, cats).alias("tabular"),
                    FT.temporal_representation(PANEL_SPEC, ch).alias("temporal"))
    return FT.finite_checks(rep, ["tabular", "temporal"])

