"""Train-only feature preparation.

``fit_*`` run one aggregation over the *train* rows and bring back parameters
whose size is O(features) (centres, scales, category lists) - the same shape
as an MLlib model.  ``*_representation`` then apply them in one narrow
projection (no join, no shuffle), producing float arrays per row.
"""

from __future__ import annotations

import warnings

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.exprs import count_if, dbl, ratio, rnd
from panelkit.functions.quantiles import group_quantiles
from panelkit.operators.checks import Rule, run_checks
from panelkit.spec import PanelSpec

WIDE_CATEGORIES = 10_000  # a one-hot block wider than this is warned about, never cut


def class_weights(train: DataFrame, target: str = "target") -> DataFrame:
    """F1 / F2: N / (2 n_c) per class from train only, plus n_neg / n_pos (1.0 without positives)."""
    g = train.groupBy(F.col(target).cast("long").alias("class_value")).agg(F.count(F.lit(1)).cast("long").alias("count"))
    w = Window.partitionBy()  # two class rows
    n = F.sum("count").over(w)
    neg = F.sum(F.when(F.col("class_value") == 0, F.col("count")).otherwise(0)).over(w)
    pos = F.sum(F.when(F.col("class_value") == 1, F.col("count")).otherwise(0)).over(w)
    return g.select("class_value", "count", rnd(ratio(n, F.col("count") * 2), 6).alias("class_weight"),
                    rnd(F.coalesce(ratio(neg, pos), F.lit(1.0)), 6).alias("pos_weight"))


@dataclass
class ScalerParams:
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def apply(self, name: str, col: Column) -> Column:
        return (dbl(col) - F.lit(self.center[name])) / F.lit(self.scale[name])


def _robust_frame(stacked: DataFrame, method: str | None) -> DataFrame:
    m = method or stacked.sparkSession.conf.get("panelkit.quantiles.method", "auto")
    q = group_quantiles(stacked, ["_c"], "_x", {"q1": 0.25, "med": 0.5, "q3": 0.75}, m)
    iqr = F.col("q3") - F.col("q1")
    return q.select(F.col("_c").alias("name"), F.col("med").alias("center"),
                    F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def _collect_params(frame: DataFrame) -> ScalerParams:
    rows = frame.collect()  # one row per feature
    return ScalerParams({r["name"]: float(r["center"]) for r in rows}, {r["name"]: float(r["scale"]) for r in rows})


def _stack(train: DataFrame, named: dict[str, list[str]]) -> DataFrame:
    """(_c, _x) rows: every listed column value under its parameter name."""
    return train.select(F.inline(F.array(*[F.struct(F.lit(name).alias("_c"), dbl(c).alias("_x"))
                                           for name, cols in named.items() for c in cols])))


def fit_robust(train: DataFrame, cols: list[str], method: str | None = None) -> ScalerParams:
    """per column median / IQR (zero IQR -> scale 1), exact linear quantiles."""
    return _collect_params(_robust_frame(_stack(train, {c: [c] for c in cols}), method))


def channel_scaler_frame(train: DataFrame, spec: PanelSpec, standard: tuple[str, ...] = ("status",),
                         robust: tuple[str, ...] = ("bill", "pay"), method: str | None = None) -> DataFrame:
    """one scaler per channel over all periods flattened (train only).

    standard: mean and population std (zero -> 1); robust: median and IQR.
    """
    st = _stack(train, {ch: list(spec.columns(ch)) for ch in standard})
    std = st.groupBy("_c").agg(F.avg("_x").alias("center"), F.stddev_pop("_x").alias("sd")).select(
        F.col("_c").alias("name"), F.lit("standard").alias("method"), "center",
        F.when(F.col("sd") == 0, F.lit(1.0)).otherwise(F.col("sd")).alias("scale"))
    rb = _robust_frame(_stack(train, {ch: list(spec.columns(ch)) for ch in robust}), method) \
        .select("name", F.lit("robust").alias("method"), "center", "scale")
    return std.unionByName(rb)


def fit_channel_scalers(train: DataFrame, spec: PanelSpec, **kw) -> ScalerParams:
    return _collect_params(channel_scaler_frame(train, spec, **kw))


def fit_one_hot(train: DataFrame, cols: list[str]) -> dict[str, list]:
    """sorted distinct train categories per column (nulls ignored).  They become output columns, so all come to the driver."""
    st = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_s"))
                                         for c in cols]))).where(F.col("_s").isNotNull()).distinct()
    out: dict[str, list] = {c: [] for c in cols}
    types = dict(train.dtypes)
    for r in st.collect():
        out[r["_c"]].append(r["_s"])
    for c in cols:
        numeric = types[c] in ("tinyint", "smallint", "int", "bigint")
        vals = [int(v) for v in out[c]] if numeric else out[c]
        out[c] = sorted(vals)
        if len(vals) > WIDE_CATEGORIES:
            warnings.warn(f"one-hot column {c} has {len(vals)} categories", stacklevel=2)
    return out


def one_hot_columns(categories: dict[str, list]) -> list[Column]:
    """One float per (column, category); an unseen category gives all zeros."""
    return [F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).cast("float")
            for c, vals in categories.items() for v in vals]


def one_hot_names(categories: dict[str, list]) -> list[str]:
    return [f"{c}_{v}" for c, vals in categories.items() for v in vals]


def _f32(c: Column) -> Column:
    return rnd(c, 6).cast("float")


def static_representation(df: DataFrame, cont: list[str], params: ScalerParams, categories: dict[str, list]) -> Column:
    """robust-scaled static continuous columns followed by the one-hot block."""
    return F.array(*[_f32(params.apply(c, F.col(c))) for c in cont], *one_hot_columns(categories))


def tabular_representation(cont: list[str], params: ScalerParams, categories: dict[str, list]) -> Column:
    """robust-scaled continuous columns (per column) followed by the one-hot block."""
    return F.array(*[_f32(params.apply(c, F.col(c))) for c in cont], *one_hot_columns(categories))


def temporal_representation(spec: PanelSpec, params: ScalerParams, channels=("status", "bill", "pay")) -> Column:
    """F8: (periods x channels) float tensor, oldest period first, channel order as given."""
    return F.array(*[F.array(*[_f32(params.apply(ch, F.col(spec.columns(ch)[i]))) for ch in channels])
                     for i in range(spec.n_periods)])


def finite_checks(df: DataFrame, array_cols: list[str]) -> DataFrame:
    """no NULL / NaN / infinite element in any representation (nested arrays flattened)."""
    rules = []
    for c in array_cols:
        arr = F.col(c)
        if isinstance(df.schema[c].dataType.elementType, T.ArrayType):
            arr = F.flatten(arr)
        bad = F.exists(arr, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        rules.append(Rule(f"{c}_finite", count_if(bad) == 0, F.format_string("%d rows with non-finite values", count_if(bad))))
    return run_checks(df, rules)


def feature_lineage(spark, representations: dict[str, list[tuple[str, str, str, str]]], fitted_on: str = "train") -> DataFrame:
    """(representation, output_index, source_column, source_period, source_type, transformation,
    fitted_on, output_feature_name) from the fitted layout (small, built on the driver)."""
    rows = []
    for rep, feats in representations.items():
        for i, (name, source, period, kind) in enumerate(feats):
            transformation = "one_hot" if kind == "categorical" else ("standard_scaler" if kind == "status" else "robust_scaler")
            rows.append((rep, i, source, period, kind, transformation, fitted_on, name))
    return spark.createDataFrame(rows, "representation string, output_index int, source_column string, "
                                       "source_period string, source_type string, transformation string, "
                                       "fitted_on string, output_feature_name string")


def temporal_window_features(df: DataFrame, spec: PanelSpec, channels=("bill", "pay"), digits: int = 6) -> DataFrame:
    """L4 (re-aimed convolution features): fixed kernel-2 / kernel-3 window statistics over each
    channel's period array - adjacent differences, kernel-2 means, kernel-3 max and mean."""
    cols = [F.col(spec.id_col)]
    for ch in channels:
        arr = F.array(*[dbl(c) for c in spec.columns(ch)])
        n = spec.n_periods
        diffs = F.array(*[arr[i + 1] - arr[i] for i in range(n - 1)])
        mean2 = F.array(*[(arr[i] + arr[i + 1]) / 2.0 for i in range(n - 1)])
        max3 = F.array(*[F.greatest(arr[i], arr[i + 1], arr[i + 2]) for i in range(n - 2)])
        mean3 = F.array(*[(arr[i] + arr[i + 1] + arr[i + 2]) / 3.0 for i in range(n - 2)])
        cols += [rnd(F.array_max(diffs), digits).alias(f"{ch}_max_step_up"),
                 rnd(F.array_min(diffs), digits).alias(f"{ch}_max_step_down"),
                 rnd(F.array_max(mean2), digits).alias(f"{ch}_max_mean2"),
                 rnd(F.array_max(max3), digits).alias(f"{ch}_max_max3"),
                 rnd(F.array_min(mean3), digits).alias(f"{ch}_min_mean3"),
                 rnd(mean3[n - 3], digits).alias(f"{ch}_last_mean3")]
    return df.select(*cols)
