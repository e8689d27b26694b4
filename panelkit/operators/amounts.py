"""Amount-panel profiles (M1-M11) for one channel of a wide panel.

One operator serves both reference variants through ``AmountPolicy`` (bill vs
payment null rules).  Plan shape per call: one narrow unpivot, one moments
aggregation, exact quantiles, and the fence counts in one pass over the rows
against a one-row-per-key fence frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import broadcast_small, count_if, dbl, hist_bin, hist_edge, pct, pct0, ratio, rnd, sign_label
from panelkit.functions.quantiles import group_quantiles
from panelkit.session import track
from panelkit.spec import (BILL_POLICY, NEGATIVE_CLASS, PANEL_FENCE_K, POSITIVE_CLASS, SIGN_CATEGORIES, AmountPolicy,
                           PanelSpec)

SUMMARY_PROBS = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
CLASS_PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _method(df: DataFrame, method: str | None) -> str:
    return method or df.sparkSession.conf.get("panelkit.quantiles.method", "auto")


def exact_mean(v) -> F.Column:
    """sum / count: exact decimal sum, one IEEE division (engine independent)."""
    return F.try_divide(F.sum(v).cast("double"), F.count(v).cast("double"))


def _long(df: DataFrame, spec: PanelSpec, channel: str) -> DataFrame:
    return spec.to_long(df, [channel]).withColumnRenamed(channel, "v")


def _classes(spark, keys_df: DataFrame, classes=(NEGATIVE_CLASS, POSITIVE_CLASS)) -> DataFrame:
    """keys_df x classes via explode (keys_df is a tiny domain frame)."""
    return keys_df.select("*", F.explode(F.array(*[F.lit(c) for c in classes])).alias("target"))


def _profile(long: DataFrame, keys: list[str], probs: dict[str, float], lo: str, hi: str,
             fence_k: float, method: str) -> DataFrame:
    """moments + exact quantiles + strict fence counts per key (NULL values ignored)."""
    v = F.col("v")
    mom = long.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.count(v).cast("long").alias("n_obs"),
        exact_mean(v).alias("mean"), F.stddev_samp(dbl(v)).alias("std"),
        F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max"),
        count_if(v < 0).alias("negative_count"), count_if(v == 0).alias("zero_count"),
        count_if(v > 0).alias("positive_count"))
    q = group_quantiles(long, keys, "v", probs, method)
    q = q.withColumn("iqr", F.col(hi) - F.col(lo))
    q = q.withColumn("lower_fence", F.col(lo) - fence_k * F.col("iqr")) \
         .withColumn("upper_fence", F.col(hi) + fence_k * F.col("iqr"))
    q = track(q)  # one row per key; read by the fence join and by the output join
    ext = long.join(broadcast_small(q.select(*keys, "lower_fence", "upper_fence")), keys).groupBy(*keys).agg(
        count_if(v < F.col("lower_fence")).alias("below_lower_fence_count"),
        count_if(v > F.col("upper_fence")).alias("above_upper_fence_count"))
    return mom.join(q, keys, "left").join(ext, keys, "left")


def _r(*names):
    return [rnd(n, 6).alias(n) for n in names]


# ---------------------------------------------------------------------------
# M2 / M3
# ---------------------------------------------------------------------------

def panel_summary(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY,
                  fence_k: float = PANEL_FENCE_K, method: str | None = None) -> DataFrame:
    """M2: per period count, missing, moments, 7 exact percentiles, sign counts/% and 1.5×IQR fences."""
    p = _profile(_long(df, spec, channel), ["t", "period"], SUMMARY_PROBS, "p25", "p75", fence_k, _method(df, method))
    count = F.col("rows") if policy.count_all_rows else F.col("n_obs")
    below = F.coalesce(F.col("below_lower_fence_count"), F.lit(0))
    above = F.coalesce(F.col("above_upper_fence_count"), F.lit(0))
    return p.select(
        F.col("t").cast("long").alias("chronological_index"), "period", count.alias("count"),
        (F.col("rows") - F.col("n_obs")).alias("missing_count"),
        *_r("mean", "std", "min", "p01", "p05", "p25", "median", "p75", "p95", "p99", "max", "iqr"),
        "negative_count", "zero_count", "positive_count",
        rnd(pct0("negative_count", "n_obs"), 6).alias("negative_percentage"),
        rnd(pct0("zero_count", "n_obs"), 6).alias("zero_percentage"),
        rnd(pct0("positive_count", "n_obs"), 6).alias("positive_percentage"),
        *_r("lower_fence", "upper_fence"),
        below.alias("below_lower_fence_count"), above.alias("above_upper_fence_count"),
        (below + above).alias("total_potential_extreme_count"))


def panel_summary_by_target(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY,
                            fence_k: float = PANEL_FENCE_K, method: str | None = None) -> DataFrame:
    """M3: M2 per (period, class) with class-local fences.

    bill policy: classes with no observed value are skipped.  payment policy:
    both classes are always reported (empty ones with count 0 and NULL stats).
    """
    spark = df.sparkSession
    keys = ["t", "period", "target"]
    long = _long(df, spec, channel).withColumn("target", F.col(spec.target).cast("int"))
    p = _profile(long, keys, CLASS_PROBS, "q1", "q3", fence_k, _method(df, method))
    if policy.skip_empty_class:
        p = p.where(F.col("n_obs") > 0)
    else:
        dense = _classes(spark, spec.period_frame(spark))
        p = dense.join(p, keys, "left")
    count = F.coalesce(F.col("rows") if policy.count_all_rows else F.col("n_obs"), F.lit(0))
    extra = [(F.coalesce(F.col("rows"), F.lit(0)) - F.coalesce(F.col("n_obs"), F.lit(0))).alias("missing_count")] \
        if policy.count_all_rows else []
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    ext = F.coalesce(F.col("below_lower_fence_count"), F.lit(0)) + F.coalesce(F.col("above_upper_fence_count"), F.lit(0))
    return p.select(
        F.col("t").cast("long").alias("chronological_index"), "period", F.col("target").cast("long").alias("target"),
        count.cast("long").alias("count"), *extra,
        *_r("mean", "std", "min", "q1", "median", "q3", "max", "iqr"),
        z("negative_count"), z("zero_count"), z("positive_count"), ext.cast("long").alias("potential_extreme_count"))


# ---------------------------------------------------------------------------
# M1 / M4 sign tables
# ---------------------------------------------------------------------------

def _signs(spark, spec: PanelSpec) -> DataFrame:
    return spec.period_frame(spark).select("*", F.posexplode(F.array(*[F.lit(s) for s in SIGN_CATEGORIES]))
                                           .alias("sign_order", "sign_category"))


def sign_summary(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY) -> DataFrame:
    """M4 overall: per (period, sign) totals, population %, default counts / rate, caution flag.

    Dense over the three signs.  bill: NULL counts as zero, % over all rows;
    payment: NULL excluded, % over non-null rows, plus ``observed_combination``.
    """
    spark = df.sparkSession
    long = _long(df, spec, channel)
    signed = long.select("t", F.col(spec.target).alias("y"), "v",
                         sign_label(F.col("v"), policy.null_sign_is_zero).alias("sign_category"))
    g = signed.groupBy("t", "sign_category").agg(
        F.count(F.lit(1)).cast("long").alias("total_count"),
        count_if(F.col("y") == spec.positive).alias("default_count"),
        count_if(F.col("y") == spec.negative).alias("non_default_count"))
    per_t = signed.groupBy("t").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n_obs"))
    out = _signs(spark, spec).join(g, ["t", "sign_category"], "left").join(per_t, "t", "left")
    tot = F.coalesce(F.col("total_count"), F.lit(0))
    denom = F.col("n_obs") if not policy.null_sign_is_zero else F.col("rows")
    cols = [F.col("t").cast("long").alias("chronological_index"), "period", "sign_category",
            tot.alias("total_count"), rnd(pct0(tot, denom), 6).alias("population_percentage"),
            F.coalesce("default_count", F.lit(0)).alias("default_count"),
            F.coalesce("non_default_count", F.lit(0)).alias("non_default_count"),
            rnd(ratio("default_count", tot), 6).alias("default_rate")]
    if policy.caution_requires_observed:
        cols.append((tot > 0).alias("observed_combination"))
    cols.append(policy.caution(tot, spec.small_n).alias("caution_flag"))
    return out.where(F.col("sign_category").isNotNull()).select(*cols)


def sign_by_target(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY) -> DataFrame:
    """M4 by target: per (period, class, sign) count and % of the whole class."""
    spark = df.sparkSession
    long = _long(df, spec, channel)
    signed = long.select("t", F.col(spec.target).cast("int").alias("target"),
                         sign_label(F.col("v"), policy.null_sign_is_zero).alias("sign_category"))
    g = signed.groupBy("t", "target", "sign_category").agg(F.count(F.lit(1)).cast("long").alias("count"))
    cls = signed.groupBy("t", "target").agg(F.count(F.lit(1)).alias("class_total"))
    dense = _classes(spark, _signs(spark, spec))
    out = dense.join(g, ["t", "target", "sign_category"], "left").join(cls, ["t", "target"], "left")
    cnt = F.coalesce("count", F.lit(0))
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period",
                      F.col("target").cast("long").alias("target"), "sign_category", cnt.alias("count"),
                      rnd(pct0(cnt, F.col("class_total")), 6).alias("percentage"))


# ---------------------------------------------------------------------------
# M5 adjacent change
# ---------------------------------------------------------------------------

def _change(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy, by_target: bool,
            method: str | None) -> DataFrame:
    spark = df.sparkSession
    pairs = spec.pairs_long(df, channel).select(
        "pair_index", "source_period", "destination_period", F.col(spec.target).cast("int").alias("target"),
        (F.col("dst") - F.col("src")).alias("v"))
    keys = ["pair_index", "source_period", "destination_period"] + (["target"] if by_target else [])
    p = _profile(pairs, keys, CLASS_PROBS, "q1", "q3", 0.0, _method(df, method))
    if by_target:
        dom = spark.createDataFrame([(i + 1, spec.periods[i], spec.periods[i + 1]) for i in range(spec.n_periods - 1)],
                                    "pair_index int, source_period string, destination_period string")
        p = _classes(spark, dom).join(p, keys, "left")
    n = F.coalesce(F.col("rows") if policy.change_over_all_rows else F.col("n_obs"), F.lit(0))
    q1, q3 = f"q1{policy.quartile_suffix}", f"q3{policy.quartile_suffix}"
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return p.select(
        F.col("pair_index").cast("long").alias("pair_index"), "source_period", "destination_period",
        *([F.col("target").cast("long").alias("target")] if by_target else []),
        n.cast("long").alias("count"),
        rnd("mean", 6).alias("mean_change"), rnd("std", 6).alias("std_change"), rnd("min", 6).alias("min_change"),
        rnd("q1", 6).alias(q1), rnd("median", 6).alias("median_change"), rnd("q3", 6).alias(q3),
        rnd("max", 6).alias("max_change"),
        z("negative_count").alias("negative_change_count"), z("zero_count").alias("zero_change_count"),
        z("positive_count").alias("positive_change_count"),
        rnd(pct0(z("negative_count"), n), 6).alias("negative_change_percentage"),
        rnd(pct0(z("zero_count"), n), 6).alias("zero_change_percentage"),
        rnd(pct0(z("positive_count"), n), 6).alias("positive_change_percentage"))


def adjacent_change(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY,
                    method: str | None = None) -> DataFrame:
    """M5 overall: destination − source for each adjacent period pair."""
    return _change(df, spec, channel, policy, False, method)


def adjacent_change_by_target(df: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy = BILL_POLICY,
                              method: str | None = None) -> DataFrame:
    """M5 by target (both classes always reported)."""
    return _change(df, spec, channel, policy, True, method)


# ---------------------------------------------------------------------------
# M6 correlation matrix
# ---------------------------------------------------------------------------

def pairwise_corr(a, b) -> F.Column:
    """Pearson r over pairwise-complete rows; NULL (not an ANSI error) for a constant side."""
    a, b = dbl(a), dbl(b)
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(a2, b2), F.stddev_samp(a2) * F.stddev_samp(b2))


def pairwise_corr_sql(a: str, b: str) -> str:
    """:func:`pairwise_corr` as expression text (one parser call instead of many plan-builder calls)."""
    both = f"(`{a}` IS NOT NULL AND `{b}` IS NOT NULL)"
    a2 = f"(CASE WHEN {both} THEN CAST(`{a}` AS DOUBLE) END)"
    b2 = f"(CASE WHEN {both} THEN CAST(`{b}` AS DOUBLE) END)"
    return f"try_divide(covar_samp({a2}, {b2}), stddev_samp({a2}) * stddev_samp({b2}))"


def correlation_matrix(df: DataFrame, spec: PanelSpec, channel: str, digits: int = 6) -> DataFrame:
    """M6: long (row_index, row_period, column_index, column_period, correlation), one pass.

    All n(n+1)/2 pair aggregates are evaluated in a single aggregation over the
    wide table, then mirrored.
    """
    cols, df = spec.columns(channel), spec.with_known(df, [channel])
    n = spec.n_periods
    aggs = [F.expr(pairwise_corr_sql(cols[i], cols[j])).alias(f"c_{i}_{j}") for i in range(n) for j in range(i, n)]
    one = df.agg(*aggs)
    structs = []
    for i in range(n):
        for j in range(n):
            a, b = min(i, j), max(i, j)
            structs.append(F.struct(F.lit(i + 1).cast("long").alias("row_index"), F.lit(spec.periods[i]).alias("row_period"),
                                    F.lit(j + 1).cast("long").alias("column_index"),
                                    F.lit(spec.periods[j]).alias("column_period"),
                                    rnd(F.col(f"c_{a}_{b}"), digits).alias("correlation")))
    return one.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------------------
# M7 display range, M8 / M9 / M10 histograms
# ---------------------------------------------------------------------------

def global_range(long: DataFrame, lo_p: float, hi_p: float, method: str | None = None) -> DataFrame:
    """One-row frame (lo, hi): global exact percentiles over all non-null values."""
    return group_quantiles(long, [], "v", {"lo": lo_p, "hi": hi_p}, method)


def display_range(df: DataFrame, spec: PanelSpec, channel: str, lo_p: float = 0.01, hi_p: float = 0.99,
                  method: str | None = None) -> DataFrame:
    """M7: global p1 / p99 and below / above / outside counts, globally (index 0) and per period.

    The per-period rows and the global row come from one ``rollup`` aggregation.
    """
    long = _long(df, spec, channel)
    rng = global_range(long, lo_p, hi_p, method)
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    v = dbl("v")
    g = long.rollup("t", "period").agg(
        F.count(F.lit(1)).cast("long").alias("total_count"),
        count_if(v < lo).alias("below_range_count"), count_if(v > hi).alias("above_range_count"),
        F.grouping_id().alias("gid"))
    g = g.where((F.col("gid") == 0) | (F.col("gid") == 3))
    outside = F.col("below_range_count") + F.col("above_range_count")
    return g.select(
        F.coalesce(F.col("t"), F.lit(0)).cast("long").alias("chronological_index"),
        F.when(F.col("gid") == 3, F.lit("Global")).otherwise(F.col("period")).alias("period"),
        rnd(lo, 6).alias("global_low_percentile"), rnd(hi, 6).alias("global_high_percentile"),
        "total_count", "below_range_count", "above_range_count", outside.alias("outside_range_count"),
        rnd(pct(outside, F.col("total_count")), 6).alias("outside_range_percentage"))


def range_histogram(df: DataFrame, spec: PanelSpec, channel: str, n_bins: int = 50, lo_p: float = 0.01,
                    hi_p: float = 0.99, method: str | None = None) -> DataFrame:
    """M8: counts per period in fixed bins over the global [p_lo, p_hi] range.

    Values outside the range are counted below / above, never clipped into the
    edge bins; the last bin is closed.  Dense over (period, bin).
    """
    spark = df.sparkSession
    long = _long(df, spec, channel).where(F.col("v").isNotNull())
    rng = global_range(long, lo_p, hi_p, method)
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    v = dbl("v")
    counts = long.select("t", hist_bin(v, lo, hi, n_bins).alias("bin")).where(F.col("bin").isNotNull()) \
        .groupBy("t", "bin").agg(F.count(F.lit(1)).cast("long").alias("count"))
    side = long.groupBy("t").agg(count_if(v < lo).alias("below_count"), count_if(v > hi).alias("above_count"))
    dense = spec.period_frame(spark).select("*", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    out = dense.join(counts, ["t", "bin"], "left").join(side, "t", "left")
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period",
                      F.col("bin").cast("long").alias("bin_index"),
                      rnd(hist_edge(F.col("bin"), lo, hi, n_bins), 6).alias("bin_left"),
                      rnd(hist_edge(F.col("bin") + 1, lo, hi, n_bins), 6).alias("bin_right"),
                      F.coalesce("count", F.lit(0)).alias("count"),
                      F.coalesce("below_count", F.lit(0)).alias("below_count"),
                      F.coalesce("above_count", F.lit(0)).alias("above_count"))


def range_histogram_by_target(df: DataFrame, spec: PanelSpec, channel: str, n_bins: int = 50,
                              lo_p: float = 0.01, hi_p: float = 0.99, method: str | None = None) -> DataFrame:
    """M9: % of the whole class (non-null values) per bin, plus below / above %; empty class -> zeros."""
    spark = df.sparkSession
    long = _long(df, spec, channel).where(F.col("v").isNotNull()).withColumn("target", F.col(spec.target).cast("int"))
    rng = global_range(long, lo_p, hi_p, method)
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    v = dbl("v")
    counts = long.select("t", "target", hist_bin(v, lo, hi, n_bins).alias("bin")).where(F.col("bin").isNotNull()) \
        .groupBy("t", "target", "bin").agg(F.count(F.lit(1)).alias("n"))
    cls = long.groupBy("t", "target").agg(F.count(F.lit(1)).alias("class_n"), count_if(v < lo).alias("below"),
                                          count_if(v > hi).alias("above"))
    dense = _classes(spark, spec.period_frame(spark)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    out = dense.join(counts, ["t", "target", "bin"], "left").join(cls, ["t", "target"], "left")
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period",
                      F.col("target").cast("long").alias("target"), F.col("bin").cast("long").alias("bin_index"),
                      rnd(pct0(F.coalesce("n", F.lit(0)), "class_n"), 6).alias("percentage"),
                      rnd(pct0(F.coalesce("below", F.lit(0)), "class_n"), 6).alias("below_percentage"),
                      rnd(pct0(F.coalesce("above", F.lit(0)), "class_n"), 6).alias("above_percentage"))


def change_histogram(df: DataFrame, spec: PanelSpec, channel: str, n_bins: int = 40, lo_p: float = 0.05,
                     hi_p: float = 0.95, method: str | None = None) -> DataFrame:
    """Global p5 / p95 over all adjacent differences, then M8 per pair with below% / above%."""
    spark = df.sparkSession
    pairs = spec.pairs_long(df, channel).select("pair_index", (F.col("dst") - F.col("src")).alias("v")) \
        .where(F.col("v").isNotNull())
    rng = global_range(pairs, lo_p, hi_p, method)
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    v = dbl("v")
    counts = pairs.select("pair_index", hist_bin(v, lo, hi, n_bins).alias("bin")).where(F.col("bin").isNotNull()) \
        .groupBy("pair_index", "bin").agg(F.count(F.lit(1)).cast("long").alias("count"))
    side = pairs.groupBy("pair_index").agg(F.count(F.lit(1)).alias("n"), count_if(v < lo).alias("below"),
                                           count_if(v > hi).alias("above"))
    dom = spark.range(1, spec.n_periods).select(F.col("id").cast("int").alias("pair_index"),
                                                F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    out = dom.join(counts, ["pair_index", "bin"], "left").join(side, "pair_index", "left")
    return out.select(F.col("pair_index").cast("long").alias("pair_index"), F.col("bin").cast("long").alias("bin_index"),
                      rnd(hist_edge(F.col("bin"), lo, hi, n_bins), 6).alias("bin_left"),
                      rnd(hist_edge(F.col("bin") + 1, lo, hi, n_bins), 6).alias("bin_right"),
                      F.coalesce("count", F.lit(0)).alias("count"),
                      rnd(pct0(F.coalesce("below", F.lit(0)), "n"), 6).alias("below_percentage"),
                      rnd(pct0(F.coalesce("above", F.lit(0)), "n"), 6).alias("above_percentage"))


def assert_no_percentage_change(df: DataFrame) -> None:
    """Change tables must not carry a percentage-change column."""
    bad = [c for c in df.columns if "percentage_change" in c]
    if bad:
        raise ValueError(f"percentage-change columns are not allowed: {bad}")
