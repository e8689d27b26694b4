"""Bill x payment relationship per period.

Pairs of channels are unpivoted together (one row per entity and period with
both values).  Several medians are computed in one pass by stacking the
measures into a single value-count table keyed by (period, measure).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if, dbl, hist_bin, pct0, ratio, rnd
from panelkit.functions.quantiles import group_quantiles
from panelkit.operators.amounts import exact_mean, pairwise_corr
from panelkit.spec import NEGATIVE_CLASS, POSITIVE_CLASS, RELATIONSHIP_CATEGORIES, PanelSpec

RATIO_PROBS = {"ratio_p25": 0.25, "ratio_median": 0.5, "ratio_p75": 0.75, "ratio_p95": 0.95, "ratio_p99": 0.99}


def _method(df, method):
    return method or df.sparkSession.conf.get("panelkit.quantiles.method", "auto")


def _pairs(df: DataFrame, spec: PanelSpec, bill: str, pay: str) -> DataFrame:
    return spec.to_long(df, [bill, pay]).select("t", "period", F.col(spec.target).cast("int").alias("target"),
                                                F.col(bill).alias("b"), F.col(pay).alias("p"))


def _medians(long: DataFrame, keys: list[str], measures: dict[str, F.Column], method: str) -> DataFrame:
    """Median of several measures per key in one pass of ranks; returns keys + <measure>_median."""
    stacked = long.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("_m"), dbl(expr).alias("_x")) for name, expr in measures.items()])))
    q = group_quantiles(stacked, [*keys, "_m"], "_x", {"med": 0.5}, method)
    return q.groupBy(*keys).pivot("_m", list(measures)).agg(F.first("med")) \
        .select(*keys, *[F.col(m).alias(f"{m}_median") for m in measures])


def _dense_classes(spark, spec: PanelSpec) -> DataFrame:
    return spec.period_frame(spark).select("*", F.explode(F.array(F.lit(NEGATIVE_CLASS), F.lit(POSITIVE_CLASS))).alias("target"))


def relationship_summary(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay",
                         method: str | None = None) -> DataFrame:
    """Per period means / medians (each over its own non-nulls), Pearson r and counts over
    pairwise-complete rows, and the mean / median of payment - bill."""
    long = _pairs(df, spec, bill, pay)
    b, p = F.col("b"), F.col("p")
    both = b.isNotNull() & p.isNotNull()
    diff = F.when(both, p - b)
    agg = long.groupBy("t", "period").agg(
        F.count(F.lit(1)).cast("long").alias("total_count"), exact_mean(b).alias("bill_mean"),
        exact_mean(p).alias("payment_mean"), pairwise_corr(b, p).alias("pearson_correlation"),
        count_if(both & (p == 0)).alias("zero_payment_count"), count_if(both & (b > 0)).alias("positive_bill_count"),
        count_if(both & (b <= 0)).alias("nonpositive_bill_count"),
        count_if(both & (b > 0) & (p == 0)).alias("positive_bill_and_zero_payment_count"),
        count_if(both & (b > 0) & (p > 0)).alias("positive_bill_and_positive_payment_count"),
        exact_mean(diff).alias("same_index_difference_mean"))
    med = _medians(long, ["t"], {"bill": b, "payment": p, "diff": diff}, _method(df, method))
    out = agg.join(med, "t", "left")
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period", "total_count",
                      rnd("bill_mean", 6).alias("bill_mean"), rnd("bill_median", 6).alias("bill_median"),
                      rnd("payment_mean", 6).alias("payment_mean"), rnd("payment_median", 6).alias("payment_median"),
                      rnd("pearson_correlation", 6).alias("pearson_correlation"), "zero_payment_count",
                      "positive_bill_count", "nonpositive_bill_count", "positive_bill_and_zero_payment_count",
                      "positive_bill_and_positive_payment_count",
                      rnd("same_index_difference_mean", 6).alias("same_index_difference_mean"),
                      rnd("diff_median", 6).alias("same_index_difference_median"))


def relationship_by_target(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay",
                           method: str | None = None) -> DataFrame:
    """R2: per (period, class); medians / r over pairwise-complete rows, % over all rows of the class."""
    spark = df.sparkSession
    long = _pairs(df, spec, bill, pay)
    b, p = F.col("b"), F.col("p")
    both = b.isNotNull() & p.isNotNull()
    keys = ["t", "period", "target"]
    agg = long.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n"), pairwise_corr(b, p).alias("r"),
        count_if(both & (p == 0)).alias("zp"), count_if(both & (b > 0) & (p == 0)).alias("pbzp"))
    med = _medians(long, ["t", "target"], {"bill": F.when(both, b), "payment": F.when(both, p),
                                           "diff": F.when(both, p - b)}, _method(df, method))
    out = _dense_classes(spark, spec).join(agg, keys, "left").join(med, ["t", "target"], "left")
    n = F.coalesce("n", F.lit(0))
    zp, pbzp = F.coalesce("zp", F.lit(0)), F.coalesce("pbzp", F.lit(0))
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period", F.col("target").cast("long").alias("target"),
                      n.alias("count"), rnd("bill_median", 6).alias("bill_median"),
                      rnd("payment_median", 6).alias("payment_median"), rnd("r", 6).alias("pearson_correlation"),
                      zp.alias("zero_payment_count"), rnd(pct0(zp, n), 6).alias("zero_payment_percentage"),
                      pbzp.alias("positive_bill_and_zero_payment_count"),
                      rnd(pct0(pbzp, n), 6).alias("positive_bill_and_zero_payment_percentage"),
                      rnd("diff_median", 6).alias("same_index_difference_median"))


def _ratio(df: DataFrame, spec: PanelSpec, bill: str, pay: str, by_target: bool, method: str | None) -> DataFrame:
    spark = df.sparkSession
    long = _pairs(df, spec, bill, pay).where(F.col("b").isNotNull() & F.col("p").isNotNull())
    long = long.withColumn("ratio", F.when(F.col("b") > 0, dbl("p") / dbl("b")))
    keys = ["t", "period"] + (["target"] if by_target else [])
    r = F.col("ratio")
    agg = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tot"), count_if(F.col("b") > 0).alias("elig"),
        F.avg(r).alias("ratio_mean"), F.stddev_samp(r).alias("ratio_std"), F.min(r).alias("ratio_min"),
        F.max(r).alias("ratio_max"), count_if(r == 0).alias("ratio_zero_count"),
        count_if(r == 1).alias("ratio_equal_one_count"), count_if(r > 1).alias("ratio_above_one_count"))
    q = group_quantiles(long, keys, "ratio", RATIO_PROBS, _method(df, method))
    out = agg.join(q, keys, "left")
    if by_target:
        out = _dense_classes(spark, spec).join(out, keys, "left")
    elig, tot = F.coalesce("elig", F.lit(0)), F.coalesce("tot", F.lit(0))
    stat = lambda c, min_n=1: F.when(elig >= min_n, rnd(c, 6)).alias(c)
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period",
                      *([F.col("target").cast("long").alias("target")] if by_target else []),
                      elig.cast("long").alias("eligible_count"), (tot - elig).cast("long").alias("ineligible_count"),
                      rnd(pct0(elig, tot), 6).alias("eligible_percentage"), stat("ratio_mean"), stat("ratio_std", 2),
                      stat("ratio_min"), *[stat(c) for c in RATIO_PROBS], stat("ratio_max"),
                      F.when(elig >= 1, rnd(F.col("ratio_p75") - F.col("ratio_p25"), 6)).alias("ratio_iqr"),
                      z("ratio_zero_count"), z("ratio_equal_one_count"), z("ratio_above_one_count"))


def ratio_summary(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay",
                  method: str | None = None) -> DataFrame:
    """R3 / R6 overall: payment / bill only where bill > 0 (guarded), with quantiles and the IQR."""
    return _ratio(df, spec, bill, pay, False, method)


def ratio_by_target(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay",
                    method: str | None = None) -> DataFrame:
    """R3 / R6 by class (both classes always reported; std NULL for n <= 1)."""
    return _ratio(df, spec, bill, pay, True, method)


def relationship_categories(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay") -> DataFrame:
    """Four exclusive cells {bill <= 0, > 0} x {payment = 0, > 0} per period.

    A negative payment fails the job (``raise_error`` evaluated in the scan);
    rows with a NULL side fall in no cell.
    """
    spark = df.sparkSession
    long = _pairs(df, spec, bill, pay)
    p = F.when(F.col("p") < 0, F.raise_error(F.lit("Negative payment values exist unexpectedly."))).otherwise(F.col("p"))
    b = F.col("b")
    cat = (F.when((b <= 0) & (p == 0), F.lit(RELATIONSHIP_CATEGORIES[0]))
            .when((b <= 0) & (p > 0), F.lit(RELATIONSHIP_CATEGORIES[1]))
            .when((b > 0) & (p == 0), F.lit(RELATIONSHIP_CATEGORIES[2]))
            .when((b > 0) & (p > 0), F.lit(RELATIONSHIP_CATEGORIES[3])))
    c = long.select("t", "target", cat.alias("category"))
    g = c.groupBy("t", "category").agg(F.count(F.lit(1)).cast("long").alias("tot"),
                                       count_if(F.col("target") == spec.positive).alias("dc"),
                                       count_if(F.col("target") == spec.negative).alias("ndc"))
    n = c.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    dom = spec.period_frame(spark).select("*", F.explode(F.array(*[F.lit(x) for x in RELATIONSHIP_CATEGORIES])).alias("category"))
    out = dom.join(g, ["t", "category"], "left").join(n, "t", "left")
    tot = F.coalesce("tot", F.lit(0))
    return out.select(F.col("t").cast("long").alias("chronological_index"), "period", "category", tot.alias("total_count"),
                      rnd(pct0(tot, "n"), 6).alias("population_percentage"),
                      F.coalesce("dc", F.lit(0)).alias("default_count"), F.coalesce("ndc", F.lit(0)).alias("non_default_count"),
                      rnd(ratio("dc", tot), 6).alias("default_rate"), ((tot > 0) & (tot < spec.small_n)).alias("caution_flag"))


def density_2d(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay", grid: int = 50,
               lo_p: float = 0.01, hi_p: float = 0.99, method: str | None = None) -> DataFrame:
    """R5 (re-aimed from a hexbin): rectangular grid x grid counts per period over the global
    p1..p99 extent of each axis; points outside the extent are not counted.  Sparse output."""
    long = _pairs(df, spec, bill, pay).where(F.col("b").isNotNull() & F.col("p").isNotNull())
    stacked = long.select(F.inline(F.array(F.struct(F.lit("b").alias("_a"), dbl("b").alias("_x")),
                                           F.struct(F.lit("p").alias("_a"), dbl("p").alias("_x")))))
    q = group_quantiles(stacked, ["_a"], "_x", {"lo": lo_p, "hi": hi_p}, _method(df, method))
    bx = q.where(F.col("_a") == "b")
    py = q.where(F.col("_a") == "p")
    blo, bhi = bx.select("lo").scalar(), bx.select("hi").scalar()
    plo, phi = py.select("lo").scalar(), py.select("hi").scalar()
    cells = long.select("t", "period", hist_bin(dbl("b"), blo, bhi, grid).alias("x_bin"),
                        hist_bin(dbl("p"), plo, phi, grid).alias("y_bin"))
    g = cells.where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull()) \
        .groupBy("t", "period", "x_bin", "y_bin").agg(F.count(F.lit(1)).cast("long").alias("count"))
    return g.select(F.col("t").cast("long").alias("chronological_index"), "period",
                    F.col("x_bin").cast("long").alias("x_bin"), F.col("y_bin").cast("long").alias("y_bin"), "count")

