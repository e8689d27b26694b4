"""Raw-table audit (P1-P12) and static profiles split by outcome.

Multi-column profiles unpivot the columns once (narrow ``inline``) and run one
aggregation keyed by (column, value); nothing is computed column by column.
Totals come from windows over the already-aggregated (tiny) result, not from
joins against a second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.exprs import broadcast_small, count_if, hist_bin, hist_edge, known, pct, ratio, rnd, widen_flat_range
from panelkit.functions.quantiles import group_quantiles, quantiles_from_counts, value_counts
from panelkit.session import track
from panelkit.spec import DOCUMENTED, POSITIVE_CLASS, NEGATIVE_CLASS, SMALL_N, STATIC_FENCE_K, UNDOCUMENTED, CodeBook

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL = (T.FloatType, T.DoubleType)


def require_columns(df: DataFrame, cols) -> None:
    """V1: raise listing missing and available columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Required column(s) missing: {missing}; available: {df.columns}")


def _grouped_by_value(df: DataFrame, cols: list[str], aggs, keep: list[str] | None = None) -> DataFrame:
    """Aggregate per (column, value) with values kept in their native type; only the
    aggregated rows are cast to string (one unpivot per physical type, then a union)."""
    keep = keep or []
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(types[c], []).append(c)
    out = None
    for group in by_type.values():
        g = df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                                for c in group]))) \
            .groupBy("column", "value").agg(*aggs()).withColumn("value", F.col("value").cast("string"))
        out = g if out is None else out.unionByName(g)
    return out


# ---------------------------------------------------------------------------
# P1/P2/P3/P5/P12 column audit
# ---------------------------------------------------------------------------

def audit_columns(df: DataFrame) -> DataFrame:
    """One row per column with ordinal, dtype, missing, infinite, distinct counts.

    Missing / infinite counts are one aggregation over the wide table.  Exact
    distinct counts unpivot the columns of each physical type to
    (column, value) - native values, no string formatting - de-duplicate with
    map-side partial aggregation, then count per column, so no single task
    holds a column's distinct set.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).cast("long").alias("row_count")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        frac = isinstance(f.dataType, FRACTIONAL)
        miss = (c.isNull() | F.isnan(c)) if frac else c.isNull()
        inf = (F.abs(c) == F.lit(float("inf"))) if frac else F.lit(False)
        aggs += [count_if(miss).alias(f"m{i}"), count_if(inf).alias(f"i{i}")]
    stacked = df.agg(*aggs).select("row_count", F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i + 1).cast("long").alias("ordinal"),
                 F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"m{i}").alias("missing_count"),
                 F.col(f"i{i}").alias("infinite_count"))
        for i, f in enumerate(fields)])))
    by_type: dict[str, list[str]] = {}
    for f in fields:
        by_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    distinct = None
    for cols in by_type.values():
        part = (df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), known(c, df.schema[c].dataType).alias("value")) for c in cols])))
                .where(F.col("value").isNotNull()).groupBy("column", "value").count()
                .groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("unique_count")))
        distinct = part if distinct is None else distinct.unionByName(part)
    out = stacked.join(distinct, "column", "left")
    return out.select("column", "ordinal", "dtype", "missing_count", "infinite_count",
                      F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"), "row_count",
                      (F.coalesce("unique_count", F.lit(0)) == F.col("row_count")).alias("all_unique"))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Is ``key`` unique?  (n, distinct, unique flag)."""
    d = df.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return d.agg(F.sum("n").cast("long").alias("non_null_rows"), F.count(F.lit(1)).cast("long").alias("distinct_keys"),
                 F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_multiplicity")) \
            .withColumn("is_unique", F.col("max_multiplicity") <= 1)


# ---------------------------------------------------------------------------
# P4 duplicates
# ---------------------------------------------------------------------------

def audit_duplicates(df: DataFrame, id_col: str | None) -> DataFrame:
    """Rows involved in duplicates (keep=False) and extra rows (keep='first'), two scopes.

    Each scope is one groupBy over the scope columns with map-side partial counts;
    a hot duplicate group only costs its count, not its rows.
    """
    scopes = [("all_columns_including_ID", list(df.columns))]
    if id_col is not None:
        scopes.append(("all_columns_excluding_ID", [c for c in df.columns if c != id_col]))
    parts = []
    for name, cols in scopes:
        g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("rows_involved"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("duplicate_rows_excl_first"),
        ).select(F.lit(name).alias("scope"), "rows_involved", "duplicate_rows_excl_first"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# P7 / P8 / S1 / P10 categorical audit
# ---------------------------------------------------------------------------

def _doc_flag(codebook: CodeBook) -> F.Column:
    cond = F.lit(False)
    for feat, codes in codebook.documented.items():
        cond = cond | ((F.col("column") == feat) & F.col("value").isin(*[str(c) for c in codes]))
    return cond


def audit_categorical_values(df: DataFrame, cols: list[str], codebook: CodeBook,
                             always_documented: tuple[str, ...] = ()) -> DataFrame:
    """(column, value, count, percentage, documented) for each listed column.

    Columns in ``always_documented`` (e.g. the target) are flagged documented.
    """
    require_columns(df, cols)
    g = _grouped_by_value(df, cols, lambda: [F.count(F.lit(1)).cast("long").alias("count")])
    total = F.sum("count").over(Window.partitionBy("column"))
    doc = _doc_flag(codebook)
    if always_documented:
        doc = doc | F.col("column").isin(*always_documented)
    return g.select("column", "value", "count", rnd(pct(F.col("count"), total), 4).alias("percentage"),
                    doc.alias("documented"))


def undocumented_values(df: DataFrame, cols: list[str], codebook: CodeBook) -> DataFrame:
    """Observed codes minus documented codes (a left anti join with the code book)."""
    spark = df.sparkSession
    book = spark.createDataFrame([(f, str(c)) for f, cs in codebook.documented.items() for c in cs],
                                 "column string, value string")
    g = _grouped_by_value(df, cols, lambda: [F.count(F.lit(1)).cast("long").alias("count")])
    # the code book is a fixed-size list given by the caller: broadcast it
    return g.join(F.broadcast(book), ["column", "value"], "left_anti").select(
        "column", "value", "count",
        F.lit("value is absent from the code book").alias("note"))


def target_summary(df: DataFrame, target: str, positive: int = POSITIVE_CLASS) -> DataFrame:
    """Class counts, percentage, imbalance ratio majority/minority."""
    require_columns(df, [target])
    g = df.groupBy(F.col(target).alias("class_value")).agg(F.count(F.lit(1)).cast("long").alias("count"))
    w = Window.partitionBy()  # over <= a few class rows
    return g.select(
        F.col("class_value").cast("long").alias("class_value"),
        F.when(F.col("class_value") == positive, F.lit("default")).otherwise(F.lit("no_default")).alias("class_label"),
        "count",
        rnd(pct(F.col("count"), F.sum("count").over(w)), 4).alias("percentage"),
        rnd(ratio(F.max("count").over(w), F.min("count").over(w)), 4).alias("imbalance_ratio_majority_to_minority"),
        F.lit(positive).cast("long").alias("positive_class"),
    )


# ---------------------------------------------------------------------------
# P9 describe
# ---------------------------------------------------------------------------

def _long_numeric(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), known(F.col(c).cast("double"), T.DoubleType()).alias("v")) for c in cols])))


def describe_numeric(df: DataFrame, cols: list[str] | None = None, method: str | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75 % (linear), max per numeric column."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    long = _long_numeric(df, cols)
    mom = long.groupBy("column").agg(
        F.count("v").cast("long").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = group_quantiles(long, ["column"], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, method)
    out = mom.join(q, "column", "left")
    return out.select("column", "count", rnd("mean", 6).alias("mean"), rnd("std", 6).alias("std"),
                      rnd("min", 6).alias("min"), rnd("p25", 6).alias("p25"), rnd("p50", 6).alias("p50"),
                      rnd("p75", 6).alias("p75"), rnd("max", 6).alias("max"))


# ---------------------------------------------------------------------------
# S2 / S3 numeric summaries with 3 x IQR fences
# ---------------------------------------------------------------------------

def _fmt1(c) -> F.Column:
    return F.format_string("%.1f", rnd(c, 1))


def _numeric_profile(df: DataFrame, cols: list[str], keys: list[str], fence_k: float,
                     method: str | None) -> DataFrame:
    long = _long_numeric(df, cols, keys)
    k = ["column", *keys]
    mom = long.groupBy(*k).agg(
        F.count("v").cast("long").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    vc = value_counts(long, k, "v")
    m = method or df.sparkSession.conf.get("panelkit.quantiles.method", "auto")
    if m == "approx":
        q = group_quantiles(long, k, "v", {"q25": 0.25, "median": 0.5, "q75": 0.75}, m)
    else:
        q = quantiles_from_counts(vc, k, {"q25": 0.25, "median": 0.5, "q75": 0.75}, m)
    fences = q.select(*k, "q25", "median", "q75", (F.col("q75") - F.col("q25")).alias("iqr"))
    fences = fences.select("*", (F.col("q25") - fence_k * F.col("iqr")).alias("lf"),
                           (F.col("q75") + fence_k * F.col("iqr")).alias("uf"))
    fences = track(fences)  # one row per key; read by the fence join and by the output join
    # second pass runs on the distinct-value table joined with a one-row-per-key fence frame
    ext = vc.join(broadcast_small(fences.select(*k, "lf", "uf")), k).groupBy(*k).agg(
        F.sum(F.when((F.col("_v") < F.col("lf")) | (F.col("_v") > F.col("uf")), F.col("_n")).otherwise(0))
        .cast("long").alias("n_extreme"))
    return mom.join(fences, k, "left").join(ext, k, "left")


def _numeric_select(p: DataFrame, keys: list) -> DataFrame:
    # fixed output value: the note names the count and both fences
    note = F.concat(F.coalesce(F.col("n_extreme"), F.lit(0)).cast("string"), F.lit(" values outside 3×IQR fences ["),
                    _fmt1("lf"), F.lit(", "), _fmt1("uf"), F.lit("]; not removed"))
    return p.select(F.col("column").alias("feature"), *keys, "count",
                    rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"), rnd("min", 4).alias("min"),
                    rnd("q25", 4).alias("q25"), rnd("median", 4).alias("median"), rnd("q75", 4).alias("q75"),
                    rnd("max", 4).alias("max"), rnd("iqr", 4).alias("iqr"), note.alias("potential_extreme_note"))


def numeric_summary(df: DataFrame, cols: list[str], fence_k: float = STATIC_FENCE_K,
                    method: str | None = None) -> DataFrame:
    """Overall statistics and strict 3×IQR extreme count per numeric column."""
    require_columns(df, cols)
    return _numeric_select(_numeric_profile(df, cols, [], fence_k, method), [])


def numeric_by_target(df: DataFrame, cols: list[str], target: str, positive: int = POSITIVE_CLASS,
                      fence_k: float = STATIC_FENCE_K, method: str | None = None) -> DataFrame:
    """S3: S2 per class, fences computed per class."""
    require_columns(df, [*cols, target])
    p = _numeric_profile(df.withColumn("_t", F.col(target)), cols, ["_t"], fence_k, method)
    p = p.where(F.col("_t").isNotNull())
    return _numeric_select(p, [F.col("_t").cast("long").alias("target_value"),
                               F.when(F.col("_t") == positive, "default").otherwise("no_default").alias("target_label")])


# ---------------------------------------------------------------------------
# S4 / S5 categorical distribution and default rates
# ---------------------------------------------------------------------------

def _doc_status(codebook: CodeBook) -> F.Column:
    return F.when(_doc_flag(codebook), F.lit(DOCUMENTED)).otherwise(F.lit(UNDOCUMENTED))


def categorical_distribution(df: DataFrame, cols: list[str], codebook: CodeBook,
                             small_n: int = SMALL_N) -> DataFrame:
    """Count, percentage (4 dp), documentation status, small-sample flag per raw code."""
    require_columns(df, cols)
    g = _grouped_by_value(df, cols, lambda: [F.count(F.lit(1)).cast("long").alias("count")])
    n = F.sum("count").over(Window.partitionBy("column"))
    return g.select(F.col("column").alias("feature"), F.col("value").alias("raw_value"), "count",
                    rnd(pct(F.col("count"), n), 4).alias("percentage"),
                    _doc_status(codebook).alias("documentation_status"),
                    (F.col("count") < small_n).alias("small_sample_warning"))


def categorical_default_rates(df: DataFrame, cols: list[str], target: str, codebook: CodeBook,
                              positive: int = POSITIVE_CLASS, small_n: int = SMALL_N) -> DataFrame:
    """Totals, defaults, non-defaults, default rate (6 dp), population % (4 dp), flags.

    One aggregation keyed by (feature, code) after a narrow unpivot; the population
    total is a window over the aggregated rows.
    """
    require_columns(df, [*cols, target])
    g = _grouped_by_value(df, cols, lambda: [F.count(F.lit(1)).cast("long").alias("total_count"),
                                             count_if(F.col(target) == positive).alias("default_count")], [target])
    n = F.sum("total_count").over(Window.partitionBy("column"))
    return g.select(F.col("column").alias("feature"), F.col("value").alias("raw_value"), "total_count",
                    "default_count", (F.col("total_count") - F.col("default_count")).alias("non_default_count"),
                    rnd(ratio("default_count", "total_count"), 6).alias("default_rate"),
                    rnd(pct(F.col("total_count"), n), 4).alias("population_percentage"),
                    _doc_status(codebook).alias("documentation_status"),
                    (F.col("total_count") < small_n).alias("small_sample_warning"))


def overall_default_rate(df: DataFrame, target: str, positive: int = POSITIVE_CLASS) -> DataFrame:
    """The reference line of the default-rate charts."""
    return df.agg(rnd(ratio(count_if(F.col(target) == positive), F.count(F.lit(1))), 6).alias("overall_default_rate"))


# ---------------------------------------------------------------------------
# S7 class histogram with shared edges, S8 box statistics
# ---------------------------------------------------------------------------

def class_histogram(df: DataFrame, col: str, target: str, n_bins: int = 40,
                    classes=(NEGATIVE_CLASS, POSITIVE_CLASS)) -> DataFrame:
    """Edges from the non-null min..max of the whole column; % of each class per bin.

    Dense over bins x classes; the bin domain comes from ``sequence`` on the
    one-row range frame (no cross join of data).
    """
    require_columns(df, [col, target])
    if n_bins <= 0:
        raise ValueError("n_bins must be positive")
    v = known(F.col(col).cast("double"), T.DoubleType())
    rng = df.agg(F.min(v).alias("lo0"), F.max(v).alias("hi0"))
    lo, hi = widen_flat_range(F.col("lo0"), F.col("hi0"))
    rng = rng.select(lo.alias("lo"), hi.alias("hi"))
    # the range is a one-row aggregate: used as scalar subqueries, not joined
    lo_s, hi_s = rng.select("lo").scalar(), rng.select("hi").scalar()
    data = df.select(v.alias("v"), F.col(target).alias("cls")).where(F.col("v").isNotNull())
    counts = data.select("cls", hist_bin("v", lo_s, hi_s, n_bins).alias("bin")) \
        .groupBy("cls", "bin").agg(F.count(F.lit(1)).alias("n"))
    # every non-null value lies in [min, max], so class totals come from the (tiny) bin counts
    class_tot = counts.groupBy("cls").agg(F.sum("n").alias("class_n"))
    dense = rng.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"),
                       F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls"))
    out = dense.join(counts, ["cls", "bin"], "left").join(class_tot, "cls", "left")
    return out.select(F.lit(col).alias("feature"), F.col("cls").cast("long").alias("target"),
                      F.col("bin").cast("long").alias("bin_index"),
                      rnd(hist_edge(F.col("bin"), F.col("lo"), F.col("hi"), n_bins), 6).alias("bin_left"),
                      rnd(hist_edge(F.col("bin") + 1, F.col("lo"), F.col("hi"), n_bins), 6).alias("bin_right"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("count"),
                      rnd(F.coalesce(pct(F.col("n"), F.col("class_n")), F.lit(0.0)), 6).alias("percentage"))


def box_stats(df: DataFrame, cols: list[str], target: str, whisker: float = 1.5,
              method: str | None = None) -> DataFrame:
    """Five-number summary per (column, class), 1.5×IQR whiskers at the furthest
    datum inside the fences (matplotlib rule), and the flier count."""
    require_columns(df, [*cols, target])
    long = _long_numeric(df, cols, [F.col(target).alias("_t")])
    k = ["column", "_t"]
    vc = value_counts(long, k, "v")
    q = quantiles_from_counts(vc, k, {"q1": 0.25, "median": 0.5, "q3": 0.75},
                              method or df.sparkSession.conf.get("panelkit.quantiles.method", "auto"))
    f = q.select(*k, "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    f = f.select("*", (F.col("q1") - whisker * F.col("iqr")).alias("lo_f"), (F.col("q3") + whisker * F.col("iqr")).alias("hi_f"))
    j = vc.join(broadcast_small(f), k)
    inside = (F.col("_v") >= F.col("lo_f")) & (F.col("_v") <= F.col("hi_f"))
    agg = j.groupBy(*k).agg(
        F.sum("_n").cast("long").alias("count"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"), F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).cast("long").alias("flier_count"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"))
    return agg.select(F.col("column").alias("feature"), F.col("_t").cast("long").alias("target"), "count",
                      *[rnd(c, 6).alias(c) for c in ("min", "q1", "median", "q3", "max", "whisker_low", "whisker_high")],
                      "flier_count")
