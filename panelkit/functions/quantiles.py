"""Exact (linear-interpolated) quantiles per group, built on a value-count table.

``value_counts`` collapses rows to distinct ``(keys, value, n)``; it is hash
partitioned on the value too, so a key holding a third of the table is still
spread over all tasks and partially aggregated map-side.

Range-partitioned prefix counts give every distinct value its rank interval; the
two ranks around ``p*(N-1)`` are picked by an equi-join on the keys and joined by
``a + (b - a) * f``.  There is one formula at every size.

Many rows with many different values are first collapsed (:func:`_near_ranks`): only values near the
ranks looked for stay apart, all others of a key between two such stretches are one row with their
count.  The ranks stay exact, and a rank that falls on a collapsed row is seen, and then all values are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import broadcast_small
from panelkit.functions.ordered import SMALL_LIMIT, ordered_prefix
from panelkit.session import track

#: names that callers may give; all mean the exact value
METHODS = ("auto", "percentile", "ranked")
#: accuracy of the sketch that says where a rank lies, and how far around it (as a part of the rows) values stay apart
SKETCH_ACCURACY, MARGIN = 4000, 0.0015
#: keys with at most so many values keep all of them apart
FEW_VALUES = 20_000


def _method(df: DataFrame, method: str | None) -> str:
    return method or df.sparkSession.conf.get("panelkit.quantiles.method", "auto")


def value_counts(df: DataFrame, keys: list[str], value: str | Column) -> DataFrame:
    """(keys, _v, _n): distinct values and their counts; NULL and NaN are no values."""
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, v.alias("_v"))
    if rows.schema["_v"].dataType.typeName() in ("double", "float"):
        rows = rows.where(~F.isnan("_v"))
    return (rows.where(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))


def quantiles_from_counts(vc: DataFrame, keys: list[str], probs: dict[str, float],
                          method: str = "auto") -> DataFrame:
    """``vc`` = (keys, _v, _n) with unique (keys, _v).  Returns keys + one double column per prob."""
    if method not in METHODS:
        raise ValueError(f"unknown quantile method {method!r}")
    return _ranked(vc, keys, probs)


def _ranked(vc: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    return _pivoted(_picked(vc, keys, probs), keys, probs)


def _picked(vc: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """One row for each key and probability: its position and the values at the two ranks around it; ``_bad`` if one of them is a collapsed row."""
    pref = ordered_prefix(vc, keys, "_v", ["_n"])
    totals = vc.groupBy(*keys).agg(F.sum("_n").alias("_N"))
    targets = totals.select(*keys, "_N", F.inline(F.array(*[
        F.struct(F.lit(n).alias("_qname"), F.lit(float(p)).alias("_p")) for n, p in probs.items()])))
    pos = F.col("_p") * (F.col("_N") - 1).cast("double")
    targets = targets.select(*keys, "_qname", pos.alias("_pos"),
                             F.floor(pos).cast("long").alias("_lo"), F.ceil(pos).cast("long").alias("_hi"))
    # Each (key, q) matches at most two distinct values; the target side has
    # (#keys x #probs) rows and is broadcast once that size is proven.
    hit_lo = (F.col("_lo") >= F.col("_n_before")) & (F.col("_lo") < F.col("_n_before") + F.col("_n"))
    hit_hi = (F.col("_hi") >= F.col("_n_before")) & (F.col("_hi") < F.col("_n_before") + F.col("_n"))
    j = pref.join(broadcast_small(targets), on=keys, how="inner").where(hit_lo | hit_hi)
    bad = F.max(F.col("_v") != F.col("_top")) if "_top" in vc.columns else F.lit(False)
    return j.groupBy(*keys, "_qname").agg(
        F.max(F.when(hit_lo, F.col("_v"))).cast("double").alias("_q_lo_value"),
        F.max(F.when(hit_hi, F.col("_v"))).cast("double").alias("_q_hi_value"),
        F.first("_pos").alias("_pos"), F.first("_lo").alias("_lo"), bad.alias("_bad"))


def _pivoted(picked: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    frac = F.col("_pos") - F.col("_lo").cast("double")
    a, b = F.col("_q_lo_value"), F.col("_q_hi_value")
    val = F.when(frac == 0, a).otherwise(a + (b - a) * frac)
    res = picked.groupBy(*keys).pivot("_qname", list(probs)).agg(F.first(val))
    return res.select(*keys, *[F.col(n).cast("double").alias(n) for n in probs])


def _near_ranks(rows: DataFrame, keys: list[str], probs: dict[str, float], near: DataFrame) -> DataFrame:
    """``rows`` = (keys, _v) -> (keys, _v, _n, _top): values near the ranks with their counts, all others between two stretches
    of these as one row from ``_v`` to ``_top``.  ``near`` has the stretches (``_a0``, ``_b0``, ...) of every key."""
    v, at = F.col("_v"), F.col("_v").cast("double")
    inside, gap = F.lit(False), F.lit(0)
    for k in range(len(probs)):
        inside = inside | at.between(F.col(f"_a{k}"), F.col(f"_b{k}"))
        gap = gap + F.when(at > F.col(f"_b{k}"), 1).otherwise(0)
    cells = rows.join(broadcast_small(near), keys).select(*keys, v, F.when(~inside, gap).alias("_gap"), F.when(inside, v).alias("_apart"))
    return (cells.groupBy(*keys, "_gap", "_apart").agg(F.min("_v").alias("_v"), F.max("_v").alias("_top"), F.count(F.lit(1)).alias("_n"))
            .select(*keys, "_v", "_n", "_top"))


def group_quantiles(df: DataFrame, keys: list[str], value: str | Column, probs: dict[str, float],
                    method: str | None = None) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys`` (NULL and NaN ignored, numpy 'linear' rule).

    Up to ``panelkit.prefix.inMemoryLimit`` values are counted one by one.  Beyond it a mergeable sketch says where
    each rank lies, and one more pass counts the values near it one by one and all others as few rows:
    nothing but those is shuffled, sorted or kept, whatever the number of rows.
    """
    m = _method(df, method)
    if m not in METHODS:
        raise ValueError(f"unknown quantile method {m!r}")
    if not keys:  # global quantile: a constant key keeps every join an equi-join
        v = F.col(value) if isinstance(value, str) else value
        res = group_quantiles(df.select(F.lit(0).alias("_g"), v.alias("_gv")), ["_g"], "_gv", probs, m)
        return res.drop("_g")
    rows = df.select(*keys, (F.col(value) if isinstance(value, str) else value).alias("_v"))
    if rows.schema["_v"].dataType.typeName() in ("double", "float"):
        rows = rows.where(~F.isnan("_v")).withColumn("_v", F.col("_v") + F.lit(0.0))  # one zero
    rows = rows.where(F.col("_v").isNotNull())
    spread = [min(max(p + d, 0.0), 1.0) for p in probs.values() for d in (-MARGIN, MARGIN)]
    sketch = track(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_N"), F.percentile_approx(
        F.col("_v").cast("double"), spread, SKETCH_ACCURACY).alias("_at")))  # one row per key
    n_rows = sketch.agg(F.sum("_N")).first()[0] or 0
    if n_rows > int(df.sparkSession.conf.get("panelkit.prefix.inMemoryLimit", str(SMALL_LIMIT))):
        few, inf = F.col("_N") <= FEW_VALUES, float("inf")
        near = sketch.select(*keys, *[x for k in range(len(probs)) for x in (
            F.when(few, F.lit(-inf)).otherwise(F.col("_at")[2 * k]).alias(f"_a{k}"),
            F.when(few, F.lit(inf)).otherwise(F.col("_at")[2 * k + 1]).alias(f"_b{k}"))])
        picked = track(_picked(_near_ranks(rows, keys, probs, near), keys, probs))
        if picked.where("_bad").isEmpty():
            return _pivoted(picked, keys, probs)
    return quantiles_from_counts(value_counts(rows, keys, "_v"), keys, probs, m)
