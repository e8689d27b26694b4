"""Approximate distinct counts by mergeable sketches (P5 at sizes where exact counts cost a shuffle of all values).

A sketch is a HyperLogLog of 2 ** lg_k registers, made where the rows are and merged as a partial
aggregate; stored sketches of days, files or runs are united later without the rows.  The
standard error of an estimate is at most 1.04 / sqrt(2 ** lg_k).  Null and NaN count for nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / math.sqrt(1 << lg_k)


def distinct_sketches(df: DataFrame, cols: list[str], by: list[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """(by..., column, n, sketch): one small sketch for every column of every group."""
    kinds = dict(df.dtypes)
    value = {c: F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("float", "double") else F.col(c) for c in cols}
    # adding zero makes -0.0 and 0.0 one value
    text = {c: ((v + 0.0) if kinds[c] in ("float", "double") else v).cast("string") for c, v in value.items()}
    long = df.select(*(by or []), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), text[c].alias("value")) for c in cols])))
    return long.groupBy(*(by or []), "column").agg(F.count("value").alias("n"), F.hll_sketch_agg("value", F.lit(lg_k)).alias("sketch"))


def united(*tables: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of several runs or groups as one for each column (of each of the groups ``by``)."""
    out = tables[0].select(*(by or []), "column", "n", "sketch")
    for t in tables[1:]:
        out = out.unionByName(t.select(*(by or []), "column", "n", "sketch"))
    return out.groupBy(*(by or []), "column").agg(F.sum("n").cast("long").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame) -> DataFrame:
    """The sketches' columns with the estimated distinct count in place of the sketch."""
    keep = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*keep, F.hll_sketch_estimate("sketch").cast("long").alias("distinct_estimate"))
