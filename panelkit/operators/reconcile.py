"""Keyed difference of two stored tables.

Rows fall into buckets by a hash of their key.  Each table is digested bucket by bucket (row
count, sum and xor of row hashes: partial aggregates, independent of order and partitioning);
only rows of buckets whose digests differ are joined, null-safe on the key, and compared column by column
within a tolerance.  Two equal tables cost one scan each and no join of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.exprs import count_if

BUCKETS = 1024


def _hash(cols: list[str]) -> Column:
    """64 bits of the columns; a null is told from every value and from its place."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return F.xxhash64(nulls, *[F.col(c) for c in cols])


def _bucketed(df: DataFrame, keys: list[str], cols: list[str], buckets: int) -> DataFrame:
    return df.select(*keys, *cols, F.pmod(_hash(keys), F.lit(buckets)).alias("_bucket"))


def bucket_digests(df: DataFrame, keys: list[str], cols: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, n, total, mixed): a digest of every bucket that has rows."""
    h = _hash([*keys, *cols])
    return _bucketed(df, keys, cols, buckets).groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(h).alias("mixed"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket): at most ``buckets`` rows."""
    a = bucket_digests(left, keys, cols, buckets)
    b = bucket_digests(right, keys, cols, buckets).select(F.col("_bucket").alias("_b"), F.col("n").alias("n2"), F.col("total").alias("t2"), F.col("mixed").alias("m2"))
    j = a.join(b, F.col("_bucket") == F.col("_b"), "full_outer")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("total").eqNullSafe(F.col("t2")) & F.col("mixed").eqNullSafe(F.col("m2"))
    return j.where(~same).select(F.coalesce("_bucket", "_b").alias("_bucket"))


def _equal(kind: T.DataType, a: Column, b: Column, tolerance: float) -> Column:
    """Null-safe equality; numbers may differ by ``tolerance``, NaN equals NaN."""
    if tolerance and isinstance(kind, T.NumericType):
        x, y = a.cast("double"), b.cast("double")
        return a.eqNullSafe(b) | F.coalesce(F.abs(x - y) <= F.lit(float(tolerance)), F.lit(False))
    return a.eqNullSafe(b)


def difference(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str] | None = None, tolerance: dict[str, float] | float = 0.0,
               buckets: int = BUCKETS) -> DataFrame:
    """(keys..., kind, column, left_value, right_value): what differs between two tables, one row a finding.

    ``left_only`` and ``right_only`` are keys of one table, ``duplicate_key`` keys that a table has more than once (values are then
    not compared; the counts are given), ``value`` a column whose values differ by more than its ``tolerance``.
    ``cols`` defaults to the columns both tables have.  Numeric columns of different types are compared by value.
    """
    cols = cols or [c for c in left.columns if c in right.columns and c not in keys]
    kinds = {f.name: f.dataType for f in left.schema}
    right = right.select(*keys, *[F.col(c).cast(kinds[c]) for c in cols])
    bad = [r["_bucket"] for r in differing_buckets(left, right, keys, cols, buckets).collect()]  # at most ``buckets`` numbers

    def side(df: DataFrame, tag: str) -> DataFrame:
        rows = _bucketed(df, keys, cols, buckets).where(F.col("_bucket").isin(bad) if bad else F.lit(False))
        one = F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(0).alias("_none"))
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_n_{tag}"), F.first(one).alias(f"_v_{tag}")).select(
            *[F.col(k).alias(f"_{tag}_{k}") for k in keys], f"_n_{tag}", f"_v_{tag}")

    same_key = reduce(lambda a, b: a & b, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    j = side(left, "l").join(side(right, "r"), same_key, "full_outer")

    def finding(when: Column, kind: str, column: str | None, a: Column, b: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"),
                                     a.cast("string").alias("left_value"), b.cast("string").alias("right_value")))

    n_l, n_r, none = F.col("_n_l"), F.col("_n_r"), F.lit(None)
    both = (n_l == 1) & (n_r == 1)
    doubled = F.coalesce(n_l > 1, F.lit(False)) | F.coalesce(n_r > 1, F.lit(False))
    found = [finding(doubled, "duplicate_key", None, F.coalesce(n_l, F.lit(0)), F.coalesce(n_r, F.lit(0))),
             finding(~doubled & n_r.isNull(), "left_only", None, none, none), finding(~doubled & n_l.isNull(), "right_only", None, none, none)]
    for c in cols:
        a, b = F.col(f"_v_l.{c}"), F.col(f"_v_r.{c}")
        allowed = tolerance.get(c, 0.0) if isinstance(tolerance, dict) else tolerance
        found.append(finding(both & ~_equal(kinds[c], a, b, allowed), "value", c, a, b))
    out = j.select(*[F.when(n_l.isNotNull(), F.col(f"_l_{k}")).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys],
                   F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("_f"))
    return out.select(*keys, "_f.kind", "_f.column", "_f.left_value", "_f.right_value")


def summary(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str] | None = None, tolerance: dict[str, float] | float = 0.0,
            buckets: int = BUCKETS) -> DataFrame:
    """One row: rows of either table and findings of each kind."""
    d = difference(left, right, keys, cols, tolerance, buckets)
    rows = [df.select(F.count(F.lit(1))).scalar() for df in (left, right)]
    kinds = ("left_only", "right_only", "duplicate_key", "value")
    counts = d.agg(*[count_if(F.col("kind") == k).alias(k) for k in kinds])
    return counts.select(rows[0].alias("left_rows"), rows[1].alias("right_rows"), *[F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in kinds])
