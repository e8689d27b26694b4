"""Ordered prefix sums that stay distributed when a key holds most of the rows.

A window ``partitionBy(key).orderBy(v)`` puts every row of a key in one task;
with a handful of keys (6 periods, 3 models) that is one task per key over the
whole table.  Instead the rows are range-partitioned on (key, v), so a hot key
is spread over many partitions, summed locally, and each partition receives
the exclusive running total of the partitions before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.exprs import broadcast_small
from panelkit.session import ensure_checkpoint_dir, track

SMALL_LIMIT = 2_000_000
ROWS_PER_PARTITION = 4_000_000


def _default_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def ordered_prefix(df: DataFrame, keys: list[str], order_col: str, sum_cols: list[str],
                   num_partitions: int | None = None, neighbours: list[str] | None = None) -> DataFrame:
    """Add ``<c>_before``: sum of ``c`` over rows of the same keys with a smaller ``order_col``; and, for
    ``neighbours``, the struct columns ``_prev`` and ``_next`` with those columns of the row before and after
    (null at either end of a key).

    ``(keys, order_col)`` must be unique (aggregate first).  Inputs of at most
    ``panelkit.prefix.inMemoryLimit`` rows use a plain per-key window.  Larger
    ones are range-partitioned; the range-partitioned
    frame is checkpointed so the partition ids seen by the local pass and by the
    per-partition totals are the same even if tasks are retried on other executors.
    A partition gets from the others one row for each key: the running total before it and the
    nearest row on either side.  Null keys are keys like any other.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get("panelkit.prefix.inMemoryLimit", str(SMALL_LIMIT)))
    beside = F.struct(*neighbours) if neighbours else None
    df = track(df)
    n_rows = df.count()
    if n_rows <= limit:
        # provably small: one window per key over at most ``limit`` rows in total
        by = Window.partitionBy(*keys).orderBy(order_col)
        w = by.rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*df.columns, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_before") for c in sum_cols],
                         *([F.lag(beside).over(by).alias("_prev"), F.lead(beside).over(by).alias("_next")] if neighbours else []))
    ensure_checkpoint_dir(spark)
    # size range partitions from the row count (default ~4M rows each), never below the shuffle default
    per_part = int(spark.conf.get("panelkit.prefix.rowsPerPartition", str(ROWS_PER_PARTITION)))
    parts = num_partitions or max(_default_partitions(df), -(-n_rows // per_part))
    ranged = (df.repartitionByRange(parts, *[F.col(k) for k in keys], F.col(order_col))
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))

    local_by = Window.partitionBy("_pid", *keys).orderBy(order_col)
    local_w = local_by.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(local_w), F.lit(0)).alias(f"_loc_{c}") for c in sum_cols],
                          *([F.lag(beside).over(local_by).alias("_loc_prev"), F.lead(beside).over(local_by).alias("_loc_next")] if neighbours else []))

    totals = ranged.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols],
                                               *([F.min_by(beside, order_col).alias("_head"), F.max_by(beside, order_col).alias("_tail")] if neighbours else []))
    parts_of_key = Window.partitionBy(*keys).orderBy("_pid")
    off_w = parts_of_key.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_o_{k}") for k in keys],
                            *[F.coalesce(F.sum(f"_tot_{c}").over(off_w), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
                            *([F.lag("_tail").over(parts_of_key).alias("_off_prev"), F.lead("_head").over(parts_of_key).alias("_off_next")] if neighbours else []))
    # offsets has at most (partitions + distinct keys) rows: broadcast once that is proven
    same = F.col("_pid") == F.col("_opid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    joined = local.join(broadcast_small(offsets), same, "inner")
    return joined.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{c}_before") for c in sum_cols],
                         *([F.coalesce("_loc_prev", "_off_prev").alias("_prev"), F.coalesce("_loc_next", "_off_next").alias("_next")] if neighbours else []))
