"""Helpers that several training-data operators share."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import ensure_checkpoint_dir

#: order key given to a null id: before every other id
NULL_ORDER = -(1 << 63)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lost executors lose nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that nothing refers to any more; by itself it does so every
    half hour (``spark.cleaner.periodicGC.interval``), and until then they fill the disk beside the next job's."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (compared without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def order_key(column: str) -> Column:
    """An id as a never-null long; null ids come before all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ORDER))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64 arrays: a bijection that spreads bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def sliced(batches, limit: int, column: str = "text"):
    """Cut Arrow batches so that ``column`` holds at most ``limit`` bytes a piece (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        end = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(end, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(end[to - 1])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as strings, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without a copy, and n + 1 offsets into them (null: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def list_array(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values, kind))


def range_bounds(df: DataFrame, column: str, parts: int) -> np.ndarray:
    """Ascending upper bounds (inclusive, existing values; the last is the maximum) that deal the
    rows into about equal ranges.  At most ``parts`` numbers come to the driver; nulls don't count."""
    at = [k / parts for k in range(1, parts)] or [0.5]
    row = df.agg(F.percentile_approx(column, at, 10_000).alias("q"), F.max(column).alias("m")).first()
    if row["m"] is None:
        return np.zeros(0, np.int64)
    return np.unique(np.array([*(row["q"] or []), row["m"]], np.int64))
