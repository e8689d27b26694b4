"""Reuse or refuse: stored results that are either whole and known or not there.

A result is written to a staging folder, read back, verified (its checks, its row count and the
order-independent digest of its rows), moved to its place, and published by a marker
file written last.  A folder without a marker is partial state and is never read; a marker whose
fingerprint of the inputs differs is another result and is never overwritten unless told to.
Folders are reached through Hadoop's file system, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.checks import assert_checks

MARKER, DATA = "published.json", "data"


class PartialState(RuntimeError):
    """Files are there, but nothing was published."""


class OtherResult(RuntimeError):
    """Something was published from other inputs, or the stored rows are not those that were published."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def digest(df: DataFrame) -> dict:
    """Row count, schema and an order-independent hash of all rows; one row comes to the driver."""
    cols = df.columns
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    h = F.xxhash64(nulls, *[F.col(f"`{c}`") for c in cols])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(h).alias("mixed")).first()
    return {"rows": int(row["n"]), "total": str(row["total"]), "mixed": str(row["mixed"]), "schema": df.schema.simpleString()}


def read_marker(spark: SparkSession, path: str) -> dict | None:
    """The marker of a published result; None if nothing is there; ``PartialState`` if files are, but no marker."""
    if not _exists(spark, f"{path}/{MARKER}"):
        if _children(spark, path):
            raise PartialState(f"{path} holds files but nothing was published: {_children(spark, path)}")
        return None
    text = "".join(r["value"] for r in spark.read.text(f"{path}/{MARKER}").collect())  # a few hundred bytes
    try:
        return json.loads(text)
    except ValueError as exc:
        raise PartialState(f"the marker in {path} is not whole") from exc


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_published(spark: SparkSession, path: str, fingerprint: str | None = None, verify: bool = True) -> DataFrame:
    """The published rows, after a look at the marker, the fingerprint of the inputs and (``verify``) the rows themselves."""
    marker = read_marker(spark, path)
    if marker is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    if fingerprint is not None and marker["fingerprint"] != fingerprint:
        raise OtherResult(f"{path} was published from other inputs ({marker['fingerprint']}, not {fingerprint})")
    if DATA not in _children(spark, path):
        raise PartialState(f"{path} has a marker but no rows")
    df = spark.read.parquet(f"{path}/{DATA}")
    if verify and digest(df) != marker["digest"]:
        raise OtherResult(f"the rows at {path} are not those that were published")
    return df


def publish(df: DataFrame, path: str, fingerprint: str, checks: Callable[[DataFrame], DataFrame] | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Write, read back, verify, move into place, publish.  A failure at any step leaves nothing that could be taken for a result."""
    spark = df.sparkSession
    if read_marker(spark, path) is not None:
        raise OtherResult(f"{path} is published already")
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    fs, _ = _fs(spark, path)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{staging}/{DATA}")
        back = spark.read.parquet(f"{staging}/{DATA}")
        if checks is not None:
            assert_checks(checks(back))
        marker = {"fingerprint": fingerprint, "digest": digest(back)}
        fs.mkdirs(to_path(path))
        if not fs.rename(to_path(f"{staging}/{DATA}"), to_path(f"{path}/{DATA}")):
            raise OSError(f"could not move the verified rows to {path}")
        _write_text(spark, f"{path}/{MARKER}", json.dumps(marker, sort_keys=True))
    finally:
        if fs.exists(to_path(staging)):
            fs.delete(to_path(staging), True)
    return read_published(spark, path, fingerprint, verify=False)


def reuse_or_create(spark: SparkSession, path: str, fingerprint: str, build: Callable[[], DataFrame],
                    checks: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, bool]:
    """The published rows if they are whole, pass the checks and come from these inputs; a new result where nothing is; else an error.
    The flag says whether they were reused."""
    if read_marker(spark, path) is None:
        return publish(build(), path, fingerprint, checks), False
    df = read_published(spark, path, fingerprint)
    if checks is not None:
        assert_checks(checks(df))
    return df, True
