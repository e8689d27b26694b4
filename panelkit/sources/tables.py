"""Readers and sinks (A1-A10).

Everything goes through ``spark.read`` / ``df.write`` so scans keep parquet
column pruning, filter pushdown and partition pruning.
"""

from __future__ import annotations

import csv
import json
import os
import re
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from panelkit.functions.exprs import broadcast_small
from panelkit.functions.sha256 import Sha256, sha256_goes_on

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one test table."""
    return spark.read.parquet(table_path(sf_dir, name))


def _opened(read, path: str) -> DataFrame:
    """``read()``, once its path is known to exist."""
    try:
        df = read()
        df.schema  # noqa: B018 - forces path resolution
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(f"Raw dataset not found at {path}") from exc
        raise
    return df


def load_raw(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
             junk_header_rows: int = 0) -> DataFrame:
    """A1: load the raw table; a missing path raises FileNotFoundError naming it.

    CSV exports with a title row above the header set ``junk_header_rows=1``
    (see :func:`load_titled_csv`).  ``schema`` then types the columns by name.
    """
    if junk_header_rows and fmt == "csv":
        if junk_header_rows != 1:
            raise ValueError("one title row at most can stand above the header")
        return load_titled_csv(spark, path, schema)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
        return _opened(lambda: reader.csv(path), path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return _opened(lambda: reader.format(fmt).load(path), path)


#: most different headers that one folder of files may have
MAX_HEADERS = 64


def _header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line: blanks by place, repeats numbered."""
    out: list[str] = []
    for k, name in enumerate(next(csv.reader([line], delimiter=sep))):
        name = name.strip() or f"_c{k}"
        n = sum(1 for x in out if x == name or x.startswith(f"{name}."))
        out.append(f"{name}.{n}" if name in out else name)
    return out


def load_titled_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
                    each_header: bool = False) -> DataFrame:
    """A1 for CSV files whose first line is a title and whose second line names the columns.

    Files are read as whole lines, so the title may have any width; the reader itself
    drops the first line of every file by its place.  The header is the second line
    of one file and its copies at the start of the others go; with ``each_header``
    every file is parsed by its own second line (one more pass over the lines), and a column
    that a file lacks is null there.  Blank lines count for nothing, unless the first line is blank: then it is the title,
    and so it must be in all files.  Lines are parsed where they are read, without a
    shuffle; missing fields are null, surplus ones are dropped.  Without ``schema`` all
    columns are text; with it, columns come by name, values that don't fit are null and a
    column that no header names raises ValueError.  Quoted line ends are not supported.
    """
    whole = "\u0001"  # no line holds it: a line is one field
    top = _opened(lambda: spark.read.text(path), path).where(F.col("_metadata.file_block_start") == 0).first()
    titled = top is not None and bool(top["value"].strip())  # the reader skips blank lines, a blank title too
    lines = spark.read.option("header", titled).option("sep", whole).option("quote", "").option("escape", "").schema("line string").csv(path)
    lines = lines.where(F.col("line").isNotNull())
    first_block = F.col("_metadata.file_block_start") == 0
    if each_header:
        at = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
        heads = (lines.select(F.col("_metadata.file_path").alias("_file"), "line", at.alias("_at"))
                 .groupBy("_file").agg(F.min_by("line", "_at").alias("_header")))
        headers = [r["_header"] for r in heads.select("_header").distinct().limit(MAX_HEADERS + 1).collect()]
        if len(headers) > MAX_HEADERS:
            raise ValueError(f"more than {MAX_HEADERS} different headers in {path}")
    else:
        top = lines.where(first_block).first()
        headers = [] if top is None else [top["line"]]
    if not headers:
        raise ValueError(f"no header row below the title row in {path}")
    if each_header and len(headers) > 1:
        rows = lines.withColumn("_file", F.col("_metadata.file_path")).withColumn("_start", first_block).join(broadcast_small(heads), "_file")
    else:
        rows = lines.select("line", first_block.alias("_start"), F.lit(headers[0]).alias("_header"))
    rows = rows.where(~(F.col("_start") & (F.col("line") == F.col("_header"))))
    by_header = {h: _header_names(h, sep) for h in sorted(headers)}
    names = list(dict.fromkeys(n for own in by_header.values() for n in own))

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    parsed = {h: F.from_csv("line", ", ".join(f"{quoted(n)} string" for n in own), {"sep": sep}) for h, own in by_header.items()}
    out = []
    for name in names:
        value = F.coalesce(*(F.when(F.col("_header") == F.lit(h), parsed[h].getField(name)) if len(by_header) > 1 else parsed[h].getField(name)
                             for h, own in by_header.items() if name in own))
        out.append(value.alias(name))
    df = rows.select(*out)
    if schema is None:
        return df
    lacking = [f.name for f in schema if f.name not in names]
    if lacking:
        raise ValueError(f"columns not in the header of {path}: {lacking}")
    return df.select(*[F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in schema])


#: files up to this size are hashed by one task each; larger ones piece by piece
WHOLE_BYTES = 128 << 20
#: names of files that the line reader would unpack, so that it does not see their own bytes
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".passthrough")
_BOM = b"\xef\xbb\xbf"


def file_integrity(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """A2: (file_name, size_bytes, sha256) per file, hashed on the executors.

    ``binaryFile`` reads a file whole inside one task, and none above 2 GB.  So files of more than
    ``WHOLE_BYTES`` go through :func:`_sha256_by_pieces`; those jobs run at once, one after another for a
    file and side by side for several.  Packed files (``.gz`` and the like) are read whole at any size.
    """
    files = spark.read.format("binaryFile").load(paths)
    large = files.where(F.col("length") > WHOLE_BYTES).select("path", "length").collect()  # no contents, one row a large file
    pieces, whole = [], []
    for r in large:
        (pieces if sha256_goes_on() and not r["path"].endswith(_PACKED) else whole).append(r)
    contents = files.where(F.col("length") <= WHOLE_BYTES).select("path", "length", "content")  # pushed down: no other file is opened
    if whole:
        contents = contents.unionByName(spark.read.format("binaryFile").load([_literal(r["path"]) for r in whole]).select("path", "length", "content"))
    out = contents.select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    if pieces:
        with ThreadPoolExecutor(min(len(pieces), spark.sparkContext.defaultParallelism)) as pool:
            digests = list(pool.map(inheritable_thread_target(spark)(lambda r: _sha256_by_pieces(spark, r["path"], r["length"])), pieces))
        out = out.unionByName(spark.createDataFrame([(r["path"], r["length"], d) for r, d in zip(pieces, digests)],
                                                    "path string, length long, sha256 string"))
    return out.select(
        F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
        F.col("length").cast("long").alias("size_bytes"),
        "sha256",
    )


def _literal(path: str) -> str:
    """The path as a pattern that only it matches."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _sha256_by_pieces(spark: SparkSession, path: str, size: int) -> str:
    """sha256 of one file that no task reads whole.

    The digest is one chain over the bytes, so its pieces follow one another: each is the one task of a
    job, begins with the state (112 bytes) that the piece before came to, and returns its own.  The
    pieces are the splits of the line reader, told to end lines at newline bytes only; a line is then
    the bytes between two of them, whatever they mean.
    """
    lines = spark.read.option("lineSep", "\n").text(_literal(path)).select(
        F.concat(F.lit(bytearray(b"\n")), F.col("value").cast("binary")).alias("line"), F.col("_metadata.file_block_start").alias("at"))
    n_pieces = lines.rdd.getNumPartitions()
    for head in (b"", _BOM):  # the line reader drops this mark at the start of a file
        digest = Sha256()
        digest.update(head)
        done, last = len(head), None
        for k in range(n_pieces):
            piece = lines.mapInArrow(_hash_lines(digest.state(), last), "state binary, n long, at long").rdd
            for r in spark.sparkContext.runJob(piece, list, [k]):
                digest, done, last = Sha256(bytes(r["state"])), done + r["n"], r["at"]
        if done + 1 == size:  # a newline at the very end starts no line
            digest.update(b"\n")
            done += 1
        if done == size:
            return digest.hexdigest()
    raise RuntimeError(f"{path} was not read byte for byte: {size} bytes in its listing, {done} read")


def _hash_lines(state: bytes, last: int | None):
    """Arrow batches of (line, at) -> one row (state, n, at): the digest after them, their bytes, where their split starts.

    A line has the newline before it, but the file's first one (``last`` is None) stands for none.
    """
    def run(batches):
        digest, n, at = Sha256(state), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = batch.column("at").to_numpy()
            if starts[0] < (at or 0) or (np.diff(starts) < 0).any() or (at is None and last is not None and starts[0] <= last):
                raise RuntimeError(f"pieces of a file out of order: {starts.min()} after {last if at is None else at}")
            line = batch.column("line")
            ends = np.frombuffer(line.buffers()[1], np.int64 if pa.types.is_large_binary(line.type) else np.int32)
            first, past = int(ends[line.offset]), int(ends[line.offset + len(line)])
            first += at is None and last is None
            digest.update_at(line.buffers()[2].address + first, past - first)
            n, at = n + past - first, int(starts[-1])
        if at is not None:
            yield pa.RecordBatch.from_pydict({"state": pa.array([digest.state()], pa.binary()), "n": pa.array([n], pa.int64()), "at": pa.array([at], pa.int64())})

    return run


def table_integrity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A2 report row: file name, size, sha256, rows, columns."""
    df = read_table(spark, sf_dir, name)
    rows = df.select(F.count(F.lit(1))).scalar()  # scalar subquery, not a join
    info = file_integrity(spark, table_path(sf_dir, name))
    return info.select("file_name", "size_bytes", "sha256", rows.cast("long").alias("row_count"),
                       F.lit(len(df.columns)).cast("long").alias("column_count"))


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A3: manifest / prediction CSVs with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_prepared(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: one parquet dataset partitioned by ``split`` (array feature columns kept)."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """A5: one split; the filter on the partition column prunes directories."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"Prepared data not found at {path}") from exc
    return df.where(F.col("split") == F.lit(split))


def read_development(spark: SparkSession, path: str) -> DataFrame:
    """Train + validation only; the test partition is never listed."""
    return spark.read.parquet(path).where(F.col("split").isin("train", "validation"))


def smoke_subset(df: DataFrame, id_col: str, n: int = 100, split_col: str = "split") -> DataFrame:
    """A10: first ``n`` rows (by id) of every split, as a top-k per split.

    ``row_number() <= n`` plans as a partial WindowGroupLimit before the shuffle,
    so each map task forwards at most ``n`` rows per split (three small groups).
    """
    from pyspark.sql import Window
    w = Window.partitionBy(split_col).orderBy(F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def write_report(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """One sink for every report table."""
    path = os.path.join(root, name)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_metadata(spark: SparkSession, root: str, name: str, meta: dict) -> str:
    """A one-row JSON document (shas, seeds, dimensions, class weights)."""
    path = os.path.join(root, name)
    spark.createDataFrame([(json.dumps(meta, sort_keys=True, default=str),)], "doc string") \
        .write.mode("overwrite").text(path)
    return path


def save_model(model, path: str) -> str:
    """Persist a fitted MLlib model / pipeline."""
    model.write().overwrite().save(path)
    return path
