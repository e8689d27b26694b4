"""Token ids in fixed-width bit-packed blocks.

File format: a folder of Parquet files whose rows are blocks.  A block holds the ids of consecutive
whole documents, each id in the least number of bits that the vocabulary needs, packed from the least
significant bit on.  ``first`` is the number of ids before the block in its shard, ``doc_ids`` and
``doc_n`` say which documents it holds and how many ids each has, so numpy unpacks a block in one go
and any document or position is found from the block offsets alone.  Shards are ascending ranges of
document ids; rows in a shard ascend too, null ids first.

Null texts count as empty; a document with no ids still gets the end id.  Repeated document ids are
kept as separate documents.  An empty table makes no block.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.byte_bpe import CHUNK_BYTES, PieceEncoder
from panelkit.llm.common import range_bounds, shuffle_parts, sliced, texts_of

#: a block is closed once it has so many ids
BLOCK_IDS = 1 << 17
_PACKED = "doc_id long, n long, packed binary, shard int"
_BLOCKS = "shard int, block long, first long, n_ids long, bits int, doc_ids array<long>, doc_n array<long>, payload binary"


def width(vocabulary: int) -> int:
    """Bits that the largest id needs."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits an id, least significant first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """Ids ``start`` to ``start + n``; only their bytes are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, start * bits // 8).astype(np.uint32)
    a, b = start * bits, (start + n) * bits
    flat = np.unpackbits(np.frombuffer(payload, np.uint8)[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + n * bits]
    return (flat.reshape(n, bits).astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


@functools.cache
def library_encoder(path: str):
    """The tokenizers library's ids of texts, by cached pieces, and its vocabulary size.  A text that holds one of the file's added
    tokens goes through the library as a whole, which gives that token its own id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content]

    def encode(pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    by_pieces = PieceEncoder(encode)

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        whole = {k for a in added for k, t in enumerate(texts) if a in t}
        out = by_pieces([t if k not in whole else "" for k, t in enumerate(texts)] if whole else texts)
        return [np.array(encode([texts[k]])[0], "<u4") if k in whole else x for k, x in enumerate(out)] if whole else out

    return ids_of, tokenizer.get_vocab_size()


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the blocks in ascending document order."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    source = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    bounds = range_bounds(source, "doc_id", parts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = library_encoder(tokenizer_path)
        bits, end = width(max(size, end_id + 1)), np.array([end_id], np.uint32)
        for batch in sliced(batches, CHUNK_BYTES):
            ids = [np.concatenate((x, end)) for x in encoder(texts_of(batch))]
            key = pc.fill_null(batch.column(0), -(1 << 63)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([pack(x, bits) for x in ids], pa.binary()),
                 pa.array(np.searchsorted(bounds, key).astype(np.int32))], names=["doc_id", "n", "packed", "shard"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, size = library_encoder(tokenizer_path)
        bits = width(max(size, end_id + 1))
        shard, number, first, held, count = None, 0, 0, [], 0

        def closed():
            ids = np.concatenate([unpack(p, bits, n) for _, n, p in held])
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": number, "first": first, "n_ids": count, "bits": bits, "doc_ids": [d for d, _, _ in held],
                "doc_n": [n for _, n, _ in held], "payload": pack(ids, bits)}], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("doc_n", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for doc, n, packed, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and (at != shard or count >= BLOCK_IDS):
                    yield closed()
                    number, first, held, count = number + 1, first + count, [], 0
                if at != shard:
                    shard, number, first = at, 0, 0
                held.append((doc, n, packed))
                count += n
        if held:
            yield closed()

    (source.mapInArrow(encode, _PACKED).repartitionById(parts, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n", "packed")
     .mapInArrow(blocks, _BLOCKS).write.option("compression", "zstd").parquet(path))


def shard_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each shard; one number for each shard comes to the driver."""
    totals = sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    out, at = {}, 0
    for shard, n in totals:
        out[shard], at = at, at + n
    return out


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: (doc_id, start, n_tokens, ids array<int>), ids as stored."""
    return _per_document(spark, path, "ids array<int>", lambda ids: ids.astype(np.int32), pa.list_(pa.int32()))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: (doc_id, start, n_tokens, ids_crc32)."""
    return _per_document(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _per_document(spark: SparkSession, path: str, column: str, of, kind: pa.DataType) -> DataFrame:
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    before = shard_starts(blocks)
    names = ["doc_id", "start", "n_tokens", column.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(row["doc_n"])
                starts = np.concatenate(([0], ends[:-1]))
                ids = unpack(row["payload"], row["bits"], row["n_ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + before[row["shard"]] + row["first"], pa.int64()),
                     pa.array(row["doc_n"], pa.int64()), pa.array([of(ids[a:b]) for a, b in zip(starts, ends)], kind)], names=names)

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, " + column)


def ids_at(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Random access: ids ``start:stop`` of the whole corpus; reads only the blocks that hold them."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    before = shard_starts(blocks)
    order = sorted(before)
    after = {s: before[order[i + 1]] if i + 1 < len(order) else None for i, s in enumerate(order)}
    parts = []
    for shard in (s for s in order if before[s] < stop and (after[s] is None or after[s] > start)):
        a, b = max(0, start - before[shard]), stop - before[shard]
        rows = (blocks.where((F.col("shard") == shard) & (F.col("first") < b) & (F.col("first") + F.col("n_ids") > a))
                .select("first", "n_ids", "bits", "payload").orderBy("first").toLocalIterator())
        for row in rows:
            lo, hi = max(0, a - row["first"]), min(row["n_ids"], b - row["first"])
            parts.append(unpack(bytes(row["payload"]), row["bits"], hi - lo, lo))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
