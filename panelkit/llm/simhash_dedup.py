"""SimHash near-duplicates through the generalised pigeonhole principle.

A fingerprint bit is 1 when over half of the shingle hashes (XXH64, seed 42) have it.  Distinct
fingerprints are searched for partners within ``distance`` bits: the 64 bits are dealt to parts, bits
that correlate into the same part; if a query allows t_i differing bits in part i (-1: the part is not
probed) and the sum of t_i + 1 is distance + 1, every partner agrees within t_i in some part i.  Each
query's thresholds come from a dynamic programme over the numbers of candidates that the value counts
of its parts promise, so crowded values are avoided and rare ones probed wider.  All candidates are
verified on the whole fingerprint, and no partner can be missed.

Null and blank texts have fingerprint zero, linked like any other.  Repeated rows share a
fingerprint; rows with a null id keep a null id, order before all others and name their component
null.  Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import NULL_ORDER, fresh_name, materialise, order_key, sliced
from panelkit.llm.components import components

SHINGLE, DISTANCE, PARTS = 3, 3, 4
#: a probe counts as so many candidates when thresholds are chosen
PROBE_COST = 1.0
_CHUNK_BYTES = 4 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, 42) for x in runs], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash long, fp long): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, _CHUNK_BYTES):
            fp = np.array([fingerprint(x, shingle) for x in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(prints: DataFrame, parts: int) -> list[list[int]]:
    """Deal the 64 bits into ``parts`` equal parts, correlated bits together (greedy on |correlation|).
    The 64 x 64 counts of common ones are summed over all fingerprints."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        if n:
            i, j = np.triu_indices(64)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i, 64).astype(np.int32)), pa.array(np.append(j, 64).astype(np.int32)),
                                              pa.array(np.append(total[i, j], n))], names=["i", "j", "n"])

    rows = prints.select("fp").mapInArrow(common, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, count = np.zeros((64, 64)), 1
    for r in rows:
        if r["i"] == 64:
            count = r["n"]
        else:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    mean = np.diag(both) / count
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    likeness = np.abs((both / count - np.outer(mean, mean)) / np.outer(spread, spread))
    free, out = list(range(64)), []
    for k in range(parts):
        size = (64 * (k + 1)) // parts - (64 * k) // parts
        rest = likeness[np.ix_(free, free)] - np.eye(len(free))
        part = [free.pop(int(rest.max(axis=1).argmax()))]
        while len(part) < size:
            part.append(free.pop(int(likeness[np.ix_(part, free)].mean(axis=0).argmax())))
        out.append(sorted(part))
    return out


def part_values(fp: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    """(parts, n): each part's bits as a number."""
    bits = _bits(fp).astype(np.int64)
    return np.stack([(bits[:, p] << np.arange(len(p))).sum(axis=1) for p in parts])


def masks(width: int, most: int) -> list[np.ndarray]:
    """Masks with exactly 0, 1, ... ``most`` of ``width`` bits set."""
    return [np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), k)], np.int64) for k in range(most + 1)]


def promised(counts: list[np.ndarray], distance: int) -> list[np.ndarray]:
    """For each part (distance + 1, 2 ** width): fingerprints whose value is within t bits, t = 0 ... distance, and the probes."""
    out = []
    for count in counts:
        width = int(len(count)).bit_length() - 1
        at, rows, seen = np.arange(len(count)), [], 0
        for ring in masks(width, distance):
            seen = seen + sum((count[at ^ m] for m in ring), np.zeros(len(count)))
            rows.append(seen)
        probes = np.cumsum([len(r) for r in masks(width, distance)])
        out.append(np.stack(rows) + PROBE_COST * probes[:, None])
    return out


def thresholds(costs: list[np.ndarray], values: np.ndarray, distance: int) -> np.ndarray:
    """(parts, n) thresholds from -1 to ``distance`` of least promised cost whose sum of t + 1 is distance + 1."""
    n, budget = values.shape[1], distance + 1
    best = np.full((budget + 1, n), np.inf)
    best[0] = 0
    steps = []
    for cost, value in zip(costs, values):
        new, chosen = np.full_like(best, np.inf), np.zeros((budget + 1, n), np.int8)
        for spent in range(budget + 1):
            for use in range(spent + 1):
                total = best[spent - use] + (cost[use - 1][value] if use else 0)
                better = total < new[spent]
                new[spent][better], chosen[spent][better] = total[better], use
        best, steps = new, [*steps, chosen]
    out, left = np.zeros((len(costs), n), np.int64), np.full(n, budget)
    for k in range(len(costs) - 1, -1, -1):
        use = steps[k][left, np.arange(n)].astype(np.int64)
        out[k], left = use - 1, left - use
    return out


def link(prints: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """(a, b): all pairs of different fingerprints (column fp, distinct) at most ``distance`` bits apart, a < b."""
    dealt = correlated_parts(prints, parts)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            if len(fp):
                values = part_values(fp, dealt)
                yield pa.RecordBatch.from_arrays([pa.array(((np.arange(len(dealt))[:, None] << 32) | values).ravel()), pa.array(np.tile(fp, len(dealt)))],
                                                 names=["bucket", "b"])

    entries = prints.select("fp").mapInArrow(index, "bucket long, b long")
    counts = [np.zeros(1 << len(p), np.int64) for p in dealt]
    for r in entries.groupBy("bucket").count().toLocalIterator():  # at most the sum of 2 ** width numbers
        counts[r["bucket"] >> 32][r["bucket"] & 0xFFFFFFFF] = r["count"]
    costs = prints.sparkSession.sparkContext.broadcast(promised(counts, distance))
    rings = [masks(len(p), distance) for p in dealt]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in range(0, batch.num_rows, 4096):
                fp = batch.column(0).to_numpy()[piece:piece + 4096]
                values = part_values(fp, dealt)
                allowed = thresholds(costs.value, values, distance)
                for k, ring in enumerate(rings):
                    for t in range(distance + 1):
                        near = np.flatnonzero(allowed[k] >= t)
                        if len(near):
                            keys = (k << 32) | (values[k][near][:, None] ^ ring[t][None, :])
                            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fp[near], len(ring[t])))], names=["bucket", "a"])

    probes = prints.select("fp").mapInArrow(probe, "bucket long, a long")
    near = probes.join(entries, "bucket").where(f"a < b and bit_count(a ^ b) <= {distance}")
    return near.select("a", "b").distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, least struct<id, text_hash>): the least row of each row's group; a null id counts as ``NULL_ORDER``."""
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "prints")
    row = F.struct(order_key("doc_id").alias("id"), "text_hash")
    nodes = materialise(prints.groupBy("fp").agg(F.min(row).alias("least")), "nodes")
    labels = components(link(nodes, distance, parts)).withColumnRenamed("node", "fp")
    named = materialise(nodes.join(labels, "fp", "left").selectExpr("fp", "least", "coalesce(label, fp) as label"), "named")
    lowest = materialise(named.groupBy("label").agg(F.min("least").alias("least")), "lowest")
    of = materialise(named.select("fp", "label").join(lowest, "label").select("fp", "least"), "of")
    return prints.join(of, "fp")


def cluster(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the least id reachable over links, one row per document."""
    return groups(docs, shingle, distance, parts, id_col, text_col).selectExpr("doc_id", "fp", f"nullif(least.id, {NULL_ORDER + 1}L - 1L) as component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group: that of the least id (then of the least
    text hash; of rows equal in both, one).  All columns stay."""
    key, mark = fresh_name(docs, "__id"), fresh_name(docs, "__text")
    chosen = (groups(docs, shingle, distance, parts, id_col, text_col).where("least.id = coalesce(doc_id, least.id) and least.text_hash = text_hash")
              .select(F.col("least.id").alias(key), F.col("text_hash").alias(mark)).distinct())
    kept = docs.withColumns({key: order_key(id_col), mark: F.xxhash64(text_col)}).join(materialise(chosen, "chosen"), [key, mark], "left_semi")
    return kept.dropDuplicates([key, mark]).drop(key, mark)
