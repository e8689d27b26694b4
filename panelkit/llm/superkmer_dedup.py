"""Substring dedup over words by super-k-mer partitioning.

A window is 20 consecutive words of one document.  Consecutive windows that share a minimiser travel
as one packed string (words joined by one space) to the bucket of the minimiser, where sorting the
windows counts them exactly and finds where each starts first.  Every word covered by a window that
also starts earlier (smaller id, or the same document and an earlier start) is removed; windows are
judged on the input.  See ``substrings`` for the partitioning, hot minimisers and odd rows.

Null and empty texts have no words.  Documents with fewer than 20 words lose nothing.  Rows that
repeat an id and a text count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import substrings
from panelkit.llm.common import fresh_name, order_key, raw_bytes, sliced

WINDOW, GRAM = 20, 8


def resolver(window: int):
    def resolve(keys: np.ndarray, strings: list[bytes], ids: np.ndarray, positions: np.ndarray, counts: np.ndarray) -> list[list[dict]]:
        texts, owner, offset = [], [], []
        for i, s in enumerate(strings):
            words = s.split(b" ")
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends[:-1]]
            texts += [s[a:b - 1] for a, b in zip(starts, ends[window - 1:])]
            owner += [i] * (len(words) - window + 1)
            offset += range(len(words) - window + 1)
        order = np.array(sorted(range(len(texts)), key=texts.__getitem__))
        owner, offset = np.array(owner), np.array(offset)
        head = np.array([True, *(texts[a] != texts[b] for a, b in zip(order.tolist(), order[1:].tolist()))])
        at = np.flatnonzero(head)
        n = np.add.reduceat(counts[owner[order]], at)
        group = np.cumsum(head) - 1
        # the first occurrence in each group: least id, then least position
        start = positions[owner[order]] + offset[order]
        best = np.lexsort((start, ids[owner[order]], group))[at]
        out_n, out_id, out_pos = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        out_n[order], out_id[order], out_pos[order] = n[group], ids[owner[order]][best][group], start[best][group]
        cut = np.searchsorted(owner, np.arange(len(strings) + 1))
        return [substrings.compressed(out_id[a:b], out_pos[a:b], out_n[a:b] > 1) for a, b in zip(cut, cut[1:])]
    return resolve


def _cleaned(docs: DataFrame, window: int, gram: int, id_col: str, text_col: str) -> tuple[DataFrame, str, str, str]:
    key, mark, spans = (fresh_name(docs, x) for x in ("__id", "__text", "__spans"))
    removed = "first_id <> id or first_pos <> pos"
    found = substrings.spans(substrings.source(docs, id_col, text_col), substrings.word_units, window, gram, resolver(window), removed)
    found = found.select(F.col("id").alias(key), F.col("text_hash").alias(mark), F.col("spans").alias(spans))
    return docs.withColumns({key: order_key(id_col), mark: F.xxhash64(text_col)}).join(found, [key, mark], "left"), key, mark, spans


def _kept(raw: bytes, pieces: list | None, window: int) -> tuple[int, list[bytes]]:
    """How many words a text has, and those that no window of the pieces covers."""
    words = raw.split()
    gone = substrings.covered(len(words), pieces, window) if pieces else None
    return len(words), words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]


def remove(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words that stay, joined by one space."""
    joined, key, _, spans = _cleaned(docs, window, gram, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, substrings.CHUNK_BYTES):
            data, at = raw_bytes(batch.column(1))
            raw, rows = data.tobytes(), []
            for a, b, pieces in zip(at.tolist(), at[1:].tolist(), batch.column(2).to_pylist()):
                n, kept = _kept(raw[a:b], pieces, window)
                rows.append((n, n - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return (joined.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(spans).alias("spans"))
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string"))


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated words cut from the text (kept words joined by one space); texts that lose
    nothing stay as they are.  All rows and columns stay; ``n_chars``, if there, follows the text."""
    joined, _, _, spans = _cleaned(docs, window, gram, id_col, text_col)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for piece in sliced([pa.RecordBatch.from_arrays([texts, spans], names=["text", "spans"])], substrings.CHUNK_BYTES):
            data, at = raw_bytes(piece.column(0))
            raw = data.tobytes()
            # rows without spans come as null and stay null
            kept = [None if p is None else b" ".join(_kept(raw[a:b], p, window)[1]) for a, b, p in zip(at.tolist(), at[1:].tolist(), piece.column(1).to_pylist())]
            out.append(pa.array(kept, pa.binary()).view(pa.string()))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    # only texts that lose something go to Python
    kept = cut(F.when(F.col(spans).isNotNull(), F.col(text_col)), F.col(spans))
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(kept)
    out = joined.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(text_col)))
    return out.select(*docs.columns)
