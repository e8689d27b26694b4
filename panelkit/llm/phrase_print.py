"""Fingerprints by locally consistent parsing.

Each level turns a sequence of names into phrases.  Runs of one name collapse first; then
deterministic coin tossing (the lowest bit in which a name differs from the one before, with its
value, again and again) shrinks names to six and then three colours, and a phrase starts at every
local maximum of the colours.  A landmark depends on a few neighbours only, so equal substrings get
equal phrases inside, whatever their offset.  Phrases are named by a hash of the names in them.

The fingerprint is a one-permutation min-hash sketch of the names of levels 3 to 5 (phrases of about
20, 55 and 150 characters) and of a sixteenth and a quarter, chosen by their own hash, of the names of levels 1 and 2, which
short texts have in plenty; the rule is the same at every length: 64 slots of 16 bits as hex, 0000 for an empty slot.  Likeness is the share of equal slots among those that either print fills.

An empty or null text has no phrase: all slots are empty, it is like another empty text (1) and
unlike any other (0).  Documents with a null id come after all others in descending order; ties on
the id are taken in ascending order of their text.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import mix64, range_bounds, shuffle_parts, sliced

SLOTS, LAST_LEVEL = 64, 5
#: of the names of these levels one in so many counts
THINNED = {1: 16, 2: 4}
#: code points worked on at a time
CHUNK_CHARS = 1 << 18
_EDGE = 7  # colour of "no neighbour"
_SEED, _MULT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def _toss_table() -> np.ndarray:
    """(own label, label before) -> twice the lowest differing bit, plus the own label's bit there."""
    own, other = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = own ^ other
    low = np.where(differ > 0, np.log2(np.maximum(differ & -differ, 1)).astype(int), 0)
    return (2 * low + (own >> low & 1)).astype(np.uint8).ravel()


@functools.cache
def _free_table() -> np.ndarray:
    """(left colour, right colour) -> least of 0, 1, 2 that neither has."""
    return np.array([[next(c for c in range(3) if c not in (a, b)) for b in range(8)] for a in range(8)], np.uint8).ravel()


def colours(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three-colouring of names; neighbours in one document must differ.  ``first``: places where documents start."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[first] = ~names[first]
    differ = names ^ before
    low = differ & (~differ + np.uint64(1))
    bit = (low.astype(np.float64).view(np.int64) >> 52) - 1023
    label = (2 * bit + ((names >> bit.astype(np.uint64)) & np.uint64(1)).astype(np.int64)).astype(np.uint8)
    table = _toss_table()
    for _ in range(3):  # 128 labels, 14, 8, 6
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[first] = label[first] ^ 1
        label = table.take((label.astype(np.int16) << 7) | left)
    free = _free_table()
    padded = np.empty(len(label) + 2, np.uint8)
    start = np.zeros(len(label) + 1, bool)
    start[first], start[-1] = True, True
    for colour in (5, 4, 3):
        at = np.flatnonzero(label == colour)
        padded[1:-1], padded[0], padded[-1] = label, _EDGE, _EDGE
        left = np.where(start[at], _EDGE, padded[at])
        right = np.where(start[at + 1], _EDGE, padded[at + 2])
        label[at] = free.take(left.astype(np.int16) * 8 + right)
    return label


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases, and where documents start among them."""
    n = len(names)
    start = np.zeros(n + 1, bool)
    start[first], start[n] = True, True
    head = start[:-1].copy()
    head[1:] |= names[1:] != names[:-1]
    if not head.all():  # a run counts as one name
        at = np.flatnonzero(head)
        run = np.diff(np.append(at, n))
        names = names[at]
        names[run > 1] = mix64(names[run > 1] ^ mix64(run[run > 1].astype(np.uint64) * _SEED))
        first = np.searchsorted(at, first)
        n = len(names)
        start = np.zeros(n + 1, bool)
        start[first], start[n] = True, True
    label = colours(names, first).astype(np.int8)
    left, right = np.full(n, -1, np.int8), np.full(n, -1, np.int8)
    left[1:], right[:-1] = label[:-1], label[1:]
    left[first] = -1
    right[np.flatnonzero(start[1:])] = -1
    peak = (label > left) & (label > right)
    second = first + 1
    peak[second[(second < n) & ~start[np.minimum(second, n)]]] = False  # so that two names make one phrase
    peak |= start[:-1]
    at = np.flatnonzero(peak)
    length = np.diff(np.append(at, n))
    out = mix64(names[at] + _SEED)
    more = np.arange(len(at))
    k = 1
    while len(more := more[length[more] > k]):
        out[more] = mix64(out[more] * _MULT + names[at[more] + k])
        k += 1
    return out, np.searchsorted(at, first)


def prints(texts: list[str]) -> np.ndarray:
    """(len(texts), SLOTS) uint16 sketches; 0 marks an empty slot."""
    best = np.full(len(texts) * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    length = np.array([len(t) for t in texts], np.int64)
    docs = np.flatnonzero(length)
    if len(docs):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        names, first = mix64(points.astype(np.uint64) + _SEED), np.concatenate(([0], np.cumsum(length[docs])[:-1]))
        for level in range(1, LAST_LEVEL + 1):
            names, first = parse(names, first)
            own = np.repeat(docs, np.diff(np.append(first, len(names))))
            key = mix64(names ^ _MULT)
            if level in THINNED:
                keep = key % np.uint64(THINNED[level]) == 0
                own, key = own[keep], mix64(key[keep])
            np.minimum.at(best, own * SLOTS + (key >> np.uint64(58)).astype(np.int64), key & np.uint64((1 << 58) - 1))
    slot = ((best >> np.uint64(8)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return np.where(best == np.iinfo(np.uint64).max, 0, slot).astype(np.uint16).reshape(len(texts), SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; two empty texts are alike."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def to_hex(rows: np.ndarray) -> list[str]:
    data = rows.astype(">u2").tobytes().hex()
    width = SLOTS * 4
    return [data[i:i + width] for i in range(0, len(data), width)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNK_CHARS):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(to_hex(prints(texts)))],
                                             names=["doc_id", "n_chars", "fingerprint"])

    source = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    return source.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples; only a slice of a batch is held as Python strings, which take up to four bytes a character."""
    for piece in sliced(batches, CHUNK_CHARS):
        yield from zip(*(column.to_pylist() for column in piece.columns))


def splice(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SPLICED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_spliced(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text spliced with the next document's (descending id; the
    last is followed by the first), with both likenesses.

    Rows are dealt to ranges of the id whose upper bounds are existing ids, so the document that
    follows a range is the first of the range below: those few rows are sent to both.  A range is a
    partition of its own; rows that repeat an id share one.
    """
    parts = shuffle_parts(docs.sparkSession)
    source = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"coalesce(`{text_col}`, '') as text")
    bounds = range_bounds(source, "doc_id", parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pc.fill_null(batch.column(0), -(1 << 63)).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, key)
            head = (np.isin(key, bounds) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)) if len(bounds) else np.zeros(len(key), bool)
            at = pa.array(np.concatenate((np.arange(len(key)), np.flatnonzero(head))))
            part = np.concatenate((part, (part[head] + 1) % max(1, len(bounds))))
            extra = np.concatenate((np.zeros(len(key), bool), np.ones(int(head.sum()), bool)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(part.astype(np.int32)), pa.array(extra)],
                                             names=["doc_id", "text", "part", "extra"])

    def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last text, which only follows."""
        edited = [splice(a, b) for a, b in zip(texts, texts[1:])]
        both = prints(texts + edited)
        own, after, cut = both[:len(texts) - 1], both[1:len(texts)], both[len(texts):]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
             pa.array(to_hex(own)), pa.array(to_hex(cut)), pa.array(likeness(own, cut)), pa.array(likeness(own, after))],
            names=[x.split()[0] for x in _SPLICED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, done, ids, texts, chars = None, None, False, [], [], 0
        for doc, text, at, extra in rows_of(batches):
            if at != part:
                if texts:
                    yield compare(ids, [*texts, head])
                part, head, done, ids, texts, chars = at, text, False, [], [], 0
            if extra:
                if not done and texts:
                    yield compare(ids, [*texts, text])
                done, ids, texts = True, [], []
                continue
            ids.append(doc)
            texts.append(text)
            chars += len(text)
            if chars > CHUNK_CHARS and len(texts) > 1:
                yield compare(ids[:-1], texts)
                ids, texts, chars = ids[-1:], texts[-1:], len(texts[-1])
        if texts:
            yield compare(ids, [*texts, head])

    return (source.mapInArrow(deal, "doc_id long, text string, part int, extra boolean").repartitionById(parts, "part")
            .sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "text").mapInArrow(run, _SPLICED))
