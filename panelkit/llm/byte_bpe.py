"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regex.  Every code point gets a class (letter, number, white space, other);
one look ahead turns classes into the symbols of an eight-state automaton.  The transition function
of each symbol belongs to a small finite monoid, so composing functions is a table look-up that is
associative: a blocked prefix scan over numpy arrays gives the state before every character, and a
second look-up says where a piece starts.  Equal pieces of a batch are found by 128-bit hashes of their code
points, so each different slice is cut once and feeds pair merging with a bounded cache.

Texts that are null count as empty (no ids); rows that repeat are encoded each time.  Any columns but
the id and the text are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm.common import list_array, mix64, sliced, texts_of

#: bytes that a generation of the cache takes, entries and their overhead; each Python worker keeps two generations
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 110
#: bytes of text worked on at a time
CHUNK_BYTES = 2 << 20
#: pieces hashed at a time
HASHED = 1 << 16
#: longer pieces merge through a heap
HEAP_FROM = 40

LETTER, NUMBER, OTHER, SPACE, SPACE_END, BLANK_END, QUOTE2, QUOTE3, RESET = range(9)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_BLANK, TAIL1, TAIL2 = range(8)

# Letters and numbers of Unicode 16 that the interpreter's Unicode 15.1 doesn't know.
NEW_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
               (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
               (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
               (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
# The code points with the property White_Space.
WHITE_SPACE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))


@functools.cache
def code_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    kinds = np.array(kinds)
    table[kinds == "L"], table[kinds == "N"] = LETTER, NUMBER
    for kind, spans in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS), (SPACE, WHITE_SPACE)):
        for a, b in spans:
            table[a:b + 1] = kind
    return table


def _step(symbol: int, state: int) -> int:
    if symbol == LETTER:
        return {TAIL1: FRESH, TAIL2: TAIL1}.get(state, IN_LETTERS)
    if symbol in (QUOTE2, QUOTE3):
        return IN_OTHERS if state in (IN_OTHERS, AFTER_BLANK) else TAIL1 if symbol == QUOTE2 else TAIL2
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACE: IN_SPACES, BLANK_END: AFTER_BLANK}.get(symbol, FRESH)


def _starts(symbol: int, state: int) -> bool:
    inside = {LETTER: (IN_LETTERS, AFTER_BLANK, TAIL1, TAIL2), NUMBER: (IN_NUMBERS, AFTER_BLANK), SPACE: (IN_SPACES,),
              OTHER: (IN_OTHERS, AFTER_BLANK), QUOTE2: (IN_OTHERS, AFTER_BLANK), QUOTE3: (IN_OTHERS, AFTER_BLANK)}
    return state not in inside.get(symbol, ())


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]:
    """Element of each symbol, (then, first) -> composed element, element x state -> state, the
    identity, symbol x state -> whether a piece starts."""
    functions = {tuple(_step(x, s) for s in range(8)): None for x in range(9)} | {tuple(range(8)): None}
    grown = True
    while grown:
        known = list(functions)
        functions |= {tuple(g[s] for s in f): None for f in known for g in known}
        grown = len(functions) > len(known)
    number = {f: i for i, f in enumerate(functions)}
    assert len(number) <= 256
    size = len(number)
    product = np.zeros((256, size), np.uint8)
    for g, i in number.items():
        for f, j in number.items():
            product[i, j] = number[tuple(g[s] for s in f)]
    of = np.array([number[tuple(_step(x, s) for s in range(8))] for x in range(9)], np.uint8)
    start = np.array([[_starts(x, s) for s in range(8)] for x in range(9)], bool)
    return of, product, np.array(list(functions), np.uint8), number[tuple(range(8))], start


def scan(elements: np.ndarray) -> np.ndarray:
    """Inclusive prefix products of monoid elements, block by block."""
    _, product, _, identity, _ = monoid()
    size, n, block = product.shape[1], len(elements), 64
    table = product.ravel()
    if n <= block:
        out = elements.copy()
        for i in range(1, n):
            out[i] = product[elements[i], out[i - 1]]
        return out
    rows = -(-n // block)
    grid = np.full(rows * block, identity, np.uint8)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    for j in range(1, block):
        grid[j] = table.take(grid[j].astype(np.int32) * size + grid[j - 1])
    before = np.empty(rows, np.uint8)
    before[0], before[1:] = identity, scan(grid[-1])[:-1]
    for j in range(block):
        grid[j] = table.take(grid[j].astype(np.int32) * size + before)
    return np.ascontiguousarray(grid.T).ravel()[:n]


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Automaton symbols of code points; ``ends`` are the places of the one sentinel after each text."""
    kind = code_classes().take(points)
    kind[ends] = RESET
    follows = np.empty(len(kind), bool)
    follows[-1], follows[:-1] = False, kind[1:] <= OTHER
    last = (kind == SPACE) & follows
    kind[last] = np.where(points[last] == 0x20, BLANK_END, SPACE_END)
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        quotes = quotes[kind[quotes] == OTHER]
        padded = np.concatenate((points, np.zeros(2, points.dtype)))
        one, two = padded[quotes + 1], padded[quotes + 2]
        kind[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE2
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        kind[quotes[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]] = QUOTE3
    return kind


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces start; every sentinel is a piece of its own."""
    of, _, apply, _, start = monoid()
    kind = symbols(points, ends)
    state = np.empty(len(kind), np.uint8)
    state[0], state[1:] = FRESH, apply[:, FRESH].take(scan(of.take(kind))[:-1])
    return np.flatnonzero(start.ravel().take(kind.astype(np.int32) * 8 + state))


def cut_texts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All texts joined, each followed by one sentinel, their code points, where pieces start, and which pieces are sentinels."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts])) - 1
    at = piece_starts(points, ends)
    return joined, points, at, np.searchsorted(at, ends)


def split_texts(texts: list[str]) -> tuple[list[str], list[int]]:
    """Pieces of all texts, each text followed by one sentinel piece; places of the sentinels."""
    joined, _, at, marks = cut_texts(texts)
    cut = [*at.tolist(), len(joined)]
    return [joined[a:b] for a, b in zip(cut, cut[1:])], marks.tolist()


def piece_hashes(points: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each piece: two sums over its code points, each mixed with its place in the piece."""
    one, two = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    for k in range(0, len(at), HASHED):
        a, b = at[k:k + HASHED], ends[k:k + HASHED]
        place = np.arange(a[0], b[-1]) - np.repeat(a - 1, b - a)
        mixed = mix64((place.astype(np.uint64) << np.uint64(32)) | points[a[0]:b[-1]])
        one[k:k + HASHED] = np.add.reduceat(mixed, a - a[0])
        two[k:k + HASHED] = np.add.reduceat(mixed * mixed, a - a[0])
    return one, two


def different(points: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One piece of each content, and for every piece the place of its content among these."""
    one, two = piece_hashes(points, at, ends)
    order = np.argsort(one)
    one, two = one[order], two[order]
    new = np.ones(len(at), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    which = np.empty(len(at), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the adjacent pair of least rank joins first, the leftmost of equals."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) >= HEAP_FROM:
        return _merge_heap(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = sys.maxsize
    cost = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while cost:
        least = min(cost)
        if least == none:
            break
        i = cost.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del cost[i]
        if i < len(cost):
            cost[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            cost[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if part[i] is not None else -1
        if j < 0 or part[i] + part[j] != pair:
            continue
        part[i], part[j], after[i] = pair, None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else -1
            if b >= 0 and (r := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (r, a, part[a] + part[b]))
    return [ranks[p] for p in part if p is not None]


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.cache
def vocabulary(path: str) -> list[bytes]:
    """Bytes of each id (empty for ids without an entry)."""
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


class PieceEncoder:
    """Ids of pieces as little-endian uint32 bytes; ``encode`` maps new pieces to id lists.

    The cache has two generations: a full young one becomes the old one, and what is found in the old
    one moves back.  Memory is bounded and frequent pieces stay.
    """

    def __init__(self, encode, limit: int = CACHE_BYTES):
        self.encode, self.limit, self.young, self.old, self.size = encode, limit, {}, {}, 0

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        joined, points, at, marks = cut_texts(texts)
        ends = np.append(at[1:], len(points))
        some, which = different(points, at, ends)
        found = self.of([joined[a:b] for a, b in zip(at[some].tolist(), ends[some].tolist())])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        n = sizes[which]
        n[marks] = 0
        stop = np.cumsum(n)
        ids = flat[np.repeat(first[which] - (stop - n), n) + np.arange(stop[-1])]
        return np.split(ids, stop[marks][:-1])

    def of(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        found = list(map(self.young.get, pieces))
        if None in found:
            late = {p: self.old.get(p) for p, x in zip(pieces, found) if x is None}
            new = [p for p, x in late.items() if x is None]
            late |= {p: array("I", x).tobytes() for p, x in zip(new, self.encode(new))}
            found = [x if x is not None else late[p] for p, x in zip(pieces, found)]
            more = ENTRY_BYTES * len(late) + sum(map(len, late)) + sum(map(len, late.values()))
            if self.size + more > self.limit:
                self.old, self.young, self.size = self.young, {}, 0
            if more <= self.limit:  # a slice with more new pieces than a generation holds is not kept
                self.young.update(late)
                self.size += more
        return found


@functools.cache
def rank_encoder(path: str) -> PieceEncoder:
    ranks = load_ranks(path)
    return PieceEncoder(lambda pieces: [merge(p.encode("utf-8", "surrogatepass"), ranks) for p in pieces])


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = True) -> DataFrame:
    """(doc_id, ids array<int>[, offsets array<int>]): the ids of each whole text and, if asked for,
    the byte at which each id starts, so that any part of a text can be decoded alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks_path)
        width = np.array([len(t) for t in vocabulary(ranks_path)], np.int32)
        for batch in sliced(batches, CHUNK_BYTES):
            found = encoder(texts_of(batch))
            flat, ends = np.concatenate(found).astype(np.int32), np.cumsum([len(x) for x in found])
            columns = [batch.column(0), list_array(flat, ends, pa.int32())]
            if offsets:
                at = np.concatenate([np.concatenate(([0], np.cumsum(width[x])))[:-1] for x in found]).astype(np.int32)
                columns.append(list_array(at, ends, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets"][:len(columns)])

    source = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    return source.mapInArrow(run, "doc_id long, ids array<int>" + ", offsets array<int>" * offsets)


def decode_ids(ids: np.ndarray, ranks_path: str) -> bytes:
    return b"".join(map(vocabulary(ranks_path).__getitem__, ids.tolist()))


def decode_span(ids: np.ndarray, offsets: np.ndarray, start: int, stop: int, ranks_path: str) -> bytes:
    """Bytes ``start:stop`` of a text, decoding only the ids that hold them."""
    a = max(0, int(np.searchsorted(offsets, start, side="right")) - 1)
    b = int(np.searchsorted(offsets, stop, side="left"))
    if a >= b:
        return b""
    return decode_ids(ids[a:b], ranks_path)[start - int(offsets[a]):stop - int(offsets[a])]


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, bytes): the text of each row's ids."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            parts = [decode_ids(np.asarray(x.values), ranks_path) if x.is_valid else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
