"""What both substring operators share: minimiser runs, the filter of repeated minimisers, packed
strings dealt to buckets, and the way back from resolved strings to spans of documents.

A document is a sequence of units (bytes or words).  Of the hashes of the ``gram``-unit substrings in
a window, the least (the leftmost of equals) is the window's minimiser.  Consecutive windows with the
same minimiser form a run, packed as one string of run + window - 1 units, so two equal windows meet
in the bucket of their common minimiser.

1. Every minimiser is counted over all rows (packed arrays, one group for each slot of the hash
   range).  Minimisers seen once cannot belong to a repeated window; those with ``HOT`` different strings
   or more are split.  Both facts go to the tasks as bit arrays of fixed size (``FILTER_BITS``, ``CORE_BITS``,
   ``HOT_BITS``, whatever the input): a clash only lets through a run that turns out not to be repeated.
2. A run of a hot minimiser is cut into parts by where its windows stand around the minimiser.  The
   units that all windows of a part share, most of a window, are its core; cores are counted like the
   minimisers before them, so a part whose core is seen once goes no further.
3. Runs and parts that pass are strings, keyed by minimiser or core; a part of a hot core goes as single
   windows, keyed by a hash of the window itself, so its groups fall apart.  Equal strings of a task are
   aggregated before they are dealt to buckets.  A key that repeats with one string only needs no text
   in its bucket: its string goes as a mark, length and digest.  The counts compare 32 bits of a hash;
   if a bucket sees marks of two strings with one key, that key is noted and the strings are sent again.
4. A bucket resolves each distinct string: for which of its windows does the content start first
   where.  Occurrences join the answers by the string's digest.

A string's digest is 128 bits: two polynomial hashes of its units and its length, from prefix sums over a whole slice,
so a string is only cut out of its text where a bucket needs to see it.  Strings are short (less than two
windows and a few units), too short for inputs that such hashes can't tell apart by their form.

Texts longer than a slice are a slice of their own; a task's arrays take about 150 bytes for each unit of a slice.

Rows are known by (id, 64-bit hash of the text): repeated rows get the same spans, rows with the same
id and other texts their own.  Null ids come before all others; null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import free_shuffles, materialise, mix64, order_key, raw_bytes, shuffle_parts, sliced

#: sizes of the bit arrays for minimisers and for cores (half as many say which keys are varied)
FILTER_BITS, CORE_BITS, HOT_BITS, HOT = 1 << 27, 1 << 24, 1 << 22, 3000
#: bytes of text scanned at a time
CHUNK_BYTES = 2 << 20
#: units whose grams are hashed at a time: these arrays stay in a core's cache
SCAN_UNITS = 1 << 15
#: bytes of strings that a bucket task resolves at a time
RESOLVE_BYTES = 1 << 18
#: rows of strings and bytes of their text that a map task holds before it sends them
HELD_ROWS, HELD_BYTES = 400_000, 16 << 20
#: rows that a bucket task answers at a time, if their strings don't fill ``size_limit`` before
ANSWERED_ROWS = 200_000
_MULT, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
RUNS = "array<struct<first:int,last:int,id:long,pos:long>>"


class Units(NamedTuple):
    """Units of some documents: a hash of each, where documents start (n_docs + 1), and the canonical bytes of units a to b."""
    hashes: np.ndarray
    at: np.ndarray
    cut: Callable[[int, int], bytes]


def byte_units(column: pa.Array) -> Units:
    data, at = raw_bytes(column)
    raw = data.tobytes()
    return Units(data.astype(np.uint64) + np.uint64(1), at, lambda a, b: raw[a:b])


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int, step: int = 1 << 10) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64; nothing is kept between calls."""
    def run(of: int, size: int) -> np.ndarray:
        steps = np.full(size, of % (1 << 64), np.uint64)
        steps[:1] = 1
        return np.multiply.accumulate(steps)

    return (run(pow(base, step, 1 << 64), -(-n // step))[:, None] * run(base, min(n, step))[None]).ravel()[:n]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and where documents start among them; no word crosses documents."""
    n = len(data)
    word = np.zeros(n + 1, bool)
    word[:n] = ~_BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], word[:-1]))
    starts = np.flatnonzero(word & (~before | edge))
    ends = np.flatnonzero(before & (~word | edge))
    return starts, ends, np.searchsorted(starts, at)


def word_units(column: pa.Array) -> Units:
    data, at = raw_bytes(column)
    starts, ends, docs = word_spans(data, at)
    raw, base = data.tobytes(), int(_MULT)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(base, len(data)), out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * _powers(pow(base, -1, 1 << 64), len(data) + 1)[starts])

    def cut(a: int, b: int) -> bytes:
        return b" ".join(raw[starts[a]:ends[b - 1]].split())

    return Units(hashes, docs, cut)


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` units from each place on (the last places hold fewer; no window starts there)."""
    def power(k: int) -> np.uint64:
        return np.uint64(pow(int(_MULT), k, 1 << 64))

    def joined(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> np.ndarray:
        out = a * power(size_b)
        if size_a < len(out):
            out[:-size_a] += b[size_a:]
        return out

    done, size, part, width = None, 0, units, 1
    while gram:
        if gram & 1:
            done, size = (part, width) if done is None else (joined(done, part, size, width), size + width)
        gram >>= 1
        if gram:
            part, width = joined(part, part, width, width), 2 * width
    return mix64(done)


def runs(units: Units, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start of every run, and the hash and place of its minimiser."""
    n, none = len(units.hashes), np.zeros(0, np.int64)
    if n < window:
        return none, none, np.zeros(0, np.uint64), none
    starts, width = n - window + 1, window - gram + 1
    hashes, where = np.empty(n, np.uint64), np.empty(starts, np.int64)
    for a in range(0, starts, SCAN_UNITS):
        here = min(SCAN_UNITS, starts - a)
        block = gram_hashes(units.hashes[a:a + here + window - 1], gram)[:here + width - 1]
        hashes[a:a + len(block)] = block
        least = (block & ~_LOW) | np.arange(a, a + len(block), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[:size - width], least[width - size:])
        where[a:a + here] = least & _LOW
    begin, end = units.at[:-1], units.at[1:] - window + 1
    begin, end = begin[end > begin], end[end > begin]
    change = np.zeros(n + 1, np.int8)
    change[begin] += 1
    change[end] -= 1
    valid = np.cumsum(change, dtype=np.int8)[:len(where)].astype(bool)
    goes_on = valid[:-1] & valid[1:] & (where[:-1] == where[1:])
    head, tail = valid.copy(), valid.copy()
    head[1:] &= ~goes_on
    tail[:-1] &= ~goes_on
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    return first, last, hashes[where[first]], where[first]


def range_hashes(units: Units, begin: np.ndarray, end: np.ndarray, multiplier: np.uint64 = _MULT) -> np.ndarray:
    """A hash of the units from each ``begin`` to its ``end`` (exclusive), from prefix sums."""
    n, base = len(units.hashes), int(multiplier)
    total, powers = np.zeros(n + 1, np.uint64), _powers(base, min(n, SCAN_UNITS))
    for a in range(0, n, SCAN_UNITS):
        block = units.hashes[a:a + SCAN_UNITS]
        block = (block if multiplier == _MULT else mix64(block)) * powers[:len(block)] * np.uint64(pow(base, a, 1 << 64))
        np.add(np.cumsum(block), total[a], out=total[a + 1:a + 1 + len(block)])
    back, far = pow(base, -1, 1 << 64), pow(base, -1 << 10, 1 << 64)
    return mix64((total[end] - total[begin]) * _powers(far, (n >> 10) + 1)[begin >> 10] * _powers(back, 1 << 10)[begin & 1023])


def digests(units: Units, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits for each range of units, as rows of two numbers."""
    size = (end - begin).astype(np.uint64) * _SECOND
    return np.stack([mix64(range_hashes(units, begin, end) ^ size), mix64(range_hashes(units, begin, end, _SECOND) + size)], axis=1)


def cores(units: Units, first: np.ndarray, last: np.ndarray, place: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut into parts: first and last window start of each, and the hash of the units that all windows share
    that stand so far before the minimiser."""
    width = max(1, (window - gram + 1) // 5)
    low, high = (place - last) // width, (place - first) // width
    n = high - low + 1
    of = np.repeat(np.arange(len(n)), n)
    part = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    nearest = place[of] - width * part
    core = range_hashes(units, nearest, nearest - width + 1 + window)
    return np.maximum(first[of], nearest - width + 1), np.minimum(last[of], nearest), core


class Filter(NamedTuple):
    slots: int
    repeated: np.ndarray
    hot: np.ndarray
    varied: np.ndarray

    def _cell(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        hashes = mix64(hashes)  # minimisers are small in their high bits, cells must not be
        slot = ((hashes >> np.uint64(32)) * np.uint64(self.slots)) >> np.uint64(32)
        each = np.uint64(len(bits) * 8 // self.slots)
        return slot * each + (((hashes & _LOW) * each) >> np.uint64(32))

    def _test(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        cell = self._cell(bits, hashes)
        return (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(self._test(x, hashes) for x in (self.repeated, self.hot, self.varied))

    def note_varied(self, hashes: np.ndarray) -> None:
        cell = self._cell(self.varied, hashes)
        np.bitwise_or.at(self.varied, (cell >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8))


class Known(NamedTuple):
    """What is known of minimisers, and of the cores of hot ones."""
    minimisers: Filter
    cores: Filter


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(order_key(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def counted(docs: DataFrame, units_of, window: int, keyed, bits_in_all: int) -> Filter:
    """Bit arrays of the keys that occur twice or more, of those with ``HOT`` different strings or more,
    and of those with two or more.  ``keyed(units)`` gives first and last window start and key of the strings."""
    slots = shuffle_parts(docs.sparkSession)
    each, each_hot, each_varied = (-(-n // slots // 8) * 8 for n in (bits_in_all, HOT_BITS, bits_in_all // 2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4 * CHUNK_BYTES):
            found = []
            for piece in sliced([batch], CHUNK_BYTES):
                units = units_of(piece.column(0))
                first, last, hashes = keyed(units)
                found.append((hashes, range_hashes(units, first, last + window)))
            hashes, strings = (np.concatenate(x) for x in zip(*found))
            hashes = mix64(hashes)  # as in Filter
            slot = ((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
            # the slot, the low half of the key and half of the string's hash name a string
            pair = ((hashes & _LOW) << np.uint64(32)) | (strings >> np.uint64(32))
            order = np.lexsort((pair, slot))
            slot, pair = slot[order], pair[order]
            head = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (slot[1:] != slot[:-1])))) if len(pair) else np.zeros(0, np.int64)
            many = np.diff(np.append(head, len(pair))) > 1
            slot, pair = slot[head], pair[head]
            cut = np.searchsorted(slot, np.arange(slots + 1, dtype=np.uint64))
            rows = [(s, pair[a:b][~many[a:b]].tobytes(), pair[a:b][many[a:b]].tobytes()) for s, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))],
                                             names=["slot", "once", "many"])

    def bits(batch: pa.Table) -> pa.Table:
        once, many = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64) for c in ("once", "many"))
        pair = np.concatenate((once, many, many))  # what a task has seen twice or more counts as two
        pair.sort()
        value = pair >> np.uint64(32)
        head = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        n = np.diff(np.append(head, len(value)))
        strings = np.add.reduceat(np.concatenate(([True], pair[1:] != pair[:-1])), head)
        value = value[head]

        def marked(chosen: np.ndarray, size: int) -> bytes:
            out = np.zeros(size, np.uint8)
            out[((chosen * np.uint64(size)) >> np.uint64(32)).astype(np.int64)] = 1
            return np.packbits(out, bitorder="little").tobytes()

        return pa.table({"slot": batch.column("slot").slice(0, 1).combine_chunks(), "repeated": [marked(value[n > 1], each)], "hot": [marked(value[strings >= HOT], each_hot)],
                         "varied": [marked(value[strings > 1], each_varied)]},
                        schema=pa.schema([("slot", pa.int32()), ("repeated", pa.binary()), ("hot", pa.binary()), ("varied", pa.binary())]))

    rows = (docs.select("text").mapInArrow(count, "slot int, once binary, many binary")
            .groupBy("slot").applyInArrow(bits, "slot int, repeated binary, hot binary, varied binary"))
    out = Filter(slots, *(np.zeros(slots * n // 8, np.uint8) for n in (each, each_hot, each_varied)))
    for r in rows.toLocalIterator():  # 1.5 bits_in_all + HOT_BITS
        for name in ("repeated", "hot", "varied"):
            piece = np.frombuffer(r[name], np.uint8)
            getattr(out, name)[r["slot"] * len(piece):(r["slot"] + 1) * len(piece)] = piece
    return out


def repeated(docs: DataFrame, units_of, window: int, gram: int):
    """Counts of all minimisers, then of the cores of the hot ones, and the broadcast of the former."""
    minimisers = counted(docs, units_of, window, lambda units: runs(units, window, gram)[:3], FILTER_BITS)
    sent = docs.sparkSession.sparkContext.broadcast(minimisers)

    def hot_parts(units: Units):
        first, last, hashes, place = runs(units, window, gram)
        often, hot, _ = sent.value.of(hashes)
        return cores(units, *(x[often & hot] for x in (first, last, place)), window, gram)

    if not minimisers.hot.any():
        return Known(minimisers, Filter(1, *(np.zeros(1, np.uint8) for _ in range(3)))), sent
    return Known(minimisers, counted(docs, units_of, window, hot_parts, CORE_BITS)), sent


class Strings:
    """Strings of a slice, cut out of their texts only when asked for."""

    def __init__(self, units: Units, begin: np.ndarray, end: np.ndarray):
        self.units, self.begin, self.end = units, begin, end

    def __len__(self) -> int:
        return len(self.begin)

    def __iter__(self) -> Iterator[bytes]:
        return map(self.units.cut, self.begin.tolist(), self.end.tolist())

    def of(self, rows: np.ndarray) -> list[bytes]:
        return list(map(self.units.cut, self.begin[rows].tolist(), self.end[rows].tolist()))


def _packed(batch: pa.RecordBatch, units_of, window: int, gram: int, known: Known):
    """Key, string, row and unit at which it starts, last window, whether the key has more strings, and digest, of
    each run or part whose key repeats; hot parts window by window."""
    units = units_of(batch.column("text"))
    first, last, hashes, place = runs(units, window, gram)
    often, hot, varied = known.minimisers.of(hashes)
    split, often = often & hot, often & ~hot
    part_first, part_last, core = cores(units, first[split], last[split], place[split], window, gram)
    passes, hot, more = known.cores.of(core)
    first, last, hashes, varied = (np.concatenate((a[often], b[passes])) for a, b in ((first, part_first), (last, part_last), (hashes, core), (varied, more)))
    hot = np.concatenate((np.zeros(int(often.sum()), bool), hot[passes]))
    if hot.any():
        n = np.where(hot, last - first + 1, 1)
        alone = np.repeat(hot, n)
        step = np.arange(len(alone)) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(first, n) + np.where(alone, step, 0)
        last = np.where(alone, first, np.repeat(last, n))
        hashes, hot, varied = np.repeat(hashes, n), alone, np.repeat(varied, n)
    digest = digests(units, first, last + window)
    keys = np.where(hot, digest[:, 0], hashes).view(np.int64)
    doc = np.searchsorted(units.at, first, side="right") - 1
    return keys, Strings(units, first, last + window), doc, first - units.at[doc], last - first, varied, digest


def _binary(digest: np.ndarray) -> pa.Array:
    """Rows of two numbers as 16 bytes each."""
    ends = np.arange(len(digest) + 1, dtype=np.int32) * 16
    return pa.BinaryArray.from_buffers(pa.binary(), len(digest), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(digest))])


def _numbers(column: pa.Array) -> np.ndarray:
    """16 bytes each as rows of two numbers."""
    return raw_bytes(column)[0].view(np.uint64).reshape(-1, 2)


def _first(digest: np.ndarray, ids: np.ndarray, positions: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal digests, the row that starts first, and how many there are in all."""
    order = np.lexsort((positions, ids, digest[:, 0]))
    if not len(order):
        return order, counts
    half = digest[order, 0]
    same = half[1:] == half[:-1]
    if (same & (digest[order[1:], 1] != digest[order[:-1], 1])).any():  # halves of different strings agree: sort by the whole
        order = np.lexsort((positions, ids, digest[:, 1], digest[:, 0]))
        same = (digest[order[1:]] == digest[order[:-1]]).all(axis=1)
    head = np.flatnonzero(np.concatenate(([True], ~same)))
    return order[head], np.add.reduceat(counts[order], head)


def occurrences(docs: DataFrame, units_of, window: int, gram: int, known) -> DataFrame:
    """(digest, id, text_hash, pos): every packed string that may hold a repeated window, without the string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNK_BYTES):
            *_, doc, pos, _, _, digest = _packed(batch, units_of, window, gram, Known(*(k.value for k in known)))
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays([_binary(digest), batch.column("id").take(at), batch.column("text_hash").take(at), pa.array(pos)],
                                             names=["digest", "id", "text_hash", "pos"])

    return docs.select("id", "text_hash", "text").mapInArrow(run, "digest binary, id long, text_hash long, pos long")


_STRINGS = "key long, digest binary, last int, string binary, id long, pos long, n long"


def distinct_strings(docs: DataFrame, units_of, window: int, gram: int, known) -> DataFrame:
    """(key, digest, last, string, id, pos, n): a task's distinct strings with their last window, the first of their occurrences and
    how many there are; of those alone with their key no text.  A task sends a string once for every ``HELD_ROWS`` or ``HELD_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_rows, n_bytes = [], 0, 0

        def sent():
            key, digest, last, ids, pos, n = (np.concatenate(x) for x in list(zip(*held))[:6])
            strings = pa.concat_arrays([x[6] for x in held])
            best, n = _first(digest, ids, pos, n)
            for k in range(0, len(best), 50_000):
                part = best[k:k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(key[part]), _binary(digest[part]), pa.array(last[part].astype(np.int32)), strings.take(pa.array(part)),
                                                  pa.array(ids[part]), pa.array(pos[part]), pa.array(n[k:k + 50_000])], names=names)

        names = [c.split()[0] for c in _STRINGS.split(", ")]
        for batch in sliced(batches, CHUNK_BYTES):
            keys, strings, doc, pos, last, varied, digest = _packed(batch, units_of, window, gram, Known(*(k.value for k in known)))
            ids = batch.column("id").to_numpy(zero_copy_only=False)[doc]
            best, n = _first(digest, ids, pos, np.ones(len(keys), np.int64))
            told = varied[best]
            seen = np.full(len(best), -1)
            seen[told] = np.arange(int(told.sum()))
            texts = pa.array(strings.of(best[told]), pa.binary()).take(pa.array(seen, mask=~told))
            held.append((keys[best], digest[best], last[best], ids[best], pos[best], n, texts))
            n_rows, n_bytes = n_rows + len(best), n_bytes + texts.nbytes
            if n_rows >= HELD_ROWS or n_bytes >= HELD_BYTES:
                yield from sent()
                held, n_rows, n_bytes = [], 0, 0
        if held:
            yield from sent()

    return docs.select("id", "text").mapInArrow(run, _STRINGS)


def _runs_of(first: np.ndarray, last: np.ndarray, ids: np.ndarray, pos: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of runs, so many in each."""
    items = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(ids.astype(np.int64)), pa.array(pos.astype(np.int64))],
                                       names=["first", "last", "id", "pos"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), items)


def resolved(strings: DataFrame, resolve, size_limit: int) -> DataFrame:
    """(digest, runs): ``resolve(keys, strings, ids, positions, counts)``, called with about ``size_limit``
    bytes of strings and all strings of a key, gives for each distinct string the
    windows that repeat, as runs of windows with where their content starts first.  A string without its text is alone with its key: its windows
    all repeat if it has come twice.  If there are several such strings with one key, (key, null) says so."""
    parts = shuffle_parts(strings.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("id", pa.int64()), ("pos", pa.int64())]))

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            key, last, ids, pos, n = (table.column(c).to_numpy() for c in ("key", "last", "id", "pos", "n"))
            digest, text = _numbers(table.column("digest").chunk(0)), table.column("string").chunk(0)
            best, n = _first(digest, ids, pos, n)
            key, last, ids, pos, digest, text = key[best], last[best], ids[best], pos[best], digest[best], text.take(pa.array(best))
            alone = text.is_null().to_numpy(zero_copy_only=False)
            again = np.flatnonzero(alone & (n > 1))
            zeros = np.zeros(len(again), np.int64)
            yield pa.RecordBatch.from_arrays([_binary(digest[again]), _runs_of(zeros, last[again], ids[again], pos[again], np.ones(len(again), np.int64))], names=names)
            marked, several = np.unique(key[alone], return_counts=True)
            unclear = [int(k).to_bytes(8, signed=True) for k in marked[several > 1].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(unclear, pa.binary()), pa.nulls(len(unclear), kind)], names=names)
            told = np.flatnonzero(~alone)
            if len(told):
                answers = resolve(key[told], text.take(pa.array(told)).to_pylist(), ids[told], pos[told], n[told])
                full = [k for k, r in enumerate(answers) if r]
                yield pa.RecordBatch.from_arrays([_binary(digest[told[full]]), pa.array([answers[k] for k in full], kind)], names=names)

        names, held, size, n_rows = ["digest", "runs"], [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # up to the row that fills the measure, then on to the end of its key
                keys = batch.column(0).to_numpy()[at:]
                ends = np.cumsum(np.diff(raw_bytes(batch.column(3).slice(at))[1])) + size
                to = int(min(np.searchsorted(ends, size_limit), max(0, ANSWERED_ROWS - 1 - n_rows)))
                if to >= len(keys):
                    held.append(batch.slice(at))
                    size, n_rows = int(ends[-1]), n_rows + len(keys)
                    break
                end = to + int(np.searchsorted(keys[to:] != keys[to], True))
                held.append(batch.slice(at, end))
                if end < len(keys):
                    yield from done(pa.Table.from_batches(held))
                    held, size, n_rows = [], 0, 0
                else:  # the key may go on in the next batch
                    size, n_rows = int(ends[-1]), n_rows + len(keys)
                at += end
        if held:
            yield from done(pa.Table.from_batches(held))

    return strings.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, f"digest binary, runs {RUNS}")


def spans(docs: DataFrame, units_of, window: int, gram: int, resolve, removed: str,
          size_limit: int = RESOLVE_BYTES) -> DataFrame:
    """(id, text_hash, spans array<struct<a, b>>): units to remove, as window starts a to b (inclusive),
    of every row that loses any.  ``removed`` is the condition on (id, pos) of a window run in a
    document against (first_id, first_pos) of its first occurrence."""
    send = docs.sparkSession.sparkContext.broadcast
    counts, sent = repeated(docs, units_of, window, gram)
    known = sent, send(counts.cores)
    free_shuffles(docs.sparkSession)  # the counts are broadcast
    while True:
        answers = materialise(resolved(distinct_strings(docs, units_of, window, gram, known), resolve, size_limit), "resolved")
        unclear = [r["digest"] for r in answers.where("runs is null").select("digest").collect()]  # one of 2 ** 32 keys that repeat
        if not unclear:
            break
        for one in counts:
            one.note_varied(np.frombuffer(b"".join(unclear), ">u8").astype(np.uint64))
        known = tuple(map(send, counts))
    free_shuffles(docs.sparkSession)  # the answers are stored
    windows = (occurrences(docs, units_of, window, gram, known).join(answers, "digest").select("id", "text_hash", "pos", F.explode("runs").alias("r"))
               .selectExpr("id", "text_hash", "pos + r.first as pos", "pos + r.last as last", "r.id as first_id", "r.pos as first_pos").where(removed))
    return windows.groupBy("id", "text_hash").agg(F.collect_set(F.struct(F.col("pos").alias("a"), F.col("last").alias("b"))).alias("spans"))


def compressed(first_id: np.ndarray, first_pos: np.ndarray, wanted: np.ndarray) -> list[dict]:
    """Runs of one string's windows with consecutive first occurrences, only of ``wanted`` windows."""
    at = np.flatnonzero(wanted)
    if not len(at):
        return []
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(first_id[at]) != 0) | (np.diff(first_pos[at]) != 1)))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return [{"first": int(at[a]), "last": int(at[b]), "id": int(first_id[at[a]]), "pos": int(first_pos[at[a]])} for a, b in zip(head, tail)]


def covered(n: int, pieces: list, window: int) -> np.ndarray:
    """Which of n units some window of the pieces covers."""
    change = np.zeros(n + 1, np.int64)
    for p in pieces or ():
        change[p["a"]] += 1
        change[p["b"] + window] -= 1
    return np.cumsum(change)[:n] > 0
