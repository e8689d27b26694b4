"""Quality rules by repetition coverage.

For every text: how many characters of words stand inside word n-grams that occur twice or more in that
text, for several n, and inside lines that do.  Words become exact dictionary numbers, a number becomes
64 random bits, and the hash of an n-gram rolls from n - 1 to n by one multiplication and one addition on
whole arrays, so a slice of many documents costs one sort a length.  Windows with equal hashes are compared
word by word; where two differ (a clash of 64 bits), that length is counted anew from the words themselves,
so the counts are exact.

A text is kept if it passes the base rules (at least ``LEAST_WORDS`` words, at most ``MOST_REPEATED`` per
cent of them in repeated 3-word windows) and no coverage is above its limit in per cent of the characters
of words (``NGRAM_LIMITS``, ``LINE_LIMIT``).  Every comparison is between integers.

Words are ``[^\\x20\\x09-\\x0D]+``, characters are code points; lines are split at ``\\n`` and count only if
they hold a word.  Null and empty texts have no words and fail the base rules.  Rows are judged one by one: repeated
rows and ids get equal results, null ids stay null, ties can't occur, other columns are ignored, an empty table gives no rows.  A
very long text is one slice of its own; its arrays take about 150 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import mix64, raw_bytes, sliced
from panelkit.llm.substrings import word_spans

LEAST_WORDS, MOST_REPEATED, BASE_GRAM = 50, 50, 3
#: per cent of word characters that may stand in repeated n-grams of so many words
NGRAM_LIMITS = {5: 40, 6: 38, 7: 36, 8: 34, 9: 32, 10: 30}
#: per cent of word characters that may stand in lines equal to an earlier one
LINE_LIMIT = 30
#: characters counted as symbols
SYMBOLS = "#*$%&|<>"
#: bytes of text measured at a time
CHUNK_BYTES = 2 << 20
_ROLL = np.uint64(0x9E3779B97F4A7C15)


class Measures(NamedTuple):
    """For each text of a slice: counts, and word characters in repeated n-grams (a row for each length)."""
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    line_chars: np.ndarray
    n_repeat_words: np.ndarray
    gram_chars: np.ndarray


def _numbers(data: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact numbers of byte strings: ``data[inside]`` holds them one after another."""
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return strings.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _repeated(at: np.ndarray, hashes: np.ndarray, numbers: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Those of the windows of ``n`` words starting ``at`` that occur twice or more in their text."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    left, right = at[order[:-1][same]], at[order[1:][same]]
    equal = owner[left] == owner[right]
    for k in range(n):
        equal &= numbers[left + k] == numbers[right + k]
    if not equal.all():  # a clash of hashes: compare the windows themselves
        rows = np.stack([owner[at], *(numbers[at + k] for k in range(n))], axis=1)
        _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return at[count[which.ravel()] > 1]
    return np.union1d(left, right)


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words a window of ``n`` words that begins at one of ``starts`` covers."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def _lines(data: np.ndarray, at: np.ndarray, starts: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and the word characters in them."""
    n_docs = len(at) - 1
    ends = np.flatnonzero(data == 10)
    inside = data != 10
    edges = np.sort(np.concatenate((ends, at[1:])))  # a text's last line ends where the text does
    begin = np.concatenate(([0], edges[:-1]))
    doc = np.searchsorted(at[1:], edges, side="left")
    # a line that ends at an end of line begins after the one before; offsets into the bytes without ends of lines
    kept = np.concatenate(([0], np.cumsum(inside)))
    numbers = _numbers(data, inside, kept[edges] - kept[begin])
    words = np.searchsorted(starts, edges) - np.searchsorted(starts, begin)
    total = np.concatenate(([0], np.cumsum(chars)))
    line_chars = total[np.searchsorted(starts, edges)] - total[np.searchsorted(starts, begin)]
    full = np.flatnonzero(words)
    order = full[np.lexsort((full, numbers[full], doc[full]))]
    again = np.zeros(len(order), bool)
    again[1:] = (numbers[order[1:]] == numbers[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    copies = order[again]
    return np.bincount(doc[copies], minlength=n_docs), np.bincount(doc[copies], line_chars[copies], n_docs).astype(np.int64)


def measure(text: pa.Array, lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> Measures:
    """Measures of every text of an Arrow string column."""
    data, at = raw_bytes(text)
    n_docs = len(at) - 1
    starts, ends, first = word_spans(data, at)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n_docs), n_words)
    size = len(starts)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
    chars = points[ends] - points[starts]
    word_chars = np.bincount(owner, chars, n_docs).astype(np.int64)

    symbol = np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8))
    symbols = np.concatenate(([0], np.cumsum(symbol)))
    n_symbols = symbols[at[1:]] - symbols[at[:-1]]

    # words by exact number, the hash of an n-gram rolling from one length to the next
    word = np.zeros(len(data) + 1, np.int8)
    word[starts] += 1
    word[ends] -= 1
    numbers = _numbers(data, np.cumsum(word[:-1], dtype=np.int8) > 0, ends - starts)
    values = mix64(numbers.astype(np.uint64) + np.uint64(1))
    rolled = mix64(owner.astype(np.uint64) + np.uint64(1 << 40))
    room = first[1:][owner] - np.arange(size)  # words from here to the end of the text
    n_repeat_words, gram_chars = np.zeros(n_docs, np.int64), np.zeros((len(lengths), n_docs), np.int64)
    candidates = np.arange(size)  # a longer window can only repeat where a shorter one does
    for n in range(1, max((BASE_GRAM, *lengths)) + 1):
        if size < n:
            break
        rolled = rolled[:size - n + 1] * _ROLL + values[n - 1:]
        if n != BASE_GRAM and n not in lengths:
            continue
        candidates = candidates[room[candidates] >= n]
        candidates = _repeated(candidates, rolled[candidates], numbers, owner, n)
        covered = _covered(candidates, n, size)
        if n == BASE_GRAM:
            n_repeat_words = np.bincount(owner[covered], minlength=n_docs)
        if n in lengths:
            gram_chars[lengths.index(n)] = np.bincount(owner[covered], chars[covered], n_docs)

    n_dup_lines, line_chars = _lines(data, at, starts, chars)
    return Measures(n_words, word_chars, n_symbols, n_dup_lines, line_chars, n_repeat_words, gram_chars)


def judge(docs: DataFrame, ngram_limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line_chars, gram_chars array<long>, base_failed,
    kept): ``gram_chars`` has the characters in repeated n-grams of each length of ``ngram_limits``, shortest first."""
    limits = dict(sorted((ngram_limits or NGRAM_LIMITS).items()))
    most = np.array(list(limits.values()), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNK_BYTES):
            m = measure(batch.column(1), tuple(limits))
            base_failed = (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)
            repeats = (100 * m.line_chars > line_limit * m.word_chars) | (100 * m.gram_chars > most[:, None] * m.word_chars).any(axis=0)
            grams = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(most)), pa.array(m.gram_chars.T.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x.astype(np.int64)) for x in (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.line_chars)),
                 grams, pa.array(base_failed), pa.array(~base_failed & ~repeats)], names=names)

    kinds = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_chars long, "
             "gram_chars array<long>, base_failed boolean, kept boolean")
    names = [x.split()[0] for x in kinds.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kinds)


def sql() -> str:
    """DuckDB: windows as consecutive word numbers, coverage by window frames, no hashes."""
    grams = "".join(f"""
  max(CASE WHEN n{n} > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n},""" for n in sorted({BASE_GRAM, *NGRAM_LIMITS}))
    counts = "".join(f"""
  CASE WHEN w{n - 1} IS NOT NULL THEN count(*) OVER (PARTITION BY r, {', '.join(f'w{k}' for k in range(n))}) ELSE 0 END AS n{n},""" for n in sorted({BASE_GRAM, *NGRAM_LIMITS}))
    after = ", ".join(f"lead(w0, {k}) OVER (PARTITION BY r ORDER BY p) AS w{k}" for k in range(1, max(BASE_GRAM, *NGRAM_LIMITS)))
    passes = " AND ".join(f"100 * g{n} <= {most} * word_chars" for n, most in NGRAM_LIMITS.items())
    sums = ", ".join(f"sum(c{n} * length(word)) AS g{n}" for n in NGRAM_LIMITS)
    nil = ", ".join(f"coalesce(g{n}, 0) AS g{n}" for n in NGRAM_LIMITS)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spots AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM docs),
numbers AS (SELECT word, row_number() OVER () AS w0 FROM (SELECT DISTINCT word FROM spots)),
windows AS (SELECT r, p, word, w0, {after} FROM spots JOIN numbers USING (word)),
counted AS (SELECT{counts} r, p, word FROM windows),
covered AS (SELECT{grams} r, word FROM counted),
grams AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(c{BASE_GRAM}) AS n_repeat_words, {sums} FROM covered GROUP BY r),
split AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (SELECT r, line, count(*) AS n, sum(length(x)) AS chars FROM (SELECT r, line, regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g') AS x FROM split) WHERE x <> '' GROUP BY r, line),
dup AS (SELECT r, sum(n - 1) AS n_dup_lines, sum(chars - chars // n) AS line_chars FROM lines GROUP BY r),
facts AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_chars, 0) AS line_chars, {nil}
          FROM docs LEFT JOIN grams USING (r) LEFT JOIN dup USING (r)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM facts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(line_chars AS BIGINT) AS line_chars, base_failed,
       NOT base_failed AND 100 * line_chars <= {LINE_LIMIT} * word_chars AND {passes} AS kept
FROM judged"""
