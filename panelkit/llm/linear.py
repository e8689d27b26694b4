"""Hashed text features, page-metadata features and linear classifiers for the operators that need one.

Features are made in numpy for whole Arrow batches.  Fitting sees a bounded sample on the driver (the
callers state the bound); the weights have a fixed size and are broadcast for scoring.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from panelkit.llm.common import mix64, raw_bytes, texts_of
from panelkit.llm.substrings import _MULT, _powers

WORD_BITS = 18
WORDS = 1 << WORD_BITS
#: metadata features: bins of each measure, then hashed source and language
BINS, NAMES = 12, 64
MEASURES = 13
META = MEASURES * BINS + 2 * NAMES
#: documents that a word must occur in to count
LEAST_COUNT, SMOOTHING = 5, 20.0
#: features whose log ratios are all smaller count for nothing
INFORMATIVE = 0.5
CHUNK_BYTES = 2 << 20


def _classes() -> np.ndarray:
    """Byte classes: 0 upper, 1 lower, 2 digit, 3 blank, 4 line end, 5 of # $ % & *, 6 bar, 7 exclamation, 8 other ASCII, 9 beyond ASCII."""
    kind = np.full(256, 8, np.uint8)
    kind[ord("A"):ord("Z") + 1], kind[ord("a"):ord("z") + 1], kind[ord("0"):ord("9") + 1], kind[0x80:] = 0, 1, 2, 9
    kind[[0x20, 0x09]], kind[[0x0A, 0x0D]], kind[[ord(c) for c in "#$%&*"]], kind[ord("|")], kind[ord("!")] = 3, 4, 5, 6, 7
    return kind


_KIND = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.isin(_KIND, (0, 1, 2, 9))


class Features(NamedTuple):
    """Distinct word features of document d at words[at[d]:at[d + 1]]; metadata features (n, MEASURES + 2); words in each text."""
    words: np.ndarray
    at: np.ndarray
    meta: np.ndarray
    tokens: np.ndarray


def features(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> Features:
    data, at = raw_bytes(text)
    n = len(at) - 1
    length = np.diff(at)
    doc = np.repeat(np.arange(n), length)
    kinds = np.bincount(doc * 10 + _KIND[data], minlength=n * 10).reshape(n, 10)
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = _IN_WORD[data]
    before = np.concatenate(([False], word[:-1]))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts, ends = np.flatnonzero(word & (~before | edge)), np.flatnonzero(before & (~word | edge))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(int(_MULT), len(data)), out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * _powers(pow(int(_MULT), -1, 1 << 64), len(data) + 1)[starts])
    owner = np.searchsorted(at, starts, side="right") - 1
    tokens = np.bincount(owner, minlength=n)
    distinct = np.unique((owner.astype(np.uint64) << np.uint64(WORD_BITS)) | (hashes >> np.uint64(64 - WORD_BITS)))
    of = (distinct >> np.uint64(WORD_BITS)).astype(np.int64)
    cut = np.searchsorted(of, np.arange(n + 1))
    words = (distinct & np.uint64(WORDS - 1)).astype(np.int64)

    lines = [t.split("\n") for t in texts_of(pa.record_batch([text], names=["text"]))]
    repeated = np.array([1 - len(set(x)) / len(x) for x in lines])
    size, many = np.maximum(length, 1), np.maximum(tokens, 1)
    told = np.array([x if x is not None else -1 for x in n_chars.to_pylist()], np.float64) if n_chars is not None else length.astype(np.float64)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1], 1)
    measures = np.stack([np.log2(np.maximum(told, 0) + 1) / 20, kinds[:, 0] / letters, *(np.sqrt(kinds[:, k] / size) for k in (2, 4, 5, 6, 7, 8, 9)),
                         repeated, np.diff(cut) / many, np.minimum(length / many / 20, 1), np.sqrt(kinds[:, 3] / size)], axis=1)
    bins = np.minimum((measures * BINS).astype(np.int64), BINS - 1) + np.arange(MEASURES) * BINS
    named = [[zlib.crc32((x or "").encode()) % NAMES for x in (c.to_pylist() if c is not None else [None] * n)] for c in (lang, source)]
    meta = np.concatenate((bins, MEASURES * BINS + np.array(named, np.int64).T.reshape(n, 2) + [[0, NAMES]]), axis=1)
    return Features(words, cut, meta, tokens)


def joined(parts: list[Features]) -> Features:
    """Features of several batches as one."""
    if not parts:
        return Features(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((0, MEASURES + 2), np.int64), np.zeros(0, np.int64))
    counts = np.concatenate([np.diff(p.at) for p in parts])
    return Features(np.concatenate([p.words for p in parts]), np.concatenate(([0], np.cumsum(counts))), np.concatenate([p.meta for p in parts]),
                    np.concatenate([p.tokens for p in parts]))


def subset(f: Features, rows: np.ndarray) -> Features:
    counts = np.diff(f.at)[rows]
    step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return Features(f.words[np.repeat(f.at[:-1][rows], counts) + step], np.concatenate(([0], np.cumsum(counts))), f.meta[rows], f.tokens[rows])


def sparse(f: Features, view: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column of every feature of a view (text, meta or both), and the number of columns."""
    rows, columns = np.repeat(np.arange(len(f.meta)), np.diff(f.at)), f.words
    own = np.repeat(np.arange(len(f.meta)), f.meta.shape[1])
    if view == "text":
        return rows, columns, WORDS
    if view == "meta":
        return own, f.meta.ravel(), META
    return np.concatenate((rows, own)), np.concatenate((columns, WORDS + f.meta.ravel())), WORDS + META


class Linear(NamedTuple):
    view: str
    weights: np.ndarray
    bias: np.ndarray

    def logits(self, f: Features) -> np.ndarray:
        rows, columns, _ = sparse(f, self.view)
        n = len(f.meta)
        return np.stack([np.bincount(rows, self.weights[columns, k], n) for k in range(self.weights.shape[1])], axis=1) + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(f: Features, y: np.ndarray, classes: int, view: str, weight: np.ndarray | None = None, steps: int = 250, decay: float = 1e-4) -> Linear:
    """Softmax regression on presence features, each scaled by its smoothed log ratio to the class share
    (features in few documents or with small ratios count for nothing); accelerated gradient steps."""
    rows, columns, width = sparse(f, view)
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    target = np.eye(classes)[y] * weight[:, None]
    share = (target.sum(axis=0) + 1) / (weight.sum() + classes)
    seen = np.bincount(columns, weight[rows], width)
    scale = np.zeros((width, classes))
    for k in range(classes):
        own = np.bincount(columns, target[rows, k], width)
        scale[:, k] = np.where(seen >= LEAST_COUNT, np.log((own + SMOOTHING * share[k]) / ((seen + SMOOTHING) * share[k])), 0)
    scale[np.abs(scale).max(axis=1) < INFORMATIVE] = 0
    useful = np.flatnonzero(scale.any(axis=1))
    place = np.full(width, -1)
    place[useful] = np.arange(len(useful))
    rows, columns = rows[place[columns] >= 0], place[columns[place[columns] >= 0]]
    values, size = scale[useful][columns], len(useful)
    norm = np.array([np.bincount(rows, values[:, k] ** 2, n).mean() for k in range(classes)]).max() + 1
    rate = 4.0 / norm
    u, b = np.zeros((size, classes)), np.log(share)
    ahead_u, ahead_b, momentum = u, b, 1.0
    for _ in range(steps):
        logits = np.stack([np.bincount(rows, values[:, k] * ahead_u[columns, k], n) for k in range(classes)], axis=1) + ahead_b
        error = (softmax(logits) * weight[:, None] - target) / weight.sum()
        slope = np.stack([np.bincount(columns, values[:, k] * error[rows, k], size) for k in range(classes)], axis=1)
        new_u, new_b = ahead_u - rate * (slope + decay * ahead_u), ahead_b - rate * error.sum(axis=0)
        after = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead_u, ahead_b = new_u + (momentum - 1) / after * (new_u - u), new_b + (momentum - 1) / after * (new_b - b)
        u, b, momentum = new_u, new_b, after
    weights = np.zeros((width, classes), np.float32)
    weights[useful] = scale[useful] * u
    return Linear(view, weights, b)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 50, decay: float = 1e-3) -> np.ndarray:
    """Coefficients of a small dense logistic regression (intercept last), by Newton steps."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + decay * len(x) * np.append(w[:-1], 0)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * len(x) * np.eye(len(w)) + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w = w - move
        if np.abs(move).max() < 1e-9:
            break
    return w
