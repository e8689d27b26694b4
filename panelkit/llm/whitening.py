"""Whitening of embeddings to their leading principal components.

Entries become integers, x = floor(256 c).  The fit list holds each distinct x vector once.  Three passes over it, each one
sum of small matrices a task that Spark adds up cell by cell: n and the sums S, the covariance V of the rows centred
before they are multiplied, and, in the end, the covariance of the whitened rows as a check.  Only n, S and the cells of
V (as many as dimensions squared, whatever the number of rows) come to the driver, which

1. reduces V to a tridiagonal matrix by Householder reflections,
2. finds the leading eigenvalues by bisection on Sturm counts (how many eigenvalues lie below a shift),
3. finds their vectors by inverse iteration, made orthogonal again within clusters of close eigenvalues,
4. carries the vectors back through the reflections.

Components, S and n are broadcast (dimensions times components numbers) and every row is projected where it is.

Rows whose vector is null, empty or holds a null or non-finite entry are dropped.  All vectors should have one length; if not, the
length that most of the rows have counts (of equals the greater) and other rows are dropped.  Repeated rows and ids are
all returned; null ids stay null; other columns are ignored.  An empty table gives no rows, nor does a component whose
eigenvalue is zero to rounding (one distinct vector only, fewer distinct vectors than components), since nothing can be
scaled to it.  Of equal eigenvalues any basis is right; the sign makes the entry of largest size positive.
Entries beyond +-2^53 / 256 saturate.  A ``deviation`` that a long can't hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialise

COMPONENTS, SCALE = 4, 256
#: entries saturate here, where doubles stop to hold every integer
LARGEST = 1 << 53
EPS = float(np.finfo(np.float64).eps)
#: eigenvalues nearer than this share of the norm are one cluster
CLUSTER = 1e-3
#: vectors turned into one array at a time
ROWS = 8192


def integers(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>): usable rows only."""
    entry = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("long"))
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("v") > 0)
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), entry.alias("v")).where(F.col("v").isNotNull() & usable)
    size = out.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return out.where(F.size("v") == (size["size"] if size else 0)).select("vec_id", x.alias("x"))


def matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches with their vectors as an int64 matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            yield piece, piece.column(column).flatten().to_numpy().reshape(piece.num_rows, -1)


def summed(rows: DataFrame, of) -> np.ndarray | None:
    """The sum over all rows of ``of(x)``, a flat float or integer array for a matrix of rows: one array a task, then a
    sum for each cell in Spark.  Integer cells are exact (decimals)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in matrices(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            whole = total.dtype != np.float64
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(np.zeros(len(total)) if whole else total),
                                              pa.array(total if whole else np.zeros(len(total), np.int64), pa.int64())], names=["cell", "value", "whole"])

    cells = (rows.select("x").mapInArrow(run, "cell long, value double, whole long").groupBy("cell")
             .agg(F.sum("value").alias("value"), F.sum(F.col("whole").cast("decimal(20,0)")).alias("whole")).orderBy("cell").collect())
    if not cells:
        return None
    return np.array([float(r["value"]) for r in cells]), [int(r["whole"]) for r in cells]


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reflections that turn symmetric ``a`` into a tridiagonal matrix: its diagonal, its off-diagonal, and
    the unit normals of the reflections (each acts on the entries behind its place)."""
    a, normals = a.copy(), []
    for k in range(len(a) - 2):
        column = a[k + 1:, k]
        normal = column.copy()
        normal[0] += np.copysign(np.linalg.norm(column), column[0])
        length = np.linalg.norm(normal)
        normal = normal / length if length else np.zeros_like(normal)
        rest = a[k + 1:, k + 1:]
        image = rest @ normal
        image -= normal * (normal @ image)
        rest -= 2 * (np.outer(normal, image) + np.outer(image, normal))
        column -= 2 * normal * (normal @ column)
        a[k, k + 1:] = column
        normals.append(normal)
    return np.diag(a).copy(), np.diag(a, 1).copy(), normals


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are less than each shift (signs of the pivots of T - shift)."""
    tiny = EPS * EPS * max(float((off ** 2).max(initial=0)), 1.0)
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shifts - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval can't be halved."""
    n = len(diagonal)
    radius = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    low, high = np.full(k, float((diagonal - radius).min())), np.full(k, float((diagonal + radius).max()))
    span = max(abs(low[0]), abs(high[0]), 1e-300)
    low, high = low - 2 * EPS * span, high + 2 * EPS * span
    wanted = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        small = below(diagonal, off, middle) <= wanted
        low, high = np.where(small, middle, low), np.where(small, high, middle)
    return (low + high) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; pivots are ``least`` in size at least."""
    n = len(diagonal)
    d, up, upper, low, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), off.copy(), right.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):  # the next row goes first
            d[i], low_i = low[i], d[i]
            up[i], d_next = d[i + 1], up[i]
            upper[i], up_next = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
            factor = low_i / d[i]
            d[i + 1], up[i + 1] = d_next - factor * up[i], up_next - factor * upper[i]
        else:
            if abs(d[i]) < least:
                d[i] = np.copysign(least, d[i])
            factor = low[i] / d[i]
            d[i + 1] -= factor * up[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < least:
        d[-1] = np.copysign(least, d[-1])
    for i in range(n - 1, -1, -1):
        later = (up[i] * x[i + 1] if i + 1 < n else 0.0) + (upper[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - later) / d[i]
        size = np.abs(x).max()
        if size > 1e200:  # only the direction counts
            x /= size
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, a row for each of ``values`` (falling)."""
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0))) or 1.0
    random, out, first, shift = np.random.default_rng(n), np.zeros((len(values), n)), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k  # a new cluster
        shift = min(value, shift - 4 * EPS * norm) if k > first else value  # never the same shift twice
        x = random.standard_normal(n)
        for _ in range(6):
            x = solved(diagonal, off, shift, x / np.linalg.norm(x), EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):  # twice is enough
                x -= out[first:k].T @ (out[first:k] @ x)
        out[k] = x / np.linalg.norm(x)
    return out


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues of symmetric ``v``, falling, and their unit vectors as rows."""
    diagonal, off, normals = tridiagonal(v)
    values = leading_values(diagonal, off, min(k, len(v)))
    rows = leading_vectors(diagonal, off, values)
    for at in range(len(normals) - 1, -1, -1):
        rows[:, at + 1:] -= 2 * np.outer(rows[:, at + 1:] @ normals[at], normals[at])
    largest = rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]
    return values, rows * np.where(largest < 0, -1.0, 1.0)[:, None]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sums over dimensions of (n x - S) ** 2, exact; null where a long can't hold one."""
    most = max(abs(s) for s in sums)
    size = int(np.abs(x).max(initial=0))
    if (n * size + most) ** 2 * len(sums) < 1 << 63:
        part = n * x - np.array(sums, np.int64)
        return pa.array((part * part).sum(axis=1), pa.int64())
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whiten(rows: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [c.split()[0] for c in kinds.split(", ")]
    every = integers(rows, id_col, vector_col)
    fit = materialise(every.select("x").distinct(), "fit")
    first = summed(fit, lambda x: np.concatenate(([len(x)], x.sum(axis=0))).astype(np.int64))
    if first is None:
        return rows.sparkSession.createDataFrame([], kinds)
    n, sums = first[1][0], first[1][1:]
    mean, size = np.array([s / n for s in sums]), len(sums)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred).ravel()

    v = summed(fit, products)[0].reshape(size, size) / n
    values, vectors = components((v + v.T) / 2, k)
    good = values > size * 16 * EPS * max(np.trace(v), 0.0)
    values, vectors = values[good], vectors[good]
    if not len(values):
        return rows.sparkSession.createDataFrame([], kinds)
    scaled, explained = vectors / np.sqrt(values)[:, None], values / np.trace(v)

    def projected(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ scaled.T
        return np.concatenate((white.sum(axis=0), (white.T @ white).ravel()))

    seen = summed(fit, projected)[0] / n
    identity_error = float(np.abs(seen[len(values):].reshape(len(values), -1) - np.outer(seen[:len(values)], seen[:len(values)]) - np.eye(len(values))).max())
    sent = rows.sparkSession.sparkContext.broadcast((mean, sums, scaled, explained))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, sums, scaled, explained = sent.value
        many = len(scaled)
        for piece, x in matrices(batches, 1):
            white = (x - mean) @ scaled.T
            of = pa.array(np.repeat(np.arange(len(x)), many))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(of), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))), pa.array(np.full(many * len(x), n)),
                 deviations(x, n, sums).take(of), pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(many * len(x), identity_error))], names=names)

    return every.select("vec_id", "x").mapInArrow(run, kinds)
