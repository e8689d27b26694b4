"""A weighted two-block network over sequences and static features (L3), trained by distributed gradient sums.

The temporal block slides ``filters`` kernels of two periods over the (periods x channels) tensor, rectifies
and keeps each filter's largest response; the static block is one rectified layer; a rectified
layer joins both and one output gives the log-odds.  Each step is one Spark job: every task sums the
weighted gradients and losses of its rows in numpy, Spark adds the sums up cell by cell, and the
driver, which holds the parameters only, takes an Adam step.  The loss is the weighted mean, so a row of weight 2
counts like the same row twice.  Validation rows give a loss in the same job; training ends by the
early-stopping rule and the best parameters count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.spec import EARLY_STOP_MIN_DELTA, EARLY_STOP_PATIENCE

FILTERS, STATIC_UNITS, JOINT_UNITS = 32, 16, 64


@dataclass
class Shape:
    periods: int
    channels: int
    static: int
    filters: int = FILTERS
    static_units: int = STATIC_UNITS
    joint_units: int = JOINT_UNITS

    def sizes(self) -> list[tuple[int, ...]]:
        return [(2 * self.channels, self.filters), (self.filters,), (self.static, self.static_units), (self.static_units,),
                (self.filters + self.static_units, self.joint_units), (self.joint_units,), (self.joint_units, 1), (1,)]

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for size in self.sizes():
            n = int(np.prod(size))
            out.append(flat[at:at + n].reshape(size))
            at += n
        return out

    @property
    def n_parameters(self) -> int:
        return sum(int(np.prod(s)) for s in self.sizes())


def initial(shape: Shape, seed: int) -> np.ndarray:
    """Scaled normal weights, zero biases."""
    random, parts = np.random.default_rng(seed), []
    for size in shape.sizes():
        parts.append(random.normal(size=size) * np.sqrt(2.0 / size[0]) if len(size) == 2 else np.zeros(size))
    return np.concatenate([p.ravel() for p in parts])


def _forward(shape: Shape, flat: np.ndarray, temporal: np.ndarray, static: np.ndarray):
    w, b, ws, bs, wj, bj, wo, bo = shape.split(flat)
    pairs = np.concatenate((temporal[:, :-1], temporal[:, 1:]), axis=2)
    response = pairs @ w + b
    best = response.argmax(axis=1)
    peak = np.take_along_axis(response, best[:, None], axis=1)[:, 0]
    left, right = np.maximum(peak, 0), np.maximum(static @ ws + bs, 0)
    both = np.concatenate((left, right), axis=1)
    joint = np.maximum(both @ wj + bj, 0)
    return pairs, best, peak, right, both, joint, (joint @ wo + bo)[:, 0]


def log_odds(shape: Shape, flat: np.ndarray, temporal: np.ndarray, static: np.ndarray) -> np.ndarray:
    return _forward(shape, flat, temporal, static)[-1]


def losses(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic loss of each row, without overflow."""
    return np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))


def gradient_sums(shape: Shape, flat: np.ndarray, temporal: np.ndarray, static: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums over rows of the weighted gradients and of the weighted losses."""
    pairs, best, peak, right, both, joint, z = _forward(shape, flat, temporal, static)
    _, _, ws, _, wj, _, wo, _ = shape.split(flat)
    dz = weight * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
    d_joint = dz[:, None] * wo[:, 0] * (joint > 0)
    d_both = d_joint @ wj.T
    d_peak = d_both[:, :shape.filters] * (peak > 0)
    d_right = d_both[:, shape.filters:] * (right > 0)
    # each filter's gradient goes to the pair of periods that gave its largest response
    chosen = pairs[np.arange(len(z))[:, None], best]  # rows, filters, inputs
    parts = [np.einsum("nfi,nf->if", chosen, d_peak), d_peak.sum(axis=0), static.T @ d_right, d_right.sum(axis=0),
             both.T @ d_joint, d_joint.sum(axis=0), joint.T @ dz[:, None], [dz.sum()]]
    return np.concatenate([np.ravel(p) for p in parts]), float((weight * losses(z, y)).sum())


def _arrays(batch: pa.RecordBatch, shape: Shape) -> tuple[np.ndarray, ...]:
    n = batch.num_rows
    temporal = batch.column(0).flatten().flatten().to_numpy().reshape(n, shape.periods, shape.channels).astype(float)
    static = batch.column(1).flatten().to_numpy().reshape(n, shape.static).astype(float)
    return temporal, static, *(batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(2, batch.num_columns))


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sums(rows: DataFrame, shape: Shape, flat: np.ndarray) -> np.ndarray:
    """Over (temporal, static, label, weight, held): gradient sums and loss of the training rows, their weight, then loss and weight of the held-out rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape.n_parameters + 4)
        for batch in _pieces(batches):
            temporal, static, y, weight, held = _arrays(batch, shape)
            own = held == 0
            gradient, loss = gradient_sums(shape, flat, temporal[own], static[own], y[own], weight[own])
            away = losses(log_odds(shape, flat, temporal[~own], static[~own]), y[~own])
            total += np.concatenate((gradient, [loss, weight[own].sum(), (weight[~own] * away).sum(), weight[~own].sum()]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "value"])

    got = rows.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()  # one number a parameter
    out = np.zeros(shape.n_parameters + 4)
    for r in got:
        out[r["cell"]] = r["value"]
    return out


@dataclass
class Network:
    shape: Shape
    parameters: np.ndarray
    history: list[tuple[int, float, float]] = field(default_factory=list)  # epoch, training loss, held-out loss

    def history_frame(self, spark: SparkSession, name: str = "network") -> DataFrame:
        """(model_name, epoch, training_loss, validation_loss): one row an epoch."""
        return spark.createDataFrame([(name, *h) for h in self.history], "model_name string, epoch long, training_loss double, validation_loss double")

    def score(self, df: DataFrame, id_col: str, temporal: str = "temporal", static: str = "static", label: str = "label", name: str = "network") -> DataFrame:
        """(model_name, ID, y_true, probability_default, prediction_at_0_5)."""
        shape, kind = self.shape, df.schema[id_col].dataType.simpleString()
        sent = df.sparkSession.sparkContext.broadcast(self.parameters)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _pieces(batches):
                t, s, _ = _arrays(batch.select([0, 1, 2]), shape)
                p = 1 / (1 + np.exp(-np.clip(log_odds(shape, sent.value, t, s), -700, 700)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(p)), batch.column(3), pa.array(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)), pa.array(p),
                                                  pa.array((p >= 0.5).astype(np.int32))], names=["model_name", "ID", "y_true", "probability_default", "prediction_at_0_5"])

        return df.select(temporal, static, F.col(label).cast("long").alias(label), id_col).mapInArrow(
            run, f"model_name string, ID {kind}, y_true long, probability_default double, prediction_at_0_5 int")

    def to_json(self) -> str:
        return json.dumps({"shape": vars(self.shape), "parameters": self.parameters.tolist(), "history": self.history})

    @staticmethod
    def from_json(text: str) -> "Network":
        raw = json.loads(text)
        return Network(Shape(**raw["shape"]), np.array(raw["parameters"]), [tuple(h) for h in raw["history"]])


def fit(train: DataFrame, validation: DataFrame | None, shape: Shape, temporal: str = "temporal", static: str = "static", label: str = "label", weight: str | None = "weight",
        epochs: int = 40, rate: float = 0.02, decay: float = 1e-4, patience: int = EARLY_STOP_PATIENCE, min_delta: float = EARLY_STOP_MIN_DELTA, seed: int = 42) -> Network:
    """L3: train on whole frames; weights of ``weight`` (none: 1) on training rows, 1 on validation rows."""

    def prepared(df: DataFrame, w, held: int) -> DataFrame:
        return df.select(F.col(temporal).alias("t"), F.col(static).alias("s"), F.col(label).cast("double").alias("y"), w.cast("double").alias("w"), F.lit(held).alias("held"))

    rows = prepared(train, F.col(weight) if weight else F.lit(1.0), 0)
    if validation is not None:
        rows = rows.unionByName(prepared(validation, F.lit(1.0), 1))
    rows = rows.persist()
    flat, first, second = initial(shape, seed), np.zeros(shape.n_parameters), np.zeros(shape.n_parameters)
    best, best_loss, wait, history = flat, np.inf, 0, []
    try:
        for epoch in range(epochs + 1):
            got = sums(rows, shape, flat)
            loss, total, held_loss, held_total = got[-4:]
            if not total:
                raise ValueError("no training rows with a weight")
            watched = held_loss / held_total if held_total else loss / total
            history.append((epoch, float(loss / total), float(watched)))
            if watched < best_loss - min_delta:
                best, best_loss, wait = flat, watched, 0
            else:
                wait += 1
                if wait >= patience:
                    break
            if epoch == epochs:
                break
            slope = got[:-4] / total + decay * flat
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
            flat = flat - rate * (first / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(second / (1 - 0.999 ** (epoch + 1))) + 1e-8)
    finally:
        rows.unpersist()
    return Network(shape, best, history)
