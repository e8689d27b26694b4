"""Quality classifier by co-training.

Two views of a document: its words, and its page metadata (source, language, stated length, layout
measures).  Each view has a classifier of its own.  In every round each classifier scores a pool of
unlabelled documents, and those on which it is confident (calibrated on held-out labels) become
pseudo-labels for the other view.  In the end each view's margin is calibrated and a logistic
combination fitted on the held-out labels scores every document.

A document is wanted when it is labelled of quality 1 and not toxic.  Fitting uses at most
``labelled_rows`` labelled documents and ``pool_rows`` unlabelled ones, those of least id hash; all
documents are scored.  Null text counts as empty; null metadata is a value of its own; columns lang,
source and n_chars may be missing.  Several labels of one document: the lowest quality and the highest
toxicity count; labels with a null count as absent.  Without labels of both kinds every document
scores 1.  Rows with a null or repeated id are scored each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import linear
from panelkit.llm.common import fresh_name, materialise, sliced

LABELLED_ROWS, POOL_ROWS, ROUNDS, CONFIDENT, PSEUDO_WEIGHT = 10_000, 5_000, 3, 0.97, 0.3
LIMIT = 0.5


class Model(NamedTuple):
    text: linear.Linear
    meta: linear.Linear
    calibrations: tuple[np.ndarray, np.ndarray]
    blend: np.ndarray

    def scores(self, f: linear.Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated text and metadata probabilities, and the combined one."""
        margins = [_margin(m, f) for m in (self.text, self.meta)]
        views = [sigmoid(m * c[0] + c[1]) for m, c in zip(margins, self.calibrations)]
        return *views, sigmoid(np.stack([_logit(v) for v in views], axis=1) @ self.blend[:-1] + self.blend[-1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def _margin(model: linear.Linear, f: linear.Features) -> np.ndarray:
    x = model.logits(f)
    return x[:, 1] - x[:, 0]


def view(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns that features are made of, under fixed names."""
    has = {c.lower() for c in docs.columns}
    extra = [F.col(c).try_cast(kind).alias(c) if c in has else F.lit(None).cast(kind).alias(c) for c, kind in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *extra)


def batch_features(batch: pa.RecordBatch) -> linear.Features:
    return linear.features(*(batch.column(c) for c in ("text", "lang", "source", "n_chars")))


def sampled(docs: DataFrame, ids: DataFrame) -> tuple[np.ndarray, linear.Features]:
    """Features of a bounded set of documents, on the driver in id order; one row for a repeated id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, linear.CHUNK_BYTES):
            data = pickle.dumps((batch.column("doc_id").to_numpy(zero_copy_only=False), batch_features(batch)))
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

    picked = docs.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    parts = [pickle.loads(r["data"]) for r in picked.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, "data binary").toLocalIterator()]
    if not parts:
        return np.zeros(0, np.int64), linear.joined([])
    keys, whole = np.concatenate([p[0] for p in parts]), linear.joined([p[1] for p in parts])
    _, first = np.unique(keys, return_index=True)
    return keys[first], linear.subset(whole, first)


def label_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, toxic), one row per labelled document."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").dropna()
            .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))


def least_hashed(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _calibrated(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return linear.logistic(margin[:, None], y)


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS, rounds: int = ROUNDS,
        confident: float = CONFIDENT) -> Model | None:
    """Co-train on bounded samples; ``docs`` as from ``view``."""
    known = label_rows(labels).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = least_hashed(known, labelled_rows).collect()
    truth = {r["doc_id"]: int(r["quality"] == 1 and r["toxic"] == 0) for r in chosen}
    if len(set(truth.values())) < 2:
        return None
    spark = docs.sparkSession
    ids, f = sampled(docs, spark.createDataFrame([(i,) for i in truth], "doc_id long"))
    pool_ids = least_hashed(docs.select("doc_id").dropna().distinct().join(label_rows(labels), "doc_id", "left_anti"), pool_rows).collect()
    _, pool = sampled(docs, spark.createDataFrame([(r["doc_id"],) for r in pool_ids], "doc_id long")) if pool_ids else (None, linear.joined([]))
    y = np.array([truth[i] for i in ids.tolist()])
    held = np.arange(len(ids)) % 4 == 0
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(ids), bool)
    own, check, y_own, y_check = linear.subset(f, np.flatnonzero(~held)), linear.subset(f, np.flatnonzero(held | ~held.any())), y[~held], y[held | ~held.any()]
    given: dict[str, np.ndarray] = {"text": np.full(len(pool.meta), -1), "meta": np.full(len(pool.meta), -1)}
    for turn in range(rounds + 1):
        models, cal = {}, {}
        for name in ("text", "meta"):
            extra = np.flatnonzero(given[name] >= 0)
            rows = linear.joined([own, linear.subset(pool, extra)])
            models[name] = linear.fit(rows, np.concatenate((y_own, given[name][extra])), 2, name,
                                      np.concatenate((np.ones(len(y_own)), np.full(len(extra), PSEUDO_WEIGHT))))
            cal[name] = _calibrated(_margin(models[name], check), y_check)
        if turn < rounds and len(pool.meta):
            for name, other in (("text", "meta"), ("meta", "text")):
                p = sigmoid(_margin(models[name], pool) * cal[name][0] + cal[name][1])
                given[other] = np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1))
    views = np.stack([_logit(sigmoid(_margin(models[v], check) * cal[v][0] + cal[v][1])) for v in ("text", "meta")], axis=1)
    return Model(models["text"], models["meta"], (cal["text"], cal["meta"]), linear.logistic(views, y_check))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """(doc_id, text_hash, text_score, meta_score, score) of every row."""
    rows = view(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, linear.CHUNK_BYTES):
            if model.value is None:
                out = [np.ones(batch.num_rows)] * 3
            else:
                out = model.value.scores(batch_features(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *map(pa.array, out)],
                                             names=["doc_id", "text_hash", "text_score", "meta_score", "score"])

    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, text_score double, meta_score double, score double")


def keep(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """The rows of ``docs`` that score ``limit`` or more, all columns as they are: one scan, no shuffle of texts."""
    rows = view(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, **bounds))
    # the same readings of the metadata as in ``view``, in front of the table's own columns
    meta, has = {}, {c.lower() for c in docs.columns}
    for c, kind in (("lang", "string"), ("source", "string"), ("n_chars", "long")):
        meta[fresh_name(docs, f"__{c}")] = F.col(c).try_cast(kind) if c in has else F.lit(None).cast(kind)
    joined = docs.select(*(c.alias(name) for name, c in meta.items()), "*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, linear.CHUNK_BYTES, text_col):
            columns, own = batch.columns[:3], pa.RecordBatch.from_arrays(batch.columns[3:], names=batch.schema.names[3:])
            if model.value is not None:
                own = own.filter(pa.array(model.value.scores(linear.features(own.column(text_col), *columns))[2] >= limit))
            yield own

    return joined.mapInArrow(run, docs.schema)
