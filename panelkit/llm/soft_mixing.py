"""Mixing sources to target weights with soft memberships.

A classifier fitted on the labelled table gives each document posteriors over domains (clean, low
quality, toxic).  Rates r >= 0 of documents minimise

    1/2 |sum_i w_i r_i p_i - target|^2 + ridge/2 sum_i w_i (r_i - 1)^2,   w_i = tokens of i / all tokens

by projected gradient steps, the norm being that of the inverse second moments of the posteriors, so
that rare domains converge as fast as common ones.  A step changes r_i by the posteriors' product with one gradient vector, so
a task replays all steps from the short history of these vectors and only sums of a few numbers travel
(one row from each task).  The ridge prefers rates near one among the many that meet the targets.  Steps go on until the
largest gap to a target is below ``TOLERANCE`` or has not shrunk by a tenth for ``PATIENCE`` steps, as where a floor or a bound on
rates keeps the targets out of reach; the gap that is left is returned with the rates.

Fitting sees at most ``labelled_rows`` labelled documents (least id hash); posteriors, totals and rates
cover all documents.  A document without tokens has no weight and gets the rate of its posteriors.
Null texts count as empty and very long ones as whole texts; repeated rows count each time; labels of one domain only make every document
a member of that domain, no labels one of the first.  Several labels of a document: see ``cotrain_quality``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import linear
from panelkit.llm.common import fresh_name, list_array, materialise, order_key, sliced
from panelkit.llm.cotrain_quality import batch_features, label_rows, least_hashed, sampled, view

DOMAINS = ("clean", "low", "toxic")
TARGET = (0.92, 0.05, 0.03)
LABELLED_ROWS, RIDGE = 10_000, 1e-3
#: steps without a smaller gap after which the rates are as near as they get
PATIENCE = 8
#: added to the second moments: a domain that hardly any document belongs to can't throw the rates about
LEAST_MOMENT = 1e-3
#: largest gap to a target share at which the steps end
TOLERANCE = 1e-5


def fit(rows: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> linear.Linear | int:
    """The classifier, or the one domain that all labels name (the first without labels)."""
    known = label_rows(labels).join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    truth = {r["doc_id"]: 2 if r["toxic"] == 1 else int(r["quality"] != 1) for r in least_hashed(known, labelled_rows).collect()}
    if len(set(truth.values())) < 2:
        return min(truth.values(), default=0)
    ids, f = sampled(rows, rows.sparkSession.createDataFrame([(i,) for i in truth], "doc_id long"))
    return linear.fit(f, np.array([truth[i] for i in ids.tolist()]), len(DOMAINS), "both")


def posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text_hash, tokens, p array<double>) of every row."""
    rows = view(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, labelled_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, linear.CHUNK_BYTES):
            f = batch_features(batch)
            p = np.eye(len(DOMAINS))[np.full(batch.num_rows, model.value)] if isinstance(model.value, int) else linear.softmax(model.value.logits(f))
            ends = np.arange(1, batch.num_rows + 1) * len(DOMAINS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(f.tokens.astype(np.int64)), list_array(p.ravel(), ends, pa.float64())],
                                             names=["doc_id", "text_hash", "tokens", "p"])

    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, tokens long, p array<double>")


def rates_of(p: np.ndarray, history: list[np.ndarray], ridge: float = RIDGE, least_first: float = 0.0, most: float = np.inf) -> np.ndarray:
    """Replay the projected steps; the step length suits a curvature of at most 1 + ridge.  Documents
    whose likeliest domain is the first have rates of ``least_first`` or more, all others of 0 or more; none is above ``most``."""
    r = np.ones(len(p))
    floor = np.where(p.argmax(axis=1) == 0, least_first, 0.0)
    for slope in history:
        r = np.minimum(most, np.maximum(floor, r - (p @ slope + ridge * (r - 1)) / (1 + ridge)))
    return r


def _p(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, len(DOMAINS))


def totals(members: DataFrame, history: list[np.ndarray], ridge: float, least_first: float = 0.0, most: float = np.inf) -> np.ndarray:
    """Expected tokens of each domain under the rates so far, all tokens, and the second moments of the
    posteriors (row by row); exact sums of the tasks' rows."""

    size = len(DOMAINS) * (len(DOMAINS) + 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            tokens, p = batch.column(0).to_numpy().astype(float), _p(batch, 1)
            out += np.concatenate(((tokens * rates_of(p, history, ridge, least_first, most)) @ p, [tokens.sum()], ((p * tokens[:, None]).T @ p).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["sums"])

    rows = members.select("tokens", "p").mapInArrow(run, "sums array<double>").collect()
    return np.array([math.fsum(r["sums"][k] for r in rows) for k in range(size)])


def fit_rates(members: DataFrame, target=TARGET, ridge: float = RIDGE, least_first: float = 0.0, most: float = np.inf) -> tuple[list[np.ndarray], float]:
    """The gradient vectors of the projected steps up to the least gap found, and that gap."""
    history: list[np.ndarray] = []
    k, best, at, mark, since = len(DOMAINS), np.inf, 0, np.inf, 0
    while True:
        sums = totals(members, history, ridge, least_first, most)
        if not sums[k]:
            return [], 0.0
        gap = sums[:k] / sums[k] - np.array(target)
        size = float(np.abs(gap).max())
        if size < best:
            best, at = size, len(history)
        if size < 0.9 * mark:
            mark, since = size, len(history)
        if size < TOLERANCE or len(history) - since >= PATIENCE:
            return history[:at], best
        history.append(np.linalg.solve(sums[k + 1:].reshape(k, k) / sums[k] + LEAST_MOMENT * np.eye(k), gap))


def rate(members: DataFrame, history: list[np.ndarray], gap: float, ridge: float = RIDGE, least_first: float = 0.0, most: float = np.inf) -> DataFrame:
    """(doc_id, text_hash, tokens, p, rate, gap) of every row of ``members``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_of(_p(batch, 3), history, ridge, least_first, most)), pa.array(np.full(batch.num_rows, gap))],
                                             names=["doc_id", "text_hash", "tokens", "p", "rate", "gap"])

    return members.mapInArrow(run, "doc_id long, text_hash long, tokens long, p array<double>, rate double, gap double")


def mix(docs: DataFrame, labels: DataFrame, target=TARGET, ridge: float = RIDGE, least_first: float = 0.0, most: float = np.inf,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, tokens, p, rate, gap): the posteriors and the fitted rate of every document, and the largest
    difference that is left between a domain's expected tokens and its target, as a share of all tokens."""
    members = materialise(posteriors(docs, labels, id_col, text_col), "posteriors")
    return rate(members, *fit_rates(members, target, ridge, least_first, most), ridge, least_first, most)


def resample(docs: DataFrame, labels: DataFrame, target=TARGET, ridge: float = RIDGE, most: float = np.inf, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part always, the rest by a hash of id
    and text.  Rates of documents whose likeliest domain is the first (clean) are fitted to be one or
    more, so none of them is lost; no rate is above ``most``; repeats keep their id.  Rows of one id and text go by the largest of their rates."""
    rated = mix(docs, labels, target, ridge, 1.0, most, id_col, text_col)
    key, mark, times = (fresh_name(docs, x) for x in ("__id", "__text", "__times"))
    chance = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 53)) / float(1 << 53)
    copies = rated.select(order_key("doc_id").alias(key), F.col("text_hash").alias(mark), F.floor(F.col("rate") + chance).cast("int").alias(times))
    copies = copies.groupBy(key, mark).agg(F.max(times).alias(times))
    out = docs.withColumns({key: order_key(id_col), mark: F.xxhash64(text_col)}).join(copies.where(F.col(times) > 0), [key, mark])
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
