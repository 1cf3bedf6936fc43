"""Operator 3: a linear quality classifier on n-grams scaled by naive Bayes, fitted by dual coordinate descent.

A text is the set of its hashed n-grams (one and two words, and one and two word shapes, in ``DIMENSIONS``
buckets). Each indicator is scaled by the log-count ratio of its bucket between the two classes, and the vector by the
root of its length. On those vectors a hinge-loss linear model is fitted by dual coordinate descent, and a logistic curve
turns its margin into a score from 0 to 1.

The model is fitted on a bounded sample of labelled rows: ``SAMPLE`` documents, those with the lowest hash of their id. Only
the ids and labels of that sample are broadcast to the scan and only their features reach the driver. Every document is scored
over its whole text, with weights of a fixed size.

Null texts are empty; empty texts are scored by the bias. Labels that are null, or differ for one id, are left out. Without
labels of both classes the score is the share of label 1, or 0.5 without any. Repeated rows are scored alike. A row
with a null id has ``held_out`` false.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import id_text, id_type, prepare
from dosecast.llm.word_hashes import few_at_a_time, hashed, mix

DIMENSIONS = 1 << 18
SAMPLE = 8000
FOLDS = 5
THRESHOLD = 0.3


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram buckets of all texts in a row, and where each text's begin and end."""
    words, firsts, shapes = hashed([t.encode("utf-8", "surrogatepass") for t in texts], shapes=True)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(firsts))
    near = owner[1:] == owner[:-1]
    same = np.zeros(len(words), bool)
    same[1:] = near & (words[1:] == words[:-1])
    shapes = shapes ^ (same * np.uint64(0x5BD1E9955BD1E995))  # a word that repeats its neighbour has its own shape
    grams, owners = [words, shapes + np.uint64(1)], [owner, owner]
    for own in grams[:2]:
        grams.append((own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:])[near])
        owners.append(owner[1:][near])
    buckets = mix(np.concatenate(grams)) % np.uint64(DIMENSIONS)
    keys = np.sort(np.concatenate(owners) * np.uint64(DIMENSIONS) + buckets)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    edges = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) * np.uint64(DIMENSIONS))
    return (keys % np.uint64(DIMENSIONS)).astype(np.uint32), edges


@dataclass
class Model:
    weight: np.ndarray  # log-count ratio times SVM weight, by bucket
    bias: float
    slope: float
    shift: float

    def scores(self, buckets: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weight[buckets])])
        margin = (total[edges[1:]] - total[edges[:-1]]) / np.sqrt(np.maximum(1, np.diff(edges))) + self.bias
        curve = 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30.0, 30.0)))
        return np.round(curve, 9)  # sums differ in the last bits with the company of a text


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = np.full((2, DIMENSIONS), smoothing)
    for features, label in zip(rows, labels, strict=True):
        counts[int(label), features] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def fit(rows: list[np.ndarray], labels: list[int], cost: float = 1.0, rounds: int = 20, seed: int = 7) -> Model:
    """Dual coordinate descent for the hinge loss on scaled indicators with a bias."""
    y = np.where(np.array(labels) == 1, 1.0, -1.0)
    if len(set(labels)) < 2:
        share = float(np.mean(np.array(labels) == 1)) if labels else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model(np.zeros(DIMENSIONS), 0.0, 0.0, math.log(share / (1 - share)))
    ratio = log_count_ratio(rows, np.array(labels))
    values = [ratio[r] / math.sqrt(max(1, len(r))) for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    weight, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (float(weight[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                weight[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    margins = np.array([float(weight[r] @ v) + bias for r, v in zip(rows, values, strict=True)])
    slope, shift = logistic(margins, y > 0)
    return Model(weight * ratio, bias, slope, shift)


def logistic(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, targets drawn in a little from 0 and 1."""
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the documents with a label and outside the held-out fold, ``sample`` of them at most.

    Of an id with several texts, or repeated rows, one row counts: that of the least text hash. So the bound holds for rows.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("labelled"), F.col(label_col).cast("int").alias("label"))
    known = known.where("labelled IS NOT NULL AND label IS NOT NULL").where(~held_out("labelled"))
    agreed = known.groupBy("labelled").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    chosen = agreed.where("label = other").orderBy(F.xxhash64("labelled"), "labelled").limit(sample).drop("other")

    def run(batches):
        for batch in few_at_a_time(batches):
            buckets, edges = features(batch.column("text").to_pylist())
            made = [buckets[a:b].astype("<u4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "features": pa.array(made, pa.binary())}
            )

    # the sample is bounded, so its ids may be broadcast whatever the corpus is
    texts = id_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    texts = texts.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    texts = texts.select("doc_id", "one.text", "label")
    found = texts.mapInArrow(run, f"doc_id {id_type(docs)}, label int, features binary").collect()
    found.sort(key=lambda r: (r.doc_id, bytes(r.features)))
    return fit([np.frombuffer(r.features, "<u4") for r in found], [r.label for r in found])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted per document row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in few_at_a_time(batches):
            made = shared.value.scores(*features(batch.column("text").to_pylist()))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(made)})

    scored = id_text(docs).mapInArrow(run, f"doc_id {id_type(docs)}, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)
