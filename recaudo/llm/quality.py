"""Quality classifier: supervised subword embeddings.

A document's features are its words (runs without white space, as written),
their n-grams of ``SIZES`` bytes, with a boundary mark at both ends, and for
each two neighbouring words whether they are equal, all hashed into ``buckets``. Each bucket has a learned vector; the document's is
their mean over all its features, and a softmax over it gives the label's
probability. Vectors and output are trained by numpy stochastic gradient
descent with decaying rate in one task, on at most ``max_train`` labelled
rows, so training costs the same for any corpus. Whole texts are scored in
tasks, with the vectors broadcast (buckets * dim floats).

Null, empty and blank texts have no features and get the prior of the
training labels, as learned by the bias. Rows that repeat an id are scored
each. Without labelled rows of both kinds every score is the share of label 1
(0.5 without any). Only the text is an input; other columns pass through
unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_table
from .folds import fold_is, labelled_sample
from .registry import register

SIZES = (3, 4)
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % buckets


def features(text: bytes, buckets: int) -> np.ndarray:
    """Buckets of all features of a text, in no particular order."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(space))
    starts, ends = edge[::2] + 1, edge[1::2] + 1           # words are raw[start:end]
    if not len(starts):
        return np.empty(0, np.int64)
    code = np.where(space, np.uint64(32), raw.astype(np.uint64)) + np.uint64(1)
    out = []
    for size in SIZES:
        n = len(raw) - size + 1
        if n <= 0:
            continue
        inner = space[1:n + 1].copy()
        for j in range(2, size - 1):
            inner |= space[j:n + j]
        h = np.full(n, np.uint64(size))
        for j in range(size):
            h = h * BASE + code[j:n + j]
        out.append(_bucket(h[~inner], buckets))
    power = np.full(len(raw), BASE)
    power[0] = 1
    power = np.cumprod(power)
    total = np.concatenate([[np.uint64(0)], np.cumsum(code * power)])
    back = np.full(len(raw), _INVERSE)
    back[0] = 1
    words = (total[ends] - total[starts]) * np.cumprod(back)[starts]
    out.append(_bucket(words, buckets))
    # pairs of neighbouring words by their pattern alone: equal or not
    out.append(_bucket((words[1:] == words[:-1]).astype(np.uint64) + np.uint64(1), buckets))
    return np.concatenate(out)


def counted(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets and each one's share of its features."""
    at, n = np.unique(features(text, buckets), return_counts=True)
    return at.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)


def train(sparse: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, buckets: int, dim: int, epochs: int, rate: float,
          seed: int) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias): the log-odds of label 1 are the mean
    weight over a text's features plus the bias. The softmax of two outputs
    depends on their difference alone, so the vectors are folded with it."""
    rng = np.random.default_rng(seed)
    if not len(label) or label.min() == label.max():
        share = min(max(float(label.mean()) if len(label) else 0.5, 1e-6), 1 - 1e-6)
        return np.zeros(buckets), float(np.log(share / (1 - share)))
    vectors = (rng.random((buckets, dim), np.float32) - 0.5) / dim
    output, bias = np.zeros((dim, 2), np.float32), np.log(np.bincount(label, minlength=2) / len(label))
    steps, done = epochs * len(label), 0
    for _ in range(epochs):
        for k in rng.permutation(len(label)):
            at, share = sparse[k]
            step = rate * (1 - done / steps)
            done += 1
            mine = vectors[at]
            hidden = share @ mine
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label[k]] -= 1
            back = output @ p
            output -= (step * np.outer(hidden, p)).astype(np.float32)
            bias = bias - 0.1 * step * p
            # a document's gradient is shared out over its features; scaled by the largest share, it moves the frequent ones
            vectors[at] = mine - (step * share / share.max(initial=1e-9))[:, None] * back[None, :]
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def fit(sample: DataFrame, buckets: int, dim: int, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, float]:
    """Counts features of the bounded ``sample`` (doc_id, label, text) where
    its rows are, at most ``buckets`` numbers a row however long its text, and
    trains on them in one task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t.as_py().encode("utf-8", "surrogatepass"), buckets) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a.tobytes() for a, _ in found], pa.binary()),
                                              pa.array([n.tobytes() for _, n in found], pa.binary())], ["doc_id", "label", "buckets", "shares"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "label", "buckets", "shares"])
        sparse = [(np.frombuffer(a, np.int32), np.frombuffer(n, np.float32)) for a, n in zip(group.buckets, group.shares)]
        weights, bias = train(sparse, group.label.to_numpy(np.int64), buckets, dim, epochs, rate, seed)
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    rows = sample.select("doc_id", "label", "text").mapInArrow(count, "doc_id long, label int, buckets binary, shares binary")
    got = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "weights binary, bias double").collect()
    return (np.frombuffer(got[0].weights), got[0].bias) if got else (np.zeros(buckets), 0.0)


def _logit(text: str, weights: np.ndarray, bias: float) -> float:
    at = features(text.encode("utf-8", "surrogatepass"), len(weights))
    return bias + (float(weights[at].mean()) if len(at) else 0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            logits = [_logit(t.as_py() or "", weights, bias) for t in batch.column(1)]
            p = 1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.asarray(p, np.float64))], ["doc_id", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, with all their columns. Only a flag passes
    between Python and Spark, so the rows are never copied through Python or shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        weights, bias = shared.value
        return texts.map(lambda t: bool(_logit(t, weights, bias) >= 0))

    return docs.filter(good(F.coalesce(F.col(text_col), F.lit(""))))


#: Production parameters of op6 and of the pipeline. ``max_train`` bounds the labelled rows the classifier is fitted on.
PARAMETERS = {"buckets": 1 << 16, "dim": 8, "epochs": 6, "rate": 0.5, "seed": 3}
MAX_TRAIN = 4000
FOLDS, HELD_OUT = 3, 1


def quality_model(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    return fit(labelled_sample(docs, labels, "quality", ~fold_is(FOLDS, HELD_OUT), MAX_TRAIN), **PARAMETERS)


def quality_scores(docs: DataFrame, labels: DataFrame, to_score: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``to_score`` (default ``docs``)."""
    scored = score(docs if to_score is None else to_score, quality_model(docs, labels))
    return scored.select("doc_id", fold_is(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op6_quality")
def op6_quality(spark, sf_dir):
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
