"""Toxicity by maximum-scoring segments.

A token's units are the word and its prefixes of ``PREFIXES`` letters, so that
inflected forms share what is learned. A unit's score is the log-odds of its
share in toxic against other training texts, with an informative Dirichlet
prior in the proportions of both (``prior`` of their tokens). A unit counts
once for each different training text that has it, whatever stands around it,
so words of fixed phrases are learned and copies of a text teach nothing new.
Units whose log-odds are under ``min_odds`` or under ``z_min`` standard
deviations count as any other; ``z_min`` is the one of ``Z_MIN`` with the least
log loss on a fifth of the training texts, held out while it is chosen (the
largest where that fifth lacks a label). A token takes its highest
unit, less a constant drift, so a text without toxic terms has a falling sum.
One linear scan (Ruzzo and Tompa) finds all maximal-scoring segments, however
many. Sums of such scores follow an extreme-value law: a segment of score s
in n tokens has E = K n exp(-lambda s), with lambda the root of
E[exp(lambda s)] = 1 over the tokens of non-toxic training texts and K fitted
to their best segments. Segments with E <= ``e_max`` are the significant
passages. The evidence of a document is the largest -log P of its r best
segments together (Karlin and Altschul's sum statistic, any r); a logistic
curve fitted on the training rows turns it into a probability.

Tokens are runs of letters, digits and underscores, in lower case. At most
``max_train`` labelled rows are used for fitting (a documented sample) and at
most ``max_terms`` units with the largest z are broadcast. Whole texts of all
documents are scored, each in its task with memory for one text.

Null and empty texts have no tokens: no passage, zero evidence, the score of
that evidence. Repeated rows are scored each. Without labelled rows of both
kinds there are no terms and every score is 0.5. Only the text is an input;
other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_table, written
from .folds import fold_is, labelled_sample
from .registry import register

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
Z_MIN = (2.0, 3.0, 4.0, 6.0)
KNOWN = 200_000          # words whose scores a task remembers


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)     # score of a unit, drift taken off
    drift: float = 0.1
    lam: float = 1.0
    k: float = 1.0
    a: float = 0.0                                            # logistic curve of the evidence
    b: float = 0.0
    e_max: float = 0.01
    known: dict[str, float | None] = field(default_factory=dict)

    def word(self, word: str) -> float | None:
        """The score of a word that holds a toxic unit."""
        found = [s for u in (word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)) if (s := self.terms.get(u)) is not None]
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[word] = score = max(found, default=None)
        return score


_NEW = object()


def maximal_segments(runs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence, given as runs (start, end,
    score); linear: each candidate is visited a bounded number of times."""
    total, found = 0.0, []            # (start, end, sum before, sum after, nearest earlier candidate with a smaller sum before)
    for start, end, s in runs:
        before, total = total, total + s
        if s <= 0:
            continue
        now = (start, end, before, total)
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= now[3]:
                found.append((*now, j))
                break
            now = (found[j][0], now[1], found[j][2], now[3])
            del found[j:]
    return [(start, end, after - before) for start, end, before, after, _ in found]


def scan(text: str, model: Model) -> tuple[int, list[tuple[int, int, float]]]:
    """(number of tokens, maximal segments by token number)."""
    tokens = WORD.findall(text.lower())
    get, word = model.known.get, model.word
    hits = [(i, s) for i, t in enumerate(tokens) if (s := x if (x := get(t, _NEW)) is not _NEW else word(t)) is not None]
    runs, last = [], 0
    for i, s in hits:
        if i > last:
            runs.append((last, i, -model.drift * (i - last)))
        runs.append((i, i + 1, s))
        last = i + 1
    return len(tokens), maximal_segments(runs)


def evidence(n: int, segments: list[tuple[int, int, float]], model: Model) -> float:
    """-log of the chance of the r best segments together, for the best r."""
    floor = math.log(max(1e-300, model.k * n)) if n else 0.0
    total, best = 0.0, 0.0
    for r, s in enumerate(sorted((s for *_, s in segments), reverse=True), 1):
        x = model.lam * s - floor
        if x <= 0:
            break
        total += x
        best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def _counts(sample: DataFrame) -> DataFrame:
    """unit, toxic and other: different labelled texts that have the unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(text.lower()))
                units = words.union(f"{w[:k]}*" for w in words for k in PREFIXES if len(w) > k)
                count.update((u, label) for u in units)
            unit, label = zip(*count) if count else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.string()), pa.array(label, pa.int32()), pa.array(list(count.values()), pa.float64())], ["unit", "label", "n"])
    n = lambda y: F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0.0))
    different = sample.select("label", "text", F.sha2("text", 256).alias("sha")).dropDuplicates(["label", "sha"])
    return (different.select("label", "text").mapInArrow(run, "unit string, label int, n double")
            .groupBy("unit").agg(n(1).alias("toxic"), n(0).alias("other")))


def fit(sample: DataFrame, prior: float = 0.05, min_odds: float = 1.5, z_min: float | None = None, max_terms: int = 20_000,
        drift: float = 0.1, e_max: float = 0.01) -> Model:
    """Learns units, extreme-value law and curve from (doc_id, label, text)."""
    sample = written(sample, "toxic-sample")
    if z_min is None:
        z_min = _chosen_z(sample, prior, min_odds, max_terms, drift, e_max)
    return _fit(sample, written(_counts(sample), "toxic-counts"), prior, min_odds, z_min, max_terms, drift, e_max)


def _chosen_z(sample: DataFrame, prior: float, min_odds: float, max_terms: int, drift: float, e_max: float) -> float:
    """The threshold of least log loss on a fifth of the texts; copies of a text are on one side."""
    held = F.pmod(F.xxhash64("text", F.lit(17)), F.lit(5)) == 0
    rest, out = sample.filter(~held), sample.filter(held)
    if rest.select("label").distinct().count() < 2 or out.select("label").distinct().count() < 2:
        return max(Z_MIN)
    counts, best = written(_counts(rest), "toxic-counts"), (math.inf, max(Z_MIN))
    for z in sorted(Z_MIN, reverse=True):
        model = _fit(rest, counts, prior, min_odds, z, max_terms, drift, e_max)
        seen = _evidence(out.select("label", "text"), model, "label int", lambda n, segments, m=model: (evidence(n, segments, m),), ["x double"]).toPandas()   # at most max_train pairs
        p = 1 / (1 + np.exp(-np.clip(model.a + model.b * seen.x.to_numpy(np.float64), -30, 30)))
        loss = float(-np.log(np.where(seen.label.to_numpy() == 1, p, 1 - p)).mean())
        best = min(best, (loss, z), key=lambda t: t[0])
    return best[1]


def _fit(sample: DataFrame, counts: DataFrame, prior: float, min_odds: float, z_min: float, max_terms: int, drift: float, e_max: float) -> Model:
    words = counts.filter(~F.col("unit").endswith("*"))
    all_ = words.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    if not all_.toxic or not all_.other:
        return Model(drift=drift, e_max=e_max)
    alpha = (F.col("toxic") + F.col("other")) * prior
    odds = lambda y, n: F.log((y + alpha) / (F.lit(n + prior * (all_.toxic + all_.other)) - y - alpha))
    delta = odds(F.col("toxic"), all_.toxic) - odds(F.col("other"), all_.other)
    deviation = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("other") + alpha))
    terms = (counts.withColumn("delta", delta).withColumn("z", F.col("delta") / deviation).filter((F.col("z") >= z_min) & (F.col("delta") >= min_odds))
             .orderBy(F.desc("z"), "unit").limit(max_terms).select("unit", "delta", "other").collect())
    model = Model({r.unit: r.delta - drift for r in terms}, drift, e_max=e_max)
    # lambda: the positive root of E[exp(lambda s)] = 1 over the tokens of other texts
    share = np.array([r.other + 1.0 for r in terms] + [1.0])      # one more occurrence each, as unseen ones aren't impossible
    share = np.append(share, max(all_.other - share.sum(), 1.0)) / max(all_.other, share.sum() + 1.0)
    value = np.array([r.delta - drift for r in terms] + [drift, -drift])
    low, high = 0.0, 50.0 / max(1e-9, value.max())
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if share @ np.exp(mid * value) < 1 else (low, mid)
    model.lam = max(low, 1e-3)
    found = _evidence(sample.select("label", "text"), model, "label int", lambda n, segments: (float(n), max((s for *_, s in segments), default=0.0)), ["n double", "best double"])
    calm = found.filter("label = 0 and n > 0").agg(F.count("*").alias("docs"), F.sum(F.col("n") * F.exp(-F.lit(model.lam) * F.col("best"))).alias("e")).first()
    model.k = calm.docs / calm.e if calm.docs and calm.e else 1.0
    curve = _evidence(sample.select("label", "text"), model, "label int", lambda n, segments: (evidence(n, segments, model),), ["x double"]).toPandas()   # at most max_train pairs
    model.a, model.b = _logistic(curve.x.to_numpy(np.float64), curve.label.to_numpy(np.float64))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Newton's method for p = 1 / (1 + exp(-(a + b x)))."""
    scale = max(1.0, float(x.max(initial=0.0)))
    design, w = np.stack([np.ones_like(x), x / scale], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1] / scale)


def _evidence(docs: DataFrame, model: Model, key: str, result, columns: list[str]) -> DataFrame:
    """Scans (key, text) rows; ``result(n, segments)`` gives the columns' values."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [key.split()[0], *(c.split()[0] for c in columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [result(*scan(t.as_py() or "", shared.value)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([v[k] for v in values], pa.float64()) for k in range(len(columns)))], names)
    return docs.mapInArrow(run, ", ".join([key, *columns]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, evidence, passages: array of (start, end, score, e_value)
    of the significant passages, in code points of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])

    def passages(text: str, n: int, segments, model: Model) -> list[dict]:
        kept = [(a, b, s, e) for a, b, s in segments if (e := model.k * n * math.exp(-min(700.0, model.lam * s))) <= model.e_max]
        if not kept:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        if len(spans) != n:                     # lower-casing changed the token borders: give spans of the lower-cased text
            spans = [m.span() for m in WORD.finditer(text.lower())]
        return [{"start": spans[a][0], "end": spans[b - 1][1], "score": s, "e_value": e} for a, b, s, e in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found, seen = [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                n, segments = scan(text, m)
                found.append(evidence(n, segments, m))
                seen.append(passages(text, n, segments, m))
            x = np.array(found, np.float64)
            p = 1 / (1 + np.exp(-np.clip(m.a + m.b * x, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(x), pa.array(seen, pa.list_(passage))], ["doc_id", "score", "evidence", "passages"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, score double, evidence double, passages array<struct<start:long,end:long,score:double,e_value:double>>"))


MAX_TRAIN = 10_000
FOLDS, HELD_OUT = 5, 0


@register("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = fit(labelled_sample(docs, labels, "toxic", ~fold_is(FOLDS, HELD_OUT), MAX_TRAIN))
    return score(docs, model).select("doc_id", fold_is(FOLDS, HELD_OUT).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
