"""Periodic runs of words by multi-scale minimizers.

A run is a longest stretch of words with smallest period q (words q apart are
equal) and at least ``max(min_words, min_periods * q)`` words. Periods up to
``SHORT`` are found by direct lag scans: the stretches where each word equals
the one q before. Longer ones are looked for scale by scale. Scale P takes
the periods P < q <= 2P and hashes every stretch of 2P words; of each P
neighbouring hashes the least is a minimizer. Inside a run of four periods

* the window q words further holds the same words, so its minimum stands
  exactly q further (the run has room for P + q hashes);
* two equal stretches of 2P >= q words stand a multiple of q apart, or the
  run would have a smaller period.

So a minimizer's next equal one is one period on: neighbours of equal value
at a distance of P + 1 to 2P words seed the pair (place, period), and a seed
is extended to both sides on the words themselves. Hashes only propose, words
decide; a seed inside a stretch that was already extended is passed over, so
a run costs its length once a scale. A stretch that also has a smaller period
is the run of that period and is reported with it.

Texts are worked on a block at a time: their words are numbered and laid end
to end, with a number of its own between two texts, which no run can hold.
Every scale drops the texts that are too short for it. Rows stay where they
are, nothing is shuffled, and memory is a block's (``block_words``, or one
longer text).

Words are ``[^\\x20\\x09-\\x0D]+``. Null, empty and blank texts have no words
and no runs. A word's run keeps its first period; collapsing drops the rest.
Repeated rows are answered each; an empty table gives an empty result. Only
the id and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_table
from .registry import register

#: Periods that are scanned directly; a power of two, the first scale.
SHORT = 8
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def _stretch_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` words (a power of two), by doubling."""
    h, width = _mixed(words.astype(np.uint64) + MIX2), 1
    while width < size:
        h = _mixed(h[:-width] * MIX2 + h[width:])
        width *= 2
    return h


def _sliding(least: Callable, x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width < size:
        x = least(x[:-width], x[width:])
        width *= 2
    return x


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places that hold the least hash of some ``window`` neighbours: where
    the largest of the minima of all windows over a place is its own hash."""
    minima = _sliding(np.minimum, hashes, window)
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, minima, edge]), window) == hashes)


def _equal_to(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on (towards ``step`` 1 or -1) equal those ``lag`` further."""
    room = len(words) - lag - at if step > 0 else at + 1
    seen, size = 0, 64
    while seen < room:
        size = min(size, room - seen)
        low = at + seen if step > 0 else at - seen - size + 1
        other = np.flatnonzero(words[low:low + size] != words[low + lag:low + lag + size])
        if len(other):
            return seen + int(other[0] if step > 0 else size - 1 - other[-1])
        seen += size
        size *= 2
    return seen


def _lag_scan(words: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int, int]]:
    same = np.zeros(len(words) - lag + 2, np.int8)
    same[1:-1] = words[lag:] == words[:-lag]
    edges = np.flatnonzero(np.diff(same))
    start, length = edges[::2], edges[1::2] - edges[::2] + lag
    for k in np.flatnonzero(length >= least):
        yield int(start[k]), int(length[k]), lag


def _scale(words: np.ndarray, p: int, least: Callable[[int], int]) -> Iterator[tuple[int, int, int]]:
    """The runs of periods p + 1 to 2p, by equal neighbouring minimizers."""
    hashes = _stretch_hashes(words, 2 * p)
    if len(hashes) < 2 * p:
        return
    places = minimizers(hashes, p)
    places = places[np.argsort(hashes[places], kind="stable")]
    value, gap = hashes[places], np.diff(places)
    seed = np.flatnonzero((value[1:] == value[:-1]) & (gap > p) & (gap <= 2 * p))
    at, lag = places[seed], gap[seed]
    order = np.lexsort((at, lag))
    done_lag, done = 0, 0
    for x, q in zip(at[order].tolist(), lag[order].tolist()):
        if q == done_lag and x < done:
            continue
        right = _equal_to(words, x, q, 1)
        if not right:
            continue
        start = x - _equal_to(words, x - 1, q, -1) if x else 0
        done_lag, done = q, x + right
        if done - start + q >= least(q):
            yield start, done - start + q, q


def find_runs(words: np.ndarray, sizes: np.ndarray, min_words: int = 6, min_periods: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period, in texts
    of ``sizes`` words that are laid end to end in ``words`` (numbers) with
    one number that occurs nowhere else behind each. ``min_periods`` of four
    or more is what the scales need."""
    if min_periods < 4:
        raise ValueError("min_periods must be at least 4")
    least = lambda q: max(min_words, min_periods * q)
    longest = int(sizes.max(initial=0))
    found: dict[tuple[int, int], int] = {}

    def add(runs, origin=None):
        for start, length, q in runs:
            if origin is not None:
                start = int(origin[start])
            if found.get((start, length), q) >= q:
                found[start, length] = q

    for q in range(1, SHORT + 1):
        if least(q) <= longest:
            add(_lag_scan(words, q, least(q)))
    p, place = SHORT, np.arange(len(words))
    own = np.repeat(sizes, sizes + 1)                    # the size of each word's text
    while least(p + 1) <= longest:
        long = own >= least(p + 1)
        if 2 * np.count_nonzero(long) <= len(long):      # texts too short for this scale leave
            words, own, place = words[long], own[long], place[long]
        add(_scale(words, p, least), place)
        p *= 2
    rows = np.array([(s, n, q) for (s, n), q in found.items()], np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, with one of its own behind each text; the texts' sizes."""
    known: dict[bytes, int] = {}
    flat: list[int] = []
    for k, text in enumerate(texts):
        flat += [known.setdefault(w, len(known)) for w in text]
        flat.append(-k - 1)
    return np.array(flat, np.int64), np.array([len(t) for t in texts], np.int64)


def _answers(ids: list, texts: list[list[bytes]], min_words: int, min_periods: int) -> pa.RecordBatch:
    words, sizes = numbered(texts)
    runs = find_runs(words, sizes, min_words, min_periods)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    change = np.zeros(len(words) + 1, np.int64)          # +1 where a run's second period begins, -1 behind its end
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    drop = np.cumsum(change[:-1]) > 0
    ends = np.searchsorted(runs[:, 0], begin).astype(np.int32)
    collapsed = []
    for k, text in enumerate(texts):
        if ends[k + 1] > ends[k]:
            text = [text[i] for i in np.flatnonzero(~drop[begin[k]:begin[k] + len(text)])]
        collapsed.append(b" ".join(text))
    start = runs[:, 0] - np.repeat(begin[:-1], np.diff(ends))
    rows = pa.StructArray.from_arrays([pa.array(start), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), rows), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_words: int = 6, min_periods: int = 4, rewrite: Rewrite | None = None,
                  id_col: str = "doc_id", text_col: str = "text", block_words: int = 1 << 17) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period)
    and the collapsed text, a row a document. ``rewrite`` turns (id, words)
    into the words that are looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, count = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                i, words = i.as_py(), (t.as_py() or b"").split()
                ids.append(i)
                texts.append(rewrite(i, words) if rewrite else words)
                count += len(words)
                if count >= block_words:
                    yield _answers(ids, texts, min_words, min_periods)
                    ids, texts, count = [], [], 0
        if ids:
            yield _answers(ids, texts, min_words, min_periods)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, SCHEMA)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rule: a tenth of all documents repeat a stretch from some
    word on, both chosen by the id's crc32. Without an id words stay."""
    n = len(words)
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@register("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(read_table(spark, sf_dir, "documents"), rewrite=planted)
    # runs come by start and period, so only a strictly greater exponent replaces the best so far
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                       lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
