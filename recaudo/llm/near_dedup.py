"""MinHash near-dedup by an LSH forest.

A document's set holds the hashes of its distinct word shingles (``width``
words; with fewer words the whole sequence is one shingle). Each of ``trees``
orders sorts all documents by a label of ``depth`` MinHash values. Rows of one
order that share the first ``min_depth`` values form a region. In a region of
at most ``window`` rows every pair is a candidate; a larger region is cut
deeper, value by value, until its parts are that small, and neighbours in the
sorted order (the longest common prefixes) stay candidates at any size. The
depth so adapts to each region, and a region never yields more than
``window`` candidates a row and order. In a large region every row is also
held against three well linked rows of it (of each third of the ids the one
with the most confirmed links) that aren't in its component yet, so that
variants of one text that resemble the text but not each other come together.

What is then still apart in large regions is compared by a prefix filter. All
shingles have one order, rare ones first (by how often the rows of large
regions hold their bucket of ``BUCKETS``, then by hash). Of two sets at the
threshold the larger shares one of its first n - ceil(0.8 n) + 1 shingles with
the first n - ceil(2 * 0.8 n / 1.8) + 1 of the smaller, at places that leave
enough shingles behind them. Rows of different components that do are
candidates, however many: text that all rows of a region share stands behind
their own shingles and makes none unless it could make a link. Of a shingle's
rows only those of different components are ever put together: the shingle's
components are paired first (a row a component, however many rows it has), and
the rows meet by (shingle, component).

A pair of similarity 0.8 shares 3 of 3 values in one order with probability
0.51, so 24 orders miss it with probability 4e-8; the region it then shares is
compared whole. A pair that a boundary between two sorted parts separates is
looked for in the other orders.

Candidates are confirmed on whole sets: 100 * intersection >= 80 * union. The
three likeliest candidates of every document are confirmed first; of the rest
only those whose ends are still in different components, as the others can't
change the result.

Equal sets are one class from the start, so copies cost one row each. The
sorted orders are dealt out by range of (order, label, id), so neither a hot
label nor a hot region lands in one task; candidates of one document are
bounded by orders * window, and by the prefix filter in large regions.

Null, empty and blank texts have an empty set and link with nothing. Rows
that repeat a doc_id are one document if their texts are equal, and link by
their texts otherwise. A row with a null id gets the component of the documents
with its very text, or null; it links nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .common import read_table, text_of, written
from .components import connected_components, merged_components
from .registry import register

BUCKETS = 1 << 20       # counters of shingles, the bound of what is broadcast
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.
    Words are runs without space, tab, LF, VT, FF, CR, in lower-case A-Z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    x = _mixed(h[:n] + np.uint64(width))
    for j in range(1, width):
        x = _mixed(x * MIX2 + h[j:n + j])
    return np.unique(x)


def _multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _label(shingles: np.ndarray, odd: np.ndarray, step: int = 2048) -> bytes:
    least = (odd[:, None] * shingles[None, :step]).min(axis=1)
    for i in range(step, len(shingles), step):
        least = np.minimum(least, (odd[:, None] * shingles[None, i:i + step]).min(axis=1))
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def sketches(docs: DataFrame, width: int, trees: int, depth: int, seed: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the set, null if empty) and
    labels (trees * depth MinHash values)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = _multipliers(trees * depth, seed)
        for batch in batches:
            sizes, keys, labels = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                labels.append(_label(s, odd) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(labels, pa.binary())], ["doc_id", "n_shingles", "set_key", "labels"])
    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, labels binary")


def _prefixes(labels: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Length of the prefix that each sorted row shares with the row before it in its order."""
    same = (labels[1:] == labels[:-1]) & (tree[1:] == tree[:-1])[:, None]
    return np.concatenate([[0], np.where(same.all(axis=1), labels.shape[1], same.argmin(axis=1))]).astype(np.int16)


def _region_depth(lcp: np.ndarray, depth: int, min_depth: int, window: int) -> np.ndarray:
    """The depth, from ``min_depth`` on, at which each row's region has at most ``window`` rows; depth + 1 if none."""
    need = np.full(len(lcp), depth + 1, np.int16)
    for d in range(depth, min_depth - 1, -1):
        length = np.diff(np.append(np.flatnonzero(lcp < d), len(lcp)))
        need[np.repeat(length, length) <= window] = d
    return need


def _pairs(lcp: np.ndarray, need: np.ndarray, depth: int, min_depth: int, window: int):
    """(rows, rows, common prefix) of the candidates among sorted rows."""
    rows = len(lcp)
    common = np.full(rows, depth, np.int16)
    for back in range(1, min(window, rows)):
        common = np.minimum(common[1:], lcp[1:rows - back + 1])      # of rows k and k + back
        j = np.arange(back, rows)
        hit = common >= (min_depth if back == 1 else need[j])
        yield j[hit], j[hit] - back, common[hit]


def _scan(min_depth: int, depth: int, window: int, block: int, percent: int):
    """Runs over the sorted rows of a part, a block at a time: candidates
    (a, b, common), and the rows of regions of over ``window`` rows (a, region)."""
    def read(rows: pa.Table):
        labels = np.frombuffer(b"".join(rows.column("label").to_pylist()), dtype=">u4").reshape(-1, depth)
        tree, ids, n = (rows.column(c).to_numpy() for c in ("tree", "id", "n"))
        lcp = _prefixes(labels, tree)
        need = _region_depth(lcp, depth, min_depth, window)
        for i, j, common in _pairs(lcp, need, depth, min_depth, window):
            close = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            a, b = ids[i[close]], ids[j[close]]
            yield out(np.maximum(a, b), np.minimum(a, b), common[close], None)
        dense = np.flatnonzero(need > min_depth)
        keys = [xxhash.xxh3_64_intdigest(labels[k, :min_depth].tobytes(), seed=int(tree[k])) for k in dense]
        yield out(ids[dense], None, None, np.array(keys, np.uint64).view(np.int64))

    def out(*columns):
        rows = len(columns[0])
        return pa.RecordBatch.from_arrays([pa.nulls(rows, t) if c is None else pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                                          ["a", "b", "common", "region"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= block:
                rows = pa.Table.from_batches(held)
                yield from read(rows)
                held = rows.slice(rows.num_rows - window).combine_chunks().to_batches()     # looked back at by the next block
                count = window
        if count:
            yield from read(pa.Table.from_batches(held))
    return run


def forest(classes: DataFrame, trees: int, depth: int, min_depth: int, window: int, percent: int, block: int = 1 << 18) -> DataFrame:
    """One pass over the sorted orders of ``classes`` (id, n, labels): rows
    (a, b, common) are candidates, rows (a, region) members of dense regions."""
    rows = classes.select("id", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)),
                          lambda t: F.substring(F.col("labels"), t * (depth * 4) + 1, F.lit(depth * 4)))).alias("tree", "label"))
    ordered = rows.repartitionByRange("tree", "label", "id").sortWithinPartitions("tree", "label", "id")
    return (ordered.select("tree", "label", "id", "n")
            .mapInArrow(_scan(min_depth, depth, window, block, percent), "a long, b long, common int, region long"))


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """id and its set as an array, from (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), width).view(np.int64) for t in part.column(1)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["id", "shingles"])
    return docs.mapInArrow(run, "id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    # one plan at every size: the sets shuffle, however few the pairs are
    left, right = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s{c}")).hint("merge") for c in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"))


def _apart(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component yet."""
    of = lambda c: component.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _hub_pairs(members: DataFrame, links: DataFrame, hubs: int = 3) -> DataFrame:
    """Every member (id, region, component) of a dense region with those of the
    region's well linked members that are in another component: of each
    ``hubs``-th of the ids the one with the most links."""
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    share = F.pmod(F.xxhash64("id"), F.lit(hubs))
    top = [F.max(F.when(share == k, F.struct("degree", (-F.col("id")).alias("last"), "component"))).alias(f"h{k}") for k in range(hubs)]
    hub = (members.join(degree, "id").groupBy("region").agg(*top)
           .select("region", F.explode(F.array(*[f"h{k}" for k in range(hubs)])).alias("h")).filter("h is not null")
           .select(F.col("region").alias("r"), (-F.col("h.last")).alias("hub"), F.col("h.component").alias("hc")))
    return (members.join(hub, (F.col("region") == F.col("r")) & (F.col("component") != F.col("hc")))
            .select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct())


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (_mixed(shingles.view(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[a:b] for a, b in zip(ends[:-1], ends[1:]))


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many (row, shingle) of ``sets`` fall into each bucket; 0 for 0 and 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for s in _lists(batch.column(0)):
                np.add.at(count, _bucket(s), 1)
        hit = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(count[hit])], ["bucket", "n"])
    counts = np.zeros(BUCKETS, np.int64)
    rows = sets.select("shingles").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()   # at most BUCKETS
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


def prefixes(sets: DataFrame, percent: int, counts: Broadcast) -> DataFrame:
    """The first shingles of each set of (id, component, shingles), rare ones
    first. ``smaller``: among those that count against sets no smaller. A
    shingle that no other row can hold is left out."""
    names = ["shingle", "smaller", "id", "component", "n", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for i, c, s in zip(part.column(0).to_numpy(), part.column(1).to_numpy(), _lists(part.column(2))):
                    n, often = len(s), counts.value[_bucket(s)]
                    first = np.lexsort((s, often))[:n - -(-percent * n // 100) + 1]
                    place = np.flatnonzero(often[first])
                    s, k = s[first][place], len(place)
                    out.append((s, place < n - -(-2 * percent * n // (100 + percent)) + 1, np.full(k, i), np.full(k, c), np.full(k, n), place))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names)
    return (sets.select("id", "component", "shingles").filter("size(shingles) > 0")
            .mapInArrow(run, "shingle long, smaller boolean, id long, component long, n long, place long"))


def _prefix_pairs(members: DataFrame, sets: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of members in different components that can be similar enough."""
    inside = sets.join(members.select("id").distinct().hint("merge"), "id", "left_semi")
    counts = sets.sparkSession.sparkContext.broadcast(shingle_counts(inside))
    rows = (inside.join(component, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "shingles"))
    parts = written(prefixes(rows, percent, counts), "near-prefixes")
    counts.destroy()
    # the components that each shingle brings together, a row a component, with the bounds of its rows
    spare = F.col("n") - F.col("place")                                         # shared from here on, at most
    holds = parts.groupBy("shingle", "component").agg(
        F.max("smaller").alias("smaller"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max(spare).alias("spare"),
        F.min(F.when(F.col("smaller"), F.col("n"))).alias("least_small"), F.max(F.when(F.col("smaller"), F.col("n"))).alias("most_small"),
        F.max(F.when(F.col("smaller"), spare)).alias("spare_small"))
    shared = holds.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least != most").select("shingle")
    holds = written(holds.join(shared, "shingle", "left_semi"), "near-holds")
    may_fit = ((F.col("least_small") <= F.col("most_n")) & (100 * F.col("most_small") >= percent * F.col("least_n"))
               & ((100 + percent) * F.least("spare_small", "spare") >= percent * (F.col("least_small") + F.greatest("least_n", "least_small"))))
    apart = (holds.filter("smaller").select("shingle", F.col("component").alias("c0"), "least_small", "most_small", "spare_small")
             .join(holds.select(F.col("shingle").alias("s1"), F.col("component").alias("c1"), "least_n", "most_n", "spare"),
                   (F.col("shingle") == F.col("s1")) & (F.col("c0") != F.col("c1")) & may_fit)
             .select("shingle", "c0", "c1", "least_n", "most_n", "spare"))
    small, large = (df.select("shingle", *[F.col(c).alias(c[0] + y) for c in ("id", "component", "n", "place")])
                    for df, y in ((parts.filter("smaller"), "0"), (parts, "1")))
    left = F.least(F.col("n0") - F.col("p0"), F.col("n1") - F.col("p1"))        # shared from here on, at most
    fits = (((F.col("n0") < F.col("n1")) | (F.col("n0") == F.col("n1")) & (F.col("i0") < F.col("i1")))
            & (100 * F.col("n0") >= percent * F.col("n1")) & ((100 + percent) * left >= percent * (F.col("n0") + F.col("n1"))))
    ends = large.select(F.col("shingle").alias("s1"), F.col("c1").alias("d1"), "i1", "n1", "p1")
    # each row by itself against the other component's bounds, then against its rows
    reaches = ((F.col("n0") <= F.col("most_n")) & (100 * F.col("n0") >= percent * F.col("least_n"))
               & ((100 + percent) * F.least(F.col("n0") - F.col("p0"), F.col("spare")) >= percent * (F.col("n0") + F.greatest("least_n", "n0"))))
    starts = small.select(F.col("shingle").alias("s0"), F.col("c0").alias("d0"), "i0", "n0", "p0")
    return (starts.join(apart, (F.col("s0") == F.col("shingle")) & (F.col("d0") == F.col("c0")) & reaches)
            .join(ends, (F.col("shingle") == F.col("s1")) & (F.col("c1") == F.col("d1")) & fits)
            .select(F.greatest("i0", "i1").alias("a"), F.least("i0", "i1").alias("b")).distinct())


def near_links(docs: DataFrame, classes: DataFrame, width: int, trees: int, depth: int, min_depth: int, window: int, percent: int) -> DataFrame:
    """id, component of every class that links with another class.
    ``docs``: id, text of all documents; ``classes``: id, n, labels."""
    found = written(forest(classes, trees, depth, min_depth, window, percent), "near-forest")
    members = written(found.filter("region is not null").select(F.col("a").alias("id"), "region").distinct(), "near-members")
    pairs = written(found.filter("b is not null").groupBy("a", "b").agg(F.sum("common").alias("weight")), "near-pairs")
    each = pairs.select(F.explode(F.array("a", "b")).alias("end"), "a", "b", "weight")
    ends = each.select(F.col("end").alias("id")).union(members.select("id")).distinct()
    sets = written(shingle_sets(docs.join(ends.hint("merge"), "id", "left_semi").select("id", "text"), width), "near-sets")
    best = (each.withColumn("rank", F.row_number().over(Window.partitionBy("end").orderBy(F.desc("weight"), "a", "b")))
            .filter("rank <= 3").select("a", "b").distinct())
    links = written(confirmed(best, sets, percent), "near-links")
    component = written(connected_components(links), "components")
    placed = members.join(component, "id", "left").select("id", "region", F.coalesce("component", "id").alias("component"))
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    todo = _apart(rest, component).union(_hub_pairs(placed, links)).distinct()
    component = merged_components(component, written(confirmed(todo, sets, percent), "near-links"))
    if members.isEmpty():
        return component
    return merged_components(component, written(confirmed(_prefix_pairs(members, sets, component, percent), sets, percent), "near-links"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, trees: int = 24, depth: int = 8, min_depth: int = 3,
                    window: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sketch = written(sketches(texts, width, trees, depth, seed), "near-sketches")
    classes = written(sketch.filter("set_key is not null and doc_id is not null").groupBy("set_key")
                      .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("labels").alias("labels"), F.count("*").alias("copies")), "near-classes")
    linked = near_links(texts.withColumnRenamed("doc_id", "id"), classes.select("id", "n", "labels"), width, trees, depth, min_depth, window, percent)
    of_class = classes.select("set_key", "id").join(linked, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    return (sketch.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    keep = near_duplicates(docs, id_col=id_col, **parameters).filter("kept").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(keep, docs[id_col].cast("long").eqNullSafe(keep["__keep"]), "left_semi")


@register("op1_near_dedup")
def op1_near_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=4)
