"""Alignment of two tokenizers' tokens by merge-path partitioning.

Vocabulary A is a byte-level BPE (a ``tokenizers`` JSON file), B a
SentencePiece model. Both cut the same bytes, a space and the text, so a
token is known by the byte at which it ends. Where an A and a B token end
together, both are linked, and such ends cut the text into groups: the
fewest tokens on both sides that cover the same bytes.

The ends of all texts of a chunk are laid end to end, which gives two sorted
lists whatever the texts' lengths are. Merging them is divided by diagonals:
a binary search on each diagonal d finds how many of the first d merged ends
are A's, so pieces of equal work are cut out that need nothing of each other,
through the middle of a long text as well as across many short ones. A piece
emits the ends that both lists hold inside it. An A end and its equal B end
may lie on two sides of a cut; these pairs are found at the boundaries, and
the groups are put together over the cuts.

A chunk (``chunk_bytes`` of text, or one longer text) is one row: its texts
with their links as places in the chunk's list of different pairs, and that
list with its counts. So the corpus-wide count of an id pair costs one row a
chunk and pair, and is brought back to the texts by one row a chunk and pair;
links themselves are never shuffled one by one, and a pair that stands in
every text is one row a chunk. The tables of both passes are written to the
shared folder.

Strings of special tokens inside texts are plain text. Texts that are null or
empty, or whose pieces don't give space + text back (as with a literal
U+2581, which B reads as a space), have no tokens: zeros and ''. Repeated
rows are answered each and each counts; an empty table gives empty results.
Only the id and the text column are read, so other columns may have any name.

Both vocabularies are read by the driver from paths that are parameters, and
broadcast: 50,257 and 32,000 entries.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_table, written
from .registry import register

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The published splitting pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTROL, BYTE = 3, 6

DOC = ("doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,groups:string,"
       "at:array<int>,times:array<int>")
CHUNK_SCHEMA = f"docs array<struct<{DOC}>>, pair array<long>, n array<long>"


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE writes a byte as the letter of its code where that is a
    printable one of Latin-1, and the others as the letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}


def load_vocabularies(byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL) -> dict:
    """Both vocabularies as plain values that can be broadcast."""
    with open(byte_path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, model, split = _byte_letters(), spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merges]
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec.get("normalizer") or order != sorted(order):
        raise ValueError(f"{byte_path}: a byte-level BPE whose ids follow its merges is needed")
    with open(piece_path, "rb") as f:
        return {"ranks": ranks, "pieces": f.read()}


def merge_cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where every ``work``-th diagonal crosses the merge path of two sorted
    lists (equal ends: A's first), by binary searches on all diagonals at once."""
    diagonal = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        k = np.flatnonzero(open_)
        before = a[middle[k]] <= b[diagonal[k] - 1 - middle[k]]
        low[k[before]] = middle[k[before]] + 1
        high[k[~before]] = middle[k[~before]]
    return low, diagonal - low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` (both strictly increasing) of the ends they share, in order."""
    i, j = merge_cuts(a, b, work)
    found = []
    for k in range(len(i) - 1):
        left, right = a[i[k]:i[k + 1]], b[j[k]:j[k + 1]]
        if len(left) and len(right):
            at = np.searchsorted(right, left)
            hit = np.flatnonzero(right[np.minimum(at, len(right) - 1)] == left)
            found.append(np.stack([i[k] + hit, j[k] + at[hit]]))
        if i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:     # cut between two equal ends
            found.append(np.array([[i[k + 1] - 1], [j[k + 1]]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # pieces come in order; two cuts may stand between the same ends, if one has nothing of a side
    shared = np.concatenate(found, axis=1)
    once = np.diff(shared[0], prepend=-1) > 0
    return shared[0][once], shared[1][once]


class Aligner:
    """Encoders and byte tables of both vocabularies, built once a worker."""

    def __init__(self, vocabularies: dict):
        self.vocabularies, self.ready = vocabularies, False

    def __getstate__(self):
        return {"vocabularies": self.vocabularies, "ready": False}

    def _build(self) -> None:
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2 as pb
        ranks = self.vocabularies["ranks"]
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.vocabularies["pieces"])
        proto = pb.ModelProto()
        proto.ParseFromString(self.vocabularies["pieces"])
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else p.piece.replace("▁", " ").encode() for p in proto.pieces]
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = [len(t) for t in ranks]
        self.a_size, self.b_size = sizes, np.array([len(t) for t in self.b_bytes])
        # an id and what follows it in a text of groups: inside one, or as the last of its side
        digits = lambda size, marks: np.array([[f"{i}{m}".encode() for i in range(size)] for m in marks], object)
        self.a_text, self.b_text = digits(len(sizes), ",|"), digits(len(self.b_bytes), ",;")
        self.ready = True

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B for each text; two empty lists where there are none."""
        if not self.ready:
            self._build()
        a, b, none = [], [], np.empty(0, np.int64)
        for text, pieces in zip(texts, self.b.encode(texts, num_threads=1)):
            if text and b"".join(map(self.b_bytes.__getitem__, pieces)) == b" " + text.encode():
                a.append(self.a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64))
                b.append(np.array(pieces, np.int64))
            else:
                a.append(none)
                b.append(none)
        return a, b

    def chunk(self, ids: list, texts: list[str], keep_groups: bool, work: int) -> dict:
        """One row of CHUNK_SCHEMA."""
        of_a, of_b = self.tokens(texts)
        a, b = np.concatenate(of_a), np.concatenate(of_b)
        end_a, end_b = (np.cumsum([0, *map(len, x)]) for x in (of_a, of_b))
        at_a, at_b = common_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), work)
        # a text's last ends are shared, so no group reaches into the next text
        cut = np.searchsorted(at_a, end_a)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[at_a] = last_b[at_b] = 1
        words = np.empty(len(a) + len(b), object)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        words[np.arange(len(a)) + np.concatenate([[0], at_b + 1])[group_a]] = self.a_text[last_a, a]
        words[np.arange(len(b)) + (at_a + 1)[group_b]] = self.b_text[last_b, b]
        pair, which, times = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True, return_counts=True)
        docs = []
        for k, i in enumerate(ids):
            links = cut[k + 1] - cut[k]
            groups = b"".join(words[end_a[k] + end_b[k]:end_a[k + 1] + end_b[k + 1]].tolist())[:-1]
            place, n = np.unique(which[cut[k]:cut[k + 1]], return_counts=True)
            docs.append({"doc_id": i, "n_a": len(of_a[k]), "n_b": len(of_b[k]), "n_groups": links, "n_links": links,
                         "groups_sha256": hashlib.sha256(groups).hexdigest() if links else "",
                         "groups": groups.decode() if keep_groups else None, "at": place.astype(np.int32), "times": n.astype(np.int32)})
        return {"docs": docs, "pair": pair, "n": times}


def aligned_chunks(docs: DataFrame, byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL, id_col: str = "doc_id", text_col: str = "text",
                   keep_groups: bool = False, chunk_bytes: int = 1 << 20, work: int = 1 << 14) -> DataFrame:
    """chunk, docs, pair (A id * 2^32 + B id), n: a row a chunk, written."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Aligner(load_vocabularies(byte_path, piece_path)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = spark.createDataFrame([], CHUNK_SCHEMA).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value
        ids, texts, size = [], [], 0
        out = lambda: pa.RecordBatch.from_pylist([aligner.chunk(ids, texts, keep_groups, work)], arrow)
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield out()
                    ids, texts, size = [], [], 0
        if ids:
            yield out()
    return written(rows.mapInArrow(run, CHUNK_SCHEMA).withColumn("chunk", F.monotonically_increasing_id()), "aligned-chunks")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, a_id, b_id, count (links of the whole corpus) and best (no other A id has more with this B id)."""
    counts = written(chunks.select(F.explode(F.arrays_zip("pair", "n")).alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("count"))
                     .select("pair", F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id"), "count"), "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("best"))


def with_support(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    groups: each text's links with the counts of their id pairs."""
    asked = chunks.select("chunk", F.posexplode("pair").alias("place", "pair"))
    known = (asked.join(counts.select("pair", "count", "best"), "pair").groupBy("chunk")
             .agg(F.array_sort(F.collect_list(F.struct("place", "count", "best"))).alias("known"))     # as many as the chunk has pairs
             .select("chunk", F.col("known.count").alias("count"), F.col("known.best").alias("best")))
    rows = chunks.select("chunk", "docs").join(known, "chunk", "left").select("docs", "count", "best")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                docs = row.column(0).flatten()
                count, best = (np.array(x.flatten().to_numpy(zero_copy_only=False)) for x in (row.column(1), row.column(2)))
                field = lambda name: docs.field(docs.type.get_field_index(name))  # noqa: E731, B023
                at, times = (field(x).flatten().to_numpy() for x in ("at", "times"))
                ends = np.concatenate([[0], np.cumsum(field("at").value_lengths().to_numpy())]).astype(np.int64)
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at].astype(np.int64), times * count[at].astype(np.int64))] if len(at) else [np.zeros(1, np.int64)] * 2
                n_best, count_sum = (pa.array((s[ends[1:]] - s[ends[:-1]]).astype(np.int64)) for s in sums)
                yield pa.RecordBatch.from_arrays([field("doc_id"), field("n_a"), field("n_b"), field("n_groups"), field("n_links"), n_best, count_sum,
                                                  field("groups_sha256"), field("groups")],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"])
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string")


def align_tokenizers(docs: DataFrame, **parameters) -> DataFrame:
    """A row a document: see :func:`with_support`. ``keep_groups`` adds the
    groups themselves as text (``a1,a2|b1;a3|b2,b3``), else null."""
    chunks = aligned_chunks(docs, **parameters)
    return with_support(chunks, pair_counts(chunks))


@register("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    return align_tokenizers(read_table(spark, sf_dir, "documents")).drop("groups")
