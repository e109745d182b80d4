"""SentencePiece encoding and decoding by streaming Viterbi.

A lattice over the characters of the normalised text: an arc is a piece of
the vocabulary, a node keeps the one best way to reach it. For a unigram
model the best way has the highest sum of scores. For a BPE model it is the
way on which every two neighbouring pieces stay apart when their text is
merged anew by rank; exactly one such way leads to each node, and it is what
applying all merges to the text gives, so ids equal SentencePiece's own.
The arcs that end at a node are found by walking back through a trie of the
reversed pieces. Only the nodes of the last ``longest`` characters can still
be extended. When the backpointers of all of them lead through one boundary,
the ids before it are committed and forgotten; the window stays as short as
the text allows. All text goes through this one stream.

No piece spans a boundary between a character and a following space mark, or
the sides of a character that no longer piece contains, so all ways meet
there and everything is committed; between two such boundaries stands a unit,
whose ids a bounded table of recent units remembers. Whether two pieces stay
apart is decided once for each pair, by walking down their last merges from
the boundary, and remembered in a bounded table too.

Text normalisation is SentencePiece's identity rule with a dummy prefix.
A literal U+2581, which SentencePiece would turn into a space, is written as
its three byte pieces, so that decoding gives back every text exactly. Other
characters outside the vocabulary are written as byte pieces too. Strings
like ``<s>`` are ordinary text. Null and empty texts give no ids and decode
to the empty text. Rows keep their columns: :func:`encode` returns the id
column, ids and what ``keep`` names; repeated rows are encoded each.

The vocabulary (some 30,000 pieces) is read once by the driver from a path
that is a parameter, and broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import read_table
from .registry import register

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2


def load_model(path: str = MODEL) -> dict:
    """Piece table of a .model file: plain values that can be broadcast."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if model.trainer_spec.model_type not in (UNIGRAM, BPE) or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError(f"{path}: a unigram or BPE model with identity normalisation is needed")
    return {"kind": model.trainer_spec.model_type, "prefix": spec.add_dummy_prefix,
            "pieces": [(p.piece, p.score, p.type) for p in model.pieces]}


class Pieces:
    """Encoder and decoder over one piece table."""

    def __init__(self, model: dict, table_size: int = 500_000):
        usable = {p: i for i, (p, _, kind) in enumerate(model["pieces"]) if kind in (NORMAL, USER_DEFINED)}
        self.ids, self.kind, self.prefix = usable, model["kind"], model["prefix"]
        self.score = {p: model["pieces"][i][1] for p, i in usable.items()}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model["pieces"]) if kind == BYTE}
        self.unknown = min(self.score.values()) - 10
        self.longest = max(map(len, usable))
        self.back: dict = {}                     # trie of the reversed pieces: character -> [id of the piece or -1, its children]
        for p, i in usable.items():
            children = self.back
            for c in reversed(p):
                node = children.setdefault(c, [-1, {}])
                children = node[1]
            node[0] = i
        joined = {c for p in usable if len(p) > 1 for c in p}
        inner = any(MARK in p.lstrip(MARK) for p in usable)
        letters = "[" + "".join(map(re.escape, sorted(joined - {MARK}))) + "]" if joined - {MARK} else "(?!)"
        self.unit = re.compile("(?s).+" if inner else f"{MARK}*{letters}+|{MARK}+|(?s:.)")
        self.text = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind in (NORMAL, USER_DEFINED) else b""
                     for p, _, kind in model["pieces"]]
        self.piece = [p for p, _, _ in model["pieces"]]
        # merges come by rank; a single character is there from the start
        order = sorted(set(self.score.values()), reverse=True)
        rank = {v: k for k, v in enumerate(order)}
        self.rank = {i: rank[self.score[p]] if len(p) > 1 else -1 for p, i in usable.items()}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[int, bool] = {}         # id * 2^32 + id behind it
        self.code = [i.to_bytes(4, "little") for i in range(len(self.piece))]
        self.units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.spaced = not inner
        self.table_size = table_size

    # --- lattice -----------------------------------------------------------
    # ids from len(self.piece) on stand for single characters outside the vocabulary

    def _text(self, i: int) -> str:
        return self.piece[i] if i < len(self.piece) else chr(i - len(self.piece))

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """All merges applied to a short text, best score first, then leftmost; the last pair that was merged."""
        parts, last = list(text), None
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts, last
            last = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _split(self, i: int) -> tuple[int, int] | None:
        """The two pieces whose merge gives a longer piece; None if its
        merges don't give it, or go through a character outside the vocabulary."""
        if i not in self.splits:
            parts, last = self.merged(self.piece[i])
            ids = tuple(self.ids.get(p, -1) for p in last or ())
            self.splits[i] = ids if len(parts) == 1 and len(ids) == 2 and min(ids) >= 0 else None
        return self.splits[i]

    def stays_apart(self, before: int, i: int) -> bool:
        """Whether piece ``i`` may follow ``before`` (-1: the start of a unit).
        Only pairs at the boundary can merge over it: the right ends of
        ``before`` and the left ends of ``i``, as far as they are there at a time."""
        if before < 0:
            return i >= len(self.piece) or len(self.piece[i]) == 1 or self.merged(self.piece[i])[0] == [self.piece[i]]
        left, right, limit = before, i, len(self.piece)
        while left < len(self.piece) and right < len(self.piece):
            joined = self.ids.get(self.piece[left] + self.piece[right])
            if joined is not None and self.rank[joined] < limit:
                return False
            if self.rank[left] > self.rank[right]:
                limit, parts = self.rank[left], self._split(left)
            elif self.rank[right] >= 0:
                limit, parts = self.rank[right] + 1, self._split(right)
            else:
                return True
            if parts is None:
                break
            if self.rank[left] > self.rank[right]:
                left = parts[1]
            else:
                right = parts[0]
        texts = [self._text(before), self._text(i)]
        return self.merged("".join(texts))[0] == texts

    def _known(self, before: int, i: int) -> bool:
        if len(self.apart) > 2 * self.table_size:
            self.apart.clear()
        known = self.apart[before << 32 | i] = self.stays_apart(before, i)
        return known

    def walk(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters, each as soon as it is certain.
        ``held`` begins at the last committed boundary; last[k] is the piece
        that ends at its node k, back[k] its length, cost[k] the best sum of scores."""
        held, back, last, cost, end = "", [0], [-1], [0.0], 0
        trie, apart, known, bpe, outside, longest = self.back, self.apart.get, self._known, self.kind == BPE, len(self.piece), self.longest
        for c in chars:
            held += c
            k = end
            end += 1
            node = trie.get(c)
            if node is None or node[0] < 0:              # within pieces at most, but none by itself
                i, children = outside + ord(c), node[1] if node else {}
            else:
                i, children = node
            best, take, piece = None, 1, i
            while True:
                if i >= 0:
                    if bpe:
                        ok = apart(last[k] << 32 | i)
                        if ok is None:
                            ok = known(last[k], i)
                        if ok:
                            take, piece = end - k, i     # the only way to this node
                            break
                    else:
                        total = cost[k] + (self.score[self.piece[i]] if i < outside else self.unknown)
                        if best is None or total >= best:
                            best, take, piece = total, end - k, i
                if not k:
                    break
                k -= 1
                node = children.get(held[k])
                if node is None:
                    break
                i, children = node
            back.append(take)
            last.append(piece)
            if not bpe:
                cost.append(best)
            if end >= longest:
                meet = self._meeting(back, end)
                if meet:
                    yield from self._way(back, last, meet)
                    held, back, last, cost, end = held[meet:], back[meet:], last[meet:], [x - cost[meet] for x in cost[meet:]], end - meet
                    back[0] = 0
        yield from self._way(back, last, end)

    def stream(self, chars: Iterable[str]) -> Iterator[str]:
        """The pieces of :meth:`walk` as text."""
        return map(self._text, self.walk(chars))

    def _meeting(self, back: list[int], end: int) -> int:
        """The last boundary that the ways to all extendable nodes pass."""
        live = set(range(max(0, end - self.longest + 1), end + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - back[last])
        return live.pop()

    @staticmethod
    def _way(back: list[int], last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= back[end]
        return out[::-1]

    # --- texts -------------------------------------------------------------
    def _byte_ids(self, piece: str) -> bytes:
        return b"".join(self.byte[b].to_bytes(4, "little") for b in piece.encode("utf-8", "surrogatepass"))

    def _ids(self, unit: str) -> bytes:
        code, inside = self.code, len(self.piece)
        return b"".join([code[i] if i < inside else self._byte_ids(chr(i - inside)) for i in self.walk(unit)])

    def _unit(self, unit: str) -> bytes:
        ids = self._ids(unit)
        if len(self.units) >= self.table_size:
            self.units.clear()
        if len(unit) <= 64:
            self.units[unit] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a space mark and a word, by its units; remembered."""
        units = self.unit.findall(MARK + word)
        if len(units) == 1:
            ids = self._ids(units[0])
        else:
            get, make = self.units.get, self._unit
            ids = b"".join([get(u) or make(u) for u in units])
        if len(self.words) >= self.table_size:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<i4")
        literal = self._byte_ids(MARK)
        out = []
        for k, part in enumerate(((" " if self.prefix else "") + text).split(MARK)):
            if k:
                out.append(literal)
            words = part.split(" ")
            if self.spaced and "" not in words[1:]:      # a space mark begins a unit, unless another one stands before it
                if words[0]:
                    out += [self.units.get(u) or self._unit(u) for u in self.unit.findall(words[0])]
                get, make = self.words.get, self._word
                out += [get(w) or make(w) for w in words[1:]]
            else:
                get, make = self.units.get, self._unit
                out += [get(u) or make(u) for u in self.unit.findall(part.replace(" ", MARK))]
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids) -> str:
        text = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", rows: int = 256) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip (the ids decode to the same text)."""
    model = docs.sparkSession.sparkContext.broadcast(Pieces(load_model(model_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model.value             # a worker's tasks share what it has learned
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = [t.as_py() or "" for t in part.column(1)]
                ids = [pieces.encode(t) for t in texts]
                same = [pieces.decode(i.tolist()) == t for i, t in zip(ids, texts)]
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends).astype(np.int64)), lists, pa.array(same)],
                                                 ["doc_id", "n_tokens", "ids", "round_trip"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"))


def decode(encoded: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids", rows: int = 256) -> DataFrame:
    """doc_id, text from ids; null or empty ids give the empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(Pieces(load_model(model_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model.value             # a worker's tasks share what it has learned
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([pieces.decode(i.as_py() or []) for i in part.column(1)], pa.string())], ["doc_id", "text"])
    return (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


@register("op8_sentencepiece")
def op8_sentencepiece(spark, sf_dir):
    return encode(read_table(spark, sf_dir, "documents"))
