"""Encoding and decoding with a BPE piece model, as shortest paths of weighted transducers.

Three transducers are compiled from the model file and composed with each input:

* the normaliser puts a space mark in front and turns spaces into marks,
* the pieces turn a run of symbols into the id of a piece,
* the byte fallback turns a symbol that is no piece into the ids of its bytes.

Weights lie in the tropical semiring: a path adds its weights and the smallest sum wins. The state
after a piece remembers that piece. An arc weighs 0 if merging by score would leave its piece and
the remembered one side by side, otherwise infinity. Merging leaves exactly one cut of any prefix,
so at each position exactly one state has a finite weight, and the search of the shortest path never
comes to a position twice with hope. Where no piece has a mark after another symbol, no piece crosses the place
before a run of marks, and the input is composed run by run; recent runs are remembered.

Decoding runs the pieces the other way: marks become spaces, runs of byte ids become text (bytes
that are no UTF-8 become U+FFFD each), the space in front goes.

Models are BPE with byte fallback and without a character map. Others raise ValueError: Unigram models,
whose arcs would have scores of their own to add up, normalisers that map or drop characters,
user-defined and unused pieces.

A null text has null ids and a null decoded text; an empty one has no ids. Repeated rows give
repeated results, other columns than doc_id and text are ignored, an empty table gives an empty
result. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import Recent, pieces

MARK = "▁"
# Bytes of recent runs that a worker remembers, and pairs of pieces.
MEMORY = 128 << 20
PAIRS = 500_000
# The state at the start and after bytes, where nothing merges with what stands before.
APART = (1 << 20) - 1
# Kinds of pieces and of models in the file format: fixed values.
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
BPE = 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in protobuf's wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class PieceModel:
    """The transducers of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(fields(file.read()))
        trainer, normalizer = ({n: v for number, data in model if number == part
                                for n, v in fields(data)} for part in (2, 3))
        if trainer.get(3, 1) != BPE or not trainer.get(35):
            raise ValueError("a BPE model with byte fallback is needed")
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("a normaliser that maps or drops characters is not supported")
        self.prefix, self.marks = normalizer.get(3, 1), normalizer.get(5, 1)
        self.pieces, self.ids, self.scores, self.bytes = [], {}, {}, {}
        for number, data in model:
            if number == 1:
                part = dict(fields(data))
                self._add(part[1].decode(), struct.unpack("<f", part.get(2, bytes(4)))[0],
                          part.get(3, NORMAL))
        self._compile_merges()
        self.texts = ["" if kind in (CONTROL, BYTE) else " ⁇ " if kind == UNKNOWN
                      else piece.replace(MARK, " ") for piece, kind in self.pieces]
        self.fallback = np.zeros(len(self.pieces), bool)
        self.fallback[[*self.bytes.values()]] = True
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.sizes = {i: len(p) for p, i in self.ids.items()} | {APART: 1}
        self.longest = max(map(len, self.ids))
        # From a beginning of pieces by a symbol to the id of the piece, or -1, and what goes on.
        self.trie: dict = {}
        for piece, number in self.ids.items():
            node = self.trie
            for symbol in piece[:-1]:
                node = node.setdefault(symbol, [-1, {}])[1]
            node.setdefault(piece[-1], [-1, {}])[0] = number
        runs = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.run = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if runs else ".+", re.DOTALL)
        self.recent = Recent({}, self.shortest, MEMORY)
        self.weights: dict[int, bool] = {}

    def _add(self, piece: str, score: float, kind: int) -> None:
        if kind == USER:
            raise ValueError("user-defined pieces are not supported")
        if kind in (NORMAL, UNUSED):
            if kind == UNUSED:
                raise ValueError("unused pieces are not supported")
            self.ids[piece], self.scores[piece] = len(self.pieces), score
        elif kind == BYTE:
            self.bytes[int(piece[1:-1], 16)] = len(self.pieces)
        self.pieces.append((piece, kind))

    def normalised(self, text: str) -> str:
        text = " " + text if self.prefix and text else text
        return text.replace(" ", MARK) if self.marks else text

    def _compile_merges(self) -> None:
        """Rank and result of every merge of two pieces; equal scores share a rank."""
        ranks = {score: n for n, score in enumerate(sorted({*self.scores.values()}, reverse=True))}
        self.rank_of, self.made_of, ids = {}, {}, self.ids
        for piece, number in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    self.rank_of[left << 20 | right] = ranks[self.scores[piece]]
                    self.made_of[left << 20 | right] = number

    def merged(self, symbols: str) -> list[int]:
        """What merging leaves of known symbols: best score first, then leftmost."""
        parts = [*map(self.ids.__getitem__, symbols)]
        rank, none = self.rank_of.get, 1 << 60
        ranks = [rank(a << 20 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            new = self.made_of[parts[i] << 20 | parts[i + 1]]
            del ranks[i], parts[i]
            parts[i] = new
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | new, none)
            if i < len(ranks):
                ranks[i] = rank(new << 20 | parts[i + 1], none)
        return parts

    def finite(self, state: int, piece: int) -> bool:
        """Whether the arc of ``piece`` from ``state`` has a finite weight."""
        if state == APART:
            found = self.merged(self.pieces[piece][0]) == [piece]
        else:
            found = self.merged(self.pieces[state][0] + self.pieces[piece][0]) == [state, piece]
        if len(self.weights) >= PAIRS:
            self.weights.clear()
        self.weights[state << 20 | piece] = found
        return found

    def shortest(self, run: str) -> bytes:
        """Output of the shortest path of the composition with ``run``, as 32-bit ids.

        Depth first, longest arcs first. As a position has one state at most, a position that led
        nowhere once is closed for good.
        """
        trie, longest, known, sizes = self.trie, self.longest, self.weights.get, self.sizes
        end = len(run)
        path, closed, at, state = [], None, 0, APART
        while at < end:
            arcs, node = [], trie
            for symbol in run[at:at + longest]:
                step = node.get(symbol)
                if step is None:
                    break
                piece, node = step
                if piece >= 0:
                    arcs.append(piece)
            if not arcs:
                # No piece: the symbol goes to its bytes, and nothing merges with it.
                path.append(APART)
                at, state = at + 1, APART
                continue
            while arcs:
                piece = arcs.pop()
                weight = known(state << 20 | piece)
                if weight is None:
                    weight = self.finite(state, piece)
                if weight and not (closed and at + sizes[piece] in closed):
                    path.append(piece)
                    at, state = at + sizes[piece], piece
                    break
            else:
                closed = closed or set()
                closed.add(at)
                at -= sizes[path.pop()]
                state = path[-1] if path else APART
        if APART not in path:
            return array("i", path).tobytes()
        out, at = array("i"), 0
        for piece in path:
            out.extend([piece] if piece != APART else [self.bytes[b] for b in run[at].encode()])
            at += sizes[piece]
        return out.tobytes()

    def encode(self, text: str) -> np.ndarray:
        runs = self.run.findall(self.normalised(text))
        return np.frombuffer(b"".join(map(self.recent.__getitem__, runs)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. Control pieces have no text."""
        if self.fallback[ids].any():
            text, pending = [], bytearray()
            for i in [*ids.tolist(), -1]:
                if i in self.byte_of:
                    pending.append(self.byte_of[i])
                    continue
                if pending:
                    text.append(readable(bytes(pending)))
                    pending.clear()
                text.append(self.texts[i] if i >= 0 else "")
            out = "".join(text)
        else:
            out = "".join(map(self.texts.__getitem__, ids.tolist()))
        # The mark of the normaliser goes, if the first piece with text brought one.
        first = next((i for i in ids.tolist() if self.fallback[i] or self.texts[i]), None)
        marked = first is not None and not self.fallback[first] and self.texts[first][0] == " "
        return out[1:] if self.prefix and marked and self.pieces[first][1] == NORMAL else out


def readable(data: bytes) -> str:
    """UTF-8 as text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in range(1, 5):
                try:
                    out.append(data[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def ids_of(column: pa.Array) -> list[np.ndarray | None]:
    """The rows of a list column as arrays."""
    flat, ends = column.flatten().to_numpy(), np.cumsum(pa.compute.fill_null(
        pa.compute.list_value_length(column), 0).to_numpy())
    return [None if null else flat[end - size:end] for null, end, size in zip(
        column.is_null().to_pylist(), ends, np.diff(ends, prepend=0))]


def lists_of(ids: list[np.ndarray | None]) -> pa.Array:
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in ids)])
    offsets = pa.array(ends, pa.int32(), mask=np.array([*(x is None for x in ids), False]))
    parts = [x for x in ids if x is not None]
    return pa.ListArray.from_arrays(offsets, np.concatenate(parts) if parts else
                                    pa.array([], pa.int32()))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int), n_bytes (ids that stand for bytes) and text, which is decoded
    from the ids again, of every row."""
    def run(batches):
        model = piece_model(path)
        for batch in pieces(batches, 256):
            ids = [None if t is None else model.encode(t)
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), lists_of(ids),
                pa.array([None if x is None else int(model.fallback[x].sum()) for x in ids],
                         pa.int64()),
                pa.array([None if x is None else model.decode(x) for x in ids], pa.string()),
            ], ["doc_id", "ids", "n_bytes", "text"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_bytes long, text string")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids. Ids outside the model fail the job."""
    def run(batches):
        model = piece_model(path)
        for batch in pieces(batches, 256):
            texts = [None if x is None else model.decode(x) for x in ids_of(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", rows["ids"].cast("array<int>").alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, n_bytes, ids and decoded_sha256 (of the decoded ids) of every text."""
    return encoded(docs, path).select(
        "doc_id", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_tokens"),
        "n_bytes", "ids", F.sha2("text", 256).alias("decoded_sha256"))
