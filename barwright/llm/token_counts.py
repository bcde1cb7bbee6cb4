"""Token counts of whole texts with a whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges each on its own. Offline, before any text is
read, every vocabulary string is merged once: those that end as one token, and that the splitting
pattern leaves in one piece, are proven to count 1. While counting, a pre-token found among them
needs no merging; only the rest is merged, and a bounded memory keeps the counts of recent ones.

A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results, a null doc_id
stays null, extra columns are ignored, an empty table gives an empty result. Texts are counted
whole, whatever their length.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from barwright.llm.common import Recent, pieces

# The splitting pattern of byte-level BPE vocabularies of this kind: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters and numbers of the newest Unicode tables that the library's tables do not have: fixed values.
NEWER = r"[\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016FF4-\U00016FF6]"
NONE = 1 << 60
# Bytes of recent words that a worker remembers; a quarter as many of pre-tokens.
MEMORY = 96 << 20
# More than any text has tokens; marks words after which a text cannot be cut.
OPEN = 1 << 50


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for
    themselves, the others take the code points from 256 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(printable)))
    return letters


class Vocabulary:
    """Merge ranks of a tokenizer file, and the strings proven to be one token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE without a normalizer is needed")
        if pre["add_prefix_space"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("prefix spaces, dropout and unmerged words are not supported")
        self.letters, ids = byte_letters(), model["vocab"]
        self.byte_ids = [ids[self.letters[b]] for b in range(256)]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        # A pair of ids, 20 bits each, gives the rank of its merge and, in 20 bits, the id made.
        self.made = {ids[a] << 20 | ids[b]: rank << 20 | ids[a + b]
                     for rank, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = regex.compile(PATTERN)
        self.newer = regex.compile(NEWER)
        self.alone = self._prove(model["vocab"])
        # Of a pre-token: 1 for every proven string, merged counts of the rest as they come.
        self.counts = Recent(dict.fromkeys(self.alone, 1), self._merge, MEMORY // 4)
        # Of a word between spaces with the space before it. No pre-token goes from something else
        # into white space, so a text may be cut before each space that ends no white space.
        self.after_space = Recent({}, lambda word: OPEN if self.open(word)
                                  else self.plain(" " + word), MEMORY)

    def _merge(self, word: str) -> int:
        return self.merged(word) if len(word) < 256 else merged_long(self, word)

    def merged(self, word: str) -> int:
        """How many tokens the merges leave of a pre-token."""
        parts = [*map(self.byte_ids.__getitem__, word.encode())]
        made = self.made.get
        best_of = [made(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while best_of and (best := min(best_of)) < NONE:
            i = best_of.index(best)
            del best_of[i], parts[i]
            parts[i] = new = best & 0xFFFFF
            if i:
                best_of[i - 1] = made(parts[i - 1] << 20 | new, NONE)
            if i < len(best_of):
                best_of[i] = made(new << 20 | parts[i + 1], NONE)
        return len(parts)

    def _prove(self, vocabulary: dict[str, int]) -> frozenset[str]:
        bytes_of = {letter: b for b, letter in self.letters.items()}
        proven = []
        for letters in vocabulary:
            try:
                word = bytes(bytes_of[x] for x in letters).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if self.split.findall(word) == [word] and self.merged(word) == 1:
                proven.append(word)
        return frozenset(proven)

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of a text. Code points of NEWER are plain symbols to the library."""
        if text.isascii() or not self.newer.search(text):
            return self.split.findall(text)
        shadow = self.newer.sub("\uffff", text)
        return [text[m.start():m.end()] for m in self.split.finditer(shadow)]

    def count(self, text: str) -> int:
        """Tokens of a text; added tokens inside it count one each, as the library has them."""
        parts, found = [text], 0
        for special in self.special:
            if special in text:
                cut = [part.split(special) for part in parts]
                found += sum(len(p) - 1 for p in cut)
                parts = [x for p in cut for x in p]
        for part in parts:
            first, *rest = part.split(" ")
            tokens = sum(map(self.after_space.__getitem__, rest)) if not self.open(first) else OPEN
            found += tokens + self.plain(first) if tokens < OPEN else self.plain(part)
        return found

    def plain(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.pretokens(text)))

    @staticmethod
    def open(word: str) -> bool:
        """Whether white space ends the word, or it is empty: then a space that follows belongs to
        a longer run, and the text cannot be cut before it."""
        return not word or word[-1].isspace()


def merged_long(vocabulary: Vocabulary, word: str) -> int:
    """The same count for a pre-token of any length in n log n: a heap of pairs over a linked list."""
    parts = [vocabulary.byte_ids[b] for b in word.encode()]
    after = [*range(1, len(parts)), -1]
    before = [*range(-1, len(parts) - 1)]
    made, heap, left = vocabulary.made, [], len(parts)

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0:
            best = made.get(parts[i] << 20 | parts[after[i]])
            if best is not None:
                heapq.heappush(heap, (best >> 20, i, parts[i], parts[after[i]], best & 0xFFFFF))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j < 0 or parts[j] != b:
            continue
        parts[i], parts[j] = new, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        left -= 1
        offer(before[i])
        offer(i)
    return left


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text.

    ``path`` is the tokenizer file; every worker reads its own copy of it once.
    """
    def run(batches):
        count = vocabulary(path).count
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
