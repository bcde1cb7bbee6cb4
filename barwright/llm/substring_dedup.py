"""Substring dedup: repeated windows of words, counted exactly in buckets of super-k-mers.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is its longest word, of several
the one with the smallest hash: long words are rare ones, so few windows share one by chance.
Consecutive windows with the same minimiser overlap but for one word each, so they travel together as one packed string (a super-k-mer, the words joined by a
space) to the bucket of their minimiser: equal windows have equal minimisers and meet there. A bucket
sorts its windows by a hash, compares the words of neighbours that are equal in it, and flags every
window that also starts in a document with a smaller doc_id. The flags of a string travel back as the
bits of one number; each word that a flagged window covers goes.

* Buckets get their number from a count of all strings, so that one holds about ``BUCKET``. A task
  packs what it sends to a bucket in parcels.
* Hot minimisers: those with more than max(``HOT``, a millionth of all) strings, found by a count over
  all documents, have no bucket. Their strings are grouped by their words instead, each task sending one
  row for equal ones; the windows of the distinct strings are grouped likewise, and every occurrence
  takes the first documents of its windows by a join, which Spark splits where it is skewed. The
  list of hot minimisers has at most 2^20 numbers. A minimiser that no task holds twice in
  ``COUNTED`` strings is not counted; it has at most one string in so many.

Windows are judged on the input, not on what is left. A null text has no words; what stays is ''. A
null doc_id counts as 2^63 - 1, the largest; rows of one doc_id never remove words of each other, so
repeated rows lose the same words. Long texts are cut in stretches of ``STRETCH`` words that overlap, so
that memory does not follow them before the last step. Only doc_id and text are read, so other
columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import pieces, stored, text_key

WINDOW = 13
# Windows of a string at most: their flags are bits of a long.
LONGEST = 32
STRETCH = 50_000
# Strings of a bucket; of a minimiser that counts as hot; that a task counts at once.
BUCKET, HOT, COUNTED = 1 << 16, 4096, 1 << 20
# Bytes of text that are hashed at once, that are cut at once, and whose strings a parcel is made of.
HASHED, CUT, PACKED = 1 << 19, 1 << 20, 1 << 23
LAST_ID = 2**63 - 1
STEP = np.uint64(0x9E3779B97F4A7C15)
LETTERS = np.random.default_rng(12).integers(0, 2**64, 256, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end]; words follow one another with one byte between."""
    found = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(end, start[first] + HASHED, "right")))
        low, size = start[first], end[first:last] - start[first:last]
        at = np.arange(end[last - 1] - low) - np.repeat(
            start[first:last] - low, np.r_[size[:-1] + 1, size[-1]])
        steps = np.cumprod(np.r_[np.uint64(1), np.full(size.max(), STEP)])
        # The byte between words stands behind its word and is multiplied away.
        values = LETTERS[data[low:end[last - 1]]] * steps[at]
        values[end[first:last - 1] - low] = 0
        found[first:last] = mixed(np.add.reduceat(values, start[first:last] - low)
                                  + size.astype(np.uint64))
        first = last
    return found


def hashes_of(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive words, from those of the words, by doubling."""
    parts, power, done, total = words, STEP, 0, None
    while k >> done:
        size = 1 << done
        if k & size:
            if total is None:
                total, had = parts, size
            else:
                n = len(words) - had - size + 1
                total = total[:n] * power + parts[had:had + n] if n > 0 else words[:0]
                had += size
        n = max(0, len(parts) - size)
        parts, done = parts[:n] * power + parts[size:size + n], done + 1
        power = np.uint64(int(power) ** 2 % 2**64)
    return mixed(total[:max(0, len(words) - k + 1)])


def least_of(values: np.ndarray, k: int) -> np.ndarray:
    """The least of each ``k`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= k:
        values = np.minimum(values[:-size], values[size:]) if len(values) > size else values[:0]
        size *= 2
    rest = k - size
    return np.minimum(values[:-rest], values[rest:]) if rest and len(values) > rest else \
        values if not rest else values[:0]


class Strings:
    """The super-k-mers of some stretches of words, as arrays with one entry for each: the number
    of the ``text``, ``pos`` of its first word, ``windows``, and ``key``, the minimiser."""

    def __init__(self, stretches: list[tuple[int, int, list[bytes]]]):
        long = [s for s in stretches if len(s[2]) >= WINDOW]
        self.data = b" ".join(b" ".join(words) for _, _, words in long)
        sizes = np.array([len(words) for _, _, words in long], np.int64)
        self.start, self.end = word_bounds(self.data)
        if not long:
            self.key, self.word = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.windows = self.text = self.pos = np.zeros(0, np.int32)
            return
        marks = word_hashes(np.frombuffer(self.data, np.uint8), self.start, self.end)
        longest = (255 - np.minimum(self.end - self.start, 255)).astype(np.uint64)
        least = least_of(longest << np.uint64(56) | marks >> np.uint64(8), WINDOW)
        first = np.r_[0, np.cumsum(sizes)[:-1]]
        counts = sizes - WINDOW + 1
        offset = np.repeat(first, counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        least = least[offset + within]
        new = (within == 0) | np.r_[True, least[1:] != least[:-1]]
        begins = np.flatnonzero(new)
        run = np.arange(len(new)) - np.repeat(begins, np.diff(np.r_[begins, len(new)]))
        begins = np.flatnonzero(run % LONGEST == 0)
        self.windows = np.diff(np.r_[begins, len(new)]).astype(np.int32)
        self.word, self.key = (offset + within)[begins], least[begins]
        stretch = np.repeat(np.arange(len(long)), counts)[begins]
        self.text = np.array([s[0] for s in long])[stretch]
        self.pos = (np.array([s[1] for s in long])[stretch] + within[begins]).astype(np.int32)

    def packed(self, chosen: np.ndarray) -> list[bytes]:
        """The words of the chosen strings."""
        start = self.start[self.word[chosen]]
        end = self.end[self.word[chosen] + self.windows[chosen] + WINDOW - 2]
        return [self.data[a:b] for a, b in zip(start.tolist(), end.tolist())]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end, with one space between them and none around."""
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return (np.r_[0, spaces + 1], np.r_[spaces, len(data)]) if data else (spaces, spaces)


def strings_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Strings]]:
    """Some rows of doc and text_key, and the strings of their texts, again and again."""
    def taken():
        return pa.Table.from_batches(rows).combine_chunks().to_batches()[0], Strings(stretches)

    rows, stretches, size, n = [], [], 0, 0
    for batch in pieces(batches, 64):
        rows.append(batch.select(["doc", "text_key"]))
        for text in batch.column("text").to_pylist():
            words = text.split()
            for at in range(0, max(1, len(words) - WINDOW + 1), STRETCH):
                stretches.append((n, at, words[at:at + STRETCH + WINDOW - 1]))
                size += len(text)
            n += 1
        if size > CUT:
            yield taken()
            rows, stretches, size, n = [], [], 0, 0
    if rows:
        yield taken()


def doc_order(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(LAST_ID))


def readable(docs: DataFrame) -> DataFrame:
    return docs.select(doc_order().cast("long").alias("doc"), text_key().alias("text_key"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def hot_minimisers(docs: DataFrame, least: int = HOT) -> tuple[int, frozenset[int]]:
    """How many strings there are, and the minimisers of too many of them."""
    def run(batches):
        held, total = [], 0

        def counted():
            keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64),
                                return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys[n > 1].view(np.int64)),
                                               pa.array(n[n > 1])], ["key", "n"])

        for _, strings in strings_of(batches):
            held.append(strings.key)
            total += len(strings.key)
            if sum(map(len, held)) > COUNTED:
                yield counted()
                held = []
        yield counted()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], ["key", "n"])

    counts = stored(readable(docs).mapInArrow(run, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")), "substring-minimisers")
    total = counts.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    # Fewer than 2^20 can have more than a millionth of all.
    hot = counts.where("key IS NOT NULL").where(F.col("n") > max(least, total >> 20))
    return total, frozenset(r["key"] for r in hot.select("key").toLocalIterator())


def _is_hot(hot: frozenset[int]):
    among = np.sort(np.array([*hot], np.int64))
    return lambda keys: np.isin(keys.view(np.int64), among)


def planes(values: np.ndarray) -> bytes:
    """The numbers byte by byte, first all lowest bytes, so that they compress."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, n: int, kind: type, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()


class Parcel:
    """Strings on their way: doc, text_key, pos and windows of each, and their words."""

    COLUMNS = {"doc": np.int64, "text_key": np.int64, "pos": np.int32, "windows": np.uint8}

    def __init__(self, **columns: np.ndarray):
        self.columns = {c: columns[c].astype(kind) for c, kind in self.COLUMNS.items()}

    def part(self, low: int, high: int, words: list[bytes]) -> bytes:
        return b"".join([planes(values[low:high]) for values in self.columns.values()]
                        + [b" ".join(words[low:high])])

    @classmethod
    def read(cls, data: bytes, n: int) -> tuple[list[np.ndarray], bytes]:
        at, columns = 0, []
        for kind in cls.COLUMNS.values():
            columns.append(from_planes(data, n, kind, at))
            at += columns[-1].nbytes
        return columns, data[at:]


def parcels(docs: DataFrame, buckets: int, hot: frozenset[int]) -> DataFrame:
    """bucket, and the n strings that go there, compressed together."""
    is_hot = _is_hot(hot)

    def packed(held):
        codec = pa.Codec("zstd", 6)
        bucket, words = (np.concatenate([h[i] for h in held]) for i in (0, 2))
        order = np.argsort(bucket, kind="stable")
        bucket, words = bucket[order], words[order].tolist()
        parcel = Parcel(**{c: np.concatenate([h[1][c] for h in held])[order] for c in held[0][1]})
        ends = np.flatnonzero(np.r_[bucket[1:] != bucket[:-1], True]) + 1
        parts = [parcel.part(a, b, words) for a, b in zip([0, *ends.tolist()], ends.tolist())]
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[ends - 1]), pa.array(np.diff(np.r_[0, ends])),
            pa.array([len(p) for p in parts], pa.int64()),
            pa.array([codec.compress(p, asbytes=True) for p in parts], pa.binary())],
            ["bucket", "n", "size", "packed"])

    def run(batches):
        held, size = [], 0
        for rows, strings in strings_of(batches):
            chosen = np.flatnonzero(~is_hot(strings.key))
            if not len(chosen):
                continue
            words = np.empty(len(chosen), object)
            words[:] = strings.packed(chosen)
            text = strings.text[chosen]
            held.append(((mixed(strings.key[chosen]) % np.uint64(buckets)).astype(np.int64), {
                "doc": rows.column("doc").to_numpy()[text], "pos": strings.pos[chosen],
                "text_key": rows.column("text_key").to_numpy()[text],
                "windows": strings.windows[chosen]}, words))
            size += len(strings.data)
            if size > PACKED:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return readable(docs).mapInArrow(run, "bucket long, n long, size long, packed binary")


def windows_at(windows: np.ndarray) -> np.ndarray:
    """The number of the first word of each window, strings following one another."""
    words = windows + (WINDOW - 1)
    shift = (np.cumsum(words) - words) - (np.cumsum(windows) - windows)
    return np.repeat(shift, windows) + np.arange(windows.sum())


def repeated(data: bytes, windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each string the bits of those of its windows that a smaller doc holds as well."""
    at = windows_at(windows)
    start, end = word_bounds(data)
    marks = hashes_of(word_hashes(np.frombuffer(data, np.uint8), start, end), WINDOW)[at]
    doc = np.repeat(doc, windows)
    order = np.argsort(marks)
    marks = marks[order]
    begins = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
    lengths = np.diff(np.r_[begins, len(marks)])
    ranked = doc[order]
    least = np.minimum.reduceat(ranked, begins)
    # Only windows that may stand in two documents are compared word by word.
    twice = np.repeat(least < np.maximum.reduceat(ranked, begins), lengths)
    run, first = np.repeat(np.arange(len(begins)), lengths)[twice], np.repeat(least, lengths)[twice]
    low, high = start[at[order[twice]]], end[at[order[twice]] + WINDOW - 1]
    keys = [data[a:b] for a, b in zip(low.tolist(), high.tolist())]
    same = np.fromiter(map(eq, keys[1:], keys[:-1]), bool, max(0, len(keys) - 1))
    ranked = ranked[twice]
    for odd in np.unique(run[1:][~same & (run[1:] == run[:-1])]).tolist():
        # One hash for different words: here the words decide.
        members, firsts = np.flatnonzero(run == odd).tolist(), {}
        for i in members:
            firsts[keys[i]] = min(firsts.get(keys[i], ranked[i]), ranked[i])
        first[members] = [firsts[keys[i]] for i in members]
    flags = np.zeros(len(at), np.int64)
    flags[order[twice]] = ranked > first
    begins = np.cumsum(windows) - windows
    within = np.arange(len(at)) - np.repeat(begins, windows)
    return np.bitwise_or.reduceat(flags << within, begins)


def _bucket_flags(key, rows):
    """doc, text_key, pos and bits of the strings of a bucket with flagged windows."""
    codec = pa.Codec("zstd")
    columns, words = zip(*(Parcel.read(codec.decompress(p, size, asbytes=True), n) for n, size, p in zip(
        *(rows.column(c).to_pylist() for c in ("n", "size", "packed")))))
    doc, text, pos, windows = map(np.concatenate, zip(*columns))
    bits = repeated(b" ".join(words), windows.astype(np.int64), doc)
    has = bits != 0
    return pa.table({"doc": doc[has], "text_key": text[has], "pos": pos[has], "bits": bits[has]})


def cold_flags(docs: DataFrame, total: int, hot: frozenset[int]) -> DataFrame:
    return parcels(docs, max(1, total // BUCKET), hot).groupBy("bucket").applyInArrow(
        _bucket_flags, "doc long, text_key long, pos int, bits long")


def hot_flags(docs: DataFrame, hot: frozenset[int]) -> DataFrame:
    """The same for strings of hot minimisers, without a bucket."""
    is_hot = _is_hot(hot)

    def cut(batches):
        for rows, strings in strings_of(batches):
            chosen = np.flatnonzero(is_hot(strings.key))
            if len(chosen):
                text = pa.array(strings.text[chosen])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc").take(text), rows.column("text_key").take(text),
                     pa.array(strings.pos[chosen]), pa.array(strings.packed(chosen), pa.binary())],
                    ["doc", "text_key", "pos", "packed"])

    def unpack(batches):
        for batch in pieces(batches, 4096):
            words = [p.split(b" ") for p in batch.column("packed").to_pylist()]
            counts = np.array([len(w) - WINDOW + 1 for w in words], np.int64)
            of = pa.array(np.repeat(np.arange(len(words)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("packed").take(of),
                 pa.array(np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)),
                 pa.array([b" ".join(w[i:i + WINDOW]) for w in words
                           for i in range(len(w) - WINDOW + 1)], pa.binary()),
                 batch.column("least").take(of), batch.column("most").take(of)],
                ["packed", "at", "words", "least", "most"])

    occurrences = stored(readable(docs).mapInArrow(
        cut, "doc long, text_key long, pos int, packed binary"), "substring-hot")
    strings = occurrences.groupBy("packed").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    windows = stored(strings.mapInArrow(
        unpack, "packed binary, at long, words binary, least long, most long"), "substring-windows")
    # Both are written, as Spark splits a skewed side of a join only where it comes from a plain shuffle.
    firsts = stored(windows.groupBy("words").agg(
        F.min("least").alias("first"), F.max("most").alias("most")).where("first < most"),
        "substring-firsts")
    found = stored(windows.select("packed", "at", "words").join(firsts, "words").groupBy("packed").agg(
        F.collect_list(F.struct("at", "first")).alias("firsts")), "substring-found")  # at most LONGEST
    bits = F.expr("aggregate(firsts, 0L, (b, w) -> b | if(w.first < doc, shiftleft(1L, cast(w.at AS int)), 0L))")
    return occurrences.join(found, "packed").select(
        "doc", "text_key", "pos", bits.alias("bits")).where("bits <> 0")


def flags_of(docs: DataFrame, least: int = HOT) -> DataFrame:
    """doc, text_key and flags (pos and bits of each string with flagged windows) of the texts that lose
    words."""
    total, hot = hot_minimisers(docs, least)
    rows = cold_flags(docs, total, hot)
    if hot:
        rows = rows.unionByName(hot_flags(docs, hot))
    # No more flags than a text has words.
    return rows.groupBy("doc", "text_key").agg(F.collect_list(F.struct("pos", "bits")).alias("flags"))


def covered(pos: np.ndarray, bits: np.ndarray, words: int) -> np.ndarray:
    """Which of the words the flagged windows cover."""
    string, at = np.nonzero(bits[:, None] >> np.arange(LONGEST) & 1)
    starts = pos[string] + at
    edges = np.bincount(starts, minlength=words + 1) - np.bincount(starts + WINDOW, minlength=words + 1)
    return np.cumsum(edges[:words]) > 0


def with_kept_words(docs: DataFrame, least: int = HOT) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with n_words, n_removed and kept, the words
    that stay with one space between them."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    flags = flags_of(docs, least)
    joined = rows.join(flags, (doc_order(F.col("row.doc_id")).cast("long") == F.col("doc"))
                       & (text_key(F.col("row.text")) == F.col("text_key")), "left").select(
        "row", F.col("flags.pos").alias("pos"), F.col("flags.bits").alias("bits"))

    def run(batches):
        for batch in pieces(batches):
            n_words, n_removed, kept = [], [], []
            texts = pc.struct_field(batch.column("row"), "text").cast(pa.binary())
            for text, pos, bits in zip(texts, batch.column("pos"), batch.column("bits")):
                words, gone = (text.as_py() or b"").split(), 0
                n_words.append(len(words))
                if pos.is_valid:
                    cover = covered(pos.values.to_numpy(), bits.values.to_numpy(), len(words))
                    words = [words[i] for i in np.flatnonzero(~cover).tolist()]
                    gone = int(cover.sum())
                n_removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())], ["row", "n_words", "n_removed", "kept"])

    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {kind}, n_words long, n_removed long, kept binary") \
        .withColumn("kept", F.col("kept").cast("string"))


def remove_repeats(docs: DataFrame, least: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every text."""
    return with_kept_words(docs.select("doc_id", "text"), least).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SUBSTRING_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS w FROM starts),
flagged AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, p + unnest(range(13)) AS i FROM flagged),
words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
left_over AS (
  SELECT w.doc_id, count(g.i) AS n_removed,
         string_agg(word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN left_over USING (doc_id)
"""
