"""What several operators of this folder need."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator
from functools import reduce
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.session import scratch_dir

# ASCII white space as the contracts spell it: space and \t \n \v \f \r. Python's bytes.split() cuts at the same.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: list[list[str]] = []


@contextlib.contextmanager
def stored_inside() -> Iterator[list[str]]:
    """The paths of what is stored inside, for a caller that knows when they are read no more."""
    paths: list[str] = []
    _STORED.append(paths)
    try:
        yield paths
    finally:
        _STORED.remove(paths)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the folder that all executors share, and read back.

    Later steps read files instead of running the plan again, also after executors are lost. The
    files stay until this process ends, because the returned frame is lazy, unless a caller removes
    them (:func:`stored_inside`).
    """
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    for paths in _STORED:
        paths.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that long texts never pile up. At the end memory
    that is free goes back to the system: Spark's workers live on for other tasks and stages."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        batch = None  # else it stays until the next one is there
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library is glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_key(text: str | Column = "text") -> Column:
    """Tells apart rows that share a doc_id. Null and empty texts count as the same text."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def learns(doc_id: str = "doc_id") -> Column:
    """Rows that a classifier may learn from: crc32 of the id as text, mod 3, is not 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(True))


def bounded_sample(rows: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """All rows, or about ``most`` of them chosen by a hash of ``key`` when there are more."""
    count = rows.count()
    if count <= most:
        return rows
    return rows.where(sample_hash(key) < most * 2**63 // count)


def sample_hash(*keys: str) -> Column:
    """A number of 63 bits."""
    return F.xxhash64(F.lit("sample"), *keys).bitwiseAND(F.lit(2**63 - 1))


def same(left: Column, right: Column, *more: Column) -> Column:
    """Null-safe equality of pairs of columns, for joins on keys that may be null."""
    columns = [left, right, *more]
    return reduce(lambda a, b: a & b, (columns[i].eqNullSafe(columns[i + 1])
                                       for i in range(0, len(columns), 2)))


class Recent(dict):
    """A dict that makes what is missing and forgets all it made when that takes over ``most`` bytes.
    What it is given at the start it keeps, and strings over 64 letters it never remembers."""

    # Of an entry in the dict and in the list of what was made.
    ENTRY = 120

    def __init__(self, given, make, most):
        super().__init__(given)
        self.make, self.made, self.most, self.bytes = make, [], most, 0

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= 64:
            if self.bytes >= self.most:
                for old in self.made:
                    del self[old]
                self.made, self.bytes = [], 0
            self[word] = value
            self.made.append(word)
            self.bytes += getsizeof(word) + getsizeof(value) + self.ENTRY
        return value


def bounded_broadcast(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """``rows`` marked for a broadcast if a count finds at most ``most`` of them; else as they are, so
    that the join shuffles."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows
