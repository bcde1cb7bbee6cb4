"""The state of stored tables: numbers of loads, what was worked in, layout, versions of schemas.

It is one small text below the root, with a row for each source and not for each load, so it does not
grow with their number. Every change makes the next version of it: a file of that number is put in
place only if there is none yet, so of two drivers that change it at once one succeeds and the other
reads again and repeats its change. A few old versions stay for readers that are about to open them.

That takes a file system whose renames (HDFS) or links (local) refuse to replace a file. In an
object store without such a rename, one driver at a time may write.
"""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from barwright.session import file_names, place_once, read_text, remove

# Spark passes over folders whose names begin so.
FOLDER = "_state"
KEPT_VERSIONS = 4
ATTEMPTS = 200


class StateConflictError(RuntimeError):
    """Other drivers changed the state again and again while this one tried to."""


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = file_names(spark, f"{root.rstrip('/')}/{FOLDER}")
    return sorted(int(name.removesuffix(".json")) for name in names
                  if name.endswith(".json") and name[0].isdigit())


def _path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:012d}.json"


def _read(spark: SparkSession, root: str) -> tuple[int, dict]:
    for _ in range(ATTEMPTS):
        versions = _versions(spark, root)
        if not versions:
            return 0, {}
        try:
            return versions[-1], json.loads(read_text(spark, _path(root, versions[-1])))
        except Py4JJavaError as gone:  # removed by a driver that went on by some versions
            if "FileNotFound" not in str(gone.java_exception):
                raise
    raise StateConflictError(f"the state below {root} changes faster than it can be read")


def read_state(spark: SparkSession, root: str) -> dict:
    """The state of now; empty if nothing was written yet."""
    return _read(spark, root)[1]


def change_state(spark: SparkSession, root: str, change: Callable[[dict], Any]) -> Any:
    """Let ``change`` work on the state and keep what it made; returns what it returned.

    It may be called several times, with the state as others left it. A change that leaves everything
    as it was writes nothing.
    """
    for attempt in range(ATTEMPTS):
        version, state = _read(spark, root)
        before = json.dumps(state, sort_keys=True)
        result = change(state)
        after = json.dumps(state, sort_keys=True)
        if after == before:
            return result
        if place_once(spark, _path(root, version + 1), after):
            for old in _versions(spark, root):
                if old <= version + 1 - KEPT_VERSIONS:
                    remove(spark, _path(root, old))
            return result
        time.sleep(random.random() * 0.01 * (1 + min(attempt, 20)))
    raise StateConflictError(f"{os.getpid()}: no change of the state below {root} was the first")


# Numbers are kept as ranges, since loads are numbered in a row.

def in_ranges(number: int, ranges: list[list[int]]) -> bool:
    return any(low <= number <= high for low, high in ranges)


def as_ranges(numbers: list[int]) -> list[list[int]]:
    ranges: list[list[int]] = []
    for number in sorted(set(numbers)):
        if ranges and ranges[-1][1] == number - 1:
            ranges[-1][1] = number
        else:
            ranges.append([number, number])
    return ranges


def without(ranges: list[list[int]], number: int) -> list[list[int]]:
    cut = []
    for low, high in ranges:
        if low <= number <= high:
            cut += [[a, b] for a, b in ((low, number - 1), (number + 1, high)) if a <= b]
        else:
            cut.append([low, high])
    return cut
