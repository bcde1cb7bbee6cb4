"""Random draws from a hash of the row's identity.

``rand(seed)`` depends on the partition a row lies in. A hash of (seed, keys, tag) does not, so a
lost task or another cluster size draws the same numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 52


def uniform(seed: int, tag: str, *keys: Column) -> Column:
    """A double strictly between 0 and 1."""
    bits = F.xxhash64(F.lit(seed), F.lit(tag), *keys).bitwiseAND(F.lit((1 << _BITS) - 1))
    return (bits.cast("double") + 0.5) / float(1 << _BITS)


def normal(mean: float, stddev: float, seed: int, tag: str, *keys: Column) -> Column:
    """Box-Muller over two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(seed, tag + ".radius", *keys)))
    angle = F.lit(2.0 * math.pi) * uniform(seed, tag + ".angle", *keys)
    return F.lit(mean) + F.lit(stddev) * radius * F.cos(angle)


def integer(low: int, high: int, seed: int, tag: str, *keys: Column) -> Column:
    """A whole number in ``[low, high)``."""
    return (F.lit(low) + F.floor(uniform(seed, tag, *keys) * (high - low))).cast("long")
