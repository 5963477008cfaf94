"""Seeded, partition-independent randomness.

``rand(seed)`` depends on how rows fall into partitions, so a re-run on another cluster gives another
sample.  Every shuffle, split, sample and draw here uses the md5 text of (seed, purpose, row key): the
same row always gets the same value, and any SQL engine can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(seed: int, purpose: str, *parts: Column) -> Column:
    """Hex text used as a random ordering key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[p.cast("string") for p in parts]).cast("binary"))


def uniform(seed: int, purpose: str, *parts: Column) -> Column:
    """Uniform double in [0, 1): the first 8 hex digits of the hash over 2**32."""
    return F.conv(F.substring(hash_key(seed, purpose, *parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def normal(seed: int, purpose: str, *parts: Column) -> Column:
    """Standard normal draw by the Box-Muller transform."""
    u1 = F.lit(1.0) - uniform(seed, purpose + "_r", *parts)
    u2 = uniform(seed, purpose + "_a", *parts)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
