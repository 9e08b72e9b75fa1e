"""Repeatable randomness: every draw is a hash of (seed, key), so results do
not change with the partitioning and plain SQL can reproduce them."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: draws are 32-bit.
DRAW_RANGE = 4294967296


def hash32(*parts) -> Column:
    """First 32 bits of md5 over the ':'-joined parts, as a bigint."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash32_each(part: str, values: Column) -> Column:
    """``hash32`` of the part and each string of an array, equal strings of a batch being hashed once; made in Python, where :func:`texts.char_grams` leaves its arrays."""
    class Draws(dict):
        def __missing__(self, value: str) -> int:
            self[value] = x = int(hashlib.md5(f"{part}:{value}".encode()).hexdigest()[:8], 16)
            return x

    def run(arrays: pd.Series) -> pd.Series:
        draw = Draws().__getitem__
        return pd.Series([None if a is None else np.fromiter(map(draw, a), np.int64, len(a)) for a in arrays], dtype=object)

    return F.pandas_udf(run, "array<bigint>")(values)


def uniform(*parts) -> Column:
    """A draw from the open interval (0, 1)."""
    return (hash32(*parts) + F.lit(0.5)) / F.lit(float(DRAW_RANGE))


def hash_bucket(features: Column, n: int, digits: int = 6) -> Column:
    """Hash an array of numbers, each to ``digits`` decimals, to one of ``n`` buckets."""
    scaled = F.transform(features, lambda x: F.round(x * F.lit(10.0**digits)).cast("bigint").cast("string"))
    return F.pmod(hash32("features", F.array_join(scaled, ",")), F.lit(n))
