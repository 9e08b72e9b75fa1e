"""Guarded scalar expressions (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, fallback=0.0) -> Column:
    other = fallback if isinstance(fallback, Column) else F.lit(float(fallback))
    return F.when(denominator != 0, numerator / denominator).otherwise(other)


def clamp(column: Column, low: float = 0.5, high: float = 5.0) -> Column:
    return F.greatest(F.least(column, F.lit(high)), F.lit(low))


def reward(rating: Column, liked_from: float = 4.0) -> Column:
    """+1 for a liked item, -1 for a disliked one, 0 for an unrated one."""
    return F.when(rating >= liked_from, 1.0).when(rating < liked_from, -1.0).otherwise(0.0)


def linear_decay(step: Column, start: float, end: float, total_steps: int) -> Column:
    return F.greatest(F.lit(end), F.lit(start) - F.lit(start - end) * step / F.lit(float(total_steps)))


def lsh_probability(similarity: Column, rows: Column, bands: Column) -> Column:
    """Chance that a pair meets in at least one band."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(similarity, rows), bands)


def lsh_threshold(rows: Column, bands: Column) -> Column:
    return F.pow(F.lit(1.0) / bands, F.lit(1.0) / rows)
