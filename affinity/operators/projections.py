"""Neighbours of query points by bucketed random projections, checked exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.relational import top_k
from affinity.operators.scoring import grid, part, shape

#: Points on one side of a cell, about.
MOST = 50_000
#: Queries compared with a block together.
IDS = 128
#: Pairs whose distances are taken anew together.
EXACT = 50_000


def signs(dims: int, table: int, place: int, seed: int = 42) -> list[float]:
    """The direction of one projection: a sign for each dimension, from a hash that SQL can repeat."""
    told = (hashlib.md5(f"{seed}:{table}:{place}:{d}".encode()).hexdigest()[:8] for d in range(dims))
    return [1.0 if int(x, 16) % 2 == 0 else -1.0 for x in told]


def cells(v: Column, dims: int, table: int, per_key: int, width: float, seed: int) -> list[Column]:
    """The buckets of a vector in the directions of one table."""
    def along(place: int) -> Column:
        line = F.array(*[F.lit(s) for s in signs(dims, table, place, seed)])
        return F.aggregate(F.zip_with(v, line, lambda x, s: x * s), F.lit(0.0), lambda a, x: a + x)

    return [F.floor(along(place) / F.lit(width)) for place in range(per_key)]


def met(
    points: DataFrame, queries: DataFrame, width: float, keep: Callable[[np.ndarray, np.ndarray, int], np.ndarray],
    tables: int = 3, per_key: int = 2, seed: int = 42, most: int = MOST,
) -> DataFrame:
    """(a, b, distance): of the query points and the others that share or adjoin their bucket in a table, those that ``keep`` selects.

    ``points`` and ``queries`` are (id, v). Every point has one bucket in each
    of ``per_key`` directions of each table; a query meets its own and all
    adjoining buckets. Two points at a distance of ``width`` meet in one
    table with about 72 % at two directions, so in one of three with 98 %.

    Slices of queries meet blocks of points in a grid, whose cells compare
    bucket numbers. ``keep`` gets distances from a matrix product (infinite
    where two points did not meet), their possible errors and how often an id
    may stand in a block; the distances of what it selects are taken anew.
    Points without a whole vector are not met here.
    """
    dims = points.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0
    places = [c for t in range(tables) for c in cells(F.col("v"), dims, t, per_key, width, seed)]

    def keyed(df: DataFrame, side: str, n: int) -> DataFrame:
        return df.select(part("id", n).alias(side), F.col("id").cast("bigint").alias("id"), F.col("v").alias("v"), F.array(*places).alias("at")).filter(~F.exists("at", F.isnull))

    slices, blocks = shape(queries, "id", points, "id", most, most, IDS)

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            (a, x, p), (b, y, q) = ((df["id"].to_numpy(), np.stack(df["v"].to_numpy()), np.stack(df["at"].to_numpy())) for df in (left, right))
            times = int(np.unique(b, return_counts=True)[1].max())
            xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
            for i in range(0, len(a), IDS):
                near = np.zeros((len(a[i : i + IDS]), len(b)), bool)
                for t in range(0, tables * per_key, per_key):
                    near |= np.logical_and.reduce([np.abs(p[i : i + IDS, None, c] - q[None, :, c]) <= 1 for c in range(t, t + per_key)])
                near &= a[i : i + IDS, None] != b[None, :]
                sizes = xx[i : i + IDS, None] + yy[None, :]
                rough = np.sqrt(np.maximum(sizes - 2 * (x[i : i + IDS] @ y.T), 0.0))
                row, col = np.nonzero(near & keep(np.where(near, rough, np.inf), 1e-6 * np.sqrt(sizes), times))
                for j in range(0, len(row), EXACT):
                    r, c = row[j : j + EXACT] + i, col[j : j + EXACT]
                    found.append((a[r], b[c], np.sqrt(((x[r] - y[c]) ** 2).sum(axis=1))))
        one, other, apart = (np.concatenate(f) for f in zip(*found))
        return pd.DataFrame({"a": one, "b": other, "distance": apart})

    return grid(keyed(queries, "slice", slices), keyed(points, "block", blocks), slices, blocks).applyInPandas(cell, "a bigint, b bigint, distance double")


def within(points: DataFrame, queries: DataFrame, most: float, tables: int = 3, per_key: int = 2) -> DataFrame:
    """(a, b, distance): points up to ``most`` away from query points, with buckets as wide as that."""
    pairs = met(points, queries, most, lambda rough, error, times: rough <= most + error, tables, per_key)
    return pairs.filter(F.col("distance") <= most).dropDuplicates(["a", "b"])


def nearest(points: DataFrame, queries: DataFrame, k: int, width: float, tables: int = 3, per_key: int = 2) -> DataFrame:
    """(a, b, distance, rank): the k nearest of the points that a query meets; distances are compared to six decimals."""
    def closest(rough: np.ndarray, error: np.ndarray, times: int) -> np.ndarray:
        if rough.shape[1] <= k * times:
            return np.isfinite(rough)
        return rough <= np.partition(rough, k * times - 1, axis=1)[:, k * times - 1 : k * times] + 2 * error + 2e-6

    once = met(points, queries, width, closest, tables, per_key).groupBy("a", "b").agg(F.min("distance").alias("distance"))
    # Points without a vector have each other, at an unknown distance: the first k + 1 of them are enough.
    blank = points.filter("v IS NULL").select(F.col("id").cast("bigint").alias("b")).distinct().orderBy("b").limit(k + 1)
    lost = queries.filter("v IS NULL").select(F.col("id").cast("bigint").alias("a")).distinct().join(blank, F.col("a") != F.col("b"))
    once = once.unionByName(lost.withColumn("distance", F.lit(None).cast("double")))
    return top_k(once, ["a"], [F.round("distance", 6), "b"], k)
