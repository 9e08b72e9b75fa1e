"""k-center, k-means++ seeding, objective and assignment over (id, v) points.

Only the k chosen centers travel through the driver. A round is one scan with
vectorised distances and a one-row aggregate. The least distance of every point
so far is written every few rounds, so that a round measures the centers chosen
since then only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions.hashing import uniform
from affinity.sources.scratch import materialize

CENTERS = "center bigint, id bigint, v array<double>"
ROUNDS_KEPT = 8  # rounds after which the least distances are written
PLACES = 9  # distances are compared after rounding, ties go to the smallest id


def _nearest(centers: list[list[float]]):
    """Column function: struct(d, center) of the closest center."""
    c = np.asarray(centers, dtype=float)

    @F.pandas_udf(T.StructType([T.StructField("d", T.DoubleType()), T.StructField("center", T.LongType())]))
    def nearest(v: pd.Series) -> pd.DataFrame:
        if len(v) == 0:
            return pd.DataFrame({"d": [], "center": []})
        x = np.stack(v.to_numpy())
        d = np.empty((len(x), len(c)))
        for j in range(len(c)):
            d[:, j] = ((x - c[j]) ** 2).sum(axis=1)
        d = np.round(d, PLACES)
        at = d.argmin(axis=1)
        return pd.DataFrame({"d": d[np.arange(len(x)), at], "center": at})

    return nearest


def assign(points: DataFrame, centers: DataFrame) -> DataFrame:
    """points with ``center`` (number of the closest) and squared distance ``d``."""
    rows = [r["v"] for r in centers.orderBy("center").collect()]  # k rows
    return points.withColumn("_n", _nearest(rows)(F.col("v"))).select(*points.columns, F.col("_n.center").alias("center"), F.col("_n.d").alias("d"))


def objective(points: DataFrame, centers: DataFrame) -> DataFrame:
    """One row: mean squared distance to the closest center."""
    return assign(points, centers).agg(F.avg("d").alias("objective"))


def _grow(points: DataFrame, first, k: int, best) -> DataFrame:
    chosen, fresh = [first], [first]
    held = points.select("id", "v", F.lit(float("inf")).alias("least"))
    while len(chosen) < k:
        d = F.least(F.col("least"), _nearest([c["v"] for c in fresh])(F.col("v"))["d"])
        measured = held.select("id", "v", d.alias("d"))
        if len(fresh) == ROUNDS_KEPT:
            measured = materialize(measured, "least")
            held, fresh = measured.withColumnRenamed("d", "least"), []
        following = measured.agg(best(len(chosen)).alias("p")).first()["p"]  # one point
        if following is None:
            break
        chosen.append(following)
        fresh.append(following)
    rows = [(i, c["id"], c["v"]) for i, c in enumerate(chosen)]
    return points.sparkSession.createDataFrame(rows, CENTERS)


def k_center(points: DataFrame, k: int) -> DataFrame:
    """Farthest-first traversal from the smallest id: (center, id, v)."""
    first = points.agg(F.min(F.struct("id", "v")).alias("p")).first()["p"]

    def farthest(_: int) -> Column:
        return F.max_by(F.struct("id", "v"), F.struct("d", -F.col("id")))

    return _grow(points, first, k, farthest)


def k_means_pp(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """D-squared sampling without collecting weights: the smallest -ln(u)/D^2 wins."""
    race = F.struct(uniform(seed, 0, F.col("id")), F.col("id"))
    first = points.agg(F.min_by(F.struct("id", "v"), race).alias("p")).first()["p"]

    def sampled(number: int) -> Column:
        time = F.when(F.col("d") > 0, F.round(-F.log(uniform(seed, number, F.col("id"))) / F.col("d"), PLACES))
        return F.min_by(F.struct("id", "v"), F.when(time.isNotNull(), F.struct(time, F.col("id"))))

    return _grow(points, first, k, sampled)


def coreset(points: DataFrame, k_wide: int, k: int, seed: int = 42) -> DataFrame:
    """k-means++ centers drawn from a k-center summary of the points."""
    return k_means_pp(k_center(points, k_wide).select("id", "v"), k, seed)
