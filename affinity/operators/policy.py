"""Batch scoring of logged interactions: arm statistics, bandit scores, Q values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import uniform
from affinity.operators import scoring
from affinity.operators.relational import dense_index, top_k
from affinity.sources.scratch import materialize


def arm_stats(logged: DataFrame) -> DataFrame:
    return logged.groupBy("arm").agg(F.count(F.lit(1)).alias("pulls"), F.avg("reward").alias("mean"))


def ucb_scores(logged: DataFrame, arms: DataFrame, c: float = 2.0) -> DataFrame:
    """(arm, pulls, mean, ucb); an arm never pulled has no score and goes first."""
    total = logged.agg(F.count(F.lit(1)).alias("t")).scalar()
    joined = arms.join(arm_stats(logged), "arm", "left").withColumn("_t", total)
    score = F.col("mean") + F.lit(c) * F.sqrt(F.log("_t") / F.col("pulls"))
    return joined.select("arm", F.coalesce("pulls", F.lit(0)).alias("pulls"), "mean", score.alias("ucb"))


def greedy(stats: DataFrame, k: int) -> DataFrame:
    return stats.withColumn("score", F.round("mean", 9)).orderBy(F.desc("score"), "arm").limit(k)


def epsilon_greedy(requests: DataFrame, stats: DataFrame, epsilon: float = 0.1, seed: int = 42) -> DataFrame:
    """requests (id) with the served ``arm`` and whether it was explored."""
    numbered = dense_index(stats, "arm", "_at")
    n = stats.agg(F.count(F.lit(1)).alias("n")).scalar()
    best = greedy(stats, 1).select("arm").scalar()
    drawn = requests.withColumn("explored", uniform(seed, "explore", F.col("id")) < epsilon).withColumn(
        "_at", F.floor(uniform(seed, "arm", F.col("id")) * n).cast("bigint"))
    served = drawn.join(numbered, "_at", "left")
    return served.withColumn("_best", best).withColumn("arm", F.when(F.col("explored"), F.col("arm")).otherwise(F.col("_best"))).drop("_at", "_best")


ARMS_IN_BLOCK = 1000  # arms, and contexts, that are scored together
CELLS = 100  # such chunks in one cell, on the side of the contexts; a fifth of it on that of the arms, which have matrices


def arm_models(contexts: DataFrame, rewards: DataFrame, dims: int) -> DataFrame:
    """(arm, theta, inverse): the ridge solution of each arm, its matrix in rows.

    Only the sums of x x' and r x are grouped, which Spark adds up before the
    shuffle, so an arm with much of the log is no load; the solving runs in the tasks.
    """
    x = [F.col("x")[i] for i in range(dims)]
    upper = [(i, j) for i in range(dims) for j in range(i, dims)]
    sums = rewards.join(contexts, "user_id").groupBy("arm").agg(
        *[F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i, j in upper], *[F.sum(F.col("reward") * x[i]).alias(f"b{i}") for i in range(dims)])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = np.tile(np.eye(dims), (len(batch), 1, 1))
            for i, j in upper:
                a[:, i, j] += batch[f"a{i}_{j}"].to_numpy()
                if i != j:
                    a[:, j, i] += batch[f"a{i}_{j}"].to_numpy()
            inverse = np.linalg.inv(a)
            theta = np.einsum("nij,nj->ni", inverse, batch[[f"b{i}" for i in range(dims)]].to_numpy())
            yield pd.DataFrame({"arm": batch["arm"], "theta": list(theta), "inverse": list(inverse.reshape(len(batch), dims * dims))})

    return sums.mapInPandas(solve, "arm bigint, theta array<double>, inverse array<double>")


def linear_arms(contexts: DataFrame, rewards: DataFrame, dims: int, k: int = 10, alpha: float = 0.5, block: int = ARMS_IN_BLOCK) -> DataFrame:
    """(user_id, arm, score, rank): the best k of all logged arms by upper-confidence linear scores.

    Slices of contexts meet blocks of arms in a grid, whose cells score
    ``block`` contexts and arms at a time; each cell gives its contexts' best k,
    and the best of all blocks are ranked. The rows are the same for any grid,
    and no arm passes the driver.
    """
    models = materialize(arm_models(contexts, rewards, dims), "arms")
    asked = contexts.select(F.col("user_id").cast("bigint").alias("user_id"), "x")
    slices, blocks = scoring.shape(asked, "user_id", models, "arm", block * CELLS, block * CELLS // 5, block)

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, right = left.sort_values("user_id"), right.sort_values("arm")
        arms = right["arm"].to_numpy()
        if not len(left) or not len(right):
            return pd.DataFrame({"user_id": [], "arm": [], "score": []})
        theta, inverse = (np.stack(c.to_numpy()) for c in (right["theta"], right["inverse"]))
        # x' A x as one product: the upper half of x x', twice what is off the diagonal, with that of A.
        upper = np.triu_indices(dims)
        wide = inverse.reshape(len(arms), dims, dims)
        wide = (wide + wide.transpose(0, 2, 1))[:, upper[0], upper[1]] / np.where(upper[0] == upper[1], 2.0, 1.0)
        one = np.ones((len(arms), 1), np.float32)
        flat, spread = theta.astype(np.float32), np.concatenate([wide.astype(np.float32), one], axis=1)
        sizes, widths = np.sqrt((theta * theta).sum(axis=1)), np.sqrt((wide * wide).sum(axis=1))
        step = min(block, max(1, scoring.TOGETHER // block))
        space = np.empty((2, block * step), np.float32)
        best = []
        for at in range(0, len(left), block):
            some = left.iloc[at : at + block]
            ctx, users = np.stack(some["x"].to_numpy()), some["user_id"].to_numpy()
            n, outer = len(ctx), ctx[:, upper[0]] * ctx[:, upper[1]]
            lengths, squares = np.sqrt((ctx * ctx).sum(axis=1)), np.sqrt((outer * outer).sum(axis=1))

            def score(from_: int, bound: np.ndarray):
                """Never lower in single precision: the possible errors are added below the root, where a further column holds them, and taken off the bound."""
                of = slice(from_, from_ + step)
                mean, room = (s[: n * len(theta[of])].reshape(n, -1) for s in space)
                np.matmul(ctx.astype(np.float32), flat[of].T, out=mean)
                error = 2 * scoring.off_by(outer.shape[1], squares, widths[of])
                np.matmul(np.concatenate([outer, error[:, None]], axis=1).astype(np.float32), spread[of].T, out=room)
                np.sqrt(np.maximum(room, 0, out=room), out=room)
                room *= np.float32(alpha * (1 + 1e-6))
                room += mean
                above = room > scoring.lowered(bound - scoring.off_by(dims, lengths, sizes[of]) - 1e-6 * np.abs(bound))
                return (above, lambda r, c: np.einsum("ij,ij->i", ctx[r], theta[of][c]) + alpha * np.sqrt(np.maximum(np.einsum("ij,ij->i", outer[r], wide[of][c]), 0)),
                        lambda: ctx @ theta[of].T + alpha * np.sqrt(np.maximum(outer @ wide[of].T, 0)))

            row, arm, found = scoring.best_in_order(n, len(arms), step, score, k, 6)
            best.append((users[row], arms[arm], found))
        user, arm, score = (np.concatenate(c) for c in zip(*best))
        return pd.DataFrame({"user_id": user, "arm": arm, "score": score})

    met = scoring.grid(asked.withColumn("slice", scoring.part("user_id", slices)), models.withColumn("block", scoring.part("arm", blocks)), slices, blocks)
    return top_k(met.applyInPandas(cell, "user_id bigint, arm bigint, score double"), ["user_id"], [F.desc("score"), "arm"], k)


def batch_q(transitions: DataFrame, gamma: float = 0.9, rounds: int = 5) -> DataFrame:
    """(state, action, q) after value-iteration rounds over logged transitions.

    ``transitions`` is (state, action, reward, next_state), next_state null at
    the end. The log is reduced once to counts per (state, action,
    next_state); the rounds run on that small table.
    """
    moves = materialize(transitions.groupBy("state", "action", "next_state").agg(F.count(F.lit(1)).alias("n"), F.sum("reward").alias("r")), "moves")
    values = None
    for _ in range(rounds):
        if values is None:
            known = moves.withColumn("_v", F.lit(0.0))
        else:
            known = moves.join(values, "next_state", "left")
        q = known.groupBy("state", "action").agg(
            ((F.sum("r") + F.lit(gamma) * F.sum(F.col("n") * F.coalesce("_v", F.lit(0.0)))) / F.sum("n")).alias("q"))
        values = q.groupBy(F.col("state").alias("next_state")).agg(F.max("q").alias("_v"))
    return q


def unit_counts(long: DataFrame, key: str, index: str, value: Column) -> DataFrame:
    """(key, index, x): grouped sums scaled to length one."""
    sums = long.groupBy(key, index).agg(F.sum(value).alias("_s"))
    norms = sums.groupBy(key).agg(F.sqrt(F.sum(F.col("_s") * F.col("_s"))).alias("_n"))
    return sums.join(norms, key).select(key, index, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).otherwise(F.lit(0.0)).alias("x"))
