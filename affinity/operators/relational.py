"""Joins, rankings and reports that the other operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators.ordered import quantiles
from affinity.sources.scratch import materialize

PART_ROWS = 1_000_000  # rows that are grouped or joined in one task, about


def most_active(df: DataFrame, user: str, item: str, n_users: int, n_items: int) -> DataFrame:
    """The sub-matrix of the most active users and most rated items."""
    def busiest(key: str, n: int) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), key).limit(n).select(key)

    return df.join(busiest(user, n_users), user, "left_semi").join(busiest(item, n_items), item, "left_semi")


def top_k(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """First k rows per key; Spark limits each group before its shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def dealt(df: DataFrame, rows: int, *keys: str, join: bool = False) -> DataFrame:
    """``df`` of about so many rows in parts by its keys whose size, and so a task's memory, does not grow with the input.

    With ``join`` the rows are about to be joined on the keys, which shuffles
    them into the session's number of partitions unless they lie in more.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, int(rows // PART_ROWS) + 1)
    if join and parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(parts, *keys)


def rows_met(left: DataFrame, right: DataFrame, key: str) -> int:
    """Number of rows of the equi-join of both sides, from their counts per key."""
    n, m = (df.groupBy(key).agg(F.count(F.lit(1)).alias(c)) for df, c in ((left, "_n"), (right, "_m")))
    return n.join(m, key).agg(F.coalesce(F.sum(F.col("_n") * F.col("_m")), F.lit(0))).first()[0]


def range_successors(df: DataFrame, key: str, at: str, reach: int, names: tuple[str, str] = ("src", "dst")) -> DataFrame:
    """Ordered pairs with ``a.at < b.at <= a.at + reach``, as an equi-join.

    Each left row lists its ``reach`` possible positions, so only true pairs
    are formed. The right rows of a position are dealt over all cores, each of
    which meets all of its left rows, so the pairs of a hot position are made
    in many tasks. Degrees need no pairs at all: see :func:`range_degrees`.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    every = F.explode(F.sequence(F.lit(0), F.lit(cores - 1))).alias("_part")
    left = df.select(F.col(key).alias(names[0]), F.explode(F.sequence(F.col(at) + 1, F.col(at) + reach)).alias("_at")).select(names[0], "_at", every)
    right = df.select(F.col(key).alias(names[1]), F.col(at).alias("_at"), F.pmod(F.xxhash64(key), F.lit(cores)).cast("int").alias("_part"))
    left, right = (side.repartition(4 * cores, "_at", "_part") for side in (left, right))
    return left.join(right, ["_at", "_part"]).filter(F.col(names[0]) != F.col(names[1])).drop("_at", "_part")


def range_degrees(df: DataFrame, key: str, at: str, reach: int) -> DataFrame:
    """Out- and in-degree of the range graph from per-position counts, without its edges."""
    per_position = df.groupBy(F.col(at).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    spread = per_position.select(F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("_d"), "_at", "_n")
    out = spread.groupBy((F.col("_at") - F.col("_d")).alias("_at")).agg(F.sum("_n").alias("out_degree"))
    into = spread.groupBy((F.col("_at") + F.col("_d")).alias("_at")).agg(F.sum("_n").alias("in_degree"))
    positioned = df.withColumn("_at", F.col(at))
    return positioned.join(out, "_at", "left").join(into, "_at", "left").drop("_at")


def fill_missing_median(df: DataFrame, column: str) -> DataFrame:
    """Nulls become the exact median of the column."""
    median = quantiles(df, [], column, {"m": 0.5}).select("m").scalar()
    return df.withColumn(column, F.coalesce(F.col(column), median))


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population std per column; a constant column becomes 0."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    scaled = df.join(F.broadcast(stats))  # one row
    for c in columns:
        m, s = F.col(f"_m_{c}"), F.col(f"_s_{c}")
        scaled = scaled.withColumn(c, F.when(s != 0, (F.col(c) - m) / s).otherwise(F.lit(0.0)))
    return scaled.drop(*[f"_{n}_{c}" for c in columns for n in "ms"])


def dense_index(df: DataFrame, key: str, out: str = "idx") -> DataFrame:
    """Distinct keys with consecutive numbers from 0, in key order.

    The keys are range-partitioned and only per-partition counts are combined,
    so no task sees all keys.
    """
    keys = df.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key)
    placed = materialize(keys.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "index")
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.join(bases, "_part").select(key, (F.col("_base") + F.col("_id") - F.col("_first")).cast("bigint").alias(out))


def multi_hot(tags: DataFrame, key: str, tag: str) -> DataFrame:
    """(key, hot, size): the ascending places of each key's tags in the sorted vocabulary of all tags, and its size.

    The vocabulary is learned from the rows; a vector is kept as its places of ones.
    """
    places = dense_index(tags, tag, "_at")
    size = places.agg(F.count(F.lit(1)).alias("n")).scalar()
    held = tags.select(key, tag).distinct().join(places, tag).groupBy(key).agg(F.sort_array(F.collect_list("_at")).alias("hot"))
    return held.withColumn("size", size)


def confusion(estimated: DataFrame, truth: DataFrame, keys: list[str], weight: Column | None = None) -> DataFrame:
    """False positives, false negatives and hits between two pair sets."""
    w = "_w"
    e = estimated.select(*keys, (weight if weight is not None else F.lit(1)).alias(w), F.lit(True).alias("_e"))
    t = truth.select(*keys, (weight if weight is not None else F.lit(1)).alias("_wt"), F.lit(True).alias("_t"))
    both = e.join(t, keys, "full")
    size = F.coalesce(w, "_wt")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, size)), F.lit(0)).cast("bigint")

    return both.agg(
        total(F.col("_e").isNotNull() & F.col("_t").isNull()).alias("false_pos"),
        total(F.col("_e").isNull() & F.col("_t").isNotNull()).alias("false_neg"),
        total(F.col("_e").isNotNull() & F.col("_t").isNotNull()).alias("hits"),
    )
