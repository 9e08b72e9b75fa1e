"""Degrees, PageRank, connected components and graph summaries.

Edges are (src, dst) tables without duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators import ordered
from affinity.sources.scratch import materialize, materialize_bucketed


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))


def total_degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def degree_table(edges: DataFrame, nodes: DataFrame | None = None, keep_null: bool = False) -> DataFrame:
    """(id, in_degree, out_degree) for all nodes, 0 where there is no edge."""
    base = vertices(edges) if nodes is None else nodes
    joined = base.join(in_degrees(edges), "id", "left").join(out_degrees(edges), "id", "left")
    return joined if keep_null else joined.fillna(0, ["in_degree", "out_degree"])


def adjacency(edges: DataFrame, size: int = 1_000) -> DataFrame:
    """(src, chunk, neighbours): sorted neighbour lists, a hub's in numbered chunks of at most ``size``."""
    return ordered.chunked_lists(edges, ["src"], "dst", size, "neighbours")


def _links(edges: DataFrame, slice_size: int) -> DataFrame:
    """(src, part, dst, w, parts): edges with weight 1/out-degree, and one self row per node (null weight).

    The self row carries a node through the join and aggregate that move the
    ranks, so a round needs no further join. The out-edges of a node are
    numbered into parts of about ``slice_size`` by a hash of their end; its
    self row, in part 0, holds the number of parts.
    """
    degrees = out_degrees(edges).select(F.col("id").alias("src"), "out_degree", F.ceil(F.col("out_degree") / slice_size).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("part")
    weighted = edges.join(degrees, "src").select("src", part, "dst", (F.lit(1.0) / F.col("out_degree")).alias("w"), F.lit(None).cast("int").alias("parts"))
    nodes = vertices(edges).withColumnRenamed("id", "src").join(degrees, "src", "left")
    own = nodes.select("src", F.lit(0).alias("part"), F.col("src").alias("dst"), F.lit(None).cast("double").alias("w"), F.coalesce("parts", F.lit(1)).alias("parts"))
    return weighted.unionByName(own)


def pagerank(
    edges: DataFrame, damping: float = 0.85, iterations: int = 40, tolerance: float | None = None,
    dangling: str = "drop", cut_every: int = 5, slice_size: int = 100_000,
) -> tuple[DataFrame, int]:
    """((id, rank), rounds). Ranks start uniform and sum to 1 unless mass is dropped.

    With a ``tolerance`` the result is that of the first round whose L1 change
    is below it. ``dangling='spread'`` gives the rank of nodes without
    out-edges to all nodes evenly. Lineage is cut every ``cut_every`` rounds
    and the changes of those rounds are summed in one pass.

    The links are written once, bucketed by their source, and stay where they
    are: a round shuffles partial sums only. Where a node has more than
    ``slice_size`` links, buckets go by (src, part), so that none holds more of
    one node, and a round also sends one rank to each node and part.
    """
    edges = materialize(edges.distinct(), "edges")
    parted = (out_degrees(edges).agg(F.max("out_degree")).first()[0] or 0) > slice_size
    keys, parts = (["src", "part"], ["parts"]) if parted else (["src"], [])
    links = materialize_bucketed(_links(edges, slice_size), keys, "links")
    is_self = F.col("w").isNull()
    n = links.filter(is_self).count()
    if n == 0:
        return vertices(edges).withColumn("rank", F.lit(0.0)), 0
    sinks = None
    if dangling == "spread":
        ends = links.filter(is_self).select(F.col("src").alias("id")).join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
        sinks = materialize(ends, "sinks")
        if sinks.isEmpty():
            sinks = None
        else:
            cut_every = 1
    state = links.filter(is_self).select(F.col("src").alias("id"), *parts, F.lit(1.0 / n).alias("r0"))
    done = 0
    while done < iterations:
        steps = min(cut_every, iterations - done)
        lost = 0.0
        if sinks is not None:
            lost = state.join(sinks, "id", "left_semi").agg(F.sum("r0").alias("m")).first()["m"]  # one number
        base = (1.0 - damping) / n + damping * lost / n
        for i in range(1, steps + 1):
            # Earlier ranks are kept for the changes only, with a node's own row.
            earlier = range(i) if tolerance is not None else []
            each = [F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")] if parted else []
            ranks = state.select(F.col("id").alias("src"), *each, *[f"r{j}" for j in sorted({*earlier, i - 1})])
            moved = links.join(ranks, keys)
            carried = [F.max(F.when(is_self, F.col(f"r{j}"))).alias(f"r{j}") for j in earlier]
            flow = F.sum(F.coalesce(F.col(f"r{i - 1}") * F.col("w"), F.lit(0.0)))
            state = moved.groupBy(F.col("dst").alias("id")).agg(*[F.max(c).alias(c) for c in parts], *carried, (F.lit(base) + F.lit(damping) * flow).alias(f"r{i}"))
        state = materialize(state, "ranks")
        taken = steps
        if tolerance is not None:
            changes = state.agg(*[F.sum(F.abs(F.col(f"r{i}") - F.col(f"r{i - 1}"))).alias(f"e{i}") for i in range(1, steps + 1)]).first()
            small = [i for i in range(1, steps + 1) if changes[f"e{i}"] < tolerance]
            if small:
                taken = small[0]
                return state.select("id", F.col(f"r{taken}").alias("rank")), done + taken
        done += taken
        state = state.select("id", *parts, F.col(f"r{taken}").alias("r0"))
    return state.select("id", F.col("r0").alias("rank")), done


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, component): smallest id of each component.

    Alternating large-star and small-star steps link every node to its
    component's minimum in a logarithmic number of rounds; neighbours are only
    ever reduced by ``min``, never collected.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("p")).select("p.u", "p.v")

    def large_star(e: DataFrame) -> DataFrame:
        pairs = both(e)
        least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("_m", "u").alias("m"))
        return pairs.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    def fingerprint(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", "v"))).first())

    links = materialize(edges.filter("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "links")
    before = fingerprint(links)
    while True:
        links = materialize(small_star(large_star(links)), "links")
        after = fingerprint(links)
        if after == before:
            break
        before = after
    base = vertices(edges) if nodes is None else nodes
    root = links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return base.join(root, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def summary(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row: nodes, edges, density and the spread of the ranks."""
    n_edges = edges.agg(F.count(F.lit(1)).alias("m")).scalar()
    stats = ranks.agg(
        F.count(F.lit(1)).alias("n_nodes"), F.avg("rank").alias("mean_rank"), F.stddev_pop("rank").alias("sd_rank"),
        F.min("rank").alias("min_rank"), F.max("rank").alias("max_rank")).withColumn("n_edges", n_edges)
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1)
    return stats.withColumn("density", F.when(pairs > 0, F.col("n_edges") / pairs).otherwise(F.lit(0.0)))


def compare_ranks(left: DataFrame, right: DataFrame, k: int, score: Column | None = None) -> DataFrame:
    """(id, rank_a, rank_b, diff): both ranks of the k first nodes of ``left``."""
    first = left.withColumn("_s", F.round("rank", 9) if score is None else score).orderBy(F.desc("_s"), "id").limit(k)
    joined = first.select("id", F.col("rank").alias("rank_a")).join(right.select("id", F.col("rank").alias("rank_b")), "id")
    return joined.withColumn("diff", F.abs(F.col("rank_a") - F.col("rank_b")))
