"""Influence edges, degrees, PageRank and components."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import graph, relational
from affinity.plans import views
from affinity.plans.queries.relational import DEGREES_SQL, RANGE_SQL, REACH
from affinity.plans.registry import query
from affinity.sources.scratch import materialize

E = views.EDGES_SQL


@query("influence_edges", f"WITH {RANGE_SQL} SELECT src, dst FROM infl")
def influence_edges(spark, sf):
    return relational.range_successors(views.firsts(spark, sf), "author", "first_day", REACH)


@query("degrees", f"""WITH {DEGREES_SQL}
(SELECT 'out' AS side, src AS author, out_degree AS degree FROM outd ORDER BY 3 DESC, 2 LIMIT 5) UNION ALL (SELECT 'in', dst, in_degree FROM ind ORDER BY 3 DESC, 2 LIMIT 5)""")
def degrees(spark, sf):
    """Top 5 of each side, from per-day counts: the edges are never formed."""
    d = relational.range_degrees(views.firsts(spark, sf), "author", "first_day", REACH)

    def top(side):
        column = f"{side}_degree"
        return d.filter(F.col(column) > 0).orderBy(F.desc(column), "author").limit(5).select(F.lit(side).alias("side"), "author", F.col(column).alias("degree"))

    return top("out").unionByName(top("in"))


@query("degree_table", f"""WITH {E}, n AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
SELECT id, coalesce((SELECT count(*) FROM edges WHERE dst = id), 0) AS in_degree, coalesce((SELECT count(*) FROM edges WHERE src = id), 0) AS out_degree FROM n""")
def degree_table(spark, sf):
    return graph.degree_table(views.edges(spark, sf))


@query("total_degree", f"WITH {E} SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def total_degree(spark, sf):
    return graph.total_degrees(views.edges(spark, sf)).orderBy(F.desc("degree"), "id").limit(5)


@query("adjacency", f"""WITH {E}, r AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 1000 AS chunk FROM edges)
SELECT src, chunk, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours, count(*) AS n FROM r GROUP BY 1, 2""")
def adjacency(spark, sf):
    a = graph.adjacency(views.edges(spark, sf))
    return a.select("src", "chunk", F.array_join(F.col("neighbours").cast("array<string>"), ",").alias("neighbours"), F.size("neighbours").cast("bigint").alias("n"))


def pagerank_sql(damping: float, rounds: int, tolerance: float | None = None, spread: bool = False, edges: str = E) -> str:
    """Unrolled rounds; with a tolerance, later rounds repeat the first settled one."""
    d, parts = f"CAST({damping} AS DOUBLE)", [edges]
    parts.append("nodes AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)")
    parts.append("cnt AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)")
    parts.append("links AS MATERIALIZED (SELECT src, dst, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY src) AS w FROM edges)")
    parts.append("r0 AS MATERIALIZED (SELECT id, 1 / n AS rank, CAST(1 AS DOUBLE) AS e FROM nodes, cnt)")
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        lost = f" + {d} * (SELECT coalesce(sum(rank), 0) FROM {p} WHERE id NOT IN (SELECT src FROM edges)) / n" if spread else ""
        new = f"(1 - {d}) / n{lost} + {d} * coalesce(s, 0)"
        parts.append(f"t{i} AS MATERIALIZED (SELECT p.id, p.rank AS old, {new} AS new FROM {p} p LEFT JOIN (SELECT dst, sum(rank * w) AS s FROM links JOIN {p} ON id = src GROUP BY 1) ON dst = p.id, cnt)")
        if tolerance is None:
            parts.append(f"r{i} AS MATERIALIZED (SELECT id, new AS rank FROM t{i})")
        else:
            parts.append(f"r{i} AS MATERIALIZED (SELECT t.id, CASE WHEN p.e < {tolerance} THEN t.old ELSE t.new END AS rank, CASE WHEN p.e < {tolerance} THEN p.e ELSE (SELECT sum(abs(new - old)) FROM t{i}) END AS e FROM t{i} t JOIN {p} p USING (id))")
    return ",\n".join(parts)


@query("pagerank_fixed", f"WITH {pagerank_sql(0.8, 40)} SELECT id, round(rank, 9) AS rank FROM r40")
def pagerank_fixed(spark, sf):
    return graph.pagerank(views.edges(spark, sf), 0.8, 40)[0].select("id", F.round("rank", 9).alias("rank"))


@query("pagerank_converged", f"WITH {pagerank_sql(0.85, 30, 1e-6)} SELECT id, round(rank, 9) AS rank FROM r30")
def pagerank_converged(spark, sf):
    """Stops at the first round whose L1 change is below 1e-6 (at most 100 rounds)."""
    return graph.pagerank(views.edges(spark, sf), 0.85, 100, tolerance=1e-6)[0].select("id", F.round("rank", 9).alias("rank"))


# Edges up the id order only: the last nodes have no way out.
UP_SQL = "edges AS MATERIALIZED (SELECT * FROM all_edges WHERE src < dst)"
UP_EDGES = E.replace("edges AS", "all_edges AS", 1) + ",\n" + UP_SQL


@query("pagerank_spread", f"WITH {pagerank_sql(0.85, 10, spread=True, edges=UP_EDGES)} SELECT id, round(rank, 9) AS rank FROM r10")
def pagerank_spread(spark, sf):
    """The rank of nodes without out-edges goes to all nodes; edges up the id order have such nodes."""
    up = views.edges(spark, sf).filter("src < dst")
    return graph.pagerank(up, 0.85, 10, dangling="spread")[0].select("id", F.round("rank", 9).alias("rank"))


@query("pagerank_sum_n", f"WITH {pagerank_sql(0.85, 10)} SELECT id, round(rank * n, 6) AS rank FROM r10, cnt")
def pagerank_sum_n(spark, sf):
    """The unnormalised form: ranks sum to the number of nodes."""
    ranks = graph.pagerank(views.edges(spark, sf), 0.85, 10)[0]
    n = ranks.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranks.select("id", F.round(F.col("rank") * n, 6).alias("rank"))


@query("rank_compare", f"""WITH {pagerank_sql(0.85, 10)}
SELECT a.id, row_number() OVER (ORDER BY round(a.rank, 9) DESC, a.id) AS position, round(a.rank, 9) AS rank_a, round(b.rank, 9) AS rank_b, round(abs(a.rank - b.rank), 9) AS diff
FROM r10 a JOIN r5 b USING (id) QUALIFY position <= 10""")
def rank_compare(spark, sf):
    e = materialize(views.edges(spark, sf), "edges")
    ten, five = graph.pagerank(e, 0.85, 10)[0], graph.pagerank(e, 0.85, 5)[0]
    both = graph.compare_ranks(ten, five, 10)
    ranked = relational.top_k(both.withColumn("one", F.lit(1)), ["one"], [F.desc(F.round("rank_a", 9)), "id"], 10, rank="position")
    return ranked.select("id", "position", *[F.round(c, 9).alias(c) for c in ("rank_a", "rank_b", "diff")])


@query("graph_summary", f"""WITH {pagerank_sql(0.85, 5)}
SELECT count(*) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges, round((SELECT count(*) FROM edges) / (count(*) * (count(*) - 1)), 9) AS density,
  round(avg(rank), 9) AS mean_rank, round(stddev_pop(rank), 9) AS sd_rank, round(min(rank), 9) AS min_rank, round(max(rank), 9) AS max_rank FROM r5""")
def graph_summary(spark, sf):
    e = materialize(views.edges(spark, sf), "edges")
    s = graph.summary(e, graph.pagerank(e, 0.85, 5)[0])
    return s.select("n_nodes", "n_edges", *[F.round(c, 9).alias(c) for c in ("density", "mean_rank", "sd_rank", "min_rank", "max_rank")])


# Chains of close first days make several components.
CHAIN = 2
CHAIN_SQL = f"""{views.FIRSTS_SQL}, k AS MATERIALIZED (SELECT CAST(substr(author, 10) AS BIGINT) AS id, first_day FROM firsts),
marked AS (SELECT id, first_day, CASE WHEN first_day - lag(first_day) OVER (ORDER BY first_day, id) <= {CHAIN} THEN 0 ELSE 1 END AS fresh FROM k),
grouped AS (SELECT id, sum(fresh) OVER (ORDER BY first_day, id ROWS UNBOUNDED PRECEDING) AS g FROM marked)"""


@query("components", f"WITH {CHAIN_SQL} SELECT id, min(id) OVER (PARTITION BY g) AS component FROM grouped")
def components(spark, sf):
    """Suppliers linked when their first days are at most two apart, directly or through others."""
    k = views.firsts(spark, sf).select(F.substring("author", 10, 20).cast("bigint").alias("id"), "first_day")
    days = k.groupBy("first_day").agg(F.min("id").alias("head"))
    # One edge from each supplier to its day's first, and one between the heads of near days.
    same = k.join(days, "first_day").select(F.col("id").alias("src"), F.col("head").alias("dst"))
    near = relational.range_successors(days.withColumnRenamed("head", "id"), "id", "first_day", CHAIN)
    return graph.connected_components(same.unionByName(near), k.select("id"))


def labels_sql(rounds: int) -> str:
    parts = ["l0 AS MATERIALIZED (SELECT src AS id, src AS label FROM edges UNION SELECT dst, dst FROM edges)",
             "sym AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)"]
    parts += [f"l{i} AS MATERIALIZED (SELECT p.id, least(p.label, min(q.label)) AS label FROM l{i - 1} p JOIN sym ON src = p.id JOIN l{i - 1} q ON q.id = dst GROUP BY p.id, p.label)" for i in range(1, rounds + 1)]
    return ",\n".join(parts)


@query("components_edges", f"WITH {E}, {labels_sql(8)} SELECT label AS component, count(*) AS n_nodes FROM l8 GROUP BY 1")
def components_edges(spark, sf):
    """Component sizes of the purchase graph (it is connected)."""
    c = graph.connected_components(views.edges(spark, sf))
    return c.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
