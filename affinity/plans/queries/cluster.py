"""k-center, k-means++, objective and assignment on the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import cluster
from affinity.plans import views
from affinity.plans.registry import query

P = views.POINTS_SQL


def dist(v: str = "p.v", c: str = "c.v") -> str:
    return f"round(pow(list_distance({v}, {c}), 2), 9)"


def kcenter_sql(k: int, prefix: str = "k") -> str:
    parts = [f"{prefix}c0 AS MATERIALIZED (SELECT 0 AS center, id, v FROM points ORDER BY id LIMIT 1)",
             f"{prefix}d0 AS MATERIALIZED (SELECT p.id, p.v, {dist()} AS d FROM points p, {prefix}c0 c)"]
    for i in range(1, k):
        parts.append(f"{prefix}c{i} AS MATERIALIZED (SELECT {i} AS center, id, v FROM {prefix}d{i - 1} ORDER BY d DESC, id LIMIT 1)")
        parts.append(f"{prefix}d{i} AS MATERIALIZED (SELECT p.id, p.v, least(p.d, {dist()}) AS d FROM {prefix}d{i - 1} p, {prefix}c{i} c)")
    parts.append(f"{prefix}cs AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {prefix}c{i}' for i in range(k))})")
    return ",\n".join(parts)


def kpp_sql(k: int, source: str, prefix: str = "s", seed: int = 42) -> str:
    u0 = views.uniform_sql(f"'{seed}'", "0", "id")
    parts = [f"{prefix}c0 AS MATERIALIZED (SELECT 0 AS center, id, v FROM {source} ORDER BY {u0}, id LIMIT 1)",
             f"{prefix}d0 AS MATERIALIZED (SELECT p.id, p.v, {dist()} AS d FROM {source} p, {prefix}c0 c)"]
    for i in range(1, k):
        u = views.uniform_sql(f"'{seed}'", str(i), "id")
        parts.append(f"{prefix}c{i} AS MATERIALIZED (SELECT {i} AS center, id, v FROM {prefix}d{i - 1} WHERE d > 0 ORDER BY round(-ln({u}) / d, 9), id LIMIT 1)")
        parts.append(f"{prefix}d{i} AS MATERIALIZED (SELECT p.id, p.v, least(p.d, {dist()}) AS d FROM {prefix}d{i - 1} p, {prefix}c{i} c)")
    parts.append(f"{prefix}cs AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {prefix}c{i}' for i in range(k))})")
    return ",\n".join(parts)


def points(spark, sf):
    return views.points(spark, sf).select("id", "v")


@query("k_center", f"WITH {P}, {kcenter_sql(10)} SELECT center::BIGINT AS center, id FROM kcs")
def k_center(spark, sf):
    return cluster.k_center(points(spark, sf), 10).select("center", "id")


@query("kmeanspp", f"WITH {P}, {kpp_sql(10, 'points')} SELECT center::BIGINT AS center, id FROM scs")
def kmeanspp(spark, sf):
    return cluster.k_means_pp(points(spark, sf), 10).select("center", "id")


@query("cluster_objective", f"WITH {P}, {kpp_sql(10, 'points')} SELECT round(avg(d), 6) AS objective FROM sd9")
def cluster_objective(spark, sf):
    p = points(spark, sf)
    return cluster.objective(p, cluster.k_means_pp(p, 10)).select(F.round("objective", 6).alias("objective"))


@query("coreset", f"""WITH {P}, {kcenter_sql(50)}, {kpp_sql(10, 'kcs')}, a AS (SELECT p.id, min({dist()}) AS d FROM points p, scs c GROUP BY 1)
SELECT round(avg(d), 6) AS objective FROM a""")
def coreset(spark, sf):
    p = points(spark, sf)
    return cluster.objective(p, cluster.coreset(p, 50, 10)).select(F.round("objective", 6).alias("objective"))


@query("assign", f"""WITH {P}, {kcenter_sql(10)}, a AS (SELECT p.id, c.center, {dist()} AS d FROM points p, kcs c)
SELECT id, center::BIGINT AS center, round(d, 6) AS d FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY a.d, center) = 1""")
def assign(spark, sf):
    p = points(spark, sf)
    return cluster.assign(p, cluster.k_center(p, 10)).select("id", "center", F.round("d", 6).alias("d"))
