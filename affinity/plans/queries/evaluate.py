"""Ranking and rating metrics of the bias baseline on the held-out ratings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import evaluate as ev, recommend as rc
from affinity.operators.relational import top_k
from affinity.plans import views
from affinity.plans.queries.recommend import BIAS_SQL, SPLIT
from affinity.plans.registry import QUERIES, SQL, query
from affinity.sources.scratch import materialize

K = 5
RECS_SQL = f"""{SPLIT}, {BIAS_SQL}, scored AS (SELECT user_id, item_id, rating, round(cf, 6) AS pred FROM bias),
recs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, item_id) AS rank FROM scored),
truth AS MATERIALIZED (SELECT user_id, item_id FROM test WHERE rating >= 4),
u AS MATERIALIZED (SELECT user_id, n_rel, coalesce(h, 0) AS hits FROM (SELECT user_id, count(*) AS n_rel FROM truth GROUP BY 1)
  LEFT JOIN (SELECT user_id, count(*) AS h FROM recs SEMI JOIN truth USING (user_id, item_id) WHERE rank <= {K} GROUP BY 1) USING (user_id))"""
PR_SQL = f"""{RECS_SQL}, pr AS MATERIALIZED (SELECT user_id, hits, n_rel, hits / {K} AS p, hits / n_rel AS r, CASE WHEN hits > 0 THEN 2 * (hits / {K}) * (hits / n_rel) / (hits / {K} + hits / n_rel) ELSE 0 END AS f1 FROM u)"""


def scored(spark, sf):
    return rc.bias_terms(views.test(spark, sf), views.train(spark, sf)).select("user_id", "item_id", "rating", F.round("cf", 6).alias("pred"))


def recommended(spark, sf, k=K):
    return top_k(scored(spark, sf), ["user_id"], [F.desc("pred"), "item_id"], k)


def relevant(spark, sf):
    return ev.truth(views.test(spark, sf))


@query("truth", f"WITH {RECS_SQL} SELECT user_id, item_id FROM truth")
def truth(spark, sf):
    return relevant(spark, sf)


@query("precision_recall", f"WITH {PR_SQL} SELECT user_id, hits, n_rel AS n_relevant, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM pr")
def precision_recall(spark, sf):
    pr = ev.precision_recall(recommended(spark, sf), relevant(spark, sf), K)
    return pr.select("user_id", "hits", "n_relevant", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("macro_avg", f"WITH {PR_SQL} SELECT count(*) AS n_users, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f1), 6) AS f1 FROM pr")
def macro_avg(spark, sf):
    pr = ev.precision_recall(recommended(spark, sf), relevant(spark, sf), K)
    return pr.agg(F.count(F.lit(1)).alias("n_users"), *[F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")])


@query("thresholded_precision", f"""WITH {RECS_SQL}, c AS (SELECT user_id, count(*) FILTER (WHERE rating >= 4) AS rel, count(*) FILTER (WHERE rank <= {K} AND pred >= 3) AS rec, count(*) FILTER (WHERE rank <= {K} AND pred >= 3 AND rating >= 3) AS met,
  count(*) FILTER (WHERE rating >= 3) AS rel3 FROM recs GROUP BY 1)
SELECT user_id, round(CASE WHEN rec > 0 THEN met / rec ELSE 0 END, 6) AS precision, round(CASE WHEN rel3 > 0 THEN met / rel3 ELSE 0 END, 6) AS recall FROM c""")
def thresholded_precision(spark, sf):
    """Threshold 3, near the mean of these ratings; 4 is the default of the operator."""
    everything = scored(spark, sf)
    best = recommended(spark, sf).select("user_id", "item_id", "rank")
    ranked = everything.join(best, ["user_id", "item_id"], "left")
    return ev.thresholded_precision(ranked, K, 3.0).select("user_id", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("list_precision", f"""WITH {RECS_SQL} SELECT user_id, round(count(t.item_id) / count(*), 6) AS precision, round(count(t.item_id) / {K}, 6) AS recall
FROM recs r LEFT JOIN truth t USING (user_id, item_id) WHERE rank <= {K} GROUP BY 1""")
def list_precision(spark, sf):
    return ev.list_precision(recommended(spark, sf), relevant(spark, sf), K).select("user_id", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("user_report", f"""WITH {PR_SQL}, {views.ITEMS_SQL},
rt AS (SELECT user_id, string_agg(title, ', ' ORDER BY rank) AS recommended FROM recs JOIN items USING (item_id) WHERE rank <= {K} GROUP BY 1),
lt AS (SELECT user_id, string_agg(title, ', ' ORDER BY item_id) AS liked FROM truth JOIN items USING (item_id) GROUP BY 1)
SELECT user_id, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, recommended, liked FROM pr LEFT JOIN rt USING (user_id) LEFT JOIN lt USING (user_id)""")
def user_report(spark, sf):
    recs, wanted = recommended(spark, sf), relevant(spark, sf)
    titles = views.items(spark, sf).select("item_id", "title")

    def joined(df, order, name):
        names = F.transform(F.array_sort(F.collect_list(F.struct(order, "title"))), lambda x: x["title"])
        return df.join(titles, "item_id").groupBy("user_id").agg(F.array_join(names, ", ").alias(name))

    pr = ev.precision_recall(recs, wanted, K)
    return pr.join(joined(recs, "rank", "recommended"), "user_id", "left").join(joined(wanted, "item_id", "liked"), "user_id", "left").select(
        "user_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "recommended", "liked")


@query("rmse", f"WITH {RECS_SQL} SELECT round(sqrt(avg((rating - pred) * (rating - pred))), 6) AS rmse, count(*) AS n FROM scored")
def rmse(spark, sf):
    return ev.rmse(scored(spark, sf)).withColumn("rmse", F.round("rmse", 6))


@query("rmse_const", f"WITH {RECS_SQL} SELECT round(sqrt(avg((4 - pred) * (4 - pred))), 6) AS rmse, count(*) AS n FROM scored WHERE rating >= 4 AND pred <> 0")
def rmse_const(spark, sf):
    liked = scored(spark, sf).filter("rating >= 4 AND pred != 0")
    return ev.rmse(liked, F.lit(4.0)).withColumn("rmse", F.round("rmse", 6))


@query("ndcg", f"""WITH {RECS_SQL}, d AS (SELECT user_id, sum(1 / log2(rank + 1)) AS dcg FROM recs SEMI JOIN truth USING (user_id, item_id) WHERE rank <= {K} GROUP BY 1),
i AS (SELECT user_id, sum(1 / log2(s + 1)) AS ideal FROM u, range(1, {K + 1}) t(s) WHERE s <= n_rel GROUP BY 1)
SELECT user_id, round(coalesce(dcg, 0) / ideal, 6) AS ndcg FROM i LEFT JOIN d USING (user_id)""")
def ndcg(spark, sf):
    return ev.ndcg(recommended(spark, sf), relevant(spark, sf), K).select("user_id", F.round("ndcg", 6).alias("ndcg"))


@query("hit_rate", f"WITH {RECS_SQL} SELECT round(avg(CASE WHEN hits > 0 THEN 1 ELSE 0 END), 6) AS hit_rate FROM u")
def hit_rate(spark, sf):
    return ev.hit_rate(recommended(spark, sf), relevant(spark, sf), K).agg(F.round(F.avg("hit"), 6).alias("hit_rate"))


@query("novelty", f"""WITH {RECS_SQL}, p AS (SELECT item_id, count(*) AS p FROM train GROUP BY 1), n AS (SELECT count(*) AS n FROM train)
SELECT user_id, round(avg(-log2(coalesce(p, 1) / n + 1e-9)), 6) AS novelty FROM recs LEFT JOIN p USING (item_id), n WHERE rank <= {K} GROUP BY 1""")
def novelty(spark, sf):
    return ev.novelty(recommended(spark, sf), views.train(spark, sf), K).select("user_id", F.round("novelty", 6).alias("novelty"))


@query("coverage", f"WITH {RECS_SQL} SELECT round((SELECT count(DISTINCT item_id) FROM recs WHERE rank <= {K}) / (SELECT count(*) FROM part), 6) AS coverage")
def coverage(spark, sf):
    return ev.coverage(recommended(spark, sf), views.items(spark, sf), K).withColumn("coverage", F.round("coverage", 6))


@query("ctr", f"WITH {views.LOGGED_SQL} SELECT event_type, round(avg(CASE WHEN reward > 0 THEN 1 ELSE 0 END), 6) AS ctr FROM logged GROUP BY 1")
def ctr(spark, sf):
    return views.logged(spark, sf).groupBy("event_type").agg(F.round(F.avg((F.col("reward") > 0).cast("double")), 6).alias("ctr"))


@query("model_table", f"""WITH {SPLIT}, {BIAS_SQL},
m AS (SELECT user_id, item_id, rating, unnest(['bias', 'item_mean', 'user_mean']) AS model, unnest([round(cf, 6), round(popularity, 6), round(user_bias, 6)]) AS pred FROM bias),
r AS (SELECT *, row_number() OVER (PARTITION BY model, user_id ORDER BY pred DESC, item_id) AS rank FROM m),
u AS (SELECT model, user_id, count(*) FILTER (WHERE rank <= {K} AND rating >= 4) AS hits, count(*) FILTER (WHERE rating >= 4) AS rel FROM r GROUP BY 1, 2)
SELECT model, (SELECT round(sqrt(avg((rating - pred) * (rating - pred))), 6) FROM m WHERE m.model = u.model) AS rmse, round(avg(hits / {K}), 6) AS precision, round(avg(hits / rel), 6) AS recall FROM u WHERE rel > 0 GROUP BY model""")
def model_table(spark, sf):
    """Several models side by side: one row per model."""
    terms = rc.bias_terms(views.test(spark, sf), views.train(spark, sf))
    named = {"bias": "cf", "item_mean": "popularity", "user_mean": "user_bias"}
    models = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.round(c, 6).alias("pred")) for n, c in named.items()]))
    m = terms.select("user_id", "item_id", "rating", models.alias("m")).select("user_id", "item_id", "rating", "m.*")
    error = F.col("rating") - F.col("pred")
    liked = F.col("rating") >= 4
    errors = m.groupBy("model").agg(F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"))
    found = top_k(m, ["model", "user_id"], [F.desc("pred"), "item_id"], K).groupBy("model", "user_id").agg(F.count_if(liked).alias("hits"))
    rel = m.groupBy("model", "user_id").agg(F.count_if(liked).alias("rel")).filter("rel > 0")
    scores = rel.join(found, ["model", "user_id"]).groupBy("model").agg(
        F.round(F.avg(F.col("hits") / K), 6).alias("precision"), F.round(F.avg(F.col("hits") / F.col("rel")), 6).alias("recall"))
    return errors.join(scores, "model").select("model", "rmse", "precision", "recall")


# The recommenders whose own lists are scored; each list is what its query returns.
RECOMMENDERS = ["user_recs", "item_recs", "profile_recs", "genre_recs", "dense_user_cf", "dense_item_cf"]


@query("recommender_table", f"""WITH {SPLIT},
truth AS MATERIALIZED (SELECT user_id, item_id FROM test WHERE rating >= 4), rel AS (SELECT user_id, count(*) AS n_rel FROM truth GROUP BY 1),
lists AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{name}' AS model, user_id, item_id, rank FROM ({SQL[name]}) WHERE rank <= {K}" for name in RECOMMENDERS)}),
best AS (SELECT user_id, n_rel, sum(1 / log2(s + 1)) AS ideal FROM rel, range(1, {K + 1}) t(s) WHERE s <= n_rel GROUP BY 1, 2),
h AS (SELECT model, user_id, count(*) AS hits, sum(1 / log2(rank + 1)) AS dcg FROM lists SEMI JOIN truth USING (user_id, item_id) GROUP BY 1, 2),
m AS (SELECT model, sum(hits) AS hits, sum(hits / n_rel) AS r, count(*) AS u, sum(dcg / ideal) AS g FROM h JOIN best USING (user_id) GROUP BY 1),
p AS (SELECT item_id, count(*) AS p FROM train GROUP BY 1),
c AS (SELECT model, count(DISTINCT item_id) / (SELECT count(*) FROM part) AS coverage, avg(-log2(coalesce(p, 1) / (SELECT count(*) FROM train) + 1e-9)) AS novelty FROM lists LEFT JOIN p USING (item_id) GROUP BY 1)
SELECT model, n AS n_users, round(coalesce(hits, 0) / n / {K}, 6) AS precision, round(coalesce(r, 0) / n, 6) AS recall, round(coalesce(u, 0) / n, 6) AS hit_rate, round(coalesce(g, 0) / n, 6) AS ndcg,
  round(coverage, 6) AS coverage, round(novelty, 6) AS novelty FROM c LEFT JOIN m USING (model), (SELECT count(*) AS n FROM rel)""")
def recommender_table(spark, sf):
    """Six recommenders by the lists they give, on the held-out ratings."""
    lists = [QUERIES[name](spark, sf).select(F.lit(name).alias("model"), "user_id", "item_id", "rank") for name in RECOMMENDERS]
    table = materialize(reduce(DataFrame.unionByName, lists).filter(F.col("rank") <= K), "lists")
    out = ev.compare(table, materialize(relevant(spark, sf), "truth"), views.train(spark, sf), views.items(spark, sf), K)
    return out.select("model", "n_users", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "hit_rate", "ndcg", "coverage", "novelty")])
