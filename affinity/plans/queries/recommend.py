"""Content, neighbourhood and baseline recommenders on the interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import arrays, texts
from affinity.operators import explain, overlap, recommend as rc
from affinity.operators.relational import dense_index, top_k
from affinity.plans import views
from affinity.plans.registry import query
from affinity.sources.scratch import materialize

SPLIT, TAGS = views.SPLIT_SQL, views.TAGS_SQL

VECTORS_SQL = f"""{TAGS}, nt AS (SELECT count(DISTINCT item_id) AS n FROM tags),
vec AS MATERIALIZED (SELECT item_id, t.tag, ln((nt.n + 1) / (d.df + 1)) AS w FROM tags t JOIN (SELECT tag, count(*) AS df FROM tags GROUP BY 1) d USING (tag), nt),
unitv AS MATERIALIZED (SELECT item_id, tag, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM vec)"""


def vectors(spark, sf, weight="idf"):
    return rc.item_vectors(views.item_tags(spark, sf), weight)


@query("content_neighbours", f"""WITH {VECTORS_SQL}, q AS (SELECT tag, w AS wq FROM unitv WHERE item_id = 1)
SELECT item_id, round(sum(w * wq), 6) AS cosine FROM unitv JOIN q USING (tag) WHERE item_id <> 1 GROUP BY 1 ORDER BY cosine DESC, item_id LIMIT 5""")
def content_neighbours(spark, sf):
    return rc.similar_items(vectors(spark, sf), 1)


PROFILE_SQL = f"""{SPLIT}, {VECTORS_SQL},
profile AS MATERIALIZED (SELECT user_id, tag, sum(rating * w) / any_value(total) AS x FROM train JOIN (SELECT user_id, sum(rating) AS total FROM train GROUP BY 1) USING (user_id) JOIN vec USING (item_id) GROUP BY 1, 2)"""


@query("user_profile", f"WITH {PROFILE_SQL} SELECT user_id, tag, round(x, 6) AS x FROM profile")
def user_profile(spark, sf):
    return rc.user_profiles(views.train(spark, sf), vectors(spark, sf)).select("user_id", "tag", F.round("x", 6).alias("x"))


@query("profile_recs", f"""WITH {PROFILE_SQL}, pn AS (SELECT user_id, tag, x / sqrt(sum(x * x) OVER (PARTITION BY user_id)) AS x FROM profile),
s AS (SELECT user_id, item_id, round(sum(x * w), 6) AS score FROM pn JOIN unitv USING (tag) GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM s ANTI JOIN train USING (user_id, item_id) QUALIFY rank <= 5""")
def profile_recs(spark, sf):
    v = materialize(vectors(spark, sf), "vectors")
    ratings = materialize(views.train(spark, sf), "train")
    return rc.profile_recommendations(rc.user_profiles(ratings, v), v, 5, seen=ratings)


@query("genre_recs", f"""WITH {SPLIT}, {TAGS}, g AS MATERIALIZED (SELECT item_id, tag, 1 / sqrt(count(*) OVER (PARTITION BY item_id)) AS w FROM tags),
z AS MATERIALIZED (SELECT user_id, tag, sum(w) AS x FROM train JOIN g USING (item_id) WHERE rating >= 4 GROUP BY 1, 2),
s AS (SELECT user_id, item_id, round(sum(x * w), 6) AS score FROM z JOIN g USING (tag) GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM s ANTI JOIN train USING (user_id, item_id) QUALIFY rank <= 10""")
def genre_recs(spark, sf):
    return rc.liked_sum_recommendations(views.train(spark, sf), vectors(spark, sf, "one"), 10)


# --- neighbourhoods -----------------------------------------------------------------

def co_sql(table: str, key: str, by: str, name: str = "co") -> str:
    return f"""{name} AS MATERIALIZED (SELECT a, b, count(*) AS n, sum(x)::BIGINT AS sx, sum(y)::BIGINT AS sy, sum(x * x)::BIGINT AS sxx, sum(y * y)::BIGINT AS syy, sum(x * y)::BIGINT AS sxy
  FROM (SELECT p.{key} AS a, q.{key} AS b, CAST(p.rating * 2 AS BIGINT) AS x, CAST(q.rating * 2 AS BIGINT) AS y FROM {table} p JOIN {table} q ON p.{by} = q.{by} AND p.{key} < q.{key}) GROUP BY 1, 2)"""


SPREAD = "(CAST(n * sxx - sx * sx AS DOUBLE) * CAST(n * syy - sy * sy AS DOUBLE))"


def pearson_sql(table: str) -> str:
    return f"""{co_sql(table, 'user_id', 'item_id')},
pearson AS MATERIALIZED (SELECT a, b, n, CASE WHEN {SPREAD} > 0 THEN CAST(n * sxy - sx * sy AS DOUBLE) / sqrt({SPREAD}) ELSE 0 END AS sim FROM co WHERE n >= 2),
sims AS MATERIALIZED (SELECT a AS id, b AS other, sim FROM pearson WHERE sim <> 0 UNION ALL SELECT b, a, sim FROM pearson WHERE sim <> 0)"""


@query("pearson_pairs", f"WITH {views.INTERACTIONS_SQL}, {pearson_sql('interactions')} SELECT a, b, n, round(sim, 6) AS sim FROM pearson")
def pearson_pairs(spark, sf):
    pairs = overlap.pearson(overlap.co_rated(views.interactions(spark, sf), "user_id", "item_id"))
    return pairs.select("a", "b", F.col("n").cast("bigint").alias("n"), F.round("sim", 6).alias("sim"))


NEAR_SQL = f"""{SPLIT}, {pearson_sql('train')},
near AS MATERIALIZED (SELECT id, other, sim, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS rank FROM sims WHERE sim > 0 QUALIFY rank <= 20),
means AS (SELECT user_id, avg(rating) AS mean FROM train GROUP BY 1)"""


def train_tables(spark, sf):
    ratings = materialize(views.train(spark, sf), "train")
    return ratings, materialize(rc.user_similarities(ratings), "similarities")


@query("user_topk", f"WITH {NEAR_SQL} SELECT id, other, round(sim, 6) AS sim, rank FROM near")
def user_topk(spark, sf):
    near = rc.nearest(rc.user_similarities(views.train(spark, sf)), 20)
    return near.select("id", "other", F.round("sim", 6).alias("sim"), "rank")


def rated_mean_sql(rated: str) -> str:
    """Weighted mean over the top 5 raters of ``rated`` (user_id, item_id, other, sim, rating)."""
    return f"""rc AS (SELECT item_id, count(*) AS n_raters FROM train GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY sim DESC, other) AS r, count(*) OVER (PARTITION BY user_id, item_id) AS k FROM {rated}),
chosen AS (SELECT * FROM ranked JOIN rc USING (item_id) WHERE r + CASE WHEN sim < 0 THEN n_raters - k ELSE 0 END <= 5),
preds AS MATERIALIZED (SELECT user_id, item_id, CASE WHEN sum(abs(sim)) <> 0 THEN sum(sim * rating) / sum(abs(sim)) ELSE 0 END AS pred FROM chosen GROUP BY 1, 2)"""


@query("user_predict_mean", f"""WITH {NEAR_SQL},
rated AS (SELECT t.user_id, t.item_id, s.other, s.sim, r.rating FROM test t JOIN sims s ON s.id = t.user_id JOIN train r ON r.user_id = s.other AND r.item_id = t.item_id),
{rated_mean_sql('rated')}
SELECT t.user_id, t.item_id, t.rating, round(coalesce(pred, 0), 6) AS pred FROM test t LEFT JOIN preds p ON p.user_id = t.user_id AND p.item_id = t.item_id""")
def user_predict_mean(spark, sf):
    ratings, sims = train_tables(spark, sf)
    held_out = materialize(views.test(spark, sf), "held_out")
    preds = rc.predict_by_raters(held_out, sims, ratings, 5)
    return held_out.join(preds, ["user_id", "item_id"]).select("user_id", "item_id", "rating", F.round("pred", 6).alias("pred"))


@query("user_predict_centred", f"""WITH {NEAR_SQL},
s AS (SELECT t.user_id, t.item_id, sum(n.sim * (r.rating - m.mean)) AS num, sum(n.sim) AS den FROM test t JOIN near n ON n.id = t.user_id
  JOIN train r ON r.user_id = n.other AND r.item_id = t.item_id JOIN means m ON m.user_id = n.other GROUP BY 1, 2)
SELECT t.user_id, t.item_id, t.rating, round(greatest(least(mean + CASE WHEN coalesce(den, 0) <> 0 THEN num / den ELSE 0 END, 5), 0.5), 6) AS pred
FROM test t JOIN means m ON m.user_id = t.user_id LEFT JOIN s ON s.user_id = t.user_id AND s.item_id = t.item_id""")
def user_predict_centred(spark, sf):
    ratings, sims = train_tables(spark, sf)
    held_out = materialize(views.test(spark, sf), "held_out")
    preds = rc.predict_centred(held_out, materialize(rc.nearest(sims, 20), "nearest"), ratings)
    return held_out.join(preds, ["user_id", "item_id"]).select("user_id", "item_id", "rating", F.round("pred", 6).alias("pred"))


USER_RECS_SQL = f"""{NEAR_SQL},
s AS (SELECT n.id AS user_id, r.item_id, sum(n.sim * (r.rating - m.mean)) AS num, sum(n.sim) AS den FROM near n JOIN train r ON r.user_id = n.other JOIN means m ON m.user_id = n.other GROUP BY 1, 2),
f AS (SELECT s.user_id, s.item_id, round(greatest(least(mean + CASE WHEN den <> 0 THEN num / den ELSE 0 END, 5), 0.5), 6) AS score
  FROM (SELECT * FROM s ANTI JOIN train USING (user_id, item_id)) s JOIN means m ON m.user_id = s.user_id),
recs AS MATERIALIZED (SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM f QUALIFY rank <= 5)"""


@query("user_recs", f"WITH {USER_RECS_SQL} SELECT user_id, item_id, score, rank FROM recs")
def user_recs(spark, sf):
    ratings, sims = train_tables(spark, sf)
    return rc.recommend_centred(materialize(rc.nearest(sims, 20), "nearest"), ratings, 5)


@query("unseen_top_n", f"""WITH {NEAR_SQL},
rated AS (SELECT s.id AS user_id, r.item_id, s.other, s.sim, r.rating FROM sims s JOIN train r ON r.user_id = s.other ANTI JOIN train t ON t.user_id = s.id AND t.item_id = r.item_id),
{rated_mean_sql('rated')}
SELECT user_id, item_id, round(pred, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY round(pred, 6) DESC, item_id) AS rank FROM preds QUALIFY rank <= 5""")
def unseen_top_n(spark, sf):
    ratings, sims = train_tables(spark, sf)
    return rc.unseen_by_raters(sims, ratings, 5, 5)


ITEM_NEAR_SQL = f"""{SPLIT}, {co_sql('train', 'item_id', 'user_id', 'ico')},
isim AS (SELECT a, b, CASE WHEN sxx::DOUBLE * syy::DOUBLE > 0 THEN sxy::DOUBLE / sqrt(sxx::DOUBLE * syy::DOUBLE) ELSE 0 END AS sim FROM ico WHERE n >= 2),
inear AS MATERIALIZED (SELECT id, other, sim, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS rank FROM (
  SELECT a AS id, b AS other, sim FROM isim WHERE sim > 0 UNION ALL SELECT b, a, sim FROM isim WHERE sim > 0) QUALIFY rank <= 10)"""


@query("item_topk", f"WITH {ITEM_NEAR_SQL} SELECT id, other, round(sim, 6) AS sim, rank FROM inear")
def item_topk(spark, sf):
    return rc.nearest(rc.item_similarities(views.train(spark, sf)), 10).select("id", "other", F.round("sim", 6).alias("sim"), "rank")


@query("item_recs", f"""WITH {ITEM_NEAR_SQL},
s AS (SELECT r.user_id, n.id AS item_id, sum(sim * rating) / sum(sim) AS pred FROM inear n JOIN train r ON r.item_id = n.other GROUP BY 1, 2)
SELECT user_id, item_id, round(pred, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY round(pred, 6) DESC, item_id) AS rank FROM s ANTI JOIN train USING (user_id, item_id) QUALIFY rank <= 5""")
def item_recs(spark, sf):
    ratings = materialize(views.train(spark, sf), "train")
    return rc.recommend_by_items(rc.nearest(rc.item_similarities(ratings), 10), ratings, 5)


def full_sql(key: str, by: str) -> str:
    return f"""{SPLIT}, {co_sql('train', key, by)},
ss AS (SELECT {key} AS id, sum(rating * 2 * rating * 2)::BIGINT AS s FROM train GROUP BY 1),
sims AS MATERIALIZED (SELECT a AS id, b AS other, sxy FROM co UNION ALL SELECT b, a, sxy FROM co)"""


@query("dense_user_cf", f"""WITH {full_sql('user_id', 'item_id')},
near AS (SELECT m.id, other, row_number() OVER (PARTITION BY m.id ORDER BY sxy::DOUBLE * sxy / s DESC, other) AS rank FROM sims m JOIN ss ON ss.id = other QUALIFY rank <= 10),
s AS (SELECT n.id AS user_id, item_id, round(sum(rating) / 10, 6) AS score FROM near n JOIN train r ON r.user_id = n.other GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM s ANTI JOIN train USING (user_id, item_id) QUALIFY rank <= 5""")
def dense_user_cf(spark, sf):
    """Whole-row neighbours among all users that share a rating."""
    return rc.mean_of_nearest(materialize(views.train(spark, sf), "train"))


@query("dense_item_cf", f"""WITH {full_sql('item_id', 'user_id')},
s AS (SELECT user_id, m.id AS item_id, round(sum(sxy / sqrt(p.s * q.s) * rating), 6) AS score FROM sims m JOIN ss p ON p.id = m.id JOIN ss q ON q.id = m.other JOIN train r ON r.item_id = m.other GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM s ANTI JOIN train USING (user_id, item_id) QUALIFY rank <= 5""")
def dense_item_cf(spark, sf):
    """The matrix of all items' cosines times every user's row."""
    return rc.similarity_times_row(materialize(views.train(spark, sf), "train"))


@query("co_liked", f"""WITH {views.INTERACTIONS_SQL}, c AS (SELECT p.item_id, q.item_id AS other, count(*) AS n FROM interactions p JOIN interactions q ON p.user_id = q.user_id AND p.item_id <> q.item_id WHERE p.rating >= 4 GROUP BY 1, 2)
SELECT item_id, other, n, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, other) AS rank FROM c QUALIFY rank <= 3""")
def co_liked(spark, sf):
    return rc.co_liked(materialize(views.interactions(spark, sf), "ratings"), 3)


# --- baselines and features -----------------------------------------------------------

BIAS_SQL = """g AS (SELECT avg(rating) AS g FROM train), um AS (SELECT user_id, avg(rating) AS m FROM train GROUP BY 1), im AS (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1),
bias AS MATERIALIZED (SELECT t.user_id, t.item_id, t.rating, coalesce(um.m, g) AS user_bias, coalesce(im.m, g) AS popularity, coalesce(um.m, g) + coalesce(im.m, g) - g AS cf
  FROM test t LEFT JOIN um ON um.user_id = t.user_id LEFT JOIN im ON im.item_id = t.item_id, g)"""
GENRE_SQL = f"""cnt AS (SELECT user_id, count(*) AS n FROM train SEMI JOIN tags USING (item_id) GROUP BY 1),
liking AS (SELECT user_id, tag, sum(rating) AS s FROM train JOIN tags USING (item_id) GROUP BY 1, 2),
dots AS (SELECT t.user_id, t.item_id, sum(coalesce(l.s, 0)) AS dot FROM test t JOIN tags g ON g.item_id = t.item_id LEFT JOIN liking l ON l.user_id = t.user_id AND l.tag = g.tag GROUP BY 1, 2),
meta AS MATERIALIZED (SELECT b.*, CASE WHEN n IS NULL OR dot IS NULL THEN g ELSE dot / n END AS cbf FROM bias b LEFT JOIN dots d ON d.user_id = b.user_id AND d.item_id = b.item_id LEFT JOIN cnt c ON c.user_id = b.user_id, g)"""


def meta(spark, sf):
    return rc.meta_features(views.test(spark, sf), views.train(spark, sf), views.item_tags(spark, sf))


@query("bias_baseline", f"WITH {SPLIT}, {BIAS_SQL} SELECT user_id, item_id, rating, round(cf, 6) AS pred FROM bias")
def bias_baseline(spark, sf):
    return rc.bias_terms(views.test(spark, sf), views.train(spark, sf)).select("user_id", "item_id", "rating", F.round("cf", 6).alias("pred"))


@query("genre_score", f"WITH {SPLIT}, {TAGS}, {BIAS_SQL}, {GENRE_SQL} SELECT user_id, item_id, round(cbf, 6) AS score FROM meta")
def genre_score(spark, sf):
    return meta(spark, sf).select("user_id", "item_id", F.round("cbf", 6).alias("score"))


@query("meta_features", f"""WITH {SPLIT}, {TAGS}, {BIAS_SQL}, {GENRE_SQL}
SELECT user_id, item_id, rating, round(cf, 6) AS cf, round(cbf, 6) AS cbf, round(popularity, 6) AS popularity, round(user_bias, 6) AS user_bias FROM meta""")
def meta_features(spark, sf):
    return meta(spark, sf).select("user_id", "item_id", "rating", *[F.round(c, 6).alias(c) for c in ("cf", "cbf", "popularity", "user_bias")])


@query("cold_start", f"""WITH {SPLIT}, {TAGS}, {BIAS_SQL}, {GENRE_SQL}, cold AS (SELECT user_id FROM train GROUP BY 1 HAVING count(*) <= 25),
m AS (SELECT model, user_id, item_id, rating, pred FROM (SELECT 'cf' AS model, user_id, item_id, rating, round(cf, 6) AS pred FROM meta UNION ALL SELECT 'cbf', user_id, item_id, rating, round(cbf, 6) FROM meta) SEMI JOIN cold USING (user_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY model, user_id ORDER BY pred DESC, item_id) AS rank FROM m),
u AS (SELECT model, user_id, count(*) FILTER (WHERE rank <= 5 AND rating >= 4) AS hits, count(*) FILTER (WHERE rating >= 4) AS rel FROM r GROUP BY 1, 2),
e AS (SELECT model, sqrt(avg((rating - pred) * (rating - pred))) AS rmse FROM m GROUP BY 1)
SELECT model, count(*) AS n_users, round(any_value(rmse), 6) AS rmse, round(avg(hits / 5), 6) AS precision, round(avg(CASE WHEN rel > 0 THEN hits / rel ELSE 0 END), 6) AS recall FROM u JOIN e USING (model) GROUP BY 1""")
def cold_start(spark, sf):
    """Scores of two models on users with at most 25 training ratings."""
    return cold_scores(meta(spark, sf), views.train(spark, sf), ["cf", "cbf"])


def cold_scores(features, ratings, names):
    """Error, precision and recall at 5 of the models in the columns ``names``, over cold users' rows of ``features``."""
    from affinity.functions.scalars import ratio

    features = features.join(rc.cold_users(ratings), "user_id", "left_semi")
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.round(m, 6).alias("pred")) for m in names]))
    m = features.select("user_id", "item_id", "rating", models.alias("m")).select("user_id", "item_id", "rating", "m.*")
    liked = F.col("rating") >= 4
    top = top_k(m, ["model", "user_id"], [F.desc("pred"), "item_id"], 5).groupBy("model", "user_id").agg(F.count_if(liked).alias("hits"))
    error = F.col("rating") - F.col("pred")
    users = m.groupBy("model", "user_id").agg(F.count_if(liked).alias("rel"), F.sum(error * error).alias("se"), F.count(F.lit(1)).alias("n"))
    return users.join(top, ["model", "user_id"]).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_users"), F.round(F.sqrt(F.sum("se") / F.sum("n")), 6).alias("rmse"),
        F.round(F.avg(F.col("hits") / 5), 6).alias("precision"), F.round(F.avg(ratio(F.col("hits"), F.col("rel"))), 6).alias("recall"))


@query("side_features", f"""WITH {SPLIT}, {TAGS}, im AS (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1),
years AS (SELECT item_id, TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS DOUBLE) AS year FROM items),
pref AS (SELECT user_id, tag, sum(rating) AS s FROM train JOIN tags USING (item_id) GROUP BY 1, 2), tot AS (SELECT user_id, sum(rating) AS t FROM train GROUP BY 1),
affin AS (SELECT t.user_id, t.item_id, sum(coalesce(p.s, 0) / tot.t) AS affinity, count(*) AS n_tags FROM train t JOIN tags g ON g.item_id = t.item_id JOIN tot ON tot.user_id = t.user_id LEFT JOIN pref p ON p.user_id = t.user_id AND p.tag = g.tag GROUP BY 1, 2),
place AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS pos FROM (SELECT DISTINCT tag FROM tags)),
uv AS (SELECT user_id, string_agg(pos || ':' || CAST(round(s / t * 1000000) AS BIGINT), ',' ORDER BY pos) AS user_tags FROM pref JOIN tot USING (user_id) JOIN place USING (tag) GROUP BY 1),
iv AS (SELECT item_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS item_tags FROM tags JOIN place USING (tag) GROUP BY 1)
SELECT t.user_id, t.item_id, t.rating, y.year, round(im.m, 6) AS avg_rating, round(a.affinity, 6) AS affinity, a.n_tags, uv.user_tags, iv.item_tags
FROM train t JOIN im USING (item_id) JOIN years y USING (item_id) JOIN affin a ON a.user_id = t.user_id AND a.item_id = t.item_id JOIN uv ON uv.user_id = t.user_id JOIN iv ON iv.item_id = t.item_id""")
def side_features(spark, sf):
    """Both tag vectors are written by their places other than 0, the user's in millionths."""
    def written(c: str, form):
        numbered = F.transform(c, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
        return F.array_join(F.transform(F.filter(numbered, lambda s: s["x"] != 0), form), ",").alias(c)

    user = written("user_tags", lambda s: F.concat_ws(":", s["i"].cast("string"), F.round(s["x"] * 1000000).cast("bigint").cast("string")))
    return features(spark, sf).select(
        "user_id", "item_id", "rating", "year", F.round("avg_rating", 6).alias("avg_rating"), F.round("affinity", 6).alias("affinity"), "n_tags", user, written("item_tags", lambda s: s["i"].cast("string")))


def tag_vector(rows: DataFrame, key: str, places: DataFrame, size: int, out: str) -> DataFrame:
    """(key, out): the values of (key, tag, x) rows as one array over the learned vocabulary."""
    entries = F.map_from_entries(F.collect_list(F.struct("_at", "x")))
    held = rows.join(places, "tag").groupBy(key).agg(entries.alias("_held"))
    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint"))
    return held.select(key, F.transform(slots, lambda i: F.coalesce(F.element_at("_held", i), F.lit(0.0))).alias(out))


def features(spark, sf, pairs=None):
    """Item year and mean rating, the tag vectors of both sides and their product, all of train, for ``pairs`` (train's own by default).

    A user's vector is the weighted preference for each tag, an item's one for
    each tag it has. An item that train lacks has the global mean, a user that
    it lacks no preference.
    """
    ratings, tags = views.train(spark, sf), materialize(views.item_tags(spark, sf), "tags")
    pairs = ratings if pairs is None else pairs
    means = ratings.groupBy("item_id").agg(F.avg("rating").alias("avg_rating"))
    overall = ratings.agg(F.avg("rating").alias("g")).scalar()
    years = views.items(spark, sf).select("item_id", texts.year(F.col("title"), texts.TITLE_YEAR).cast("double").alias("year"))
    totals = ratings.groupBy("user_id").agg(F.sum("rating").alias("t"))
    places = dense_index(tags, "tag", "_at")
    size = places.count()
    pref = ratings.join(tags, "item_id").groupBy("user_id", "tag").agg(F.sum("rating").alias("s")).join(totals, "user_id").select("user_id", "tag", (F.col("s") / F.col("t")).alias("x"))
    users = tag_vector(pref, "user_id", places, size, "user_tags")
    items = tag_vector(tags.select("item_id", "tag", F.lit(1.0).alias("x")), "item_id", places, size, "item_tags")
    known = pairs.join(means, "item_id", "left").withColumn("_g", overall).withColumn("avg_rating", F.coalesce("avg_rating", "_g")).drop("_g")
    nothing = F.transform(F.col("item_tags"), lambda x: F.lit(0.0))
    both = known.join(years, "item_id").join(items, "item_id").join(users, "user_id", "left").withColumn("user_tags", F.coalesce("user_tags", nothing))
    product = arrays.total(F.zip_with("user_tags", "item_tags", lambda x, y: x * y))
    return both.withColumn("affinity", product).withColumn("n_tags", arrays.total("item_tags").cast("bigint"))


# --- explanations -----------------------------------------------------------------------

@query("neighbour_why", f"""WITH {USER_RECS_SQL},
w AS (SELECT c.user_id, c.item_id, n.other, n.sim, r.rating, row_number() OVER (PARTITION BY c.user_id, c.item_id ORDER BY n.sim DESC, n.other) AS place
  FROM recs c JOIN near n ON n.id = c.user_id JOIN train r ON r.user_id = n.other AND r.item_id = c.item_id QUALIFY place <= 3)
SELECT user_id, item_id, string_agg(CAST(other AS VARCHAR), ',' ORDER BY place) AS neighbours, round(sum(sim), 6) AS total_sim, sum(rating) AS total_rating FROM w GROUP BY 1, 2""")
def neighbour_why(spark, sf):
    ratings, sims = train_tables(spark, sf)
    near = materialize(rc.nearest(sims, 20), "nearest")
    return explain.neighbour_reasons(rc.recommend_centred(near, ratings, 5), near, ratings, 3)


@query("feature_why", f"""WITH {PROFILE_SQL}, pn AS (SELECT user_id, tag, x / sqrt(sum(x * x) OVER (PARTITION BY user_id)) AS x FROM profile),
c AS (SELECT t.user_id, t.item_id, tag, round(x * w, 6) AS part FROM test t JOIN unitv v ON v.item_id = t.item_id JOIN pn USING (user_id, tag))
SELECT user_id, item_id, tag, part, row_number() OVER (PARTITION BY user_id, item_id ORDER BY abs(part) DESC, tag) AS rank FROM c QUALIFY rank <= 2""")
def feature_why(spark, sf):
    v = vectors(spark, sf)
    profiles = rc.unit_vectors(rc.user_profiles(views.train(spark, sf), v), "user_id", "x")
    return explain.feature_shares(views.test(spark, sf), profiles, rc.unit_vectors(v, "item_id", "w"), 2)
