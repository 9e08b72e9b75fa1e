"""Scalar guards, arrays, features, joins, aggregates, windows and sets."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from affinity.functions import arrays, hashing, scalars, texts
from affinity.operators import ordered, relational
from affinity.plans import views
from affinity.plans.registry import query
from affinity.sources.scratch import materialize

I, T, L, P = views.INTERACTIONS_SQL, views.TAGS_SQL, views.LOGGED_SQL, views.POINTS_SQL
ONE = "CAST(1 AS DOUBLE)"


@query("scalar_guards", f"""WITH {I}, g AS (SELECT avg(rating) AS m FROM interactions)
SELECT item_id, count(*) AS n, least(5, greatest(CAST(0.5 AS DOUBLE), sum(rating) - 20)) AS clamped,
  round(CASE WHEN count(*) FILTER (WHERE rating >= 4) <> 0 THEN sum(rating) / count(*) FILTER (WHERE rating >= 4) ELSE 0 END, 6) AS per_like,
  round(log2(count(*)), 6) AS bits, round(sqrt(sum(rating)), 6) AS root, round(abs(avg(rating) - 3), 6) AS off, round(pow(avg(rating) / 5, 3), 6) AS cubed
FROM interactions GROUP BY 1""")
def scalar_guards(spark, sf):
    likes = F.count_if(F.col("rating") >= 4)
    return views.interactions(spark, sf).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"), scalars.clamp(F.sum("rating") - 20).alias("clamped"),
        F.round(scalars.ratio(F.sum("rating"), likes), 6).alias("per_like"), F.round(F.log2(F.count(F.lit(1))), 6).alias("bits"),
        F.round(F.sqrt(F.sum("rating")), 6).alias("root"), F.round(F.abs(F.avg("rating") - 3), 6).alias("off"),
        F.round(F.pow(F.avg("rating") / 5, 3), 6).alias("cubed"))


REWARD_SQL = "CASE WHEN rating >= 4 THEN 1 WHEN rating < 4 THEN -1 ELSE 0 END"


@query("reward_map", f"""WITH {I}, {views.ITEMS_SQL}
SELECT item_id, coalesce(sum(CAST({REWARD_SQL} AS DOUBLE)), 0) AS reward, count(rating) AS n FROM items LEFT JOIN interactions USING (item_id) GROUP BY 1""")
def reward_map(spark, sf):
    joined = views.items(spark, sf).select("item_id").join(views.interactions(spark, sf), "item_id", "left")
    return joined.groupBy("item_id").agg(F.sum(scalars.reward(F.col("rating"))).alias("reward"), F.count("rating").alias("n"))


@query("unrated_bonus", f"""WITH {views.SPLIT_SQL}, seen AS (SELECT DISTINCT user_id, item_id FROM train)
SELECT t.user_id, t.item_id, CAST(CASE WHEN rating >= 4 THEN 1 ELSE -1 END AS DOUBLE) + CASE WHEN s.user_id IS NULL THEN CAST(0.1 AS DOUBLE) ELSE 0 END AS reward
FROM interactions t LEFT JOIN seen s ON t.user_id = s.user_id AND t.item_id = s.item_id""")
def unrated_bonus(spark, sf):
    seen = views.train(spark, sf).select("user_id", "item_id", F.lit(True).alias("rated"))
    joined = views.interactions(spark, sf).join(seen, ["user_id", "item_id"], "left")
    bonus = F.when(F.col("rated").isNull(), 0.1).otherwise(0.0)
    return joined.select("user_id", "item_id", (scalars.reward(F.col("rating")) + bonus).alias("reward"))


@query("null_fill", f"""WITH {I}, a AS (SELECT item_id, avg(rating) AS m FROM interactions WHERE rating >= 4 GROUP BY 1),
j AS (SELECT p_partkey AS item_id, m, CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS size FROM part LEFT JOIN a ON p_partkey = item_id)
SELECT item_id, round(coalesce(m, 2.5), 6) AS filled_mean, coalesce(m, 0) > 0 AS has_mean, coalesce(size, (SELECT median(size) FROM j)) AS size FROM j""")
def null_fill(spark, sf):
    means = views.interactions(spark, sf).filter("rating >= 4").groupBy("item_id").agg(F.avg("rating").alias("m"))
    p = views.table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("size"))
    joined = relational.fill_missing_median(p.join(means, "item_id", "left"), "size")
    return joined.select("item_id", F.round(F.coalesce("m", F.lit(2.5)), 6).alias("filled_mean"), (F.coalesce("m", F.lit(0.0)) > 0).alias("has_mean"), "size")


@query("decay_schedule", """SELECT event_id, greatest(CAST(0.05 AS DOUBLE), 1 - CAST(0.95 AS DOUBLE) * event_id / CAST(5000 AS DOUBLE)) AS epsilon FROM events""")
def decay_schedule(spark, sf):
    e = views.table(spark, sf, "events")
    return e.select("event_id", scalars.linear_decay(F.col("event_id"), 1.0, 0.05, 5000).alias("epsilon"))


@query("array_algebra", f"""WITH {P}, q AS (SELECT v AS q FROM points WHERE id = 0)
SELECT id, round(list_inner_product(v, q), 6) AS dot, round(sqrt(list_inner_product(v, v)), 6) AS norm, round(list_cosine_similarity(v, q), 6) AS cosine,
  round(pow(list_distance(v, q), 2), 6) AS sq_dist, round(3 * list_sum(v), 6) AS scaled, round(list_sum(v) / 4, 6) AS divided FROM points, q""")
def array_algebra(spark, sf):
    pts = views.points(spark, sf)
    v, q = F.col("v"), F.col("q")
    return pts.withColumn("q", pts.filter("id = 0").select("v").scalar()).select(
        "id", F.round(arrays.dot(v, q), 6).alias("dot"), F.round(arrays.norm(v), 6).alias("norm"), F.round(arrays.cosine(v, q), 6).alias("cosine"),
        F.round(arrays.squared_distance(v, q), 6).alias("sq_dist"), F.round(arrays.total(arrays.scale(v, F.lit(3.0))), 6).alias("scaled"),
        F.round(arrays.total(arrays.divide(v, F.lit(4.0))), 6).alias("divided"))


@query("array_sums", f"""WITH {P}, x AS (SELECT label, generate_subscripts(v, 1) - 1 AS pos, unnest(v) AS x FROM points)
SELECT label, pos, round(sum(x), 6) AS total FROM x GROUP BY 1, 2""")
def array_sums(spark, sf):
    """Element-wise sums per label, rebuilt to an ordered array and taken apart again."""
    long = views.points(spark, sf).select("label", F.posexplode(vector_to_array(array_to_vector("v"))).alias("pos", "x"))
    sums = long.groupBy("label", "pos").agg(F.sum("x").alias("s"))
    rebuilt = sums.groupBy("label").agg(arrays.rebuild("pos", "s").alias("v"))
    return rebuilt.select("label", F.posexplode("v").alias("pos", "x")).select("label", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("total"))


HOT_SQL = f"""{T}, places AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS pos FROM (SELECT DISTINCT tag FROM tags)),
hot AS MATERIALIZED (SELECT item_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS hot, (SELECT count(*) FROM places) AS size FROM tags JOIN places USING (tag) GROUP BY 1)"""


def hot_tags(spark, sf):
    hot = relational.multi_hot(views.item_tags(spark, sf), "item_id", "tag")
    return hot.select("item_id", F.array_join(F.col("hot").cast("array<string>"), ",").alias("hot"), "size")


@query("multi_hot", f"WITH {HOT_SQL} SELECT item_id, hot, size FROM hot")
def multi_hot(spark, sf):
    """Each item's places of ones in the vocabulary of all tags."""
    return hot_tags(spark, sf)


@query("standardise", """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS balance,
  round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS nation FROM customer""")
def standardise(spark, sf):
    c = views.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"))
    scaled = relational.standardise(c, ["balance", "nation"])
    return scaled.select("c_custkey", F.round("balance", 6).alias("balance"), F.round("nation", 6).alias("nation"))


@query("feature_concat", f"WITH {P} SELECT id, round(list_sum(v) + label, 6) AS total, len(v) + 1 AS dims FROM points")
def feature_concat(spark, sf):
    p = views.points(spark, sf).withColumn("vec", array_to_vector("v"))
    both = VectorAssembler(inputCols=["vec", "label"], outputCol="features").transform(p).withColumn("f", vector_to_array("features"))
    return both.select("id", F.round(arrays.total(F.col("f")), 6).alias("total"), F.size("f").cast("bigint").alias("dims"))


@query("dense_index", f"WITH {I} SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM interactions)")
def dense_index(spark, sf):
    return relational.dense_index(views.interactions(spark, sf), "user_id")


@query("hash_bucket", f"""WITH {P}
SELECT CAST('0x' || substr(md5('features:' || array_to_string(list_transform(v, lambda x: CAST(round(x * 1000000.0::DOUBLE) AS BIGINT)), ',')), 1, 8) AS BIGINT) % 50 AS bucket, count(*) AS n FROM points GROUP BY 1""")
def hash_bucket(spark, sf):
    bucket = hashing.hash_bucket(F.col("v"), 50).alias("bucket")
    return views.points(spark, sf).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query("hash_bucket_text", "SELECT CAST('0x' || substr(md5('b:' || text), 1, 8) AS BIGINT) % 50 AS bucket, count(*) AS n FROM documents GROUP BY 1")
def hash_bucket_text(spark, sf):
    bucket = F.pmod(hashing.hash32("b", F.col("text")), F.lit(50)).alias("bucket")
    return views.corpus(spark, sf).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


# --- joins -----------------------------------------------------------------------

REACH = 5  # days after which a first shipment no longer counts as influenced
RANGE_SQL = f"{views.FIRSTS_SQL}, infl AS MATERIALIZED (SELECT a.author AS src, b.author AS dst FROM firsts a JOIN firsts b ON b.first_day > a.first_day AND b.first_day <= a.first_day + {REACH} AND a.author <> b.author)"
DEGREES_SQL = f"""{RANGE_SQL},
outd AS (SELECT src, count(*) AS out_degree FROM infl GROUP BY 1), ind AS (SELECT dst, count(*) AS in_degree FROM infl GROUP BY 1)"""


@query("range_pairs", f"WITH {RANGE_SQL} SELECT src, dst FROM infl")
def range_pairs(spark, sf):
    return relational.range_successors(views.firsts(spark, sf), "author", "first_day", REACH)


@query("degree_join", f"WITH {DEGREES_SQL} SELECT author, first_day, in_degree, out_degree FROM firsts LEFT JOIN outd ON author = src LEFT JOIN ind ON author = dst")
def degree_join(spark, sf):
    degrees = relational.range_degrees(views.firsts(spark, sf), "author", "first_day", REACH)
    return degrees.select("author", "first_day", "in_degree", "out_degree")


@query("pair_join", f"""WITH {I}, {T}, m AS (SELECT item_id, avg(rating) AS mean FROM interactions GROUP BY 1)
SELECT tag, count(*) AS n_items, count(mean) AS n_rated, round(avg(mean), 6) AS mean FROM tags LEFT JOIN m USING (item_id) GROUP BY 1""")
def pair_join(spark, sf):
    means = views.interactions(spark, sf).groupBy("item_id").agg(F.avg("rating").alias("mean"))
    joined = views.item_tags(spark, sf).join(means, "item_id", "left")
    return joined.groupBy("tag").agg(F.count(F.lit(1)).alias("n_items"), F.count("mean").alias("n_rated"), F.round(F.avg("mean"), 6).alias("mean"))


@query("lookup", f"WITH {I}, {views.ITEMS_SQL} SELECT user_id, item_id, title, rating FROM interactions JOIN items USING (item_id) WHERE rating >= 4")
def lookup(spark, sf):
    return views.interactions(spark, sf).filter("rating >= 4").join(views.items(spark, sf).select("item_id", "title"), "item_id").select("user_id", "item_id", "title", "rating")


@query("unseen", f"WITH {views.SPLIT_SQL} SELECT user_id, item_id FROM test ANTI JOIN (SELECT * FROM train WHERE rating >= 5) s USING (item_id)")
def unseen(spark, sf):
    return views.test(spark, sf).select("user_id", "item_id").join(views.train(spark, sf).filter("rating >= 5"), "item_id", "left_anti")


# --- aggregates -------------------------------------------------------------------

@query("group_stats", f"""WITH {I} SELECT user_id, count(*) AS n, min(rating) AS lo, max(rating) AS hi, sum(rating) AS total, round(avg(rating), 6) AS mean,
  round(stddev_samp(rating), 6) AS sd, count(DISTINCT item_id) AS items FROM interactions GROUP BY 1""")
def group_stats(spark, sf):
    # (user_id, item_id) is unique, so the distinct count is the row count.
    return views.interactions(spark, sf).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("rating").alias("lo"), F.max("rating").alias("hi"), F.sum("rating").alias("total"),
        F.round(F.avg("rating"), 6).alias("mean"), F.round(F.stddev_samp("rating"), 6).alias("sd"), F.count("item_id").alias("items"))


@query("distinct_counts", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps FROM lineitem GROUP BY 1")
def distinct_counts(spark, sf):
    """Distinct values are reduced per (flag, value) first, so three flags spread over all tasks."""
    li = views.table(spark, sf, "lineitem").select("l_returnflag", "l_partkey", "l_suppkey")

    def distinct(column, name):
        pairs = li.select("l_returnflag", column).distinct()
        return pairs.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias(name))

    return distinct("l_partkey", "parts").join(distinct("l_suppkey", "supps"), "l_returnflag")


RATINGS = 200_000  # ratings whose tags are summed up in one task, about


@query("weighted_avg", f"WITH {I}, {T} SELECT user_id, tag, round(sum(rating) / (SELECT sum(rating) FROM interactions x WHERE x.user_id = i.user_id), 6) AS share FROM interactions i JOIN tags USING (item_id) GROUP BY 1, 2")
def weighted_avg(spark, sf):
    ratings = materialize(views.interactions(spark, sf).select("user_id", "item_id", "rating"), "ratings")
    totals = ratings.groupBy("user_id").agg(F.sum("rating").alias("w"))
    # Few ratings of a user share a tag, so they are summed up after the shuffle, in parts of about even size.
    parts = max(spark.sparkContext.defaultParallelism, ratings.count() // RATINGS + 1)
    sums = ratings.join(views.item_tags(spark, sf), "item_id").select("user_id", "tag", "rating").repartition(parts, "user_id", "tag").groupBy("user_id", "tag").agg(F.sum("rating").alias("s"))
    return sums.join(totals, "user_id").select("user_id", "tag", F.round(scalars.ratio(F.col("s"), F.col("w")), 6).alias("share"))


@query("collect_sets", f"""WITH {I}, r AS (SELECT user_id, item_id, (row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1) // 1000 AS chunk FROM interactions)
SELECT user_id, chunk, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, count(*) AS n FROM r GROUP BY 1, 2""")
def collect_sets(spark, sf):
    """Each user's items as lists, a long one in numbered chunks."""
    lists = ordered.chunked_lists(views.interactions(spark, sf).select("user_id", "item_id").distinct(), ["user_id"], "item_id")
    return lists.select("user_id", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), F.size("items").cast("bigint").alias("n"))


@query("reduce_sum", "SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT))::BIGINT AS qty FROM lineitem GROUP BY 1")
def reduce_sum(spark, sf):
    return views.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))


@query("argmax_row", "SELECT l_returnflag, max(l_extendedprice) AS price, arg_max(l_partkey, (l_extendedprice, -l_orderkey, -l_partkey)) AS item_id FROM lineitem GROUP BY 1")
def argmax_row(spark, sf):
    best = F.max_by("l_partkey", F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_partkey")))
    return views.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("price"), best.alias("item_id"))


@query("col_summary", """SELECT c_nationkey AS nation, count(*) AS n, count(*) FILTER (WHERE isnan(c_acctbal)) AS n_nan, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS sd,
  min(c_acctbal) AS lo, round(quantile_cont(c_acctbal, 0.25), 6) AS q1, round(quantile_cont(c_acctbal, 0.5), 6) AS q2, round(quantile_cont(c_acctbal, 0.75), 6) AS q3, max(c_acctbal) AS hi FROM customer GROUP BY 1""")
def col_summary(spark, sf):
    """Counts, moments and exact quartiles per nation."""
    x = F.col("c_acctbal")
    c = views.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), "c_acctbal")
    stats = c.groupBy("nation").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.isnan(x)).alias("n_nan"), F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("sd"),
        F.min(x).alias("lo"), F.max(x).alias("hi"))
    quartiles = ordered.quantiles(c, ["nation"], "c_acctbal", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return stats.join(quartiles, "nation").select("nation", "n", "n_nan", "mean", "sd", "lo", *[F.round(q, 6).alias(q) for q in ("q1", "q2", "q3")], "hi")


FLAGS = ["A", "N", "R"]


@query("pivot_matrix", "SELECT l_suppkey, " + ", ".join(f"coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = '{f}'), 0)::BIGINT AS {f.lower()}" for f in FLAGS) + " FROM lineitem GROUP BY 1")
def pivot_matrix(spark, sf):
    wide = views.table(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", FLAGS).agg(F.sum(F.col("l_quantity").cast("bigint"))).fillna(0)
    return wide.select("l_suppkey", *[F.col(f).alias(f.lower()) for f in FLAGS])


@query("vector_variance", f"WITH {P}, x AS (SELECT id, unnest(v) AS x FROM points) SELECT id, round(var_pop(x), 6) AS variance FROM x GROUP BY 1")
def vector_variance(spark, sf):
    v, n = F.col("v"), F.size("v")
    mean = arrays.total(v) / n
    return views.points(spark, sf).withColumn("m", mean).select(
        "id", F.round(arrays.total(F.transform("v", lambda x: (x - F.col("m")) * (x - F.col("m")))) / n, 6).alias("variance"))


# --- windows -----------------------------------------------------------------------

CURVE_SQL = f"""{L}, curve AS MATERIALIZED (SELECT event_type, event_id, reward,
  row_number() OVER w AS step, sum(reward) OVER (w ROWS UNBOUNDED PRECEDING) AS running,
  avg(reward) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS moving
  FROM logged WINDOW w AS (PARTITION BY event_type ORDER BY us, event_id))"""


def reward_steps(spark, sf):
    """Cumulative reward per event type in time order."""
    keys, order = ["event_type"], ["us", "event_id"]
    return ordered.running_sum(ordered.ranged(views.logged(spark, sf), keys, order), keys, order, F.col(ordered.RANGE), "reward")


@query("running_sum", f"WITH {CURVE_SQL} SELECT event_type, event_id, step, running FROM curve")
def running_sum(spark, sf):
    return reward_steps(spark, sf).select("event_type", "event_id", "step", "running")


@query("moving_avg", f"WITH {CURVE_SQL} SELECT event_type, step, round(moving, 6) AS moving_avg FROM curve WHERE step >= 20")
def moving_avg(spark, sf):
    return ordered.moving_average(reward_steps(spark, sf), ["event_type"], 20).select("event_type", "step", F.round("moving_avg", 6).alias("moving_avg"))


@query("stride", f"WITH {CURVE_SQL} SELECT event_type, step, running FROM curve WHERE step % 100 = 1")
def stride(spark, sf):
    return ordered.every_nth(reward_steps(spark, sf), 100).select("event_type", "step", "running")


@query("top_bottom", f"""WITH {I}, s AS (SELECT item_id, sum(rating) AS total FROM interactions GROUP BY 1)
(SELECT 'top' AS side, item_id, total FROM s ORDER BY total DESC, item_id LIMIT 5) UNION ALL (SELECT 'bottom', item_id, total FROM s ORDER BY total, item_id LIMIT 5)""")
def top_bottom(spark, sf):
    s = views.interactions(spark, sf).groupBy("item_id").agg(F.sum("rating").alias("total"))
    top = s.orderBy(F.desc("total"), "item_id").limit(5).select(F.lit("top").alias("side"), "item_id", "total")
    return top.unionByName(s.orderBy("total", "item_id").limit(5).select(F.lit("bottom").alias("side"), "item_id", "total"))


@query("set_ops", f"""WITH {views.SPLIT_SQL}, a AS (SELECT DISTINCT item_id FROM train WHERE rating >= 4), b AS (SELECT DISTINCT item_id FROM test WHERE rating >= 4)
SELECT 'both' AS part, item_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'train', item_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'test', item_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def set_ops(spark, sf):
    a = views.train(spark, sf).filter("rating >= 4").select("item_id").distinct()
    b = views.test(spark, sf).filter("rating >= 4").select("item_id").distinct()

    def part(name, df):
        return df.select(F.lit(name).alias("part"), "item_id")

    return part("both", a.intersect(b)).unionByName(part("train", a.subtract(b))).unionByName(part("test", b.subtract(a)))


@query("union_zero", f"""WITH {I} SELECT p_partkey AS item_id, count(user_id) AS n FROM part LEFT JOIN interactions ON p_partkey = item_id GROUP BY 1""")
def union_zero(spark, sf):
    """Counts with every catalogue key present, through a union of zero rows."""
    counted = views.interactions(spark, sf).select("item_id", F.lit(1).cast("bigint").alias("n"))
    zeros = views.table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.lit(0).cast("bigint").alias("n"))
    return counted.unionByName(zeros).groupBy("item_id").agg(F.sum("n").alias("n"))
