"""Recommenders over (user_id, item_id, rating) and (item_id, tag) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.scalars import clamp, ratio
from affinity.operators import overlap
from affinity.operators.relational import dealt, dense_index, rows_met, top_k
from affinity.operators.scoring import top_k_by_dot
from affinity.sources.scratch import materialize

LIKED_FROM = 4.0
#: Ratings of one user that are still paired with each other.
BUSY_RATER = 1_000
#: Raters of one item that all meet each user who asks for it.
MANY_RATERS = 1_000
#: Marks of neighbours that go along with an asked pair.
MARKS = 256


# --- content ------------------------------------------------------------------------

def tag_vocabulary(tags: DataFrame) -> DataFrame:
    """(tag, idx, idf): consecutive indices and smoothed IDF of the tag list."""
    n = tags.agg(F.count_distinct("item_id").alias("n")).scalar()
    df = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("df"))
    indexed = df.join(dense_index(df, "tag", "idx"), "tag")
    return indexed.select("tag", "idx", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def item_vectors(tags: DataFrame, weight: str = "idf") -> DataFrame:
    """(item_id, tag, idx, w): tag weights per item, 'idf' or 'one'."""
    vocabulary = tag_vocabulary(tags)
    w = F.col("idf") if weight == "idf" else F.lit(1.0)
    return tags.join(vocabulary, "tag").select("item_id", "tag", "idx", w.alias("w"))


def unit_vectors(vectors: DataFrame, key: str, value: str) -> DataFrame:
    norms = vectors.groupBy(key).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_norm")).filter("_norm > 0")
    return vectors.join(norms, key).withColumn(value, F.col(value) / F.col("_norm")).drop("_norm")


def similar_items(vectors: DataFrame, item_id: int, n: int = 5) -> DataFrame:
    """(item_id, cosine): the items nearest to one item."""
    unit = unit_vectors(vectors, "item_id", "w")
    asked = unit.filter(F.col("item_id") == item_id).select("idx", F.col("w").alias("_q"))
    others = unit.filter(F.col("item_id") != item_id)
    scores = others.join(asked, "idx").groupBy("item_id").agg(F.round(F.sum(F.col("w") * F.col("_q")), 6).alias("cosine"))
    return scores.orderBy(F.desc("cosine"), "item_id").limit(n)


def user_profiles(ratings: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, tag, idx, x): sum(rating * vector) / sum(rating)."""
    totals = ratings.groupBy("user_id").agg(F.sum("rating").alias("_t"))
    sums = ratings.join(vectors, "item_id").groupBy("user_id", "tag", "idx").agg(F.sum(F.col("rating") * F.col("w")).alias("_s"))
    return sums.join(totals, "user_id").select("user_id", "tag", "idx", ratio(F.col("_s"), F.col("_t")).alias("x"))


def profile_recommendations(profiles: DataFrame, vectors: DataFrame, k: int = 5, seen: DataFrame | None = None) -> DataFrame:
    """Cosine of user profiles and item vectors, best k per user."""
    unit_users = unit_vectors(profiles.select(F.col("user_id").alias("id"), "idx", "x"), "id", "x")
    recs = top_k_by_dot(unit_users, unit_vectors(vectors, "item_id", "w").select("item_id", "idx", "w"), k, seen)
    return recs.withColumnRenamed("id", "user_id")


def liked_sum_recommendations(ratings: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """Sum of cosines to the user's liked items; the sum is one dot product per item."""
    unit = unit_vectors(vectors, "item_id", "w")
    liked = ratings.filter(F.col("rating") >= LIKED_FROM).select("user_id", "item_id")
    wanted = liked.join(unit, "item_id").groupBy(F.col("user_id").alias("id"), "idx").agg(F.sum("w").alias("x"))
    return top_k_by_dot(wanted, unit.select("item_id", "idx", "w"), k, seen=ratings).withColumnRenamed("id", "user_id")


# --- neighbourhoods -----------------------------------------------------------------

def user_similarities(ratings: DataFrame) -> DataFrame:
    """(id, other, sim): non-zero Pearson similarities, both directions."""
    pairs = overlap.pearson(overlap.co_rated(ratings, "user_id", "item_id"))
    return overlap.both_ways(pairs.filter("sim != 0"))


def item_similarities(ratings: DataFrame, min_shared: int = 2) -> DataFrame:
    """(id, other, sim): positive cosines over co-raters, both directions."""
    pairs = overlap.overlap_cosine(overlap.co_rated(ratings, "item_id", "user_id", min_shared=min_shared))
    return overlap.both_ways(pairs.filter("sim > 0"))


def nearest(similarities: DataFrame, k: int) -> DataFrame:
    """(id, other, sim, rank): the k most similar, positive ones only."""
    return top_k(similarities.filter("sim > 0"), ["id"], [F.desc("sim"), "other"], k)


def neighbour_means(rated: DataFrame, k: int) -> DataFrame:
    """(user_id, item_id, pred): weighted mean over the k most similar raters of the item.

    ``rated`` is (user_id, item_id, other, sim, rating, n_raters) for
    similarities other than 0, n_raters being all raters of the item. Raters
    with similarity 0 carry no weight but rank before the negative ones. Place
    and number of a pair's raters come from one pass over one shuffle.
    """
    keys = ["user_id", "item_id"]
    pair = Window.partitionBy(*keys)
    placed = rated.withColumn("_place", F.row_number().over(pair.orderBy(F.desc("sim"), "other"))).withColumn("_n", F.count(F.lit(1)).over(pair))
    place = F.col("_place") + F.when(F.col("sim") < 0, F.col("n_raters") - F.col("_n")).otherwise(F.lit(0))
    return placed.filter(place <= k).groupBy(*keys).agg(F.sum(F.col("sim") * F.col("rating")).alias("_num"), F.sum(F.abs("sim")).alias("_den")).select(
        *keys, ratio(F.col("_num"), F.col("_den")).alias("pred"))


def rater_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_raters"))


def _mark(column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(32_768)).cast("smallint")


def raters_met(asked: DataFrame, sims: DataFrame, known: DataFrame, marks: int = MARKS) -> DataFrame:
    """(user_id, item_id, n_raters, other, rating): the raters of the asked items that may be neighbours of the user.

    A user's neighbours go along as 15 bits each, so nearly all other raters
    are dropped before a shuffle; users of more than ``marks`` marks meet all.
    """
    held = sims.groupBy("user_id").agg(F.collect_set(_mark("other")).alias("_marks"))
    held = held.withColumn("_marks", F.when(F.size("_marks") <= marks, F.col("_marks")))
    met = asked.join(held, "user_id").join(known, "item_id")
    return met.filter(F.col("_marks").isNull() | F.array_contains("_marks", _mark("other"))).drop("_marks")


def predict_by_raters(pairs: DataFrame, similarities: DataFrame, ratings: DataFrame, k: int = 5, popular: int = MANY_RATERS) -> DataFrame:
    """Predictions for given (user_id, item_id); 0 where no rater has a similarity.

    An asked pair meets the raters of its item, and those the similarities of
    its user. Only items of more than ``popular`` raters, of whom many are
    neighbours, are reached through the user's neighbours instead. Any limit
    gives the same rows.
    """
    wanted = pairs.select("user_id", "item_id")
    sims = similarities.select(F.col("id").alias("user_id"), "other", "sim")
    known = ratings.select(F.col("user_id").alias("other"), "item_id", "rating")
    asked = wanted.join(rater_counts(ratings), "item_id")
    by_item = raters_met(asked.filter(F.col("n_raters") <= popular), sims, known).join(sims, ["user_id", "other"])
    by_user = asked.filter(F.col("n_raters") > popular).join(sims, "user_id").join(known, ["other", "item_id"])
    return wanted.join(neighbour_means(by_item.unionByName(by_user), k), ["user_id", "item_id"], "left").fillna(0.0, ["pred"])


def unseen_by_raters(similarities: DataFrame, ratings: DataFrame, n: int = 5, k: int = 5) -> DataFrame:
    """Top-n unseen items per user. Only items that a similar user rated can score.

    What a user has seen is dealt with what the neighbours rated, so both are
    told apart without a further shuffle.
    """
    sims = similarities.select(F.col("id").alias("user_id"), "other", "sim")
    known = ratings.join(rater_counts(ratings), "item_id").select(F.col("user_id").alias("other"), "item_id", "rating", "n_raters")
    rated = sims.join(known, "other").select("user_id", "item_id", "other", "sim", "rating", "n_raters", F.lit(False).alias("seen"))
    own = ratings.filter(F.col("item_id").isNotNull() & F.col("user_id").isNotNull()).select("user_id", "item_id", F.lit(True).alias("seen"))
    rows = dealt(rated.unionByName(own, allowMissingColumns=True), rows_met(sims, known.select("other"), "other") + own.count(), "user_id", "item_id")
    # In the order of the neighbours' places, so that one sort serves all.
    pair = Window.partitionBy("user_id", "item_id").orderBy(F.desc("sim"), "other").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rated = rows.withColumn("_seen", F.max("seen").over(pair)).filter("NOT _seen").drop("seen", "_seen")
    preds = neighbour_means(rated, k).withColumn("score", F.round("pred", 6))
    return top_k(preds, ["user_id"], [F.desc("score"), "item_id"], n).select("user_id", "item_id", "score", "rank")


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("mean"))


def _deviations(ratings: DataFrame) -> DataFrame:
    """(other, item_id, off, mean): ratings less the rater's mean, and that mean."""
    return ratings.join(user_means(ratings), "user_id").select(
        F.col("user_id").alias("other"), "item_id", (F.col("rating") - F.col("mean")).alias("off"), "mean")


def _centred_score(num: str, den: str):
    shift = ratio(F.coalesce(num, F.lit(0.0)), F.coalesce(den, F.lit(0.0)))
    return clamp(F.col("mean") + shift)


def predict_centred(pairs: DataFrame, neighbours: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean-centred predictions for given pairs, clamped; the user's mean without neighbours."""
    wanted = pairs.select("user_id", "item_id")
    near = neighbours.select(F.col("id").alias("user_id"), "other", "sim")
    asked = dealt(wanted.join(near, "user_id"), rows_met(wanted, near, "user_id"), "other", "item_id", join=True)
    sums = asked.join(_deviations(ratings).drop("mean"), ["other", "item_id"]).groupBy("user_id", "item_id").agg(
        F.sum(F.col("sim") * F.col("off")).alias("num"), F.sum(F.abs("sim")).alias("den"))
    known = wanted.join(sums, ["user_id", "item_id"], "left").join(user_means(ratings), "user_id")
    return known.withColumn("pred", _centred_score("num", "den")).drop("num", "den", "mean")


def recommend_centred(neighbours: DataFrame, ratings: DataFrame, n: int = 5) -> DataFrame:
    """Top-n unseen items among those the neighbours rated.

    A user's own ratings are dealt with what the neighbours rated, so sums,
    mean and ranks of a user need no further shuffle. An item without an id is
    never seen.
    """
    near = neighbours.select(F.col("id").alias("user_id"), "other", "sim")
    off = _deviations(ratings)
    rated = near.join(off, "other").select("user_id", "item_id", (F.col("sim") * F.col("off")).alias("num"), F.abs("sim").alias("den"))
    own = off.select(F.col("other").alias("user_id"), "item_id", "mean", F.lit(True).alias("own"))
    rows = dealt(rated.unionByName(own, allowMissingColumns=True), rows_met(near, off.select("other"), "other") + own.count(), "user_id")
    sums = rows.groupBy("user_id", "item_id").agg(*[f(c).alias(c) for c, f in (("num", F.sum), ("den", F.sum), ("mean", F.max), ("own", F.max))])
    user = Window.partitionBy("user_id")
    theirs = sums.withColumns({"mean": F.max("mean").over(user), "_known": F.max("own").over(user)})
    fresh = theirs.filter("_known AND den IS NOT NULL AND (own IS NULL OR item_id IS NULL)")
    scored = fresh.withColumn("score", F.round(_centred_score("num", "den"), 6))
    return top_k(scored, ["user_id"], [F.desc("score"), "item_id"], n).select("user_id", "item_id", "score", "rank")


def recommend_by_items(neighbours: DataFrame, ratings: DataFrame, n: int = 5) -> DataFrame:
    """Top-n unseen items, each scored by the user's ratings of its nearest items."""
    near = neighbours.select(F.col("id").alias("item_id"), F.col("other").alias("rated"), "sim")
    own = ratings.select("user_id", F.col("item_id").alias("rated"), "rating")
    sums = near.join(own, "rated").groupBy("user_id", "item_id").agg(
        F.sum(F.col("sim") * F.col("rating")).alias("num"), F.sum("sim").alias("den"))
    fresh = sums.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    scored = fresh.withColumn("score", F.round(ratio(F.col("num"), F.col("den")), 6))
    return top_k(scored, ["user_id"], [F.desc("score"), "item_id"], n).select("user_id", "item_id", "score", "rank")


def nearest_rows(ratings: DataFrame, key: str, by: str, k: int = 10) -> DataFrame:
    """(id, other, rank): the k rows with the highest cosine over whole rows, of all that share anything; ratings must be positive half stars.

    Pairs that share two ratings or more come from the overlap join. A pair
    that shares only one has the cosine x * y / (|row| * |other|), so among the
    rows of that one element the others with the largest y / |other| come
    first: the first k + 1 of each element are enough, because k rows before
    another one in that order share at least as much. Squares are compared,
    as quotients of whole numbers, so equal cosines tie and go to the smaller id.
    """
    rows = ratings.select(F.col(key).alias("id"), F.col(by).alias("elem"), (F.col("rating") * 2).cast("bigint").alias("x"))
    squares = rows.groupBy(F.col("id").alias("other")).agg(F.sum(F.col("x") * F.col("x")).alias("ss"))
    square = lambda dot, ss: dot.cast("double") * dot / ss
    closeness = lambda dot: F.desc(square(F.col(dot), F.col("ss")))
    raters = rows.select("elem", F.col("id").alias("other"), F.col("x").alias("y")).join(squares, "other")
    leading = materialize(top_k(raters, ["elem"], [closeness("y"), "other"], k + 1), "leading")
    shared = overlap.both_ways(overlap.co_rated(ratings, key, by).select("a", "b", F.col("sxy").alias("sim"))).withColumnRenamed("sim", "dot").join(squares, "other")
    # An element with k + 1 leading rows shows k others; who is further away than those of the best such element is not needed.
    last = leading.filter(F.col("rank") == k + 1).select("elem", F.col("y").alias("_y"), F.col("ss").alias("_ss"))
    bounds = rows.join(last, "elem").groupBy("id").agg((F.max(square(F.col("x") * F.col("_y"), F.col("_ss"))) * (1 - overlap.EPSILON)).alias("_bound"))
    single = rows.join(bounds, "id", "left").join(leading.drop("rank"), "elem").filter(
        (F.col("id") != F.col("other")) & (F.col("_bound").isNull() | (square(F.col("x") * F.col("y"), F.col("ss")) >= F.col("_bound")))
    ).select("id", "other", (F.col("x") * F.col("y")).alias("dot"), "ss")
    # A pair of the overlap join may stand among the single ones too, with a part of its sum.
    pairs = single.unionByName(shared).groupBy("id", "other", "ss").agg(F.max("dot").alias("dot"))
    return top_k(pairs, ["id"], [closeness("dot"), "other"], k).select("id", "other", "rank")


def _unseen_top(scores: DataFrame, ratings: DataFrame, n: int) -> DataFrame:
    fresh = scores.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return top_k(fresh, ["user_id"], [F.desc("score"), "item_id"], n)


def mean_of_nearest(ratings: DataFrame, k: int = 10, n: int = 5) -> DataFrame:
    """Unseen items by the mean rating of the k users with the nearest whole rows, a missing rating counting as 0."""
    near = nearest_rows(ratings, "user_id", "item_id", k).select(F.col("id").alias("user_id"), "other")
    known = ratings.select(F.col("user_id").alias("other"), "item_id", "rating")
    scores = near.join(known, "other").groupBy("user_id", "item_id").agg(F.round(F.sum("rating") / k, 6).alias("score"))
    return _unseen_top(scores, ratings, n)


def similarity_times_row(ratings: DataFrame, n: int = 5, busy: int = BUSY_RATER) -> DataFrame:
    """Unseen items by the cosine matrix of all items' whole columns times the user's row.

    The score of an item is a sum over raters v and rated items j of
    unit(v, item) * unit(v, j) * rating(j), with unit the rating over the
    column's length. Raters of up to ``busy`` items give it through the matrix
    (item, j), to which they add the squares of their lists; the few longer
    lists are not squared but stay a dimension of their own, on both sides. Any
    limit gives the same scores. The products of all vectors are taken in a grid.
    """
    lengths = ratings.groupBy("item_id").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("_length"))
    units = materialize(ratings.join(lengths, "item_id").select("user_id", "item_id", "rating", (F.col("rating") / F.col("_length")).alias("unit")), "units")
    many = units.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > busy).select("user_id")
    quiet, loud = units.join(many, "user_id", "left_anti"), units.join(many, "user_id", "left_semi")
    rated, rater = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    other = quiet.select("user_id", F.col("item_id").alias("_j"), F.col("unit").alias("_u"))
    matrix = quiet.join(other, "user_id").filter("item_id <> _j").groupBy("item_id", rated("_j").alias("idx")).agg(F.sum(F.col("unit") * F.col("_u")).alias("w"))
    columns = matrix.unionByName(loud.select("item_id", rater("user_id").alias("idx"), F.col("unit").alias("w")))
    theirs = loud.select("item_id", F.col("user_id").alias("_v"), F.col("unit").alias("_u"))
    shared = units.select("user_id", "item_id", "rating").join(theirs, "item_id").groupBy("user_id", rater("_v").alias("idx")).agg(F.sum(F.col("rating") * F.col("_u")).alias("x"))
    wanted = units.select("user_id", rated("item_id").alias("idx"), F.col("rating").alias("x")).unionByName(shared).withColumnRenamed("user_id", "id")
    return top_k_by_dot(wanted, columns, n, seen=ratings).withColumnRenamed("id", "user_id")


def co_liked(ratings: DataFrame, k: int = 3) -> DataFrame:
    """(item_id, other, n, rank): items most rated by the users who liked an item.

    Pairs met by two or more users come from the overlap join. Those met by a
    single user only fill up short lists, smallest id first; a user's first
    k + 3 items then suffice, so no user's items are paired with each other.
    """
    liked = (F.col("rating") >= LIKED_FROM).cast("bigint")
    members = ratings.select(F.col("item_id").alias("id"), F.col("user_id").alias("elem"), liked.alias("x"))
    pairs = overlap.shared_sums(
        members, {"shared": lambda x, y: F.lit(1), "na": lambda x, y: x, "nb": lambda x, y: y},
        need=lambda n: F.lit(2), light=overlap.LIGHT, totals=False).filter("shared >= 2")
    two = F.explode(F.array(
        F.struct(F.col("a").alias("item_id"), F.col("b").alias("other"), F.col("na").alias("n")),
        F.struct(F.col("b").alias("item_id"), F.col("a").alias("other"), F.col("nb").alias("n"))))
    met = pairs.select(two.alias("p")).select("p.*").filter("n > 0")
    often = top_k(met.filter("n >= 2"), ["item_id"], [F.desc("n"), "other"], k).drop("rank")
    firsts = top_k(ratings.select("user_id", F.col("item_id").alias("other")), ["user_id"], ["other"], k + 3).drop("rank")
    likers = ratings.filter(F.col("rating") >= LIKED_FROM).select("item_id", "user_id")
    once = likers.join(firsts, "user_id").filter(F.col("item_id") != F.col("other")).select("item_id", "other").distinct()
    once = once.join(often.select("item_id", "other"), ["item_id", "other"], "left_anti").withColumn("n", F.lit(1).cast("bigint"))
    return top_k(often.unionByName(once), ["item_id"], [F.desc("n"), "other"], k)


# --- baselines and features ----------------------------------------------------------

def bias_terms(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Adds user_bias, popularity (item mean) and cf = user + item - global; unknown ones fall back to the global mean."""
    g = ratings.agg(F.avg("rating").alias("g")).scalar()
    items = ratings.groupBy("item_id").agg(F.avg("rating").alias("_i"))
    joined = pairs.join(user_means(ratings), "user_id", "left").join(items, "item_id", "left")
    joined = joined.withColumn("_g", g)
    user, item = F.coalesce("mean", "_g"), F.coalesce("_i", "_g")
    return joined.withColumns({"user_bias": user, "popularity": item, "cf": user + item - F.col("_g")}).drop("mean", "_i")


def with_genre_score(pairs: DataFrame, ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """Adds cbf: dot of the user's mean rating-weighted tag vector with the item's tags."""
    counts = ratings.join(tags.select("item_id").distinct(), "item_id", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    liking = ratings.join(tags, "item_id").groupBy("user_id", "tag").agg(F.sum("rating").alias("_s"))
    dots = pairs.select("user_id", "item_id").join(tags, "item_id").join(liking, ["user_id", "tag"], "left").groupBy("user_id", "item_id").agg(
        F.sum(F.coalesce("_s", F.lit(0.0))).alias("_dot"))
    joined = pairs.join(dots, ["user_id", "item_id"], "left").join(counts, "user_id", "left")
    g = F.col("_g")
    return joined.withColumn("cbf", F.when(F.col("_n").isNull() | F.col("_dot").isNull(), g).otherwise(F.col("_dot") / F.col("_n"))).drop("_dot", "_n")


def meta_features(pairs: DataFrame, ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """pairs plus cf, cbf, popularity and user_bias."""
    return with_genre_score(bias_terms(pairs, ratings), ratings, tags).drop("_g")


def cold_users(ratings: DataFrame, limit: int = 25) -> DataFrame:
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") <= limit).select("user_id")
