"""Bandit statistics, linear arms, contexts and Q values on the logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.functions import scalars
from affinity.operators import ordered, policy
from affinity.plans import views
from affinity.plans.queries.relational import HOT_SQL, hot_tags
from affinity.plans.registry import query
from affinity.sources.scratch import materialize

L = views.LOGGED_SQL
BOUGHT = "event_type = 'purchase'"  # the pulls of the policy; other events only name arms
STATS_SQL = f"""{L}, arms AS MATERIALIZED (SELECT DISTINCT arm FROM logged), pulls AS MATERIALIZED (SELECT * FROM logged WHERE {BOUGHT}),
stats AS MATERIALIZED (SELECT arm, count(*) AS pulls, avg(reward) AS mean FROM pulls GROUP BY 1)"""


def pulls(spark, sf):
    return views.logged(spark, sf).filter(BOUGHT)


@query("arm_stats", f"WITH {STATS_SQL} SELECT arm, pulls, round(mean, 6) AS mean FROM stats")
def arm_stats(spark, sf):
    return policy.arm_stats(pulls(spark, sf)).select("arm", "pulls", F.round("mean", 6).alias("mean"))


@query("ucb_scores", f"""WITH {STATS_SQL} SELECT arm, coalesce(pulls, 0) AS pulls, round(mean + 2 * sqrt(ln((SELECT count(*) FROM pulls)) / pulls), 6) AS ucb FROM arms LEFT JOIN stats USING (arm)""")
def ucb_scores(spark, sf):
    arms = views.logged(spark, sf).select("arm").distinct()
    return policy.ucb_scores(pulls(spark, sf), arms).select("arm", "pulls", F.round("ucb", 6).alias("ucb"))


@query("greedy_top_k", f"WITH {STATS_SQL} SELECT arm, round(mean, 9) AS score FROM stats ORDER BY score DESC, arm LIMIT 5")
def greedy_top_k(spark, sf):
    return policy.greedy(policy.arm_stats(pulls(spark, sf)), 5).select("arm", "score")


EPS_SQL = f"""{STATS_SQL}, numbered AS (SELECT arm, row_number() OVER (ORDER BY arm) - 1 AS pos FROM stats), best AS (SELECT arm AS best FROM stats ORDER BY round(mean, 9) DESC, arm LIMIT 1),
drawn AS (SELECT event_id AS id, {views.uniform_sql("'42'", "'explore'", "event_id")} < 0.1 AS explored, CAST(floor({views.uniform_sql("'42'", "'arm'", "event_id")} * (SELECT count(*) FROM stats)) AS BIGINT) AS pos FROM events),
served AS MATERIALIZED (SELECT id, explored, CASE WHEN explored THEN arm ELSE best END AS arm FROM drawn LEFT JOIN numbered USING (pos), best)"""


def served(spark, sf):
    requests = views.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return policy.epsilon_greedy(requests, policy.arm_stats(pulls(spark, sf)))


@query("eps_greedy", f"WITH {EPS_SQL} SELECT id, explored, arm FROM served")
def eps_greedy(spark, sf):
    return served(spark, sf).select("id", "explored", "arm")


@query("explore_rate", f"WITH {EPS_SQL} SELECT round(avg(CASE WHEN explored THEN 1 ELSE 0 END), 6) AS rate, count(*) AS n FROM served")
def explore_rate(spark, sf):
    return served(spark, sf).agg(F.round(F.avg(F.col("explored").cast("double")), 6).alias("rate"), F.count(F.lit(1)).alias("n"))


def extras(spark, sf):
    """Mean rating and number of likes of every user."""
    likes = F.least(F.count_if(F.col("rating") >= 4) / F.lit(50.0), F.lit(1.0))
    return views.interactions(spark, sf).groupBy("user_id").agg(F.avg("rating").alias("mean_rating"), likes.alias("n_norm"))


def liking(spark, sf, tags):
    """(user_id, tag, x): the user's liked items by tag, of length one."""
    liked = views.interactions(spark, sf).filter("rating >= 4").join(tags, "item_id")
    return policy.unit_counts(liked, "user_id", "tag", F.lit(1.0))


@query("user_context", f"""WITH {views.INTERACTIONS_SQL}, {views.TAGS_SQL}, c AS (SELECT user_id, tag, CAST(count(*) AS DOUBLE) AS s FROM interactions JOIN tags USING (item_id) WHERE rating >= 4 GROUP BY 1, 2),
x AS (SELECT user_id, tag, s / sqrt(sum(s * s) OVER (PARTITION BY user_id)) AS x FROM c),
e AS (SELECT user_id, avg(rating) AS mean_rating, least(count(*) FILTER (WHERE rating >= 4) / 50, 1) AS n_norm FROM interactions GROUP BY 1)
SELECT user_id, tag, round(coalesce(x, 0), 6) AS x, round(mean_rating, 6) AS mean_rating, round(n_norm, 6) AS n_norm FROM e LEFT JOIN x USING (user_id)""")
def user_context(spark, sf):
    """The non-zero entries of every user's tag vector; a user who liked nothing has one row without a tag."""
    c = extras(spark, sf).join(liking(spark, sf, views.item_tags(spark, sf)), "user_id", "left").fillna(0.0, ["x"])
    return c.select("user_id", "tag", *[F.round(x, 6).alias(x) for x in ("x", "mean_rating", "n_norm")])


@query("item_context", f"""WITH {views.INTERACTIONS_SQL}, {HOT_SQL}, s AS (SELECT item_id, avg(rating) AS m, count(*) AS n FROM interactions GROUP BY 1)
SELECT h.item_id, hot, size, round((coalesce(m, 2.5) - 2.5) / 2.5, 6) AS quality, round(least(coalesce(n, 0) / 500, 1), 6) AS popularity
FROM hot h LEFT JOIN s ON s.item_id = h.item_id""")
def item_context(spark, sf):
    stats = views.interactions(spark, sf).groupBy("item_id").agg(F.avg("rating").alias("m"), F.count(F.lit(1)).alias("n"))
    quality = (F.coalesce("m", F.lit(2.5)) - 2.5) / 2.5
    popularity = F.least(F.coalesce("n", F.lit(0)) / F.lit(500.0), F.lit(1.0))
    return hot_tags(spark, sf).join(stats, "item_id", "left").select("item_id", "hot", "size", F.round(quality, 6).alias("quality"), F.round(popularity, 6).alias("popularity"))


@query("linear_arms")
def linear_arms(spark, sf):
    """All items as arms, for every user. A context is the user's liking of each category (an item's first tag), mean rating and activity."""
    categories = views.items(spark, sf).select("item_id", F.split("genres", r"\|")[0].alias("tag"))
    # The categories are few by their nature; the arms' matrices have their number squared.
    names = [r["tag"] for r in categories.select("tag").distinct().orderBy("tag").collect()]
    wide = liking(spark, sf, categories).groupBy("user_id").pivot("tag", names).agg(F.max("x"))
    x = F.array(*[F.coalesce(F.col(f"`{t}`"), F.lit(0.0)) for t in names], F.col("mean_rating"), F.col("n_norm"))
    contexts = materialize(extras(spark, sf).join(wide, "user_id", "left").select("user_id", x.alias("x")), "contexts")
    rewards = views.interactions(spark, sf).select("user_id", F.col("item_id").alias("arm"), scalars.reward(F.col("rating")).alias("reward"))
    return policy.linear_arms(contexts, rewards, len(names) + 2)


def q_sql(rounds: int) -> str:
    parts = [L, """trans AS (SELECT event_type AS state, arm AS action, reward, lead(event_type) OVER (PARTITION BY user_id ORDER BY us, event_id) AS next_state FROM logged)""",
             "moves AS MATERIALIZED (SELECT state, action, next_state, count(*) AS n, sum(reward) AS r FROM trans GROUP BY ALL)",
             "v0 AS (SELECT DISTINCT state AS next_state, CAST(0 AS DOUBLE) AS v FROM moves)"]
    for i in range(1, rounds + 1):
        parts.append(f"q{i} AS MATERIALIZED (SELECT state, action, (sum(r) + CAST(0.9 AS DOUBLE) * sum(n * coalesce(v, 0))) / sum(n) AS q FROM moves LEFT JOIN v{i - 1} USING (next_state) GROUP BY 1, 2)")
        parts.append(f"v{i} AS MATERIALIZED (SELECT state AS next_state, max(q) AS v FROM q{i} GROUP BY 1)")
    return ",\n".join(parts)


@query("batch_q", f"WITH {q_sql(5)} SELECT state, action, round(q, 6) AS q FROM q5")
def batch_q(spark, sf):
    """States are event types, actions arms; a user's next event gives the next state."""
    logged = ordered.ranged(views.logged(spark, sf), ["user_id"], ["us", "event_id"])
    steps = ordered.successors(logged, ["user_id"], ["us", "event_id"], F.col(ordered.RANGE), ["event_type"])
    moves = steps.select(F.col("event_type").alias("state"), F.col("arm").alias("action"), "reward", F.col("next_event_type").alias("next_state"))
    return policy.batch_q(moves).select("state", "action", F.round("q", 6).alias("q"))


@query("reward_curve", f"""WITH {L}, c AS (SELECT CASE WHEN {views.uniform_sql("'42'", "'explore'", "event_id")} < 0.1 THEN 'explore' ELSE 'greedy' END AS policy, us, event_id, reward FROM logged),
s AS (SELECT policy, row_number() OVER w AS step, sum(reward) OVER (w ROWS UNBOUNDED PRECEDING) AS running FROM c WINDOW w AS (PARTITION BY policy ORDER BY us, event_id))
SELECT policy, step, running FROM s WHERE step % 100 = 1""")
def reward_curve(spark, sf):
    from affinity.functions.hashing import uniform

    label = F.when(uniform(42, "explore", F.col("event_id")) < 0.1, "explore").otherwise("greedy")
    logged = views.logged(spark, sf).withColumn("policy", label)
    logged = ordered.ranged(logged, ["policy"], ["us", "event_id"])
    curve = ordered.running_sum(logged, ["policy"], ["us", "event_id"], F.col(ordered.RANGE), "reward")
    return ordered.every_nth(curve, 100).select("policy", "step", "running")
