"""Cosine, Jaccard, MinHash, banding and random-projection neighbours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import hashing, scalars, texts
from affinity.operators import overlap, projections, relational, signatures as sg, termweights as tw
from affinity.plans import views
from affinity.plans.queries.text import TF_SQL, corpus_weights
from affinity.plans.registry import query
from affinity.sources.scratch import materialize

COSINE = 0.5
UNIT_SQL = f"""{TF_SQL},
norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM weights GROUP BY 1),
unit AS MATERIALIZED (SELECT doc_id, word, tfidf / norm AS w FROM weights JOIN norms USING (doc_id) WHERE norm > 0 AND tfidf <> 0),
bags AS (SELECT doc_id, md5(string_agg(word || ':' || tf, ',' ORDER BY word)) AS bag FROM tf GROUP BY 1),
reps AS MATERIALIZED (SELECT min(doc_id) AS rep, count(*) AS n_copies FROM bags GROUP BY bag)"""


def unit_rows(spark, sf):
    return tw.unit_rows(corpus_weights(spark, sf))


@query("cosine_pairs", f"""WITH {UNIT_SQL},
u AS MATERIALIZED (SELECT doc_id, word, w, n_copies FROM unit JOIN reps ON doc_id = rep),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n_copies AS copies_a, y.n_copies AS copies_b, round(sum(x.w * y.w), 6) AS cosine
  FROM u x JOIN u y ON x.word = y.word AND x.doc_id < y.doc_id GROUP BY ALL)
SELECT a, b, copies_a, copies_b, cosine FROM c WHERE cosine >= {COSINE}
UNION ALL SELECT rep, rep, n_copies, n_copies, 1.0 FROM reps SEMI JOIN unit ON doc_id = rep WHERE n_copies > 1""")
def cosine_pairs(spark, sf):
    """Document pairs at or above a cosine; copies are represented by one document and counted, and their own pairs are one row with a = b."""
    weights = materialize(corpus_weights(spark, sf), "weights")
    bags = weights.select(F.col("doc_id").alias("id"), F.struct("word", "tf").alias("elem"))
    groups = overlap.copy_groups(bags)
    reps = groups.filter("id = rep").select("id", "n_copies")
    unit = tw.unit_rows(weights).select(F.col("doc_id").alias("id"), F.col("word").alias("elem"), F.col("w").alias("x"))
    pairs = overlap.cosine_pairs(materialize(unit.join(reps.select("id"), "id", "left_semi"), "unit"), COSINE)
    ca, cb = (reps.select(F.col("id").alias(s), F.col("n_copies").alias(f"copies_{s}")) for s in "ab")
    between = pairs.join(ca, "a").join(cb, "b").select("a", "b", "copies_a", "copies_b", F.round("cosine", 6).alias("cosine")).filter(F.col("cosine") >= COSINE)
    n = F.col("n_copies")
    inside = reps.filter(n > 1).join(unit.select("id"), "id", "left_semi").select(F.col("id").alias("a"), F.col("id").alias("b"), n.alias("copies_a"), n.alias("copies_b"), F.lit(1.0).alias("cosine"))
    return between.unionByName(inside)


@query("cosine_top_n", f"""WITH {UNIT_SQL}, q AS (SELECT word, w AS wq FROM unit WHERE doc_id = 1)
SELECT doc_id, round(sum(w * wq), 6) AS cosine FROM unit JOIN q USING (word) WHERE doc_id <> 1 GROUP BY 1 ORDER BY cosine DESC, doc_id LIMIT 5""")
def cosine_top_n(spark, sf):
    unit = unit_rows(spark, sf).select("doc_id", "word", "w")
    asked = unit.filter("doc_id = 1").select("word", F.col("w").alias("wq"))
    scores = unit.filter("doc_id != 1").join(asked, "word").groupBy("doc_id").agg(F.round(F.sum(F.col("w") * F.col("wq")), 6).alias("cosine"))
    return scores.orderBy(F.desc("cosine"), "doc_id").limit(5)


# --- pyspark.ml features --------------------------------------------------------------

HASHED = 10000


@query("hashed_tfidf", f"""WITH {views.TOKENS_SQL},
tf AS MATERIALIZED (SELECT doc_id, CAST('0x' || substr(md5('term:' || word), 1, 8) AS BIGINT) % {HASHED} AS bucket, count(*) AS tf FROM tokens GROUP BY 1, 2),
df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY 1), n AS (SELECT count(*) AS n FROM documents),
x AS (SELECT doc_id, tf * ln((n.n + 1) / (df + 1)) AS x FROM tf JOIN df USING (bucket), n)
SELECT doc_id, count(*) FILTER (WHERE x <> 0) AS n_features, round(sqrt(coalesce(sum(x * x), 0)), 6) AS norm FROM documents LEFT JOIN x USING (doc_id) GROUP BY 1""")
def hashed_tfidf(spark, sf):
    """Weights of hashed terms, one row for each document and bucket it fills; smooth IDF over buckets."""
    docs = views.corpus(spark, sf)
    words = tw.term_frequencies(docs)
    hashed = words.groupBy("doc_id", F.pmod(hashing.hash32("term", F.col("word")), F.lit(HASHED)).alias("word")).agg(F.sum("tf").alias("tf"))
    x = F.col("tfidf")
    weights = tw.tfidf(hashed, tw.count_docs(docs), "smooth")
    norms = weights.groupBy("doc_id").agg(F.count_if(x != 0).alias("n"), F.sqrt(F.sum(x * x)).alias("length"))
    return docs.select("doc_id").join(norms, "doc_id", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_features"), F.round(F.coalesce("length", F.lit(0.0)), 6).alias("norm"))


@query("ml_idf", f"""WITH {TF_SQL}, s AS (SELECT doc_id, tf * ln((n.n + 1) / (df + 1)) AS x FROM tf JOIN df USING (word), n)
SELECT doc_id, round(sqrt(sum(x * x)), 6) AS norm FROM s GROUP BY 1""")
def ml_idf(spark, sf):
    smooth = corpus_weights(spark, sf, "smooth")
    return smooth.groupBy("doc_id").agg(F.round(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))), 6).alias("norm"))


@query("l2_norm", f"WITH {UNIT_SQL} SELECT doc_id, round(sum(w * w), 6) AS length, round(max(w), 6) AS top FROM unit GROUP BY 1")
def l2_norm(spark, sf):
    w = F.col("w")
    return unit_rows(spark, sf).groupBy("doc_id").agg(F.round(F.sum(w * w), 6).alias("length"), F.round(F.max(w), 6).alias("top"))


REACH, TABLES, PER_KEY = 1.2, 3, 2


def _cell_sql(place: int) -> str:
    sign = f"CASE WHEN CAST('0x' || substr(md5('42:' || t || ':{place}:' || (i - 1)), 1, 8) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END"
    return f"CAST(floor(list_sum(list_transform(v, lambda x, i: x * {sign})) / {REACH}) AS BIGINT)"


MET_SQL = f"""{views.POINTS_SQL}, cells AS MATERIALIZED (SELECT id, v, t, {', '.join(f'{_cell_sql(p)} AS c{p}' for p in range(PER_KEY))} FROM points, range({TABLES}) r(t)),
met AS MATERIALIZED (SELECT DISTINCT q.id AS a, p.id AS b, list_distance(q.v, p.v) AS distance FROM cells q JOIN cells p ON q.t = p.t AND q.id <> p.id AND {' AND '.join(f'abs(q.c{p} - p.c{p}) <= 1' for p in range(PER_KEY))}
  WHERE q.id % 20 = 0)"""


def asked_points(spark, sf):
    """(all points, the query points): those whose id is divisible by 20."""
    points = materialize(views.points(spark, sf).select("id", "v"), "points")
    return points, points.filter(F.pmod("id", F.lit(20)) == 0)


@query("brp_neighbours", f"WITH {MET_SQL} SELECT a, b, round(distance, 6) AS distance, row_number() OVER (PARTITION BY a ORDER BY round(distance, 6), b) AS rank FROM met QUALIFY rank <= 5")
def brp_neighbours(spark, sf):
    """The five nearest points of each query point, among those it meets in a bucket."""
    return projections.nearest(*asked_points(spark, sf), 5, REACH, TABLES, PER_KEY).withColumn("distance", F.round("distance", 6))


@query("brp_join", f"WITH {MET_SQL} SELECT a, b, round(distance, 6) AS distance FROM met WHERE distance <= {REACH}")
def brp_join(spark, sf):
    """Points within a distance of each query point, found through buckets and checked exactly."""
    return projections.within(*asked_points(spark, sf), REACH, TABLES, PER_KEY).withColumn("distance", F.round("distance", 6))


# --- shingle sets ----------------------------------------------------------------------

CHAR_SQL = "chars AS MATERIALIZED (SELECT DISTINCT doc_id AS id, substr(text, i, 3) AS elem FROM (SELECT doc_id, text, unnest(range(1, length(text) - 1)) AS i FROM documents))"
WORD_SQL = """ws AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (
  SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM documents)),
grams AS MATERIALIZED (SELECT DISTINCT id, elem FROM (SELECT doc_id AS id, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS elem FROM ws) WHERE elem IS NOT NULL),
sets AS (SELECT id, count(*) AS n, md5(string_agg(elem, chr(1) ORDER BY elem)) AS digest FROM grams GROUP BY 1),
reps AS MATERIALIZED (SELECT min(id) AS id, count(*) AS n_copies, any_value(n) AS n FROM sets GROUP BY digest),
members AS MATERIALIZED (SELECT id, elem, n, n_copies FROM grams JOIN reps USING (id))"""
# The same names over all sets, each standing for itself alone.
RAW_SQL = WORD_SQL[: WORD_SQL.index("sets AS")] + """reps AS MATERIALIZED (SELECT id, 1 AS n_copies, count(*) AS n FROM grams GROUP BY 1),
members AS MATERIALIZED (SELECT id, elem, n, n_copies FROM grams JOIN reps USING (id))"""


def exact_sql(level: float) -> str:
    return f"""inter AS (SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b, x.n_copies * y.n_copies AS weight, count(*) AS shared
  FROM members x JOIN members y ON x.elem = y.elem AND x.id < y.id GROUP BY ALL),
exact AS MATERIALIZED (SELECT a, b, n_a, n_b, weight, shared, shared / (n_a + n_b - shared) AS jaccard FROM inter WHERE shared / (n_a + n_b - shared) >= {level})"""


def char_grams(spark, sf):
    return views.corpus(spark, sf).select(F.col("doc_id").alias("id"), F.explode(texts.char_grams(F.col("text"), 3)).alias("elem"))


def word_grams(spark, sf):
    return views.corpus(spark, sf).select(F.col("doc_id").alias("id"), F.explode(texts.word_grams(F.col("text"), 2)).alias("elem"))


def word_sets(spark, sf):
    """(members of representatives, (id, n_copies) of representatives)."""
    grams = materialize(word_grams(spark, sf), "grams")
    groups = overlap.copy_groups(grams)
    reps = materialize(groups.filter("id = rep").select("id", "n_copies"), "reps")
    return grams.join(reps.select("id"), "id", "left_semi"), reps


def weigh(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Adds how many pairs of the full input each representative pair stands for."""
    ca, cb = (reps.select(F.col("id").alias(s), F.col("n_copies").alias(f"_{s}")) for s in "ab")
    return pairs.join(ca, "a").join(cb, "b").withColumn("weight", F.col("_a") * F.col("_b")).drop("_a", "_b")


def inside(reps: DataFrame) -> DataFrame:
    """(a, b, weight): the pairs inside each group of copies, as one row with a = b."""
    n = F.col("n_copies")
    return reps.filter(n > 1).select(F.col("id").alias("a"), F.col("id").alias("b"), (n * (n - 1) / 2).cast("bigint").alias("weight"))


INSIDE_SQL = "SELECT id AS a, id AS b, n_copies * (n_copies - 1) // 2 AS weight FROM reps WHERE n_copies > 1"


@query("char_kgrams", f"WITH {CHAR_SQL} SELECT id AS doc_id, count(*) AS n_grams FROM chars GROUP BY 1")
def char_kgrams(spark, sf):
    return char_grams(spark, sf).groupBy(F.col("id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_grams"))


@query("word_kgrams", f"WITH {WORD_SQL} SELECT elem, count(*) AS n_docs FROM grams GROUP BY 1")
def word_kgrams(spark, sf):
    return word_grams(spark, sf).groupBy("elem").agg(F.count(F.lit(1)).alias("n_docs"))


@query("copy_groups", f"WITH {WORD_SQL}, f AS (SELECT id, digest FROM sets) SELECT s.id, min(s.id) OVER (PARTITION BY digest) AS rep, count(*) OVER (PARTITION BY digest) AS n_copies FROM sets s")
def copy_groups(spark, sf):
    return overlap.copy_groups(word_grams(spark, sf))


@query("jaccard_pairs", f"WITH {WORD_SQL}, {exact_sql(0.5)} SELECT a, b, n_a, n_b, shared, weight, round(jaccard, 6) AS jaccard FROM exact")
def jaccard_pairs(spark, sf):
    members, reps = word_sets(spark, sf)
    pairs = weigh(overlap.jaccard_pairs(members, 0.5), reps)
    return pairs.select("a", "b", "n_a", "n_b", F.col("shared").cast("bigint").alias("shared"), "weight", F.round("jaccard", 6).alias("jaccard"))


@query("jaccard_levels", f"""WITH {WORD_SQL}, {exact_sql(0.5)}, levels AS (SELECT unnest([0.5, 0.6, 0.8])::DOUBLE AS level),
inside AS (SELECT sum(n_copies * (n_copies - 1) // 2) AS n FROM reps)
SELECT level, count(*) AS n_pairs, CAST(sum(weight) + any_value(inside.n) AS BIGINT) AS n_full_pairs FROM exact, levels, inside WHERE jaccard >= level GROUP BY 1""")
def jaccard_levels(spark, sf):
    members, reps = word_sets(spark, sf)
    pairs = weigh(overlap.jaccard_pairs(members, 0.5), reps)
    levels = F.explode(F.filter(F.array(F.lit(0.5), F.lit(0.6), F.lit(0.8)), lambda x: x <= F.col("jaccard")))
    counts = pairs.select(levels.alias("level"), "weight").groupBy("level").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("weight").alias("between"))
    # Pairs of copies agree in full; they belong to every level.
    inside = reps.agg(F.coalesce(F.sum((F.col("n_copies") * (F.col("n_copies") - 1) / 2).cast("bigint")), F.lit(0)).alias("n"))
    return counts.join(F.broadcast(inside)).select("level", "n_pairs", (F.col("between") + F.col("n")).alias("n_full_pairs"))


USER_JACCARD = 0.08


@query("jaccard_threshold", f"""WITH {views.INTERACTIONS_SQL}, s AS (SELECT user_id, count(*) AS n FROM interactions GROUP BY 1),
m AS MATERIALIZED (SELECT user_id AS id, item_id AS elem, n FROM interactions JOIN s USING (user_id)),
i AS (SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b, count(*) AS shared FROM m x JOIN m y ON x.elem = y.elem AND x.id < y.id GROUP BY ALL)
SELECT a, b, n_a, n_b, shared, round(shared / (n_a + n_b - shared), 6) AS jaccard FROM i WHERE shared / (n_a + n_b - shared) >= {USER_JACCARD}""")
def jaccard_threshold(spark, sf):
    members = views.interactions(spark, sf).select(F.col("user_id").alias("id"), F.col("item_id").alias("elem"))
    pairs = overlap.jaccard_pairs(members, USER_JACCARD, overlap.LIGHT)
    return pairs.select("a", "b", "n_a", "n_b", F.col("shared").cast("bigint").alias("shared"), F.round("jaccard", 6).alias("jaccard"))


@query("set_profile", f"""WITH {views.INTERACTIONS_SQL}, s AS (SELECT count(*) AS n FROM interactions GROUP BY user_id)
SELECT count(*) AS n_users, min(n) AS lo, max(n) AS hi, round(avg(n), 6) AS mean FROM s""")
def set_profile(spark, sf):
    s = views.interactions(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.agg(F.count(F.lit(1)).alias("n_users"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.round(F.avg("n"), 6).alias("mean"))


# --- MinHash ---------------------------------------------------------------------------

def family_sql(n: int, trials: int = 1, limit: int = sg.PRIME) -> str:
    rows = ", ".join(f"({t}, {j}, {a}::BIGINT, {b}::BIGINT)" for t in range(trials) for j, (a, b) in enumerate(sg.coefficients(n, t, limit)))
    return f"family AS MATERIALIZED (SELECT * FROM (VALUES {rows}) AS f(trial, slot, a, b))"


HASH32 = "CAST('0x' || substr(md5('g:' || elem), 1, 8) AS BIGINT)"


def minhash_sql(source: str, n: int, trials: int = 1) -> str:
    return f"""{family_sql(n, trials)},
x AS MATERIALIZED (SELECT id, {HASH32} % {sg.PRIME} AS x FROM {source}),
sig AS MATERIALIZED (SELECT trial, id, slot, min((a * x + b) % {sg.PRIME}) AS value FROM x, family GROUP BY ALL)"""


SLOTS = 100


def doc_signatures(members, n, trial=0):
    return sg.minhash(members, hashing.hash32("g", F.col("elem")), sg.coefficients(n, trial))


@query("minhash_strings", f"WITH {CHAR_SQL}, {minhash_sql('chars', 20)} SELECT id AS doc_id, slot::BIGINT AS slot, value FROM sig")
def minhash_strings(spark, sf):
    grams = texts.char_grams(F.col("text"), 3)
    hashed = views.corpus(spark, sf).select(F.col("doc_id").alias("id"), F.explode(hashing.hash32_each("g", grams)).alias("x"))
    sig = sg.minhash(hashed, F.col("x"), sg.coefficients(20))
    return sig.select(F.col("id").alias("doc_id"), F.posexplode("signature").alias("slot", "value")).withColumn("slot", F.col("slot").cast("bigint"))


ID_PRIME, ID_MODULUS = 1000003, 2003


@query("minhash_ids", f"""WITH {views.INTERACTIONS_SQL}, {family_sql(50, limit=ID_MODULUS)}
SELECT user_id, slot::BIGINT AS slot, min((a * item_id + b) % {ID_PRIME} % {ID_MODULUS}) AS value FROM interactions, family GROUP BY 1, 2""")
def minhash_ids(spark, sf):
    members = views.interactions(spark, sf).select(F.col("user_id").alias("id"), "item_id")
    sig = sg.minhash(members, F.col("item_id"), sg.coefficients(50, 0, ID_MODULUS), ID_PRIME, ID_MODULUS)
    return sig.select(F.col("id").alias("user_id"), F.posexplode("signature").alias("slot", "value")).withColumn("slot", F.col("slot").cast("bigint"))


EST_SQL = f"""{WORD_SQL}, {minhash_sql('members', SLOTS)},
est AS MATERIALIZED (SELECT p.id AS a, q.id AS b, count(*) AS shared FROM sig p JOIN sig q ON p.slot = q.slot AND p.value = q.value AND p.id < q.id GROUP BY ALL)"""


@query("minhash_pairs", f"""WITH {EST_SQL} SELECT a, b, shared, shared / {SLOTS} AS share, p.n_copies * q.n_copies AS weight FROM est JOIN reps p ON p.id = a JOIN reps q ON q.id = b WHERE shared / {SLOTS} >= 0.5
UNION ALL SELECT a, b, {SLOTS}, 1.0, weight FROM ({INSIDE_SQL})""")
def minhash_pairs(spark, sf):
    """Estimated pairs of different sets, each with the number of pairs it stands for; a = b stands for those of equal sets."""
    members, reps = word_sets(spark, sf)
    between = weigh(estimated(members, SLOTS, 0.5), reps).select("a", "b", F.col("shared").cast("bigint").alias("shared"), "share", "weight")
    return between.unionByName(inside(reps).select("a", "b", F.lit(SLOTS).cast("bigint").alias("shared"), F.lit(1.0).alias("share"), "weight"))


def estimated(members, n, threshold):
    """Estimated pairs of sets that differ; their signatures may be equal."""
    return sg.estimated_pairs(materialize(doc_signatures(members, n), "signatures"), threshold)


# The signature lengths compared.
SWEEP = [20, 60, 150, 300, 600]


@query("minhash_sweep", f"""WITH {WORD_SQL}, {exact_sql(0.5)}, {minhash_sql('members', max(SWEEP))},
hits AS (SELECT a, b, jaccard, p.slot FROM exact JOIN sig p ON p.id = a JOIN sig q ON q.id = b AND q.slot = p.slot WHERE p.value = q.value)
SELECT a, b, round(jaccard, 6) AS jaccard, """ + ", ".join(f"count(*) FILTER (WHERE slot < {t}) / {t} AS est_{t}" for t in SWEEP) + " FROM hits GROUP BY ALL")
def minhash_sweep(spark, sf):
    """Estimates from growing prefixes of one signature, next to the exact value."""
    members, _ = word_sets(spark, sf)
    pairs = materialize(overlap.jaccard_pairs(members, 0.5).select("a", "b", "jaccard"), "pairs")
    # Only ids that stand in a pair are signed, once for both sides.
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sig = materialize(doc_signatures(members.join(ids, "id", "left_semi"), max(SWEEP)), "signatures")
    return sg.agreement(pairs, sig, SWEEP).select("a", "b", F.round("jaccard", 6).alias("jaccard"), *[f"est_{t}" for t in SWEEP])


# Rows in a band, and bands.
ROWS, BANDS = 5, 20
BANDS_SQL = f"""bands AS MATERIALIZED (SELECT id, slot // {ROWS} AS band, string_agg(CAST(value AS VARCHAR), ',' ORDER BY slot) AS key FROM sig GROUP BY 1, 2),
cand AS MATERIALIZED (SELECT DISTINCT p.id AS a, q.id AS b FROM bands p JOIN bands q ON p.band = q.band AND p.key = q.key AND p.id < q.id)"""


def lsh_pairs(spark, sf):
    members, reps = word_sets(spark, sf)
    sig = materialize(doc_signatures(members, SLOTS), "signatures")
    return members, reps, sig, sg.candidates(sig, ROWS, BANDS)


@query("lsh_candidates", f"""WITH {WORD_SQL}, {minhash_sql('members', SLOTS)}, {BANDS_SQL} SELECT a, b, p.n_copies * q.n_copies AS weight FROM cand JOIN reps p ON p.id = a JOIN reps q ON q.id = b
UNION ALL {INSIDE_SQL}""")
def lsh_candidates(spark, sf):
    """Candidate pairs of different sets, each with the number of pairs it stands for; a = b stands for those of equal sets."""
    _, reps, _, pairs = lsh_pairs(spark, sf)
    return weigh(pairs, reps).unionByName(inside(reps))


PROB_SQL = "1 - pow(1 - pow(s, r), b)"


@query("lsh_probability", f"""WITH {EST_SQL}, {BANDS_SQL}, c AS (SELECT cand.a, cand.b, coalesce(shared, 0) / {SLOTS} AS s FROM cand LEFT JOIN est ON cand.a = est.a AND cand.b = est.b)
SELECT a, b, s AS est, round(1 - pow(1 - pow(s, {ROWS}), {BANDS}), 6) AS probability, s >= 0.6 AS verified FROM c""")
def lsh_probability(spark, sf):
    """Candidates with their estimate, the chance of having met, and whether they pass the check."""
    _, _, sig, pairs = lsh_pairs(spark, sf)
    scored = sg.agreement(pairs, sig, [SLOTS]).withColumnRenamed(f"est_{SLOTS}", "est")
    p = scalars.lsh_probability(F.col("est"), F.lit(ROWS), F.lit(BANDS))
    return scored.select("a", "b", "est", F.round(p, 6).alias("probability"), (F.col("est") >= 0.6).alias("verified"))


# The (rows, bands) settings compared.
CONFIGS = [(5, 10), (5, 20), (5, 40), (10, 20)]


@query("s_curve", f"""WITH {RAW_SQL}, {exact_sql(0.3)}, obs AS (SELECT round(jaccard, 2) AS s, count(*) AS n_pairs FROM exact GROUP BY 1),
cfg AS (SELECT * FROM (VALUES {', '.join(f'({r}, {b})' for r, b in CONFIGS)}) AS c(r, b))
SELECT s, n_pairs, r AS n_rows, b AS n_bands, round({PROB_SQL}, 6) AS probability, round(pow(1.0::DOUBLE / b, 1.0::DOUBLE / r), 6) AS threshold FROM obs, cfg""")
def s_curve(spark, sf):
    """The curve at each observed similarity, for four (rows, bands) settings."""
    members, reps = word_sets(spark, sf)
    between = weigh(overlap.jaccard_pairs(members, 0.3), reps).select(F.round("jaccard", 2).alias("s"), "weight")
    observed = between.unionByName(inside(reps).select(F.lit(1.0).alias("s"), "weight")).groupBy("s").agg(F.sum("weight").alias("n_pairs"))
    configs = F.explode(F.array(*[F.struct(F.lit(r).alias("n_rows"), F.lit(b).alias("n_bands")) for r, b in CONFIGS]))
    each = observed.withColumn("c", configs).select("s", "n_pairs", "c.n_rows", "c.n_bands")
    p = scalars.lsh_probability(F.col("s"), F.col("n_rows"), F.col("n_bands"))
    return each.select("s", "n_pairs", "n_rows", "n_bands", F.round(p, 6).alias("probability"),
                       F.round(scalars.lsh_threshold(F.col("n_rows"), F.col("n_bands")), 6).alias("threshold"))


def confused(est: DataFrame, truth: DataFrame, reps: DataFrame) -> DataFrame:
    """Error counts over all sets: weighted pairs of representatives, and the pairs of equal sets, which any estimate hits."""
    between = relational.confusion(weigh(est, reps), weigh(truth, reps), ["a", "b"], F.col("weight"))
    equal = inside(reps).agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("_n"))
    return between.join(F.broadcast(equal)).select("false_pos", "false_neg", (F.col("hits") + F.col("_n")).alias("hits"))  # one row each


@query("minhash_errors", f"""WITH {EST_SQL.replace(WORD_SQL, RAW_SQL)}, {exact_sql(0.5)},
e AS (SELECT a, b, p.n_copies * q.n_copies AS weight FROM est JOIN reps p ON p.id = a JOIN reps q ON q.id = b WHERE shared / {SLOTS} >= 0.5)
SELECT (SELECT coalesce(sum(weight), 0)::BIGINT FROM e ANTI JOIN exact USING (a, b)) AS false_pos,
  (SELECT coalesce(sum(weight), 0)::BIGINT FROM exact ANTI JOIN e USING (a, b)) AS false_neg,
  (SELECT coalesce(sum(weight), 0)::BIGINT FROM exact SEMI JOIN e USING (a, b)) AS hits""")
def minhash_errors(spark, sf):
    members, reps = word_sets(spark, sf)
    return confused(estimated(members, SLOTS, 0.5), overlap.jaccard_pairs(members, 0.5), reps)


@query("lsh_errors", f"""WITH {RAW_SQL}, {minhash_sql('members', SLOTS)}, {BANDS_SQL}, {exact_sql(0.6)},
e AS (SELECT a, b, p.n_copies * q.n_copies AS weight FROM cand JOIN reps p ON p.id = a JOIN reps q ON q.id = b)
SELECT (SELECT coalesce(sum(weight), 0)::BIGINT FROM e ANTI JOIN exact USING (a, b)) AS false_pos,
  (SELECT coalesce(sum(weight), 0)::BIGINT FROM exact ANTI JOIN e USING (a, b)) AS false_neg,
  (SELECT coalesce(sum(weight), 0)::BIGINT FROM exact SEMI JOIN e USING (a, b)) AS hits""")
def lsh_errors(spark, sf):
    members, reps, _, pairs = lsh_pairs(spark, sf)
    return confused(pairs, overlap.jaccard_pairs(members, 0.6), reps)


# Trials, and the signature lengths compared.
TRIALS, LENGTHS = 5, [50, 100, 200]


@query("minhash_trials", f"""WITH {WORD_SQL}, {exact_sql(0.5)}, {minhash_sql('members', max(LENGTHS), TRIALS)},
lens AS (SELECT unnest({LENGTHS}) AS t),
est AS MATERIALIZED (SELECT p.trial, t, p.id AS a, q.id AS b FROM sig p JOIN sig q ON p.trial = q.trial AND p.slot = q.slot AND p.value = q.value AND p.id < q.id JOIN lens ON p.slot < t
  GROUP BY ALL HAVING count(*) / t >= 0.5),
w AS (SELECT trial, t, a, b, p.n_copies * q.n_copies AS weight FROM est JOIN reps p ON p.id = a JOIN reps q ON q.id = b),
runs AS (SELECT trial, t FROM range({TRIALS}) r(trial), lens),
counts AS (SELECT r.trial, r.t, (SELECT coalesce(sum(w.weight), 0) FROM w LEFT JOIN exact x ON x.a = w.a AND x.b = w.b WHERE w.trial = r.trial AND w.t = r.t AND x.a IS NULL) AS fp,
  (SELECT coalesce(sum(x.weight), 0) FROM exact x WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.trial = r.trial AND w.t = r.t AND w.a = x.a AND w.b = x.b)) AS fn FROM runs r)
SELECT t::BIGINT AS n_hashes, round(avg(fp), 6) AS avg_fp, round(avg(fn), 6) AS avg_fn, round(stddev_samp(fp), 6) AS sd_fp, round(stddev_samp(fn), 6) AS sd_fn FROM counts GROUP BY 1""")
def minhash_trials(spark, sf):
    """Error counts over seeded trials; all trials and lengths share one overlap join."""
    members, reps = word_sets(spark, sf)
    members = materialize(members, "members")
    signed = [doc_signatures(members, max(LENGTHS), t).select(F.lit(t).cast("bigint").alias("trial"), "id", "signature") for t in range(TRIALS)]
    long = materialize(reduce(DataFrame.unionByName, signed), "signatures").select("trial", "id", F.posexplode("signature").alias("slot", "value"))
    lengths = F.explode(F.filter(F.array(*[F.lit(t) for t in LENGTHS]), lambda t: t > F.col("slot")))
    runs = long.withColumn("t", lengths).select(F.struct("trial", "t", "id").alias("id"), F.struct("trial", "t", "slot", "value").alias("elem"))
    est = overlap.agreeing_pairs(runs, 0.5).select(F.col("a.trial").alias("trial"), F.col("a.t").alias("t"), F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    est = materialize(weigh(est, reps), "estimated")
    truth = materialize(weigh(overlap.jaccard_pairs(members, 0.5), reps).select("a", "b", "weight"), "truth")
    hit = est.join(truth.select("a", "b", F.lit(True).alias("true")), ["a", "b"], "left")
    by_run = hit.groupBy("trial", "t").agg(
        F.coalesce(F.sum(F.when(F.col("true").isNull(), F.col("weight"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(F.col("true"), F.col("weight"))), F.lit(0)).alias("found"))
    grid = spark.range(TRIALS).select(F.col("id").alias("trial"), F.explode(F.array(*[F.lit(t) for t in LENGTHS])).alias("t"))
    total = truth.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).scalar()
    counts = grid.join(by_run, ["trial", "t"], "left").select("t", F.coalesce("fp", F.lit(0)).alias("fp"), (total - F.coalesce("found", F.lit(0))).alias("fn"))
    return counts.groupBy(F.col("t").cast("bigint").alias("n_hashes")).agg(
        F.round(F.avg("fp"), 6).alias("avg_fp"), F.round(F.avg("fn"), 6).alias("avg_fn"),
        F.round(F.stddev_samp("fp"), 6).alias("sd_fp"), F.round(F.stddev_samp("fn"), 6).alias("sd_fn"))
