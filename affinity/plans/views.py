"""Views over the star-schema tables, each in Spark and as SQL text.

They stand for the inputs of the operators: a book corpus, ratings, an item
dimension, a link graph, authors by first day, points, a policy log and an
action log. Every view covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.functions.hashing import hash32


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistributes a scan that has fewer tasks than the cluster has cores.

    Text work is all CPU, so a corpus of a few files would leave most cores
    idle; a corpus of many files is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def corpus(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")


# --- books: documents with a header and boilerplate markers -----------------

BOOK_YEARS = 60  # release years cycle over 1950..2009


def books(spark, sf) -> DataFrame:
    d = corpus(spark, sf)
    year = F.lit(1950) + F.pmod(F.col("doc_id") * 7, F.lit(BOOK_YEARS))
    text = F.concat(
        F.lit("Title: "), F.col("source"), F.lit(" volume "), F.col("doc_id").cast("string"),
        F.lit("\nRelease Date: March "), (F.pmod("doc_id", F.lit(28)) + 1).cast("string"), F.lit(", "),
        year.cast("string"), F.lit(" [EBook #"), F.col("doc_id").cast("string"), F.lit("]\nLanguage: "), F.col("lang"),
        F.lit("\nCharacter set encoding: UTF-8\n*** START OF THIS BOOK ***\n"), F.col("text"),
        F.lit("\n*** END OF THIS BOOK ***\nwritten by "), F.col("source"), F.lit("\n"),
    )
    return d.select("doc_id", text.alias("text"))


BOOKS_SQL = f"""books AS (
  SELECT doc_id, 'Title: ' || source || ' volume ' || doc_id || chr(10) || 'Release Date: March '
    || (doc_id % 28 + 1) || ', ' || (1950 + (doc_id * 7) % {BOOK_YEARS}) || ' [EBook #' || doc_id || ']' || chr(10)
    || 'Language: ' || lang || chr(10) || 'Character set encoding: UTF-8' || chr(10) || '*** START OF THIS BOOK ***'
    || chr(10) || text || chr(10) || '*** END OF THIS BOOK ***' || chr(10) || 'written by ' || source || chr(10) AS text
  FROM documents)"""


# --- interactions: who bought which part, as a half-star rating -------------

def interactions(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    bought = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        bought.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.max(F.col("l_quantity").cast("bigint")).alias("q"), F.max("o_orderdate").alias("d"))
        .select(
            "user_id", "item_id",
            (F.lit(0.5) + F.lit(0.5) * F.pmod("q", F.lit(10))).alias("rating"),
            F.datediff(F.col("d"), F.lit("1970-01-01")).cast("bigint").alias("day"),
        )
    )


INTERACTIONS_SQL = """interactions AS MATERIALIZED (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CAST(0.5 + 0.5 * (max(CAST(l_quantity AS BIGINT)) % 10) AS DOUBLE) AS rating,
    date_diff('day', DATE '1970-01-01', CAST(max(o_orderdate) AS DATE)) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

TEST_SHARE = 20  # per cent held out
SPLIT_SEED = 42


def is_held_out(seed: int = SPLIT_SEED, share: int = TEST_SHARE):
    return F.pmod(hash32("split", seed, F.col("user_id"), F.col("item_id")), F.lit(100)) < share


def train(spark, sf) -> DataFrame:
    return interactions(spark, sf).filter(~is_held_out())


def test(spark, sf) -> DataFrame:
    return interactions(spark, sf).filter(is_held_out())


SPLIT_SQL = f"""{INTERACTIONS_SQL},
flagged AS (SELECT *, ('0x' || substr(md5('split:{SPLIT_SEED}:' || user_id || ':' || item_id), 1, 8))::BIGINT % 100 < {TEST_SHARE} AS held_out
  FROM interactions),
train AS MATERIALIZED (SELECT user_id, item_id, rating, day FROM flagged WHERE NOT held_out),
test AS MATERIALIZED (SELECT user_id, item_id, rating, day FROM flagged WHERE held_out)"""


# --- items: parts with a title and tags -------------------------------------

def items(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.pmod("p_partkey", F.lit(70))).cast("string"), F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand"), F.lit("|"), F.translate("p_name", " ", "|")).alias("genres"),
    )


ITEMS_SQL = """items AS MATERIALIZED (
  SELECT p_partkey AS item_id, p_name || ' (' || (1950 + p_partkey % 70) || ')' AS title,
    p_type || '|' || p_brand || '|' || replace(p_name, ' ', '|') AS genres FROM part)"""


def item_tags(spark, sf) -> DataFrame:
    """(item_id, tag), one row per distinct tag of an item."""
    return items(spark, sf).select("item_id", F.explode(F.array_distinct(F.split("genres", r"\|"))).alias("tag"))


TAGS_SQL = f"""{ITEMS_SQL},
tags AS MATERIALIZED (SELECT DISTINCT item_id, unnest(string_split(genres, '|')) AS tag FROM items)"""


# --- edges: parts bought one after the other in an order --------------------

def edges(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    return (
        li.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"))
        .filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))).distinct()
    )


EDGES_SQL = """edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
    FROM lineitem) WHERE dst IS NOT NULL AND src <> dst)"""


# --- firsts: suppliers with the day of their first shipment ------------------

def firsts(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first"))
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("author"), F.datediff(F.col("first"), F.lit("1970-01-01")).cast("bigint").alias("first_day")
    )


FIRSTS_SQL = """firsts AS MATERIALIZED (
  SELECT s_name AS author, date_diff('day', DATE '1970-01-01', CAST(min(l_shipdate) AS DATE)) AS first_day
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name)"""


# --- points -------------------------------------------------------------------

def points(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")


POINTS_SQL = "points AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


# --- logged: rewards of served arms -------------------------------------------

def logged(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("arm"),
        F.when(F.col("value") >= 50, 1.0).otherwise(-1.0).alias("reward"),
        "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )


LOGGED_SQL = """logged AS MATERIALIZED (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS arm,
    CASE WHEN value >= 50 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS reward, event_type, epoch_us(ts) AS us FROM events)"""

HOUR_US = 3600 * 1000 * 1000


# --- pagelog: documents added in id order, with queries in between -------------

QUERY_EVERY = 5  # a query follows every fifth page


def page_log(spark, sf) -> DataFrame:
    """(seq, cmd, word, page): each page add, and queries for words of earlier and later pages."""
    d = corpus(spark, sf)
    page = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    adds = d.select((F.col("doc_id") * 10).alias("seq"), F.lit("add").alias("cmd"), F.lit(None).cast("string").alias("word"), page.alias("page"))
    asked = d.filter(F.pmod("doc_id", F.lit(QUERY_EVERY)) == 0).select(
        "doc_id", F.lower(F.regexp_extract("text", r"([A-Za-z]+)", 1)).alias("word"), page.alias("page"))
    find = asked.select((F.col("doc_id") * 10 + 1).alias("seq"), F.lit("find").alias("cmd"), "word", F.lit(None).cast("string").alias("page"))
    where = asked.select((F.col("doc_id") * 10 + 2).alias("seq"), F.lit("where").alias("cmd"), "word",
                         F.concat(F.lit("doc"), (F.col("doc_id") + F.pmod("doc_id", F.lit(3)) - 1).cast("string")).alias("page"))
    early = asked.select((F.col("doc_id") * 10 - 1).alias("seq"), F.lit("find").alias("cmd"), "word", F.lit(None).cast("string").alias("page"))
    return adds.unionByName(find).unionByName(where).unionByName(early)


PAGE_LOG_SQL = f"""asked AS MATERIALIZED (SELECT doc_id, lower(regexp_extract(text, '([A-Za-z]+)', 1)) AS word FROM documents WHERE doc_id % {QUERY_EVERY} = 0),
pagelog AS MATERIALIZED (
  SELECT doc_id * 10 AS seq, 'add' AS cmd, NULL AS word, 'doc' || doc_id AS page FROM documents
  UNION ALL SELECT doc_id * 10 + 1, 'find', word, NULL FROM asked
  UNION ALL SELECT doc_id * 10 + 2, 'where', word, 'doc' || (doc_id + doc_id % 3 - 1) FROM asked
  UNION ALL SELECT doc_id * 10 - 1, 'find', word, NULL FROM asked)"""


# --- tokens ---------------------------------------------------------------------

TOKENS_SQL = """tokens AS MATERIALIZED (
  SELECT doc_id, word FROM (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(lower(text), '[^a-z\\s]', '', 'g'), '\\s+')) AS word FROM documents)
  WHERE word <> '')"""


def uniform_sql(*parts: str) -> str:
    """SQL twin of ``hashing.uniform``; parts are SQL expressions."""
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"((CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE))"
