"""Corpus cleaning, metadata, tokens and TF-IDF."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from affinity.functions import texts
from affinity.operators import termweights as tw
from affinity.plans import views
from affinity.plans.registry import query

TF_SQL = f"""{views.TOKENS_SQL},
tf AS MATERIALIZED (SELECT doc_id, word, count(*) AS tf FROM tokens GROUP BY 1, 2),
df AS MATERIALIZED (SELECT word, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(*) AS n FROM documents),
weights AS MATERIALIZED (SELECT doc_id, word, tf, df, ln(n.n / df) AS idf, tf * ln(n.n / df) AS tfidf FROM tf JOIN df USING (word), n)"""


def corpus_weights(spark, sf, idf="raw"):
    docs = views.corpus(spark, sf)
    return tw.tfidf(tw.term_frequencies(docs), tw.count_docs(docs), idf)


@query("tfidf_top_terms", f"""WITH {TF_SQL},
ranked AS (SELECT doc_id, word, tf, df, round(tfidf, 6) AS score,
  row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf, 6) DESC, word) AS rank FROM weights)
SELECT doc_id, rank, word, tf, df, score FROM ranked WHERE rank <= 5""")
def tfidf_top_terms(spark, sf):
    return tw.top_terms(corpus_weights(spark, sf), 5).select("doc_id", "rank", "word", "tf", "df", "score")


@query("tfidf_top_overall", f"""WITH {TF_SQL}
SELECT doc_id, word, round(tfidf, 6) AS score FROM weights ORDER BY score DESC, word, doc_id LIMIT 20""")
def tfidf_top_overall(spark, sf):
    return tw.top_terms(corpus_weights(spark, sf), 20, key=None).select("doc_id", "word", "score")


@query("document_frequency", f"""WITH {TF_SQL}
SELECT word, df, round(ln(n.n / df), 6) AS idf_raw, round(ln((n.n + 1) / (df + 1)), 6) AS idf_smooth FROM df, n""")
def document_frequency(spark, sf):
    docs = views.corpus(spark, sf)
    raw = tw.document_frequencies(tw.term_frequencies(docs), tw.count_docs(docs))
    n = tw.count_docs(docs).scalar()
    smooth = F.log((n + 1.0) / (F.col("df") + 1.0))
    return raw.select("word", "df", F.round("idf", 6).alias("idf_raw"), F.round(smooth, 6).alias("idf_smooth"))


@query("metadata_fields", f"""WITH {views.BOOKS_SQL}
SELECT doc_id, regexp_extract(text, '(?i)Title:\\s*(.*)', 1) AS title,
  regexp_extract(text, '(?i)Release Date:\\s*(.*)', 1) AS release_date,
  regexp_extract(text, '(?i)Language:\\s*(.*)', 1) AS language,
  regexp_extract(text, '(?i)(Character set encoding|Encoding):\\s*(.*)', 2) AS encoding FROM books""")
def metadata_fields(spark, sf):
    return metadata(spark, sf).select("doc_id", "title", "release_date", "language", "encoding")


def metadata(spark, sf):
    text = F.col("text")
    return views.books(spark, sf).select(
        "doc_id",
        texts.field(text, texts.TITLE).alias("title"),
        texts.field(text, texts.RELEASE_DATE).alias("release_date"),
        texts.field(text, texts.LANGUAGE).alias("language"),
        texts.field(text, texts.ENCODING, 2).alias("encoding"),
    )


@query("author_year", f"""WITH {views.BOOKS_SQL},
found AS (SELECT doc_id, regexp_extract(text, 'by\\s+([A-Za-z.\\s]+)', 1) AS author,
  TRY_CAST(regexp_extract(text, '(19\\d{{2}}|20\\d{{2}})', 1) AS INTEGER) AS year FROM books)
SELECT doc_id, author, year FROM found WHERE author <> '' AND year IS NOT NULL""")
def author_year(spark, sf):
    text = F.col("text")
    found = views.books(spark, sf).select(
        "doc_id", texts.field(text, texts.AUTHOR).alias("author"), texts.year(text, texts.MODERN_YEAR).alias("year"))
    return found.filter((F.col("author") != "") & F.col("year").isNotNull())


@query("boilerplate", f"""WITH {views.BOOKS_SQL},
c AS (SELECT doc_id, regexp_replace(text, '(?s)\\*\\*\\* START OF.*?\\*\\*\\*|\\*\\*\\* END OF.*?\\*\\*\\*', '', 'g') AS clean FROM books)
SELECT doc_id, length(clean) AS n_chars, md5(clean) AS digest FROM c""")
def boilerplate(spark, sf):
    clean = texts.strip_boilerplate(F.col("text"))
    return views.books(spark, sf).select("doc_id", F.length(clean).cast("bigint").alias("n_chars"), F.md5(clean).alias("digest"))


@query("year_counts", f"""WITH {views.BOOKS_SQL}
SELECT regexp_extract(regexp_extract(text, '(?i)Release Date:\\s*(.*)', 1), '(\\d{{4}})', 1) AS year, count(*) AS n_books
FROM books GROUP BY 1 ORDER BY 1""")
def year_counts(spark, sf):
    year = texts.field(F.col("release_date"), texts.FOUR_DIGITS).alias("year")
    return metadata(spark, sf).groupBy(year).agg(F.count(F.lit(1)).alias("n_books")).filter("year != ''").orderBy("year")


@query("top_language", f"""WITH {views.BOOKS_SQL}
SELECT regexp_extract(text, '(?i)Language:\\s*(.*)', 1) AS language, count(*) AS n_books FROM books GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def top_language(spark, sf):
    counts = metadata(spark, sf).groupBy("language").agg(F.count(F.lit(1)).alias("n_books"))
    return counts.orderBy(F.desc("n_books"), "language").limit(1)


@query("title_length", f"""WITH {views.BOOKS_SQL}
SELECT round(avg(length(regexp_extract(text, '(?i)Title:\\s*(.*)', 1))), 6) AS avg_title_length FROM books""")
def title_length(spark, sf):
    return metadata(spark, sf).agg(F.round(F.avg(F.length("title")), 6).alias("avg_title_length"))


@query("preview", "SELECT doc_id, substr(text, 1, 100) AS preview, length(text) AS n_chars FROM documents")
def preview(spark, sf):
    return views.corpus(spark, sf).select(
        "doc_id", F.substring("text", 1, 100).alias("preview"), F.length("text").cast("bigint").alias("n_chars"))


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@query("stopwords", f"""WITH {views.TOKENS_SQL}, counted AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE word NOT IN ({_quoted(texts.ENGLISH_STOP_WORDS)})) AS n_kept FROM tokens GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_kept, 0) AS n_kept FROM documents LEFT JOIN counted USING (doc_id)""")
def stopwords(spark, sf):
    """Words left per document after the default English list."""
    words = views.corpus(spark, sf).select("doc_id", texts.tokens(F.col("text")).alias("words"))
    kept = StopWordsRemover(inputCol="words", outputCol="kept").transform(words)
    return kept.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.size("kept").cast("bigint").alias("n_kept"))


PUNCT_SQL = "translate(text, '{}[]<>=().,;''\"?!-:', '                    ')"
SEARCH_WORDS_SQL = f"""raw AS MATERIALIZED (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM (
  SELECT doc_id, string_split(trim(regexp_replace(lower({PUNCT_SQL}), '\\s+', ' ', 'g')), ' ') AS words FROM documents)),
plural AS MATERIALIZED (SELECT doc_id, pos, CASE word WHEN 'stacks' THEN 'stack' WHEN 'structures' THEN 'structure' WHEN 'applications' THEN 'application' ELSE word END AS word FROM raw WHERE word <> '')"""


@query("custom_stopwords", f"""WITH {SEARCH_WORDS_SQL}
SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE word NOT IN ({_quoted(texts.SEARCH_STOP_WORDS)})) AS n_kept FROM plural GROUP BY 1""")
def custom_stopwords(spark, sf):
    words = texts.search_words(F.col("text"))
    kept = F.filter(words, lambda w: ~texts.is_search_stop_word(w))
    counted = views.corpus(spark, sf).select("doc_id", F.size(words).cast("bigint").alias("n_words"), F.size(kept).cast("bigint").alias("n_kept"))
    return counted.filter("n_words > 0")


@query("punct_plural", f"""WITH {SEARCH_WORDS_SQL}
SELECT word, count(*) AS n FROM plural GROUP BY 1""")
def punct_plural(spark, sf):
    words = views.corpus(spark, sf).select(F.explode(texts.search_words(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("genre_split", f"""WITH {views.TAGS_SQL}
SELECT tag, count(*) AS n_items FROM tags GROUP BY 1""")
def genre_split(spark, sf):
    return views.item_tags(spark, sf).groupBy("tag").agg(F.count(F.lit(1)).alias("n_items"))
