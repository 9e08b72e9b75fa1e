"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import alignment, decontamination, encoding, licenses, privacy, quality, resampling, secrets, sharding, simhash, substring_dedup, suffix_dedup, toxicity
from affinity.llm.frames import BLANKS, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# Production parameters of the placement: equal shards.
SHARDS = {f"shard-{i:02d}": 1 for i in range(64)}
SHARD_SLOTS = sharding.next_prime(sharding.SLOTS_PER_SHARD * len(SHARDS))
_HOLDERS = ",".join(map(str, sharding.lookup_table(SHARDS, SHARD_SLOTS)))

OP1_SQL = f"""
WITH placed AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0))), 1, 15) AS BIGINT) % {SHARD_SLOTS} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST([{_HOLDERS}][slot + 1] AS VARCHAR), 2, '0') AS shard FROM placed"""


@query("op1_sharding", OP1_SQL)
def op1(spark, sf):
    """Every document on one of 64 shards."""
    return sharding.assign(table(spark, sf, "documents").select("doc_id"), ["doc_id"], SHARDS, SHARD_SLOTS)


_BLANK = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '{_BLANK}+'), lambda x: x <> '')"


def _normal_sql(line: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(translate({line}, '{_UPPER}', '{_LOWER}'), '{_BLANK}+', ' ', 'g')), '[0-9]+', '0', 'g')"


_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS p FROM (
  SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
c AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS p FROM (
  SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT DISTINCT c.r, c.i, c.m, p.item FROM c JOIN p ON c.m = p.m AND c.p = p.p),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM o) GROUP BY r),
it AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN it ON it.r = d.r"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark, sf):
    """Benchmark words and items of every document."""
    return decontamination.digest(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op3_bpe_encoding")
def op3(spark, sf):
    """Ids of every document, and their decoding."""
    return encoding.digest(table(spark, sf, "documents"), WORD_BPE)


def op5_sql(docs: str = "documents", max_texts: int = 100, least_left: float = 0.2) -> str:
    """Verdicts over a table with doc_id, text, source; r tells repeated rows apart."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM {docs}),
w AS (SELECT *, {_words_sql('text')} AS words, list_filter(string_split(text, chr(10)), lambda x: len({_words_sql('x')}) > 0) AS lines FROM d),
win AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 8)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
ln AS (SELECT r, host, text, {_normal_sql('line')} AS norm, len({_words_sql('line')}) AS words FROM (SELECT r, host, text, unnest(lines) AS line FROM w)),
freq AS (SELECT host, norm FROM ln GROUP BY host, norm HAVING count(DISTINCT text) > {max_texts}),
gone AS (SELECT r, count(*) AS n, sum(words) AS words FROM ln JOIN freq USING (host, norm) GROUP BY r),
base AS (SELECT w.r, doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(gone.n, 0) AS BIGINT) AS n_lines_removed, CAST(len(w.words) - coalesce(gone.words, 0) AS BIGINT) AS n_words_left
  FROM w LEFT JOIN cov ON cov.r = w.r LEFT JOIN gone ON gone.r = w.r)
SELECT * EXCLUDE (r), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words_left >= {least_left} * n_words AS kept
FROM base"""


@query("op5_quality_rules", op5_sql())
def op5(spark, sf):
    """Counts and verdicts of every document, lines counted for each source."""
    return quality.digest(table(spark, sf, "documents"))


def _literal(pattern: str) -> str:
    return pattern.replace("'", "''")


def _found_sql(kind: str) -> str:
    """Rows (r, k, s, e) of the matches of one kind that hold, by summed lengths of gaps and matches."""
    pattern = _literal(secrets.PATTERNS[kind])
    holds = {
        "assign": f"length(regexp_extract(value, '{pattern}', 1)) >= {secrets.ASSIGN_LEAST}",
        "part_secret": f"length(value) <= {secrets.PART_SECRET_MOST} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')",
    }.get(kind, "true")
    return f"""SELECT r, {secrets.KINDS.index(kind)} AS k, CAST(s AS BIGINT) AS s, CAST(s + length(value) AS BIGINT) AS e FROM (
    SELECT r, held[i] AS value, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(held[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT r, gaps, held, unnest(range(1, len(held) + 1)) AS i FROM (
      SELECT r, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS held FROM d WHERE regexp_matches(text, '{pattern}')))) WHERE {holds}"""


OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(_found_sql(k) for k in secrets.KINDS)}),
p AS (SELECT *, CASE k WHEN 4 THEN 'secret' WHEN 5 THEN 'endpoint' ELSE 'id' END AS role FROM f WHERE k IN (1, 3, 4, 5)),
met AS (SELECT a.r, a.k, a.s, a.e, a.role, bool_or(b.role = 'id') AS with_id, bool_or(b.role = 'secret') AS with_secret
  FROM p a JOIN p b ON a.r = b.r AND abs(a.s - b.s) <= {secrets.SCOPE} AND b.role <> 'endpoint' GROUP BY ALL),
linked AS (SELECT r, k, s, e FROM met WHERE k >= 3 AND CASE role WHEN 'id' THEN with_secret WHEN 'secret' THEN with_id ELSE with_id AND with_secret END),
base AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
  string_agg({secrets.KINDS}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM f WHERE k < 3 GROUP BY r),
every AS (SELECT r, string_agg({secrets.KINDS}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM (SELECT * FROM f WHERE k < 3 UNION ALL SELECT * FROM linked) GROUP BY r)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access, CAST(coalesce(h, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base.spans, '')) AS base_sha256, coalesce(every.spans, '') AS spans
FROM d LEFT JOIN base ON base.r = d.r LEFT JOIN every ON every.r = d.r"""


@query("op6_secret_scans", OP6_SQL)
def op6(spark, sf):
    """Secrets of every document, single ones and linked parts."""
    return secrets.digest(table(spark, sf, "documents"))


@query("op7_simhash_near_dedup")
def op7(spark, sf):
    """Fingerprint and group of every document."""
    return simhash.digest(table(spark, sf, "documents"))


def document_paths(docs: DataFrame) -> DataFrame:
    """(id, path, text): the table has no paths, so each document is filed by its source, language and id."""
    part = F.when(F.pmod("doc_id", F.lit(10)) != 0, F.concat(F.lit("part-"), F.floor(F.col("doc_id") / 1000).cast("string")))
    lang = F.when(F.pmod("doc_id", F.lit(100)) != 0, F.col("lang"))
    return docs.select(F.col("doc_id").alias("id"), F.concat_ws("/", "source", lang, part, F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt"))).alias("path"), "text")


@query("op4_license_scans")
def op4(spark, sf):
    """Licence of every document, its own or of the nearest folder with one; a document with a notice is the licence file of its folder."""
    out = licenses.scan(document_paths(table(spark, sf, "documents")), F.lit(True))
    return out.withColumnRenamed("id", "doc_id")


@query("op8_toxicity")
def op8(spark, sf):
    """Toxicity of every document."""
    return toxicity.digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_suffix_array_dedup")
def op9(spark, sf):
    """Bytes of every document that repeat earlier ones."""
    return suffix_dedup.digest(table(spark, sf, "documents"))


@query("op10_substring_dedup")
def op10(spark, sf):
    """Words of every document that repeat those of documents with smaller ids."""
    return substring_dedup.digest(table(spark, sf, "documents"))


@query("op11_personal_data")
def op11(spark, sf):
    """Personal values of every document, and the terms that disclose them."""
    return privacy.digest(table(spark, sf, "documents"))


# The checksum of a word from its bytes, by a table that the polynomial gives.
OP12_SQL = rf"""
WITH poly AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS told),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w FROM documents),
f AS (SELECT r, unnest(w) AS w FROM d),
g AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}')) AS w FROM benchmark),
v AS (SELECT w, xor(list_reduce([4294967295] || list_transform(range(CAST(length(hex(w)) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, told[(xor(c, x) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS b FROM (SELECT w FROM f UNION SELECT w FROM g), poly),
s AS (SELECT b, count(*) AS n FROM f JOIN v USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM g JOIN v USING (w) GROUP BY b),
gain AS (SELECT v.b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {resampling.BUCKETS})::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {resampling.BUCKETS})::DOUBLE))) AS BIGINT) AS x FROM (SELECT DISTINCT b FROM v) v LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
sums AS (SELECT r, sum(x) AS weight FROM f JOIN v USING (w) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN sums ON sums.r = d.r),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {resampling.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN place <= {resampling.SHARE[0]} * n // {resampling.SHARE[1]} THEN place END AS BIGINT) AS rank FROM scored LEFT JOIN placed ON placed.r = scored.r"""


@query("op12_importance_resampling", OP12_SQL)
def op12(spark, sf):
    """Likeness of every document to the benchmark, and the places of those drawn."""
    return resampling.digest(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op13_token_alignment")
def op13(spark, sf):
    """Groups and links of the tokens that two tokenizers make of every document."""
    return alignment.align(table(spark, sf, "documents"), BYTE_BPE, PIECE_BPE)
