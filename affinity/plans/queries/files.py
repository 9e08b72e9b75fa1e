"""Sources and sinks: each query writes table data to scratch files and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.plans import views
from affinity.plans.registry import query
from affinity.sources import files
from affinity.sources.scratch import scratch_path

LINES_SQL = """lines AS MATERIALIZED (SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents))"""


def document_lines(spark, sf):
    d = views.corpus(spark, sf)
    return d.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line_no", (F.col("pos") + 1).cast("bigint"))


@query("text_lines_roundtrip", f"""WITH {LINES_SQL}
SELECT source, doc_id, line_no, row_number() OVER (PARTITION BY source ORDER BY doc_id, line_no) AS line_id FROM lines""")
def text_lines_roundtrip(spark, sf):
    """Lines written in range order, read back, and numbered inside each source folder."""
    path = scratch_path(spark, "lines")
    lines = document_lines(spark, sf).repartitionByRange("source", "doc_id", "line_no").sortWithinPartitions("source", "doc_id", "line_no")
    lines.select("source", F.concat_ws("\t", "doc_id", "line_no").alias("value")).write.partitionBy("source").text(path)
    numbered = files.number_lines(files.text_lines(spark, f"{path}/*/*.txt"))
    numbered = numbered.withColumn("source", F.regexp_extract("file_path", r"source=([^/]+)/", 1))
    sizes = numbered.groupBy("source", "file_name").agg(F.max("line_id").alias("n"))
    # A folder's files are one range after the other; their names sort in that order.
    before = views.Window.partitionBy("source").orderBy("file_name").rowsBetween(views.Window.unboundedPreceding, -1)
    bases = sizes.select("source", "file_name", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    parts = F.split("value", "\t")
    return numbered.join(bases, ["source", "file_name"]).select(
        "source", parts[0].cast("bigint").alias("doc_id"), parts[1].cast("bigint").alias("line_no"),
        (F.col("line_id") + F.col("base")).alias("line_id"))


@query("doc_assemble", "SELECT doc_id, md5(text) AS digest FROM documents")
def doc_assemble(spark, sf):
    whole = files.assemble(document_lines(spark, sf), ["doc_id"], "line_no", "line")
    return whole.select("doc_id", F.md5("text").alias("digest"))


@query("csv_roundtrip", f"WITH {views.INTERACTIONS_SQL} SELECT user_id, item_id, rating, day FROM interactions")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(views.interactions(spark, sf), path)
    return files.read_csv(spark, path, files.RATINGS_SCHEMA).toDF("user_id", "item_id", "rating", "day")


@query("tsv_rename", f"WITH {views.INTERACTIONS_SQL} SELECT user_id, count(*) AS n, sum(rating) AS total FROM interactions GROUP BY 1")
def tsv_rename(spark, sf):
    path = scratch_path(spark, "tsv")
    views.interactions(spark, sf).write.csv(path, sep="\t")
    rows = files.read_tsv(spark, path, files.RATINGS_SCHEMA, ["user_id", "item_id", "rating", "day"])
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"))


@query("vector_csv", f"WITH {views.POINTS_SQL} SELECT id, round(list_inner_product(v, v), 6) AS sq_norm, len(v) AS dims FROM points")
def vector_csv(spark, sf):
    path = scratch_path(spark, "vectors")
    p = views.points(spark, sf)
    p.select(F.array_join(F.concat(F.array(F.col("id").cast("string")), F.col("v").cast("array<string>")), ",").alias("value")).write.text(path)
    v = F.slice("v", F.lit(2), F.size("v"))
    from affinity.functions import arrays
    return files.read_vectors(spark, path).select(
        F.col("v")[0].cast("bigint").alias("id"), F.round(arrays.dot(v, v), 6).alias("sq_norm"), (F.size("v") - 1).cast("bigint").alias("dims"))


@query("edge_file", f"WITH {views.EDGES_SQL} SELECT src, dst FROM edges")
def edge_file(spark, sf):
    path = scratch_path(spark, "edges")
    e = views.edges(spark, sf)
    e.unionAll(e).select(F.concat_ws("\t", "src", "dst").alias("value")).write.text(path)
    return files.read_edges(spark, path)


def conversation_pages(spark, sf):
    """(page, text) through packs of records: one page for each turn of a conversation."""
    path = scratch_path(spark, "pages")
    c = views.table(spark, sf, "conversations")
    files.write_pages(c.select(F.concat_ws("-", "conv_id", "turn", "role").alias("page"), F.coalesce("text", F.lit("")).alias("text")), path)
    return files.packed_pages(spark, path)


@query("page_files", """SELECT 'conv-' || conv_id AS page, count(*) AS n_turns, sum(length(coalesce(text, '')))::BIGINT AS n_chars, sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1)::BIGINT AS n_lines
FROM conversations GROUP BY 1""")
def page_files(spark, sf):
    """Turns of conversations, written as packs, read back as pages and counted for each conversation."""
    page = F.concat(F.lit("conv-"), F.split("page", "-")[0])
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return conversation_pages(spark, sf).groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("n_turns"), F.sum(F.length("text")).alias("n_chars"), F.sum(lines).alias("n_lines"))


@query("first_line", """SELECT conv_id || '-' || turn || '-' || role AS page, string_split_regex(coalesce(text, ''), '\r?\n')[1] AS line FROM conversations""")
def first_line(spark, sf):
    return files.first_lines(conversation_pages(spark, sf))


@query("action_file", f"""WITH {views.PAGE_LOG_SQL} SELECT row_number() OVER (ORDER BY seq) AS seq, cmd, word, page FROM pagelog WHERE cmd = 'add' OR word <> ''""")
def action_file(spark, sf):
    """The action log written to files and read back, numbered from one."""
    path = scratch_path(spark, "actions")
    files.write_actions(views.page_log(spark, sf).filter("cmd = 'add' OR word <> ''"), path)
    return files.read_actions(spark, path).select("seq", "cmd", "word", "page")


@query("rows_frame", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def rows_frame(spark, sf):
    """A report is a DataFrame from the start; no rows pass through the driver."""
    c, n, r = (views.table(spark, sf, t) for t in ("customer", "nation", "region"))
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select("c_custkey", "n_name", "r_name")


# --- sampling --------------------------------------------------------------------

@query("hash_split", f"""WITH {views.SPLIT_SQL}
SELECT held_out, count(*) AS n, sum(rating) AS total FROM flagged GROUP BY 1""")
def hash_split(spark, sf):
    return views.interactions(spark, sf).groupBy(views.is_held_out().alias("held_out")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"))


@query("first_n", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50")
def first_n(spark, sf):
    return views.corpus(spark, sf).select("doc_id", "lang").orderBy("doc_id").limit(50)


MOST_ACTIVE_SQL = f"""{views.INTERACTIONS_SQL},
top_u AS (SELECT user_id FROM interactions GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 500),
top_i AS (SELECT item_id FROM interactions GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 500),
active AS MATERIALIZED (SELECT * FROM interactions SEMI JOIN top_u USING (user_id) SEMI JOIN top_i USING (item_id))"""


@query("most_active", f"WITH {MOST_ACTIVE_SQL} SELECT user_id, item_id, rating FROM active")
def most_active(spark, sf):
    from affinity.operators.relational import most_active as op
    return op(views.interactions(spark, sf), "user_id", "item_id", 500, 500).select("user_id", "item_id", "rating")
