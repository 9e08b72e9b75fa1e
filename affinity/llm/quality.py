"""Quality rules: counts of one text, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.frames import BLANKS, lower_ascii, matching, words_of
from affinity.sources.scratch import materialize

# The contract's symbols, window, and limits of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


def _repeat_columns(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside windows of WINDOW words that the text holds twice or more.

    Works inside the row. Window hashes are sorted with their places, equal
    neighbours are the repeats, and their places are merged from left to right.
    """
    n = F.size("words")
    windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    df = df.withColumn("windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(some, F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i")))))
    df = df.withColumn("placed", placed).drop("windows")

    def twin(i: Column) -> Column:
        own = F.get("placed", i)["x"]
        return F.coalesce(own == F.get("placed", i - 1)["x"], F.lit(False)) | F.coalesce(own == F.get("placed", i + 1)["x"], F.lit(False))

    places = F.transform(F.filter(F.sequence(F.lit(0), F.size("placed") - 1), twin), lambda i: F.get("placed", i)["i"])
    df = df.withColumn("places", F.when(F.col("placed").isNotNull(), F.sort_array(places))).drop("placed")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("covered"))

    def step(acc: Column, i: Column) -> Column:
        return F.struct((i + WINDOW).alias("end"), (acc["covered"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("covered"))

    covered = F.aggregate("places", start, step, lambda acc: acc["covered"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("places")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, host, lines, line_words, n_words, the four counts, base_failed): a row for each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("host"), text.alias("text"))
    df = df.withColumn("words", words_of(F.col("text")))
    df = _repeat_columns(df)
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    df = df.select(
        "doc_id", "host", "text", "lines", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def normal_line(line: Column) -> Column:
    """ASCII lower case, one space between words, every run of digits as 0."""
    return F.regexp_replace(F.btrim(F.regexp_replace(lower_ascii(line), r"[\x20\x09-\x0D]+", " ")), "[0-9]+", "0")


def _judged(docs: DataFrame, max_texts: int = 100, least_left: float = 0.2) -> DataFrame:
    """The columns of ``judge`` and gone: the places, from 0 and in order, of the removed ones among the lines with words; null if there are none."""
    held = F.transform("lines", lambda x: F.struct(F.xxhash64("host", normal_line(x)).alias("line"), F.size(words_of(x)).alias("words")))
    rows = materialize(measured(docs).withColumn("text_key", F.xxhash64("host", "text")).withColumn("held", held).drop("text", "lines", "host"), "quality")
    lines = rows.select("text_key", F.explode(F.array_distinct(F.transform("held", lambda x: x["line"]))).alias("line"))
    # Equal texts of a host are folded first, so a group of copies is one row for each line and task.
    frequent = lines.distinct().groupBy("line").agg(F.count("*").alias("texts")).where(F.col("texts") > max_texts).select("line")
    # Written first, so that the planner broadcasts it only if its size allows.
    frequent = materialize(frequent, "frequent-lines")
    each = rows.select("doc_id", "text_key", F.posexplode("held").alias("place", "x")).select("doc_id", "text_key", "place", "x.line", "x.words")
    removed = each.join(frequent, "line").select("doc_id", "text_key", "place", "words").distinct()
    removed = removed.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.count("*").alias("n_lines_removed"), F.sum("words").alias("words_gone"), F.sort_array(F.collect_list("place")).alias("gone"))
    out = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    out = out.withColumn("n_lines_removed", F.coalesce("n_lines_removed", F.lit(0)).cast("bigint"))
    out = out.withColumn("n_words_left", F.col("n_words") - F.coalesce("words_gone", F.lit(0)))
    kept = ~F.col("base_failed") & (F.col("n_words_left") >= least_left * F.col("n_words"))
    return out.withColumn("kept", kept).select(*OUT, "gone")


def judge(docs: DataFrame, **limits) -> DataFrame:
    """Counts and verdict of each row of ``docs`` (doc_id, text, source as the host).

    A normalised line is above the limit if more than ``max_texts`` different
    texts of one host hold it; exact copies count once, since removing copies is
    another operator's work. Such lines are removed; ``cleaned`` gives the texts
    without them. A document is depleted,
    and rejected, if fewer than ``least_left`` of its words remain; one that the
    base rules fail on its input is rejected too. Besides the base columns:
    n_lines_removed, n_words_left, kept.

    Null and empty texts have no words and fail; a null host is a host of its
    own; repeated rows get equal verdicts; an empty table gives an empty one.
    Shuffled are line hashes, folded in the map task, and the few lines above
    the limit; no text. A line is known by 64 bits of host and line.
    """
    return _judged(docs, **limits).select(*OUT)


def digest(docs: DataFrame, **limits) -> DataFrame:
    return judge(docs, **limits).drop("text_key")


OUT = ["doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "n_words_left", "base_failed", "kept"]


def filtered(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns and their whole texts."""
    own = F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    return matching(docs, own, judge(docs, **limits).where("kept"), "left_semi")


def cleaned(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``filtered``, the lines above the limit taken out of their texts; blank lines stay.

    The lines between two removed places are sliced out of the row's own array,
    so a text is cut in time that grows with its lines.
    """
    names = docs.columns
    chosen = _judged(docs, **limits).where("kept").dropDuplicates(["doc_id", "text_key"])
    chosen = chosen.select(F.col("doc_id").alias("__chosen_id"), F.col("text_key").alias("__chosen_key"), F.col("gone").alias("__gone"))
    own = F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    rows = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("__chosen_id")) & (own == F.col("__chosen_key")))
    rows = rows.withColumn("__all", F.when(F.col("__gone").isNotNull(), F.split("text", "\n")))
    # Removed places count lines with words only.
    worded = F.filter(F.sequence(F.lit(0), F.size("__all") - 1), lambda i: F.btrim(F.get("__all", i), F.lit(BLANKS)) != "")
    rows = rows.withColumn("__worded", F.when(F.col("__all").isNotNull(), worded))
    ends = F.concat(F.array(F.lit(-1)), F.transform("__gone", lambda g: F.get("__worded", g)), F.array(F.size("__all")))
    rows = rows.withColumn("__ends", F.when(F.col("__all").isNotNull(), ends))
    between = F.transform(F.sequence(F.lit(0), F.size("__ends") - 2), lambda k: F.slice("__all", F.get("__ends", k) + 2, F.get("__ends", k + 1) - F.get("__ends", k) - 1))
    left = F.when(F.col("__all").isNotNull(), F.array_join(F.flatten(between), "\n")).otherwise(F.col("text"))
    return rows.withColumn("text", left).select(*names)
