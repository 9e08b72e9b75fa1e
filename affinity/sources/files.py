"""File sources and sinks. Schemas are explicit, so no pass is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()), T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType()),
])
ITEMS_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()), T.StructField("title", T.StringType()), T.StructField("genres", T.StringType()),
])


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """(value, file_path, file_name, block_start, line_key): lines with their origin.

    (block_start, line_key) orders the lines of one file, over all its splits.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line_key"),
    )
    return lines.withColumn("file_name", F.regexp_extract("file_path", r"([^/]+$)", 1))


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds the 1-based ``line_id`` inside each file.

    Line keys are consecutive within a split, so a line's number is its
    distance from the split's first key plus the lines of earlier splits: one
    row per split is combined per file, never a whole file in one task.
    """
    splits = lines.groupBy("file_path", "block_start").agg(F.min("line_key").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (
        lines.join(bases, ["file_path", "block_start"])
        .withColumn("line_id", F.col("_base") + F.col("line_key") - F.col("_first") + 1)
        .drop("_base", "_first")
    )


def assemble(lines: DataFrame, keys: list[str], order: str, value: str = "value", sep: str = "\n") -> DataFrame:
    """Lines back to one text per key, in order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["v"]), sep).alias("text"))


def whole_files(spark: SparkSession, paths) -> DataFrame:
    """(page, text): one row per file, named after the file."""
    pages = spark.read.text(paths, wholetext=True)
    return pages.select(F.regexp_extract("_metadata.file_path", r"([^/]+$)", 1).alias("page"), F.col("value").alias("text"))


# Fixed value: the separator of records in a pack.
RECORD = "\x1e"


def write_pages(pages: DataFrame, path: str) -> None:
    """(page, text) rows as packs: few large files of many pages, each a record of its name, a line end and its text.

    A file for each page would cost a task and an entry of the file system
    each. Names hold no line end, names and texts no record separator.
    """
    pages.select(F.concat("page", F.lit("\n"), "text").alias("value")).write.option("lineSep", RECORD).text(path)


def packed_pages(spark: SparkSession, paths) -> DataFrame:
    """(page, text): the pages of packs; a large pack is read in many tasks, cut at its records."""
    at = F.position(F.lit("\n"), F.col("value"))
    records = spark.read.option("lineSep", RECORD).text(paths)
    return records.select(F.substring("value", F.lit(1), at - 1).alias("page"), F.substring("value", at + 1, F.length("value")).alias("text"))


def first_lines(pages: DataFrame) -> DataFrame:
    """(page, line): the first line of each page, of :func:`whole_files` or :func:`packed_pages`."""
    return pages.select("page", F.split("text", r"\r?\n", 2)[0].alias("line"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, names: list[str] | None = None) -> DataFrame:
    table = spark.read.schema(schema).csv(path, sep="\t", header=False)
    return table.toDF(*names) if names else table


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(v): one comma-separated line of numbers per vector."""
    numbers = F.transform(F.split(F.trim("value"), ","), lambda x: x.cast("double"))
    return spark.read.text(path).filter(F.trim("value") != "").select(numbers.alias("v"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst): distinct pairs of a whitespace-separated edge list."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.trim("value") != "").select(
        parts[0].cast("bigint").alias("src"), parts[1].cast("bigint").alias("dst")).distinct()


# The command names of an action log.
ADD_PAGE = "addPage"
FIND_PAGES = "queryFindPagesWhichContainWord"
FIND_POSITIONS = "queryFindPositionsOfWordInAPage"


def write_actions(log: DataFrame, path: str) -> None:
    """(seq, cmd, word, page) rows as an action log: files whose names and lines follow the order."""
    name = F.when(F.col("cmd") == "add", ADD_PAGE).when(F.col("cmd") == "find", FIND_PAGES).when(F.col("cmd") == "where", FIND_POSITIONS)
    lines = log.repartitionByRange("seq").sortWithinPartitions("seq")
    lines.select(F.concat_ws(" ", name, "word", "page").alias("value")).write.text(path)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """(seq, cmd, word, page) from an ordered action log: a file, or a folder whose files follow each other by name."""
    lines = number_lines(text_lines(spark, path))
    files = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select("file_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    lines = lines.join(starts, "file_path").withColumn("line_id", F.col("_start") + F.col("line_id")).filter(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"\s+")
    cmd = F.get(parts, F.lit(0))
    first, second = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    return lines.select(
        F.col("line_id").alias("seq"),
        F.when(cmd == ADD_PAGE, "add").when(cmd == FIND_PAGES, "find").when(cmd == FIND_POSITIONS, "where").alias("cmd"),
        F.when(cmd != ADD_PAGE, F.lower(first)).alias("word"),
        F.when(cmd == ADD_PAGE, first).otherwise(second).alias("page"),
    )


def write_csv(report: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwriting CSV sink with a header; ``single_file`` only for small reports."""
    (report.coalesce(1) if single_file else report).write.mode("overwrite").option("header", True).csv(path)
