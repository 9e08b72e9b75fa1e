"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the blank characters of the word pattern [^\x20\x09-\x0D]+.
BLANKS = " \t\n\x0b\f\r"


def travels(module: str) -> None:
    """Sends the functions of a module to the Python workers by value, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, a null text as the empty one; other columns of the input never clash with an operator's own."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ in order; an empty array for a text without one."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def matching(docs: DataFrame, key: Column, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, ``key``) is among ``chosen`` (doc_id, text_key), or is not, for how = left_semi or left_anti.

    The chosen columns are renamed, so those of ``docs`` may have any names.
    """
    own = chosen.select(F.col("doc_id").alias("__chosen_id"), F.col("text_key").alias("__chosen_key")).distinct()
    return docs.join(own, F.col("doc_id").eqNullSafe(F.col("__chosen_id")) & (key == F.col("__chosen_key")), how)
