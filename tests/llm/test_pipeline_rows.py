"""Every stage of the pipeline on awkward rows and on empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from affinity.llm import decontamination, quality, simhash
from tests.llm.test_against_sql import SF, frame


@pytest.fixture(scope="module")
def docs(spark):
    """Null and repeated ids, null and empty and long texts, copies, a column of every name that a stage uses, and n_chars."""
    return frame(spark).withColumn("n_chars", F.length("text").cast("bigint")).withColumn("component", F.lit(None).cast("string"))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), SF)
    assert out.collect() == []
    assert out.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0]


def test_awkward_rows(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(map(str, df.select("doc_id", "source").collect()))
    held = {n: stages[n](spark, docs, SF) for n in stages}
    for name, out in list(held.items())[:-1]:
        assert out.columns == docs.columns, name
        assert out.where("n_chars <> length(text)").count() == 0, name
    assert held["quality_rules"].count() == quality.digest(docs).where("kept").count() < docs.count()
    assert held["simhash_near_dedup"].count() == simhash.near_duplicates(docs).select("component").distinct().count() < docs.count()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert held["benchmark_decontamination"].count() == decontamination.digest(docs, bench).where("not contaminated").count()
    assert rows(held["secret_scans"]) == rows(docs)
    assert held["secret_scans"].where("text IS NULL").count() == docs.where("text IS NULL").count()
    made = held["bpe_encoding"].collect()
    assert len(made) == docs.count() and all(r.n_tokens == len(r.ids) for r in made)
