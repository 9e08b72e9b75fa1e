"""Importance resampling against SQL and plain Python, on awkward rows and ties."""

from hashlib import sha256
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm import catalogue, resampling
from affinity.llm.decontamination import words_of
from tests.llm.test_against_sql import duck, frame, rows, same

SF = "/root/testdata/sf0.001"


def bench(spark):
    return spark.createDataFrame([(1, "w1x1 body alpha"), (2, None), (3, "w3x3 w4x4 w1x1 Body")], "item_id bigint, text string")


def test_against_sql(spark):
    con = duck([r if r[1] is None or len(r[1]) < 1000 else (r[0], r[1][:3000], r[2]) for r in rows()])
    con.execute("drop table benchmark")
    con.execute("create table benchmark as select * from (values (1, 'w1x1 body alpha'), (2, null), (3, 'w3x3 w4x4 w1x1 Body')) t(item_id, text)")
    docs = frame(spark, [r if r[1] is None or len(r[1]) < 1000 else (r[0], r[1][:3000], r[2]) for r in rows()])
    same(resampling.digest(docs, bench(spark)), con, catalogue.OP12_SQL)


def test_query_by_definition(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.doc_id: words_of(r.text) for r in docs.collect()}
    count = lambda lists: np.bincount([crc32(w) % 10000 for ws in lists for w in ws], minlength=10000)
    s, t = count(texts.values()), count(words_of(r.text) for r in items.collect())
    gain = [floor(1000 * log((float(b) + 1) * (float(t.sum()) * 0 + s.sum() + 10000) / ((float(a) + 1) * (t.sum() + 10000)))) for a, b in zip(s, t)]
    weight = {i: sum(gain[crc32(w) % 10000] for w in ws) for i, ws in texts.items()}
    h = {i: int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16) for i in texts}
    score = {i: weight[i] + floor(-1000 * log(-log((h[i] + 0.5) / 4294967296))) for i in texts}
    able = sorted((i for i in texts if len(texts[i]) >= 20), key=lambda i: (-score[i], i))
    place = {i: k + 1 for k, i in enumerate(able[: 10 * len(able) // 100])}
    got = {r.doc_id: tuple(r)[1:] for r in catalogue.QUERIES["op12_importance_resampling"](spark, SF).collect()}
    assert got == {i: (len(texts[i]), weight[i], score[i], place.get(i)) for i in texts}
    assert len(place) > 5


@pytest.mark.parametrize("share", [(0, 100), (1, 100), (37, 100), (1, 1)])
def test_ties_and_hot_rows(spark, share):
    """Most rows tie in score and id; the cutoff still parts exactly so many, and ranks have no gap."""
    text = "a b c d e f g h i j k l m n o p q r s t"
    values = [(None, text)] * 300 + [(7, text)] * 200 + [(7, text + " u")] * 3 + [(i, f"{text} v{i % 5}") for i in range(100)] + [(1, "short"), (2, None), (3, "")]
    docs = spark.createDataFrame([(*v, "x", 1) for v in values], "doc_id bigint, text string, rank string, row int")
    out = resampling.resample(docs, bench(spark), share=share).collect()
    able = [r for r in out if r.n_words >= 20]
    drawn = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert len(out) == len(values) and len(drawn) == share[0] * len(able) // share[1]
    assert [r["rank"] for r in drawn] == list(range(1, len(drawn) + 1))
    key = lambda r: (-r.score, -(1 << 63) if r.doc_id is None else r.doc_id, r.n_features)
    assert [key(r) for r in drawn] == sorted(map(key, able))[: len(drawn)]


def test_longer_runs(spark):
    got = resampling.feature_buckets([b"a", b"b", b"c"], 3, 1 << 32)
    assert got.tolist() == [crc32(x) for x in (b"a", b"b", b"c", b"a b", b"b c", b"a b c")]
    docs = spark.createDataFrame([(1, "A b c"), (2, "é B")], "doc_id bigint, text string")
    out = {r.doc_id: r for r in resampling.resample(docs, docs, longest=2).collect()}
    assert (out[1].n_features, out[2].n_features, out[1].weight) == (5, 3, 0)


def test_empty_tables(spark):
    docs, items = frame(spark), bench(spark)
    assert resampling.digest(docs.limit(0), items).collect() == []
    n = 10 * sum(len(words_of(r.text)) >= 20 for r in docs.collect()) // 100
    for d, b in ((docs, items.limit(0)), (docs, items)):
        out = resampling.digest(d, b).collect()
        assert len(out) == docs.count() and sorted(r["rank"] for r in out if r["rank"]) == list(range(1, n + 1))


@pytest.mark.parametrize("n", [0, 1, 5, 50, 99, 100])
def test_cutoff_over_wide_numbers(spark, n):
    draw = np.random.default_rng(n)
    values = pd.DataFrame({"a": draw.integers(-3, 3, 100) * (1 << 61), "b": draw.integers(-9, 9, 100), "c": np.arange(100)})
    df = spark.createDataFrame(values)
    got = df.where(resampling.first_in_order(df, [-F.col("a"), F.col("b"), F.col("c")], n)).toPandas()
    want = values.assign(k=-values.a).sort_values(["k", "b", "c"]).head(n)
    assert sorted(got.c) == sorted(want.c)


def test_schema(spark):
    out = resampling.digest(frame(spark), bench(spark))
    assert [f.dataType for f in out.schema] == [T.LongType()] * 5 and out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
