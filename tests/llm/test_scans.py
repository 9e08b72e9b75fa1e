"""Licence and toxicity scans against brute force and held-out labels."""

import itertools
import random
from collections import Counter
from math import exp, log, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm import licenses, toxicity
from affinity.llm.decontamination import words_of


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments(seed):
    """By the definition: the best segment, then the best on each side of it, and so on."""
    draw = random.Random(seed)
    scores = [draw.choice([-1.0, -1.0, 0.7, 1.9, 2.6]) for _ in range(draw.randint(0, 40))]

    def plain(a, b):
        best = max(((sum(scores[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        tops = [x for x in ((sum(scores[i:j]), i, j) for i in range(a, b) for j in range(i + 1, b + 1)) if abs(x[0] - best[0]) < 1e-9]
        score, i, j = min(tops, key=lambda x: (x[2] - x[1], x[1]))
        return [*plain(a, i), (i, j, score), *plain(j, b)]

    places = [i for i, s in enumerate(scores) if s > 0]
    got = toxicity.segments(places, [scores[i] for i in places], -1.0)
    assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in plain(0, len(scores))))
    assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in plain(0, len(scores))), default=0))
    for a, b, s in got:
        assert s == pytest.approx(sum(scores[a:b]))
    assert all(x[1] <= y[0] for x, y in itertools.pairwise(got))


def test_toxicity_of_awkward_rows(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [(None, "w1 foul"), (-1, None), (-2, "")], [(None, 1, 1), (-1, 0, 0), (5000, 0, 1)]
    for i in range(400):
        toxic = i % 5 == 0
        text = draw.choices(words, k=60)
        if toxic:
            text[30:30] = ["foul", "vile", "Foul"]
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    rows.append(rows[8])
    docs = spark.createDataFrame([(*r, "x") for r in rows], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("toxic", T.StringType())]))
    labels = spark.createDataFrame([*labels, (3, None, None)], "doc_id bigint, quality int, toxic int")
    out = toxicity.digest(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.predicted for r in out if r.doc_id is not None and r.doc_id >= 0 and r.doc_id % 5 == 0} == {1}
    assert {r.predicted for r in out if r.doc_id is not None and (r.doc_id < 0 or r.doc_id % 5)} == {0}
    assert toxicity.digest(docs.limit(0), labels).collect() == []
    assert {r.predicted for r in toxicity.digest(docs, labels.limit(0)).collect()} == {0}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.digest(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    told = out.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    got = {(r.toxic, r.predicted): r["count"] for r in told.groupBy("toxic", "predicted").count().collect()}
    assert got[1, 1] / (got[1, 1] + got.get((1, 0), 0)) > 0.9
    assert got.get((0, 1), 0) / (got[0, 0] + got.get((0, 1), 0)) < 0.01
    some = {(r.toxic, r.some): r["count"] for r in told.groupBy("toxic", (F.col("n_passages") > 0).alias("some")).count().collect()}
    assert some[0, True] / (some[0, True] + some[0, False]) < 0.01 and some[1, True] / (some[1, True] + some[1, False]) > 0.9
    assert out.where("score IS NULL OR isnan(score) OR score < 0 OR score > 1").count() == 0


def toxic_rows(n=300, copies=0, seed=2):
    """(doc_id, text) and (doc_id, quality, toxic): every fifth text holds insults, in some of ``copies`` near copies of each."""
    draw = random.Random(seed)
    words, rows, labels = [f"w{i}" for i in range(400)], [], []
    for i in range(n):
        text = draw.choices(words, k=80) + [f"own{i}a", f"own{i}b"]
        if i % 5 == 0:
            text[30:30] = draw.sample(["foul", "vile", "nastyone", "nastytwo", "nastyfew"], 3)
        for c in range(copies + 1):
            near = [*text]
            near[c % 20] = f"edit{i}"
            rows.append((i * (copies + 1) + c, " ".join(near)))
            labels.append((rows[-1][0], 0, int(i % 5 == 0)))
    return rows, labels


def toxic_model(spark, rows, labels):
    return toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_long_toxic_runs(spark):
    """The more toxic words, the higher the score; nothing overflows or turns back."""
    rows, labels = toxic_rows()
    model = toxic_model(spark, rows, labels)
    runs = spark.createDataFrame([(n, "foul vile " * n) for n in (0, 1, 2, 25, 100, 1000, 20_000)], "doc_id bigint, text string")
    out = sorted(toxicity.scan(runs, model).collect(), key=lambda r: r.doc_id)
    scores = [r.score for r in out]
    assert scores == sorted(scores) and scores[0] < 0.5 < scores[2] and scores[-1] <= 1
    assert [len(r.passages) for r in out[2:]] == [1] * 5 and [(p.start, p.end) for p in out[-1].passages] == [(0, 40_000)]
    assert all(0 <= p.expected < toxicity.LEAST_EXPECTED for r in out for p in r.passages)


def test_near_copies_teach_once(spark):
    """Words of one toxic text are no sign, however many near copies of it are labelled; the signs stay the same."""
    models = [toxic_model(spark, *toxic_rows(copies=c)) for c in (0, 7)]
    for model in models:
        signs = {w.decode() for w in model.scores if not w.endswith(b"*")}
        assert {"foul", "vile"} <= signs <= {"foul", "vile", "nastyone", "nastytwo", "nastyfew"}
        assert np.isfinite([model.k, model.slope, model.offset, *model.scores.values()]).all() and model.slope > 0


def test_bands_meet_for_near_duplicates():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    met = []
    for edits in (0, 4, 200):
        got = 0
        for _ in range(40):
            a = draw.choices(words, k=300)
            b = [*a]
            for i in draw.sample(range(300), edits):
                b[i] = "x"
            got += not set(toxicity.bands_of(" ".join(a))).isdisjoint(toxicity.bands_of(" ".join(b)))
        met.append(got)
    assert met[0] == 40 and met[1] >= 39 and met[2] == 0
    assert toxicity.bands_of("") == [] and len(toxicity.bands_of("One two")) == toxicity.BANDS and toxicity.bands_of("one TWO") == toxicity.bands_of("One two")


def test_unseen_word_counts_by_its_stem(spark):
    model = toxic_model(spark, *toxic_rows())
    assert b"nast*" in model.scores
    found = lambda text: toxicity.passages(text, model)[1]
    assert found("w1 nastymany w2") and found("nast") and not found("w1 w2 nas")
    own = toxicity.Model(model.scores, model.other, frozenset([b"nastymany"]))
    assert not toxicity.passages("w1 nastymany w2", own)[1]


def test_scan_against_plain_scores(spark):
    """Evidence, curve and passages of the scan by the definition."""
    rows, labels = toxic_rows()
    model = toxic_model(spark, rows, labels)
    rows = [*rows, (None, None), (-1, ""), (-2, "foul"), (-2, "foul")]
    out = toxicity.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert len(out) == len(rows)
    for r, (_, text) in zip(out, rows):
        n, found = toxicity.passages(text, model)
        over = [s - log(model.k) - log(max(n, 1)) for *_, s in found]
        told = 1 / (1 + exp(-(model.slope * log(1 + sum(max(0, x) for x in over)) + model.offset)))
        assert r.n == n and r.score == pytest.approx(told)
        assert [(p.start, p.end) for p in r.passages] == [(a, b) for (a, b, _), x in zip(found, over) if exp(-x) < toxicity.LEAST_EXPECTED]


def test_calibration():
    """Of the expected numbers under the fitted k, none but the strongest few is below the observed one."""
    draw = np.random.default_rng(1)
    harmless = [(int(n), list(draw.exponential(1, 2) + np.log(n) - 6)) for n in draw.integers(50, 500, 4000)]
    k = toxicity._calibrated(harmless)
    over = np.sort([x - np.log(n) for n, found in harmless for x in found])[::-1]
    told = len(harmless) * k * np.exp(-over)
    assert (told[20:] >= np.arange(21, len(over) + 1) * (1 - 1e-9)).all() and told[400] < 3 * 400
    assert toxicity._calibrated([(10, []), (0, [])]) == pytest.approx(0.5 / 11)


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Some title\nLicensed under the Apache License, Version 2.0.\n"), (2, "a/b/x.py", None), (3, "a/b/c/y.py", "# Released under the MIT License\nimport x"),
        (4, "a/b/COPYING.txt", "This work is licensed under the GNU General\nPublic License, version 3"), (5, "a/b/c/z.py", "the of and to"), (6, "q/w.py", "none"), (7, None, ""), (8, "top.py", "x"),
        (5, "a/b/c/z.py", "the of and to"), (9, "ab/n.py", "x"), (10, "a/b2/LICENSE", "nothing here"), (11, "a/b2/m.py", "\n" * 3),
    ]
    files = spark.createDataFrame([(*r, "own") for r in rows], T.StructType([T.StructField("id", T.LongType()), T.StructField("path", T.StringType()), T.StructField("text", T.StringType()), T.StructField("dir", T.StringType())]))
    got = sorted((r.id, r.license, r.origin) for r in licenses.scan(files).collect())
    assert got == [
        (1, "Apache-2.0", "own"), (2, "GPL-3.0", "inherited"), (3, "MIT", "own"), (4, "GPL-3.0", "own"), (5, "GPL-3.0", "inherited"), (5, "GPL-3.0", "inherited"), (6, None, None), (7, None, None), (8, None, None), (9, None, None),
        (10, "Apache-2.0", "inherited"), (11, "Apache-2.0", "inherited")]
    assert licenses.scan(files.limit(0)).collect() == []


@pytest.mark.parametrize("before", range(0, 30))
def test_notice_broken_over_lines_anywhere_in_a_run(before):
    """The same notice after any number of licence-like lines, and one with a word in each line."""
    own = licenses.Matcher(1000, {"of": 300, "the": 400, "software": 2, "modification": 2})
    head = ["the software of software"] * before
    parts = ["Permission is hereby granted, free of", "charge, to any person obtaining a copy", "of this software and associated documentation files (the", "Software), to deal in the Software without restriction"]
    assert all(licenses.LEAST / 2 <= own.bound(words_of(x)) for x in head + parts)
    name, found, line = own.scan("\n".join(head + parts))
    assert (name, line) == ("MIT", before) and found == pytest.approx(1)
    longest = max(licenses.TEMPLATES, key=lambda x: len(words_of(x[1])))
    name, found, line = own.scan("\n".join(head + [w.decode() for w in words_of(longest[1])]))
    assert (name, line) == (longest[0], before) and found == pytest.approx(1)


def test_cosines_against_dense_vectors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), F.lit("x").alias("path"), "text")
    lines = [words_of(line) for r in docs.collect() for line in r.text.split("\n")]
    lines = [w for w in lines if w]
    held = Counter(w for line in lines for w in set(line))
    known = {w for _, t in licenses.TEMPLATES for w in words_of(t)}
    idf = lambda w: log((len(lines) + 1) / ((held[w] if w in known else 0) + 1)) + 1
    vector = lambda ws: {w: n * idf(w) for w, n in Counter(ws).items()}
    cosine = lambda a, b: sum(x * b.get(w, 0) for w, x in a.items()) / sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    own = licenses.matcher(docs)
    for line in lines[:300] + [w for w in lines if b"licensed" in w or b"license" in w]:
        best = max(cosine(vector(line), vector(words_of(t))) for _, t in licenses.TEMPLATES)
        assert own.best(line)[0] == pytest.approx(best) and own.bound(line) >= best - 1e-9
