"""Operators on small fixtures with known or brute-force answers."""

import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinity.functions import arrays, hashing, scalars, texts
from affinity.operators import cluster, evaluate as ev, explain, factor, graph, ordered, policy, projections, relational, search
from affinity.operators import scoring
from affinity.operators.scoring import top_k_by_dot
from affinity.plans import views
from affinity.sources import files
from affinity.sources.scratch import FREED, materialize, materialize_bucketed, scratch_root

SF = "/root/testdata/sf0.001"


# --- files and text ---------------------------------------------------------------------

def test_line_numbers_across_splits(spark, tmp_path):
    lines = {f"f{k}.txt": [f"f{k}.txt {i}" for i in range(1, n + 1)] for k, n in enumerate((400, 7, 150))}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = files.number_lines(files.text_lines(spark, str(tmp_path)))
        assert got.select("file_path", "block_start").distinct().count() > 10
        assert all(r["value"] == f"{r['file_name']} {r['line_id']}" for r in got.collect())
        whole = files.assemble(got, ["file_name"], "line_id")
        assert {r["file_name"]: r["text"] for r in whole.collect()} == {n: "\n".join(v) for n, v in lines.items()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "e.txt").write_text("1 2\n2\t3\n1 2\n\n3 1\n")
    assert sorted(map(tuple, files.read_edges(spark, str(tmp_path / "e.txt")).collect())) == [(1, 2), (2, 3), (3, 1)]
    (tmp_path / "v.csv").write_text("1,2.5\n-3,4e1\n")
    assert [r["v"] for r in files.read_vectors(spark, str(tmp_path / "v.csv")).collect()] == [[1.0, 2.5], [-3.0, 40.0]]
    (tmp_path / "u.data").write_text("7\t8\t4\t99\n")
    row = files.read_tsv(spark, str(tmp_path / "u.data"), files.RATINGS_SCHEMA, ["u", "i", "r", "t"]).first()
    assert tuple(row) == (7, 8, 4.0, 99)
    files.write_csv(spark.createDataFrame([(1, "a,b")], "movieId bigint, title string").withColumn("genres", F.lit("x|y")), str(tmp_path / "out"), single_file=True)
    assert tuple(files.read_csv(spark, str(tmp_path / "out"), files.ITEMS_SCHEMA).first()) == (1, "a,b", "x|y")
    (tmp_path / "page_one").write_text("first\nsecond\n")
    assert tuple(files.first_lines(files.whole_files(spark, str(tmp_path / "page_one"))).first()) == ("page_one", "first")


def test_scratch_uses_the_configured_folder(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or configured.rstrip("/") in root
    df = spark.range(5).withColumn("x", F.array(F.col("id").cast("double")))
    assert materialize(df).dtypes == df.dtypes


@pytest.mark.parametrize("cut", [materialize, lambda df: materialize_bucketed(df, ["k"])])
def test_scratch_leaves_no_shuffle_files(spark, cut):
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    files = lambda: {x for x in held().split() if "/shuffle_" in x}
    setting = spark.conf.get(FREED)
    before = files()
    out = cut(spark.range(1000).selectExpr("id % 7 AS k").repartition(3, "k").groupBy("k").count())
    until = time.time() + 20
    while files() - before and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(FREED) == setting
    assert {r["k"]: r["count"] for r in out.collect()} == {k: len(range(k, 1000, 7)) for k in range(7)}


def test_metadata_stops_at_the_line_end(spark):
    text = "Title: A Book\nRelease Date: May 1, 1987\nlanguage:  English\nEncoding: ASCII\nby Ann B.\n*** START OF IT ***body*** END OF IT ***"
    row = spark.createDataFrame([(text,)], "t string").select(
        texts.field(F.col("t"), texts.TITLE), texts.field(F.col("t"), texts.LANGUAGE), texts.field(F.col("t"), texts.ENCODING, 2),
        texts.year(F.col("t"), texts.MODERN_YEAR), texts.strip_boilerplate(F.col("t"))).first()
    assert list(row)[:4] == ["A Book", "English", "ASCII", 1987] and row[4].endswith("body")


def test_grams(spark):
    row = spark.createDataFrame([("abcab", "to be  to be", "x")], "a string, b string, c string").select(
        texts.char_grams(F.col("a"), 2), texts.word_grams(F.col("b"), 2), texts.word_grams(F.col("c"), 2), texts.char_grams(F.col("c"), 3)).first()
    assert sorted(row[0]) == ["ab", "bc", "ca"] and sorted(row[1]) == ["be to", "to be"] and row[2] == [] and row[3] == []


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_char_grams_of_any_text(spark, k):
    """All code points, short and empty texts and nulls; each gram once, hashed as SQL hashes it."""
    given = ["abcabcab", "ä😀x😀x\U0010ffffé\x00a\n\n\n", "ab", "", None, " " * 50]
    wanted = [None if t is None else {t[i : i + k] for i in range(len(t) - k + 1)} for t in given]
    df = spark.createDataFrame(list(enumerate(given)), "id int, t string").repartition(1)
    grams = texts.char_grams(F.col("t"), k)
    rows = df.select("id", grams.alias("g"), hashing.hash32_each("g", grams).alias("h"), F.transform(grams, lambda x: hashing.hash32("g", x)).alias("plain")).orderBy("id").collect()
    assert [None if r.g is None else set(r.g) for r in rows] == wanted
    assert all(r.g is None or len(r.g) == len(set(r.g)) for r in rows)
    assert [r.h for r in rows] == [r.plain for r in rows]


def test_char_grams_are_not_made_of_arrays_of_single_characters(spark, capsys):
    spark.createDataFrame([("abc",)], "t string").select(texts.char_grams(F.col("t"), 3)).explain()
    plan = capsys.readouterr().out
    assert "split(" not in plan and "zip_with" not in plan


def test_scalar_guards(spark):
    row = spark.range(1).select(
        scalars.lsh_probability(F.lit(0.8), F.lit(8), F.lit(20)), scalars.lsh_threshold(F.lit(8.0), F.lit(20.0)), scalars.ratio(F.lit(1.0), F.lit(0.0)),
        scalars.clamp(F.lit(9.0)), arrays.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))), scalars.linear_decay(F.lit(10), 1.0, 0.05, 5)).first()
    assert list(row) == pytest.approx([0.9746, 0.6877, 0, 5, 0, 0.05], abs=5e-5)


# --- order within a key -------------------------------------------------------------------

@pytest.mark.parametrize("width", [1, 7, 1000])
def test_ordered_operators(spark, width):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else f"k{i % 5}", rng.randint(0, 200), i, float(rng.choice([-1, 1]))) for i in range(600)]
    pdf = pd.DataFrame(rows, columns=["k", "t", "id", "x"]).sort_values(["k", "t", "id"])
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, x double").repartition(6)
    bucket = F.floor(F.col("t") / width)
    pdf["step"] = pdf.groupby("k").cumcount() + 1
    pdf["running"] = pdf.groupby("k")["x"].cumsum()
    pdf["next"] = pdf.groupby("k")["id"].shift(-1)
    curve = ordered.running_sum(df, ["k"], ["t", "id"], bucket, "x")
    got = curve.toPandas().sort_values(["k", "t", "id"])
    assert (got["step"].values == pdf["step"].values).all() and (got["running"].values == pdf["running"].values).all()
    follow = ordered.successors(df, ["k"], ["t", "id"], bucket, ["id"]).toPandas().sort_values(["k", "t", "id"])
    assert np.array_equal(follow["next_id"].to_numpy(float), pdf["next"].to_numpy(), equal_nan=True)
    moving = ordered.moving_average(curve, ["k"], 5).toPandas().sort_values(["k", "t", "id"])["moving_avg"].to_numpy()
    want = pdf.groupby("k")["x"].rolling(5).mean().dropna().to_numpy()
    assert moving == pytest.approx(want)
    q = ordered.quantiles(df, ["k"], "t", {"q1": 0.25, "q2": 0.5}).toPandas().set_index("k").sort_index()
    assert q["q1"].to_numpy() == pytest.approx(pdf.groupby("k")["t"].quantile(0.25).sort_index().to_numpy())
    assert q["q2"].to_numpy() == pytest.approx(pdf.groupby("k")["t"].median().sort_index().to_numpy())


def test_dense_index_and_ranges(spark):
    ids = [5, 900, 17, 17, 3]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint")
    assert {r["k"]: r["idx"] for r in relational.dense_index(df, "k").collect()} == {3: 0, 5: 1, 17: 2, 900: 3}
    authors = spark.createDataFrame([(f"a{i}", i % 9) for i in range(40)], "author string, year bigint")
    pairs = relational.range_successors(authors, "author", "year", 3)
    brute = {(f"a{i}", f"a{j}") for i in range(40) for j in range(40) if i % 9 < j % 9 <= i % 9 + 3}
    assert {tuple(r) for r in pairs.collect()} == brute
    degrees = relational.range_degrees(authors, "author", "year", 3).fillna(0).collect()
    assert all(r["out_degree"] == sum(a == r["author"] for a, _ in brute) and r["in_degree"] == sum(b == r["author"] for _, b in brute) for r in degrees)


def test_ranges_part_a_hot_key(spark):
    """A key with most of the rows is cut into even ranges, in which a running sum goes on."""
    rows = [("hot" if i % 3 else f"k{i % 30}", (i * 7919) % 20_011, float(i % 5)) for i in range(20_000)]
    pdf = pd.DataFrame(rows, columns=["k", "t", "x"]).sort_values(["k", "t"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordered.ranged(spark.createDataFrame(rows, "k string, t bigint, x double"), ["k"], ["t"])
        sizes = [r["count"] for r in cut.groupBy(ordered.RANGE).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
        assert cut.filter("k = 'hot'").select(ordered.RANGE).distinct().count() >= 5
        got = ordered.running_sum(cut, ["k"], ["t"], F.col(ordered.RANGE), "x").toPandas().sort_values(["k", "t"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (got["running"].values == pdf.groupby("k")["x"].cumsum().values).all()


def test_lists_in_chunks(spark):
    rows = [("hub", (i * 37) % 1009) for i in range(1009)] + [("b", 5), ("b", 3), ("c", 1)]
    got = {(r["k"], r["chunk"]): r["items"] for r in ordered.chunked_lists(spark.createDataFrame(rows, "k string, v bigint"), ["k"], "v", 100).collect()}
    assert got == {**{("hub", c): list(range(100 * c, min(100 * c + 100, 1009))) for c in range(11)}, ("b", 0): [3, 5], ("c", 0): [1]}


def test_quantiles_with_a_hot_value(spark):
    rows = [("a", 5.0)] * 700 + [("a", float(i)) for i in range(301)] + [("b", 1.0), ("b", 2.5), ("c", None), ("d", 4.0)]
    points = {"q1": 0.25, "q2": 0.5, "q3": 0.9}
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    got = {r["k"]: r for r in ordered.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", points).collect()}
    assert set(got) == {"a", "b", "d"}
    for k, r in got.items():
        assert [r[p] for p in points] == pytest.approx([pdf[pdf.k == k].v.quantile(q) for q in points.values()])


# --- scoring, factors, explanations ---------------------------------------------------------

def test_top_k_paths_agree(spark):
    rng = np.random.default_rng(2)
    x, w = rng.random((30, 6)).round(2), rng.random((40, 6)).round(2)
    profiles = spark.createDataFrame([(u, i, float(x[u, i])) for u in range(30) for i in range(6)], "id bigint, idx int, x double")
    catalogue = spark.createDataFrame([(i * 3, j, float(w[i, j])) for i in range(40) for j in range(6)], "item_id bigint, idx int, w double")
    seen = spark.createDataFrame([(u, 3 * ((u + j) % 40)) for u in range(30) for j in range(10)], "user_id bigint, item_id bigint")
    matrix = sorted(map(tuple, top_k_by_dot(profiles, catalogue, 4, seen).select("id", "item_id", "score", "rank").collect()))
    joined = sorted(map(tuple, top_k_by_dot(profiles, catalogue, 4, seen, max_cells=25).select("id", "item_id", "score", "rank").collect()))
    assert matrix == joined and len(matrix) == 120
    want = []
    for u in range(30):
        hidden = {3 * ((u + j) % 40) for j in range(10)}
        ranked = sorted((-round(float(x[u] @ w[i]), 6), i * 3) for i in range(40) if i * 3 not in hidden)[:4]
        want += [(u, i, pytest.approx(-s), n + 1) for n, (s, i) in enumerate(ranked)]
    assert sorted(matrix, key=lambda r: (r[0], r[3])) == want


def test_grid_cells_are_bounded(spark):
    """Every row meets every item once, and no cell holds more ids than its share allows."""
    left = spark.range(500).select("id", scoring.part("id", 5).alias("slice"))
    right = spark.range(300).select(F.col("id").alias("item_id"), scoring.part("id", 4).alias("block"))

    def cell(a, b):
        return pd.DataFrame({"pairs": [len(a) * len(b)], "most": [max(len(a), len(b))]})

    out = scoring.grid(left, right, 5, 4).applyInPandas(cell, "pairs bigint, most bigint").collect()
    assert len(out) == 20 and sum(r.pairs for r in out) == 150_000 and max(r.most for r in out) < 160


def test_grid_takes_few_large_cells(spark):
    """Sides that fit in one cell are not sent once for every few thousand ids of the other."""
    many = spark.range(300_000).select("id", F.lit(1).alias("idx"))
    few = spark.range(100).select("id", F.lit(1).alias("idx"))
    cores = spark.sparkContext.defaultParallelism
    assert scoring.shape(many, "id", few, "id", 2_000_000, 2_000_000) == (cores, 1)
    assert scoring.shape(few, "id", few, "id", 2_000_000, 2_000_000) == (1, 1)
    assert scoring.shape(many, "id", many, "id", 20_000, 150_000) == (15, 2)


@pytest.mark.parametrize("fill", [0.02, 0.9])
def test_chunks_of_a_cell_agree(spark, fill):
    """Scores by entries and by matrices, in chunks of any size, against numpy."""
    rng = np.random.default_rng(4)
    x, w = ((rng.random((n, 50)) * (rng.random((n, 50)) < fill)).round(2) for n in (40, 60))
    lists = lambda m, cols: spark.createDataFrame([(int(r), int(c), float(m[r, c])) for r, c in zip(*np.nonzero(m))], cols)
    seen = [(u, (u + j) % 60) for u in range(40) for j in range(12)]
    scores = np.round(x @ w.T, 6)
    scores[tuple(np.array(seen).T)] = -np.inf
    want = {(u, int(i), n + 1) for u in range(40) for n, i in enumerate(sorted(range(60), key=lambda i: (-scores[u, i], i))[:5]) if scores[u, i] > 0}
    for ids, products in ((7, 50), (2_048, 4_000_000)):
        left, right = (scoring._Side(*np.nonzero(m), m[m != 0], np.arange(50)) for m in (x, w))
        for a in range(0, len(left.ids), ids):
            for b in range(0, len(right.ids), ids):
                there = x[np.ix_(left.ids[a : a + ids], range(50))] @ w[np.ix_(right.ids[b : b + ids], range(50))].T
                assert np.allclose(scoring._dots(left.chunk(a, ids), right.chunk(b, ids), 50, products), there)
        got = top_k_by_dot(lists(x, "id bigint, idx bigint, x double"), lists(w, "item_id bigint, idx bigint, w double"), 5, spark.createDataFrame(seen, "user_id bigint, item_id bigint"), ids=ids)
        assert {(r.id, r.item_id, r["rank"]) for r in got.collect()} == want


@pytest.mark.parametrize("floor", [0.0, -np.inf])
def test_most_scores_are_only_compared_with_a_bound(monkeypatch, floor):
    """Of the chunks of a cell few are ranked, with many ties and seen pairs; the lists are those of all scores."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (50, 12)) * 0.5
    w = (rng.random((4_000, 12)) < 0.3) * 0.25
    seen = np.unique(np.stack([rng.integers(0, 50, 3_000), rng.integers(0, 400, 3_000)], axis=1), axis=0)
    scores = np.round(x @ w.T, 6)
    scores[tuple(seen.T)] = -np.inf
    want = [(u, int(i), scores[u, i]) for u in range(50) for i in np.lexsort((np.arange(4_000), -scores[u]))[:6] if scores[u, i] > floor]
    ranked = []
    monkeypatch.setattr(scoring, "best_of_rows", lambda *args, of=scoring.best_of_rows: ranked.append(1) or of(*args))
    # Each id has an entry in every dimension, as ids without entries are no part of a side.
    users, items = (scoring._Side(np.repeat(np.arange(len(m)), 12), np.tile(np.arange(12), len(m)), m.ravel(), np.arange(12)) for m in (x, w))
    got = scoring._best_of_cell(users, items, 12, 6, seen[:, 0], seen[:, 1], 6, floor, 100)
    assert sorted(zip(*(c.tolist() for c in got)), key=lambda r: (r[0], -r[2], r[1])) == want
    assert len(ranked) < 10


def test_bounds_allow_for_single_precision():
    """Scores that differ in the sixth place only are told apart, at any size."""
    rng = np.random.default_rng(6)
    x = np.array([[1.0, 1.0], [300.0, 300.0], [-1.0, 2.0]])
    w = 1.0 + rng.integers(0, 50, (1_000, 2)) * 1e-6
    users, items = (scoring._Side(np.repeat(np.arange(len(m)), 2), np.tile(np.arange(2), len(m)), m.ravel(), np.arange(2)) for m in (x, w))
    got = scoring._best_of_cell(users, items, 2, 4, np.zeros(0, np.int64), np.zeros(0, np.int64), 6, -np.inf, 10)
    scores = np.round(x @ w.T, 6)
    want = [(u, int(i)) for u in range(3) for i in np.lexsort((np.arange(1_000), -scores[u]))[:4]]
    assert list(zip(got[0].tolist(), got[1].tolist())) == want


def test_svd_against_numpy(spark):
    rng = np.random.default_rng(0)
    a = sum(10.0 ** -i * np.outer(rng.normal(size=40), rng.normal(size=25)) for i in range(5))
    entries = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(40) for j in range(25)], "row bigint, col bigint, x double")
    left, right, values = factor.truncated_svd(entries, k=3)
    u, s, vt = np.linalg.svd(a)
    assert values == pytest.approx(s[:3], rel=1e-6)
    lm = left.orderBy("row").toPandas()[["c0", "c1", "c2"]].to_numpy()
    rm = right.orderBy("col").toPandas()[["c0", "c1", "c2"]].to_numpy()
    assert lm @ rm.T == pytest.approx(u[:, :3] * s[:3] @ vt[:3], abs=1e-5)


def test_svd_of_real_ratings_and_of_low_rank(spark):
    """Slowly falling values, and fewer than k."""
    ratings = views.train(spark, SF).select(F.col("user_id").alias("row"), F.col("item_id").alias("col"), (F.col("rating") - 2.5).alias("x"))
    rows = ratings.toPandas()
    a = rows.pivot(index="row", columns="col", values="x").fillna(0.0)
    for entries, full in ((ratings, a.to_numpy()), (spark.createDataFrame([(i, j, float((i + 1) * (j + 1))) for i in range(4) for j in range(5)], "row bigint, col bigint, x double"), np.outer(range(1, 5), range(1, 6)))):
        left, right, values = factor.truncated_svd(entries, k=20)
        u, s, vt = np.linalg.svd(full)
        want = np.r_[s, np.zeros(20)][:20]
        assert values == pytest.approx(want, abs=1e-5)
        lm = left.orderBy("row").toPandas().iloc[:, 1:].to_numpy()
        rm = right.orderBy("col").toPandas().iloc[:, 1:].to_numpy()
        n = min(20, len(s))
        assert lm @ rm.T == pytest.approx(u[:, :n] * s[:n] @ vt[:n], abs=1e-4)


def test_surrogate_recovers_a_linear_model(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, p double, q double")
    out = explain.surrogate_weights(df, ["p", "q"], lambda d: d.withColumn("prediction", 2 * F.col("p") - 3 * F.col("q") + 1), n_samples=60)
    sd = pd.DataFrame(rows)[[1, 2]].std(ddof=0)
    for r in out.collect():
        want = {"p": 2 * sd[1], "q": -3 * sd[2]}.get(r["feature"])
        assert want is None or r["weight"] == pytest.approx(want, rel=0.02)


def test_linear_arms_rank_few_blocks(spark):
    """Many arms in small blocks, of which most are only compared with the bounds of the contexts; the lists are those of one block."""
    rng = np.random.default_rng(8)
    contexts = spark.createDataFrame([(u, [float(v) for v in rng.random(4).round(2)]) for u in range(30)], "user_id bigint, x array<double>").cache()
    log = [(int(u), int(a), float(rng.choice([-1, 1]))) for a in range(600) for u in rng.choice(30, 4)]
    rewards = spark.createDataFrame(log, "user_id bigint, arm bigint, reward double")
    small, one = (sorted(map(tuple, policy.linear_arms(contexts, rewards, 4, k=3, block=block).collect())) for block in (20, 1_000))
    assert small == one and len(one) == 90
    models = {r.arm: (np.array(r.theta), np.array(r.inverse).reshape(4, 4)) for r in policy.arm_models(contexts, rewards, 4).collect()}
    for user in contexts.collect():
        x = np.array(user.x)
        best = sorted((-round(float(x @ t + 0.5 * np.sqrt(x @ a @ x)), 6), arm) for arm, (t, a) in models.items())[:3]
        assert [(r[1], pytest.approx(-r[2], abs=2e-6)) for r in sorted(one, key=lambda r: r[3]) if r[0] == user.user_id] == [(arm, s) for s, arm in best]


def test_linear_arms_against_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.random((20, 3)).round(3)
    log = [(int(u), int(a), float(rng.choice([-1, 1]))) for u in range(20) for a in rng.choice(8, 3, replace=False)]
    contexts = spark.createDataFrame([(u, [float(v) for v in x[u]]) for u in range(20)], "user_id bigint, x array<double>")
    rewards = spark.createDataFrame(log, "user_id bigint, arm bigint, reward double")
    got = policy.linear_arms(contexts, rewards, 3, k=2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, policy.linear_arms(contexts, rewards, 3, k=2, block=3).collect()))
    best = {}
    for arm in range(8):
        a, b = np.eye(3), np.zeros(3)
        for u, r in ((u, r) for u, m, r in log if m == arm):
            a += np.outer(x[u], x[u])
            b += r * x[u]
        inv = np.linalg.inv(a)
        for u in range(20):
            best.setdefault(u, []).append((-round(float(inv @ b @ x[u] + 0.5 * np.sqrt(x[u] @ inv @ x[u])), 6), arm))
    for r in got.collect():
        score, arm = sorted(best[r["user_id"]])[r["rank"] - 1]
        assert (r["arm"], r["score"]) == (arm, pytest.approx(-score, abs=2e-6))


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1)], "user_id bigint, item_id bigint, rank int")
    relevant = spark.createDataFrame([(1, 11), (1, 99), (3, 5)], "user_id bigint, item_id bigint")
    pr = {r["user_id"]: r for r in ev.precision_recall(recs, relevant, 2).collect()}
    assert pr[1]["precision"] == 0.5 and pr[1]["recall"] == 0.5 and pr[1]["f1"] == 0.5 and pr[3]["f1"] == 0 and 2 not in pr
    nd = {r["user_id"]: r["ndcg"] for r in ev.ndcg(recs, relevant, 3).collect()}
    assert nd[1] == pytest.approx((1 / np.log2(3)) / (1 + 1 / np.log2(3))) and nd[3] == 0
    assert {r["user_id"]: r["hit"] for r in ev.hit_rate(recs, relevant, 1).collect()} == {1: 0.0, 3: 0.0}


# --- graph ------------------------------------------------------------------------------------

SIX = [("A", "B"), ("A", "C"), ("B", "C"), ("B", "D"), ("C", "A"), ("C", "D"), ("C", "E"), ("D", "C"), ("E", "F"), ("F", "C"), ("F", "E")]


@pytest.mark.parametrize("cut_every", [1, 4, 7])
def test_pagerank_golden(spark, cut_every):
    edges = spark.createDataFrame(SIX + SIX[:3], "src string, dst string")
    ranks, rounds = graph.pagerank(edges, 0.85, 100, tolerance=1e-6, cut_every=cut_every)
    got = {r["id"]: r["rank"] for r in ranks.collect()}
    assert rounds == 30
    assert got == pytest.approx({"A": 0.110376, "B": 0.071910, "C": 0.301326, "D": 0.140937, "E": 0.189433, "F": 0.186018}, abs=1e-6)
    assert got["A"] != pytest.approx(0.116313, abs=1e-3)  # damping applied twice
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_hubs_in_parts(spark):
    """A hub's links in parts give the same ranks, and no round shuffles the links."""
    pairs = [(0, i) for i in range(1, 300)] + [(i, i % 7) for i in range(1, 300)] + [(i, i + 1) for i in range(1, 50)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    whole, parted = (graph.pagerank(edges, 0.85, 12, slice_size=size)[0] for size in (100_000, 16))
    assert {r["id"]: r["rank"] for r in parted.collect()} == pytest.approx({r["id"]: r["rank"] for r in whole.collect()}, rel=1e-12)
    links = graph._links(edges.distinct(), 16)
    most = links.filter("w IS NOT NULL").groupBy("src", "part").count().agg(F.max("count")).first()[0]
    assert most <= 40 and links.filter("src = 0 AND w IS NULL").first()["parts"] == 19


@pytest.mark.parametrize("keys", [["src"], ["src", "part"]])
def test_buckets_stay_in_place(spark, keys):
    links = materialize_bucketed(spark.range(1000).selectExpr("id AS src", "CAST(id % 3 AS INT) AS part", "id % 10 AS dst"), keys, "links")
    sums = links.groupBy(F.col("dst").alias("src")).agg(F.sum("src").alias("r"), F.max("part").alias("part"))
    plan = links.hint("merge").join(sums, keys)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("SortMergeJoin"):].split("\n")
    first_scan = next(i for i, line in enumerate(below) if "FileScan" in line)
    assert "Bucketed: true" in below[first_scan] and not any("Exchange" in line for line in below[:first_scan])
    assert not spark.catalog.listTables()


def test_pagerank_dangling(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 1)], "src bigint, dst bigint")  # 3 has no way out
    spread = {r["id"]: r["rank"] for r in graph.pagerank(edges, 0.85, 60, dangling="spread")[0].collect()}
    assert sum(spread.values()) == pytest.approx(1.0)
    drop = {r["id"]: r["rank"] for r in graph.pagerank(edges, 0.85, 60)[0].collect()}
    assert sum(drop.values()) < 0.9
    total = sum(drop.values())
    assert {k: v / total for k, v in drop.items()} == pytest.approx(spread, abs=1e-6)


def test_components(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(0, 60) if i not in (20, 41)]  # three chains
    pairs += [(100, 100 + i) for i in range(1, 80)]  # a star
    pairs = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in pairs]
    nodes = spark.createDataFrame([(n,) for n in {x for p in pairs for x in p} | {500}], "id bigint")
    got = {r["id"]: r["component"] for r in graph.connected_components(spark.createDataFrame(pairs, "src bigint, dst bigint"), nodes).collect()}
    assert got == {n: 0 if n <= 20 else 21 if n <= 41 else 42 if n <= 60 else 100 if n < 500 else 500 for n in got}
    assert len(got) == 61 + 80 + 1


# --- clustering ---------------------------------------------------------------------------------

def test_clusters(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.1, (20, 3)) for c in (0, 5, 10)])
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id bigint, v array<double>").repartition(4)
    radii, chosen = [], None
    for k in (1, 2, 3, 6):
        centers = cluster.k_center(points, k)
        radii.append(cluster.assign(points, centers).agg(F.max("d")).first()[0])
        chosen = [r["id"] for r in centers.orderBy("center").collect()]
    assert radii == sorted(radii, reverse=True) and radii[2] < 1 and len(set(chosen)) == 6
    greedy, d = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(greedy) < 6:
        greedy.append(int(np.round(d, 9).argmax()))
        d = np.minimum(d, ((x - x[greedy[-1]]) ** 2).sum(axis=1))
    assert chosen == greedy
    pp = cluster.k_means_pp(points, 3, seed=3)
    again = cluster.k_means_pp(points.repartition(7), 3, seed=3)
    assert [r["id"] for r in pp.collect()] == [r["id"] for r in again.collect()]
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(5)], "id bigint, v array<double>")
    assert cluster.k_means_pp(same, 3).count() == 1  # nothing left to choose
    assert cluster.objective(points, cluster.coreset(points, 10, 3)).first()[0] < 60


# --- search ---------------------------------------------------------------------------------------

def test_search_log(spark, tmp_path):
    pages = {"one": "The stacks (of Stack) and C++ code.", "two": "Function: the stack's end; c!", "three": "magazines"}
    folder = tmp_path / "pages"
    folder.mkdir()
    for name, text in pages.items():
        (folder / name).write_text(text)
    log = tmp_path / "log.txt"
    log.write_text("\n".join([
        f"{files.ADD_PAGE} one", f"{files.FIND_PAGES} delhi", f"{files.FIND_PAGES} Stack", f"{files.FIND_POSITIONS} stack one", f"{files.FIND_PAGES} C++",
        f"{files.FIND_PAGES} magazines", f"{files.FIND_POSITIONS} stack two", f"{files.ADD_PAGE} two", f"{files.ADD_PAGE} three",
        f"{files.FIND_PAGES} stack", f"{files.FIND_POSITIONS} magazines two", f"{files.FIND_PAGES} the", f"{files.FIND_PAGES} magazines"]))
    entries = search.postings(files.whole_files(spark, str(folder)))
    answers = search.replay(files.read_actions(spark, str(log)), entries).orderBy("seq")
    assert [r["answer"] for r in answers.collect()] == [
        "No webpage contains word delhi", "one", "1,3", "one", "No webpage contains word magazines", "No webpage two found",
        "one, two", "Webpage two does not contain word magazines", "No webpage contains word the", "three"]
    assert search.difference(answers, answers).count() == 0
    changed = answers.withColumn("answer", F.when(F.col("seq") == 2, "x").otherwise(F.col("answer")))
    assert search.difference(answers, changed).count() == 1
    assert {(r["word"], r["tf"]) for r in search.inverted_index(entries).filter("page = 'one'").collect()} == {("stack", 2), ("c++", 1), ("code", 1)}


def test_log_of_eleven_queries(spark, tmp_path):
    """Pages come one by one; each query sees those before it, by counts or by pages."""
    pages = {
        "structure": "A stack in Wikipedia: push and pop are a function each", "cprogramming": "Allain on C and C++, a function", "oracle": "the JDK",
        "overflow": "which function", "lighting": "lamps", "magazine": "magazines"}
    files.write_pages(spark.createDataFrame(list(pages.items()), "page string, text string"), str(tmp_path / "packs"))
    read = files.packed_pages(spark, str(tmp_path / "packs"))
    assert {r["page"]: r["text"] for r in read.collect()} == pages
    steps = [
        ("add", None, "structure"), ("find", "delhi", None), ("find", "stack", None), ("find", "wikipedia", None), ("where", "magazines", "structure"), ("find", "allain", None),
        ("add", None, "cprogramming"), ("find", "allain", None), ("find", "C", None), ("find", "C++", None), ("add", None, "oracle"), ("find", "jdk", None),
        ("add", None, "overflow"), ("find", "function", None), ("add", None, "lighting"), ("add", None, "magazine"), ("find", "magazines", None)]
    log = spark.createDataFrame([(10 * i, *s) for i, s in enumerate(steps)], "seq bigint, cmd string, word string, page string")
    files.write_actions(log.repartition(5), str(tmp_path / "log"))
    actions = files.read_actions(spark, str(tmp_path / "log"))
    assert [tuple(r) for r in actions.orderBy("seq").collect()] == [(i + 1, c, w and w.lower(), p) for i, (c, w, p) in enumerate(steps)]
    entries = search.postings(read)
    assert [r["answer"] for r in search.replay(actions, entries).orderBy("seq").collect()] == [
        "No webpage contains word delhi", "structure", "structure", "Webpage structure does not contain word magazines", "No webpage contains word allain",
        "cprogramming", "cprogramming", "cprogramming", "oracle", "cprogramming, overflow, structure", "magazine"]
    counts = {r["seq"]: r["n"] for r in search.visible_counts(actions, search.page_words(actions, entries)).collect()}
    assert counts == {2: 0, 3: 1, 4: 1, 6: 0, 8: 1, 9: 1, 10: 1, 12: 1, 14: 3, 17: 1}


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_hot_word_in_a_long_log(spark, monkeypatch, span):
    """Every page holds the word and every second entry asks for it: counts equal a plain replay, for any range."""
    monkeypatch.setattr(search, "RANGE", span)
    log = [(i, "add", None, f"p{i:03d}") if i % 2 == 0 else (i, "find", ["hot", "cold", "none"][i % 3], None) for i in range(120)] + [(200, "add", None, "p000")]
    df = spark.createDataFrame(log, "seq bigint, cmd string, word string, page string")
    held = spark.createDataFrame([("hot", f"p{i:03d}", 1) for i in range(0, 120, 2)] + [("cold", f"p{i:03d}", 1) for i in range(0, 120, 8)], "word string, page string, pos bigint")
    pages = {w: [r["page"] for r in held.filter(F.col("word") == w).collect()] for w in ("hot", "cold", "none")}
    want = {s: sorted(p for p in pages[w] if int(p[1:]) < s) for s, c, w, _ in log if c == "find"}
    got = {r["seq"]: r["answer"] for r in search.find_answers(df, held).collect()}
    assert got == {s: ", ".join(p) or f"No webpage contains word {log[s][2]}" for s, p in want.items()}
    assert {r["seq"]: r["n"] for r in search.visible_counts(df, search.page_words(df, held)).collect()} == {s: len(p) for s, p in want.items()}


@pytest.mark.parametrize("together", [1, 3, 256])
def test_answers_of_a_hot_word_in_parts(spark, together):
    """The same answers for any number of queries that share a list; a query that stands twice names each page twice."""
    log = [(2 * i, "add", None, f"p{i % 7}") for i in range(10)] + [(2 * i + 1, "find", "hot", None) for i in range(10)] + [(19, "find", "hot", None), (30, "find", "none", None)]
    held = [("hot", f"p{i}", 1) for i in range(0, 7, 2)]
    got = search.find_answers(spark.createDataFrame(log, "seq bigint, cmd string, word string, page string"), spark.createDataFrame(held, "word string, page string, pos bigint"), together)
    want = {2 * i + 1: ", ".join(f"p{k}" for k in range(0, min(i, 6) + 1, 2) for _ in range(2 if i == 9 else 1)) for i in range(10)}
    assert {r["seq"]: r["answer"] for r in got.collect()} == want | {30: "No webpage contains word none"}
    assert got.count() == 11


def test_pairs_of_a_hot_position_are_made_in_many_tasks(spark):
    rows = [(f"a{i}", i % 2 + 5) for i in range(100)] + [("late", 30)]
    pairs = relational.range_successors(spark.createDataFrame(rows, "author string, day bigint"), "author", "day", 3)
    assert sorted((r["src"], r["dst"]) for r in pairs.collect()) == sorted((a, b) for a, d in rows for b, e in rows if d < e <= d + 3)
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_shares_are_summed_in_parts(spark, monkeypatch):
    """The sums of (user, tag) are not held in the tasks of the join, and any size of the parts gives the same rows."""
    from affinity.plans.queries import relational as queries

    got = queries.weighted_avg(spark, SF)
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()
    monkeypatch.setattr(queries, "RATINGS", 500)
    assert sorted(map(tuple, queries.weighted_avg(spark, SF).collect())) == sorted(map(tuple, got.collect()))


# --- projections ----------------------------------------------------------------------------------

def test_projections_find_nine_in_ten(spark):
    """Recall of pairs within the distance and of the five nearest, for ids divisible by 20 against all rows."""
    from affinity.plans.queries import similarity

    points, asked = similarity.asked_points(spark, "/root/testdata/sf0.01")
    held = {r["id"]: np.array(r["v"]) for r in points.collect()}
    far = {(a, b): float(np.linalg.norm(held[a] - held[b])) for a in held if a % 20 == 0 for b in held if a != b}
    true = {p for p, d in far.items() if d <= similarity.REACH}
    got = {(r["a"], r["b"]): r["distance"] for r in projections.within(points, asked, similarity.REACH).collect()}
    assert set(got) <= true and all(d == pytest.approx(far[p]) for p, d in got.items())
    assert len(got) >= 0.9 * len(true) and len(true) > 100
    nearest = {(a, b) for a in held if a % 20 == 0 for b in sorted((b for b in held if b != a), key=lambda b: (far[a, b], b))[:5]}
    found = {(r["a"], r["b"]) for r in projections.nearest(points, asked, 5, similarity.REACH).collect()}
    assert len(found & nearest) >= 0.9 * len(nearest)


def test_projections_in_a_grid(spark, monkeypatch):
    """Only kept pairs leave a cell; several small cells, ids that stand twice and missing vectors give the bucket rule's rows."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(60)]
    rows += rows[:20] + [(100, None), (101, None), (120, None)]
    points = spark.createDataFrame(rows, "id bigint, v array<double>")
    asked = points.filter("id % 20 = 0")
    assert projections.met(points, asked, 1.0, lambda rough, error, times: np.zeros(rough.shape, bool)).count() == 0

    at = {i: [[np.floor(np.dot(v, projections.signs(4, t, p)) / 1.0) for p in range(2)] for t in range(3)] for i, v in rows if v}
    far = {(a, b): np.linalg.norm(np.array(v) - np.array(w)) for a, v in rows if v and a % 20 == 0 for b, w in rows if w and a != b
           if any(all(abs(x - y) <= 1 for x, y in zip(s, t)) for s, t in zip(at[a], at[b]))}
    close = {a: sorted((round(d, 6), b) for (x, b), d in far.items() if x == a)[:3] for a in (0, 20, 40)}
    for most in (50_000, 10):
        monkeypatch.setattr(projections.met, "__defaults__", (*projections.met.__defaults__[:-1], most))
        got = projections.within(points, asked, 1.0).collect()
        assert sorted((r["a"], r["b"]) for r in got) == sorted(p for p, d in far.items() if d <= 1.0)
        near = projections.nearest(points, asked, 3, 1.0).collect()
        assert {a: [(round(r["distance"], 6), r["b"]) for r in sorted(near, key=lambda r: r["rank"]) if r["a"] == a] for a in close} == close
        assert sorted((r["a"], r["b"]) for r in near if r["distance"] is None) == [(100, 101), (100, 120), (120, 100), (120, 101)]


def test_recommenders_side_by_side(spark):
    lists = [("x", 1, 10, 1), ("x", 1, 11, 2), ("x", 2, 10, 1), ("y", 1, 12, 1), ("y", 3, 10, 1), ("x", 1, 12, 3)]
    truth = [(1, 11), (1, 12), (2, 99)]
    ratings = [(5, 10)] * 3 + [(6, 11)]
    out = ev.compare(
        spark.createDataFrame(lists, "model string, user_id bigint, item_id bigint, rank int"), spark.createDataFrame(truth, "user_id bigint, item_id bigint"),
        spark.createDataFrame(ratings, "user_id bigint, item_id bigint"), spark.createDataFrame([(i,) for i in (10, 11, 12, 99)], "item_id bigint"), 2)
    got = {r["model"]: tuple(r)[1:] for r in out.collect()}
    ideal = 1 + 1 / np.log2(3)
    assert got["x"] == pytest.approx((2, 1 / 2 / 2, 0.5 / 2, 0.5, (1 / np.log2(3)) / ideal / 2, 0.5, (2 * -np.log2(0.75) - np.log2(0.25)) / 3), abs=1e-6)
    assert got["y"] == pytest.approx((2, 1 / 2 / 2, 0.5 / 2, 0.5, 1 / ideal / 2, 0.5, (-np.log2(0.25) - np.log2(0.75)) / 2), abs=1e-6)


def test_batch_q(spark):
    rows = [("a", 1, 1.0, "b"), ("a", 1, -1.0, "b"), ("b", 2, 1.0, None)]
    moves = spark.createDataFrame(rows, "state string, action bigint, reward double, next_state string")
    got = {(r["state"], r["action"]): r["q"] for r in policy.batch_q(moves, 0.5, 3).collect()}
    assert got == pytest.approx({("a", 1): 0.5, ("b", 2): 1.0})
