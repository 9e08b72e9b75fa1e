"""Similarity joins against brute force, on data where one key holds a third of the rows."""

import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from affinity.operators import explain, overlap, recommend as rc, relational, signatures as sg
from affinity.sources.scratch import materialize


def skewed_ratings(n_users=60, n_items=80, seed=1):
    """Item 0 is rated by all users, and user 0 rates nearly all items: each holds a third of the rows."""
    rng = random.Random(seed)
    rows = {}
    for u in range(n_users):
        rows[u, 0] = rng.randint(1, 10) / 2
        for i in rng.sample(range(1, n_items), rng.randint(1, 3)):
            rows[u, i] = rng.randint(1, 10) / 2
    for i in range(n_items):
        rows[0, i] = rng.randint(1, 10) / 2
    return rows


@pytest.fixture(scope="module")
def ratings():
    return skewed_ratings()


@pytest.fixture(scope="module")
def table(spark, ratings):
    rows = [(u, i, r) for (u, i), r in ratings.items()]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double").repartition(5)


def by(ratings, axis):
    out = {}
    for (u, i), r in ratings.items():
        key, other = (u, i) if axis == 0 else (i, u)
        out.setdefault(key, {})[other] = r
    return out


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.8, 1.0])
def test_jaccard_matches_brute_force(table, ratings, threshold):
    sets = {u: set(v) for u, v in by(ratings, 0).items()}
    expected = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= threshold:
            expected[a, b] = j
    members = table.select(F.col("user_id").alias("id"), F.col("item_id").alias("elem"))
    got = {(r["a"], r["b"]): r["jaccard"] for r in overlap.jaccard_pairs(members, threshold).collect()}
    assert got == pytest.approx(expected)
    assert all(0 <= j <= 1 for j in got.values())
    light = {(r["a"], r["b"]): r["jaccard"] for r in overlap.jaccard_pairs(members, threshold, overlap.LIGHT).collect()}
    assert light == pytest.approx(expected)


@pytest.mark.parametrize("axis", [0, 1])
@pytest.mark.parametrize("light", [0, 4, overlap.LIGHT])
def test_shared_sums_match_brute_force(table, ratings, axis, light):
    """Left-out elements are in the sums, whatever number of ids keeps an element in the join."""
    names = ("user_id", "item_id") if axis == 0 else ("item_id", "user_id")
    got = {(r["a"], r["b"]): (r["n"], r["sx"], r["sy"], r["sxy"]) for r in overlap.co_rated(table, *names, light=light).collect()}
    rows = by(ratings, axis)
    expected = {}
    for a, b in itertools.combinations(sorted(rows), 2):
        common = rows[a].keys() & rows[b].keys()
        if len(common) >= 2:
            x, y = [2 * rows[a][c] for c in common], [2 * rows[b][c] for c in common]
            expected[a, b] = (len(common), sum(x), sum(y), sum(p * q for p, q in zip(x, y)))
    assert got == expected


def test_hot_element_makes_no_candidates(spark):
    """All users share one item only: nothing can reach two shared items."""
    rows = [(u, 0, 3.0) for u in range(400)] + [(u, 1000 + u, 3.0) for u in range(400)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    members = df.select(F.col("user_id").alias("id"), F.col("item_id").alias("elem"), F.lit(1).alias("x"))
    tagged = overlap._split_prefix(members, F.lit(1), lambda n: F.lit(2))
    assert tagged.filter("lead").count() == 0
    assert overlap.co_rated(df, "user_id", "item_id").count() == 0


def test_cosine_pairs(spark):
    rng = random.Random(3)
    vectors = {}
    for d in range(50):
        v = {0: rng.random()}  # a word in every document
        for w in rng.sample(range(1, 30), 4):
            v[w] = rng.random() * 3
        n = math.sqrt(sum(x * x for x in v.values()))
        vectors[d] = {w: x / n for w, x in v.items()}
    df = spark.createDataFrame([(d, w, x) for d, v in vectors.items() for w, x in v.items()], "id bigint, elem bigint, x double")
    for t in (0.2, 0.5, 0.7):
        expected = {}
        for a, b in itertools.combinations(vectors, 2):
            c = sum(x * vectors[b].get(w, 0) for w, x in vectors[a].items())
            if c >= t:
                expected[a, b] = c
        got = {(r["a"], r["b"]): r["cosine"] for r in overlap.cosine_pairs(df, t).collect()}
        assert got == pytest.approx(expected)


def test_copy_groups(spark):
    sets = {1: "ab", 2: "ba", 3: "abc", 4: "c", 5: "cba", 6: "ab"}
    df = spark.createDataFrame([(i, e) for i, s in sets.items() for e in s], "id bigint, elem string")
    got = {r["id"]: (r["rep"], r["n_copies"]) for r in overlap.copy_groups(df).collect()}
    assert got == {1: (1, 3), 2: (1, 3), 6: (1, 3), 3: (3, 2), 5: (3, 2), 4: (4, 1)}


def test_minhash_and_bands(spark):
    rng = random.Random(5)
    base = list(range(200))
    sets = {d: set(rng.sample(base, 60)) for d in range(12)}
    for d in range(12, 24):  # near copies of set 0
        sets[d] = set(list(sets[0])[: 60 - (d - 11)]) | {1000 + d}
    members = spark.createDataFrame([(d, e) for d, s in sets.items() for e in s], "id bigint, elem bigint")
    family = sg.coefficients(40)
    sig = sg.minhash(members, F.col("elem"), family)
    rows = {r["id"]: r["signature"] for r in sig.collect()}
    expected = {d: [min((a * x + b) % sg.PRIME for x in s) for a, b in family] for d, s in sets.items()}
    assert rows == expected
    bands = {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if any(expected[a][i * 4:(i + 1) * 4] == expected[b][i * 4:(i + 1) * 4] for i in range(10))}
    pairs = [(r["a"], r["b"]) for r in sg.candidates(sig, 4, 10).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == bands and bands
    est = {(a, b): sum(x == y for x, y in zip(expected[a], expected[b])) / 40 for a, b in itertools.combinations(sorted(sets), 2)}
    got = {(r["a"], r["b"]): r["share"] for r in sg.estimated_pairs(sig, 0.5).collect()}
    assert got == {p: s for p, s in est.items() if s >= 0.5}
    # More bands, more candidates.
    assert sg.candidates(sig, 4, 5).count() <= len(pairs)


def test_error_shrinks_with_length(spark):
    rng = random.Random(9)
    a, b = set(range(300)), set(range(150, 450))
    members = spark.createDataFrame([(0, x) for x in a] + [(1, x) for x in b], "id bigint, elem bigint")
    sig = sg.minhash(members, F.col("elem"), sg.coefficients(400, trial=rng.randint(1, 5)))
    r = sg.agreement(spark.createDataFrame([(0, 1)], "a bigint, b bigint"), sig, [400]).first()
    assert abs(r["est_400"] - 1 / 3) < 4 * math.sqrt(1 / 3 * 2 / 3 / 400)


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    den = math.sqrt(sum((p - mx) ** 2 for p in x)) * math.sqrt(sum((q - my) ** 2 for q in y))
    return sum((p - mx) * (q - my) for p, q in zip(x, y)) / den if den > 1e-12 else 0.0


def test_predictions_match_brute_force(table, ratings):
    users = by(ratings, 0)
    sims = {}
    for a, b in itertools.permutations(users, 2):
        common = sorted(users[a].keys() & users[b].keys())
        if len(common) >= 2:
            sims[a, b] = round(pearson([users[a][c] for c in common], [users[b][c] for c in common]), 9)
    wanted = [(u, i) for u in (1, 5, 9) for i in range(80) if i not in users[u]]
    k, expected, scored = 3, {}, set()
    for u, i in wanted:
        near = sorted(((sims.get((u, v), 0.0), -v, users[v][i]) for v in users if v != u and i in users[v]), reverse=True)[:k]
        den = sum(abs(s) for s, _, _ in near)
        expected[u, i] = sum(s * r for s, _, r in near) / den if den else 0.0
        if den:
            scored.add((u, i))
    spark = table.sparkSession
    pairs = spark.createDataFrame(wanted, "user_id bigint, item_id bigint")
    similarities = rc.user_similarities(table).withColumn("sim", F.round("sim", 9)).filter("sim != 0")
    similarities = materialize(similarities, "similarities")
    for popular in (0, 8, rc.MANY_RATERS):  # all items through neighbours, some, none
        got = {(r["user_id"], r["item_id"]): r["pred"] for r in rc.predict_by_raters(pairs, similarities, table, k, popular).collect()}
        assert got == pytest.approx(expected, abs=1e-6)
    unseen = rc.unseen_by_raters(similarities.filter("id IN (1, 5, 9)"), table, 4, k)
    best = {u: sorted((-round(p, 6), i) for (v, i), p in expected.items() if v == u and (v, i) in scored)[:4] for u in (1, 5, 9)}
    got = {u: [] for u in best}
    for r in unseen.orderBy("user_id", "rank").collect():
        got[r["user_id"]].append(r["score"])
    assert all(got[u] == pytest.approx([-s for s, _ in best[u]], abs=2e-6) for u in best)


def test_co_liked_with_a_hot_user(table, ratings):
    users, counts = by(ratings, 0), {}
    for u, v in users.items():
        for x, y in itertools.permutations(v, 2):
            if v[x] >= 4:
                counts.setdefault(x, {}).setdefault(y, 0)
                counts[x][y] += 1
    expected = {x: sorted(((-n, y) for y, n in c.items()))[:3] for x, c in counts.items()}
    got = {}
    for r in rc.co_liked(table, 3).orderBy("item_id", "rank").collect():
        got.setdefault(r["item_id"], []).append((-r["n"], r["other"]))
    assert got == expected


def test_same_result_for_any_partitioning(table):
    def pairs(df):
        return sorted(tuple(r) for r in overlap.pearson(overlap.co_rated(df, "user_id", "item_id")).collect())

    assert pairs(table.repartition(1)) == pairs(table.repartition(13, "item_id"))


def nearest_by_definition(rows, k):
    """Of all that share anything, the k with the highest cosine; squares are compared as fractions."""
    near = {}
    for a, b in itertools.permutations(rows, 2):
        common = rows[a].keys() & rows[b].keys()
        if common:
            dot = sum(int(2 * rows[a][i]) * int(2 * rows[b][i]) for i in common)
            near.setdefault(a, []).append((-Fraction(dot * dot, sum(int(2 * x) ** 2 for x in rows[b].values())), b))
    return {a: [b for _, b in sorted(others)[:k]] for a, others in near.items()}


@pytest.mark.parametrize("k", [1, 3, 10])
def test_nearest_whole_rows(table, ratings, k):
    want = nearest_by_definition(by(ratings, 0), k)
    got = {}
    for r in rc.nearest_rows(table, "user_id", "item_id", k).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["other"])
    assert got == want


def test_nearest_rows_that_share_one_hot_item(spark):
    """Nobody shares two ratings, all share one: each still has its nearest, without a pair of all."""
    rows = {u: {0: 1 + u % 5 / 2, 100 + u: 1 + u % 7 / 2} for u in range(300)}
    df = spark.createDataFrame([(u, i, x) for u, v in rows.items() for i, x in v.items()], "user_id bigint, item_id bigint, rating double")
    got = {}
    for r in rc.nearest_rows(df, "user_id", "item_id", 4).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["other"])
    assert got == nearest_by_definition(rows, 4)


def test_whole_row_recommendations_match_brute_force(table, ratings):
    rows = by(ratings, 0)
    near = nearest_by_definition(rows, 3)
    got = {}
    for r in rc.mean_of_nearest(table, 3, 4).collect():
        assert r["item_id"] not in rows[r["user_id"]]
        got.setdefault(r["user_id"], {})[r["rank"]] = (r["item_id"], r["score"])
    for user, others in near.items():
        sums = {}
        for b in others:
            for i, x in rows[b].items():
                if i not in rows[user]:
                    sums[i] = sums.get(i, 0) + x
        want = sorted((-round(x / 3, 6), i) for i, x in sums.items())[:4]
        assert [got.get(user, {}).get(n) for n in range(1, len(want) + 1)] == [(i, pytest.approx(-x)) for x, i in want]


@pytest.mark.parametrize("busy", [0, 5, 10_000])
def test_item_matrix_times_row(table, ratings, busy):
    """The same scores whichever raters' lists are squared."""
    columns, rows = by(ratings, 1), by(ratings, 0)
    length = {i: sum(x * x for x in c.values()) ** 0.5 for i, c in columns.items()}
    want = {}
    for user, row in rows.items():
        scores = {}
        for i in columns.keys() - row.keys():
            score = sum(sum(columns[i][v] * columns[j][v] for v in columns[i].keys() & columns[j].keys()) / length[i] / length[j] * x for j, x in row.items())
            if score > 0:
                scores[i] = score
        want[user] = sorted(((-round(s, 6), i) for i, s in scores.items()))[:4]
    got = {}
    for r in rc.similarity_times_row(table, 4, busy).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append((-r["score"], r["item_id"]))
    assert {u: [x for x, _ in v] for u, v in got.items()} == {u: pytest.approx([x for x, _ in v], abs=2e-6) for u, v in want.items() if v}
    assert sum([i for _, i in got[u]] == [i for _, i in want[u]] for u in got) > 0.9 * len(got)


def test_pairs_are_streamed_to_parts_of_bounded_size(spark, monkeypatch):
    """No task of the pair join sums up its pairs, and the number of parts follows the number of pairs."""
    monkeypatch.setattr(overlap, "PAIRS", 50)
    rows = [(u, i, 0.5 * (1 + (u + i) % 10)) for i in range(20) for u in range(i, i + 12)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    pairs = overlap.co_rated(df, "user_id", "item_id")
    assert pairs.select(F.spark_partition_id()).rdd.getNumPartitions() == 20 * 66 // 50 + 1
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") < plan.index("REPARTITION_BY_NUM") and "partial_sum" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_light_elements_are_not_looked_up_again(spark, monkeypatch):
    """Ratings without hot users make no candidate table, and a Jaccard candidate that can't reach the threshold is dropped at once."""
    written = {}

    def noted(df, label="cut"):
        written[label] = out = materialize(df, label)
        return out

    monkeypatch.setattr(overlap, "materialize", noted)
    rows = [(u, (7 * u + 3 * j) % 90, 4.5) for u in range(40) for j in range(8)]
    rc.co_liked(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"), 3).collect()
    assert "pairs" not in written
    # Sets of 30 that share their rarest element only, and two that are nearly equal.
    sets = [(i, e) for i in range(20) for e in (0, *range(100 * i + 100, 100 * i + 129))]
    sets += [(50, e) for e in range(5000, 5030)] + [(51, e) for e in range(5000, 5029)] + [(i, e) for i in range(52, 90) for e in range(5020, 5030)]
    df = spark.createDataFrame(sets, "id bigint, elem bigint")
    got = {(r.a, r.b) for r in overlap.jaccard_pairs(df, 0.9).collect() if r.a < 52 and r.b < 52}
    assert got == {(50, 51)}


@pytest.mark.parametrize("k", [1, 3])
def test_bounds_keep_the_nearest_rows(spark, table, ratings, k):
    """Rows that are too far away for an element's leading ones are dropped, and the nearest ones are still all there."""
    rows = by(ratings, 0)
    size = {u: sum((2 * x) ** 2 for x in r.values()) for u, r in rows.items()}
    want = set()
    for u, r in rows.items():
        dots = {v: sum(4 * r[i] * s[i] for i in r.keys() & s.keys()) for v, s in rows.items() if v != u and r.keys() & s.keys()}
        best = sorted(dots, key=lambda v: (-Fraction(int(dots[v]) ** 2, int(size[v])), v))[:k]
        want |= {(u, v, n + 1) for n, v in enumerate(best)}
    assert {tuple(r) for r in rc.nearest_rows(table, "user_id", "item_id", k).collect()} == want


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8])
def test_bitmaps_take_out_pairs_that_share_too_little(spark, monkeypatch, threshold):
    """The same pairs with and without bitmaps; with them, sets that share one element only are not met."""
    rng = random.Random(5)
    sets = {i: {rng.randrange(60) for _ in range(rng.randrange(1, 30))} for i in range(40)}
    sets |= {100 + i: set(sets[i]) - {min(sets[i])} | {1000 + i} for i in range(20)}
    members = spark.createDataFrame([(i, f"e{e}") for i, s in sets.items() for e in s], "id bigint, elem string")
    brute = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= Fraction(str(threshold))}
    for many in (10**9, -1):
        monkeypatch.setattr(overlap, "MANY", many)
        assert {(r["a"], r["b"]) for r in overlap.jaccard_pairs(members, threshold).collect()} == brute
    one = spark.createDataFrame([(i, f"x{i}-{j}") for i in range(30) for j in range(5)] + [(i, "common") for i in range(30)], "id bigint, elem string").withColumn("x", F.lit(1))
    met = overlap.shared_sums(one, {"shared": lambda x, y: F.lit(1)}, need=lambda n: F.lit(1), least=lambda n, m: F.lit(5))
    assert met.count() == 0


def test_only_found_ids_are_looked_up_again(spark, monkeypatch):
    """Shares that were left out are added for the ids of found pairs; other ids' members are not sent again."""
    written = {}

    def keeping(df, label="cut"):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(overlap, "materialize", keeping)
    rows = [(i, f"hot{j}") for i in range(30) for j in range(3)] + [(i, f"own{i}-{j}") for i in range(30) for j in range(4)] + [(i, f"rare{j}") for i in (3, 4) for j in range(9)]
    got = overlap.jaccard_pairs(spark.createDataFrame(rows, "id bigint, elem string"), 0.5).collect()
    assert [(r["a"], r["b"], r["shared"]) for r in got] == [(3, 4, 12)]
    assert {r["id"] for r in written["found"].collect()} == {3, 4}


def near_of(spark, table):
    return materialize(rc.nearest(rc.user_similarities(table), 5), "near")


def test_neighbour_rows_are_dealt_in_bounded_parts(spark, table, monkeypatch):
    """More rows make more tasks, not larger ones, and the same results."""
    sims, near = materialize(rc.user_similarities(table), "sims"), near_of(spark, table)
    pairs = table.filter("(user_id + item_id) % 5 = 0").select("user_id", "item_id")
    recs = materialize(rc.recommend_centred(near, table, 3), "recs")
    jobs = {
        "recs": lambda: rc.recommend_centred(near, table, 3), "unseen": lambda: rc.unseen_by_raters(sims, table, 3, 2),
        "predicted": lambda: rc.predict_centred(pairs, near, table), "why": lambda: explain.neighbour_reasons(recs, near, table, 2)}
    plain = {name: sorted(map(str, job().collect())) for name, job in jobs.items()}
    monkeypatch.setattr(relational, "PART_ROWS", 10)
    dealt, parts = relational.dealt, []

    def watched(df, rows, *keys, **how):
        out = dealt(df, rows, *keys, **how)
        n = df.count()
        assert rows == n, "the parts are planned by the true number of rows"
        parts.append(out.rdd.getNumPartitions())
        assert parts[-1] >= n // 10
        return out

    monkeypatch.setattr(rc, "dealt", watched)
    monkeypatch.setattr(explain, "dealt", watched)
    assert {name: sorted(map(str, job().collect())) for name, job in jobs.items()} == plain
    assert len(parts) == 4 and min(parts) > 8


def test_raters_that_are_no_neighbours_are_dropped_before_the_shuffle(spark):
    """Users 0 and 1 are neighbours; of the 200 raters of the asked item only user 1 is let through, and none is lost without marks."""
    known = spark.createDataFrame([(u, 7, 3.0) for u in range(1, 201)], "other bigint, item_id bigint, rating double")
    sims = spark.createDataFrame([(0, 1, 0.5), (1, 0, 0.5)], "user_id bigint, other bigint, sim double")
    asked = spark.createDataFrame([(0, 7, 200)], "user_id bigint, item_id bigint, n_raters bigint")
    met = [r.other for r in rc.raters_met(asked, sims, known).collect()]
    assert 1 in met and len(met) < 10
    assert rc.raters_met(asked, sims, known, marks=0).count() == 200


def test_items_without_an_id_are_never_seen(spark):
    rows = [(0, 1, 4.0), (0, 2, 2.0), (0, None, 3.0), (1, 1, 5.0), (1, 2, 1.0), (1, None, 4.5), (1, 3, 4.0)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    near = spark.createDataFrame([(0, 1, 1.0, 1), (5, 1, 1.0, 1)], "id bigint, other bigint, sim double, rank bigint")
    got = {(r.user_id, r.item_id): r.score for r in rc.recommend_centred(near, ratings, 5).collect()}
    assert got == {(0, None): pytest.approx(3 + 4.5 - 14.5 / 4), (0, 3): pytest.approx(3 + 4 - 14.5 / 4)}


# --- room that the pair join takes ------------------------------------------------------------

def test_elements_travel_as_numbers(spark, monkeypatch):
    """Texts are numbered before members are written and joined; the pairs are those of the texts."""
    written = {}
    monkeypatch.setattr(overlap, "materialize", lambda df, label="cut", of=overlap.materialize: written.setdefault(label, dict(df.dtypes)) and of(df, label))
    rng = random.Random(5)
    sets = {d: {f"a rather long element {rng.randint(0, 30)}" for _ in range(20)} | {f"own {d}"} for d in range(30)}
    rows = [(d, e) for d, s in sets.items() for e in s] + [(None, "a rather long element 1"), (3, None)]
    got = {(r.a, r.b): (r.shared, r.n_a, r.n_b) for r in overlap.jaccard_pairs(spark.createDataFrame(rows, "id bigint, elem string"), 0.4).collect()}
    sets[3] = sets[3] | {None}
    want = {(a, b): (len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.4 * len(sets[a] | sets[b])}
    assert got == want and want
    assert written["members"]["elem"] == written["counted"]["elem"] == "bigint"


@pytest.mark.parametrize("modulus", [None, 101])
def test_signatures_of_runs_of_members(spark, monkeypatch, modulus):
    """A task hashes its members in runs; ids over several runs, without a number or without an id give the smallest hashes."""
    monkeypatch.setattr(sg, "MEMBERS", 7)
    monkeypatch.setattr(sg, "HASHES", 16)
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, 3, 40, None]), rng.choice([None, rng.randint(-5, 2**40)])) for _ in range(200)] + [(77, None)]
    family = sg.coefficients(5)
    got = {r.id: list(r.signature) for r in sg.minhash(spark.createDataFrame(rows, "id bigint, x bigint").repartition(3), F.col("x"), family, modulus=modulus).collect()}
    want = {}
    for d in {d for d, _ in rows}:
        xs = [x % sg.PRIME for e, x in rows if e == d and x is not None]
        want[d] = [min(((a * x + b) % sg.PRIME % (modulus or sg.PRIME) for x in xs), default=None) for a, b in family]
    assert got == want
    wide = sg.minhash(spark.createDataFrame(rows, "id bigint, x bigint"), F.col("x"), family)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in wide


def test_sweep_signs_ids_of_pairs_only(spark, tmp_path, monkeypatch):
    """Of ten texts two are alike: only they are signed, once."""
    from affinity.plans.queries import similarity

    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words[:-1])] + [" ".join(f"{w}x{d}" for w in words) for d in range(8)]
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    signed = {}
    monkeypatch.setattr(similarity, "materialize", lambda df, label="cut", of=similarity.materialize: signed.setdefault(label, of(df, label)))
    got = similarity.minhash_sweep(spark, str(tmp_path)).collect()
    assert [(r.a, r.b, r.jaccard) for r in got] == [(0, 1, round(38 / 39, 6))] and all(0.7 < r[f"est_{t}"] <= 1 for r in got for t in similarity.SWEEP[1:])
    assert sorted(r.id for r in signed["signatures"].collect()) == [0, 1]
