"""Removed bytes and words against brute force, with small and large groups."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm import repeats, substring_dedup, suffix_dedup
from affinity.llm.suffixes import suffix_array


def key(i):
    return (i is not None, i or 0)


def plain_bytes(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            first[w] = min(first.get(w, (key(i), p)), (key(i), p))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - 99):
            if first[b[p : p + 100]] < (key(i), p):
                gone[p : p + 100] = [True] * 100
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def plain_words(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - 12):
            k = tuple(w[p : p + 13])
            first[k] = min(first.get(k, key(i)), key(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < key(i):
                gone[p : p + 13] = [True] * 13
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("doc", T.StringType()), T.StructField("version", T.StringType())])
    return spark.createDataFrame([(*r, "own", None, "x") for r in rows], schema)


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["the", "of", "and", "é", "to"] + ["".join(draw.choices("abcdeghö", k=draw.randint(2, 9))) for _ in range(300)]
    text = lambda k: " ".join(draw.choices(words, k=k))
    passages = [text(k) for k in (8, 14, 15, 25, 80)] + ["ab " * 120, "z" * 350]
    rows = [(None, text(40)), (0, None), (1, ""), (2, " \n"), (3, "short")]
    for i in range(10, 10 + n):
        parts = [text(draw.randint(0, 30)) for _ in range(draw.randint(1, 4))]
        for _ in range(draw.randint(0, 3)):
            parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        rows.append((i, draw.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200, rows[20][1]), (201, rows[20][1] + " tail"), (202, "head " + rows[20][1]), (203, rows[21][1]), (203, rows[21][1]), (204, rows[22][1]), (204, rows[23][1] + rows[22][1]), (-5, rows[24][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,most,piece", [(1, 50_000, 1 << 20), (2, 3, 1 << 20), (3, 1, 150), (4, 50_000, 64)])
def test_against_brute_force(spark, monkeypatch, seed, most, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rows = corpus(seed)
    monkeypatch.setattr(suffix_dedup, "MOST_OF_ANCHOR", most)
    df = frame(spark, rows).repartition(5)
    got = suffix_dedup.spans(df, most).mapInPandas(suffix_dedup._digests, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    assert sorted(map(tuple, got.collect()), key=str) == plain_bytes(rows)
    got = substring_dedup.spans(df, most).mapInPandas(substring_dedup._digests, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    assert sorted(map(tuple, got.collect()), key=str) == plain_words(rows)


def test_empty(spark):
    df = frame(spark, [(1, "x")]).limit(0)
    assert suffix_dedup.digest(df).collect() == [] and substring_dedup.digest(df).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    draw = random.Random(seed)
    text = "".join(draw.choices("ab" if seed % 2 else "abcdefgh", k=400)) + "abab" * seed * 10
    symbols = np.r_[np.frombuffer(text.encode(), np.uint8).astype(np.int64) + 1, 0]
    order, rank = suffix_array(symbols, 9)
    s = [tuple(symbols[i:]) for i in range(len(symbols))]
    assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i])
    assert rank[order].tolist() == list(range(len(s)))
    size = np.array([150, len(text) - 150])
    shared = suffix_dedup.common_prefixes(symbols, order, rank, np.array([0, 150]), size, 30)
    for i in range(2, len(order)):
        a, b = s[order[i - 1]], s[order[i]]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == min(n, 30)


def test_matching_statistics():
    draw = random.Random(3)
    known = substring_dedup.Automaton()
    texts = [draw.choices("abc", k=draw.randint(0, 25)) for _ in range(12)]
    for t in texts:
        known.add(t)
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
    asked = draw.choices("abcd", k=200)
    want = [max(n for n in range(i + 2) if tuple(asked[i + 1 - n : i + 1]) in subs or n == 0) for i in range(200)]
    assert known.matched(asked) == want


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_whose_short_hashes_agree(spark, doc_id):
    """Texts of one id (or without any) keep their own spans, also where 24 bits of a hash are the same."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=6))
    texts = [" ".join(word() for _ in range(draw.choice([40, 250]))) for _ in range(9000)]
    held = spark.createDataFrame([(t,) for t in texts], "text string").groupBy(F.hash("text").bitwiseAND(0xFFFFFF).alias("h")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").collect()
    pair = next(sorted(r.t, key=len) for r in held if len({len(t) // 1000 for t in r.t}) > 1)
    common = " ".join(word() for _ in range(60))
    rows = [(doc_id, pair[0]), (doc_id, pair[-1]), (1, common), (doc_id, f"{pair[0]} {common}"), (9, f"{common} {pair[-1]}")]
    df = frame(spark, rows)
    got = suffix_dedup.digest(df)
    assert sorted(map(tuple, got.collect()), key=str) == plain_bytes(rows)
    got = substring_dedup.digest(df)
    assert sorted(map(tuple, got.collect()), key=str) == plain_words(rows)
    assert {r.n_removed for r in suffix_dedup.digest(frame(spark, rows[:2])).collect()} == {0}


@pytest.mark.parametrize("piece", [1 << 20, 150])
def test_text_with_a_short_period_repeats_itself(spark, monkeypatch, piece):
    """Windows that equal an earlier one of their own run, in a text that no other text shares."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    draw = random.Random(5)
    word = lambda k, letters="abcdefghijklmnop": "".join(draw.choices(letters, k=k))
    rows = [(1, "-" * 99), (2, "=" * 100), (3, "+" * 101), (4, "z" * 168), (5, "y" * 169), (6, "q" * 700), (7, "é" * 60)]
    for i, period in enumerate([2, 3, 7, 31, 32, 33, 50, 67, 68, 69, 70, 99, 100, 130]):
        own = word(period)
        for j, more in enumerate([-1, 0, 1, 20, 60]):
            rows.append((10 + 10 * i + j, word(draw.randint(0, 150), "rstuvw") + word(1, "X") + (own + f"{j}" * (j > 2)) * 9))
            rows[-1] = (rows[-1][0], rows[-1][1][: len(rows[-1][1]) - 9 * period + 100 + period + more] + word(30, "RSTUVW"))
    rows += [(1000 + i, word(draw.randint(0, 80)) + word(draw.randint(1, 75)) * draw.randint(2, 9) + word(draw.randint(0, 80))) for i in range(150)]
    got = suffix_dedup.digest(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_bytes(rows)
