"""Fingerprints and groups against plain Python."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from affinity.llm import simhash


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for b in "\t\n\x0b\f\r":
        words = words.replace(b, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    out = []
    for (i, _), p, g in zip(rows, prints, group):
        ids = [r[0] for r, h in zip(rows, group) if h == g and r[0] is not None]
        out.append((i, f"{p:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,flips", [(2, 3), (60, 2), (400, 3), (300, 6)])
def test_trie_links(n, flips):
    rng = np.random.default_rng(n)
    seeds = rng.integers(0, 2**64, size=max(1, n // 20), dtype=np.uint64)
    values = set()
    while len(values) < n:
        v = int(rng.choice(seeds))
        for b in rng.integers(0, 64, size=rng.integers(0, flips + 1)):
            v ^= 1 << int(b)
        values.add(v)
    values = np.array(sorted(values), dtype=np.uint64)
    for fixed in (0, 16):
        got = {(int(i), int(j)) for a, b in simhash.trie_links(values, fixed) for i, j in zip(a, b)}
        want = {(i, j) for i, j in itertools.combinations(range(n), 2)
                if int(values[i] ^ values[j]).bit_count() <= 3 and (not fixed or int(values[i] ^ values[j]) >> 48 == 0)}
        assert got == want


def test_led_is_a_permutation_of_bits():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**64, size=50, dtype=np.uint64)
    for turn, sub in itertools.product(range(0, 64, 16), range(-1, 4)):
        led = simhash._led(values, turn, sub)
        for i in range(1, 50):
            assert int(led[0] ^ led[i]).bit_count() == int(values[0] ^ values[i]).bit_count()


@pytest.mark.parametrize("most", [1 << 21, 2])
def test_links_connect_all_close_pairs(spark, most):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    values = {base}
    for _ in range(120):
        v = base
        for b in rng.integers(0, 63, size=4):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values)
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint"), most).collect()

    def groups(pairs):
        group = {v: v for v in values}
        for a, b in pairs:
            old, new = group[a], group[b]
            group = {k: new if g == old else g for k, g in group.items()}
        return sorted(sorted(k for k in group if group[k] == g) for g in set(group.values()))

    assert groups([(r.src, r.dst) for r in got]) == groups([(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3])
    assert all((r.src ^ r.dst) & (2**64 - 1) for r in got)


def test_groups_and_awkward_rows(spark):
    words = "the quick brown fox jumps over a lazy dog while Seven zébras drink cold water near old stone walls".split()
    long = " ".join(words[i * 7 % len(words)] for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (5, "one two"), (6, long), (9, long + " end"), (None, long.upper()), (7, "x"), (7, "x"), (8, " ")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("least", T.StringType())])
    df = spark.createDataFrame([(*r, None, "a") for r in rows], schema)
    got = sorted([tuple(r) for r in simhash.digest(df).collect()], key=str)
    assert got == plain_groups(rows)
    assert simhash.digest(df.limit(0)).collect() == []
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({g for _, _, g in plain_groups(rows)}, key=str)


def test_one_of_each_keeps_unrelated_texts_of_one_id(spark):
    """Null ids, and an id that is the smallest of two groups, don't make unrelated texts a group."""
    draw = np.random.default_rng(3)
    a, b, c, d = (" ".join(f"{n}{w}" for w in draw.integers(0, 10**6, size=300)) for n in "abcd")
    rows = [(None, a), (None, b), (None, b), (1, c), (1, d), (2, c), (3, d.upper())]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, a), (None, b), (1, c), (1, d)], key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in simhash.digest(docs).collect()], key=str) == plain_groups(rows)
