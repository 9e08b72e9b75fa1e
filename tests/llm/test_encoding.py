"""Encodings by halves against the library's own, on texts that are hard to cut."""

import hashlib
import random

import pytest
import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from affinity.llm import encoding

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
DEFINITION = open(PATH, encoding="utf-8").read()
PIECES = ["the", "Ing", " ", "  ", "\n", "'s", "'re", "'l", "l", "'", "!", "12", "é", "́", "̣", "İ", "한", "ᅡ", "漢字", "é", "ñandú", "<|endoftext|>", "<|endof", "text|>", "🙂🙂", "#" * 9, "x" * 30, " ", "Σ", "한", "\x00", "-" * 5]


def expected(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(60))
def test_tree_is_exact(seed, monkeypatch):
    draw = random.Random(seed)
    monkeypatch.setattr(encoding, "WIDTH", draw.choice([1, 4, 16]))
    own = encoding.Encoder(DEFINITION)
    pieces = draw.sample(PIECES, draw.randint(2, len(PIECES)))
    text = "".join(draw.choice(pieces) for _ in range(draw.choice([5, 150, 900])))
    for leaf in (1, 7, 64, 333):
        if len(text) / leaf < 700:
            assert own.tree(text, leaf)[:, 0].tolist() == expected(text)


@pytest.mark.parametrize("text", ["a" * 40_000, "ab" * 20_000 + " end", " " * 50_000, "word " * 9000, "1" * 20_000, "́" * 18_000 + "e"])
def test_long_unbroken(text, monkeypatch):
    monkeypatch.setattr(encoding, "LEAF", 1 << 14)
    own = encoding.Encoder(DEFINITION)
    assert own.encode([text, "x"]) == [expected(text), expected("x")]


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(encoding, "LEAF", 1 << 14)
    long = " ".join(f"Word{i % 37}'s é{i}" for i in range(9000))
    rows = [(1, None), (2, ""), (2, ""), (3, " \n"), (None, "Hello, World!"), (4, long), (4, long), (5, "<|startoftext|>x<|endoftext|>")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())])
    df = spark.createDataFrame([(*r, "own") for r in rows], schema)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = expected(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(PLAIN.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, encoding.digest(df, PATH).collect()), key=str) == sorted(want, key=str)
    assert encoding.digest(df.limit(0), PATH).collect() == []
