"""Token alignment against a plain reading of the definition."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from affinity.llm import alignment, catalogue

SF = "/root/testdata/sf0.001"
A, B = catalogue.BYTE_BPE, catalogue.PIECE_BPE
AWKWARD = [
    None, "", " ", "  ", "a", "a  b   c", "tab\tand\nline \n next", "<|endoftext|> <s> </s> <0x41>", "▁ low line", "ﬁ é é 𝒳😀 日本語テキスト", "\x00 nul", " lead", "trail ", "a b  c",
    "x" * 5000, "ab " * 3000, "=" * 3000 + " " * 3000 + "-" * 500, "\n" * 400, "don't  we'll\r\n it's 12345 67.8e9", "​ zero ﻿ width", "😀" * 800, "Ελληνικά κείμενα и русский текст", "a\u0085 b᠎ c",
]


def plain(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    made, count = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a, bytes_b = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a], [piece(i) for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            made.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        groups, low = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(([i for i, e in zip(ids_a, ends_a) if low < e <= end], [i for i, e in zip(ids_b, ends_b) if low < e <= end]))
            low = end
        made.append(groups)
        count.update({(x, y) for ga, gb in groups for x in set(ga) for y in set(gb)})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in made:
        links = [((x, y), n * m) for ga, gb in groups for x, n in Counter(ga).items() for y, m in Counter(gb).items()]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((
            sum(len(ga) for ga, _ in groups), sum(len(gb) for _, gb in groups), len(groups), sum(n for _, n in links),
            sum(n for p, n in links if count[p] == best[p[0]]), sum(n * count[p] for p, n in links), sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_awkward_rows(spark, monkeypatch):
    """Texts of every kind, repeated ids and rows; the last columns are not read."""
    values = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(AWKWARD)] + [(4, "a", "x", 1), (4, "other words", "x", 1)]
    docs = spark.createDataFrame(values, "doc_id bigint, text string, pair string, shard int")
    got = sorted((tuple(r) for r in alignment.align(docs, A, B).collect()), key=str)
    assert got == sorted(((v[0], *p) for v, p in zip(values, plain([v[1] for v in values]))), key=str)
    assert any(g[1] == 0 for g in got) and any(g[4] > max(g[1], g[2]) for g in got)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in catalogue.QUERIES["op13_token_alignment"](spark, SF).collect()}
    assert got == dict(zip([d.doc_id for d in docs], plain([d.text for d in docs])))


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert alignment.align(docs.limit(0), A, B).collect() == []
    nothing = docs.limit(2).selectExpr("doc_id", "cast(null as string) as text")
    assert [tuple(r)[1:] for r in alignment.align(nothing, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@pytest.mark.parametrize("seed", range(20))
def test_coalescing(seed):
    """Groups are the parts between common ends, whatever the cuts."""
    draw = random.Random(seed)
    n = draw.randint(1, 60)
    cuts = [sorted({*draw.sample(range(1, n + 1), draw.randint(0, n)), n}) for _ in range(2)]
    starts = [np.array([0, *c[:-1]]) for c in cuts]
    got = alignment.coalesced(starts[0], np.array(cuts[0]), starts[1], np.array(cuts[1]))
    common = sorted(set(cuts[0]) & set(cuts[1]))
    for group, cut in zip(got, cuts):
        assert group.tolist() == [sum(e > c for c in common) for e in cut]


@pytest.mark.parametrize("pairs", [1, 7, 1 << 20])
def test_expansion_in_parts(monkeypatch, pairs):
    """The same pairs for any number expanded together, and one row for a group of equal tokens."""
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    draw = random.Random(1)
    doc_of = np.sort(np.array([draw.randint(0, 4) for _ in range(30)]))
    group_a, group_b = (np.array([g for g in range(30) for _ in range(draw.randint(1, 5))]) for _ in range(2))
    a, b = (np.array([draw.randint(0, 6) for _ in g]) for g in (group_a, group_b))
    want = Counter((doc_of[g], x * 10 + y) for g, x in zip(group_a, a) for h, y in zip(group_b, b) if g == h)
    doc, pair, n = alignment.linked_pairs(group_a, a, group_b, b, doc_of, 10, 10)
    assert dict(zip(zip(doc, pair), n)) == want and len(doc) == len(want)
    ones = np.zeros(100_000, np.int64)
    assert [x.tolist() for x in alignment.linked_pairs(ones, ones + 3, ones, ones + 4, np.zeros(1, np.int64), 10, 10)] == [[0], [34], [10**10]]


def test_forgetting_changes_nothing(monkeypatch):
    own = alignment.Pieces(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = [t or "" for t in AWKWARD]
    first = own.encode(texts)
    monkeypatch.setattr(alignment, "KNOWN", 1)
    for (x, n), (y, m) in zip(first, own.encode(texts)):
        assert x.tolist() == y.tolist() and n.tolist() == m.tolist()
    one = [own.encode([t]) for t in texts]
    assert np.concatenate([o[0][0] for o in one]).tolist() == first[0][0].tolist() and np.concatenate([o[1][1] for o in one]).tolist() == first[1][1].tolist()
