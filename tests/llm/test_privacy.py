"""Personal values against the contract's plain patterns, disclosing terms against a plain count over documents."""

import random
import re
from collections import defaultdict
from hashlib import sha256
from math import log

import pytest

from affinity.llm import catalogue, privacy
from tests.llm.test_against_sql import frame

SF = "/root/testdata/sf0.001"
# Fixed values of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    holds = [lambda m: True, lambda m: all(int(p) <= 255 for p in m[0].split(".")), lambda m: 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m)), lambda m: 9 <= len(digits(m)) <= 15]
    return [(k, *m.span()) for k, p in enumerate((EMAIL, IP, CARD, PHONE)) for m in p.finditer(text) if holds[k](m)]


def plain_spans(texts, least_contexts=2, threshold=0.9):
    """Base and all spans of each text, from counts over all of them."""
    bases = [plain_base(t) for t in texts]
    words = [[m for m in WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), t)) if all(m.end() <= a or m.start() >= b for _, a, b in base)] for t, base in zip(texts, bases)]
    shape = lambda w: "#number" if re.fullmatch("[0-9]+", w) else "#code" if re.search("[0-9]", w) else "#word"
    with_term, with_entity, together, around = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, (text, base, ws) in enumerate(zip(texts, bases, words)):
        for m in ws:
            with_term[m[0]].add(i)
            with_term[shape(m[0])].add(i)
        for k, a, b in base:
            value = text[a:b].lower() if k == 0 else text[a:b] if k == 1 else re.sub("[^0-9]", "", text[a:b])
            with_entity[k, value].add(i)
            left, right = [m[0] for m in ws if m.end() <= a][-8:], [m[0] for m in ws if m.start() >= b][:8]
            for t in [*left, *right, *map(shape, left + right)]:
                together[(k, value), t].add(i)
                around[(k, value), t].add((tuple(left), tuple(right)))
    told = {
        (e, t) for (e, t), docs in together.items()
        if len(around[e, t]) >= least_contexts and len(with_entity[e]) < len(texts) and 1 + log(len(docs) / len(with_term[t])) / log(len(texts) / len(with_entity[e])) >= threshold}
    terms = {}
    for e, t in told:
        if t[0] != "#":
            terms[t] = max(terms.get(t, 4), 5 if (e, shape(t)) in told else 4)
    return [(base, sorted(base + [(terms[m[0]], *m.span()) for m in ws if m[0] in terms])) for base, ws in zip(bases, words)]


def written(spans):
    return ",".join(f"{(privacy.KINDS + privacy.ADDED)[k]}:{a}:{b}" for k, a, b in spans)


@pytest.mark.parametrize("seed", range(60))
def test_base_against_plain_patterns(seed):
    draw = random.Random(seed)
    parts = ["a", "Z", "@", "@", ".", ".", "-", "+", "%", "_", "0", "9", "25", "255", "256", "1.2.3.4", " ", "(", ")", "é", "\n", "b@c.d", "+49 (30) 123-4567", "4111 1111 1111 1111", "4417744280351547", "@x.y"]
    for _ in range(300):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        assert privacy.base_spans(text) == plain_base(text), text


def test_long_runs():
    """No pattern goes over a run more than a few times."""
    n = 300_000
    for text in ("a" * n, "1" * n, "a@" * n, "1." * n, "+" * n, "+1" + " " * n, "@" + "a-" * n, ".".join(["1"] * n), "0" * n + ".1.1.1", "x" * n + "@y.z", "é" * n):
        privacy.base_spans(text)
    assert privacy.base_spans("0" * n + ".1.1.1")[0] == (1, 0, n + 6)


def texts():
    draw = random.Random(3)
    common = [f"word{i}" for i in range(30)]
    filler = lambda n: " ".join(draw.choices(common, k=n))
    out = [filler(30) for _ in range(120)]
    # A name that comes with one address in other surroundings each time, and once without it.
    out += [f"{filler(6)} Quillfeather {filler(2)} q.f@example.org {filler(9)}" for _ in range(5)] + [f"{filler(9)} of Quillfeather, {filler(4)}"]
    # An account that comes with one phone; a number is so rare here that it discloses too.
    out += [f"{filler(40)} Kontonummer7 881{i % 2} {filler(1)} +49 (30) 123-4567 {filler(20)}" for i in range(4)]
    # Copies of one passage are one context.
    out += [f"{filler(9)}\n\n" + "zebu yak gnu okapi one two three four n@copies.example five six seven eight nine ten eleven twelve"] * 6
    out += ["", " ", "@", "a@b.c", "mail " * 2000 + "x@long.example " + "é" * 5000]
    return out


def test_terms_against_plain_counts(spark):
    made = texts()
    values = [(i if i % 11 else None, t, "x") for i, t in enumerate(made)] + [(7, None, "x"), (1, made[1], "x")]
    docs = spark.createDataFrame(values, "doc_id bigint, text string, term string")
    got = sorted(tuple(r) for r in privacy.digest(docs).select("spans", "base_sha256", "n_email", "n_ip", "n_card", "n_phone", "n_terms").collect())
    want = []
    for base, span in plain_spans([v[1] or "" for v in values]):
        want.append((written(span), sha256(written(base).encode()).hexdigest(), *(sum(k == i for k, *_ in base) for i in range(4)), len(span) - len(base)))
    assert got == sorted(want)
    flagged = {t[a:b] for t, (_, span) in zip((v[1] or "" for v in values), plain_spans([v[1] or "" for v in values])) for k, a, b in span if k >= 4}
    assert {"Quillfeather", "Kontonummer7"} <= flagged and "zebu" not in flagged and not any(f.startswith("word") for f in flagged)


def test_query_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d.doc_id: (sha256(written(base).encode()).hexdigest(), written(span)) for d, (base, span) in zip(docs, plain_spans([d.text or "" for d in docs]))}
    got = {r.doc_id: (r.base_sha256, r.spans) for r in catalogue.QUERIES["op11_personal_data"](spark, SF).collect()}
    assert got == want


def test_sanitised(spark):
    made = texts()
    docs = spark.createDataFrame([(i, t, "x", 1.5) for i, t in enumerate(made)] + [(None, None, "x", 1.5)], "doc_id bigint, text string, __key string, kind double")
    out = privacy.sanitised(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(made) + 1 and got[None] is None
    for i, (t, (_, span)) in enumerate(zip(made, plain_spans([*made, ""]))):
        assert got[i] == privacy.cleaned_text(t, span)
        assert not EMAIL.search(got[i]) and "Quillfeather" not in got[i]
    assert sum(got[i] == t for i, t in enumerate(made)) >= 120
    assert privacy.cleaned_text("a@b.c 7 x", [(0, 0, 5), (4, 6, 7), (5, 8, 9)]) == "[EMAIL] [NUMBER] "


def test_empty_table(spark):
    docs = frame(spark)
    assert privacy.digest(docs.limit(0)).collect() == []
    assert privacy.sanitised(docs.limit(0)).collect() == []
    assert privacy.digest(docs).count() == docs.count()
    one = spark.createDataFrame([(1, "ann a@b.c")], "doc_id bigint, text string")
    assert [r.spans for r in privacy.digest(one).collect()] == ["email:4:9"]


def test_filter_holds_every_term(spark):
    words = [f"t{i}é" for i in range(500)]
    packed = privacy._filter(spark.createDataFrame([(w,) for w in words], "term string"))
    bits = [packed[(c := privacy.crc32(w.encode()) % privacy.BITS) >> 3] >> (c & 7) & 1 for w in words]
    assert len(packed) * 8 == privacy.BITS and all(bits)
