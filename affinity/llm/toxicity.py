"""Toxic passages: maximal scoring segments over token log-odds, with extreme-value calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import decontamination
from affinity.llm.decontamination import words_of
from affinity.llm.frames import travels
from affinity.sources.scratch import materialize

travels(__name__)
travels(decontamination.__name__)

# Fixed values of the contract: rows whose crc32(doc_id) has this remainder never teach.
FOLDS = 5
#: Labelled rows that the model is fitted on, at most; it bounds the vocabulary and what reaches the driver.
MOST_LABELLED = 20_000
#: Strength of the Dirichlet prior, in documents.
PRIOR = 50.0
#: A token is tested from this many different texts on, near-duplicates counting once.
LEAST_TEXTS = 3
#: Letters that stand for a word too rare to be tested.
STEM = 4
#: Share of harmless texts whose strongest segments don't set the calibration, as labels err.
ERRING = 0.005
#: Near-duplicates agree in a band of minima over the hashes of their 5-word
#: shingles: at a similarity of 0.8 two texts do with 99.8 %, at 0.3 with 1.5 %.
SHINGLE, BANDS, BAND_ROWS = 5, 20, 6
#: Segments of which a harmless text has fewer than this are passages.
LEAST_EXPECTED = 0.01
#: Share of such tokens in a toxic passage.
DENSITY = 0.2


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class Model:
    """Scores of telling words and stems, that of any other token, words that their stem doesn't speak for, the calibration, and the final curve."""

    scores: dict[bytes, float]
    other: float
    apart: frozenset[bytes] = frozenset()
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0


def segments(places: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time, after Ruzzo and Tompa.

    Given are the tokens with a positive score; every one between them scores
    ``other`` < 0. Candidates are kept in order with the sums up to their
    left and right ends; each points to the nearest earlier one whose left sum
    is smaller, so that no candidate is looked at twice.
    """
    held: list[list] = []
    total, before = 0.0, -1
    for at, score in zip(places, scores):
        total += (at - before - 1) * other
        low, total, before = total, total + score, at
        new = [at, at + 1, low, total, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            new[4] = j
            if j < 0 or held[j][3] >= new[3]:
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(a, b, right - left) for a, b, left, right, _ in held]


def stem(word: bytes) -> bytes:
    """The first letters of a longer word, marked by a sign that is in no word."""
    return word.decode()[:STEM].encode() + b"*"


def passages(text: str | None, model: Model) -> tuple[int, list[tuple[int, int, float]]]:
    words = words_of(text)
    score: dict[bytes, float | None] = {}
    for w in set(words):
        score[w] = model.scores.get(w, None if w in model.apart else model.scores.get(stem(w)))
    places = [i for i, w in enumerate(words) if score[w] is not None]
    return len(words), segments(places, [score[words[i]] for i in places], model.other) if places else []


def surprise(n: int, score: float, k: float) -> float:
    """How unlikely a segment of this score or more is in a harmless text of n tokens.

    That is minus the logarithm of their expected number k * n * exp(-score):
    with log-likelihood ratios as scores, lambda is 1. No power is taken, so
    scores of any size keep their order.
    """
    return max(0.0, score - float(np.log(k)) - float(np.log(max(n, 1))))


def evidence(n: int, found: list[tuple[int, int, float]], k: float) -> float:
    """The segments' surprises, summed."""
    return float(np.log1p(sum(surprise(n, s, k) for _, _, s in found)))


def bands_of(text: str) -> list[int]:
    """Numbers that near-duplicate texts share one of; none for a text without words."""
    words = words_of(text)
    if not words:
        return []
    shingles = np.array([crc32(b" ".join(words[i : i + SHINGLE])) for i in range(max(len(words) - SHINGLE + 1, 1))], np.uint64)
    # Multiply-and-add hashes with odd factors drawn from a fixed seed.
    draw = np.random.default_rng(SHINGLE)
    factor, shift = (draw.integers(1, 1 << 63, (BANDS * BAND_ROWS, 1), np.uint64) for _ in range(2))
    low = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1 << 12):
        low = np.minimum(low, ((factor | np.uint64(1)) * shingles[at : at + (1 << 12)] + shift >> np.uint64(24)).min(axis=1))
    return [int.from_bytes(blake2b(bytes([b]) + row.tobytes(), digest_size=8).digest(), "big", signed=True) for b, row in enumerate(low.reshape(BANDS, BAND_ROWS))]


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"key": batch["key"], "toxic": batch["toxic"], "bands": [bands_of(t) for t in batch["text"]]})


def first_of_near_duplicates(rows: DataFrame) -> DataFrame:
    """The rows of (key, text, toxic) but those that share a band with one of the same label and a smaller key, so of each group of near-duplicates at least the first stays."""
    each = materialize(rows.mapInPandas(_banded, "key string, toxic int, bands array<bigint>").select("key", "toxic", F.explode("bands").alias("band")), "bands")
    least = each.groupBy("toxic", "band").agg(F.min("key").alias("first"))
    later = each.join(least, ["toxic", "band"]).where(F.col("key") > F.col("first")).select("key").distinct()
    return rows.join(later, "key", "left_anti")


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        held = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = set(words_of(text))
            held[toxic].update(words | set(map(stem, words)))
        yield pd.DataFrame([(w, t, n) for t, c in held.items() for w, n in c.items()], columns=["word", "toxic", "n"])


def _scored(model: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [passages(t, model.value) for t in batch["text"]]
            batch["n"] = [n for n, _ in made]
            batch["found"] = [[{"start": a, "end": b, "score": s} for a, b, s in found] for _, found in made]
            yield batch.drop(columns="text")

    return run


FOUND = "n bigint, found array<struct<start:int,end:int,score:double>>"


def taught(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(key, text, toxic): the different texts of up to ``most`` labelled documents, those with the smallest hashes, none held out; one or few of near-duplicates.

    Labels of a document that contradict each other count as toxic; rows with a null label or id do not teach.
    """
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("__labelled"), F.col("toxic").alias("__toxic"))
    # Bounded by ``most`` rows of two numbers.
    rows = docs.join(F.broadcast(own), F.col("doc_id") == F.col("__labelled")).select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("__toxic").alias("toxic"))
    rows = rows.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return first_of_near_duplicates(materialize(rows, "labelled"))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The model of the labelled texts; without toxic or harmless ones, a model that finds nothing."""
    spark = docs.sparkSession
    rows = materialize(taught(docs, labels, most), "taught").select("text", "toxic")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({}, -1.0, offset=-5.0)
    counts = rows.mapInPandas(_document_counts, "word binary, toxic int, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0"))
    counts = materialize(counts.where(F.col("y1") + F.col("y0") >= LEAST_TEXTS), "words")
    # Twice the log-likelihood ratio of two shares against one; by chance, less than one of all tokens passes.
    both = F.col("y1") + F.col("y0")
    gain = lambda y, n: F.when(y > 0, y * F.log(y * (n0 + n1) / (both * n))).otherwise(0.0)
    ratio = 2 * (gain(F.col("y1"), n1) + gain(F.col("y0"), n0))
    prior = PRIOR * both / (n1 + n0)
    p1, p0 = (F.col("y1") + prior) / (n1 + PRIOR), (F.col("y0") + prior) / (n0 + PRIOR)
    least = 2 * float(np.log(max(counts.count(), 2)))
    telling = counts.where((F.col("y1") >= LEAST_TEXTS) & (p1 > p0) & (ratio >= least)).select("word", p1.alias("p1"), p0.alias("p0")).orderBy("word")
    # Bounded by the vocabulary of ``most`` texts.
    kept = [(bytes(r.word), r.p1, r.p0) for r in telling.collect()]
    if not kept:
        return Model({}, -1.0, offset=-5.0)
    # A word in a passage is a sign with probability DENSITY, and which one goes by how much more often toxic texts hold it.
    words = [(p1, p0) for w, p1, p0 in kept if not w.endswith(b"*")] or [(p1, p0) for _, p1, p0 in kept]
    more = sum(p1 - p0 for p1, p0 in words)
    # Document shares over the mean number of tokens give shares of tokens.
    tokens = max(1.0, rows.select(F.avg(F.size(F.split("text", " "))).alias("m")).first().m)
    scores = {w: float(np.log(DENSITY * (p1 - p0) / more / (p0 / tokens) + 1 - DENSITY)) for w, p1, p0 in kept}
    scores = {w: x for w, x in scores.items() if x > 0}
    # Words that harmless texts hold are judged by themselves.
    stems = [w.decode() for w in scores if w.endswith(b"*")]
    word = F.col("word").cast("string")
    known = counts.where((F.col("y0") >= LEAST_TEXTS) & F.concat(F.substring(word, 1, STEM), F.lit("*")).isin(stems) & ~F.endswith(word, F.lit("*"))).select("word").collect() if stems else []
    model = Model(scores, float(np.log(1 - DENSITY)), frozenset(bytes(r.word) for r in known))
    found = rows.mapInPandas(_scored(spark.sparkContext.broadcast(model)), f"toxic int, {FOUND}").collect()
    model.k = _calibrated([(r.n, [x.score for x in r.found]) for r in found if r.toxic == 0])
    x = np.array([evidence(r.n, [tuple(s) for s in r.found], model.k) for r in found])
    model.slope, model.offset = _curve(x, np.array([r.toxic for r in found], float))
    return model


def _calibrated(harmless: list[tuple[int, list[float]]]) -> float:
    """The k for which expected numbers are no smaller than those observed: of the r-th strongest segment, r in all texts, from the ERRING share on."""
    over = np.sort([x - np.log(max(n, 1)) for n, found in harmless for x in found])[::-1]
    rank = np.arange(1, len(over) + 1)
    logs = (over + np.log(rank) - np.log(len(harmless)))[int(ERRING * len(harmless)) :]
    # Without segments, half a one is taken to score 0.
    return float(np.exp(min(max([*logs, np.log(0.5) - np.log(1 + sum(n for n, _ in harmless))]), 100.0)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve with a slight pull to zero, by Newton's steps."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 0.1 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-10:
            break
    return max(float(a), 0.0), float(b)


def scan(docs: DataFrame, model: Model, least_expected: float = LEAST_EXPECTED) -> DataFrame:
    """(doc_id, n, passages, score) for each row of ``docs``.

    passages: the segments (start, end, score, expected) whose expected number
    in a harmless text is below ``least_expected``. A null or empty text has
    none, and the score of a text without evidence; a null doc_id stays null;
    repeated rows give equal results; an empty table gives an empty one. Texts
    and passages of any length keep finite scores. Only texts are looked at.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    found = rows.mapInPandas(_scored(docs.sparkSession.sparkContext.broadcast(model)), f"doc_id bigint, {FOUND}")
    told = lambda s: s["score"] - float(np.log(model.k)) - F.log(F.greatest(F.col("n"), F.lit(1)))
    total = F.aggregate("found", F.lit(0.0), lambda a, s: a + F.greatest(F.lit(0.0), told(s)))
    score = 1 / (1 + F.exp(-(F.lit(model.slope) * F.log1p(total) + F.lit(model.offset))))
    kept = F.transform(F.filter("found", lambda s: told(s) > -float(np.log(least_expected))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"), F.exp(-told(s)).alias("expected")))
    return found.select("doc_id", "n", kept.alias("passages"), score.alias("score"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scan(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").cast("bigint").alias("n_passages"))
