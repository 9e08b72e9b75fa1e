"""Benchmark decontamination: an FM-index for each shard of documents, searched for all benchmark phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.frames import matching, travels
from affinity.llm.suffixes import suffix_array

travels(__name__)

# Fixed values of the contract.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
#: Contaminated: so many times the hit words are as many as all words.
SHARE = 20
#: Phrases in one broadcast; further ones go to further passes. 13 numbers each.
MOST_PHRASES = 1 << 18
#: Bytes of text in one index.
SHARD_BYTES = 4 << 20
#: Every so many places of the text are kept with the index.
SAMPLE = 8
#: Occurrences located together.
CHUNK = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Phrases:
    """Distinct windows as rows of word numbers from 2 on (0 fills short ones), and the items that own each."""

    number: dict[bytes, int]
    rows: np.ndarray
    length: np.ndarray
    owner_from: np.ndarray
    owners: np.ndarray
    items: list[str]


def phrase_blocks(items: Iterator[tuple], most: int = MOST_PHRASES) -> Iterator[Phrases]:
    """Bounded blocks of the windows of (item_id, text) rows."""
    held: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - WINDOW + 1, 1) if words else 0):
            held.setdefault(tuple(words[i : i + WINDOW]), set()).add("null" if item is None else str(item))
            if len(held) >= most:
                yield _block(held)
                held = {}
    if held:
        yield _block(held)


def _block(held: dict[tuple[bytes, ...], set[str]]) -> Phrases:
    number = {w: i + 2 for i, w in enumerate(sorted({w for p in held for w in p}))}
    ids = sorted({i for owners in held.values() for i in owners})
    place = {i: k for k, i in enumerate(ids)}
    rows = np.zeros((len(held), WINDOW), np.int32)
    for r, phrase in enumerate(held):
        rows[r, : len(phrase)] = [number[w] for w in phrase]
    owners = [sorted(place[i] for i in o) for o in held.values()]
    return Phrases(number, rows, np.array([len(p) for p in held], np.int64), np.cumsum([0, *map(len, owners)]), np.array([k for o in owners for k in o], np.int64), ids)


class FMIndex:
    """Backward search over a text of symbols >= 1, kept as a wavelet matrix of its Burrows-Wheeler transform."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.r_[text, 0].astype(np.int64)
        self.n, self.bits = len(text), max(1, int(symbols).bit_length())
        order, _ = suffix_array(text, self.bits)
        self.last = text[order - 1]
        self.below = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols + 1))]
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.r_[0, np.cumsum(self.sampled)]
        self.samples = order[self.sampled]
        self.levels, part = [], self.last
        for level in range(self.bits - 1, -1, -1):
            one = (part >> level) & 1
            zeros = np.zeros(self.n + 1, np.int32)
            np.cumsum(1 - one, out=zeros[1:])
            self.levels.append((level, zeros))
            part = np.concatenate([part[one == 0], part[one == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place of the transform."""
        lo, hi = np.zeros_like(at), at
        for level, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            total = zeros[-1]
            lo, hi = np.where(one, total + lo - zeros[lo], zeros[lo]), np.where(one, total + hi - zeros[hi], zeros[hi])
        return hi - lo

    def search(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that start with each row's phrase."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        for back in range(1, rows.shape[1] + 1):
            live = np.flatnonzero((length >= back) & (lo < hi))
            symbol = rows[live, length[live] - back].astype(np.int64)
            lo[live] = self.below[symbol] + self.rank(symbol, lo[live])
            hi[live] = self.below[symbol] + self.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of the given suffixes: steps back to a sampled one are counted."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        while len(away := np.flatnonzero(~self.sampled[rows])):
            symbol = self.last[rows[away]]
            rows[away] = self.below[symbol] + self.rank(symbol, rows[away])
            steps[away] += 1
        return self.samples[self.sample_rank[rows]] + steps


def search_shard(texts: list[str | None], phrases: Phrases) -> list[tuple[int, np.ndarray, list[str]]]:
    """(words, merged hit spans, item ids) of each text of one shard.

    The index holds the runs of benchmark words that are long enough for the
    shortest phrase; no phrase can occur elsewhere.
    """
    get, least = phrases.number.get, int(phrases.length.min())
    counts, runs, first_of, doc_of, text_at, at = [], [], [], [], [], 0
    for doc, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        if len(words) < least:
            continue
        ids = np.array([get(w, 0) for w in words], np.int32)
        edge = np.flatnonzero(np.diff(np.r_[False, ids > 0, False].astype(np.int8)))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= least:
                runs += [ids[a:b], np.ones(1, np.int32)]
                first_of.append(a)
                doc_of.append(doc)
                text_at.append(at)
                at += b - a + 1
    empty = np.zeros((0, 2), np.int64)
    if not runs:
        return [(n, empty, []) for n in counts]
    index = FMIndex(np.concatenate(runs), len(phrases.number) + 1)
    lo, hi = index.search(phrases.rows, phrases.length)
    met = np.flatnonzero(hi > lo)
    edges = np.zeros(at + 1, np.int64)
    text_at, first_of, doc_of = np.array(text_at), np.array(first_of), np.array(doc_of)
    pairs = []
    # Occurrences are located in pieces of bounded size, phrase after phrase.
    ends = np.cumsum(hi[met] - lo[met])
    for begin in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
        nth = np.arange(begin, min(begin + CHUNK, int(ends[-1])))
        which = np.searchsorted(ends, nth, side="right")
        phrase = met[which]
        place = index.locate(hi[phrase] - (ends[which] - nth))
        np.add.at(edges, place, 1)
        np.add.at(edges, place + phrases.length[phrase], -1)
        doc = doc_of[np.searchsorted(text_at, place, side="right") - 1]
        pairs.append(np.unique(doc * len(phrases.length) + phrase))
    items: dict[int, set[int]] = {}
    for pair in np.unique(np.concatenate(pairs)) if pairs else ():
        doc, phrase = divmod(int(pair), len(phrases.length))
        items.setdefault(doc, set()).update(phrases.owners[phrases.owner_from[phrase] : phrases.owner_from[phrase + 1]].tolist())
    hit = np.flatnonzero(np.diff(np.r_[False, np.cumsum(edges[:-1]) > 0, False].astype(np.int8)))
    a, b = hit[::2], hit[1::2]
    run = np.searchsorted(text_at, a, side="right") - 1
    spans = np.stack([a - text_at[run] + first_of[run], b - text_at[run] + first_of[run]], 1)
    of = doc_of[run]
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    return [(n, spans[cut[d] : cut[d + 1]], sorted(phrases.items[i] for i in items.get(d, ()))) for d, n in enumerate(counts)]


def _shards(texts: list[str | None]) -> Iterator[slice]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SHARD_BYTES:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def _searched(texts: list[str | None], phrases: Phrases) -> list[tuple[int, np.ndarray, list[str]]]:
    return [found for part in _shards(texts) for found in search_shard(texts[part], phrases)]


def _searcher(held: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _searched(batch["text"].tolist(), held.value)
            batch["n_words"] = [n for n, _, _ in found]
            batch["spans"] = [[{"start": int(a), "end": int(b)} for a, b in spans] for _, spans, _ in found]
            batch["items"] = [i for _, _, i in found]
            yield batch.drop(columns="text")

    return run


OUT = "doc_id bigint, text_key bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def search(docs: DataFrame, benchmark: DataFrame, most: int = MOST_PHRASES) -> DataFrame:
    """(doc_id, text_key, n_words, spans, items) for each row of ``docs``.

    spans: merged word ranges (end exclusive) inside any occurrence of a
    benchmark window; items: ids of the items with an occurring window, as
    sorted strings. A null text or item has no words and no windows; rows of
    one item_id count as one item, and those without an id as the item "null";
    repeated documents give equal rows; empty tables give no spans. Long texts
    are indexed whole.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    asked = ((r[0], r[1]) for r in benchmark.select("item_id", "text").toLocalIterator())
    blocks = [spark.sparkContext.broadcast(b) for b in phrase_blocks(asked, most)]
    if not blocks:
        blocks = [spark.sparkContext.broadcast(_block({(b"\x00",): set()}))]
    parts = [source.mapInPandas(_searcher(b), OUT) for b in blocks]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    gathered = every.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.count("*").alias("rows"))

    def step(acc: Column, s: Column) -> Column:
        joins = F.size(acc) > 0
        last = F.element_at(acc, -1)
        touched = joins & (s["start"] <= F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(-1)))
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(touched, longer).otherwise(F.concat(acc, F.array(s)))

    none = F.array().cast("array<struct<start:int,end:int>>")
    merged = gathered.withColumn("spans", F.aggregate("all", none, step))
    copies = F.explode(F.sequence(F.lit(1), (F.col("rows") / len(blocks)).cast("int")))
    return merged.withColumn("copy", copies).select("doc_id", "text_key", "n_words", "spans", "items")


def contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    out = search(docs, benchmark).withColumn("n_hit", n_hit)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def cleaned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they were."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    bad = search(docs, benchmark).where(contaminated(F.col("n_words"), n_hit))
    return matching(docs, F.xxhash64("text"), bad, "left_anti")
