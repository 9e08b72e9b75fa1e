"""Windows that occur twice: routing of repeated text to shards, for the two operators that remove it.

A window is ``length`` symbols of one document. Its anchor is the smallest hash
among its ``gram``-symbol substrings, so equal windows have equal anchors, and
neighbouring windows mostly share one: a run. What is shuffled is one row for
each run, about 2 / (length - gram) of a symbol's number. Runs whose anchor
and whole content occur earlier are repeats. Where an anchor occurs with
different contents (at the edges of a repeated passage), the first document of
each content sends its symbols to a shard, where an index settles every window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.frames import id_and_text, travels
from affinity.sources.scratch import materialize

travels(__name__)

#: Symbols hashed together; longer documents are taken in overlapping pieces.
PIECE = 1 << 20
#: Runs of one anchor that meet in one shard; more of them are dealt over several, whose firsts are merged.
MOST_OF_ANCHOR = 2_000
#: Symbols that a task indexes together.
SHARD = 1 << 20
# An odd multiplier and mixing constants of 64 bits.
BASE = 0x9E3779B97F4A7C15
MIX_A = 0xBF58476D1CE4E5B9
MIX_B = 0x94D049BB133111EB
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    """What a symbol is, how long windows and anchors are, and whether a document repeats itself.

    symbols: a text as an array of numbers; within: whether an earlier place of
    the same document counts as earlier.
    """

    symbols: Callable[[str], np.ndarray]
    length: int
    gram: int
    within: bool


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, np.uint64)
    up[0] = 1
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mixed(x: np.ndarray, extra: int = 0) -> np.ndarray:
    x = x + np.uint64(extra)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def _echoes(sums: np.ndarray, grams: np.ndarray, down: np.ndarray, rule: Rule) -> np.ndarray:
    """Windows that equal one less than ``width`` places before them, which may be of the same run: text with a short period.

    All substrings of such a window recur at the same distance, one of each
    ``width`` neighbours among them, so only those are compared with what follows.
    """
    n, width = len(sums) - rule.length, rule.length - rule.gram + 1
    again = np.zeros(n, bool)
    padded = np.r_[grams, np.zeros(width - 1, np.uint64)]
    near = np.lib.stride_tricks.sliding_window_view(padded, width)[::width]
    hits = near[:, 1:] == near[:, :1]
    some = np.flatnonzero(hits.any(axis=0)) + 1
    if len(some):
        whole = _mixed((sums[rule.length :] - sums[: -rule.length]) * down[:n])
    for d in some:
        x = (np.flatnonzero(hits[:, d - 1])[:, None] * width - np.arange(width)).ravel()
        x = x[(x >= 0) & (x < n - d)]
        again[x[whole[x] == whole[x + d]] + d] = True
    return np.flatnonzero(again)


def runs(symbols: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor, content) of each run of one piece of text; the content hash covers all its symbols.

    The fifth array holds the windows that repeat one of their own run, where the rule counts those.
    """
    n, width = len(symbols) - rule.length + 1, rule.length - rule.gram + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    up, down = _powers(PIECE + 2 * rule.length)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(_mixed(symbols.astype(np.uint64), 1) * up[: len(symbols)], out=sums[1:])
    low = _mixed((sums[rule.gram :] - sums[: -rule.gram]) * down[: len(symbols) - rule.gram + 1])
    echoes = _echoes(sums, low, down, rule) if rule.within else np.zeros(0, np.int64)
    # Smallest of each ``width`` neighbours, by doubling.
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    low = low[:n]
    fresh = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    size = np.diff(np.r_[fresh, n])
    # An anchor that repeats within itself would make runs of any length.
    if (size > width).any():
        fresh = np.concatenate([np.arange(s, s + m, width) for s, m in zip(fresh, size)])
        size = np.diff(np.r_[fresh, n])
    end = fresh + size + rule.length - 1
    content = _mixed((sums[end] - sums[fresh]) * down[fresh] + size.astype(np.uint64), 7)
    return fresh, size, low[fresh], content, echoes


def _all_runs(text: str, rule: Rule) -> Iterator[tuple[np.ndarray, ...]]:
    symbols = rule.symbols(text)
    for at in range(0, max(len(symbols) - rule.length + 1, 0), PIECE):
        start, size, anchor, content, echoes = runs(symbols[at : at + PIECE + rule.length - 1], rule)
        yield start + at, size, anchor, content, echoes + at


def pack(pos: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (pos.astype(np.int64) << 8) | size.astype(np.int64)


def _later(doc: np.ndarray, pos: np.ndarray, first: np.ndarray, within: bool) -> np.ndarray:
    """Which rows come after the row ``first`` names for them."""
    return (doc > doc[first]) | ((doc == doc[first]) & (pos > pos[first]) if within else np.zeros(len(doc), bool))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the index of the first row with the same keys."""
    fresh = np.zeros(len(keys[0]), bool)
    if len(fresh):
        fresh[0] = True
        for k in keys:
            fresh[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(fresh)
    return np.repeat(at, np.diff(np.r_[at, len(fresh)]))


def _joined(doc: np.ndarray, version: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching ranges of one document as one."""
    order = np.lexsort((start, version, doc))
    doc, version, start, end = doc[order], version[order], start[order], end[order]
    if not len(doc):
        return doc, version, start, end
    group = _firsts(doc, version)
    # The furthest end so far, kept apart by document.
    shift = group * (1 << 32)
    far = np.maximum.accumulate(end + shift)
    fresh = np.r_[True, (group[1:] != group[:-1]) | (start[1:] + shift[1:] > far[:-1])]
    at = np.flatnonzero(fresh)
    return doc[at], version[at], start[at], far[np.r_[at[1:], len(far)] - 1] - shift[at]


RUNS = "a bigint, c bigint, doc bigint, version bigint, at bigint, done boolean"


def _run_rows(rule: Rule):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, echoed = [], []
            for doc, version, text in zip(batch["doc"], batch["version"], batch["text"]):
                for start, size, anchor, content, echoes in _all_runs(text, rule):
                    n = len(start)
                    parts.append((np.full(n, doc, np.int64), np.full(n, version, np.int64), start, size, anchor, content))
                    if len(echoes):
                        echoed.append((np.full(len(echoes), doc, np.int64), np.full(len(echoes), version, np.int64), echoes))
            if not parts:
                continue
            doc, version, start, size, anchor, content = (np.concatenate(x) for x in zip(*parts))
            # Repeats within the batch end here, so that a group of copies sends one row for each batch.
            order = np.lexsort((start, doc, content, anchor))
            doc, version, start, size, anchor, content = (x[order] for x in (doc, version, start, size, anchor, content))
            late = _later(doc, start, _firsts(anchor, content), rule.within)
            d, v, s, e = doc[late], version[late], start[late], start[late] + size[late] + rule.length - 1
            if echoed:
                ed, ev, es = (np.concatenate(x) for x in zip(*echoed))
                d, v, s, e = (np.r_[x, y] for x, y in ((d, ed), (v, ev), (s, es), (e, es + rule.length)))
            d, v, s, e = _joined(d, v, s, e)
            if len(d):
                spread = _mixed(d.astype(np.uint64) + s.astype(np.uint64)).view(np.int64)
                yield pd.DataFrame({"a": spread, "c": e, "doc": d, "version": v, "at": pack(s, np.zeros(len(s))), "done": True})
            live = ~late
            yield pd.DataFrame({"a": anchor[live].view(np.int64), "c": content[live].view(np.int64), "doc": doc[live], "version": version[live], "at": pack(start[live], size[live]), "done": False})

    return run


MET = "a bigint, part int, parted boolean, doc bigint, version bigint, start int, stop int, open boolean"


def _met(rule: Rule, most: int):
    """Rows sorted by (a, c, doc, at): repeats as ranges, and the runs that an index must settle (open)."""

    def settle(rows: list[np.ndarray], part: int, ongoing: np.ndarray) -> pd.DataFrame:
        """part: how many parts the anchor that goes on (ongoing) has had before."""
        a, c, doc, version, at, done = rows
        begin = _firsts(a)
        nth = np.arange(len(a)) - begin
        parted = ongoing | (np.bincount(begin, minlength=len(a))[begin] > most)
        part = np.where(ongoing, part, 0) + nth // most
        pos, size = at >> 8, at & 0xFF
        stop = np.where(done, c, pos + size + rule.length - 1)
        late = _later(doc, pos, _firsts(a, c, done), rule.within) & ~done
        group = _firsts(a, done)
        other = np.zeros(len(a), bool)
        np.logical_or.at(other, group, c != c[group])
        still = ~done & ~late & (other[group] | parted)
        some = done | late | still
        return pd.DataFrame({"a": a, "part": part, "parted": parted, "doc": doc, "version": version, "start": pos, "stop": stop, "open": still})[some]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] | None = None
        part, last = 0, None
        for batch in batches:
            rows = [batch[k].to_numpy() for k in ("a", "c", "doc", "version", "at", "done")]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            a = held[0]
            if not len(a):
                continue
            # The last anchor may go on in the next batch, unless it has been cut already.
            cut = int(np.searchsorted(a, a[-1], side="left"))
            if cut:
                ready = [x[:cut] for x in held]
                ongoing = ready[0] == last
                yield settle(ready, part, ongoing)
                part, last = 0, None
                held = [x[cut:] for x in held]
            if len(held[0]) > most:
                last = held[0][-1]
                yield settle(held, part, np.ones(len(held[0]), bool))
                part, held = part + len(held[0]) // most + 1, None
        if held is not None and len(held[0]):
            ongoing = held[0] == last
            yield settle(held, part, ongoing)

    return run


PIECES = "a bigint, part int, parted boolean, doc bigint, version bigint, start int, body binary"


def _bodies(slice_of: Callable[[str, np.ndarray, np.ndarray], list[bytes]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            many = batch["a"].str.len().to_numpy()
            if not len(many):
                continue
            out = pd.DataFrame({k: np.concatenate(batch[k].to_list()) for k in ("a", "part", "parted", "start")})
            out["doc"], out["version"] = (np.repeat(batch[k].to_numpy(), many) for k in ("doc", "version"))
            out["body"] = [body for text, start, stop in zip(batch["text"], batch["start"], batch["stop"]) for body in slice_of(text, start, stop)]
            yield out

    return run


FOUND = "doc bigint, version bigint, start int, stop int, mark bigint"
#: Settles one shard: rows of PIECES with whole (a, part) groups to rows of FOUND. Rows with mark 0 are repeats; of parted groups also the windows that are first in their shard, with their hash.
Settle = Callable[[pd.DataFrame], pd.DataFrame]


def _shards(settle: Settle):
    """Collects whole groups up to SHARD symbols; rows come sorted by (a, part)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += int(batch["body"].str.len().sum())
            if size >= SHARD:
                rows = pd.concat(held, ignore_index=True)
                tail = (rows["a"] == rows["a"].iloc[-1]) & (rows["part"] == rows["part"].iloc[-1])
                if not tail.all():
                    yield settle(rows[~tail].reset_index(drop=True))
                    rows = rows[tail].reset_index(drop=True)
                held, size = [rows], int(rows["body"].str.len().sum())
        if held:
            yield settle(pd.concat(held, ignore_index=True))

    return run


def _merged(length: int, within: bool):
    """Rows of one set of window hashes, sorted: of each hash every window after the first is a repeat, found by binary search."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: tuple | None = None
        for batch in batches:
            mark, doc, start = (batch[k].to_numpy() for k in ("mark", "doc", "start"))
            if not len(mark):
                continue
            at = np.searchsorted(mark, mark, side="left")
            d, s = doc[at], start[at]
            if first is not None:
                same = mark == first[0]
                d, s = np.where(same, first[1], d), np.where(same, first[2], s)
            late = (doc > d) | ((doc == d) & (start > s) if within else np.zeros(len(doc), bool))
            first = (mark[-1], d[-1], s[-1])
            out = batch[late]
            yield pd.DataFrame({"doc": out["doc"], "version": out["version"], "start": out["start"], "stop": out["start"] + length, "mark": 0})

    return run


def repeated(docs: DataFrame, rule: Rule, slice_of: Callable, settle: Settle, most: int = MOST_OF_ANCHOR) -> DataFrame:
    """(doc_id, text, spans) for each row of ``docs``: spans holds the ranges of symbols that earlier windows cover.

    Documents come in the order of doc_id, a null one before all. Rows that
    share a doc_id are places of one document, so equal rows do not remove each
    other; they are told apart by a 64-bit hash of the text. A null text is empty. The ranges may overlap and come in any order.
    """
    rows = id_and_text(docs).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("version"), "text")
    sorted_runs = rows.mapInPandas(_run_rows(rule), RUNS).repartition("a").sortWithinPartitions("a", "c", "doc", "at")
    met = materialize(sorted_runs.mapInPandas(_met(rule, most), MET), "met")
    asked = met.where("open").groupBy("doc", "version").agg(F.collect_list(F.struct("a", "part", "parted", "start", "stop")).alias("asked"))
    bodies = rows.join(asked, ["doc", "version"]).select("doc", "version", "text", *[F.col(f"asked.{k}").alias(k) for k in ("a", "part", "parted", "start", "stop")]).mapInPandas(_bodies(slice_of), PIECES)
    # Rows that repeat as a whole send their pieces twice, which changes nothing.
    found = materialize(bodies.repartition("a", "part").sortWithinPartitions("a", "part", "doc", "start").mapInPandas(_shards(settle), FOUND), "settled")
    firsts = found.where("mark <> 0").repartition("mark").sortWithinPartitions("mark", "doc", "start").mapInPandas(_merged(rule.length, rule.within), FOUND)
    ranges = met.where("not open").select("doc", "version", "start", "stop").unionByName(
        found.where("mark = 0").select("doc", "version", "start", "stop")).unionByName(firsts.select("doc", "version", "start", "stop"))
    spans = ranges.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    out = rows.join(spans, ["doc", "version"], "left")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text", "spans")


def covered(n: int, spans: list | None) -> np.ndarray:
    """Which of n symbols the ranges cover."""
    if spans is None or not len(spans):
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["stop"] for s in spans], -1)
    return np.cumsum(edge[:-1]) > 0


def ranges_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edge[::2], edge[1::2]
