"""Removal of repeated substrings by suffix arrays of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from affinity.llm import repeats, suffixes
from affinity.llm.frames import travels
from affinity.llm.repeats import MOST_OF_ANCHOR, Rule, covered, ranges_of, repeated
from affinity.llm.suffixes import suffix_array

for _module in (__name__, repeats.__name__, suffixes.__name__):
    travels(_module)

# Fixed value of the contract: bytes of a repeated string.
LENGTH = 100
GRAM = 32


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def _slices(text: str, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    own = text.encode("utf-8", "surrogatepass")
    return [own[a:b] for a, b in zip(start, stop)]


RULE = Rule(_bytes, LENGTH, GRAM, within=True)


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """For each place of the order, the symbols (up to ``most``) that its suffix shares with the one before it.

    Kasai's scan: going one place on in the text, the shared prefix shortens by
    one at most. All pieces of the text (``begin``, ``size``) are scanned in step.
    """
    n = len(text)
    shared = np.zeros(n, np.int64)
    h = np.zeros(len(begin), np.int64)
    for t in range(int(size.max()) if len(size) else 0):
        live = np.flatnonzero(size > t)
        p = begin[live] + t
        r = rank[p]
        q = order[r - 1]
        k = np.where(r > 0, np.maximum(h[live] - 1, 0), 0)
        grow = np.flatnonzero(r > 0)
        while len(grow):
            x, y = p[grow] + k[grow], q[grow] + k[grow]
            grow = grow[(k[grow] < most) & (x < n) & (y < n)]
            x, y = p[grow] + k[grow], q[grow] + k[grow]
            grow = grow[text[x] == text[y]]
            k[grow] += 1
        h[live] = k
        shared[r] = k
    return shared


def settle(pieces: pd.DataFrame) -> pd.DataFrame:
    """Repeats among the pieces of one shard: equal windows are neighbours in the suffix array."""
    size = pieces["body"].str.len().to_numpy(np.int64)
    text = np.r_[np.frombuffer(b"".join(pieces["body"]), np.uint8).astype(np.int64) + 1, 0]
    begin = np.cumsum(np.r_[0, size])[:-1]
    order, rank = suffix_array(text, 9)
    shared = common_prefixes(text, order, rank, begin, size, LENGTH)
    piece = np.repeat(np.arange(len(size)), size)
    offset = np.arange(len(piece)) - begin[piece]
    window = offset <= size[piece] - LENGTH
    # Places of the order that hold a window, and the class of equal windows of each.
    held = order[np.r_[window, False][order]]
    kind = np.cumsum(shared < LENGTH)[rank[held]]
    doc, pos = pieces["doc"].to_numpy(np.int64)[piece[held]], pieces["start"].to_numpy(np.int64)[piece[held]] + offset[held]
    by = np.lexsort((pos, doc, kind))
    held, kind, doc, pos = held[by], kind[by], doc[by], pos[by]
    first = np.searchsorted(kind, kind, side="left")
    late = (doc > doc[first]) | ((doc == doc[first]) & (pos > pos[first]))
    mask = np.zeros(len(piece) + 1, bool)
    mask[held[late]] = True
    # Neighbouring windows of one piece as one range.
    a, b = ranges_of(mask[:-1])
    cuts = [(x, y) for x, y in zip(a, b)]
    starts, stops = [], []
    for x, y in cuts:
        while x < y:
            z = min(y, int(begin[piece[x]] + size[piece[x]]))
            starts.append(x)
            stops.append(z)
            x = z
    at = np.array(starts, np.int64)
    of = piece[at] if len(at) else at
    versions, places, docs = (pieces[k].to_numpy(np.int64) for k in ("version", "start", "doc"))
    out = [pd.DataFrame({"doc": docs[of], "version": versions[of], "start": places[of] + at - begin[of], "stop": places[of] + np.array(stops, np.int64) - begin[of] + LENGTH - 1, "mark": 0})]
    parted = pieces["parted"].to_numpy(bool)
    if parted.any():
        rest = held[~late & parted[piece[held]]]
        of = piece[rest]
        marks = [int.from_bytes(hashlib.blake2b(text[p : p + LENGTH].astype(np.uint16).tobytes(), digest_size=8).digest(), "big", signed=True) or 1 for p in rest]
        start = places[of] + rest - begin[of]
        out.append(pd.DataFrame({"doc": docs[of], "version": versions[of], "start": start, "stop": start + LENGTH, "mark": marks}))
    return pd.concat(out, ignore_index=True).astype({"mark": "int64"})


def spans(docs: DataFrame, most: int = MOST_OF_ANCHOR) -> DataFrame:
    """(doc_id, text, spans) of each row of ``docs``: byte ranges covered by a string of LENGTH bytes that starts earlier too.

    See repeats.repeated for nulls, ties and repeated rows; an empty table gives an empty one.
    """
    return repeated(docs, RULE, _slices, settle, most)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, ranges in zip(batch["text"], batch["spans"]):
            own = _bytes(text)
            mask = covered(len(own), ranges)
            out.append((len(own), int(mask.sum()), len(ranges_of(mask)[0]), hashlib.sha256(own[~mask].tobytes()).hexdigest()))
        batch["n_bytes"], batch["n_removed"], batch["n_spans"], batch["kept_sha256"] = zip(*out) if out else ([], [], [], [])
        yield batch.drop(columns=["text", "spans"])


def digest(docs: DataFrame) -> DataFrame:
    return spans(docs).mapInPandas(_digests, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
