"""Removal of repeated word sequences by suffix automata of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from affinity.llm import repeats
from affinity.llm.frames import travels
from affinity.llm.repeats import MOST_OF_ANCHOR, Rule, covered, repeated

for _module in (__name__, repeats.__name__):
    travels(_module)

# Fixed value of the contract: words of a window.
LENGTH = 13
GRAM = 5


def words_of(text: str) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+: bytes are split at ASCII blanks only."""
    return text.encode("utf-8", "surrogatepass").split()


def _hashes(text: str) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.array([h(w) for w in words_of(text)], np.uint64)


def _slices(text: str, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    words = words_of(text)
    return [b" ".join(words[a:b]) for a, b in zip(start, stop)]


RULE = Rule(_hashes, LENGTH, GRAM, within=False)


class Automaton:
    """A suffix automaton over word sequences that are added one after another."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of q for the sequences that end where p's do with one more word."""
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state(self.size[last] + 1, {}, 0), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
            last = new

    def matched(self, words: list) -> list[int]:
        """Matching statistics: of each word, how many words up to it occur together in what was added."""
        out, state, n = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                n = self.size[state]
            if word in self.next[state]:
                state, n = self.next[state][word], n + 1
            out.append(n)
        return out


def settle(pieces: pd.DataFrame) -> pd.DataFrame:
    """Repeats among the pieces of one shard. Equal windows have one anchor, so each group has an automaton of its own.

    Documents stream past it in their order, and each is added after the last of its pieces was matched.
    """
    out = []
    rows = zip(*(pieces[k].tolist() for k in ("a", "part", "parted", "doc", "version", "start", "body")))
    for _, group in groupby(rows, key=lambda r: r[:2]):
        known = Automaton()
        for doc, own in groupby(sorted(group, key=lambda r: (r[3], r[5])), key=lambda r: r[3]):
            own = [(*r[2:6], r[6].split(b" ")) for r in own]
            for parted, _, version, start, words in own:
                open_from = None
                for end, n in enumerate([*known.matched(words), 0], 1):
                    if n >= LENGTH and open_from is None:
                        open_from = end - LENGTH
                    if n < LENGTH and open_from is not None:
                        out.append((doc, version, start + open_from, start + end - 1, 0))
                        open_from = None
                    if parted and LENGTH <= end <= len(words) and n < LENGTH:
                        mark = xxhash.xxh64_intdigest(b" ".join(words[end - LENGTH : end])) - (1 << 63) or 1
                        out.append((doc, version, start + end - LENGTH, start + end, mark))
            for *_, words in own:
                known.add(words)
    return pd.DataFrame(out, columns=["doc", "version", "start", "stop", "mark"])


def spans(docs: DataFrame, most: int = MOST_OF_ANCHOR) -> DataFrame:
    """(doc_id, text, spans) of each row of ``docs``: word ranges covered by a window that also starts in a document with a smaller id.

    See repeats.repeated for nulls, ties and repeated rows; an empty table gives an empty one.
    """
    return repeated(docs, RULE, _slices, settle, most)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, ranges in zip(batch["text"], batch["spans"]):
            words = words_of(text)
            mask = covered(len(words), ranges).tolist()
            kept = b" ".join(w for w, gone in zip(words, mask) if not gone)
            out.append((len(words), sum(mask), hashlib.sha256(kept).hexdigest()))
        batch["n_words"], batch["n_removed"], batch["kept_sha256"] = zip(*out) if out else ([], [], [])
        yield batch.drop(columns=["text", "spans"])


def digest(docs: DataFrame) -> DataFrame:
    return spans(docs).mapInPandas(_digests, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
