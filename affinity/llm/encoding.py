"""BPE encoding and decoding of whole texts; long ones by a tree of halves."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinity.llm.frames import id_and_text, travels

travels(__name__)

#: Characters in a leaf of the tree; a text of at most so many is one leaf.
LEAF = 1 << 16
#: First width of a window on each side of a join; it doubles until both sides agree.
WIDTH = 128
#: What the cut of a window can change: a contraction, or a special token's characters.
MARGIN = 32
#: Distinct words whose ids are held, plus those of one call. Words are cut at
#: blanks and line ends, which no token and no normalisation spans.
WORDS = 400_000
#: Characters encoded in one call; bounds the memory of a task.
CALL = 1 << 20


@lru_cache(maxsize=1)
def _composes() -> frozenset[str]:
    """Characters that can join the one before them under NFC."""
    second = {0x1161 + i for i in range(21)} | {0x11A8 + i for i in range(27)}
    for code in range(0xC0, 0x30000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    return frozenset(map(chr, second))


def _stable(char: str) -> bool:
    """Whether a text may be cut before this character without changing how either part is normalised."""
    return char < "̀" or (unicodedata.combining(char) == 0 and char not in _composes())


class Encoder:
    """A tokenizer whose words end in a mark, with exact joins of parts."""

    def __init__(self, definition: str):
        self.tok = Tokenizer.from_str(definition)
        self.tok.no_truncation()
        self.tok.no_padding()
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        special = set(self.tok.get_added_tokens_decoder())
        self.words: dict[str, list[int]] = {}
        self.token = [self.tok.id_to_token(i) or "" for i in range(size)]
        self.lowers = self.tok.encode("A", add_special_tokens=False).ids == self.tok.encode("a", add_special_tokens=False).ids
        # Tokens after which a word begins.
        self.ends = np.array([i in special or bool(suffix) and self.token[i].endswith(suffix) for i in range(size)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Short texts from the ids of their words, each distinct word being encoded once; long ones by the tree."""
        short = {i: self._cut(t) for i, t in enumerate(texts) if len(t) <= LEAF}
        if len(self.words) > WORDS:
            self.words.clear()
        self._learn(list({w for words in short.values() for w in words if w not in self.words}))
        get = self.words.__getitem__
        return [list(chain.from_iterable(map(get, short[i]))) if i in short else self.tree(t)[:, 0].tolist() for i, t in enumerate(texts)]

    def _cut(self, text: str) -> list[str]:
        """The words of a text; in lower case where that alone is what the tokenizer makes of them."""
        text = text.replace("\n", " ")
        return (text.lower() if self.lowers and text.isascii() and "<" not in text else text).split(" ")

    def _learn(self, words: list[str]) -> None:
        """The ids of new words, as one text; places tell whose they are."""
        if not words:
            return
        made = self.tok.encode(" ".join(words), add_special_tokens=False)
        begin = np.cumsum([0, *(len(w) + 1 for w in words)])
        of = np.searchsorted(begin, np.fromiter((a for a, _ in made.offsets), np.int64, len(made.ids)), side="right") - 1
        cut = np.searchsorted(of, np.arange(len(words) + 1)).tolist()
        ids = made.ids
        self.words.update((w, ids[a:b]) for w, a, b in zip(words, cut, cut[1:]))

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.tok.decoder is not None:
            return self.tok.decode_batch(ids, skip_special_tokens=False)
        # Without a decoder the library puts a blank between tokens.
        get = self.token.__getitem__
        return [" ".join(map(get, x)) for x in ids]

    def part(self, text: str, a: int, b: int) -> np.ndarray:
        """Rows (id, start, end) of text[a:b] encoded by itself."""
        e = self.tok.encode(text[a:b], add_special_tokens=False)
        rows = np.empty((len(e.ids), 3), np.int64)
        rows[:, 0] = e.ids
        rows[:, 1:] = np.array(e.offsets, np.int64).reshape(-1, 2) + a
        return rows

    def leaves(self, text: str, a: int, b: int, leaf: int) -> list[np.ndarray]:
        cuts = [a]
        while b - cuts[-1] > leaf:
            cuts.append(cuts[-1] + leaf)
        cuts.append(b)
        made = self.tok.encode_batch([text[x:y] for x, y in zip(cuts, cuts[1:])], add_special_tokens=False)
        out = []
        for x, e in zip(cuts, made):
            rows = np.empty((len(e.ids), 3), np.int64)
            rows[:, 0] = e.ids
            rows[:, 1:] = np.array(e.offsets, np.int64).reshape(-1, 2) + x
            out.append(rows)
        return out

    def tree(self, text: str, leaf: int | None = None) -> np.ndarray:
        """The encoding of a whole text: its leaves in parallel, then neighbours joined until one is left."""
        leaf = leaf or LEAF
        parts = self.leaves(text, 0, len(text), leaf)
        cuts = [*range(0, len(text), leaf), len(text)] if len(text) else [0, 0]
        while len(parts) > 1:
            joined, held = [], [0]
            for k in range(0, len(parts), 2):
                if k + 1 < len(parts):
                    joined.append(self.join(text, parts[k], parts[k + 1], cuts[k], cuts[k + 1], cuts[k + 2]))
                else:
                    joined.append(parts[k])
                held.append(cuts[min(k + 2, len(cuts) - 1)])
            parts, cuts = joined, held
        return parts[0]

    def starts(self, text: str, rows: np.ndarray) -> np.ndarray:
        """Which rows begin a word at a place where the text may be cut."""
        if not len(rows):
            return np.zeros(0, bool)
        first = np.r_[True, self.ends[rows[:-1, 0]] & (rows[:-1, 2] <= rows[1:, 1])]
        at = np.flatnonzero(first)
        first[at] = [_stable(text[i]) for i in rows[at, 1]]
        return first

    def join(self, text: str, left: np.ndarray, right: np.ndarray, lo: int, cut: int, hi: int) -> np.ndarray:
        """The encoding of text[lo:hi] from those of its halves.

        A window around the cut is encoded anew. It begins at a word of the
        left half that the cut cannot reach, and counts as far as a word that
        begins both in it and in the right half. Up to the first of them the
        left half holds, from the second on the right one. Where the window
        and a half do not agree, it grows, at last to the whole text.
        """
        width = WIDTH
        while True:
            lo_at, hi_at = cut - width - MARGIN, cut + width + MARGIN
            if lo_at <= lo and hi_at >= hi:
                return self.part(text, lo, hi)
            near = left[left[:, 1] >= max(lo, lo_at - width)]
            begin = near[self.starts(text, near) & (near[:, 1] <= cut - MARGIN)] if lo_at > lo else near[:0]
            # The first row here may be inside a word, as its predecessor isn't seen.
            if len(begin) and len(near) and begin[0, 1] == near[0, 1]:
                begin = begin[1:]
            a = int(begin[0, 1]) if len(begin) else lo
            b = min(hi, hi_at)
            window = self.part(text, a, b)
            beside = left[left[:, 1] >= a]
            sure = beside[beside[:, 2] <= cut - MARGIN]
            # The last word before the margin may still run over it.
            while len(sure) and not self.ends[sure[-1, 0]]:
                sure = sure[:-1]
            agreed = len(begin) == 0 or len(sure) > 0 and np.array_equal(window[: len(sure)], sure)
            if b == hi and agreed:
                return np.concatenate([left[left[:, 1] < a], window])
            words = window[self.starts(text, window), 1]
            words = words[(words > cut) & (words <= b - MARGIN)]
            head = right[right[:, 1] <= b]
            meet = np.intersect1d(words, head[self.starts(text, head) & (head[:, 1] > cut), 1])
            if agreed and len(meet):
                q = int(meet[0])
                own, other = window[(window[:, 1] >= q) & (window[:, 2] <= b - MARGIN)], right[(right[:, 1] >= q) & (right[:, 2] <= b - MARGIN)]
                n = min(len(own), len(other))
                # A word that runs over the margin may differ from its start on.
                whole = [k + 1 for k in range(n) if self.ends[own[k, 0]] or self.ends[other[k, 0]]]
                if whole and np.array_equal(own[: whole[-1]], other[: whole[-1]]):
                    return np.concatenate([left[left[:, 1] < a], window[window[:, 1] < q], right[right[:, 1] >= q]])
            width *= 2


@lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


OUT = "doc_id bigint, ids array<int>, decoded string"


def _encoded(definition: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(definition.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= CALL):
                    size += len(texts[end])
                    end += 1
                made = own.encode(texts[at:end])
                tokens = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), pa.array(np.fromiter(chain.from_iterable(made), np.int32, sum(map(len, made)))))
                yield pa.RecordBatch.from_arrays([ids[at:end], tokens, pa.array(own.decode(made), pa.string())], ["doc_id", "ids", "decoded"])
                at = end

    return run


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for each row of ``docs``: the tokenizer file's ids of the whole text, and what they decode to.

    No special tokens are added, nothing is cut or padded. A null text counts
    as the empty one, which has no ids; repeated rows give equal results; an
    empty table gives an empty one. The tokenizer's definition (a few MB, of
    fixed size) is broadcast, so executors need no file.
    """
    definition = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    rows = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_encoded(definition), OUT)


def digest(docs: DataFrame, path: str) -> DataFrame:
    return encode_decode(docs, path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
