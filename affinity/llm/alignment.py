"""Cross-tokenizer alignment: tokens of two tokenizers over the same bytes, coalesced into groups and counted over the corpus."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinity.llm.frames import id_and_text, travels
from affinity.sources.scratch import materialize, scratch_path

travels(__name__)

#: Characters aligned together; one text at least.
SHARD = 1 << 19
#: Linked id pairs expanded together, before those of one document are merged.
PAIRS = 1 << 21
#: Distinct pieces of text whose ids are held, and their characters.
KNOWN = 500_000
KNOWN_CHARS = 1 << 24
#: Pieces that are encoded as one text.
TOGETHER = 1_000
#: Bytes of one row group of the written shards; bounds what a scan holds.
ROW_GROUP = 1 << 24
# A blank after a character that is no blank in either tokenizer: no token and
# no rule of theirs spans the place before it. A piece of blanks only is left
# with the one before it, as the second tokenizer makes nothing of an empty text.
CUT = re.compile(r"(?:(?<=[!-~])|(?<=\w))(?= +[^ ])")
ODD = re.compile(r" (?:(?<![!-~\w] )|\Z)")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """The ids of one tokenizer: their bytes and how they are written in a digest."""

    def __init__(self, held: list[bytes], between: str, after: str):
        self.bytes = held
        self.lengths = np.array([len(x) for x in held], np.int64)
        width = len(str(len(held))) + 1
        self.inner = np.array([f"{i}{between}".encode() for i in range(len(held))], f"S{width}")
        self.last = np.array([f"{i}{after}".encode() for i in range(len(held))], f"S{width}")


class Pieces:
    """Ids of both tokenizers for pieces of text, each starting with a blank; pieces seen before are looked up."""

    def __init__(self, a_definition: str, b_model: bytes):
        self.a = Tokenizer.from_str(a_definition)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        names = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True)))
        self.side_a = Side([bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in names], ",", "|")
        pieces = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.side_b = Side([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces], ",", ";")
        self.sides = self.side_a, self.side_b
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.edge = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.whole = np.zeros(0, bool)

    def _ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)

    def _spelled(self, text: str, made: tuple[list[int], ...]) -> bool:
        return all(b"".join(map(side.bytes.__getitem__, ids)) == text.encode() for side, ids in zip(self.sides, made))

    def _add(self, ids: tuple[np.ndarray, ...], edges: tuple[np.ndarray, ...], whole: list[bool]) -> None:
        for side in range(2):
            self.ids[side] = np.r_[self.ids[side], ids[side]]
            self.edge[side] = np.r_[self.edge[side], self.edge[side][-1] + edges[side]]
        self.whole = np.r_[self.whole, np.array(whole, bool)]

    def learn(self, pieces: list[str]) -> None:
        """Encodes the pieces not seen before: as one text those that may be cut after, the others one by one."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.number]
        joined, single = [], []
        for p in new:
            (joined if "!" <= p[-1] <= "~" or p[-1].isalnum() else single).append(p)
        parts = [joined[at : at + TOGETHER] for at in range(0, len(joined), TOGETHER)]
        texts = ["".join(p) for p in parts]
        known: list[str] = []
        for part, text, *made in zip(parts, texts, *self._ids(texts)):
            if not self._spelled(text, made):
                single += part
                continue
            ids = tuple(np.array(x, np.int32) for x in made)
            stop = np.cumsum(np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)))
            self._add(ids, tuple(np.searchsorted(np.cumsum(side.lengths[i]), stop) + 1 for side, i in zip(self.sides, ids)), [True] * len(part))
            known += part
        made = self._ids(single)
        self._add(
            tuple(np.fromiter(chain.from_iterable(x), np.int32) for x in made), tuple(np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in made),
            [self._spelled(p, both) for p, *both in zip(single, *made)])
        known += single
        self.number.update(zip(known, range(len(self.number), len(self.number) + len(known))))
        self.chars += sum(map(len, known))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both tokenizers, the ids of blank + text one after the other and their number in each text; 0 where the bytes differ."""
        cut = [[" " + p for p in t.split(" ")] if t and not ODD.search(t) else CUT.split(" " + t) if t else [] for t in texts]
        if len(self.number) > KNOWN or self.chars > KNOWN_CHARS:
            self.forget()
        pieces = list(chain.from_iterable(cut))
        self.learn(pieces)
        place = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        doc = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        held = np.bincount(doc[~self.whole[place]], minlength=len(texts))[doc] == 0
        place, doc = place[held], doc[held]
        out = []
        for ids, edge in zip(self.ids, self.edge):
            size = edge[place + 1] - edge[place]
            total = np.cumsum(size)
            at = np.arange(total[-1] if len(total) else 0) + np.repeat(edge[place] - (total - size), size)
            out.append((ids[at], np.bincount(doc, weights=size, minlength=len(texts)).astype(np.int64)))
        return out


@lru_cache(maxsize=1)
def pieces_of(a_definition: str, b_model: bytes) -> Pieces:
    return Pieces(a_definition, b_model)


def coalesced(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B interval: all sorted by start, a group ends where a start reaches the furthest end so far."""
    start, end = np.r_[start_a, start_b], np.r_[end_a, end_b]
    order = np.lexsort((end, start))
    start, end = start[order], end[order]
    far = np.maximum.accumulate(end)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.r_[False, start[1:] >= far[:-1]]) if len(order) else 0
    return group[: len(start_a)], group[len(start_a) :]


def _distinct(group: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each group's different ids and how often they occur in it."""
    key, many = np.unique(group * width + ids, return_counts=True)
    return key // width, key % width, many


def _merged(doc: np.ndarray, pair: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal pairs of one document as one, with their occurrences summed; sorted."""
    order = np.lexsort((pair, doc))
    doc, pair, many = doc[order], pair[order], many[order]
    at = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]) if len(doc) else np.zeros(0, np.int64)
    return doc[at], pair[at], np.add.reduceat(many, at) if len(at) else many


def linked_pairs(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray, doc_of: np.ndarray, width_a: int, width_b: int) -> tuple[np.ndarray, ...]:
    """(doc, pair, links): the different id pairs that share a group of a document, pair being a * width_b + b, and how many occurrences share one.

    Groups are expanded by their different ids, PAIRS pairs at a time, so a
    group of many equal tokens makes one row.
    """
    ga, a, na = _distinct(group_a, ids_a, width_a)
    gb, b, nb = _distinct(group_b, ids_b, width_b)
    low = np.searchsorted(gb, ga)
    size = np.searchsorted(gb, ga, side="right") - low
    total = np.cumsum(size)
    parts, at = [], 0
    while at < len(ga):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        s = size[at:end]
        left = np.repeat(np.arange(at, end), s)
        right = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s) + low[left]
        parts.append(_merged(doc_of[ga[left]], a[left] * width_b + b[right], na[left] * nb[right]))
        at = end
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return parts[0] if len(parts) == 1 else _merged(*(np.concatenate(x) for x in zip(*parts)))


def _lists(size: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(values, kind))


def aligned(own: Pieces, texts: list[str]) -> dict[str, np.ndarray | list]:
    """Counts, digest and linked pairs of each text, in order; doc tells whose a pair is."""
    (ids_a, n_a), (ids_b, n_b) = own.encode(texts)
    a, b = own.side_a, own.side_b
    end_a, end_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    # Texts lie one after the other; both sides cover the same bytes of each.
    group_a, group_b = coalesced(end_a - a.lengths[ids_a], end_a, end_b - b.lengths[ids_b], end_b)
    many = int(group_a[-1]) + 1 if len(group_a) else 0
    doc_of = np.zeros(many, np.int64)
    doc_of[group_a] = np.repeat(np.arange(len(texts)), n_a)
    links = np.bincount(group_a, minlength=many) * np.bincount(group_b, minlength=many)
    n_groups = np.bincount(doc_of, minlength=len(texts))
    n_links = np.diff(np.r_[0, np.cumsum(links)][np.r_[0, np.cumsum(n_groups)]])
    doc, pair, held = linked_pairs(group_a, ids_a.astype(np.int64), group_b, ids_b.astype(np.int64), doc_of, len(a.bytes), len(b.bytes))
    # Written as fixed-width pieces of bytes, whose filling is taken out again.
    last_a, last_b = (np.r_[g[1:] != g[:-1], True] if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
    written = [np.where(last, side.last[ids], side.inner[ids]) for side, ids, last in ((a, ids_a, last_a), (b, ids_b, last_b))]
    width = max(w.dtype.itemsize for w in written)
    tokens = np.concatenate([w.astype(f"S{width}") for w in written])[np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")].tobytes()
    edge = np.r_[0, np.cumsum(n_a + n_b)] * width
    digests = [sha256(tokens[x:y].translate(None, b"\0")[:-1]).hexdigest() if y > x else "" for x, y in zip(edge.tolist(), edge[1:].tolist())]
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "digest": digests, "doc": doc, "pair": pair, "held": held}


SHARDS = "doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digest array<string>, " \
    "size array<int>, place array<int>, links array<bigint>, pair array<bigint>, docs array<bigint>"


def _shard_rows(a_definition: Broadcast, b_model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        own = pieces_of(a_definition.value, b_model.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= SHARD):
                    size += len(texts[end])
                    end += 1
                made = aligned(own, texts[at:end])
                n = end - at
                pair, place, docs = np.unique(made["pair"], return_inverse=True, return_counts=True)
                one = lambda values, kind=pa.int64(): _lists(np.array([len(values)]), values, kind)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([ids[at:end]])),
                    *[one(made[k]) for k in ("n_a", "n_b", "n_groups", "n_links")], one(made["digest"], pa.string()),
                    one(np.bincount(made["doc"], minlength=n).astype(np.int32), pa.int32()), one(place.astype(np.int32), pa.int32()), one(made["held"]), one(pair), one(docs)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "digest", "size", "place", "links", "pair", "docs"])
                at = end

    return run


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, np.cumsum(size)]])


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with ``told``, twice the count of each of their pairs, plus one where that is the best of its A id."""
    for batch in batches:
        cols = {k: batch.column(k) for k in batch.schema.names}
        for i in range(batch.num_rows):
            row = {k: c.slice(i, 1).flatten() for k, c in cols.items()}
            number = lambda k: row[k].to_numpy(zero_copy_only=False).astype(np.int64)
            links, size, told = number("links"), number("size"), number("told")[number("place")]
            yield pa.RecordBatch.from_arrays([
                *[row[k] for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], pa.array(_sums(links * (told & 1), size)), pa.array(_sums(links * (told >> 1), size)), row["digest"]],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def shards(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of SHARDS with a key each: some documents with their counts and, numbered within the shard, their linked pairs. Written once, read twice."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    # Two files of fixed size; executors need no copy of them.
    a, b = send(Path(a_path).read_text(encoding="utf-8")), send(Path(b_path).read_bytes())
    rows = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_shard_rows(a, b), SHARDS)
    path = scratch_path(spark, "aligned")
    rows.withColumn("shard", F.monotonically_increasing_id()).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.parquet(path)


def pair_counts(parts: DataFrame, width_b: int) -> DataFrame:
    """(pair, told): of each linked id pair twice the number of documents that hold it, plus one if no other pair of its A id has more."""
    held = parts.select(F.explode(F.arrays_zip("pair", "docs")).alias("x")).groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.docs").alias("n"))
    # An A id has at most as many pairs as B has ids.
    best = F.max("n").over(Window.partitionBy(F.floor(F.col("pair") / width_b)))
    return held.select("pair", (2 * F.col("n") + (F.col("n") == best).cast("bigint")).alias("told"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of RESULT for each row of ``docs``: how tokenizer file A and model file B cut blank + text, and how usual their links are.

    Tokens become byte ranges; ranges of both sides are coalesced into groups,
    which end where tokens of both end. Tokens of a group are linked, each of A
    with each of B; the count of an id pair is the number of rows of ``docs``
    that hold it linked, so repeated rows count as often as they occur. A null
    or empty text, and one whose tokens' bytes are not the text's, has no
    tokens and zeros. An empty table gives an empty result. Only doc_id, which
    may be null or repeated, and text are read.
    """
    width_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    parts = shards(docs, a_path, b_path)
    counts = materialize(pair_counts(parts, width_b), "pairs")
    asked = parts.select("shard", F.posexplode("pair").alias("at", "pair"))
    # Pairs of one shard, as bounded as its text.
    told = asked.join(counts, "pair").groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("at", "told"))).getField("told").alias("told"))
    return parts.drop("pair", "docs").join(told, "shard", "left").drop("shard").mapInArrow(_results, RESULT)
