"""SimHash near-duplicates: fingerprints, a binary trie joined with itself, and groups of linked documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.components import smallest_reachable
from affinity.llm.frames import id_and_text, matching, travels
from affinity.sources.scratch import materialize

travels(__name__)

# Fixed values of the contract.
SEED = 42
SHINGLE = 3
BUDGET = 3
BITS = 64
#: A trie starts below a block of bits that must agree: of BUDGET + 1 blocks one has no differing bit.
BLOCK = BITS // (BUDGET + 1)
#: A prefix with more fingerprints is cut again, by one of so many parts of the bits below.
SUB = (BITS - BLOCK) // (BUDGET + 1)
MOST_IN_BUCKET = 1 << 21
#: Node pairs looked at together; bounds the memory of a task.
CHUNK = 1 << 18
#: Hashes counted together.
PIECE = 1 << 16


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """One bit for each bit set in over half the shingle hashes; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        hashes = [h(b" ".join(words), SEED)]
    else:
        hashes = [h(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), PIECE):
        part = np.array(hashes[at : at + PIECE], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = np.array([fingerprint(t) for t in batch["text"]], dtype=np.uint64).view(np.int64)
        yield batch.drop(columns="text").assign(fp=made)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) of each row: the 64 bits as a signed number."""
    rows = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInPandas(_fingerprints, "doc_id bigint, text_key bigint, fp bigint")


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_links(values: np.ndarray, fixed: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (i < j) in sorted distinct ``values`` that differ in up to ``budget`` bits and agree in the first ``fixed``.

    A node of the trie is a range of the sorted values that share a prefix. A
    pair of nodes carries the bits in which their prefixes differ. Going down,
    a pair gives up to four pairs of children, one bit deeper, and it is
    dropped as soon as its bits exceed the budget. A pair of single values is
    settled at once.
    """
    n = len(values)
    if n < 2:
        return
    head = values >> np.uint64(BITS - fixed) if fixed else np.zeros(n, np.uint64)
    first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
    last = np.r_[first[1:], n]
    many = last - first > 1
    stack = [(fixed, *(x.copy() for x in (first[many], last[many], first[many], last[many])), np.zeros(many.sum(), np.int64))]
    while stack:
        depth, a0, a1, b0, b1, bits = stack.pop()
        if len(a0) > CHUNK:
            stack += [(depth, *(x[at : at + CHUNK] for x in (a0, a1, b0, b1, bits))) for at in range(0, len(a0), CHUNK)]
            continue
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = (i != j) & (_ones(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, bits = (x[~single] for x in (a0, a1, b0, b1, bits))
        if not len(a0) or depth == BITS:
            continue
        bit = np.uint64(BITS - 1 - depth)
        am, bm = _middle(values, a0, a1, bit), _middle(values, b0, b1, bit)
        own = a0 == b0
        kids = [
            (a0, am, b0, bm, bits, am > a0), (am, a1, bm, b1, bits, a1 > am),
            (a0, am, bm, b1, bits + 1, np.ones(len(a0), bool)), (am, a1, b0, bm, bits + 1, ~own),
        ]
        parts = []
        for p0, p1, q0, q1, d, fit in kids:
            fit = fit & (p1 > p0) & (q1 > q0) & (d <= budget) & ~((p0 == q0) & (p1 - p0 == 1))
            parts.append([x[fit] for x in (p0, p1, q0, q1, d)])
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where the given bit becomes one within each range; all ranges are halved together."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = ((values[np.minimum(mid, len(values) - 1)] >> bit) & np.uint64(1)) == 1
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _led(values: np.ndarray, turn: int, sub: int) -> np.ndarray:
    """The bits in another order: first the block after ``turn`` bits, then, for ``sub`` >= 0, that part of the rest."""
    u = np.uint64
    if turn:
        values = (values << u(turn)) | (values >> u(BITS - turn))
    if sub <= 0:
        return values
    rest = u((1 << (BITS - BLOCK)) - 1)
    head, tail = values & ~rest, values & rest
    moved = SUB * sub
    return head | (((tail << u(moved)) | (tail >> u(BITS - BLOCK - moved))) & rest)


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A tree for each group of linked places: every link is kept as a connection, pairs within a group are not."""
    root = np.arange(n)
    for i, j in links:
        while True:
            ri, rj = root[i], root[j]
            apart = ri != rj
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(ri, rj)[apart], np.minimum(ri, rj)[apart])
            while (deeper := root[root] != root).any():
                root = np.where(deeper, root[root], root)
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All rows of some buckets; the links of one order of bits are found in one trie."""
    kept: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for key, rows in batch.groupby(["turn", "sub"]):
            kept.setdefault(key, []).append(rows["fp"].to_numpy(np.int64))
    for (turn, sub), parts in kept.items():
        own = np.concatenate(parts)
        led = _led(own.view(np.uint64), int(turn), int(sub))
        order = np.argsort(led)
        own, led = own[order], led[order]
        i, j = _forest(len(led), trie_links(led, BLOCK if sub < 0 else BLOCK + SUB))
        yield pd.DataFrame({"src": own[i], "dst": own[j]})


def links(prints: DataFrame, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(src, dst): connections between distinct fingerprints (fp) that differ in up to BUDGET bits.

    Of BUDGET + 1 blocks of bits at least one agrees in any such pair. So each
    fingerprint enters as many tries, turned so that another block comes first,
    and the trie is entered below that block: pairs of nodes above it with a
    differing bit are pruned by the shuffle. The rest of a prefix with more
    than ``most`` fingerprints is cut into BUDGET + 1 parts in the same way, so
    that no task holds a large group. Found pairs leave the task as a tree for
    each group, 8 bytes for each distinct fingerprint being held.
    """
    turned = prints.select("fp", F.explode(F.array(*[F.lit(b * BLOCK) for b in range(BUDGET + 1)])).alias("turn"))
    turned = turned.withColumn("led", F.expr("shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn)")).withColumn("led", F.when(F.col("turn") == 0, F.col("fp")).otherwise(F.col("led")))
    turned = turned.withColumn("prefix", F.shiftrightunsigned("led", BITS - BLOCK))
    hot = materialize(turned.groupBy("turn", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > most).select("turn", "prefix", F.lit(True).alias("hot")), "hot")
    marked = turned.join(hot, ["turn", "prefix"], "left")
    subs = F.when(F.col("hot"), F.array(*[F.lit(s) for s in range(BUDGET + 1)])).otherwise(F.array(F.lit(-1)))
    dealt = marked.withColumn("sub", F.explode(subs))
    below = F.expr(f"shiftrightunsigned(led, greatest({BITS - BLOCK - SUB} - {SUB} * sub, 0)) & {(1 << SUB) - 1}")
    dealt = dealt.withColumn("below", F.when(F.col("sub") < 0, F.lit(0)).otherwise(below))
    dealt = dealt.select("fp", "turn", "sub", "prefix", "below").repartition("turn", "prefix", "sub", "below").select("fp", "turn", "sub")
    return dealt.mapInPandas(_bucket_links, "src bigint, dst bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp, component_id, component) for each row: the smallest doc_id and the smallest fp reachable over links.

    Texts without words share the fingerprint zero and are linked like any
    other; null texts are empty. A null doc_id is never the smallest, unless a
    group has no other, whose id is then null. Two groups may share a
    component_id (null, or an id that several texts have), never a component.
    Repeated rows stay, in one group. An empty table gives an empty one.
    """
    rows = materialize(fingerprints(docs), "fingerprints")
    # Documents with one fingerprint are one node, so copies never meet as pairs.
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    # Written, so that the last join stands alone and its large partitions can be split.
    reach = materialize(smallest_reachable(materialize(links(nodes.select("fp")), "links"), nodes), "reach")
    return rows.join(reach, "fp").select("doc_id", "text_key", "fp", "component_id", "component")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group one row of the smallest doc_id stays."""
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("x")
    one = near_duplicates(docs).groupBy("component").agg(least).select("x.doc_id", "x.text_key")
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return matching(docs, key, one, "left_semi").withColumn("__key", key).dropDuplicates(["doc_id", "__key"]).drop("__key")
