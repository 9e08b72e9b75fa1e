"""Importance resampling: the documents most like a target corpus, drawn by hashed features, noisy scores and an exact cutoff."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import decontamination
from affinity.llm.decontamination import words_of
from affinity.llm.frames import id_and_text, travels
from affinity.sources.scratch import materialize

travels(__name__)
travels(decontamination.__name__)

# Fixed values of the contract.
BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = "2024"
#: Halvings that one count job settles.
AHEAD = 4
#: Characters whose features are held at a time.
CALL = 1 << 22
NO_ID = -(1 << 63)


def feature_buckets(words: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` consecutive words, repeats included."""
    runs = list(words)
    for k in range(2, longest + 1):
        runs += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return np.fromiter(map(crc32, runs), np.int64, len(runs)) % buckets


def _calls(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to CALL characters, one text at least."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CALL):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def _batch_counts(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(feature_buckets(words_of(text), longest, buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts: an array of ``buckets`` numbers, whatever the size of ``docs``."""
    rows = docs.select("text").mapInArrow(_batch_counts(longest, buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares in target and source of each bucket, in thousandths, floors going down."""
    s, t, size = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def _weighed(gain: Broadcast, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = gain.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in _calls(texts):
                words = [words_of(t) for t in texts[a:b]]
                found = [feature_buckets(w, longest, len(value)) for w in words]
                edge = np.cumsum([0, *map(len, found)])
                sums = np.r_[0, np.cumsum(value[np.concatenate(found)])][edge]
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array([len(w) for w in words], pa.int64()), pa.array(np.diff(edge)), pa.array(np.diff(sums))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of (seed, id); a null id counts as an empty one."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _halved(rows: DataFrame, place: Column, need: int) -> tuple[int, int, int]:
    """(v, below, at): the smallest v with ``need`` rows or more at places up to v, the rows below it, and those at it.

    Each job counts the rows up to the midpoints of the next AHEAD halvings,
    whichever way they go, over the written column of places.
    """
    ends = rows.agg(F.min(place).alias("low"), F.max(place).alias("high")).first()
    low, high = int(ends.low), int(ends.high)
    while low < high:
        marks: list[int] = []
        ranges = [(low, high)]
        for _ in range(AHEAD):
            ranges = [half for a, b in ranges if a < b for half in ((a, (a + b) // 2), ((a + b) // 2 + 1, b))]
            marks += [b for _, b in ranges[::2]]
        marks = sorted(set(marks))
        counted = rows.agg(*[F.count(F.when(place <= m, 1)) for m in marks]).first()
        for m, n in zip(marks, counted):
            if n >= need:
                high = m
                break
            low = m + 1
    told = rows.agg(F.count(F.when(place < low, 1)), F.count(F.when(place == low, 1))).first()
    return low, told[0], told[1]


def first_in_order(rows: DataFrame, order: list[Column], n: int) -> Column:
    """The condition that the ``n`` first rows in the order of whole-number columns meet, null numbers first.

    Exactly n rows meet it if no two rows agree in all of ``order``. Nothing is
    sorted: the cutoff of each column is found by counting, and the next column
    only parts the rows that tie there.
    """
    if n <= 0:
        return F.lit(False)
    chosen, tied = F.lit(False), F.lit(True)
    for c in order:
        place = F.coalesce(c.cast("bigint"), F.lit(NO_ID))
        value, below, at = _halved(rows.where(tied), place, n)
        chosen, tied, n = chosen | (tied & (place < value)), tied & (place == value), n - below
        if at <= n:
            break
    return chosen | tied


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their places 1, 2, 3... in the given order, from ranges of it: each is sorted and numbered apart and starts after the ranges before it."""
    at = f"__{name}"
    # The upper bits of this number are the range's, the lower 33 the row's place in it.
    dealt = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(at, 33)
    sizes = [(r.part, r.n) for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()]
    before = np.cumsum([0, *[n for _, n in sizes]])
    # One row for each range, of which there are as many as shuffle partitions.
    starts = rows.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], "__part int, __before bigint")
    own = dealt.join(F.broadcast(starts), part.cast("int") == F.col("__part"))
    return own.withColumn(name, F.col("__before") + F.col(at).bitwiseAND((1 << 33) - 1) + 1).drop("__part", "__before", at)


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row of ``docs``: how much its features favour the texts of ``target``, and its place among the drawn.

    Weights are sums of an array's gains over hashed features; with Gumbel
    noise on top, the highest scores are a draw without replacement in
    proportion to the weights. Of the rows with ``least_words`` words, the
    ``share`` with the highest scores is drawn, ties going to the smaller
    doc_id (null before all), then to fewer features; rows that are equal in
    all of that take their ranks in any order. The rest has rank null. A null
    or empty text has no features and weight 0. Empty tables give an empty
    result, or gains from the other table alone. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)))
    rows = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    weighed = rows.mapInArrow(_weighed(gain, longest), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= least_words
    n = share[0] * scored.where(able).count() // share[1]
    order = [-F.col("score"), F.col("doc_id"), F.col("n_features"), F.col("row")]
    drawn = able & first_in_order(scored.where(able), order, n)
    places = ranked(scored.where(drawn), order)
    return places.unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("bigint"))).drop("row")


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
