"""Exact similarity joins over (id, elem[, x]) member tables.

All similarities here are sums over shared elements, so they come from a join
on the element. Three rules keep that join near the size of its result:

* ids with equal member sets are represented by one of them
  (:func:`copy_groups`), so a large group of copies makes no pairs;
* elements are ordered by frequency and the most frequent ones of each id are
  left out of the join as long as they alone could not reach the threshold, so
  the hottest elements make no candidate pairs; their share is added
  afterwards by equi-joins on (id, element). This is exact: a qualifying
  pair's rarest shared element is never among the left-out ones;
* sizes that cannot reach the threshold are filtered inside the join, and
  where the join meets many more pairs than it has rows, so are sets whose
  bitmaps differ in more places than sets that share enough could.

An element of few ids makes few pairs, so callers with a low threshold keep
such ``light`` elements in the join; if then nothing is left out, the pairs of
the join are the result. The rows are the same for any limit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.sources.scratch import materialize

EPSILON = 1e-9
PAIRS = 1_000_000  # rows of the pair join that are summed up in one task, about
WORDS = 16  # 64-bit words of a set's bitmap
MANY = 16  # pairs met for each row of the join from which on bitmaps are sent along
LIGHT = 200  # ids that may share an element before it can be left out of a join with a low threshold


def copy_groups(members: DataFrame, id_col: str = "id", elem: str = "elem") -> DataFrame:
    """(id, rep, n_copies): ids with the same member set share the smallest id.

    Sets are compared by size and two order-free 64-bit digests, so no set is
    gathered in one task.
    """
    h = F.struct(elem)
    digests = members.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(h)).alias("_h1"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("_h2"))
    groups = digests.groupBy("_n", "_h1", "_h2").agg(F.min(id_col).alias("rep"), F.count(F.lit(1)).alias("n_copies"))
    return digests.join(groups, ["_n", "_h1", "_h2"]).select(id_col, "rep", "n_copies")


def representatives(members: DataFrame, groups: DataFrame, id_col: str = "id") -> DataFrame:
    """The members of each group's representative only."""
    reps = groups.filter(F.col(id_col) == F.col("rep")).select(id_col)
    return members.join(reps, id_col, "left_semi")


def _split_prefix(members: DataFrame, mass: Column, need: Callable[[Column], Column], light: int = 0) -> DataFrame:
    """Tags members with ``total`` (the id's mass), ``_f`` (the element's ids) and ``lead`` (False when left out, which no element of up to ``light`` ids is).

    Elements of a single id can never be shared and are dropped after they
    counted into the total. The others are numbered, as a number takes less
    room than a text on all later ways; it means nothing outside. The cut is
    made on element frequencies: per id one row per frequency is ordered, not
    one per member. If all elements are light, nothing can be left out and no
    cut is looked for. Each step is written, so that its shuffle files are
    dropped before the next; ``members`` is read several times.
    """
    weighed = members.withColumn("_mass", mass)
    frequency = materialize(members.groupBy("elem").agg(F.count(F.lit(1)).alias("_f")).filter("_f > 1"), "frequency")
    totals = weighed.groupBy("id").agg(F.sum("_mass").alias("total"))
    numbered = weighed.join(frequency.withColumn("_at", F.monotonically_increasing_id()), "elem").withColumn("elem", F.col("_at")).drop("_at")
    if light and frequency.filter(F.col("_f") > light).isEmpty():
        return numbered.join(totals, "id").withColumn("lead", F.lit(True)).drop("_mass")
    counted = materialize(numbered, "counted")
    histogram = counted.groupBy("id", "_f").agg(F.sum("_mass").alias("_m"))
    hot_first = Window.partitionBy("id").orderBy(F.desc("_f")).rowsBetween(Window.unboundedPreceding, 0)
    sums = histogram.withColumn("_cum", F.sum("_m").over(hot_first)).join(totals, "id")
    reached = F.when(F.col("_cum") >= need(F.col("total")), F.col("_f"))
    cut = sums.groupBy("id").agg(F.max(reached).alias("_cut"), F.max("total").alias("total")).filter("_cut IS NOT NULL")
    return counted.join(materialize(cut, "cut"), "id").withColumn("lead", F.col("_f") <= F.greatest("_cut", F.lit(light))).drop("_cut", "_mass")


def bitmaps(members: DataFrame) -> DataFrame:
    """(id, _w0, _w1, ...): each id's set in bits; an element turns one bit over, so two sets differ in at least as many elements as bits."""
    h = F.xxhash64(F.struct("elem"))
    word, bit = F.pmod(h, F.lit(WORDS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 16), F.lit(64)).cast("int"))
    return members.groupBy("id").agg(*[F.coalesce(F.bit_xor(F.when(word == i, bit)), F.lit(0).cast("bigint")).alias(f"_w{i}") for i in range(WORDS)])


def shared_sums(
    members: DataFrame,
    sums: dict[str, Callable[[Column, Column], Column]],
    need: Callable[[Column], Column],
    mass: Column | None = None,
    pair_filter: Callable[[Column, Column], Column] | None = None,
    light: int = 0,
    totals: bool = True,
    hopeful: Column | None = None,
    least: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(a, b, total_a, total_b, <sums>) for every pair ``a < b`` whose shared mass can reach ``need``.

    ``members`` holds distinct (id, elem) rows with a value ``x``. Elements of
    up to ``light`` ids stay in the join. ``totals`` says whether the ids'
    masses are wanted; ``hopeful`` tells by the sums over the elements of the
    join and the masses whether a pair may still be asked for; ``least`` gives
    by the masses, which must be sizes then, how many elements a pair that is
    asked for shares. Pairs that share fewer may be missing.

    Most pairs share one element only, so summing up before the shuffle would
    save no rows and hold all of them in the tasks of the join. The join's rows
    are streamed to the shuffle as ids and values, dealt in parts of about
    PAIRS rows, and summed up there.
    """
    mass = F.lit(1) if mass is None else mass
    keys = ["a", "b", "total_a", "total_b"] if totals else ["a", "b"]

    def side(df: DataFrame, name: str, extra: list[str]) -> DataFrame:
        return df.select(F.col("id").alias(name), F.col("x").alias(f"x_{name}"), *extra)

    def paired(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, *[fn(F.col("x_a"), F.col("x_b")).alias(n) for n, fn in sums.items()])

    tagged = materialize(_split_prefix(members, mass, need, light), "members")
    leading, rest = tagged.filter("lead"), tagged.filter("NOT lead")
    # An element of f ids makes f (f - 1) / 2 pairs.
    rows, met = leading.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("_f") - 1) / 2), F.lit(0.0))).first()
    parts = max(members.sparkSession.sparkContext.defaultParallelism, int(met // PAIRS) + 1)
    told = least is not None and met > MANY * rows
    marked = leading.join(materialize(bitmaps(members), "bitmaps"), "id") if told else leading
    words = lambda name: [F.col(f"_w{i}").alias(f"_{name}{i}") for i in range(WORDS)] if told else []
    joined = (
        side(marked, "a", ["elem", F.col("total").alias("total_a"), *words("a")])
        .join(side(marked, "b", ["elem", F.col("total").alias("total_b"), *words("b")]), "elem").filter(F.col("a") < F.col("b"))
    )
    if told:
        apart = reduce(add, [F.bit_count(F.col(f"_a{i}").bitwiseXOR(F.col(f"_b{i}"))) for i in range(WORDS)])
        joined = joined.filter(apart <= F.col("total_a") + F.col("total_b") - 2 * least(F.col("total_a"), F.col("total_b")))
    if pair_filter is not None:
        joined = joined.filter(pair_filter(F.col("total_a"), F.col("total_b")))
    dealt = joined.select(*keys, "x_a", "x_b").repartition(parts, "a", "b")
    pairs = dealt.groupBy(*keys).agg(*[F.sum(fn(F.col("x_a"), F.col("x_b"))).alias(n) for n, fn in sums.items()])
    if hopeful is not None:
        pairs = pairs.filter(hopeful)
    if rest.isEmpty():
        return pairs
    pairs = materialize(pairs, "pairs")
    found = pairs.select(*keys)
    # Only the members of ids that stand in a pair are needed.
    ids = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    tagged = materialize(tagged.join(ids, "id", "left_semi"), "found")
    leading, rest = tagged.filter("lead"), tagged.filter("NOT lead")
    # Shared elements left out on a's side, then those left out on b's side only.
    from_a = found.join(side(rest, "a", ["elem"]), "a").join(side(tagged, "b", ["elem"]), ["b", "elem"])
    from_b = found.join(side(rest, "b", ["elem"]), "b").join(side(leading, "a", ["elem"]), ["a", "elem"])
    return pairs.unionByName(paired(from_a)).unionByName(paired(from_b)).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums])


def jaccard_pairs(members: DataFrame, threshold: float, light: int = 0) -> DataFrame:
    """(a, b, n_a, n_b, shared, jaccard) for pairs at or above a threshold > 0."""
    t = F.lit(threshold)
    need = lambda n: F.ceil(t * n - EPSILON)
    # What the join lacks is left out by the set with the lower cut, which leaves out less than its need; the pair needs t / (1 + t) of both sizes.
    left_out = need(F.greatest("total_a", "total_b")) - 1
    pairs = shared_sums(
        members.withColumn("x", F.lit(1)),
        {"shared": lambda x, y: F.lit(1)},
        need=need,
        pair_filter=lambda n, m: (m >= t * n - EPSILON) & (n >= t * m - EPSILON),
        light=light,
        hopeful=F.col("shared") + left_out >= t / (1 + t) * (F.col("total_a") + F.col("total_b")) - EPSILON,
        least=lambda n, m: F.ceil(t / (1 + t) * (n + m) - EPSILON),
    )
    jaccard = F.col("shared") / (F.col("total_a") + F.col("total_b") - F.col("shared"))
    return pairs.select("a", "b", F.col("total_a").alias("n_a"), F.col("total_b").alias("n_b"), "shared", jaccard.alias("jaccard")).filter(
        F.col("jaccard") >= threshold)


def agreeing_pairs(slots: DataFrame, threshold: float) -> DataFrame:
    """(a, b, shared, share): pairs of equally long signatures with enough equal slots."""
    t = F.lit(threshold)
    pairs = shared_sums(
        slots.withColumn("x", F.lit(1)), {"shared": lambda x, y: F.lit(1)}, need=lambda n: F.ceil(t * n - EPSILON),
        least=lambda n, m: F.ceil(t * n - EPSILON))
    return pairs.select("a", "b", "shared", (F.col("shared") / F.col("total_a")).alias("share")).filter(F.col("share") >= threshold)


def cosine_pairs(unit_members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, cosine) for rows of length one with non-negative weights ``x``.

    By Cauchy-Schwarz a row's left-out part of squared length below t^2 cannot
    reach t with any other unit row.
    """
    pairs = shared_sums(
        unit_members, {"cosine": lambda x, y: x * y}, mass=F.col("x") * F.col("x"),
        need=lambda n: F.lit(threshold * threshold * (1 - EPSILON)))
    return pairs.select("a", "b", "cosine").filter(F.col("cosine") >= threshold * (1 - EPSILON))


def co_rated(ratings: DataFrame, id_col: str, elem: str, value: str = "rating", min_shared: int = 2, light: int = LIGHT) -> DataFrame:
    """Sums over the shared elements of each pair of ids with at least ``min_shared``.

    (a, b, n, sx, sy, sxx, syy, sxy). Half-star values are doubled to integers,
    so all sums are exact.
    """
    members = ratings.select(F.col(id_col).alias("id"), F.col(elem).alias("elem"), (F.col(value) * 2).cast("bigint").alias("x"))
    pairs = shared_sums(
        members,
        {"n": lambda x, y: F.lit(1), "sx": lambda x, y: x, "sy": lambda x, y: y,
         "sxx": lambda x, y: x * x, "syy": lambda x, y: y * y, "sxy": lambda x, y: x * y},
        need=lambda n: F.lit(min_shared),
        light=light,
        totals=False,
    )
    return pairs.filter(F.col("n") >= min_shared)


def pearson(pairs: DataFrame) -> DataFrame:
    """(a, b, n, sim) over the shared elements; 0 when one side does not vary."""
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = (n * F.col("sxx") - sx * sx).cast("double") * (n * F.col("syy") - sy * sy).cast("double")
    sim = F.when(spread > 0, (n * F.col("sxy") - sx * sy).cast("double") / F.sqrt(spread)).otherwise(F.lit(0.0))
    return pairs.select("a", "b", "n", sim.alias("sim"))


def overlap_cosine(pairs: DataFrame) -> DataFrame:
    """(a, b, n, sim): cosine over the shared elements only."""
    length = F.col("sxx").cast("double") * F.col("syy").cast("double")
    return pairs.select("a", "b", "n", F.when(length > 0, F.col("sxy").cast("double") / F.sqrt(length)).otherwise(F.lit(0.0)).alias("sim"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """(id, other, sim): each unordered pair in both directions, in one pass."""
    two = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))
    return pairs.select(two.alias("p"), "sim").select("p.id", "p.other", "sim")
