"""Secret scans: patterns of single secrets, and credentials whose parts are weak alone but complete together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.sources.scratch import materialize

# The contract's three base patterns. A run of 24 or more
# characters is the same as a run that is then held to 24; the value of an
# assignment is held to its least length afterwards, as a short match uses up
# its characters.
ASSIGN_NAME = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = ASSIGN_NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# Weak parts of a credential, which mean nothing alone.
PART_ID = r"""(?:client_id|access_id|account|username|user|login|key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
PART_SECRET = "[A-Za-z0-9+/]{32,}"
PART_SECRET_MOST = 64
PART_ENDPOINT = "(?:https?|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9_.:@/-]{4,}"
KINDS = ["assign", "access", "hex", "part_id", "part_secret", "part_endpoint"]
PATTERNS = dict(zip(KINDS, [ASSIGN, ACCESS, HEX, PART_ID, PART_SECRET, PART_ENDPOINT]))
N_BASE = 3
#: Code points between the starts of parts that belong together.
SCOPE = 400

SPANS = "array<struct<start:int,kind:int,end:int>>"


def _holds(kind: str, value: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(value, ASSIGN, 1)) >= ASSIGN_LEAST
    if kind == "part_secret":
        return (F.length(value) <= PART_SECRET_MOST) & value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return F.lit(True)


def found(text: Column, kind: str) -> Column:
    """The matches of one kind that hold, as SPANS: code points, end exclusive.

    Places come from the lengths of what lies between the matches and of the
    matches themselves, summed up from the left.
    """
    pattern = PATTERNS[kind]
    none = F.array().cast(SPANS)
    between = F.transform(F.split(text, pattern), F.length)
    pieces = F.zip_with(between, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    # The last piece has no match after it.
    pieces = F.filter(pieces, lambda p: p["value"].isNotNull())

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + piece["gap"]
        end = begin + F.length(piece["value"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(_holds(kind, piece["value"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that are complete with others in their scope, of (text_key, start, kind, end).

    A secret counts if an identifier (a weak one or an access key) starts
    within ``scope`` of it, an identifier if a secret does, an endpoint if both
    do. The interval join goes over bins as wide as the scope: of each bin and
    role only the first and last start are kept, which decides for every part
    in it and in the bins beside it, so no pairs are made.
    """
    role = F.when(F.col("kind") == 4, "secret").when(F.col("kind") == 5, "endpoint").otherwise("id")
    parts = parts.withColumn("role", role).withColumn("bin", F.floor(F.col("start") / scope))
    ends = parts.where("role <> 'endpoint'").groupBy("text_key", F.col("role").alias("by"), "bin").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    ends = ends.select("text_key", "by", F.explode(F.array(*[F.struct((F.col("bin") + d).alias("bin"), F.lit(d).alias("step")) for d in (-1, 0, 1)])).alias("x"), "first", "last")
    ends = ends.select("text_key", "by", "x.bin", "x.step", "first", "last")
    near = (F.col("step") == 0) | ((F.col("step") == 1) & (F.col("last") >= F.col("start") - scope)) | ((F.col("step") == -1) & (F.col("first") <= F.col("start") + scope))
    met = parts.join(ends, ["text_key", "bin"]).where(near).groupBy("text_key", "start", "kind", "end", "role").agg(
        F.max((F.col("by") == "id").cast("int")).alias("with_id"), F.max((F.col("by") == "secret").cast("int")).alias("with_secret"))
    whole = F.when(F.col("role") == "id", F.col("with_secret") == 1).when(F.col("role") == "secret", F.col("with_id") == 1).otherwise(F.col("with_id") + F.col("with_secret") == 2)
    return met.where(whole & (F.col("kind") >= N_BASE)).select("text_key", "start", "kind", "end")


def scan(docs: DataFrame, keep: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """For each row of ``docs``: the columns ``keep`` (doc_id), base and span, both SPANS sorted by place.

    A null text counts as the empty one and has no spans; repeated rows give
    equal results; equal texts are linked once; an empty table gives an empty
    one. Very long texts are searched whole. Columns named text_key, base or
    span are not kept.
    """
    keep = keep or ["doc_id"]
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*keep, F.sha2(text, 256).alias("text_key"), *[found(text, k).alias(f"_{i}") for i, k in enumerate(KINDS)])
    n = lambda i: F.size(f"_{i}")
    df = df.withColumn("open", (n(4) > 0) & (n(1) + n(3) > 0))
    base = F.array_sort(F.concat(*[F.col(f"_{i}") for i in range(N_BASE)]))
    rows = materialize(df.select(*keep, "text_key", "open", base.alias("base"), F.concat("_1", "_3", "_4", "_5").alias("parts")), "secrets")
    parts = rows.where("open").select("text_key", "parts").distinct().select("text_key", F.explode("parts").alias("x")).select("text_key", "x.*")
    # All spans of one text: as bounded as the text itself.
    more = linked(parts, scope).groupBy("text_key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    some = rows.where("open").join(more, "text_key", "left").withColumn("span", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPANS)))))
    out = [*keep, "base", "span"]
    return some.select(*out).unionByName(rows.where("not open").withColumn("span", F.col("base")).select(*out))


def digest(docs: DataFrame) -> DataFrame:
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return scan(docs).select("doc_id", *[count(i).alias(f"n_{KINDS[i]}") for i in range(N_BASE)], F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("span")).alias("spans"))


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping or touching spans replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        joined = F.when((s["start"] == acc["at"]) & (F.size(acc["out"]) > 0), acc["out"]).when(piece.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(piece)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), joined.alias("out"))

    done = F.aggregate(spans, start, step)
    whole = F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every reported span masked; null texts stay null."""
    # As one column, so that names of the input cannot clash.
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    spans = scan(rows, ["__row"])
    text = F.when(F.col("__row.text").isNotNull(), masked(F.col("__row.text"), F.col("span")))
    return spans.select("__row.*", text.alias("__text")).withColumn("text", F.col("__text")).select(*docs.columns)
