"""Personal data: patterns of single values, and terms that give such a value away, by what the corpus says about both."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm import decontamination
from affinity.llm.decontamination import words_of
from affinity.llm.frames import id_and_text, travels
from affinity.sources.scratch import materialize

travels(__name__)
travels(decontamination.__name__)

# Fixed values of the contract: the base kinds in order, their patterns and
# digits. An address is found from its @, since nothing before it decides
# whether it holds; a number begins where no digit is before it. Both find the
# same matches as the whole pattern, without trying every place of a long run.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)

#: What the method adds: a term replaced by its shape, or taken out.
ADDED = ["generalised", "removed"]
#: Words on each side of a value that count as its surroundings.
SCOPE = 8
#: Different surroundings of a value in which a term must be met, so that copies of one passage say nothing.
LEAST_CONTEXTS = 2
#: A term discloses a value if it tells this share of the value's information content.
THRESHOLD = 0.9
#: Bits of the filter that leaves most words out of the search for terms; a fuller one only lets more through.
BITS = 1 << 24
#: Characters searched at a time.
CALL = 1 << 22

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
NON_DIGIT = re.compile("[^0-9]+")
HAS_DIGIT = re.compile("[0-9]")
# Shapes stand among the terms; the sign is in no word.
NUMBER, CODE, PLAIN = "#number", "#code", "#word"


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            yield m.span()


def _digits(pattern: re.Pattern, least: int, most: int, holds: Callable[[str], bool]):
    def run(text: str) -> Iterator[tuple[int, int]]:
        for m in pattern.finditer(text):
            digits = NON_DIGIT.sub("", m[0])
            if least <= len(digits) <= most and holds(digits):
                yield m.span()

    return run


FINDERS = [emails, ips, _digits(CARD, *CARD_DIGITS, luhn), _digits(PHONE, *PHONE_DIGITS, bool)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base values, by kind and place."""
    return [(k, a, b) for k, find in enumerate(FINDERS) for a, b in find(text)]


def entity(kind: int, value: str) -> str:
    """One name for all spellings of a value."""
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else value if kind == 1 else NON_DIGIT.sub('', value)}"


def shape(term: str) -> str:
    return NUMBER if term.isascii() and term.isdigit() else CODE if HAS_DIGIT.search(term) else PLAIN


def placed_words(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words that no base value overlaps."""
    out, cover = [], sorted((a, b) for _, a, b in spans)
    at, far = 0, 0
    for m in WORD.finditer(text.translate(LOWER)):
        a, b = m.span()
        while at < len(cover) and cover[at][0] < b:
            far = max(far, cover[at][1])
            at += 1
        if far <= a:
            out.append((a, b, m[0]))
    return out


def contexts(text: str, spans: list[tuple[int, int, int]], words: list[tuple[int, int, str]]) -> Iterator[tuple[str, list[str], int]]:
    """(entity, words around it, a hash of these in order) for each base value."""
    starts = [a for a, _, _ in words]
    for kind, a, b in spans:
        i, j = bisect_left(starts, a), bisect_left(starts, b)
        left, right = [w for *_, w in words[max(0, i - SCOPE) : i]], [w for *_, w in words[j : j + SCOPE]]
        own = blake2b(f"{' '.join(left)}\n{' '.join(right)}".encode(), digest_size=8).digest()
        yield entity(kind, text[a:b]), left + right, int.from_bytes(own, "big", signed=True)


# Rows counted over the corpus: documents with a term (entity null), with an
# entity (term null), with a term near an entity (in one of its contexts), and all (both null).
COUNTS = "entity string, term string, context bigint, n bigint"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        held: Counter[bytes] = Counter()
        shapes: Counter[str] = Counter()
        near: Counter[tuple[str, str, int]] = Counter()
        known: Counter[str] = Counter()
        for text in batch["text"]:
            spans = base_spans(text)
            if spans:
                words = placed_words(text, spans)
                own = {w.encode() for *_, w in words}
                met = set()
                for who, around, context in contexts(text, spans, words):
                    for t in {*around, *map(shape, around)}:
                        near[who, t, context] += (who, t) not in met
                        met.add((who, t))
                known.update({entity(k, text[a:b]) for k, a, b in spans})
            else:
                own = set(words_of(text))
            held.update(own)
            odd = [w for w in own if not w.isalpha()]
            told = {shape(w.decode()) for w in odd} | ({PLAIN} if len(odd) < len(own) else set())
            shapes.update(told)
        rows = [(None, w.decode(), None, n) for w, n in held.items()] + [(None, w, None, n) for w, n in shapes.items()]
        rows += [(who, t, c, n) for (who, t, c), n in near.items()] + [(who, None, None, n) for who, n in known.items()] + [(None, None, None, len(batch))]
        out = pd.DataFrame(rows, columns=["entity", "term", "context", "n"])
        yield out.astype({"context": "Int64", "n": "int64"})


def disclosure(together: Column, term: Column, value: Column, everything: Column) -> Column:
    """The pointwise mutual information of a term and a value over the value's information content, from numbers of documents; 1 if the term never comes without it, null if all documents hold the value."""
    return F.when(everything > value, 1 + F.log(together / term) / F.log(everything / value))


def disclosing_terms(docs: DataFrame, least_contexts: int = LEAST_CONTEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """(term, kind): the terms that disclose a personal value of ``docs`` (with a text column), and what becomes of them.

    A term is generalised to its shape, unless the shape near one of the values
    discloses that value too; then it is removed.
    """
    counts = materialize(docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(_counted, COUNTS), "counts")
    # One number; no row, and no pairs to join it to, for an empty table.
    everything = counts.where("entity IS NULL AND term IS NULL").agg(F.sum("n")).first()[0] or 0
    met = counts.where("context IS NOT NULL").groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
    pairs = materialize(met.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("together")).where(F.col("contexts") >= least_contexts), "pairs")
    known = counts.where("entity IS NOT NULL AND term IS NULL").groupBy("entity").agg(F.sum("n").alias("with_entity"))
    terms = counts.where("entity IS NULL AND term IS NOT NULL").select("term", "n").join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("with_term"))
    told = pairs.join(terms, "term").join(known, "entity").where(disclosure(F.col("together"), F.col("with_term"), F.col("with_entity"), F.lit(everything)) >= threshold).select("entity", "term")
    told = materialize(told, "disclosing")
    kind = F.when(F.col("term").rlike("^[0-9]+$"), NUMBER).when(F.col("term").rlike("[0-9]"), CODE).otherwise(PLAIN)
    words = told.where(~F.col("term").startswith("#")).withColumn("shape", kind)
    shapes = told.where(F.col("term").startswith("#")).select("entity", F.col("term").alias("shape"), F.lit(1).alias("open"))
    return words.join(shapes, ["entity", "shape"], "left").groupBy("term").agg((len(KINDS) + F.max(F.coalesce("open", F.lit(0)))).cast("int").alias("kind"))


def _filter(terms: DataFrame) -> bytes:
    """A bit for the checksum of every term: BITS bits, whatever the number of terms."""
    bit = F.crc32(F.col("term").cast("binary")) % BITS + 1
    rows = terms.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    parts = {r.part: bytes(r.bits) for r in rows}
    size = 4096
    return b"".join(parts.get(i + 1, bytes(size)) for i in range(BITS // (8 * size)))


SPAN = "struct<kind:int,start:int,end:int>"
FOUND = f"doc_id bigint, text_key binary, base array<{SPAN}>, held array<struct<term:string,start:int,end:int>>"


def _searched(packed: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(packed.value, np.uint8)
        some = bits.any()
        for batch in batches:
            texts = batch["text"].to_list()
            bases = [base_spans(t) for t in texts]
            helds: list[list] = [[] for _ in texts]
            at = 0
            while some and at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= CALL):
                    size += len(texts[end])
                    end += 1
                own = [set(words_of(t)) for t in texts[at:end]]
                words = list(set().union(*own))
                place = np.fromiter(map(crc32, words), np.int64, len(words)) % BITS
                maybe = {words[i] for i in np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)}
                for i, held in enumerate(own, at):
                    if not maybe.isdisjoint(held):
                        helds[i] = [(w, a, b) for a, b, w in placed_words(texts[i], bases[i]) if w.encode() in maybe]
                at = end
            out = pd.DataFrame({"doc_id": batch["doc_id"]})
            out["text_key"] = [sha256(t.encode()).digest() if b or h else b"" for t, b, h in zip(texts, bases, helds)]
            out["base"] = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in bases]
            out["held"] = [[{"term": w, "start": a, "end": b} for w, a, b in x] for x in helds]
            yield out

    return run


def _found(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, span) for each row of ``docs``; text_key is empty without a span."""
    packed = docs.sparkSession.sparkContext.broadcast(_filter(terms))
    rows = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = materialize(rows.mapInPandas(_searched(packed), FOUND), "personal")
    some = found.where(F.size("held") > 0)
    each = some.select("text_key", F.explode("held").alias("x")).select("text_key", "x.*").distinct()
    # All spans of one text: as bounded as the text itself.
    more = each.join(terms, "term").groupBy("text_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    none = F.array().cast(f"array<{SPAN}>")
    whole = some.join(more, "text_key", "left").withColumn("span", F.array_sort(F.concat("base", F.coalesce("more", none))))
    out = ["doc_id", "text_key", "base", "span"]
    return whole.select(*out).unionByName(found.where(F.size("held") == 0).withColumn("span", F.col("base")).select(*out))


def scan(docs: DataFrame, least_contexts: int = LEAST_CONTEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, span) for each row of ``docs``: arrays of (kind, start, end) by kind and place, end exclusive.

    base holds the values that the patterns find; span adds, wherever they
    stand outside of base values, the terms that disclose a value: in
    ``least_contexts`` different surroundings of it, and with ``threshold`` of
    its information content. Kinds 0-3 are KINDS, then ADDED. Documents are
    counted by rows, so copies weigh on both sides of a share. A null or empty
    text has no spans; repeated rows give equal results; an empty table gives
    an empty one. Texts are searched whole. Only doc_id and text are read.
    """
    terms = materialize(disclosing_terms(docs, least_contexts, threshold), "terms")
    return _found(docs, terms).select("doc_id", "base", "span")


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS + ADDED])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return scan(docs).select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), as_text(F.col("span")).alias("spans"),
        (F.size("span") - F.size("base")).cast("bigint").alias("n_terms"))


def cleaned_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with values as [KIND], generalised terms as their shape and removed ones gone; overlapping values as the first of them."""
    out, done = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= done:
            name = KINDS[kind] if kind < len(KINDS) else shape(text[start:end].translate(LOWER))[1:]
            out += [text[done:start], "" if kind > len(KINDS) else f"[{name.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else t if s is None else cleaned_text(t, [(x["kind"], x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans)], dtype=object)


def sanitised(docs: DataFrame, least_contexts: int = LEAST_CONTEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with personal values and disclosing terms replaced or taken out; null texts stay null."""
    terms = materialize(disclosing_terms(docs, least_contexts, threshold), "terms")
    found = _found(docs, terms).where(F.size("span") > 0).select(F.col("text_key").alias("__key"), F.col("span").alias("__span")).dropDuplicates(["__key"])
    # As one column, so that names of the input cannot clash.
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("__key")).join(found, "__key", "left")
    text = F.pandas_udf(_cleaned, T.StringType())(F.col("__row.text"), F.col("__span"))
    return rows.select("__row.*", text.alias("__text")).withColumn("text", F.col("__text")).select(*docs.columns)
