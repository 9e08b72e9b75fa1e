"""Text cleaning, tokenising and field extraction."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, word lists and maps that results depend on.
TITLE = r"(?i)Title:\s*(.*)"
RELEASE_DATE = r"(?i)Release Date:\s*(.*)"
LANGUAGE = r"(?i)Language:\s*(.*)"
ENCODING = r"(?i)(Character set encoding|Encoding):\s*(.*)"
AUTHOR = r"by\s+([A-Za-z.\s]+)"
FOUR_DIGITS = r"(\d{4})"
MODERN_YEAR = r"(19\d{2}|20\d{2})"
TITLE_YEAR = r"\((\d{4})\)"
BOILERPLATE = r"(?s)\*\*\* START OF.*?\*\*\*|\*\*\* END OF.*?\*\*\*"
SEARCH_STOP_WORDS = [
    "a", "an", "the", "they", "these", "this", "for", "is", "are", "was", "of", "or", "and",
    "does", "will", "whose",
]
# The default English stop words of pyspark.ml, in its order.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing",
    "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]
SEARCH_PUNCTUATION = "{}[]<>=().,;'\"?!-:"
SEARCH_PLURALS = {"stacks": "stack", "structures": "structure", "applications": "application"}


def strip_boilerplate(text: Column) -> Column:
    return F.regexp_replace(text, BOILERPLATE, "")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^a-z\s]", "")


def tokens(text: Column) -> Column:
    """Lower-cased a-z words; no empty ones."""
    return F.filter(F.split(letters_only(text), r"\s+"), lambda w: w != "")


def field(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


def year(text: Column, pattern: str = FOUR_DIGITS) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def _grams(parts: Column, k: int, sep: str) -> Column:
    """Distinct runs of k neighbours: the array zipped with its own shifts, in linear time."""
    n = F.greatest(F.size(parts) - (k - 1), F.lit(0))
    runs = F.slice(parts, F.lit(1), n)
    for j in range(1, k):
        runs = F.zip_with(runs, F.slice(parts, F.lit(j + 1), n), lambda x, y: F.concat(x, F.lit(sep), y))
    return F.array_distinct(runs)


def char_grams(text: Column, k: int) -> Column:
    """The set of character k-grams, in the order of the text.

    Made in Python, as slices: an array of one string for each character, as
    expressions on arrays make, takes many times as long. Texts of a batch
    share equal grams.
    """
    def run(texts: pd.Series) -> pd.Series:
        share = {}.setdefault
        return pd.Series([None if t is None else [share(g, g) for g in dict.fromkeys([t[i : i + k] for i in range(len(t) - k + 1)])] for t in texts], dtype=object)

    return F.pandas_udf(run, "array<string>")(text)


def word_grams(text: Column, k: int) -> Column:
    """The set of word k-grams, words split at whitespace."""
    return _grams(F.filter(F.split(text, r"\s+"), lambda w: w != ""), k, " ")


def search_words(text: Column) -> Column:
    """Words of a page in order, stop words kept so that positions count them."""
    spaced = F.translate(text, SEARCH_PUNCTUATION, " " * len(SEARCH_PUNCTUATION))
    words = F.filter(F.split(F.lower(spaced), r"\s+"), lambda w: w != "")
    plurals = F.create_map(*[F.lit(x) for pair in SEARCH_PLURALS.items() for x in pair])
    return F.transform(words, lambda w: F.coalesce(F.element_at(plurals, w), w))


def is_search_stop_word(word: Column) -> Column:
    return word.isin(SEARCH_STOP_WORDS)
