"""Column functions on text: normalisation, terms, stable ids and versions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character that separates words, as a regular-expression class in Java's and RE2's common syntax.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
# Words that a query ignores, and what some words stand for.
STOP_WORDS = ["a", "an", "and", "channel", "continue", "in", "me", "only", "play", "show", "the", "tv"]
ALIASES = {
    "hindi": "hi", "hin": "hi", "marathi": "mr", "mar": "mr", "english": "en", "eng": "en", "movie": "movies",
    "film": "movies", "films": "movies", "sport": "sports", "high definition": "hd",
}


def collapse(text: Column) -> Column:
    """Lower case, runs of space as one space, no space at the ends; null stays null."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), f"{SPACE}+", " "), "^ | $", "")


def strip(text: Column) -> Column:
    """text without space at its ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def keyword_text(text: Column) -> Column:
    """collapse with underscores as spaces."""
    return collapse(F.replace(text, F.lit("_"), F.lit(" ")))


def token(text: Column) -> Column:
    """Lower case, everything but a-z, 0-9 and the point as one underscore, none at the ends; "unknown" if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9.]+", "_"), "^_+|_+$", "")
    return F.when(plain == "", "unknown").otherwise(plain)


def stable_id(provider: Column, raw: Column) -> Column:
    return F.concat(provider, F.lit("_"), F.replace(token(raw), F.lit("."), F.lit("_")))


def ordered_distinct(values: Column) -> Column:
    """First occurrences of the values that are neither null nor empty."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[^A-Za-z0-9]+"), lambda x: x != "")


def token_estimate(text: Column) -> Column:
    """Number of words between spaces; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, f"{SPACE}+"), lambda x: x != "")), F.lit(0))


def index_terms(text: Column) -> Column:
    """Terms of the index: words between spaces and underscores, without what is neither letter nor digit inside them."""
    parts = F.split(F.replace(F.lower(text), F.lit("_"), F.lit(" ")), f"{SPACE}+")
    return ordered_distinct(F.transform(parts, lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}]", "")))


def plain_ascii(text: Column) -> Column:
    """ASCII lower case, with a space for every character that is no ASCII letter or digit."""
    return F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]", " ")


def _meant(plain: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, plain), plain)


def alias(text: Column) -> Column:
    """What a word or phrase stands for, in plain form."""
    return _meant(F.trim(plain_ascii(text)))


def query_terms(text: Column) -> Column:
    """Terms of a query or of a searchable value: aliased words without stop words, each once."""
    words = F.transform(F.array_distinct(F.split(plain_ascii(text), " +")), _meant)
    return F.array_distinct(F.filter(words, lambda x: (x != "") & ~x.isin(STOP_WORDS)))


def semver(text: Column) -> Column:
    """(major, minor, patch) of a version of three numbers, which compares part by part; null for anything else."""
    part = lambda i: F.regexp_extract(text, r"^(\d{1,5})\.(\d{1,5})\.(\d{1,5})$", i).try_cast("int")
    return F.when(text.rlike(r"^\d{1,5}\.\d{1,5}\.\d{1,5}$"), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def safe_segment(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]", "_")
