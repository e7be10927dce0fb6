"""Weighted keyword search with constraints over assets, and what builds on it: recommend, resolve, play and resume.

Constraints and playability filter first, scoring follows; both are column expressions, so a search is one scan with a
bounded top-k and no shuffle of assets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ALIASES, STOP_WORDS, alias, plain_ascii, query_terms, strip

BASE, IN_TITLE, ELSEWHERE, CONSTRAINT, DEFAULT, MOST = 0.05, 4.0, 1.5, 3.0, 0.5, 1000.0


def terms_of(text: str) -> list[str]:
    """Terms of a query, sorted, each once."""
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return sorted({ALIASES.get(w, w) for w in plain.split()} - set(STOP_WORDS))


def alias_of(text: str) -> str:
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).strip()
    return ALIASES.get(plain, plain)


def metadata(json_text: Column) -> Column:
    """A JSON object's members as strings; id, title and stream_uri, nulls and empty values are left out; lists of strings are joined by commas."""
    members = F.from_json(json_text, "map<string,string>")
    rendered = F.transform_values(members, lambda k, v: F.when(v.startswith("["), F.coalesce(F.array_join(F.from_json(v, "array<string>"), ","), v)).otherwise(v))
    return F.map_filter(rendered, lambda k, v: ~k.isin("id", "title", "stream_uri") & v.isNotNull() & (v != ""))


def searchable(assets: DataFrame) -> Column:
    """All terms an asset can be found by, each once. Needs title, provider, type, languages, genres and metadata."""
    single = F.array("title", "provider", "type")
    parts = F.concat(single, *[F.coalesce(c, F.array().cast("array<string>")) for c in ("languages", "genres")], F.coalesce(F.map_values("metadata"), F.array().cast("array<string>")))
    return query_terms(F.array_join(parts, " "))


def matches(key: str, expected: str) -> Column:
    """Whether an asset meets one constraint; unknown keys are looked up in the metadata."""
    key, wanted = key.lower(), alias_of(expected)
    found = F.try_element_at("metadata", F.lit(key))
    if key == "language":
        met = F.exists("languages", lambda x: alias(x) == wanted)
    elif key in ("genre", "genres"):
        met = F.exists("genres", lambda x: alias(x) == wanted)
    elif key == "type":
        met = alias(F.col("type")) == wanted
    elif key == "quality":
        met = plain_ascii(found).contains(wanted)
    elif key in ("live", "playable"):
        # without a value of its own the asset's availability counts, whatever was asked for
        met = F.coalesce(alias(found) == wanted, F.try_element_at("metadata", F.lit("availability")).contains(f'"{key}":true'))
    else:
        met = alias(found) == wanted
    return F.coalesce(met, F.lit(False))


def score(assets: DataFrame, text: str, constraints: dict[str, str]) -> DataFrame:
    """Playable assets that meet all constraints, with score and explanation.

    Constraints with an empty value are skipped. An asset without any of the terms keeps the base score. A null title has
    no terms; a null or blank stream isn't playable.
    """
    terms, asked = terms_of(text), {k.lower(): v for k, v in sorted(constraints.items()) if alias_of(v)}
    kept = reduce(lambda df, kv: df.where(matches(*kv)), asked.items(), assets.where(F.coalesce(strip(F.col("stream_uri")), F.lit("")) != ""))
    known = kept.withColumn("_terms", searchable(kept)).withColumn("_title", plain_ascii(F.coalesce("title", F.lit(""))))
    weight = lambda t: F.when(F.array_contains("_terms", t), F.when(F.col("_title").contains(t), IN_TITLE).otherwise(ELSEWHERE)).otherwise(0.0)
    total = F.lit(BASE)
    for t in terms:
        total = total + weight(t)
    total = total + CONSTRAINT * len(asked) + (DEFAULT if not terms and not constraints else 0.0)
    said = [F.when(F.array_contains("_terms", t), f"matched term '{t}'") for t in terms] + [F.lit(f"matched {k}={alias_of(v)}") for k, v in asked.items()]
    if not terms and not constraints:
        said.append(F.lit("default recommendation"))
    explanation = F.array_join(F.array_compact(F.array(*said)) if said else F.array().cast("array<string>"), "; ")
    return known.withColumn("score", F.least(total, F.lit(MOST))).withColumn("explanation", explanation).drop("_terms", "_title")


def search(assets: DataFrame, text: str = "", constraints: dict[str, str] | None = None, limit: int = 20) -> DataFrame:
    """The best hits: score descending, then title in byte order, then id; at least one if there is any."""
    order = [F.desc("score"), F.asc("title"), F.asc("id")]
    best = score(assets, text, constraints or {}).orderBy(*order).limit(max(limit, 1))
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most `limit` rows


def recommend(assets: DataFrame, constraints: dict[str, str] | None = None, limit: int = 20) -> DataFrame:
    return search(assets, "", constraints, limit)


def resolve(assets: DataFrame, item_id: str) -> DataFrame:
    """The playable asset of that id, or no row."""
    return assets.where((F.col("id") == item_id) & (F.coalesce(strip(F.col("stream_uri")), F.lit("")) != "")).limit(1)


def play(assets: DataFrame, query: str = "", item_id: str = "") -> DataFrame:
    return resolve(assets, item_id) if item_id.strip() else search(assets, query, {}, 1)


def resume(assets: DataFrame) -> DataFrame:
    """The first recommended film, or, where there is none, the first recommendation at all."""
    both = search(assets, "", {"genre": "movies"}, 1).withColumn("_turn", F.lit(0)).unionByName(search(assets, "", {}, 1).withColumn("_turn", F.lit(1)))
    return both.orderBy("_turn").limit(1).drop("_turn")


def history(assets: DataFrame) -> DataFrame:
    """No history and no favourites are kept: no rows, with the schema of assets."""
    return assets.limit(0)


def compile_command(filters: list[tuple[str, str, object]]) -> Column:
    """A row condition from (field, operator, value) with eq, neq, lt, lte, gt, gte, range and in; null fields meet none."""
    tests = {
        "eq": lambda c, v: c == v, "neq": lambda c, v: c != v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
        "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "range": lambda c, v: c.between(v[0], v[1]), "in": lambda c, v: c.isin(list(v)),
    }
    unknown = [op for _, op, _ in filters if op not in tests]
    if unknown:
        raise ValueError(f"unknown operators: {unknown}")
    return reduce(lambda a, b: a & b, [tests[op](F.col(field), value) for field, op, value in filters], F.lit(True))


def rank_alternative(catalogue: DataFrame, text: str, constraints: dict[str, str], ignored: frozenset[str]) -> DataFrame:
    """A second scoring: the entry's own score, 0.2 for any word of the text, 0.35 per constraint met, rounded to 3 places.

    An entry that misses a constraint which isn't ignored is left out.
    """
    words = [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split() if len(w) > 1]
    haystack = F.lower(F.concat_ws(" ", "title", "genre", "language"))
    said = reduce(lambda a, b: a | b, [haystack.contains(w) for w in words], F.lit(False))
    asked = {k: v for k, v in constraints.items() if k not in ignored}
    met = reduce(lambda a, b: a & b, [F.lower(F.col(k)) == v.lower() for k, v in asked.items()], F.lit(True))
    mood = F.when((F.col("genre") == "movies") & F.lit(constraints.get("mood") == "funny"), 0.15).otherwise(0.0)
    total = F.col("base") + F.when(said, 0.2).otherwise(0.0) + 0.35 * len(asked) + mood
    return catalogue.where(met).withColumn("score", F.round(total, 3))
