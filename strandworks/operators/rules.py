"""An utterance's intent by an ordered list of rules: the first that applies decides."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import collapse


@dataclass(frozen=True)
class Rule:
    """A rule applies if the text is one of `exact` or contains one of `phrases`; `slots` are filled where the text has them."""

    intent: str
    confidence: float
    phrases: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    constraints: tuple[tuple[str, str], ...] = ()
    slots: tuple[str, ...] = ()
    missing: tuple[str, ...] = field(default=())


# The words of each slot in the order in which they are looked for.
SLOTS = {
    "language": (("hindi", "hi"), ("english", "en"), ("marathi", "mr"), ("tamil", "ta"), ("telugu", "te")),
    "quality": (("hd", "hd"), ("1080p", "hd"), ("fhd", "hd"), ("sd", "sd"), ("480p", "sd")),
    "mood": (("funny", "funny"), ("comedy", "funny"), ("calm", "calm"), ("inspiring", "inspiring"), ("educational", "educational"), ("relax", "relaxing"), ("bored", "entertainment")),
    "sort": (("latest", "recent"), ("recent", "recent")),
    "grade": (("class 8", "8"),),
    "query": (("aaj tak", "Aaj Tak"), ("sony max", "Sony Max"), ("pbs kids", "PBS Kids"), ("india cricket live", "India cricket live")),
}
OPENINGS = ("play ", "put on ", "open ")
# The rules in their order; "{play}" and "{business}" are decided by the text.
LADDER = (
    Rule("clarify", 0.62, exact=("play sony", "put on news", "show the match"), missing=("specific_media",)),
    Rule("favorite", 0.87, ("add this to favorites", "favorite this channel", "save this for later"), constraints=(("target", "current"),)),
    Rule("resume", 0.91, ("continue", "resume"), constraints=(("continue_watching", "true"),)),
    Rule("browse", 0.9, ("what's live", "show live channels", "browse live tv"), constraints=(("live", "true"),)),
    Rule("play", 0.94, tuple(w for w, _ in SLOTS["query"]), constraints=(("live", "true"),), slots=("query",)),
    Rule("play", 0.89, ("cricket", "india match"), constraints=(("genre", "sports"), ("live", "true"), ("subgenre", "cricket")), slots=("quality",)),
    Rule("search", 0.86, ("sports",), constraints=(("genre", "sports"),), slots=("quality",)),
    Rule("recommend", 0.82, ("violent", "violence"), constraints=(("avoid", "violence"), ("parental_control", "true"))),
    Rule("recommend", 0.88, ("kid", "cartoon", "5 year old"), constraints=(("age_safe", "true"), ("audience", "kids"), ("genre", "kids"))),
    Rule("{play}", 0.86, ("movie", "film"), constraints=(("genre", "movies"),), slots=("language", "quality", "sort")),
    Rule("search", 0.92, ("news",), constraints=(("genre", "{business}"), ("live", "true")), slots=("language", "quality")),
    Rule("recommend", 0.84, ("devotional", "religious", "bhajan"), constraints=(("genre", "religious"),), slots=("language",)),
    Rule("recommend", 0.84, ("education", "class 8"), constraints=(("genre", "education"),), slots=("grade",)),
    Rule("search", 0.76, ("free",), constraints=(("subscription", "free"),)),
    Rule("recommend", 0.84, tuple(w for w, _ in SLOTS["mood"]), slots=("mood",)),
)
FALLBACK = Rule("recommend", 0.58)
# the service's variant knows two more phrases and asks back when nothing applies
SERVICE_PHRASES = {"resume": ("yesterday",), "browse": ("what is live",)}
SERVICE_FALLBACK = Rule("clarify", 0.58, missing=("query",))


def slot(text: Column, name: str) -> Column:
    return reduce(lambda chain, kv: chain.when(text.contains(kv[0]), kv[1]), SLOTS[name], F)


def _applies(rule: Rule, text: Column) -> Column:
    said = reduce(lambda a, b: a | b, [text.contains(p) for p in rule.phrases] + [text == e for e in rule.exact], F.lit(False))
    if "query" in rule.slots:
        said = said & reduce(lambda a, b: a | b, [text.startswith(o) for o in OPENINGS])
    return said


def _result(rule: Rule, text: Column) -> Column:
    intent = F.when(text.contains("play"), "play").otherwise("search") if rule.intent == "{play}" else F.lit(rule.intent)
    value = lambda v: F.when(text.contains("business"), "business_news").otherwise("news") if v == "{business}" else F.lit(v)
    pairs = [F.struct(F.lit(k).alias("key"), value(v).alias("value")) for k, v in rule.constraints]
    pairs += [F.when(slot(text, s).isNotNull(), F.struct(F.lit(s).alias("key"), slot(text, s).alias("value"))) for s in rule.slots]
    constraints = F.map_from_entries(F.array_compact(F.array(*pairs))) if pairs else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    missing = F.array(*[F.lit(m) for m in rule.missing]) if rule.missing else F.array().cast("array<string>")
    return F.struct(intent.alias("intent"), F.concat(F.lit("media."), intent).alias("tool"), F.lit(rule.confidence).alias("confidence"), constraints.alias("constraints"), missing.alias("missing_fields"), F.lit(bool(rule.missing)).alias("clarification_required"))


def parse_intent(utterance: Column, service: bool = False) -> Column:
    """struct(intent, tool, confidence, constraints, missing_fields, clarification_required) of an utterance; null falls through."""
    text = collapse(F.coalesce(utterance, F.lit("")))
    ladder = [Rule(r.intent, r.confidence, r.phrases + SERVICE_PHRASES.get(r.intent, ()), r.exact, r.constraints, r.slots, r.missing) if service else r for r in LADDER]
    chain = reduce(lambda c, r: c.when(_applies(r, text), _result(r, text)), ladder, F)
    return chain.otherwise(_result(SERVICE_FALLBACK if service else FALLBACK, text))


def model_or_rule(model: Column, confidence: Column, rule: Column, least: float = 0.5) -> Column:
    """The model's answer if it has one and is sure enough, else the rule's."""
    return F.when(model.isNotNull() & F.coalesce(confidence >= least, F.lit(False)), model).otherwise(rule)


def backend_kind(name: str) -> str:
    """The backend that a name or synonym means; unknown names are an error."""
    kinds = {"rule": "rule", "rules": "rule", "rule_based": "rule", "deterministic": "rule", "llama": "model", "llama_cpp": "model", "llama.cpp": "model", "slm": "model", "model": "model"}
    key = name.strip().lower().replace("-", "_")
    if key not in kinds:
        raise ValueError(f"unknown intent backend: {name}")
    return kinds[key]
