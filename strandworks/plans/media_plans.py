"""Named queries of playlists, channels, utterances, generated examples and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import index_terms, keyword_text, ordered_distinct, safe_segment, split_words, stable_id, token
from ..operators import generate, media, ranking, rules
from ..session import table
from .sql import collapse, listed

PLAYLIST = """#EXTM3U
#EXTINF:-1 tvg-id="Harbour.in" tvg-name="Harbour News" tvg-language="Hindi;en" tvg-country="IN" group-title="News,Local",Harbour News HD
https://streams.invalid/harbour.m3u8

#EXTINF:-1 tvg-id="Lagoon.in" tvg-country="IN" group-title="Movies",Lagoon Marathi Movies
https://streams.invalid/lagoon_1080.m3u8
#EXTINF:-1,Lost Head
#EXTINF:-1 tvg-id="Swallowed",Swallowed
#EXTINF:-1 group-title="Sports" tvg-country="US",Cricket Kids UHD
#EXTVLCOPT:http-referrer=x
https://streams.invalid/unread.m3u8
#EXTINF:-1 tvg-id="Quarry"
https://streams.invalid/quarry.m3u8
"""


def m3u_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = media.playlist_channels(spark.createDataFrame([("inline", PLAYLIST)], "path string, value string"))
    return channels.select("index", "id", "name", "stream_url", "category", "country", F.array_join("languages", ";").alias("languages"), "group", F.array_join("alt_names", ";").alias("alt_names"))


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "entities_v1").select(F.upper("market").alias("country"), F.explode("entities.channel").alias("c"))
    last = F.lower(F.element_at(F.split("c.name", " "), -1))
    return rows.select(F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.when(F.length("c.name") % 5 > 0, F.concat(F.lit("https://streams.invalid/"), F.when(F.length("c.name") % 3 == 0, "hd").otherwise("live"))).alias("stream_url"), F.lit(None).cast("string").alias("logo"), last.alias("category"), "country", F.array().cast("array<string>").alias("languages"), F.lit("general").alias("flavor"), F.col("c.aliases").alias("alt_names"))


def media_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels of the vocabularies as assets, with lists as text."""
    assets = media.project_assets(_channels(spark, sf_dir), "vocab", "1.0.0")
    joined = [F.array_join(c, ";").alias(c) for c in ("language", "genres", "subgenres", "mood", "themes")]
    return assets.select("id", "title", "type", *joined, "country", "region", "playable", "resolution")


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "code_symbols").select(stable_id(F.lit("code"), F.col("path")).alias("id"), token(F.col("qualified_name")).alias("token"), safe_segment(F.col("path")).alias("segment")).distinct()


def text_normalise_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword form, words and index terms of documents' first titles."""
    rows = table(spark, sf_dir, "code_symbols").select(F.concat_ws(" ", "name", "path", "kind").alias("t")).distinct()
    return rows.select("t", keyword_text(F.col("t")).alias("keyword"), F.array_join(ordered_distinct(split_words(F.col("t"))), " ").alias("words"), F.array_join(index_terms(F.col("t")), " ").alias("terms"))


UTTERANCES = [
    "Play Sony", "put on  news", "Favorite this channel please", "resume from yesterday", "what happened yesterday", "What's live now", "what is live", "play Aaj Tak in hd", "open PBS Kids", "pbs kids please",
    "Cricket in SD", "Sports in HD only", "nothing violent", "cartoon for a 5 year old", "play latest Hindi movies", "show recent English films in fhd", "Tuesday news", "business news in tamil", "marathi bhajan", "class 8 education",
    "free stuff", "I am bored", "something relaxing", "display movie", "zzz", "",
]


def _parsed(spark: SparkSession, service: bool) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(UTTERANCES)), "i int, utterance string").withColumn("r", rules.parse_intent(F.col("utterance"), service))
    entries = F.array_join(F.transform(F.array_sort(F.map_entries("r.constraints")), lambda e: F.concat_ws("=", e.key, e.value)), ";")
    return rows.select("i", "r.intent", "r.tool", "r.confidence", entries.alias("constraints"), F.array_join("r.missing_fields", ";").alias("missing"), "r.clarification_required")


def intent_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, False)


def intent_rules_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, True)


SEED, COUNT = 4, 2000
TEMPLATES = ["play {title} in {language}", "show {mood} {genre} from {place}", "resume the {title} series", "find {genre} in {language} for {mood} evenings"]
SLOTS = {"title": ["lantern", "harbour", "orchard", "quarry", "meadow"], "language": ["hindi", "english", "tamil"], "mood": ["funny", "calm"], "genre": ["movies", "news", "sports"], "place": ["Norvale", "Bexhaven", "Ostby", "Velmira"]}


def media_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.from_templates(spark, COUNT, SEED, TEMPLATES, SLOTS)


PREFIXES = ["please ", "can you ", "hey, ", ""]


def prefix_cross_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names after every prefix, without those that the evaluation part has."""
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("find "), "p_name").alias("q"), "p_partkey")
    evaluation = parts.where("p_partkey % 7 = 0").select(F.col("q").alias("instruction"))
    return generate.with_prefixes(parts, "q", PREFIXES, evaluation)


FAMILIES = ["abstain", "grounded_answer", "live_data_lookup", "metadata_lookup"]


def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ninety examples, as many of each family, in turn."""
    rows = ranking.balanced(table(spark, sf_dir, "enterprise_examples").select("example_id", "family"), "family", "example_id", FAMILIES, 90)
    return rows.select("rank", "turn", "family", "example_id")


def augment_every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enterprise_examples").select("example_id", "family")
    return generate.augment_every_nth(rows, "family", "example_id", 4, F.concat(F.lit("draft:"), "family"))


def ext_watch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user events by part of the day, weekend share and favourite type."""
    hour, day = F.hour("ts"), F.dayofweek("ts")
    rows = table(spark, sf_dir, "events")
    counts = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(hour < 6).alias("night"), F.count_if((hour >= 6) & (hour < 18)).alias("day"), F.count_if(hour >= 18).alias("evening"), F.round(F.avg(day.isin(1, 7).cast("double")), 6).alias("weekend_share"))
    kinds = rows.groupBy("user_id", "event_type").agg(F.count("*").alias("c"))
    best = kinds.groupBy("user_id").agg(F.max(F.struct("c", "event_type")).alias("b"))
    return counts.join(best, "user_id").select("user_id", "n", "night", "day", "evening", "weekend_share", F.col("b.event_type").alias("favourite"))


def ext_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per tumbling hour, per sliding window of two hours and per session of ten minutes, with their values."""
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id", "value")
    found = None
    for kind, window, keys in (("tumbling", F.window("ts", "1 hour"), ["event_type"]), ("sliding", F.window("ts", "2 hours", "1 hour"), ["event_type"]), ("session", F.session_window("ts", "10 minutes"), ["user_id"])):
        one = rows.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.lit(kind).alias("kind"), F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), F.col(keys[0]).cast("string").alias("key"), "n", "total")
        found = one if found is None else found.unionByName(one)
    return found


QUERIES = {f.__name__: f for f in (m3u_scan, media_assets, stable_ids, text_normalise_variants, intent_rules, intent_rules_service, media_generate, prefix_cross_corpus, balanced_sample, augment_every_nth, ext_watch_features, ext_event_windows)}

_TOKEN = "CASE WHEN {t} = '' THEN 'unknown' ELSE {t} END"


def _token(x: str) -> str:
    return _TOKEN.replace("{t}", f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9.]+', '_', 'g'), '^_+|_+$', '', 'g')")


def _keyword(x: str) -> str:
    return collapse(f"replace({x}, '_', ' ')")


def _slot_sql(name: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(t, '{w}') THEN '{v}'" for w, v in rules.SLOTS[name]) + " END"


def utterance_sql(service: bool, source: str | None = None) -> str:
    """The ladder as SQL over a table of (i, utterance), by default the listed utterances."""
    arms = []
    for rule in rules.LADDER:
        phrases = rule.phrases + (rules.SERVICE_PHRASES.get(rule.intent, ()) if service else ())
        said = " OR ".join([f"contains(t, '{p.replace(chr(39), chr(39) * 2)}')" for p in phrases] + [f"t = '{e}'" for e in rule.exact])
        if "query" in rule.slots:
            said = f"({said}) AND (" + " OR ".join(f"starts_with(t, '{o}')" for o in rules.OPENINGS) + ")"
        arms.append((said, rule))
    arms.append(("TRUE", rules.SERVICE_FALLBACK if service else rules.FALLBACK))

    def pick(value) -> str:
        return "CASE " + " ".join(f"WHEN {said} THEN {value(rule)}" for said, rule in arms) + " END"

    def constraint(rule) -> str:
        fixed = [f"'{k}=' || " + ("CASE WHEN contains(t, 'business') THEN 'business_news' ELSE 'news' END" if v == "{business}" else f"'{v}'") for k, v in rule.constraints]
        return "array_to_string(list_sort(list_filter([" + ", ".join(fixed + [f"'{s}=' || {_slot_sql(s)}" for s in rule.slots] + ["NULL::VARCHAR"]) + "], lambda x: x IS NOT NULL)), ';')"

    intent = pick(lambda r: "CASE WHEN contains(t, 'play') THEN 'play' ELSE 'search' END" if r.intent == "{play}" else f"'{r.intent}'")
    values = ", ".join(f"({i}, '{u.replace(chr(39), chr(39) * 2)}')" for i, u in enumerate(UTTERANCES))
    given = source or f"(VALUES {values}) v(i, utterance)"
    return f"""WITH u AS (SELECT i, {collapse('utterance')} AS t FROM {given}), r AS (SELECT i, {intent} AS intent, {pick(lambda r: f'{r.confidence}::DOUBLE')} AS confidence, {pick(constraint)} AS constraints, {pick(lambda r: f"'{';'.join(r.missing)}'")} AS missing FROM u)
        SELECT i, intent, 'media.' || intent AS tool, confidence, constraints, missing, missing <> '' AS clarification_required FROM r"""


def _choice_sql(values: list[str], salt: str) -> str:
    return f"([{listed(values)}])[1 + ('0x' || substr(sha256('{SEED}|{salt}|' || i), 1, 8))::BIGINT % {len(values)}]"


_FILLED = f"([{listed(TEMPLATES)}])[i % {len(TEMPLATES)} + 1]"
for _name, _values in SLOTS.items():
    _FILLED = f"replace({_FILLED}, '{{{_name}}}', {_choice_sql(_values, _name)})"
_ATTR = "nullif(regexp_extract(line, '{0}=\"([^\"]*)\"', 1), '')"
_LOW = "lower(title)"
_GENRE = "CASE category " + " ".join(f"WHEN '{k}' THEN '{g}'" for k, g in media.GENRES.items()) + " ELSE 'general' END"


def _by_genre(table_: dict[str, list[str]]) -> str:
    return "CASE genre " + " ".join(f"WHEN '{k}' THEN [{listed(v)}]" for k, v in table_.items()) + " ELSE []::VARCHAR[] END"


def _hinted(pairs: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN contains({_LOW}, '{w}') THEN '{v}' END" for w, v in pairs.items()) + "], lambda x: x IS NOT NULL)"


ORACLE = {
    "m3u_scan": f"""WITH l AS (SELECT unnest(list_filter(list_transform(string_split('{PLAYLIST}', chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS line), n AS (SELECT line, row_number() OVER () - 1 AS idx FROM l),
        h AS (SELECT idx, line, lead(line) OVER (ORDER BY idx) AS nxt, starts_with(line, '#EXTINF') AS head, coalesce(max(CASE WHEN NOT starts_with(line, '#EXTINF') THEN idx END) OVER (ORDER BY idx ROWS UNBOUNDED PRECEDING), -1) AS b FROM n),
        c AS (SELECT *, CASE WHEN contains(line, ',') THEN trim(regexp_extract(line, ',([^,]*)$', 1)) ELSE '' END AS display FROM h WHERE head AND (idx - b - 1) % 2 = 0),
        d AS (SELECT *, coalesce({_ATTR.format('tvg-name')}, nullif(display, ''), {_ATTR.format('tvg-id')}, 'Channel ' || idx) AS name, coalesce({_ATTR.format('group-title')}, 'general') AS grp FROM c)
        SELECT idx AS index, coalesce({_ATTR.format('tvg-id')}, name) AS id, name, CASE WHEN NOT starts_with(nxt, '#') THEN nxt ELSE '' END AS stream_url, lower(trim(string_split(grp, ',')[1])) AS category, {_ATTR.format('tvg-country')} AS country,
          array_to_string(list_filter(list_transform(string_split(coalesce({_ATTR.format('tvg-language')}, 'und'), ';'), lambda x: lower(trim(x))), lambda x: x <> ''), ';') AS languages, grp AS "group", CASE WHEN display <> '' AND display <> name THEN display ELSE '' END AS alt_names FROM d""",
    "media_assets": f"""WITH c AS (SELECT upper(market) AS country, unnest(entities.channel) AS c FROM entities_v1), n AS (SELECT c.id AS raw, c.name AS title, country, {_token("string_split(c.name, ' ')[-1]")} AS category,
          CASE WHEN length(c.name) % 5 > 0 THEN 'https://streams.invalid/' || CASE WHEN length(c.name) % 3 = 0 THEN 'hd' ELSE 'live' END END AS url FROM c), g AS (SELECT *, {_GENRE} AS genre, list_distinct({_hinted(media.HINTS)}) AS hints FROM n),
        l AS (SELECT *, CASE WHEN len(hints) > 0 THEN hints ELSE ['und'] END AS language, lower(title || ' ' || coalesce(url, '')) AS shown FROM g)
        SELECT 'vocab_' || replace({_token('raw')}, '.', '_') AS id, title, 'live_channel' AS type, array_to_string(language, ';') AS language, genre AS genres, CASE WHEN category = genre THEN '' ELSE category END AS subgenres, array_to_string({_by_genre(media.MOODS)}, ';') AS mood,
          array_to_string(list_concat({_by_genre(media.THEMES)}, {_hinted(media.TITLE_THEMES)}), ';') AS themes, country, CASE {' '.join(f"WHEN country = 'IN' AND (contains({_LOW}, '{w}') OR list_contains(language, '{code}')) THEN '{r}'" for w, code, r in media.REGIONS)} WHEN country = 'IN' THEN 'india' WHEN country = 'US' THEN 'united_states' END AS region,
          coalesce(url, '') <> '' AS playable, CASE WHEN contains(shown, '4k') OR contains(shown, 'uhd') THEN '4k' WHEN regexp_matches(shown, '\\b(fhd|hd|1080)\\b') THEN 'hd' END AS resolution FROM l""",
    "stable_ids": f"SELECT DISTINCT 'code_' || replace({_token('path')}, '.', '_') AS id, {_token('qualified_name')} AS token, regexp_replace(path, '[^A-Za-z0-9._-]', '_', 'g') AS segment FROM code_symbols",
    "intent_rules": utterance_sql(False),
    "intent_rules_service": utterance_sql(True),
    "media_generate": f"SELECT i, (i % {len(TEMPLATES)})::INT AS template, {_FILLED} AS input FROM range({COUNT}) r(i)",
    "prefix_cross_corpus": f"SELECT DISTINCT p || 'find ' || p_name AS instruction FROM part, (SELECT unnest([{listed(PREFIXES)}]) AS p) WHERE p || 'find ' || p_name NOT IN (SELECT 'find ' || p_name FROM part WHERE p_partkey % 7 = 0)",
    "balanced_sample": f"""WITH r AS (SELECT example_id, family, row_number() OVER (PARTITION BY family ORDER BY example_id) AS rank, list_position([{listed(FAMILIES)}], family) - 1 AS turn FROM enterprise_examples WHERE family IN ({listed(FAMILIES)}))
        SELECT rank, turn, family, example_id FROM r WHERE rank <= {90 // len(FAMILIES)} + CASE WHEN turn < {90 % len(FAMILIES)} THEN 1 ELSE 0 END""",
    "augment_every_nth": "WITH r AS (SELECT example_id, family, row_number() OVER (PARTITION BY family ORDER BY example_id) AS k FROM enterprise_examples) SELECT example_id, family, NULL AS draft, FALSE AS augmented FROM r UNION ALL SELECT example_id, family, 'draft:' || family, TRUE FROM r WHERE k % 4 = 0",
    "ext_watch_features": """WITH c AS (SELECT user_id, count(*) AS n, count_if(hour(ts) < 6) AS night, count_if(hour(ts) >= 6 AND hour(ts) < 18) AS day, count_if(hour(ts) >= 18) AS evening, round(avg((dayofweek(ts) IN (0, 6))::INT), 6) AS weekend_share FROM events GROUP BY 1),
        k AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), b AS (SELECT user_id, event_type AS favourite FROM k QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type DESC) = 1) SELECT c.*, favourite FROM c JOIN b ON b.user_id = c.user_id""",
    "ext_event_windows": """WITH t AS (SELECT date_trunc('hour', ts) AS h, * FROM events), g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, fresh DESC ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT 'tumbling' AS kind, h AS start, h + INTERVAL 1 HOUR AS "end", event_type AS key, count(*) AS n, round(sum(value), 4) AS total FROM t GROUP BY h, event_type
        UNION ALL SELECT 'sliding', b, b + INTERVAL 2 HOUR, event_type, count(*), round(sum(value), 4) FROM (SELECT unnest([h, h - INTERVAL 1 HOUR]) AS b, event_type, value FROM t) GROUP BY b, event_type
        UNION ALL SELECT 'session', min(ts), max(ts) + INTERVAL 10 MINUTE, user_id::VARCHAR, count(*), round(sum(value), 4) FROM s GROUP BY user_id, k""",
    "text_normalise_variants": f"""WITH r AS (SELECT DISTINCT concat_ws(' ', name, path, kind) AS t FROM code_symbols), w AS (SELECT t, {_keyword('t')} AS keyword, list_filter(regexp_split_to_array(t, '[^A-Za-z0-9]+'), lambda x: x <> '') AS l,
          list_filter(list_transform(regexp_split_to_array(replace(lower(t), '_', ' '), ' +'), lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}]', '', 'g')), lambda x: x <> '') AS k FROM r)
        SELECT t, keyword, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS words, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i), ' ') AS terms FROM w""",
}
