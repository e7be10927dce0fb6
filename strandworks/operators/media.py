"""Playlists and channel lists as media assets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import keyword_text, ordered_distinct, split_words, stable_id, token

# What a playlist's group says about genre, mood, theme and region, and language names in titles.
GENRES = {
    "animation": "kids", "auto": "lifestyle", "business": "business", "classic": "movies", "comedy": "comedy", "cooking": "lifestyle", "culture": "documentary",
    "documentary": "documentary", "education": "education", "entertainment": "entertainment", "family": "entertainment", "general": "general", "kids": "kids",
    "legislative": "news", "lifestyle": "lifestyle", "movies": "movies", "music": "music", "news": "news", "outdoor": "lifestyle", "regional": "entertainment",
    "religious": "religious", "science": "education", "series": "entertainment", "shop": "shopping", "sports": "sports", "travel": "lifestyle", "weather": "weather",
}
HINTS = {"hindi": "hi", "marathi": "mr", "tamil": "ta", "telugu": "te", "kannada": "kn", "gujarati": "gu", "bangla": "bn", "bengali": "bn", "punjabi": "pa", "malayalam": "ml"}
MOODS = {"comedy": ["funny"], "education": ["educational"], "kids": ["safe", "playful"], "movies": ["entertaining"], "music": ["energetic"], "news": ["informative"], "religious": ["devotional", "calm"], "sports": ["energetic"]}
THEMES = {"business": ["markets", "finance"], "news": ["current affairs"], "religious": ["devotional"], "sports": ["live sports"]}
TITLE_THEMES = {"cricket": "cricket", "kids": "children"}
REGIONS = [("marathi", "mr", "maharashtra"), ("tamil", "ta", "tamil_nadu"), ("telugu", "te", "andhra_telangana"), ("kannada", "kn", "karnataka"), ("gujarati", "gu", "gujarat")]


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in values]) if values else F.array().cast("array<string>")


def _filled(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def playlist_channels(files: DataFrame) -> DataFrame:
    """Channels of playlists given as (path, value), a whole file per row.

    A line that begins with #EXTINF and the line after it make a channel; a directive in place of the address leaves the
    address empty and is passed over, so of several such lines in a row every second one counts. Blank lines aren't
    counted. Names fall back to the text after the last comma, the id, and the line's number.
    """
    lines = F.filter(F.transform(F.split("value", r"\r\n|\n|\r|\x0b|\x0c|\x{85}|\x{2028}|\x{2029}"), lambda x: F.trim(x)), lambda x: x != "")
    each = files.select("path", F.posexplode(lines).alias("index", "line"))
    order = Window.partitionBy("path").orderBy("index")
    heads = each.withColumn("next", F.lead("line").over(order)).withColumn("head", F.col("line").startswith("#EXTINF"))
    begun = F.max(F.when(~F.col("head"), F.col("index"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    reached = heads.withColumn("_begun", F.coalesce(begun, F.lit(-1))).where(F.col("head") & ((F.col("index") - F.col("_begun") - 1) % 2 == 0))
    names, values = F.regexp_extract_all("line", F.lit(r'([\w-]+)="([^"]*)"'), F.lit(1)), F.regexp_extract_all("line", F.lit(r'([\w-]+)="([^"]*)"'), F.lit(2))
    at = lambda name: _filled(F.col("_values")[F.size("_names") - F.array_position(F.reverse("_names"), name).cast("int")])
    parted = reached.withColumn("_names", names).withColumn("_values", values)
    attr = lambda name: F.when(F.array_contains("_names", name), at(name))
    display = F.when(F.col("line").contains(","), F.trim(F.substring_index("line", ",", -1))).otherwise("")
    name = F.coalesce(attr("tvg-name"), _filled(display), attr("tvg-id"), F.concat(F.lit("Channel "), F.col("index").cast("string")))
    group = F.coalesce(attr("group-title"), F.lit("general"))
    languages = F.filter(F.transform(F.split(F.coalesce(attr("tvg-language"), F.lit("und")), ";"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return parted.select(
        "path", "index", F.coalesce(attr("tvg-id"), name).alias("id"), name.alias("name"), F.when(~F.col("next").startswith("#"), F.col("next")).otherwise("").alias("stream_url"), attr("tvg-logo").alias("logo"),
        F.coalesce(_filled(F.lower(F.trim(F.substring_index(group, ",", 1)))), F.lit("general")).alias("category"), attr("tvg-country").alias("country"), languages.alias("languages"), F.lit("general").alias("flavor"), group.alias("group"),
        F.when(F.coalesce(_filled(display), name) != name, F.array(display)).otherwise(_strings([])).alias("alt_names"),
    )


def project_assets(channels: DataFrame, provider: str, version: str) -> DataFrame:
    """Channels (id, name, stream_url, logo, category, country, languages, flavor, alt_names) as assets of one provider.

    A channel without a name is called by its id; one without either is left out.
    """
    title = F.trim(F.coalesce(_filled(F.trim("name")), F.col("id"), F.lit("")))
    lowered = F.lower("title")
    category = token(F.coalesce(_filled(F.col("category")), F.lit("general")))
    genre = reduce(lambda chain, kv: chain.when(F.col("_category") == kv[0], kv[1]), GENRES.items(), F).otherwise("general")
    given = F.transform(F.coalesce("languages", _strings([])), lambda x: F.lower(x))
    hinted = F.array_compact(F.array(*[F.when(lowered.contains(h), F.lit(code)) for h, code in HINTS.items()], F.when(F.lower(F.coalesce("flavor", F.lit(""))).contains("hindi"), F.lit("hi"))))
    spoken = ordered_distinct(F.concat(given, hinted))
    mapped = lambda table: reduce(lambda chain, kv: chain.when(F.col("genre") == kv[0], _strings(kv[1])), table.items(), F).otherwise(_strings([]))
    themes = ordered_distinct(F.concat(mapped(THEMES), F.array_compact(F.array(*[F.when(lowered.contains(w), F.lit(t)) for w, t in TITLE_THEMES.items()]))))
    region = reduce(lambda chain, r: chain.when((F.col("country") == "IN") & (lowered.contains(r[0]) | F.array_contains("language", r[1])), r[2]), REGIONS, F)
    region = region.when(F.col("country") == "IN", "india").when(F.col("country") == "US", "united_states")
    shown = F.lower(F.concat_ws(" ", "title", F.coalesce("stream_url", F.lit(""))))
    quality = F.when(shown.contains("4k") | shown.contains("uhd"), "4k").when(shown.rlike(r"\b(fhd|hd|1080)\b"), "hd")
    words = F.concat(F.array("title", keyword_text(F.col("title")), "genre", F.lit("live"), F.lit("24x7")), F.col("language"), F.array(F.lower(F.coalesce("country", F.lit("")))), F.coalesce("alt_names", _strings([])), split_words(F.col("title")))
    named = channels.withColumn("title", title).where("title <> ''").withColumn("_category", category).withColumn("genre", genre)
    known = named.withColumn("language", F.when(F.size(spoken) > 0, spoken).otherwise(F.array(F.lit("und"))))
    return known.select(
        stable_id(F.lit(provider), F.coalesce(_filled(F.col("id")), F.col("title"))).alias("id"), "title", F.lit(provider).alias("provider"), F.lit("live_channel").alias("type"), "language", F.array("genre").alias("genres"),
        F.when(F.col("_category") == F.col("genre"), _strings([])).otherwise(F.array("_category")).alias("subgenres"), "country", region.alias("region"), ordered_distinct(F.transform(F.filter(words, lambda x: x != ""), keyword_text)).alias("keywords"),
        mapped(MOODS).alias("mood"), themes.alias("themes"), (F.coalesce("stream_url", F.lit("")) != "").alias("playable"), quality.alias("resolution"), F.col("stream_url").alias("stream_uri"), F.col("logo").alias("thumbnail"), F.lit(version).alias("metadata_version"),
    )
