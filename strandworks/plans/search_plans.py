"""Named queries of search, recommendation, playback, index and pack over the media assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPACE, index_terms, strip
from ..operators import search as s
from ..operators.nested import latest_delivery
from ..session import table

FIELDS = ["id", "title", "provider", "type", "languages", "genres", "stream_uri"]


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each asset's latest delivery, with its JSON members as metadata."""
    rows = table(spark, sf_dir, "media_assets").withColumn("languages", F.col("language"))
    kept = latest_delivery(rows, "id", "ingested_at", *FIELDS[1:], "json")
    return kept.withColumn("metadata", s.metadata(F.col("json"))).drop("json")


def _hits(df: DataFrame) -> DataFrame:
    return df.select("rank", "id", "title", F.round("score", 4).alias("score"), "explanation")


def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(s.search(assets(spark, sf_dir), "Show me funny Hindi movies about the lantern and the harbour", {"type": "movie"}, 20))


def search_no_match_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(s.search(assets(spark, sf_dir), "zzz", {}, 5))


def recommend_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(s.recommend(assets(spark, sf_dir), {"genre": "sports", "language": "english"}, 10))


def resolve_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assets(spark, sf_dir)
    wanted = rows.where(strip(F.col("stream_uri")) != "").agg(F.min("id")).first()[0] or ""
    return s.resolve(rows, wanted).select("id", "title", "stream_uri")


def play_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.play(assets(spark, sf_dir), "play the marble orchard").select("id", "title", "stream_uri")


def resume_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.resume(assets(spark, sf_dir)).select("id", "title", "stream_uri")


CONSTRAINTS = {
    "genre": {"genre": "movie"}, "language": {"language": "marathi"}, "type": {"type": "live_channel"}, "live_true": {"live": "true"}, "live_false": {"live": "false"},
    "country": {"country": "in"}, "unknown_key": {"audience": "kids"}, "quality": {"quality": "1080"}, "several": {"genre": "news", "live": "true"},
}


def search_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many assets meet each family of constraints, and their score."""
    rows, found = assets(spark, sf_dir), None
    for name, wanted in CONSTRAINTS.items():
        one = s.score(rows, "", wanted).agg(F.count("*").alias("n"), F.round(F.max("score"), 4).alias("score")).withColumn("name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found.select("name", "n", "score")


def postings_by_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, first and last asset of each term's postings."""
    term = F.explode(index_terms(F.concat_ws(" ", "title", "provider", "type")))
    return assets(spark, sf_dir).select("id", term.alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets by first genre, and by each language."""
    rows = assets(spark, sf_dir).select(F.coalesce(F.get("genres", F.lit(0)), F.lit("unknown")).alias("genre"), "languages")
    both = F.explode(F.concat(F.array(F.struct(F.lit("genre").alias("facet"), F.col("genre").alias("value"))), F.transform(F.coalesce("languages", F.array().cast("array<string>")), lambda x: F.struct(F.lit("language").alias("facet"), x.alias("value")))))
    return rows.select(both.alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def pack_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(check, n) of what keeps the asset table from being a valid pack: repeated ids, blank titles, unplayable assets, unreadable JSON."""
    rows = table(spark, sf_dir, "media_assets")
    repeated = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n")).select(F.lit("repeated id").alias("check"), "n")
    blank = rows.where(F.coalesce(strip(F.col("title")), F.lit("")) == "").agg(F.count("*").alias("n")).select(F.lit("blank title").alias("check"), "n")
    silent = rows.where(F.coalesce(strip(F.col("stream_uri")), F.lit("")) == "").agg(F.count("*").alias("n")).select(F.lit("not playable").alias("check"), "n")
    broken = rows.where(F.expr("try_parse_json(json) IS NULL")).agg(F.count("*").alias("n")).select(F.lit("unreadable json").alias("check"), "n")
    return repeated.union(blank).union(silent).union(broken)


def pack_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksum per provider: hashes of the assets, folded in order within buckets of a hash, then over the buckets."""
    row = F.sha2(F.concat_ws("\x1f", "id", F.coalesce("title", F.lit("")), F.coalesce("stream_uri", F.lit(""))), 256)
    rows = assets(spark, sf_dir).select("provider", F.struct("id", row.alias("h")).alias("x"), F.substring(F.sha2("id", 256), 1, 2).alias("bucket"))
    buckets = rows.groupBy("provider", "bucket").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.h), ""), 256).alias("h"))
    return buckets.groupBy("provider").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: x.h), ""), 256).alias("checksum"))


CATALOGUE = "('m1','Funny Nights','movies','hi',0.6),('m2','Calm Sea','movies','en',0.5),('n1','Morning News','news','hi',0.7),('s1','Cricket Now','sports','en',0.65),('k1','Moon Kids','kids','en',0.4)"


def catalogue_rank_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM VALUES {CATALOGUE.replace('0.', '0.')} AS t(id, title, genre, language, base)").withColumn("base", F.col("base").cast("double"))
    return s.rank_alternative(rows, "something funny", {"language": "hi", "mood": "funny"}, frozenset({"mood", "live", "sort", "audience", "age_safe", "subgenre", "query"})).select("id", "title", "score")


COMMANDS = {
    "eq": [("l_returnflag", "eq", "R")], "neq": [("l_returnflag", "neq", "R")], "lt": [("l_quantity", "lt", 10)], "lte": [("l_quantity", "lte", 10)],
    "gt": [("l_discount", "gt", 0.05)], "gte": [("l_discount", "gte", 0.05)], "range": [("l_quantity", "range", (5, 7))], "in": [("l_linestatus", "in", ("O",)), ("l_quantity", "gt", 40)],
}


def command_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that each kind of filter keeps: all kinds in one scan."""
    rows = table(spark, sf_dir, "lineitem")
    counted = rows.agg(*[F.count_if(s.compile_command(f)).alias(name) for name, f in COMMANDS.items()])
    return counted.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in COMMANDS]), F.array(*COMMANDS))).alias("op", "n"))


def command_filter_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(s.compile_command([("l_shipdate", "gte", "1996-01-01"), ("l_quantity", "range", (20, 30)), ("l_returnflag", "in", ("A", "N"))]))
    return rows.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 2).alias("price")).orderBy(F.desc("price"), "l_orderkey", "l_linenumber").limit(50)


QUERIES = {f.__name__: f for f in (search_topk, search_no_match_floor, recommend_topk, resolve_item, play_best, resume_cascade, search_constraints, postings_by_term, facet_counts, pack_validation, pack_checksum, catalogue_rank_alt, command_filter, command_filter_sort)}

_ASCII = "regexp_replace(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]', ' ', 'g')"
_ALIAS = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in s.ALIASES.items())
_STOP = ", ".join(f"'{w}'" for w in s.STOP_WORDS)
_PLAY = f"regexp_replace(coalesce(stream_uri, ''), '{SPACE}', '', 'g') <> ''"


def _ascii(x: str) -> str:
    return _ASCII.replace("{x}", x)


def _al(x: str) -> str:
    return f"(CASE trim({_ascii(x)}) {_ALIAS} ELSE trim({_ascii(x)}) END)"


_ASSETS = f"""latest AS (SELECT id, unnest(arg_max({{'title': title, 'provider': provider, 'type': type, 'language': language, 'genres': genres, 'stream_uri': stream_uri, 'json': json}}, ingested_at)) FROM media_assets WHERE id IS NOT NULL GROUP BY id),
  members AS (SELECT l.id, e.key, CASE e.type WHEN 'VARCHAR' THEN e.value ->> '$' WHEN 'NULL' THEN NULL WHEN 'ARRAY' THEN array_to_string(e.value ->> '$[*]', ',') ELSE e.value::VARCHAR END AS v
    FROM latest l, json_each(CASE WHEN json_valid(l.json) AND json_type(l.json) = 'OBJECT' THEN l.json::JSON ELSE '{{}}'::JSON END) e WHERE e.key NOT IN ('id', 'title', 'stream_uri')),
  meta AS (SELECT id, string_agg(v, ' ') AS said, list({{'k': key, 'v': v}}) AS m FROM members WHERE v <> '' GROUP BY 1),
  assets AS (SELECT l.id, title, provider, type, language, genres, stream_uri, coalesce(m, []) AS m, {_ascii("coalesce(title, '')")} AS t,
    list_distinct(list_filter(list_transform(regexp_split_to_array({_ascii("concat_ws(' ', title, provider, type, array_to_string(language, ' '), array_to_string(genres, ' '), said)")}, ' +'),
      lambda w: CASE w {_ALIAS} ELSE w END), lambda w: w <> '' AND w NOT IN ({_STOP}))) AS terms FROM latest l LEFT JOIN meta ON meta.id = l.id)"""


def _meta(key: str) -> str:
    return f"list_filter(m, lambda x: x.k = '{key}')[1].v"


def _match_sql(key: str, expected: str) -> str:
    wanted = s.alias_of(expected)
    if key == "language":
        return f"len(list_filter(language, lambda x: {_al('x')} = '{wanted}')) > 0"
    if key == "genre":
        return f"len(list_filter(genres, lambda x: {_al('x')} = '{wanted}')) > 0"
    if key == "type":
        return f"{_al('type')} = '{wanted}'"
    if key == "quality":
        return f"contains({_ascii(_meta('quality'))}, '{wanted}')"
    if key in ("live", "playable"):
        return f"""coalesce({_al(_meta(key))} = '{wanted}', contains(replace({_meta('availability')}, ' ', ''), '"{key}":true'))"""
    return f"{_al(_meta(key))} = '{wanted}'"


def _search_sql(text: str, constraints: dict[str, str], limit: int | None) -> str:
    terms = s.terms_of(text)
    scores = "".join(f" + CASE WHEN list_contains(terms, '{t}') THEN CASE WHEN contains(t, '{t}') THEN 4.0::DOUBLE ELSE 1.5::DOUBLE END ELSE 0 END" for t in terms)
    said = [f"CASE WHEN list_contains(terms, '{t}') THEN 'matched term ''{t}''' END" for t in terms] + [f"'matched {k}={s.alias_of(v)}'" for k, v in sorted(constraints.items())]
    if not terms and not constraints:
        said.append("'default recommendation'")
    where = "".join(f" AND coalesce({_match_sql(k, v)}, FALSE)" for k, v in sorted(constraints.items()))
    score = f"0.05::DOUBLE{scores} + {3.0 * len(constraints) + (0.5 if not terms and not constraints else 0.0)}::DOUBLE"
    hits = f"SELECT *, {score} AS score, concat_ws('; ', {', '.join(said) or 'NULL'}) AS explanation FROM assets WHERE {_PLAY}{where}"
    return hits if limit is None else f"SELECT row_number() OVER (ORDER BY score DESC, title, id) AS rank, * FROM ({hits}) ORDER BY score DESC, title, id LIMIT {limit}"


def _hits_sql(text: str, constraints: dict[str, str], limit: int, columns: str = "rank, id, title, round(score, 4) AS score, explanation") -> str:
    return f"WITH {_ASSETS} SELECT {columns} FROM ({_search_sql(text, constraints, limit)})"


_ITEM = "id, title, stream_uri"
_OPS = {"eq": "l_returnflag = 'R'", "neq": "l_returnflag <> 'R'", "lt": "l_quantity < 10", "lte": "l_quantity <= 10", "gt": "l_discount > 0.05::DOUBLE", "gte": "l_discount >= 0.05::DOUBLE", "range": "l_quantity BETWEEN 5 AND 7", "in": "l_linestatus IN ('O') AND l_quantity > 40"}
_PARTS = f"list_distinct(list_filter(list_transform(regexp_split_to_array(replace(lower(concat_ws(' ', title, provider, type)), '_', ' '), '{SPACE}+'), lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}]', '', 'g')), lambda x: x <> ''))"
ORACLE = {
    "search_topk": _hits_sql("Show me funny Hindi movies about the lantern and the harbour", {"type": "movie"}, 20),
    "search_no_match_floor": _hits_sql("zzz", {}, 5),
    "recommend_topk": _hits_sql("", {"genre": "sports", "language": "english"}, 10),
    "resolve_item": f"WITH {_ASSETS} SELECT {_ITEM} FROM assets WHERE {_PLAY} ORDER BY id LIMIT 1",
    "play_best": _hits_sql("play the marble orchard", {}, 1, _ITEM),
    "resume_cascade": f"WITH {_ASSETS} SELECT {_ITEM} FROM (SELECT 0 AS turn, {_ITEM} FROM ({_search_sql('', {'genre': 'movies'}, 1)}) UNION ALL SELECT 1, {_ITEM} FROM ({_search_sql('', {}, 1)})) ORDER BY turn LIMIT 1",
    "search_constraints": f"WITH {_ASSETS} " + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, round(max(score), 4) AS score FROM ({_search_sql('', c, None)})" for n, c in CONSTRAINTS.items()),
    "postings_by_term": f"WITH {_ASSETS} SELECT term, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM (SELECT id, unnest({_PARTS}) AS term FROM assets) GROUP BY 1",
    "facet_counts": f"WITH {_ASSETS} SELECT facet, value, count(*) AS n FROM (SELECT 'genre' AS facet, coalesce(genres[1], 'unknown') AS value FROM assets UNION ALL SELECT 'language', unnest(language) FROM assets) GROUP BY 1, 2",
    "pack_validation": f"""SELECT 'repeated id' AS "check", count(*) AS n FROM (SELECT id FROM media_assets GROUP BY id HAVING count(*) > 1)
        UNION ALL SELECT 'blank title', count(*) FROM media_assets WHERE regexp_replace(coalesce(title, ''), '{SPACE}', '', 'g') = ''
        UNION ALL SELECT 'not playable', count(*) FROM media_assets WHERE NOT ({_PLAY}) UNION ALL SELECT 'unreadable json', count(*) FROM media_assets WHERE json IS NULL OR NOT json_valid(json)""",
    "pack_checksum": f"""WITH {_ASSETS}, r AS (SELECT provider, id, sha256(concat_ws(chr(31), id, coalesce(title, ''), coalesce(stream_uri, ''))) AS h, substr(sha256(id), 1, 2) AS bucket FROM assets),
        b AS (SELECT provider, bucket, sha256(string_agg(h, '' ORDER BY id)) AS h FROM r GROUP BY 1, 2) SELECT provider, sha256(string_agg(h, '' ORDER BY bucket)) AS checksum FROM b GROUP BY 1""",
    "catalogue_rank_alt": f"SELECT id, title, round(base::DOUBLE + CASE WHEN contains(lower(title || ' ' || genre || ' ' || language), 'something') OR contains(lower(title || ' ' || genre || ' ' || language), 'funny') THEN 0.2::DOUBLE ELSE 0 END + 0.35::DOUBLE + CASE WHEN genre = 'movies' THEN 0.15::DOUBLE ELSE 0 END, 3) AS score FROM (VALUES {CATALOGUE}) t(id, title, genre, language, base) WHERE language = 'hi'",
    "command_filter": " UNION ALL ".join(f"SELECT '{op}' AS op, count(*) AS n FROM lineitem WHERE {test}" for op, test in _OPS.items()),
    "command_filter_sort": "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_quantity BETWEEN 20 AND 30 AND l_returnflag IN ('A', 'N') ORDER BY price DESC, l_orderkey, l_linenumber LIMIT 50",
}
