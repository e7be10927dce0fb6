"""Named queries of nested records: media assets and the vocabularies as flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nested import flat_tables, latest_delivery, leaf_paths, path_triples, pivot_table, unread
from ..session import table

# The repeated parts of an asset and the names that mark one of their items.
ASSET_PARTS = {
    "availability.windows": {"territory", "from", "to", "offers"},
    "availability.windows[].offers": {"kind", "price", "devices"},
    "quality.tiers": {"label", "height", "hdr", "renditions"},
    "quality.tiers[].renditions": {"codec", "kbps"},
    "metadata.credits": {"name", "role"},
}
VOCABULARY_PARTS = {"entities.team": {"id", "name", "aliases"}, "entities.team[].aliases": set()}
CHILD = {
    "availability.windows": "window",
    "availability.windows.offers": "offer",
    "quality.tiers": "tier",
    "quality.tiers.renditions": "rendition",
    "metadata.credits": "credit",
    "entities.team.aliases": "team_alias",
}
TABLES = {
    "window": ("availability.windows", ["territory", "from", "to"]),
    "offer": ("availability.windows.offers", ["kind", "price.amount", "price.currency", "devices[0]", "devices[1]", "devices[2]"]),
    "tier": ("quality.tiers", ["label", "height", "hdr"]),
    "rendition": ("quality.tiers.renditions", ["codec", "kbps"]),
    "credit": ("metadata.credits", ["name", "role"]),
}
ASSET_LEAVES = ["availability.live", "availability.playable", "metadata.catalogue.season", "metadata.tags.mood"]


def _plain(parts: dict[str, set[str]]) -> dict[str, set[str]]:
    return {path.replace("[]", ""): names for path, names in parts.items()}


def asset_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of each asset's latest delivery."""
    assets = latest_delivery(table(spark, sf_dir, "media_assets"), "id", "ingested_at", "json")
    return path_triples(assets, "id", "json", _plain(ASSET_PARTS))


def vocabulary_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "entities_v1").select("market", F.to_json(F.struct(F.struct("entities.team").alias("entities")), {"ignoreNullFields": "false"}).alias("json"))
    return path_triples(rows, "market", "json", _plain(VOCABULARY_PARTS))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each nested item of the assets and for each alias of a team: the keys of the rows of all flat tables.

    An alias of a market that stands in several vocabulary rows counts in each of them.
    """
    child = F.create_map(*[F.lit(x) for pair in CHILD.items() for x in pair])
    flat = flat_tables(asset_triples(spark, sf_dir).unionByName(vocabulary_triples(spark, sf_dir))).where(F.col("node").isin(list(CHILD)))
    return flat.select(F.col("record_id").alias("parent_id"), child[F.col("node")].alias("child"), F.explode(F.array_repeat("pos", F.col("n_given").cast("int"))).alias("pos"))


def _part(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        node, columns = TABLES[name]
        flat = pivot_table(asset_triples(spark, sf_dir), node, columns)
        rest = F.array_join(F.transform(F.array_sort(F.map_entries("rest")), lambda e: F.concat_ws("=", e.key, e.value)), ";")
        return flat.withColumn("rest", rest)

    query.__name__ = f"p1_{name}s"
    query.__doc__ = f"The flat table of all {name}s, each with its asset's id, its position and its parent's position."
    return query


def p1_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the assets themselves: what stands outside of their repeated parts, one row for each asset.

    rest is JSON, because titles and tags are free text that may hold any separator.
    """
    flat = pivot_table(asset_triples(spark, sf_dir), "", ASSET_LEAVES)
    rest = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("rest"))), {"ignoreNullFields": "false"})
    return flat.drop("pos", "parent_pos").withColumn("rest", rest)


def p1_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of all teams of the vocabularies, each with its market and position."""
    return pivot_table(vocabulary_triples(spark, sf_dir), "entities.team", ["id", "name"]).select(F.col("record_id").alias("market"), "pos", "id", "name")


def p1_team_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of all aliases of teams, each with its market, its position and its team's position."""
    return pivot_table(vocabulary_triples(spark, sf_dir), "entities.team.aliases", [""]).select(F.col("record_id").alias("market"), "pos", "parent_pos", F.col("value").alias("alias"))


def p1_leaf_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns found in each table, with their number of values."""
    return leaf_paths(asset_triples(spark, sf_dir).unionByName(vocabulary_triples(spark, sf_dir)))


def p1_unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets whose latest delivery can't be read, by reason."""
    return unread(asset_triples(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n_assets"), F.min("record_id").alias("least_id"))


QUERIES = {"p1_found": p1_found, "p1_unread": p1_unread, "p1_leaf_paths": p1_leaf_paths, "p1_assets": p1_assets, "p1_teams": p1_teams, "p1_team_aliases": p1_team_aliases} | {f"p1_{name}s": _part(name) for name in TABLES}

_ITEM = """
  SELECT s.id, {pos} AS pos, e.value AS item
  FROM {source} AS s, json_each(CASE
      WHEN json_type({part}) = 'ARRAY' THEN {part}
      WHEN json_type({part}) = 'OBJECT' AND NOT list_has_any(json_keys({part}), [{marks}])
           AND len(list_filter(json_transform(json_extract({part}, '$.*'), '["JSON"]'), lambda x: json_type(x) NOT IN ('OBJECT', 'NULL'))) = 0 THEN {part}
      WHEN json_type({part}) = 'OBJECT' AND len(json_keys({part})) > 0 THEN json_array({part})
      ELSE '[]'::JSON END) AS e
  WHERE json_type(e.value) <> 'NULL'"""


def _level(source: str, pos: str, marks: list[str]) -> str:
    return _ITEM.format(source=source, pos=pos, part="s.part", marks=", ".join(f"'{m}'" for m in marks))


# the latest delivery of each asset; a JSON text that is itself held as a JSON string is unwrapped, twice if need be
_LEVELS = f"""
WITH latest AS (SELECT id, arg_max({{'j': json}}, coalesce(ingested_at, '0001-01-01'::TIMESTAMP)) AS d FROM media_assets WHERE id IS NOT NULL GROUP BY id),
read AS (SELECT id, d.j AS text, CASE WHEN json_valid(d.j) THEN d.j::JSON END AS j FROM latest),
once AS (SELECT id, text, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN (j ->> '$')::JSON END ELSE j END AS j FROM read),
twice AS (SELECT id, text, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN (j ->> '$')::JSON END ELSE j END AS j FROM once),
objects AS (SELECT id, j FROM twice WHERE json_type(j) = 'OBJECT'),
windows AS ({_level("(SELECT id, json_extract(j, '$.availability.windows') AS part FROM objects)", "e.key", ["territory", "from", "to", "offers"])}),
offers AS ({_level("(SELECT id, pos AS up, json_extract(item, '$.offers') AS part FROM windows)", "s.up || '.' || e.key", ["kind", "price", "devices"])}),
tiers AS ({_level("(SELECT id, json_extract(j, '$.quality.tiers') AS part FROM objects)", "e.key", ["label", "height", "hdr", "renditions"])}),
renditions AS ({_level("(SELECT id, pos AS up, json_extract(item, '$.renditions') AS part FROM tiers)", "s.up || '.' || e.key", ["codec", "kbps"])}),
credits AS ({_level("(SELECT id, json_extract(j, '$.metadata.credits') AS part FROM objects)", "e.key", ["name", "role"])}),
teams_at AS (SELECT market, unnest(range(len(entities.team))) AS i, unnest(entities.team) AS team FROM entities_v1),
aliases_at AS (SELECT market, i, unnest(range(len(team.aliases))) AS k, unnest(team.aliases) AS alias FROM teams_at)"""


def _table_sql(level: str, columns: list[str], below: str = "") -> str:
    """One of the flat tables: named leaves as columns, the other leaves as sorted path=value, without what stands below."""
    named = ", ".join(f"max(value) FILTER (path = '{c}') AS {''.join(x if x.isalnum() else '_' for x in c)}" for c in columns)
    other = ", ".join(f"'{c}'" for c in columns)
    apart = f" AND NOT regexp_matches(path, '^{below}($|[.\\[])')" if below else ""
    parent = "regexp_replace(pos, '[.][^.]*$', '')" if level in ("offers", "renditions") else "''"
    return f"""{_LEVELS},
leaves AS (SELECT s.id, s.pos, ltrim(substr(t.fullkey, 2), '.') AS path, CASE WHEN t.type = 'NULL' THEN NULL ELSE t.atom ->> '$' END AS value
  FROM {level} s, json_tree(s.item) t WHERE t.type NOT IN ('OBJECT', 'ARRAY')),
rows AS (SELECT id, pos, {named}, string_agg(CASE WHEN value IS NULL THEN path ELSE path || '=' || value END, ';' ORDER BY path) FILTER (path NOT IN ({other}){apart}) AS rest FROM leaves GROUP BY id, pos)
SELECT s.id AS record_id, s.pos, {parent.replace("pos", "s.pos")} AS parent_pos, r.* EXCLUDE (id, pos, rest), coalesce(r.rest, '') AS rest FROM {level} s LEFT JOIN rows r ON r.id = s.id AND r.pos = s.pos"""


ORACLE = {
    "p1_found": _LEVELS + """
SELECT id AS parent_id, 'window' AS child, pos FROM windows
UNION ALL SELECT id, 'offer', pos FROM offers
UNION ALL SELECT id, 'tier', pos FROM tiers
UNION ALL SELECT id, 'rendition', pos FROM renditions
UNION ALL SELECT id, 'credit', pos FROM credits
UNION ALL SELECT market, 'team_alias', i || '.' || k FROM aliases_at WHERE alias IS NOT NULL""",
    "p1_windows": _table_sql("windows", ["territory", "from", "to"], "offers"),
    "p1_offers": _table_sql("offers", ["kind", "price.amount", "price.currency", "devices[0]", "devices[1]", "devices[2]"]),
    "p1_tiers": _table_sql("tiers", ["label", "height", "hdr"], "renditions"),
    "p1_renditions": _table_sql("renditions", ["codec", "kbps"]),
    "p1_credits": _table_sql("credits", ["name", "role"]),
    "p1_teams": "SELECT market, i::VARCHAR AS pos, id, name FROM (SELECT market, unnest(range(len(entities.team))) AS i, unnest(entities.team, recursive := true) FROM entities_v1)",
    "p1_team_aliases": _LEVELS + " SELECT market, i || '.' || k AS pos, i::VARCHAR AS parent_pos, alias FROM aliases_at WHERE alias IS NOT NULL",
    "p1_unread": _LEVELS + """,
judged AS (SELECT id, CASE WHEN text IS NULL THEN 'null' WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'blank' WHEN j IS NULL THEN 'no JSON' ELSE 'no object' END AS reason FROM twice WHERE j IS NULL OR json_type(j) <> 'OBJECT')
SELECT reason, count(*) AS n_assets, min(id) AS least_id FROM judged GROUP BY reason""",
}
