"""Named queries of the catalogue: violations, isolation, evidence, grounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as c
from ..operators import violations as v
from ..session import table
from .sql import blank, collapse, listed

REVISION = "release-7"


def catalog_entity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.entity_violations(table(spark, sf_dir, "catalog_entities")).select("check", "row_key")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = table(spark, sf_dir, "catalog_entities").select(F.col("entity_id").alias("id"), F.col("display_name").alias("name"))
    return entities.unionByName(table(spark, sf_dir, "code_symbols").groupBy(F.col("symbol_id").alias("id")).agg(F.min("name").alias("name")))


def catalog_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.relationship_violations(table(spark, sf_dir, "relationships"), _nodes(spark, sf_dir), "id").groupBy("check").agg(F.count("*").alias("n"))


def catalog_dup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.repeated(table(spark, sf_dir, "relationships"), ["subject_id", "predicate", "object_id", "evidence_id"], "edge is unique")


def catalog_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "relationships")
    checks = {"confidence at least 0.5": F.col("confidence").between(0.5, 1)} | v.safe_location("source_path", "line_start", "line_end") | {"short range": F.col("line_end") - F.col("line_start") < 100}
    return v.rows_failing(edges, "relationship_id", checks).groupBy("check").agg(F.count("*").alias("n"))


def code_index_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.export_violations(table(spark, sf_dir, "code_symbols")).groupBy("check").agg(F.count("*").alias("n"), F.min("row_key").alias("least_key"))


def catalog_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "relationships")
    even = edges.where("relationship_id % 2 = 0")
    return c.isolation(even, edges.where("relationship_id % 2 = 1"), {"subject": "subject_id", "evidence": "evidence_id"})


def code_index_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.export_evidence(table(spark, sf_dir, "code_symbols"), REVISION).distinct()


def code_index_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.export_entities(table(spark, sf_dir, "code_symbols"), REVISION).distinct()


def grounded_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "relationships")
    labels = edges.where("evidence_id IS NOT NULL").select("evidence_id").distinct().withColumn("label", F.upper("evidence_id"))
    return c.grounded(edges, _nodes(spark, sf_dir), labels)


def entity_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.entity_predicates(table(spark, sf_dir, "relationships"), ["OWNED_BY", "EVIDENCED_BY"])


TYPES = ["team", "sport", "league", "genre", "language", "channel"]


def vocab_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions made of every alias, in capitals and with wide spaces, grounded again within their market."""
    rows, parts = table(spark, sf_dir, "entities_v1"), None
    for kind in TYPES:
        one = rows.select("market", F.posexplode(f"entities.{kind}").alias("place", "e")).select(F.concat_ws(":", "market", F.lit(kind)).alias("type"), "place", "e.id", "e.name", "e.aliases")
        parts = one if parts is None else parts.unionByName(one)
    said = parts.select("type", F.explode("aliases").alias("a")).where("a IS NOT NULL").select("type", F.replace(F.upper("a"), F.lit(" "), F.lit("  ")).alias("surface")).distinct()
    unknown = said.select("type", F.lit("nobody knows this").alias("surface")).distinct()
    return c.ground(parts, said.unionByName(unknown)).select("type", "surface", "grounded_id")


def tool_approval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples that call a tool, by whether the tool is approved: every tool but the last by name."""
    tool = F.get_json_object("action", "$.tool_call.tool")
    calls = table(spark, sf_dir, "enterprise_examples").select("example_id", tool.alias("tool")).where("tool IS NOT NULL")
    last = calls.agg(F.max("tool").alias("last"))
    approved = calls.select("tool").distinct().join(last, F.col("tool") == F.col("last"), "left_anti")
    return calls.join(approved.withColumn("approved", F.lit(True)), "tool", "left").groupBy("tool", F.coalesce("approved", F.lit(False)).alias("approved")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (catalog_entity_violations, catalog_fk_violations, catalog_dup_ids, catalog_range_violations, code_index_violations, catalog_isolation, code_index_evidence, code_index_entities, grounded_answer, entity_relationships, vocab_grounding, tool_approval)}


def _failing(source: str, key: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{name}' AS "check", {key}::VARCHAR AS row_key FROM {source} WHERE coalesce(NOT ({ok}), TRUE)""" for name, ok in checks.items())


def _filled(*columns: str) -> dict[str, str]:
    return {f"{x} is filled": f"NOT ({blank(x)})" for x in columns}


def _location(path: str) -> dict[str, str]:
    relative = f"NOT ({blank(path)}) AND NOT starts_with({path}, '/') AND NOT contains({path}, chr(92)) AND NOT list_contains(string_split({path}, '/'), '..') AND {path} <> '.'"
    return {"path is relative": relative, "lines are a range": "line_start >= 1 AND line_end >= line_start"}


_ENTITY = _filled("entity_id", "entity_type", "canonical_name", "display_name", "owner_team_id", "verification_status", "source_revision") | {
    "aliases are filled": "len(list_filter(aliases, lambda x: trim(coalesce(x, '')) = '')) = 0", "verification_status is known": f"coalesce(verification_status IN ({listed(c.STATUSES)}), FALSE)"}
_EDGE = _filled("subject_id", "predicate", "object_id", "evidence_id", "verification_status") | {
    "predicate is known": f"coalesce(predicate IN ({listed(c.PREDICATES)}), FALSE)", "verification_status is known": f"coalesce(verification_status IN ({listed(c.STATUSES)}), FALSE)", "confidence is a share": "confidence BETWEEN 0 AND 1"}
_SYMBOL = _filled("symbol_id", "kind", "name", "qualified_name", "language", "owner_team_id", "verification_status") | {
    "kind is known": f"coalesce(kind IN ({listed(c.SYMBOL_KINDS)}), FALSE)", "verification_status is known": f"coalesce(verification_status IN ({listed(c.EXPORT_STATUSES)}), FALSE)"} | _location("path")
_NODES = "nodes AS (SELECT entity_id AS id, display_name AS name FROM catalog_entities UNION ALL SELECT symbol_id, min(name) FROM code_symbols GROUP BY 1)"
_VOCAB = " UNION ALL ".join(f"SELECT market || ':{k}' AS type, unnest(range(len(entities.{k}))) AS place, unnest(entities.{k}) AS e FROM entities_v1" for k in TYPES)
_TOOLS = "calls AS (SELECT example_id, json_extract_string(action, '$.tool_call.tool') AS tool FROM enterprise_examples)"
ORACLE = {
    "catalog_entity_violations": _failing("catalog_entities", "entity_id", _ENTITY) + " UNION ALL SELECT 'entity_id is unique', entity_id FROM catalog_entities GROUP BY entity_id HAVING count(*) > 1",
    "catalog_fk_violations": f"""WITH {_NODES}, f AS ({_failing('relationships', 'relationship_id', _EDGE)} UNION ALL SELECT 'subject_id exists', relationship_id::VARCHAR FROM relationships WHERE subject_id IS NOT NULL AND subject_id NOT IN (SELECT id FROM nodes WHERE id IS NOT NULL)
        UNION ALL SELECT 'object_id exists', relationship_id::VARCHAR FROM relationships WHERE object_id IS NOT NULL AND object_id NOT IN (SELECT id FROM nodes WHERE id IS NOT NULL)) SELECT "check", count(*) AS n FROM f GROUP BY 1""",
    "catalog_dup_ids": """SELECT 'edge is unique' AS "check", concat_ws('|', coalesce(subject_id, ''), coalesce(predicate, ''), coalesce(object_id, ''), coalesce(evidence_id, '')) AS row_key, count(*) || ' rows' AS message FROM relationships GROUP BY subject_id, predicate, object_id, evidence_id HAVING count(*) > 1""",
    "catalog_range_violations": f"""SELECT "check", count(*) AS n FROM ({_failing('relationships', 'relationship_id', {'confidence at least 0.5': 'confidence BETWEEN 0.5 AND 1'} | _location('source_path') | {'short range': 'line_end - line_start < 100'})}) GROUP BY 1""",
    "code_index_violations": f"""WITH f AS ({_failing('code_symbols', 'export_row', _SYMBOL)} UNION ALL SELECT 'symbol_id is unique', symbol_id FROM code_symbols GROUP BY symbol_id HAVING count(*) > 1) SELECT "check", count(*) AS n, min(row_key) AS least_key FROM f GROUP BY 1""",
    "catalog_isolation": "SELECT * FROM (SELECT 'subject' AS kind, subject_id AS id FROM relationships WHERE relationship_id % 2 = 0 INTERSECT SELECT 'subject', subject_id FROM relationships WHERE relationship_id % 2 = 1) WHERE id IS NOT NULL UNION ALL SELECT * FROM (SELECT 'evidence' AS kind, evidence_id AS id FROM relationships WHERE relationship_id % 2 = 0 INTERSECT SELECT 'evidence', evidence_id FROM relationships WHERE relationship_id % 2 = 1) WHERE id IS NOT NULL",
    "code_index_evidence": f"WITH e AS (SELECT *, 'evidence:symbol:' || substr(sha256(symbol_id || '|{REVISION}'), 1, 20) AS evidence_id FROM code_symbols) SELECT DISTINCT symbol_id, evidence_id, upper(evidence_id) AS citation_label, concat_ws(' ', kind, qualified_name, 'is defined at the cited location.') AS text, 'repo://' || path || '#L' || line_start || '-L' || line_end AS source_uri, verification_status FROM e",
    "code_index_entities": f"SELECT DISTINCT symbol_id AS entity_id, 'source_' || kind AS entity_type, qualified_name AS canonical_name, name AS display_name, array_to_string(list_sort(list_distinct([name, qualified_name])), '|') AS aliases, owner_team_id, verification_status, '{REVISION}' AS source_revision FROM code_symbols",
    "grounded_answer": f"WITH {_NODES} SELECT r.relationship_id, s.name || ' ' || lower(replace(r.predicate, '_', ' ')) || ' ' || o.name || '.' AS answer, upper(r.evidence_id) AS citation FROM relationships r JOIN nodes s ON s.id = r.subject_id JOIN nodes o ON o.id = r.object_id WHERE r.evidence_id IS NOT NULL",
    "entity_relationships": "WITH e AS (SELECT subject_id AS entity_id, predicate FROM relationships UNION SELECT object_id, predicate FROM relationships), k AS (SELECT * FROM e WHERE entity_id IS NOT NULL AND predicate IS NOT NULL) SELECT * FROM k UNION SELECT entity_id, 'OWNED_BY' FROM k UNION SELECT entity_id, 'EVIDENCED_BY' FROM k",
    "vocab_grounding": f"""WITH v AS ({_VOCAB}), forms AS (SELECT type, place, e.id AS id, unnest(list_concat([e.name], coalesce(e.aliases, []))) AS form FROM v),
        idx AS (SELECT type, {collapse('form')} AS k, arg_max(id, place) AS grounded_id FROM forms WHERE form IS NOT NULL GROUP BY 1, 2), a AS (SELECT type, unnest(e.aliases) AS a FROM v),
        said AS (SELECT DISTINCT type, replace(upper(a), ' ', '  ') AS surface FROM a WHERE a IS NOT NULL), m AS (SELECT * FROM said UNION ALL SELECT DISTINCT type, 'nobody knows this' FROM said)
        SELECT m.type, surface, grounded_id FROM m LEFT JOIN idx ON idx.type = m.type AND idx.k = {collapse('surface')}""",
    "tool_approval": f"WITH {_TOOLS} SELECT tool, tool <> (SELECT max(tool) FROM calls) AS approved, count(*) AS n FROM calls WHERE tool IS NOT NULL GROUP BY 1, 2",
}
