"""The metadata graph: entities, relationships, evidence and what is built from a code export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse
from . import violations as v

# States, predicates and kinds that the catalogue knows.
STATUSES = ["verified", "inferred", "conflicting", "stale", "rejected"]
PREDICATES = ["IMPLEMENTS", "EXPOSES", "INVOKES", "PRODUCES", "CONSUMES", "READS_FROM", "WRITES_TO", "COMPUTES", "GOVERNED_BY", "OWNED_BY", "SUPERSEDES", "EVIDENCED_BY", "AVAILABLE_AS_TOOL"]
SYMBOL_KINDS = ["api_operation", "class", "event", "function", "method", "rule", "schema", "service", "workflow"]
EXPORT_STATUSES = ["verified", "inferred"]
EXPORT_PREDICATES = ["IMPLEMENTS", "EXPOSES", "INVOKES", "READS_FROM", "WRITES_TO", "COMPUTES", "PRODUCES", "CONSUMES"]


def entity_violations(entities: DataFrame) -> DataFrame:
    checks = v.filled("entity_id", "entity_type", "canonical_name", "display_name", "owner_team_id", "verification_status", "source_revision")
    checks |= {"aliases are filled": F.forall("aliases", lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")}
    checks |= v.one_of("verification_status", STATUSES)
    return v.together(v.rows_failing(entities, "entity_id", checks), v.repeated(entities, ["entity_id"], "entity_id is unique"))


def relationship_violations(edges: DataFrame, nodes: DataFrame, node_key: str) -> DataFrame:
    checks = v.filled("subject_id", "predicate", "object_id", "evidence_id", "verification_status") | v.one_of("predicate", PREDICATES) | v.one_of("verification_status", STATUSES)
    checks |= {"confidence is a share": F.col("confidence").between(0, 1)}
    dangling = [v.unknown_references(edges, "relationship_id", c, nodes, node_key) for c in ("subject_id", "object_id")]
    return v.together(v.rows_failing(edges, "relationship_id", checks), *dangling)


def export_violations(symbols: DataFrame) -> DataFrame:
    checks = v.filled("symbol_id", "kind", "name", "qualified_name", "language", "owner_team_id", "verification_status")
    checks |= v.one_of("kind", SYMBOL_KINDS) | v.one_of("verification_status", EXPORT_STATUSES) | v.safe_location("path", "line_start", "line_end")
    return v.together(v.rows_failing(symbols, "export_row", checks), v.repeated(symbols, ["symbol_id"], "symbol_id is unique"))


def isolation(first: DataFrame, second: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(kind, id) that stand in both catalogues, for each kind and its column."""
    return v.together(*[first.select(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id")).intersect(second.select(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id"))) for k, c in kinds.items()]).where("id IS NOT NULL")


def short_hash(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 20)


def export_evidence(symbols: DataFrame, revision: str) -> DataFrame:
    """Evidence of each symbol: id, label, sentence and place, with the state it was found in."""
    evidence = F.concat(F.lit("evidence:symbol:"), short_hash(F.col("symbol_id"), F.lit(revision)))
    return symbols.select(
        "symbol_id", evidence.alias("evidence_id"), F.upper(evidence).alias("citation_label"),
        F.concat_ws(" ", "kind", "qualified_name", F.lit("is defined at the cited location.")).alias("text"),
        F.format_string("repo://%s#L%d-L%d", "path", "line_start", "line_end").alias("source_uri"), "verification_status",
    )


def export_entities(symbols: DataFrame, revision: str) -> DataFrame:
    return symbols.select(
        F.col("symbol_id").alias("entity_id"), F.concat(F.lit("source_"), "kind").alias("entity_type"), F.col("qualified_name").alias("canonical_name"), F.col("name").alias("display_name"),
        F.array_join(F.array_sort(F.array_distinct(F.array("name", "qualified_name"))), "|").alias("aliases"), "owner_team_id", "verification_status", F.lit(revision).alias("source_revision"),
    )


def grounded(edges: DataFrame, nodes: DataFrame, evidence: DataFrame) -> DataFrame:
    """Edges whose subject, object and evidence are known, as a sentence with its citation.

    nodes has id and name, evidence has evidence_id and label; both have one row per id.
    """
    named = lambda c, n: nodes.select(F.col("id").alias(c), F.col("name").alias(n))
    joined = edges.join(named("subject_id", "_s"), "subject_id").join(named("object_id", "_o"), "object_id").join(evidence.select("evidence_id", "label"), "evidence_id")
    verb = F.lower(F.replace("predicate", F.lit("_"), F.lit(" ")))
    return joined.select("relationship_id", F.concat(F.col("_s"), F.lit(" "), verb, F.lit(" "), F.col("_o"), F.lit(".")).alias("answer"), F.col("label").alias("citation"))


def entity_predicates(edges: DataFrame, always: list[str]) -> DataFrame:
    """(entity_id, predicate): the predicates of all edges at an entity, at either end, and those that every entity has."""
    ends = F.explode(F.array("subject_id", "object_id")).alias("entity_id")
    seen = edges.select(ends, "predicate").where("entity_id IS NOT NULL AND predicate IS NOT NULL").distinct()
    fixed = seen.select("entity_id").distinct().withColumn("predicate", F.explode(F.array(*[F.lit(p) for p in always])))
    return seen.unionByName(fixed).distinct()


def ground(vocabulary: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mentions with the id that their surface names within their type: of entries with the same alias the last one counts.

    vocabulary has type, place, id, name and aliases; mentions has type and surface. Unknown surfaces get a null id.
    """
    forms = F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_form")
    index = vocabulary.select("type", "place", "id", forms).where("_form IS NOT NULL").groupBy("type", collapse(F.col("_form")).alias("_key")).agg(F.max_by("id", "place").alias("grounded_id"))
    return mentions.withColumn("_key", collapse(F.col("surface"))).join(index, ["type", "_key"], "left").drop("_key")
