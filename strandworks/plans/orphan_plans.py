"""Named queries of dangling references in the catalogue, the code export and the relationships between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orphans import replay, snapshot
from ..session import table

BATCHES = 3  # arrival windows of equal width in which the queries feed the state


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(lives, references): lives of entities (at all times), symbols (as exported) and teams, and every reference, each with the time it arrived."""
    never = F.lit(None).cast("timestamp")
    edges, symbols, entities, teams = (table(spark, sf_dir, name) for name in ("relationships", "code_symbols", "catalog_entities", "teams"))

    def lives(source: DataFrame, kind: str, key: str, born, died, seen) -> DataFrame:
        return source.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), born.cast("timestamp").alias("born"), died.cast("timestamp").alias("died"), seen.cast("timestamp").alias("seen_at"), seen.cast("timestamp").alias("arrived"))

    def refers(source: DataFrame, name: str, kind: str, fields: list[str], row_key: str, at: str, arrived: str) -> DataFrame:
        # one scan, however many fields refer
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("key")) for f in fields]))
        sides = source.select(F.col(row_key).cast("string").alias("row_key"), F.col(at).cast("timestamp").alias("at"), F.col(arrived).cast("timestamp").alias("arrived"), each.alias("_side"))
        return sides.select(F.lit(kind).alias("kind"), "_side.key", "at", F.lit(name).alias("table_name"), "row_key", "_side.field_name", "arrived")

    parents = [
        lives(entities, "node", "entity_id", never, never, never),
        lives(symbols, "node", "symbol_id", F.col("created_at"), F.col("deleted_at"), F.col("exported_at")),
        lives(teams, "team", "team_id", F.col("created_at"), F.col("retired_at"), never),
    ]
    references = [
        refers(edges, "relationships", "node", ["subject_id", "object_id"], "relationship_id", "recorded_at", "ingested_at"),
        refers(symbols, "code_symbols", "team", ["owner_team_id"], "export_row", "exported_at", "exported_at"),
        refers(entities, "catalog_entities", "team", ["owner_team_id"], "entity_id", "recorded_at", "recorded_at"),
    ]
    return reduce(DataFrame.unionByName, parents), reduce(DataFrame.unionByName, references)


def orphan_states(spark: SparkSession, sf_dir: str, batches: int = BATCHES) -> list[DataFrame]:
    """What dangles after each of the batches of equal arrival time in which both streams are fed to the state."""
    low, high = table(spark, sf_dir, "relationships").agg(F.min("ingested_at").cast("timestamp"), F.max("ingested_at").cast("timestamp")).first()
    cuts = [low + (high - low) * i / batches for i in range(1, batches)] if low is not None and low < high else []
    return replay(*arrivals(spark, sf_dir), "arrived", cuts)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference that dangles once all arrivals are known."""
    return orphan_states(spark, sf_dir)[-1].select("table_name", "row_key", "field_name", "reason")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dangling references per table, field, reason and month of the row's time."""
    return snapshot(orphan_states(spark, sf_dir)[-1], "month").withColumnRenamed("period", "month")


def p7_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts as they stood after each arrival batch, by year of the row's time."""
    counted = [snapshot(s, "year").withColumn("batch", F.lit(i)) for i, s in enumerate(orphan_states(spark, sf_dir), 1)]
    return reduce(DataFrame.unionByName, counted).select("batch", "table_name", "field_name", "reason", "period", "n_dangling")


QUERIES = {"p7_found": p7_found, "p7_report": p7_report, "p7_snapshots": p7_snapshots}

_FOUND_SQL = """
WITH symbols AS (
  SELECT symbol_id AS key, created_at AS born, arg_max(deleted_at_or, exported_at) AS died_or FROM (
    SELECT symbol_id, created_at, exported_at, {'d': deleted_at} AS deleted_at_or FROM code_symbols WHERE symbol_id IS NOT NULL) GROUP BY 1, 2),
lives AS (
  SELECT 'node' AS kind, entity_id AS key, NULL::TIMESTAMP AS born, NULL::TIMESTAMP AS died FROM catalog_entities
  UNION ALL SELECT 'node', key, born, died_or.d FROM symbols
  UNION ALL SELECT 'team', team_id, created_at, retired_at FROM teams),
refs AS (
  SELECT 'node' AS kind, 'relationships' AS table_name, relationship_id::VARCHAR AS row_key, 'subject_id' AS field_name, subject_id AS key, recorded_at AS ts FROM relationships
  UNION ALL SELECT 'node', 'relationships', relationship_id::VARCHAR, 'object_id', object_id, recorded_at FROM relationships
  UNION ALL SELECT 'team', 'code_symbols', export_row::VARCHAR, 'owner_team_id', owner_team_id, exported_at FROM code_symbols
  UNION ALL SELECT 'team', 'catalog_entities', entity_id, 'owner_team_id', owner_team_id, recorded_at FROM catalog_entities),
judged AS (
  SELECT r.kind, r.table_name, r.row_key, r.field_name, r.key, r.ts, count(l.key) AS n_lives,
    coalesce(bool_or((l.born IS NULL OR l.born <= r.ts) AND (l.died IS NULL OR r.ts < l.died)), FALSE) AS alive,
    coalesce(bool_and(l.born > r.ts), FALSE) AS all_later
  FROM refs r LEFT JOIN lives l ON l.kind = r.kind AND l.key = r.key WHERE r.key IS NOT NULL GROUP BY ALL),
found AS (
  SELECT table_name, row_key, field_name, ts,
    CASE WHEN n_lives = 0 THEN 'missing' WHEN ts IS NULL OR alive THEN NULL WHEN all_later THEN 'late' ELSE 'deleted' END AS reason
  FROM judged)
"""
ORACLE = {
    "p7_found": _FOUND_SQL + "SELECT table_name, row_key, field_name, reason FROM found WHERE reason IS NOT NULL",
    "p7_report": _FOUND_SQL + "SELECT table_name, field_name, reason, date_trunc('month', ts)::TIMESTAMP AS month, count(*) AS n_dangling FROM found WHERE reason IS NOT NULL GROUP BY ALL",
    "p7_snapshots": """
WITH ends AS (SELECT min(ingested_at) AS low, max(ingested_at) AS high FROM relationships),
cuts AS (SELECT i AS batch, CASE WHEN i < 3 THEN low + to_microseconds(round((epoch_us(high) - epoch_us(low)) * i / 3)::BIGINT) END AS cut FROM ends, (SELECT unnest([1, 2, 3]) AS i)),
came AS (SELECT batch, symbol_id AS key, created_at AS born, {'d': deleted_at} AS died, exported_at FROM code_symbols, cuts WHERE symbol_id IS NOT NULL AND (cut IS NULL OR exported_at IS NULL OR exported_at < cut)),
lives AS (
  SELECT batch, 'node' AS kind, entity_id AS key, NULL::TIMESTAMP AS born, NULL::TIMESTAMP AS died FROM catalog_entities, cuts
  UNION ALL SELECT batch, 'node', key, born, arg_max(died, exported_at).d FROM came GROUP BY ALL
  UNION ALL SELECT batch, 'team', team_id, created_at, retired_at FROM teams, cuts),
refs AS (
  SELECT 'node' AS kind, 'relationships' AS table_name, relationship_id::VARCHAR AS row_key, 'subject_id' AS field_name, subject_id AS key, recorded_at AS ts, ingested_at AS came FROM relationships
  UNION ALL SELECT 'node', 'relationships', relationship_id::VARCHAR, 'object_id', object_id, recorded_at, ingested_at FROM relationships
  UNION ALL SELECT 'team', 'code_symbols', export_row::VARCHAR, 'owner_team_id', owner_team_id, exported_at, exported_at FROM code_symbols
  UNION ALL SELECT 'team', 'catalog_entities', entity_id, 'owner_team_id', owner_team_id, recorded_at, recorded_at FROM catalog_entities),
asked AS (SELECT batch, refs.* FROM refs, cuts WHERE key IS NOT NULL AND (cut IS NULL OR came IS NULL OR came < cut)),
judged AS (
  SELECT a.batch, a.table_name, a.row_key, a.field_name, a.ts, count(l.key) AS n_lives,
    coalesce(bool_or((l.born IS NULL OR l.born <= a.ts) AND (l.died IS NULL OR a.ts < l.died)), FALSE) AS alive, coalesce(bool_and(l.born > a.ts), FALSE) AS all_later
  FROM asked a LEFT JOIN lives l ON l.batch = a.batch AND l.kind = a.kind AND l.key = a.key GROUP BY ALL),
found AS (SELECT *, CASE WHEN n_lives = 0 THEN 'missing' WHEN ts IS NULL OR alive THEN NULL WHEN all_later THEN 'late' ELSE 'deleted' END AS reason FROM judged)
SELECT batch::INTEGER AS batch, table_name, field_name, reason, date_trunc('year', ts)::TIMESTAMP AS period, count(*) AS n_dangling FROM found WHERE reason IS NOT NULL GROUP BY ALL""",
}
