"""Named queries of loose records, positional pairs, prompts and the log of failed queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import examples, text
from ..functions.records import parsed
from ..operators import ranking, rules
from ..session import table
from .media_plans import UTTERANCES, utterance_sql
from .sql import collapse


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows in four notations, by row: input and output, prompt and completion, messages, and odd ones."""
    rows = table(spark, sf_dir, "sft_rows")
    said = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    line = (
        F.when(F.col("row_id") % 4 == 0, F.to_json(F.struct("input", "output", F.col("source").alias("label")), {"ignoreNullFields": "false"}))
        .when(F.col("row_id") % 4 == 1, F.to_json(F.struct(F.col("input").alias("prompt"), F.col("output").alias("completion"), F.lit("").alias("label"), F.col("lang").alias("category")), {"ignoreNullFields": "false"}))
        .when(F.col("row_id") % 4 == 2, F.to_json(F.struct(F.array(said("system", "instruction"), said("user", "input"), said("assistant", "output")).alias("messages"), F.lit(False).alias("label"), F.lit(0).alias("action"), F.lit("chat").alias("intent"))))
        .otherwise(F.concat(F.lit("{"), "source"))
    )
    return rows.select("row_id", line.alias("line"), parsed(line).alias("value"))


def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input, output and label of the readable records, whatever their notation."""
    rows = _loose(spark, sf_dir).where("value IS NOT NULL")
    return rows.select("row_id", F.sha2(examples.input_of(F.col("value")), 256).alias("input_sha"), F.sha2(examples.output_of(F.col("value")), 256).alias("output_sha"), examples.label_of(F.col("value")).alias("label"))


def normalised_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media answers in one form, counted by intent, tool, quality asked for and whether they ask back."""
    rows = table(spark, sf_dir, "sft_rows").where("instruction LIKE '%media action%'").select(parsed(F.col("output")).alias("v")).where("v IS NOT NULL")
    each = rows.select(examples.normal_result(F.col("v")).alias("r"))
    return each.groupBy("r.intent", "r.tool", F.try_element_at("r.constraints", F.lit("quality")).alias("quality"), "r.clarification_required").agg(F.count("*").alias("n"), F.round(F.sum("r.confidence"), 4).alias("confidence"))


def positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test requests of each family paired by position, and whether their inputs are equal after normalisation."""
    rows = table(spark, sf_dir, "enterprise_examples").select("example_id", "split", "family", "user_input")
    sides = [ranking.global_rank(rows.where(F.col("split") == s).drop("split"), ["example_id"], ["family"], "pos").withColumnsRenamed({"example_id": f"{s}_id", "user_input": f"_{s}"}) for s in ("validation", "test")]
    pairs = sides[0].join(sides[1], ["family", "pos"])
    return pairs.select("family", "pos", "validation_id", "test_id", (text.collapse(F.col("_validation")) == text.collapse(F.col("_test"))).alias("same_input"))


def prompt_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blueprint instruction of the catalogue's predicates and tools: two small dimensions, spliced into a text."""
    predicates = table(spark, sf_dir, "relationships").select(F.lit("p").alias("k"), F.col("predicate").alias("v")).where("v IS NOT NULL").distinct()
    tools = table(spark, sf_dir, "enterprise_examples").select(F.lit("t").alias("k"), F.get_json_object("action", "$.tool_call.tool").alias("v")).where("v IS NOT NULL").distinct()
    both = predicates.unionByName(tools).groupBy().agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("k") == "p", F.col("v")))), ", ").alias("p"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("k") == "t", F.col("v")))), ", ").alias("t"))
    return both.select(F.concat(F.lit("Use only these relationships: "), "p", F.lit(". Read-only tools: "), F.coalesce(F.nullif("t", F.lit("")), F.lit("none")), F.lit(".")).alias("instruction"))


def failed_query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances that were understood too little, or need asking back: what the log appends."""
    rows = spark.createDataFrame(list(enumerate(UTTERANCES)), "i int, utterance string").withColumn("r", rules.parse_intent(F.col("utterance"), service=True))
    return rows.where((F.col("r.confidence") < 0.6) | F.col("r.clarification_required")).select("i", "r.intent", "r.confidence")


def intent_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the rules give the intent, and the language, that media-action rows state."""
    rows = table(spark, sf_dir, "sft_rows").where("instruction LIKE '%media action%' AND try_parse_json(output) IS NOT NULL AND startswith(output, '{')")
    judged = rows.select(rules.parse_intent(F.col("input")).alias("r"), F.get_json_object("output", "$.intent").alias("intent"), F.get_json_object("output", "$.constraints.language").alias("language"))
    n = F.count("*")
    spoken = F.try_element_at("r.constraints", F.lit("language"))
    return judged.agg(n.alias("n"), F.count_if(F.col("r.intent") == F.col("intent")).alias("intent_correct"), F.count_if(spoken.eqNullSafe(F.col("language"))).alias("language_correct"), F.round(F.avg((F.col("r.intent") == F.col("intent")).cast("double")), 6).alias("intent_accuracy"))


QUERIES = {f.__name__: f for f in (message_fields, normalised_results, positional_pairs, prompt_templates, failed_query_log, intent_metrics)}
ORACLE = {
    "message_fields": """SELECT row_id, sha256(CASE row_id % 4 WHEN 2 THEN instruction || chr(10) || input ELSE coalesce(input, 'None') END) AS input_sha, sha256(CASE WHEN row_id % 4 = 2 THEN coalesce(output, '') ELSE coalesce(output, 'None') END) AS output_sha,
        CASE row_id % 4 WHEN 0 THEN nullif(source, '') WHEN 1 THEN lang ELSE 'chat' END AS label FROM sft_rows WHERE row_id % 4 < 3""",
    "normalised_results": """WITH r AS (SELECT output::JSON AS v FROM sft_rows WHERE instruction LIKE '%media action%' AND json_valid(output)), o AS (SELECT * FROM r WHERE json_type(v) IS NOT NULL)
        SELECT v ->> '$.intent' AS intent, v ->> '$.tool' AS tool, v ->> '$.constraints.quality' AS quality, coalesce((v ->> '$.clarification_required') = 'true', FALSE) AS clarification_required, count(*) AS n, round(sum(coalesce(TRY_CAST(v ->> '$.confidence' AS DOUBLE), 0.0)), 4) AS confidence FROM o GROUP BY 1, 2, 3, 4""",
    "positional_pairs": f"""WITH r AS (SELECT example_id, split, family, {collapse('user_input')} AS t, row_number() OVER (PARTITION BY split, family ORDER BY example_id) - 1 AS pos FROM enterprise_examples)
        SELECT a.family, a.pos, a.example_id AS validation_id, b.example_id AS test_id, a.t = b.t AS same_input FROM r a JOIN r b ON a.family = b.family AND a.pos = b.pos WHERE a.split = 'validation' AND b.split = 'test'""",
    "prompt_templates": """SELECT 'Use only these relationships: ' || (SELECT string_agg(p, ', ' ORDER BY p) FROM (SELECT DISTINCT predicate AS p FROM relationships WHERE predicate IS NOT NULL)) || '. Read-only tools: ' ||
        coalesce((SELECT string_agg(t, ', ' ORDER BY t) FROM (SELECT DISTINCT json_extract_string(action, '$.tool_call.tool') AS t FROM enterprise_examples) WHERE t IS NOT NULL), 'none') || '.' AS instruction""",
    "failed_query_log": f"SELECT i, intent, confidence FROM ({utterance_sql(True)}) WHERE confidence < 0.6 OR clarification_required",
    "intent_metrics": f"""WITH g AS (SELECT row_id AS i, input AS utterance, output ->> '$.intent' AS wanted, output ->> '$.constraints.language' AS spoken FROM sft_rows WHERE instruction LIKE '%media action%' AND json_valid(output) AND starts_with(output, '{{')),
        p AS ({utterance_sql(False, 'g')}) SELECT count(*) AS n, count_if(p.intent = g.wanted) AS intent_correct, count_if(nullif(regexp_extract(p.constraints, 'language=([a-z]+)', 1), '') IS NOT DISTINCT FROM g.spoken) AS language_correct, round(avg((p.intent = g.wanted)::INT), 6) AS intent_accuracy FROM g JOIN p ON p.i = g.i""",
}
