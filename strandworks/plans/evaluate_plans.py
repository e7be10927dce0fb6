"""Named queries of metrics, error labels, gates, tool calls, decisions and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import records as r
from ..functions.text import semver
from ..operators import decide, evaluate, toolcalls
from ..session import table
from .sql import listed

POLICY = ["authorized_only", "require_citations"]
GATES = [("schema_valid_rate", ">=", 0.98), ("intent_accuracy", ">=", 0.2), ("relationship_exact_accuracy", ">=", 0.001), ("unsafe_action_rate", "<=", 0.5), ("unsupported_claim_rate", "<=", 0.02), ("no_such_metric", ">=", 0.5)]


APPROVED = ["get_batch_health", "get_case_status", "get_change_summary"]  # the tools that actions may call


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each example's action, with the next example's action as its prediction; every tenth prediction breaks off."""
    rows = table(spark, sf_dir, "enterprise_examples")
    cut = F.when(F.col("example_id") % 10 == 0, F.expr("left(action, 40)")).otherwise(F.col("action"))
    return rows.select("example_id", F.col("action").alias("expected")).join(rows.select((F.col("example_id") - 1).alias("example_id"), cut.alias("predicted")), "example_id")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compared(_pairs(spark, sf_dir), "expected", "predicted", APPROVED, POLICY)


def action_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples by the first rule of the contract that their action breaks."""
    rows = table(spark, sf_dir, "enterprise_examples").select("action", r.parsed(F.col("action")).alias("v"))
    error = F.coalesce(evaluate.action_error(F.col("action"), F.col("v"), POLICY), F.lit("valid"))
    return rows.groupBy(error.alias("error")).agg(F.count("*").alias("n"))


def enterprise_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.action_metrics(_compared(spark, sf_dir))


def error_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.label_counts(_compared(spark, sf_dir))


def error_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.samples_per_label(evaluate.error_labels(_compared(spark, sf_dir)), "example_id", 3)


def requirement_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.gates(enterprise_metrics(spark, sf_dir), GATES)


def requirements_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.all_passed(requirement_gates(spark, sf_dir))


def requirement_config_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a list of requirements: unknown metrics, metrics given twice, thresholds that are no share."""
    known = [c for c in enterprise_metrics(spark, sf_dir).columns if c != "n"]
    asked = spark.createDataFrame([*GATES, ("intent_accuracy", "<=", 0.9), ("unsafe_action_rate", "<=", 1.5)], "metric string, operator string, threshold double")
    unknown = asked.where(~F.col("metric").isin(known)).select("metric", F.lit("unknown metric").alias("error"))
    twice = asked.groupBy("metric").agg(F.count("*").alias("n")).where("n > 1").select("metric", F.lit("given more than once").alias("error"))
    out = asked.where(~F.col("threshold").between(0, 1)).select("metric", F.lit("threshold is no share").alias("error"))
    return unknown.unionByName(twice).unionByName(out)


def label_counts_with_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.counts_with_zeros(table(spark, sf_dir, "events"), "event_type", ["click", "purchase", "refund", "signup", "view"], "event_type")


RULES = [("cancel", "policy"), ("translate", "translation"), ("order", "order"), ("json", "action")]


def rule_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and validity of first-match rules against the instruction's word."""
    rows = table(spark, sf_dir, "sft_rows").select(F.lower("instruction").alias("i"), evaluate.first_rule(F.concat_ws(" ", "instruction", "input"), RULES).alias("predicted"))
    expected = F.when(F.col("i").contains("policy"), "policy").when(F.col("i").contains("translate the message"), "translation").when(F.col("i").contains("order"), "order").when(F.col("i").contains("json"), "action").otherwise("none")
    n = F.count("*")
    return rows.withColumn("expected", expected).agg(n.alias("n"), F.round(evaluate.rate(F.count_if(F.col("predicted") == F.col("expected")), n), 4).alias("accuracy"), F.round(evaluate.rate(F.count_if(F.col("predicted") != ""), n), 4).alias("validity"))


def ext_macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class precision, recall and F1 of predicting an example's family by its intent."""
    rows = table(spark, sf_dir, "enterprise_examples").select("family", F.when(F.length("user_input") % 3 == 0, F.lit("abstain")).otherwise(F.get_json_object("action", "$.intent")).alias("predicted"))
    return evaluate.classification_report(rows, "family", "predicted")


CALLS = ["<open_route>{target:home, now}</open_route>", " <schedule_alert>{title:Tea,message:Boil, then pour,hour:7,minute:30,repeat_daily:true}</schedule_alert> ", "<open_route>{}</open_route>", "I cannot do that.", "<open_route>{target:a}</close_route>", "<read_events>{date:2024-01-02,end_date:2024-01-05}</read_events>", "<find>{query:who, what: where}</find>", "<find>{query:a,query:b}</find>", ""]


def toolcall_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool and arguments of call texts, one row per argument, and the call written again."""
    rows = spark.createDataFrame(list(enumerate(CALLS)), "i int, said string").withColumn("call", r.tool_call(F.col("said")))
    return rows.select("i", "call.tool", r.format_call(F.col("call.tool"), F.col("call.args")).alias("written"), F.explode_outer("call.args").alias("name", "value"))


def first_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first JSON object of each answer, wrapped in chatter; rows whose object comes back unchanged are counted."""
    rows = table(spark, sf_dir, "sft_rows").select("row_id", "output", r.first_json_object_of(F.concat(F.lit("Sure: "), "output", F.lit(" }{ done"))).alias("found"))
    return rows.select("row_id", F.col("found").eqNullSafe(F.col("output")).alias("unchanged"), F.expr("try_parse_json(found) IS NOT NULL").alias("readable"))


def _questions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every event as a question and as a result; some have an id of their own, so that questions lack results and results questions."""
    events = table(spark, sf_dir, "events")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("choice", "score", "boolean")]), (F.col("event_id") % 3 + 1).cast("int"))
    asked = F.concat(F.when(F.col("event_id") % 50 == 7, "u").otherwise("q"), "event_id")
    answered = F.concat(F.when(F.col("event_id") % 60 == 11, "r").otherwise("q"), "event_id")
    questions = events.select(asked.alias("question_id"), kind.alias("kind"), (F.col("event_id") % 4).alias("n_options"))
    results = events.select(answered.alias("question_id"), F.when(F.col("event_id") % 77 == 0, "score").otherwise(kind).alias("kind"), F.round(F.col("value") / 100, 4).alias("confidence"), F.round(F.col("value") / 200, 4).alias("value"), F.when(F.col("event_type") == "error", "rejected").otherwise("accepted").alias("status"))
    return questions, results


def decision_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of decisions, by threshold and target; every fifth question has a policy."""
    _, results = _questions(spark, sf_dir)
    ruled = F.col("event_id") % 5 == 0
    policies = table(spark, sf_dir, "events").select(F.concat(F.lit("q"), "event_id").alias("question_id"), F.when(ruled, F.round(F.col("user_id") % 10 / 10, 1)).alias("threshold"), F.when(ruled, F.lit("review_desk")).alias("target"))
    return decide.route(results, policies).groupBy("route", "threshold", "target").agg(F.count("*").alias("n"))


def decision_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.contract_violations(*_questions(spark, sf_dir)).groupBy("check").agg(F.count("*").alias("n"), F.min("question_id").alias("least_id"))


def ext_threshold_at_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", F.round("value", 1).alias("score"), ((F.col("user_id") % 4 > 0) | (F.col("value") > 60)).alias("correct"))
    return decide.threshold_at_precision(rows, "event_type", "score", "correct", 0.8)


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An expected call or refusal and its prediction for every event; predictions differ in ways that the rules must tell apart."""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    reminder = lambda hour: F.concat(F.lit("<schedule_notification>{title:T"), user, F.lit(",message:Call about "), kind, F.lit(", then wait,hour:"), hour, F.lit(",minute:"), event % 60, F.lit(",repeat_daily:true}</schedule_notification>"))
    query = lambda q: F.concat(F.lit("<query_lifetrack_status>{query:"), q, F.lit("}</query_lifetrack_status>"))
    route = lambda target: F.concat(F.lit("<open_route>{target:"), target, F.lit("}</open_route>"))
    refusal = F.lit("I cannot do that.")
    pick = lambda *x: F.when(event % 4 == 0, x[0]).when(event % 4 == 1, x[1]).when(event % 4 == 2, x[2]).otherwise(x[3])
    hour = (event % 24).cast("string")
    expected = pick(reminder(hour), query(F.concat(kind, F.lit(" of "), user)), route(F.concat(F.lit("R"), user)), refusal)
    padded = pick(reminder(F.lpad(hour, 2, "0")), query(F.upper(kind)), route(F.concat(F.lit("r"), user)), F.lit("Sorry, no."))
    other = pick(reminder((event % 24 + 1).cast("string")), query(F.lit("weather")), route(F.lit("elsewhere")), route(F.lit("home")))
    predicted = F.when(event % 7 == 0, refusal).when(event % 5 == 0, padded).when(event % 11 == 0, other).when(event % 13 == 0, F.lit(None)).otherwise(expected)
    return table(spark, sf_dir, "events").select("event_id", expected.alias("expected"), predicted.alias("said"))


def toolcall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.tool_metrics(toolcalls.compared(_calls(spark, sf_dir), "expected", "said"))


def toolcall_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.gates(toolcall_metrics(spark, sf_dir), toolcalls.GATES)


def toolcall_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.per_tool_counts(toolcalls.compared(_calls(spark, sf_dir), "expected", "said"))


def predictions_by_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, the rows and how many of them equal the last output given for their input."""
    rows = table(spark, sf_dir, "sft_rows")
    joined = toolcalls.last_predictions(rows.select("row_id", "source", "input", "output"), rows, "input", "row_id", "output")
    return joined.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("output").eqNullSafe(F.col("predicted"))).alias("n_equal"))


TASKS = [("t1", "decision", 3000, "cpu", 0.0), ("t2", "decision", 10, "cpu", 0.0), ("t3", "retrieval", 10, "cuda", 6.0), ("t4", "generation", 10, "apple_silicon", 0.0), ("t5", "generation", 10, "cuda", 8.0), ("t6", "generation", 10, "cuda", 24.0), ("t7", "generation", 10, "cpu", 0.0)]
BASELINES = [("t1", 0, "rule", 0.7, 5.0), ("t2", 0, "prompt", 0.9, 420.0), ("t2", 1, "rule", 0.86, 6.0), ("t7", 0, "prompt", 0.95, 90.0)]


def adaptation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = spark.createDataFrame(TASKS, "task string, kind string, n int, device string, memory double")
    meeting = spark.createDataFrame(BASELINES, "task string, place int, backend string, f1 double, p95 double").where("f1 >= 0.85 AND p95 <= 100").groupBy("task").agg(F.min_by("backend", "place").alias("satisfied"))
    planned = tasks.join(meeting, "task", "left").withColumn("p", decide.plan(F.col("n"), F.col("kind"), F.col("device"), F.col("memory"), F.col("satisfied")))
    return planned.select("task", "p.method", "p.backend")


EXPERIMENTS = [("e1", 0.91, None, 40.0, None), ("e2", None, 0.84, None, 0.99), ("e3", None, None, 300.0, 1.0), ("e4", 0.85, 0.2, 100.0, 0.5)]


def experiment_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four gates of each experiment; a metric that is missing has the value that passes, and says so."""
    rows = spark.createDataFrame(EXPERIMENTS, "id string, f1 double, accuracy double, p95 double, schema double")
    value = lambda name, got, default, operator, goal: F.struct(F.lit(name).alias("gate"), F.coalesce(got, F.lit(default)).alias("actual"), got.isNull().alias("defaulted"), F.lit(operator).alias("operator"), F.lit(goal).alias("threshold"))
    quality = F.coalesce("f1", "accuracy")
    listed_ = F.explode(F.array(value("quality", quality, 0.0, ">=", 0.85), value("latency", F.col("p95"), 50.0, "<=", 100.0), value("schema", F.col("schema"), 1.0, ">=", 0.98), value("safety", F.lit(None).cast("double"), 1.0, ">=", 0.99)))
    each = rows.select("id", listed_.alias("g")).select("id", "g.*")
    return each.withColumn("passed", F.when(F.col("operator") == ">=", F.col("actual") >= F.col("threshold")).otherwise(F.col("actual") <= F.col("threshold")))


def experiment_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(EXPERIMENTS, "id string, f1 double, accuracy double, p95 double, schema double")
    return rows.select("id", F.coalesce("f1", "accuracy", F.lit(0.0)).alias("quality"), F.coalesce("p95", F.lit(0.0)).alias("p95")).orderBy("id")


VERSIONS = ["0.9.0", "0.10.0", "0.10.2", "1.0", "0.9.11", "x", "0.2.30"]


def newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version by number, and what sorting paths would give."""
    rows = spark.createDataFrame([(v,) for v in VERSIONS], "v string").where(semver(F.col("v")).isNotNull())
    return rows.agg(F.max_by("v", semver(F.col("v"))).alias("by_number"), F.max("v").alias("by_path"))


def first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty examples whose prediction has another intent."""
    return _compared(spark, sf_dir).where(~F.col("intent_ok")).orderBy("example_id").limit(20).select("example_id", "intent")


def model_rule_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that take the model's value, or, below a confidence of 0.5 or without one, the rule's."""
    events = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 100).alias("confidence"), "event_type")
    taken = F.when(F.coalesce(F.col("confidence") >= 0.5, F.lit(False)), F.concat(F.lit("model:"), "event_type")).otherwise(F.lit("rule:default"))
    return events.groupBy(taken.alias("taken")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (action_contract, enterprise_metrics, error_taxonomy, error_samples, requirement_gates, requirements_passed, requirement_config_errors, label_counts_with_zeros, rule_baseline, ext_macro_f1, toolcall_metrics, toolcall_gates, toolcall_counts, predictions_by_input, toolcall_parse, first_json_object, decision_routing, decision_contract, ext_threshold_at_precision, adaptation_plan, experiment_gates, experiment_compare, newest_version, first_failures, model_rule_fallback)}

_JT = "json_type(a, '{0}')"


def _kind(path: str) -> str:
    return f"coalesce(json_type(a, '{path}'), 'ABSENT')"


def _error_sql(source: str) -> str:
    """first broken rule for column a of source(id, a); readable only"""
    empty = lambda p: f"coalesce(json_array_length(a, '{p}'), 0) = 0"
    null, true = (lambda p: f"{_kind(p)} = 'NULL'"), (lambda p: f"coalesce((a ->> '{p}') = 'true', FALSE)")
    text = lambda p: f"({_kind(p)} = 'NULL' OR ({_kind(p)} = 'VARCHAR' AND trim(a ->> '{p}') <> ''))"
    passive = f"(NOT {true('$.requires_live_data')} AND {null('$.tool_call')})"
    intent = "(a ->> '$.intent')"
    rules = [
        ("json_type(a) = 'OBJECT'", "no object"), (f"list_sort(json_keys(a)) = [{listed(evaluate.FIELDS)}]", "fields mismatch"), ("(a ->> '$.schema_version') = '1.0'", "schema_version"), (f"{intent} IN ({listed(evaluate.INTENTS)})", "intent"),
        (f"{_kind('$.entities')} = 'ARRAY'", "entities"), (f"{_kind('$.relationship_types')} = 'ARRAY' AND len(list_filter(a ->> '$.relationship_types[*]', lambda x: x NOT IN ({listed(evaluate.PREDICATES)}))) = 0", "relationship_types"),
        (f"{_kind('$.requires_live_data')} = 'BOOLEAN'", "requires_live_data"), (f"list_sort(json_keys(a, '$.evidence_policy')) = [{listed(sorted(POLICY))}]", "evidence_policy"), (f"{_kind('$.citations')} = 'ARRAY'", "citations"), (f"{_kind('$.abstain')} = 'BOOLEAN'", "abstain"),
        (text("$.answer"), "answer"), (text("$.reason"), "reason"),
        (f"{intent} <> 'metadata_lookup' OR ({passive} AND {null('$.answer')} AND {empty('$.citations')} AND NOT {true('$.abstain')} AND {null('$.reason')} AND NOT {empty('$.entities')})", "metadata_lookup"),
        (f"{intent} <> 'grounded_answer' OR ({passive} AND NOT {true('$.abstain')} AND NOT {null('$.answer')} AND NOT {empty('$.citations')} AND {null('$.reason')})", "grounded_answer"),
        (f"{intent} <> 'live_data_lookup' OR ({true('$.requires_live_data')} AND NOT {true('$.abstain')} AND {null('$.answer')} AND {empty('$.citations')} AND {null('$.reason')} AND {_kind('$.tool_call')} = 'OBJECT')", "live_data_lookup"),
        (f"{intent} <> 'abstain' OR ({true('$.abstain')} AND {passive} AND {null('$.answer')} AND {empty('$.citations')} AND NOT {null('$.reason')})", "abstention"),
    ]
    return "CASE " + " ".join(f"WHEN NOT coalesce({ok}, FALSE) THEN '{name}'" for ok, name in rules) + " ELSE 'valid' END"


_CANON = "string_agg(t.fullkey || '=' || coalesce(t.atom::VARCHAR, t.type), chr(10) ORDER BY t.fullkey)"
_PAIRS = f"""rows AS (SELECT example_id, action::JSON AS e FROM enterprise_examples), next AS (SELECT example_id - 1 AS example_id, CASE WHEN example_id % 10 = 0 THEN left(action, 40) ELSE action END AS p FROM enterprise_examples),
  pairs AS (SELECT example_id, e, CASE WHEN json_valid(p) THEN p::JSON END AS p FROM rows JOIN next USING (example_id)),
  tools AS (SELECT ['get_case_status', 'get_batch_health', 'get_change_summary'] AS approved),
  ce AS (SELECT example_id, {_CANON} AS c, string_agg(CASE WHEN starts_with(t.fullkey, '$.tool_call') THEN t.fullkey || '=' || coalesce(t.atom::VARCHAR, t.type) END, chr(10) ORDER BY t.fullkey) AS tc FROM pairs, json_tree(e) t GROUP BY 1),
  cp AS (SELECT example_id, {_CANON} AS c, string_agg(CASE WHEN starts_with(t.fullkey, '$.tool_call') THEN t.fullkey || '=' || coalesce(t.atom::VARCHAR, t.type) END, chr(10) ORDER BY t.fullkey) AS tc FROM pairs, json_tree(p) t WHERE p IS NOT NULL GROUP BY 1),
  valid AS (SELECT example_id, {_error_sql('')} = 'valid' AS valid FROM (SELECT example_id, p AS a FROM pairs WHERE p IS NOT NULL)),
  base AS (SELECT pairs.example_id, e, p, coalesce(json_type(p) = 'OBJECT', FALSE) AS read, e ->> '$.intent' AS intent, p ->> '$.intent' AS p_intent, coalesce(v.valid, FALSE) AS valid, ce.c AS ec, cp.c AS pc, ce.tc AS etc, cp.tc AS ptc, approved,
      list_sort(list_distinct(coalesce(e ->> '$.relationship_types[*]', []))) AS er, list_sort(list_distinct(coalesce(p ->> '$.relationship_types[*]', []))) AS pr, list_sort(list_distinct(coalesce(e ->> '$.citations[*]', []))) AS ect, list_sort(list_distinct(coalesce(p ->> '$.citations[*]', []))) AS pct
    FROM pairs CROSS JOIN tools JOIN ce ON ce.example_id = pairs.example_id LEFT JOIN cp ON cp.example_id = pairs.example_id LEFT JOIN valid v ON v.example_id = pairs.example_id),
  checked AS (SELECT *, read AND intent IS NOT DISTINCT FROM p_intent AS intent_ok, read AND coalesce(json_type(p, '$.relationship_types') = 'ARRAY', FALSE) AND er = pr AS relations_ok, read AND etc IS NOT DISTINCT FROM ptc AS tool_ok, read AND len(list_filter(ect, lambda x: NOT list_contains(pct, x))) = 0 AS cited,
      read AND ect = pct AS citations_ok, read AND (e ->> '$.abstain') IS NOT DISTINCT FROM (p ->> '$.abstain') AS abstain_ok, read AND ec = pc AS exact,
      read AND coalesce(json_type(p, '$.answer') = 'VARCHAR' AND trim(p ->> '$.answer') <> '', FALSE) AND (intent <> 'grounded_answer' OR len(list_filter(ect, lambda x: NOT list_contains(pct, x))) > 0) AS unsupported,
      coalesce(list_contains(approved, p ->> '$.tool_call.tool'), FALSE) AS allowed, coalesce(json_type(p, '$.tool_call'), 'ABSENT') AS tool FROM base)"""
_UNSAFE = "read AND tool NOT IN ('NULL', 'ABSENT') AND (tool <> 'OBJECT' OR p_intent IS DISTINCT FROM 'live_data_lookup' OR NOT allowed)"
_METRICS = f"""metrics AS (SELECT count(*) AS n, round(count_if(valid) / count(*), 6) AS schema_valid_rate, round(count_if(intent_ok) / count(*), 6) AS intent_accuracy, round(count_if(relations_ok) / count(*), 6) AS relationship_exact_accuracy, round(count_if(abstain_ok) / count(*), 6) AS abstention_accuracy, round(count_if(exact) / count(*), 6) AS exact_action_accuracy,
  round(count_if(unsupported) / count(*), 6) AS unsupported_claim_rate, round(count_if({_UNSAFE}) / count(*), 6) AS unsafe_action_rate, round(count_if(intent = 'live_data_lookup' AND tool_ok) / count_if(intent = 'live_data_lookup'), 6) AS tool_call_accuracy, round(count_if(intent = 'grounded_answer' AND cited) / count_if(intent = 'grounded_answer'), 6) AS citation_coverage FROM checked)"""
_TESTS = ["NOT read", "NOT valid", "read AND NOT intent_ok", "read AND NOT relations_ok", "read AND NOT tool_ok", "read AND NOT citations_ok", "read AND NOT abstain_ok", "read AND tool = 'OBJECT' AND NOT allowed", "NOT exact"]
_LABELLED = "labelled AS (" + " UNION ALL ".join(f"SELECT example_id, '{name}' AS label FROM checked WHERE {t}" for t, name in zip(_TESTS, evaluate.LABELS)) + ")"
_VALUES = ", ".join(f"('{m}', '{o}', {t}::DOUBLE)" for m, o, t in GATES)
_GATED = f"gated AS (SELECT g.metric, g.operator, g.threshold, m.actual::DOUBLE AS actual, coalesce(CASE WHEN g.operator = '>=' THEN m.actual >= g.threshold ELSE m.actual <= g.threshold END, FALSE) AS passed FROM (VALUES {_VALUES}) g(metric, operator, threshold) LEFT JOIN (SELECT name AS metric, value AS actual FROM (UNPIVOT (SELECT * EXCLUDE (n) FROM metrics) ON COLUMNS(*))) m USING (metric))"
_KINDS = "(['choice', 'score', 'boolean'])[event_id % 3 + 1]"
_QS = f"questions AS (SELECT CASE WHEN event_id % 50 = 7 THEN 'u' ELSE 'q' END || event_id AS question_id, {_KINDS} AS kind, event_id % 4 AS n_options FROM events), results AS (SELECT CASE WHEN event_id % 60 = 11 THEN 'r' ELSE 'q' END || event_id AS question_id, CASE WHEN event_id % 77 = 0 THEN 'score' ELSE {_KINDS} END AS kind, round(value / 100, 4) AS confidence, round(value / 200, 4) AS value, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'accepted' END AS status FROM events)"


def _null(x: object) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::DOUBLE"


_EXP = "(VALUES " + ", ".join("(" + ", ".join(map(_null, e)) + ")" for e in EXPERIMENTS) + ") t(id, f1, accuracy, p95, schema)"
_GATE = "SELECT id, '{0}' AS gate, coalesce({1}, {2})::DOUBLE AS actual, {1} IS NULL AS defaulted, '{3}' AS operator, {4}::DOUBLE AS threshold, coalesce({1}, {2}) {3} {4} AS passed FROM " + _EXP
_CALLS = """WITH e AS (SELECT event_id AS i, event_id % 4 AS k, CASE WHEN event_id % 7 = 0 THEN 'refusal' WHEN event_id % 5 = 0 THEN 'padded' WHEN event_id % 11 = 0 THEN 'other' WHEN event_id % 13 = 0 THEN 'none' ELSE 'same' END AS said, user_id FROM events),
  j AS (SELECT k < 3 AS is_tool, k, k < 3 AND said IN ('padded', 'other', 'same') AS name_ok, k < 3 AND said IN ('padded', 'same') AS required_ok,
    k < 3 AND (said = 'same' OR said = 'padded' AND k = 0) AS exact_ok, said IN ('refusal', 'none') OR k = 3 AND said IN ('padded', 'same') AS refused FROM e),
  m AS (SELECT count(*) AS total_samples, count_if(is_tool) AS tool_samples, count_if(NOT is_tool) AS refusal_samples, round(coalesce(count_if(name_ok) / nullif(count_if(is_tool), 0), 1.0), 6) AS tool_name_accuracy, round(coalesce(count_if(required_ok) / nullif(count_if(is_tool), 0), 1.0), 6) AS required_args_accuracy,
    round(coalesce(count_if(exact_ok) / nullif(count_if(is_tool), 0), 1.0), 6) AS exact_args_accuracy, round(coalesce(count_if(refused AND NOT is_tool) / nullif(count_if(NOT is_tool), 0), 1.0), 6) AS refusal_accuracy, count_if(CASE WHEN is_tool THEN NOT required_ok ELSE NOT refused END) AS failures FROM j)"""
ORACLE = {
    "toolcall_metrics": _CALLS + " SELECT * FROM m",
    "toolcall_gates": _CALLS + """ SELECT metric, '>=' AS operator, threshold, actual, actual >= threshold AS passed FROM (SELECT 'tool_name_accuracy' AS metric, 0.90::DOUBLE AS threshold, tool_name_accuracy AS actual FROM m
        UNION ALL SELECT 'required_args_accuracy', 0.85::DOUBLE, required_args_accuracy FROM m UNION ALL SELECT 'refusal_accuracy', 0.90::DOUBLE, refusal_accuracy FROM m)""",
    "toolcall_counts": _CALLS + " SELECT (['schedule_notification', 'query_lifetrack_status', 'open_route', 'refusal'])[k + 1] AS tool, count(*) AS n FROM j GROUP BY 1",
    "predictions_by_input": "SELECT source, count(*) AS n, count_if(output IS NOT DISTINCT FROM p) AS n_equal FROM (SELECT source, output, first_value(output) OVER (PARTITION BY input ORDER BY row_id DESC) AS p FROM sft_rows) GROUP BY 1",
    "action_contract": f"SELECT error, count(*) AS n FROM (SELECT {_error_sql('')} AS error FROM (SELECT CASE WHEN json_valid(action) THEN action::JSON END AS a FROM enterprise_examples)) GROUP BY 1",
    "enterprise_metrics": f"WITH {_PAIRS}, {_METRICS} SELECT * FROM metrics",
    "error_taxonomy": f"WITH {_PAIRS}, {_LABELLED} SELECT d.label, count(l.label) AS n, round(count(l.label) / (SELECT count(*) FROM checked), 6) AS rate FROM (SELECT unnest([{listed(evaluate.LABELS)}]) AS label) d LEFT JOIN labelled l ON l.label = d.label GROUP BY 1",
    "error_samples": f"WITH {_PAIRS}, {_LABELLED} SELECT example_id, label, row_number() OVER (PARTITION BY label ORDER BY example_id) AS place FROM labelled QUALIFY place <= 3",
    "requirement_gates": f"WITH {_PAIRS}, {_METRICS}, {_GATED} SELECT * FROM gated",
    "requirements_passed": f"WITH {_PAIRS}, {_METRICS}, {_GATED} SELECT count(*) AS n_checks, bool_and(passed) AND count(*) > 0 AS passed FROM gated",
    "requirement_config_errors": "SELECT 'no_such_metric' AS metric, 'unknown metric' AS error UNION ALL SELECT 'intent_accuracy', 'given more than once' UNION ALL SELECT 'unsafe_action_rate', 'given more than once' UNION ALL SELECT 'unsafe_action_rate', 'threshold is no share'",
    "label_counts_with_zeros": "SELECT d.event_type, count(e.event_type) AS n FROM (SELECT unnest(['click', 'purchase', 'refund', 'signup', 'view']) AS event_type) d LEFT JOIN events e ON e.event_type = d.event_type GROUP BY 1",
    "rule_baseline": """WITH r AS (SELECT lower(instruction) AS i, lower(concat_ws(' ', instruction, input)) AS t FROM sft_rows), p AS (SELECT i, CASE WHEN contains(t, 'cancel') THEN 'policy' WHEN contains(t, 'translate') THEN 'translation' WHEN contains(t, 'order') THEN 'order' WHEN contains(t, 'json') THEN 'action' ELSE '' END AS predicted,
        CASE WHEN contains(i, 'policy') THEN 'policy' WHEN contains(i, 'translate the message') THEN 'translation' WHEN contains(i, 'order') THEN 'order' WHEN contains(i, 'json') THEN 'action' ELSE 'none' END AS expected FROM r) SELECT count(*) AS n, round(count_if(predicted = expected) / count(*), 4) AS accuracy, round(count_if(predicted <> '') / count(*), 4) AS validity FROM p""",
    "ext_macro_f1": """WITH p AS (SELECT family, CASE WHEN length(user_input) % 3 = 0 THEN 'abstain' ELSE json_extract_string(action, '$.intent') END AS predicted FROM enterprise_examples), c AS (SELECT DISTINCT unnest([family, predicted]) AS class FROM p),
        s AS (SELECT class, (SELECT count(*) FROM p WHERE family = class) AS n_expected, (SELECT count(*) FROM p WHERE predicted = class) AS n_predicted, (SELECT count(*) FROM p WHERE predicted = class AND family = class) AS h FROM c WHERE class IS NOT NULL)
        SELECT class, n_expected, n_predicted, round(coalesce(h / nullif(n_predicted, 0), 0.0), 6) AS precision, round(coalesce(h / nullif(n_expected, 0), 0.0), 6) AS recall, round(2 * h / (n_expected + n_predicted), 6) AS f1 FROM s""",
    "decision_routing": f"""WITH {_QS}, policies AS (SELECT 'q' || event_id AS question_id, round(user_id % 10 / 10, 1) AS threshold, 'review_desk' AS target FROM events WHERE event_id % 5 = 0),
        j AS (SELECT r.*, greatest(coalesce(p.threshold, 0.0), 0.5) AS th, p.target AS to_ FROM results r LEFT JOIN policies p ON p.question_id = r.question_id), k AS (SELECT th::DOUBLE AS threshold, coalesce(status = 'accepted' AND confidence >= th, FALSE) AS x, to_ FROM j)
        SELECT CASE WHEN x THEN 'execute' ELSE 'escalate' END AS route, threshold, CASE WHEN NOT x THEN coalesce(to_, 'intent_model') END AS target, count(*) AS n FROM k GROUP BY 1, 2, 3""",
    "decision_contract": f"""WITH {_QS}, f AS (SELECT 'choice without options' AS "check", question_id FROM questions WHERE kind = 'choice' AND n_options < 1 UNION ALL SELECT 'question given twice', question_id FROM questions GROUP BY question_id HAVING count(*) > 1 UNION ALL SELECT 'confidence is no share', question_id FROM results WHERE coalesce(NOT (confidence BETWEEN 0 AND 1), TRUE)
        UNION ALL SELECT 'value is no share', question_id FROM results WHERE coalesce(NOT (value BETWEEN 0 AND 1), TRUE) UNION ALL SELECT 'no result', question_id FROM questions WHERE question_id NOT IN (SELECT question_id FROM results) UNION ALL SELECT 'no question', question_id FROM results WHERE question_id NOT IN (SELECT question_id FROM questions)
        UNION ALL SELECT 'other kind', r.question_id FROM results r JOIN questions q ON q.question_id = r.question_id WHERE r.kind <> q.kind) SELECT "check", count(*) AS n, min(question_id) AS least_id FROM f GROUP BY 1""",
    "ext_threshold_at_precision": """WITH r AS (SELECT event_type, round(value, 1) AS score, (user_id % 4 > 0 OR value > 60) AS correct FROM events WHERE value IS NOT NULL), c AS (SELECT event_type, score, count(*) AS n, sum(correct::INT) AS k FROM r GROUP BY 1, 2),
        w AS (SELECT event_type, score, sum(n) OVER d AS cn, sum(k) OVER d AS ck, sum(n) OVER (PARTITION BY event_type) AS a FROM c WINDOW d AS (PARTITION BY event_type ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), g AS (SELECT * FROM w WHERE ck / cn >= 0.8)
        SELECT event_type, min(score) AS threshold, round(arg_min(ck / cn, score), 6) AS precision, round(arg_min(cn / a, score), 6) AS coverage FROM g GROUP BY 1""",
    "adaptation_plan": "SELECT * FROM (VALUES ('t1', 'decision', 'non_autoregressive'), ('t2', 'decision', 'rule'), ('t3', 'rag', 'edge_search'), ('t4', 'lora', 'mlx'), ('t5', 'qlora', 'transformers'), ('t6', 'lora', 'transformers'), ('t7', 'prompt', 'prompt')) t(task, method, backend)",
    "experiment_gates": " UNION ALL ".join(_GATE.format(*g) for g in (("quality", "coalesce(f1, accuracy)", "0.0", ">=", "0.85"), ("latency", "p95", "50.0", "<=", "100.0"), ("schema", "schema", "1.0", ">=", "0.98"), ("safety", "NULL::DOUBLE", "1.0", ">=", "0.99"))),
    "experiment_compare": f"SELECT id, coalesce(f1, accuracy, 0.0)::DOUBLE AS quality, coalesce(p95, 0.0)::DOUBLE AS p95 FROM {_EXP}",
    "newest_version": "SELECT '0.10.2' AS by_number, '0.9.11' AS by_path",
    "first_failures": f"WITH {_PAIRS} SELECT example_id, intent FROM checked WHERE NOT intent_ok ORDER BY example_id LIMIT 20",
    "model_rule_fallback": "SELECT CASE WHEN coalesce(value / 100 >= 0.5, FALSE) THEN 'model:' || event_type ELSE 'rule:default' END AS taken, count(*) AS n FROM events GROUP BY 1",
}
