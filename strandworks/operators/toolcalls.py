"""Tool calls: typed arguments, which arguments must agree, metrics and gates, and predictions joined by input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import tool_call

# Tools, and the arguments of each that must agree; a looser rule compares queries by their words.
FREE_TOOLS = ["get_current_date_time", "calendar_permission_status"]
EQUAL_ARGUMENT = {"read_calendar_events": ("date", False), "open_route": ("target", True)}  # argument, and whether letter case counts as equal
QUERY_TOOLS = ["query_lifetrack_status", "record_lifetrack_facts"]
REMINDER_TOOL = "schedule_notification"
NUMBERS = ["hour", "minute"]
GATES = [("tool_name_accuracy", ">=", 0.90), ("required_args_accuracy", ">=", 0.85), ("refusal_accuracy", ">=", 0.90)]
# Capabilities with their validators, benchmarks and backends.
CAPABILITIES = [
    ("structured_decision", ["schema_validity", "confidence_threshold"], ["accuracy", "f1", "p95_latency"], ["deterministic", "laya", "jev"]),
    ("structured_extraction", ["json_schema_validity"], ["accuracy", "field_f1", "schema_compliance"], ["prompt", "lora", "qlora"]),
    ("structured_generation", ["json_schema_validity", "safety_refusal"], ["rough_l", "bleu", "p95_latency"], ["prompt", "rag", "lora", "qlora"]),
    ("retrieval_grounding", ["fact_hallucination_check"], ["hit_rate", "mrr", "relevance"], ["edge_search", "rag"]),
]


def capabilities(spark) -> DataFrame:
    """(id, validators, benchmarks, backends): one row for each capability."""
    return spark.createDataFrame(CAPABILITIES, "id string, validators array<string>, benchmarks array<string>, backends array<string>")


def typed(call: Column) -> Column:
    """The call with its arguments as JSON values: truth values, numbers of hours and minutes, and texts; null stays null."""
    value = lambda k, v: F.when(F.lower(v).isin("true", "false"), F.lower(v)).when(k.isin(NUMBERS) & v.rlike(r"^\d+$"), F.coalesce(v.try_cast("decimal(38,0)").cast("string"), v)).otherwise(F.concat(F.lit('"'), v, F.lit('"')))
    return F.when(call.isNotNull(), F.struct(call["tool"].alias("tool"), F.transform_values(call["args"], value).alias("args")))


def _text(args: Column, name: str) -> Column:
    return F.coalesce(F.trim(args[name]), F.lit(""))


def required_agree(tool: Column, expected: Column, predicted: Column) -> Column:
    """Whether the arguments that the tool requires agree; arguments are maps of texts. An unknown tool never agrees."""
    chain = F.when(tool.isin(FREE_TOOLS), F.lit(True))
    for name, (argument, folded) in EQUAL_ARGUMENT.items():
        a, b = _text(predicted, argument), _text(expected, argument)
        chain = chain.when(tool == name, F.lower(a) == F.lower(b) if folded else a == b)
    p, e = F.lower(_text(predicted, "query")), F.lower(_text(expected, "query"))
    words = lambda x: F.filter(F.split(x, r"\s+"), lambda w: w != "")
    chain = chain.when(tool.isin(QUERY_TOOLS), (p != "") & (e.contains(p) | p.contains(e) | F.arrays_overlap(words(p), words(e))))
    number = lambda args, name: args[name].try_cast("long")
    same = (F.coalesce(number(predicted, n) == number(expected, n), F.lit(False)) for n in NUMBERS)
    said = [F.coalesce(predicted[n] != "", F.lit(False)) for n in ("title", "message")]
    reminder = said[0] & said[1]
    for test in same:
        reminder = reminder & test
    return F.coalesce(chain.when(tool == REMINDER_TOOL, reminder).otherwise(F.lit(False)), F.lit(False))


def compared(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """rows with is_tool (a call was expected), tool, name_ok, required_ok, exact_ok and refused (no call was predicted).

    A null prediction is no call. Arguments are compared as typed values, whatever their order.
    """
    both = rows.select("*", tool_call(F.col(expected)).alias("_e"), tool_call(F.col(predicted)).alias("_p"))
    e, p = F.col("_e"), F.col("_p")
    name_ok = F.coalesce(e["tool"] == p["tool"], F.lit(False))
    entries = lambda call: F.array_sort(F.map_entries(typed(call)["args"]))
    checks = {
        "is_tool": e.isNotNull(), "tool": e["tool"], "name_ok": name_ok, "required_ok": name_ok & required_agree(e["tool"], e["args"], p["args"]),
        "exact_ok": name_ok & F.coalesce(entries(e) == entries(p), F.lit(False)), "refused": p.isNull(),
    }
    return both.select(*rows.columns, *[c.alias(n) for n, c in checks.items()])


def tool_metrics(rows: DataFrame) -> DataFrame:
    """One row with the counts and accuracies of compared rows; an accuracy over no rows is 1."""
    tools, refusals = F.count_if("is_tool"), F.count_if(~F.col("is_tool"))
    share = lambda part, whole: F.round(F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(1.0)), 6)
    called = lambda c: F.count_if(F.col("is_tool") & F.col(c))
    refused = F.count_if(~F.col("is_tool") & F.col("refused"))
    failed = F.count_if(F.when(F.col("is_tool"), ~F.col("required_ok")).otherwise(~F.col("refused")))
    return rows.agg(
        F.count("*").alias("total_samples"), tools.alias("tool_samples"), refusals.alias("refusal_samples"), share(called("name_ok"), tools).alias("tool_name_accuracy"),
        share(called("required_ok"), tools).alias("required_args_accuracy"), share(called("exact_ok"), tools).alias("exact_args_accuracy"), share(refused, refusals).alias("refusal_accuracy"), failed.alias("failures"))


def per_tool_counts(rows: DataFrame) -> DataFrame:
    """(tool, n) of the expected calls; rows that expect none count as "refusal"."""
    return rows.groupBy(F.coalesce("tool", F.lit("refusal")).alias("tool")).agg(F.count("*").alias("n"))


def last_predictions(rows: DataFrame, predictions: DataFrame, on: str, position: str, value: str, strict: bool = True) -> DataFrame:
    """rows with the last prediction for their input (greatest position), one for each row.

    Inputs without a prediction are an error; with strict=False they have a null prediction. A null input matches a null
    input. Predictions are reduced to one per input before they are joined, so no row multiplies.
    """
    last = predictions.groupBy(F.col(on).alias("_on")).agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(position)).alias("_last"))
    joined = rows.join(last, F.col(on).eqNullSafe(F.col("_on")), "left")
    if strict and (missing := joined.where("_last IS NULL").count()):
        raise ValueError(f"predictions are missing for {missing} inputs")
    return joined.select(*rows.columns, F.col("_last.v").alias("predicted"))
