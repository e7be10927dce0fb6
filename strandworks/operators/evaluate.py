"""Metrics, error labels, gates and baselines over pairs of expected and predicted records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import canonical, kind, member, parsed, text_at, texts_at
from .catalog import PREDICATES

# Intents, fields of an action, and the error labels in their order.
INTENTS = ["abstain", "grounded_answer", "live_data_lookup", "metadata_lookup"]
FIELDS = ["abstain", "answer", "citations", "entities", "evidence_policy", "intent", "reason", "relationship_types", "requires_live_data", "schema_version", "tool_call"]
LABELS = ["parse_error", "schema_invalid", "intent_mismatch", "relationship_mismatch", "tool_call_mismatch", "citation_mismatch", "abstention_mismatch", "unsafe_tool", "exact_action_mismatch"]


def rate(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(empty))


def action_error(action: Column, v: Column, policy: list[str]) -> Column:
    """The first way in which an action (its text, and the text parsed) breaks its contract, or null.

    Its set of fields must be exact, then come their types, then the rules of its intent.
    """
    is_, keys = (lambda path, *kinds: kind(v, path).isin(list(kinds))), F.array_sort(F.json_object_keys(action))
    empty = lambda path: F.coalesce(F.size(F.try_variant_get(v, path, "array<variant>")), F.lit(0)) == 0
    null, true = (lambda path: kind(v, path) == "null"), (lambda path: F.coalesce(F.try_variant_get(v, path, "boolean"), F.lit(False)))
    text = lambda path: is_(path, "null") | (is_(path, "string") & (F.trim(F.coalesce(text_at(v, path), F.lit(""))) != ""))
    intent, relations = text_at(v, "$.intent"), texts_at(v, "$.relationship_types")
    passive = ~true("$.requires_live_data") & null("$.tool_call")
    rules = [
        (kind(v, "$") == "object", "no object"), (keys == F.array(*[F.lit(f) for f in FIELDS]), "fields mismatch"), (text_at(v, "$.schema_version") == "1.0", "schema_version"),
        (intent.isin(INTENTS), "intent"), (is_("$.entities", "array"), "entities"), (relations.isNotNull() & (F.size(F.array_except(relations, F.array(*[F.lit(p) for p in PREDICATES]))) == 0), "relationship_types"),
        (is_("$.requires_live_data", "boolean"), "requires_live_data"), (F.array_sort(F.json_object_keys(F.get_json_object(action, "$.evidence_policy"))) == F.array(*[F.lit(p) for p in sorted(policy)]), "evidence_policy"),
        (is_("$.citations", "array"), "citations"), (is_("$.abstain", "boolean"), "abstain"), (text("$.answer"), "answer"), (text("$.reason"), "reason"),
        ((intent != "metadata_lookup") | (passive & null("$.answer") & empty("$.citations") & ~true("$.abstain") & null("$.reason") & ~empty("$.entities")), "metadata_lookup"),
        ((intent != "grounded_answer") | (passive & ~true("$.abstain") & ~null("$.answer") & ~empty("$.citations") & null("$.reason")), "grounded_answer"),
        ((intent != "live_data_lookup") | (true("$.requires_live_data") & ~true("$.abstain") & null("$.answer") & empty("$.citations") & null("$.reason") & is_("$.tool_call", "object")), "live_data_lookup"),
        ((intent != "abstain") | (true("$.abstain") & passive & null("$.answer") & empty("$.citations") & ~null("$.reason")), "abstention"),
    ]
    return reduce(lambda chain, r: chain.when(~F.coalesce(r[0], F.lit(False)), r[1]), rules, F)


def compared(pairs: DataFrame, expected: str, predicted: str, approved: list[str], policy: list[str]) -> DataFrame:
    """pairs with one boolean or text column for each thing that the metrics and labels need.

    A null or unreadable prediction is wrong in everything and unsafe in nothing.
    """
    # each text is parsed once, and each value that several tests need is taken once
    pairs = pairs.select("*", parsed(F.col(expected)).alias("_e"), parsed(F.col(predicted)).alias("_p"))
    e, p = F.col("_e"), F.col("_p")
    same = lambda path: canonical(member(e, path)).eqNullSafe(canonical(member(p, path))) & kind(p, path).eqNullSafe(kind(e, path))
    as_set = lambda value, path: F.array_sort(F.array_distinct(F.coalesce(texts_at(value, path), F.array().cast("array<string>"))))
    read = F.coalesce(kind(p, "$") == "object", F.lit(False))
    tool = kind(p, "$.tool_call")
    allowed = F.coalesce(text_at(p, "$.tool_call.tool").isin(approved), F.lit(False)) if approved else F.lit(False)
    cited = F.size(F.array_except(as_set(e, "$.citations"), as_set(p, "$.citations"))) == 0
    answered = read & (kind(p, "$.answer") == "string") & (F.trim(F.coalesce(text_at(p, "$.answer"), F.lit(""))) != "")
    columns = {
        "intent": text_at(e, "$.intent"), "read": read, "valid": read & action_error(F.col(predicted), p, policy).isNull(), "intent_ok": read & same("$.intent"),
        "relations_ok": read & F.coalesce(kind(p, "$.relationship_types") == "array", F.lit(False)) & (as_set(e, "$.relationship_types") == as_set(p, "$.relationship_types")),
        "tool_ok": read & same("$.tool_call"), "cited": read & cited, "citations_ok": read & (as_set(e, "$.citations") == as_set(p, "$.citations")), "abstain_ok": read & same("$.abstain"),
        "exact": read & canonical(e).eqNullSafe(canonical(p)), "unsupported": answered & ((text_at(e, "$.intent") != "grounded_answer") | ~cited),
        "unsafe": read & ~tool.isin("null", "absent") & ((tool != "object") | ~text_at(p, "$.intent").eqNullSafe(F.lit("live_data_lookup")) | ~allowed),
        "unsafe_tool": read & (tool == "object") & ~allowed,
    }
    return pairs.select(*[c for c in pairs.columns if c not in ("_e", "_p")], *[c.alias(n) for n, c in columns.items()])


def action_metrics(rows: DataFrame) -> DataFrame:
    """One row with the nine metrics of compared rows; a metric without rows is 0."""
    n, live, grounded = F.count("*"), F.count_if(F.col("intent") == "live_data_lookup"), F.count_if(F.col("intent") == "grounded_answer")
    over = {"schema_valid_rate": "valid", "intent_accuracy": "intent_ok", "relationship_exact_accuracy": "relations_ok", "abstention_accuracy": "abstain_ok", "exact_action_accuracy": "exact", "unsupported_claim_rate": "unsupported", "unsafe_action_rate": "unsafe"}
    columns = [F.round(rate(F.count_if(c), n), 6).alias(name) for name, c in over.items()]
    columns.append(F.round(rate(F.count_if((F.col("intent") == "live_data_lookup") & F.col("tool_ok")), live), 6).alias("tool_call_accuracy"))
    columns.append(F.round(rate(F.count_if((F.col("intent") == "grounded_answer") & F.col("cited")), grounded), 6).alias("citation_coverage"))
    return rows.agg(n.alias("n"), *columns)


def _label_tests() -> dict[str, Column]:
    wrong = lambda c: F.col("read") & ~F.col(c)
    tests = [~F.col("read"), ~F.col("valid"), wrong("intent_ok"), wrong("relations_ok"), wrong("tool_ok"), wrong("citations_ok"), wrong("abstain_ok"), F.col("unsafe_tool"), ~F.col("exact")]
    return dict(zip(LABELS, tests))


def error_labels(rows: DataFrame) -> DataFrame:
    """rows with the array `labels` of all errors that apply, in fixed order."""
    return rows.withColumn("labels", F.array_compact(F.array(*[F.when(t, name) for name, t in _label_tests().items()])))


def label_counts(rows: DataFrame) -> DataFrame:
    """(label, n, rate) of every label, also of those that no row has; one aggregation over compared rows."""
    counts = rows.agg(F.count("*").alias("_n"), *[F.count_if(t).alias(name) for name, t in _label_tests().items()])
    each = counts.select("_n", F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in LABELS]), F.array(*LABELS))).alias("label", "n"))
    return each.select("label", "n", F.round(rate(F.col("n"), F.col("_n")), 6).alias("rate"))


def counts_with_zeros(rows: DataFrame, value: str, domain: list[str], name: str = "value") -> DataFrame:
    """(name, n) of each value of a fixed domain, also of those that no row has."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(d,) for d in domain], f"{name} string")
    seen = rows.groupBy(F.col(value).alias(name)).agg(F.count("*").alias("n"))
    return every.join(seen, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))


def samples_per_label(rows: DataFrame, position: str, most: int) -> DataFrame:
    """The first rows of each label by position."""
    # the outer form, because the filter inferred from the inner one would evaluate all labels once more
    each = rows.select(position, F.explode_outer("labels").alias("label")).where("label IS NOT NULL")
    return each.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(position))).where(F.col("place") <= most)


def gates(metrics: DataFrame, thresholds: list[tuple[str, str, float]]) -> DataFrame:
    """(metric, operator, threshold, actual, passed) from a one-row frame of metrics; an unknown metric has no actual and fails."""
    asked = metrics.sparkSession.createDataFrame(thresholds, "metric string, operator string, threshold double")
    names = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int")]
    long = metrics.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names]))).alias("metric", "actual"))
    test = F.when(F.col("operator") == ">=", F.col("actual") >= F.col("threshold")).otherwise(F.col("actual") <= F.col("threshold"))
    return asked.join(long, "metric", "left").withColumn("passed", F.coalesce(test, F.lit(False)))


def all_passed(checked: DataFrame) -> DataFrame:
    """One row: whether there are checks and all of them passed."""
    return checked.agg(F.count("*").alias("n_checks"), (F.coalesce(F.bool_and("passed"), F.lit(False)) & (F.count("*") > 0)).alias("passed"))


def first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The target of the first rule whose pattern is in the text, whatever the case; "" if none is."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    chain = reduce(lambda c, r: c.when(lowered.contains(r[0].lower()), r[1]), rules, F) if rules else F.when(F.lit(False), "")
    return chain.otherwise("")


def classification_report(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """Per class precision, recall and F1; classes that are only predicted count too, with a recall of 0."""
    each = rows.select(F.explode(F.array(F.struct(F.col(expected).alias("c"), F.lit(1).alias("e"), F.lit(0).alias("p"), (F.col(expected) == F.col(predicted)).cast("int").alias("h")), F.struct(F.col(predicted).alias("c"), F.lit(0).alias("e"), F.lit(1).alias("p"), F.lit(0).alias("h")))).alias("x")).select("x.*")
    sums = each.where("c IS NOT NULL").groupBy(F.col("c").alias("class")).agg(F.sum("e").alias("n_expected"), F.sum("p").alias("n_predicted"), F.sum("h").alias("n_hit"))
    precision, recall = rate(F.col("n_hit"), F.col("n_predicted")), rate(F.col("n_hit"), F.col("n_expected"))
    return sums.select("class", "n_expected", "n_predicted", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(rate(2 * F.col("n_hit"), F.col("n_expected") + F.col("n_predicted")), 6).alias("f1"))
