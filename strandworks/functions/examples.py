"""Column functions on loose training records: which part is the input, the output and the label, and prompts made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .records import kind, text_at

LABELS = ("label", "action", "intent", "category")


def _messages(value: Column, roles: tuple[str, ...]) -> Column:
    said = F.try_variant_get(value, "$.messages", "array<struct<role string, content string>>")
    return F.array_join(F.transform(F.filter(said, lambda m: m.role.isin(list(roles))), lambda m: m.content), "\n")


def input_of(value: Column) -> Column:
    """`input` if the record has it, else `prompt`, else what users and the system say in `messages`; a null member reads None."""
    there = lambda path: kind(value, path) != "absent"
    shown = lambda path: F.coalesce(text_at(value, path), F.lit("None"))
    return F.when(there("$.input"), shown("$.input")).when(there("$.prompt"), shown("$.prompt")).otherwise(F.coalesce(_messages(value, ("user", "system")), F.lit("")))


def output_of(value: Column) -> Column:
    """`output`, else `completion`, else what the assistant says in `messages`."""
    there = lambda path: kind(value, path) != "absent"
    shown = lambda path: F.coalesce(text_at(value, path), F.lit("None"))
    return F.when(there("$.output"), shown("$.output")).when(there("$.completion"), shown("$.completion")).otherwise(F.coalesce(_messages(value, ("assistant",)), F.lit("")))


def label_of(value: Column) -> Column:
    """The first of label, action, intent and category that says something; false, 0 and empty values don't."""
    told = [F.when(~text_at(value, f"$.{name}").isin("", "false", "0", "0.0"), text_at(value, f"$.{name}")) for name in LABELS]
    return F.coalesce(*told)


def normal_result(value: Column) -> Column:
    """A model's answer in one form: names in camel case are accepted, numbers and truth values are read from texts, gaps are filled."""
    first = lambda *paths: F.coalesce(*[text_at(value, p) for p in paths])
    return F.struct(
        text_at(value, "$.intent").alias("intent"), text_at(value, "$.tool").alias("tool"), F.coalesce(text_at(value, "$.confidence").try_cast("double"), F.lit(0.0)).alias("confidence"),
        F.coalesce(F.try_variant_get(value, "$.constraints", "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("constraints"),
        F.coalesce(F.try_variant_get(value, "$.missing_fields", "array<string>"), F.try_variant_get(value, "$.missingFields", "array<string>"), F.array().cast("array<string>")).alias("missing_fields"),
        F.coalesce(first("$.clarification_required", "$.clarificationRequired").try_cast("boolean"), F.lit(False)).alias("clarification_required"),
    )


def blueprint(predicates: list[str], tools: list[str]) -> str:
    """The instruction that states which relationships and tools an answer may use, both sorted."""
    return f"Use only these relationships: {', '.join(sorted(set(predicates)))}. Read-only tools: {', '.join(sorted(set(tools))) or 'none'}."
