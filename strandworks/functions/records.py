"""Column functions on JSON texts and tool-call texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parsed(text: Column) -> Column:
    """The text as VARIANT; null where it can't be read."""
    return F.try_parse_json(text)


def member(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def kind(value: Column, path: str) -> Column:
    """The type at a path: string, number, boolean, array, object, null, or absent."""
    raw = F.schema_of_variant(member(value, path))
    named = F.when(raw == "STRING", "string").when(raw == "BOOLEAN", "boolean").when(raw == "VOID", "null").when(raw.startswith("ARRAY"), "array").when(raw.startswith("OBJECT"), "object")
    return F.when(raw.isNull(), "absent").otherwise(F.coalesce(named, F.lit("number")))


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def texts_at(value: Column, path: str) -> Column:
    """A list of strings at a path; null where it isn't one."""
    return F.try_variant_get(value, path, "array<string>")


def canonical(value: Column) -> Column:
    """A text that is the same for equal values whatever the order of members."""
    return value.cast("string")


def first_json_object(text: str | None) -> str | None:
    """The first balanced JSON object in a text, or None; braces inside of strings don't count."""
    if text is None or (start := text.find("{")) < 0:
        return None
    depth, quoted, at = 0, False, start
    while at < len(text):
        c = text[at]
        if quoted:
            at += c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[start : at + 1]
        at += 1
    return None


def first_json_object_of(text: Column) -> Column:
    """first_json_object of a column, in Arrow batches: balanced braces are no regular language."""

    @F.pandas_udf(T.StringType())
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(first_json_object, na_action="ignore")

    return found(text)


CALL = r"(?s)^<([a-z_]+)>\{(.*)\}</\1>$"
# Names that begin an argument, so that commas inside of values don't part arguments.
ARGUMENTS = ["date", "end_date", "query", "target", "title", "message", "hour", "minute", "repeat_daily"]


def tool_call(text: Column) -> Column:
    """struct(tool, args) of `<tool>{k:v,k:v}</tool>`; null where the text is no call.

    A part without a known name belongs to the value before it; of repeated names the last one counts. Values are trimmed texts.
    """
    said = F.regexp_replace(text, r"^\s+|\s+$", "")
    body = F.trim(F.regexp_extract(said, CALL, 2))
    parts = F.filter(F.split(body, rf",(?=\s*(?:{'|'.join(ARGUMENTS)}):)"), lambda x: x.contains(":"))
    pairs = F.transform(parts, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    # the last of equal names is kept, which needs no session setting
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q.key == p.key))
    return F.when(said.rlike(CALL), F.struct(F.regexp_extract(said, CALL, 1).alias("tool"), F.map_from_entries(last).alias("args")))


def format_call(tool: Column, args: Column) -> Column:
    listed = F.array_join(F.transform(F.map_entries(args), lambda e: F.concat(e.key, F.lit(":"), e.value)), ",")
    return F.concat(F.lit("<"), tool, F.lit(">{"), listed, F.lit("}</"), tool, F.lit(">"))
