"""Problem 5: records that are the same but for whitespace, letter case, punctuation and the order of named fields.

Every field of a record becomes one 128-bit hash of its name and normalised value; a record's fingerprint is the sum of
its fields' hashes, so the order of fields doesn't matter and nothing is sorted. Records are grouped by fingerprint, which
collapses copies on the map side, and every member is then compared with its group's first record field by field.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed

_NAMED = re.compile(r"^\s*([^\W\d_][\w \-]{0,30}?)\s*[:\uff1a](?=\s|$)")
_WRAPPERS = "*(\"'\u201c\u2018[ \t\xa0"
_NULL, _HALF = "\x00null", (1 << 64) - 1
FINGERPRINT = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("n", T.LongType())])


def plain(text: str) -> str:
    """text without whitespace, punctuation, ignorable characters and differences of letter case; symbols and marks stay."""
    if text.isascii():
        return "".join(c for c in text.lower() if c.isalnum() or c in "$+<=>^`|~")
    folded = unicodedata.normalize("NFC", text.casefold())
    return "".join(c for c in folded if unicodedata.category(c)[0] not in "PZC")


class _Number(str):
    """A number as it is written; its sign and point are no punctuation."""


def _leaves(value, path: str) -> Iterator[tuple[str, str]]:
    stack = [(value, path)]
    while stack:
        value, path = stack.pop()
        if isinstance(value, _Members):
            if not value:
                yield path, "{}"
            stack += [(x, f"{path}\x1f{plain(k)}") for k, x in value]
        elif isinstance(value, list):
            if not value:
                yield path, "[]"
            stack += [(x, f"{path}\x1f#{i}") for i, x in enumerate(value)]
        elif isinstance(value, _Number):
            yield path, str(value)
        elif isinstance(value, str):
            yield path, plain(value)
        else:
            yield path, _NULL if value is None else str(value).lower()


class _Members(list):
    """An object's members as pairs; repeated names stay."""


def fields(side: str, text: str | None) -> list[tuple[str, str]]:
    """(name, normalised value) of each field of a text: JSON members, `Name: value` lines, or the text as one field.

    A line that names no field continues the field above it. A named line's name and value are one value here, so that a
    text of a single named line equals the same text without its colon.
    """
    if text is None:
        return [(side, _NULL)]
    body = text.strip()
    if body[:1] in "{[":
        try:
            return list(_leaves(json.loads(body, object_pairs_hook=_Members, parse_int=_Number, parse_float=_Number, parse_constant=_Number), side))
        except (ValueError, RecursionError):
            pass
    named: list[list[str]] = []
    lines = [x for x in body.splitlines() if x.strip()]
    if len(lines) > 1 and _NAMED.match(lines[0].lstrip(_WRAPPERS)):
        for line in lines:
            if _NAMED.match(line.lstrip(_WRAPPERS)):
                named.append([line])
            else:
                named[-1].append(line)
    if len(named) > 1:
        return [(side, plain(" ".join(x))) for x in named]
    return [(side, plain(text))]


def fingerprint(parts: list[tuple[str, str]], seed: int = 0) -> tuple[int, int, int]:
    """Sum of the fields' hashes as two signed 64-bit numbers, and the number of fields."""
    total = sum(xxhash.xxh3_128_intdigest(f"{name}\x1e{value}".encode("utf-8", "surrogatepass"), seed) for name, value in parts)
    low, high = total & _HALF, (total >> 64) & _HALF
    return low - ((low >> 63) << 64), high - ((high >> 63) << 64), len(parts)


def _fingerprint_udf(seed: int):
    @F.pandas_udf(FINGERPRINT)
    def made(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [fingerprint(fields("i", x) + fields("o", y), seed) for x, y in zip(a, b)]
        return pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 3), columns=["h1", "h2", "n"])

    return made


@F.pandas_udf(T.BooleanType())
def _same_fields(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([(w == y and x == z) or Counter(fields("i", w) + fields("o", x)) == Counter(fields("i", y) + fields("o", z)) for w, x, y, z in zip(a, b, c, d)], dtype=bool)


def form_copies(records: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(kept_id, copy_id): the smallest key of each group of copies, and each other member.

    Records are copies if both texts are the same but for whitespace, letter case, punctuation and the order of named
    fields. Null equals null only; blank text and text of punctuation alone equal the empty text. Long texts are read
    whole. Keys must be unique, as row keys are; a key given twice counts once. Rows without a key are left out. Other
    columns are not read.
    """
    own = records.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(left).alias("_l"), F.col(right).alias("_r"))
    group = ["h1", "h2", "n"]
    # a key given twice with equal records is one row; only keys and fingerprints are shuffled, texts never for this
    keyed = checkpointed(own.withColumn("_f", _fingerprint_udf(0)("_l", "_r")).select("_id", "_f.*"))
    first = keyed.groupBy(*group).agg(F.min("_id").alias("kept_id"), F.max("_id").alias("_most")).where("kept_id < _most").drop("_most")
    members = keyed.join(first, group).where("_id <> kept_id").select(F.col("_id").alias("copy_id"), "kept_id").distinct()
    kept = own.select(F.col("_id").alias("kept_id"), F.col("_l").alias("_kl"), F.col("_r").alias("_kr")).join(first.select("kept_id"), "kept_id", "left_semi")
    copies = own.select(F.col("_id").alias("copy_id"), "_l", "_r").join(members, "copy_id")
    checked = copies.join(kept, "kept_id").withColumn("_same", _same_fields("_l", "_r", "_kl", "_kr"))
    pairs = checkpointed(checked.select("kept_id", "copy_id", "_same").distinct())
    missed = pairs.where("NOT _same")
    # records that share all 128 bits and the number of fields without being equal are grouped once more, by another hash
    if missed.isEmpty():
        return pairs.select("kept_id", "copy_id")
    again = own.join(missed.select(F.col("copy_id").alias("_id")), "_id", "left_semi").withColumn("_f", _fingerprint_udf(1)("_l", "_r")).select("_id", "_f.*")
    second = again.groupBy(*group).agg(F.min("_id").alias("kept_id"))
    more = again.join(second, group).where("_id <> kept_id").select("kept_id", F.col("_id").alias("copy_id"))
    return pairs.where("_same").select("kept_id", "copy_id").unionByName(more)


def copy_counts(records: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(kept_id, n_copies): one row for each distinct record, with how often it stands in the table."""
    copies = form_copies(records, key, left, right)
    groups = copies.groupBy("kept_id").agg((F.count("*") + 1).alias("_n"))
    own = records.where(F.col(key).isNotNull()).select(F.col(key).alias("kept_id")).distinct()
    return own.join(copies.select(F.col("copy_id").alias("kept_id")), "kept_id", "left_anti").join(groups, "kept_id", "left").select("kept_id", F.coalesce("_n", F.lit(1)).alias("n_copies"))
