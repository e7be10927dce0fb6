"""Validators as frames of violations (check, row_key, message): collect all, or raise on the first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def blank(column: str) -> Column:
    return F.coalesce(strip(F.col(column)), F.lit("")) == ""


def rows_failing(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """A row for each check a row fails, in one scan; a check that is null fails."""
    failing = F.array_compact(F.array(*[F.when(F.coalesce(~ok, F.lit(True)), F.lit(name)) for name, ok in checks.items()]))
    # the outer form, because the filter inferred from the inner one would evaluate all checks once more
    each = df.select(F.col(key).cast("string").alias("row_key"), F.explode_outer(failing).alias("check")).where("check IS NOT NULL")
    return each.select("check", "row_key", F.concat_ws(" ", F.lit("failed"), "check").alias("message"))


def filled(*columns: str) -> dict[str, Column]:
    return {f"{c} is filled": ~blank(c) for c in columns}


def one_of(column: str, allowed: list[str]) -> dict[str, Column]:
    return {f"{column} is known": F.coalesce(F.col(column).isin(allowed), F.lit(False))}


def repeated(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A row for each key that stands more than once; null keys count like others."""
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(name).alias("check"), key.alias("row_key"), F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("message"))


def unknown_references(df: DataFrame, key: str, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """A row for each filled reference whose parent isn't there."""
    asked = df.where(F.col(column).isNotNull()).select(F.col(key).cast("string").alias("row_key"), F.col(column).alias("_ref"))
    known = parents.select(F.col(parent_key).alias("_ref")).where("_ref IS NOT NULL").distinct()
    return asked.join(known, "_ref", "left_anti").select(F.lit(f"{column} exists").alias("check"), "row_key", F.concat(F.lit("unknown "), F.col("_ref")).alias("message"))


def safe_location(path: str, start: str, end: str) -> dict[str, Column]:
    """A path relative to its repository, and lines that count up from 1."""
    p = F.col(path)
    relative = ~blank(path) & ~p.startswith("/") & ~p.contains("\\") & ~F.array_contains(F.split(p, "/"), "..") & (p != ".")
    return {"path is relative": relative, "lines are a range": (F.col(start) >= 1) & (F.col(end) >= F.col(start))}


def together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class ViolationError(ValueError):
    """The first violation of a fail-fast validation."""


def fail_fast(violations: DataFrame) -> None:
    first = violations.orderBy("check", "row_key").limit(1).collect()
    if first:
        raise ViolationError(f"{first[0]['check']}: {first[0]['row_key']} ({first[0]['message']})")
