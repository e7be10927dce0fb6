"""Writers: JSON lines, snapshots by split, completion rows and one-row reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_lines(rows: DataFrame, path: str, single: bool = False) -> None:
    """Rows as JSON lines; null members are written. A single file is for small results only."""
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Rows with a `split` column as a table partitioned by it, so that reading one split reads its files only."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def write_completions(rows: DataFrame, path: str, prompt: str = "prompt", completion: str = "completion") -> None:
    write_json_lines(rows.select(F.col(prompt).alias("prompt"), F.col(completion).alias("completion")), path)


def alpaca_to_lines(rows: DataFrame, path: str) -> None:
    write_json_lines(rows.select("instruction", F.coalesce("input", F.lit("")).alias("input"), "output"), path)


def write_report(row: DataFrame, path: str) -> None:
    """Write a report of one row; more rows are an error."""
    if len(row.limit(2).collect()) > 1:
        raise ValueError("a report has one row")
    write_json_lines(row, path, single=True)


def append_failed_queries(parsed: DataFrame, path: str, least: float = 0.5) -> None:
    """Append utterances that were understood too little, or need asking back, to a log."""
    parsed.where((F.col("confidence") < least) | F.col("clarification_required")).write.mode("append").json(path)
