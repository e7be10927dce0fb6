"""Profile of a dataset: counts, duplicates, leakage, token statistics, classes and warnings."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, token_estimate
from .ranking import order_statistics


def norm_hash(text: Column) -> Column:
    return F.sha2(collapse(text), 256)


def raw_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def p95_index() -> Column:
    return F.floor(F.lit(0.95) * (F.col("n") - 1)).cast("long")


def profile(records: DataFrame, text: str, parsed: Column | None = None) -> DataFrame:
    """One row: total, valid, invalid, duplicate rows, validity ratio and token statistics of the valid rows.

    A record is valid if parsed, or the text, isn't null. An empty table gives zeros, and nulls where nothing is known.
    """
    valid = (parsed if parsed is not None else F.col(text)).isNotNull()
    own = records.select(valid.alias("_v"), F.when(valid, norm_hash(F.col(text))).alias("_h"), F.when(valid, token_estimate(F.col(text))).alias("_t"))
    tokens = order_statistics(own.withColumn("_all", F.lit(1)), "_t", ["_all"], {"tokens_p95": p95_index()}).select("tokens_p95")
    counts = own.agg(
        F.count("*").alias("total"), F.count_if("_v").alias("valid"), F.count_if(~F.col("_v")).alias("invalid"),
        (F.count_if("_v") - F.count_distinct("_h")).alias("duplicates"), F.min("_t").alias("tokens_min"), F.max("_t").alias("tokens_max"),
        F.round(F.avg("_t"), 2).alias("tokens_mean"), F.coalesce(F.round(F.try_divide(F.count_if("_v"), F.count("*")), 4), F.lit(0.0)).alias("schema_validity"),
    )
    return counts.join(tokens, F.lit(True), "left")  # one row each


def leakage(train: DataFrame, evaluation: DataFrame, key: str, text: str) -> DataFrame:
    """One row: evaluation rows whose text is in train exactly, and after normalisation; repeated rows count each time.

    Of each normalised group of train the row with the smallest key alone states the exact text. Null text leaks nothing.
    """
    seen = train.where(F.col(text).isNotNull()).select(norm_hash(F.col(text)).alias("_h"), raw_hash(F.col(text)).alias("_raw"), F.col(key).alias("_key"))
    first = seen.groupBy("_h").agg(F.min_by("_raw", "_key").alias("_first"))
    asked = evaluation.where(F.col(text).isNotNull()).select(norm_hash(F.col(text)).alias("_h"), raw_hash(F.col(text)).alias("_raw"))
    # equal exact texts have equal normalised ones, so one join answers both
    both = asked.groupBy("_h", "_raw").agg(F.count("*").alias("_n")).join(first, "_h", "left")
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("_raw") == F.col("_first"), F.col("_n"))), F.lit(0)).alias("exact_leaks"),
        F.coalesce(F.sum(F.when(F.col("_first").isNotNull(), F.col("_n"))), F.lit(0)).alias("normalised_leaks"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("evaluation_rows"),
    )


def class_distribution(records: DataFrame, label: Column) -> DataFrame:
    """(label, n); rows without a label, or with an empty one, belong to no class."""
    return records.select(F.nullif(label, F.lit("")).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))


def imbalance(classes: DataFrame, most: float = 5.0) -> DataFrame:
    """One row: largest and smallest class, their ratio, and whether it is too large."""
    both = classes.agg(F.max("n").alias("largest"), F.min("n").alias("smallest"))
    ratio = F.try_divide(F.col("largest"), F.col("smallest"))
    return both.select("largest", "smallest", F.round(ratio, 4).alias("ratio"), F.coalesce(ratio > most, F.lit(False)).alias("imbalanced"))


def warnings(profiled: DataFrame, leaks: DataFrame, balance: DataFrame) -> DataFrame:
    """(place, warning) in fixed order, from one-row frames of profile, leakage and imbalance."""
    one = profiled.join(leaks, F.lit(True)).join(balance, F.lit(True))
    listed = F.array(
        F.when(F.col("invalid") > 0, F.concat(F.col("invalid").cast("string"), F.lit(" invalid rows"))),
        F.when(F.col("duplicates") > 0, F.concat(F.col("duplicates").cast("string"), F.lit(" duplicate rows"))),
        F.when(F.col("normalised_leaks") > 0, F.concat(F.col("normalised_leaks").cast("string"), F.lit(" leaked evaluation rows"))),
        F.when(F.col("imbalanced"), F.lit("class imbalance above 5.0")),
    )
    return one.select(F.posexplode(listed).alias("place", "warning")).where("warning IS NOT NULL")


def dataset_id(source: str, schema: str, config: dict) -> str:
    """The id of a dataset: 16 hex digits over its source, its schema and the configuration with sorted names, parted by "::"."""
    return hashlib.sha256(f"{source}::{schema}::{json.dumps(config, sort_keys=True)}".encode()).hexdigest()[:16]


def content_hash(rows: DataFrame, *columns: str) -> str:
    """A hash of a table's rows, whatever their order, as the source of dataset_id where it is too large to be one text.

    Each task adds up its rows' 256-bit hashes in four parts of 64 bits, so a row that is there twice counts twice.
    """
    said = F.sha2(F.to_json(F.struct(*(columns or rows.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(said, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")).alias(f"p{i}") for i in range(4)]
    sums = rows.agg(F.count("*").alias("n"), *parts).first()
    return hashlib.sha256("|".join(str(int(x or 0)) for x in sums).encode()).hexdigest()
