"""Streaming forms: the log of failed queries, and event windows with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rules import parse_intent


def failed_queries(utterances: DataFrame, least: float = 0.5) -> DataFrame:
    """Utterances of a stream (column utterance) whose intent is unsure or needs asking back."""
    parsed = utterances.withColumn("r", parse_intent(F.col("utterance"), service=True))
    return parsed.where((F.col("r.confidence") < least) | F.col("r.clarification_required")).select("utterance", "r.intent", "r.confidence", F.to_json("r.constraints").alias("constraints"))


def log_failed_queries(utterances: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the failed queries that have arrived to a JSON log, each once, and end."""
    return failed_queries(utterances).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def windowed_counts(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events (ts, event_type, value) per window and type; what comes later than `late` after the newest event is dropped from state."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "w.end", "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions per user: runs of events no further apart than the gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("w.start", "w.end", "user_id", "n")
