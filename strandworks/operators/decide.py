"""Decisions: contracts of questions and results, routing by confidence, and the plan that follows from a profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLOOR = 0.5  # least confidence at which anything is executed
DEFAULT_TARGET = "intent_model"


def route(results: DataFrame, policies: DataFrame, floor: float = FLOOR) -> DataFrame:
    """results with the threshold that counts, the route (execute or escalate) and where an escalation goes.

    The threshold is the policy's, but at least the floor; a question without a policy has a threshold of 0 and the
    default target. A null confidence or status escalates. policies has one row per question.
    """
    asked = results.join(policies.select("question_id", F.col("threshold").alias("_t"), F.col("target").alias("_to")), "question_id", "left")
    threshold = F.greatest(F.coalesce("_t", F.lit(0.0)), F.lit(floor))
    executed = F.coalesce((F.col("status") == "accepted") & (F.col("confidence") >= threshold), F.lit(False))
    return asked.select(*results.columns, threshold.alias("threshold"), F.when(executed, "execute").otherwise("escalate").alias("route"), F.when(~executed, F.coalesce("_to", F.lit(DEFAULT_TARGET))).alias("target"))


def contract_violations(questions: DataFrame, results: DataFrame) -> DataFrame:
    """(check, question_id) where questions or results break their contract.

    Ids are filled and given once, a choice has options, a result's confidence and value are shares, every question has
    a result of its kind and every result a question.
    """
    share = lambda c: F.coalesce(F.col(c).between(0, 1), F.lit(False))
    blank = F.coalesce(F.trim("question_id"), F.lit("")) == ""
    found = [
        questions.where(blank).select(F.lit("empty question id").alias("check"), "question_id"),
        questions.where((F.col("kind") == "choice") & (F.coalesce(F.col("n_options"), F.lit(0)) < 1)).select(F.lit("choice without options").alias("check"), "question_id"),
        questions.groupBy("question_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("question given twice").alias("check"), "question_id"),
        results.where(~share("confidence")).select(F.lit("confidence is no share").alias("check"), "question_id"),
        results.where(~share("value")).select(F.lit("value is no share").alias("check"), "question_id"),
        questions.join(results, "question_id", "left_anti").select(F.lit("no result").alias("check"), "question_id"),
        results.join(questions, "question_id", "left_anti").select(F.lit("no question").alias("check"), "question_id"),
        results.join(questions.select("question_id", F.col("kind").alias("_kind")), "question_id").where("kind <> _kind").select(F.lit("other kind").alias("check"), "question_id"),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def threshold_at_precision(rows: DataFrame, group: str, score: str, correct: str, least: float) -> DataFrame:
    """Per group the lowest score from which on the precision is at least `least`, with precision and coverage there.

    Scores are counted first, so that a window holds distinct scores. Groups that never reach it have no row.
    """
    counted = rows.where(F.col(score).isNotNull()).groupBy(group, score).agg(F.count("*").alias("_n"), F.sum(F.col(correct).cast("int")).alias("_c"))
    own = Window.partitionBy(group)
    down = own.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    curve = counted.withColumn("_cn", F.sum("_n").over(down)).withColumn("_cc", F.sum("_c").over(down)).withColumn("_all", F.sum("_n").over(own))
    good = curve.where(F.col("_cc") / F.col("_cn") >= least)
    best = good.groupBy(group).agg(F.min_by(F.struct(F.col(score).alias("threshold"), (F.col("_cc") / F.col("_cn")).alias("precision"), (F.col("_cn") / F.col("_all")).alias("coverage")), score).alias("b"))
    return best.select(group, "b.threshold", F.round("b.precision", 6).alias("precision"), F.round("b.coverage", 6).alias("coverage"))


def plan(profile: Column, kind: Column, device: Column, memory_gb: Column, satisfied: Column) -> Column:
    """struct(method, backend) for a task: a baseline that already suffices, then by kind of task, then by hardware.

    profile is the number of examples; satisfied is the first baseline that meets all constraints, or null.
    """
    pick = lambda method, backend: F.struct(F.lit(method).alias("method"), F.lit(backend).alias("backend"))
    return (
        F.when(satisfied.isNotNull(), F.struct(F.when(satisfied.isin("decision", "rule"), "decision").otherwise("prompt").alias("method"), satisfied.alias("backend")))
        .when(kind == "decision", F.struct(F.lit("decision").alias("method"), F.when(profile > 2000, "non_autoregressive").otherwise("standard").alias("backend")))
        .when(kind == "retrieval", pick("rag", "edge_search"))
        .when(device == "apple_silicon", pick("lora", "mlx"))
        .when((device == "cuda") & (memory_gb <= 8.0), pick("qlora", "transformers"))
        .otherwise(pick("lora", "transformers"))
    )
