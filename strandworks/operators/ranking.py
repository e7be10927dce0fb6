"""Ranks, order statistics, splits and balanced selections that need no global task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def global_rank(df: DataFrame, order: list[str], group: list[str] | None = None, name: str = "rank") -> DataFrame:
    """df with the rank from 0 of each row, within its group if there is one.

    Rows are sorted by ranges, counted per range, and ranked within their range; order must be unique within a group, so
    that ties, however many, fall into several ranges. Nulls come first.
    """
    group = group or []
    ranged = checkpointed(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*group, "_part").orderBy(*order)
    placed = ranged.withColumn("_own", F.row_number().over(own) - 1)
    same = [placed[c].eqNullSafe(offsets[c]) for c in [*group, "_part"]]
    joined = placed.join(offsets, same).select(*[placed[c] for c in df.columns], (F.col("_own") + F.col("_before")).alias(name))
    return joined


def order_statistics(df: DataFrame, value: str, group: list[str], picks: dict[str, Column]) -> DataFrame:
    """Per group the values at the given indexes (Columns over `n`, from 0) of its sorted values; nulls are left out.

    Values are counted first, so a group's window holds its distinct values and not its rows.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    own = Window.partitionBy(*group)
    upto = own.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    spread = counted.withColumn("_upto", F.sum("_c").over(upto)).withColumn("n", F.sum("_c").over(own))
    at = [F.min(F.when(F.col("_upto") > index, F.col(value))).alias(name) for name, index in picks.items()]
    return spread.groupBy(*group).agg(F.sum("_c").alias("n"), *at)


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Of rows with the same key the one that comes first; a task keeps one row per key before the shuffle."""
    own = Window.partitionBy("_key").orderBy(order)
    return df.withColumn("_key", key).withColumn("_place", F.row_number().over(own)).where("_place = 1").drop("_key", "_place")


def hashed_split(df: DataFrame, key: str, seed: int, train: float, validation: float) -> DataFrame:
    """df with `split`: the rows in the order of a seeded hash, cut at the floors of the shares; the rest is test."""
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)
    ranked = global_rank(df.withColumn("_order", order), ["_order", key], name="_rank")
    n = df.count()
    first, second = int(n * train), int(n * train) + int(n * validation)
    split = F.when(F.col("_rank") < first, "train").when(F.col("_rank") < second, "validation").otherwise("test")
    return ranked.withColumn("split", split).drop("_order", "_rank")


def balanced(df: DataFrame, family: str, order: str, families: list[str], count: int) -> DataFrame:
    """`count` rows, as many of each family as of the others, the first families one more; rank and family order are kept.

    A family that has too few rows gives what it has.
    """
    quota = {f: count // len(families) + (i < count % len(families)) for i, f in enumerate(families)}
    # the literal bound lets each task keep that many rows of a family before the shuffle
    ranked = df.where(F.col(family).isin(families)).withColumn("rank", F.row_number().over(Window.partitionBy(family).orderBy(order))).where(F.col("rank") <= max(quota.values()))
    most = F.create_map(*[F.lit(x) for pair in quota.items() for x in pair])
    place = F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, i)])
    return ranked.where(F.col("rank") <= most[F.col(family)]).withColumn("turn", place[F.col(family)])
