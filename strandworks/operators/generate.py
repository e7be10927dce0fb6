"""Generated examples: seeded choices, templates, augmentation and prefix corpora. Choices are hashes, so any engine repeats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import global_rank


def choice(values: list[str], seed: int, salt: str, row: Column) -> Column:
    """One of the values for each row, by a seeded hash."""
    hashed = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), row.cast("string")), 256), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*[F.lit(v) for v in values]), (hashed % len(values) + 1).cast("int"))


def from_templates(spark: SparkSession, count: int, seed: int, templates: list[str], slots: dict[str, list[str]]) -> DataFrame:
    """(i, template, input): `count` inputs, templates in turn, each {slot} filled by a seeded choice of its values."""
    rows = spark.range(count).withColumnRenamed("id", "i").withColumn("template", (F.col("i") % len(templates)).cast("int"))
    text = F.element_at(F.array(*[F.lit(t) for t in templates]), F.col("template") + 1)
    for name, values in slots.items():
        text = F.replace(text, F.lit("{" + name + "}"), choice(values, seed, name, F.col("i")))
    return rows.select("i", "template", text.alias("input"))


def augment_every_nth(rows: DataFrame, family: str, order: str, n: int, draft: Column) -> DataFrame:
    """rows, and of each family every n-th row by order once more with a faulty draft to correct; `augmented` tells them apart.

    order must be unique within a family.
    """
    ranked = global_rank(rows, [order], [family], "_r")
    extra = ranked.where((F.col("_r") + 1) % n == 0).withColumn("draft", draft).withColumn("augmented", F.lit(True))
    return ranked.withColumn("draft", F.lit(None).cast("string")).withColumn("augmented", F.lit(False)).unionByName(extra).drop("_r")


def with_prefixes(queries: DataFrame, query: str, prefixes: list[str], evaluation: DataFrame) -> DataFrame:
    """Every query after every prefix, without what stands in the evaluation set; prefixes are an array, not a join."""
    spoken = queries.select(F.explode(F.transform(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.concat(p, F.col(query)))).alias("instruction")).distinct()
    return spoken.join(evaluation.select("instruction"), "instruction", "left_anti")
