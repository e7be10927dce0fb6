"""Named queries of the training-data problems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, table
from . import abuse, aliases, defects, form_copies, lookalikes, mixing, packing, winnow
from .tokens import TOKENIZER, token_count


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "media_assets").select(F.col("id").alias("record"), F.col("title").alias("text"), F.lit(False).alias("anchor"))


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    channel = F.explode("entities.channel").alias("c")
    return table(spark, sf_dir, "entities_v1").select(channel).select(F.col("c.id").alias("record"), F.col("c.name").alias("text"), F.lit(True).alias("anchor"))


def p2_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a training and an evaluation example, with its coverage."""
    return winnow.cross_split_overlaps(table(spark, sf_dir, "enterprise_examples"), "example_id", "split", "user_input", "action")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p2_overlaps(spark, sf_dir)
    return found.select(F.least("train_id", "eval_id").alias("example_a"), F.greatest("train_id", "eval_id").alias("example_b"))


def p2_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlapping example of either side: its overlaps and the greatest coverage."""
    found = p2_overlaps(spark, sf_dir)
    each = found.select(F.explode(F.array("train_id", "eval_id")).alias("example_id"), "coverage")
    return each.groupBy("example_id").agg(F.count("*").alias("n_overlaps"), F.round(F.max("coverage"), 4).alias("coverage"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples, overlapping examples, their overlaps and mean coverage per split and source, the training split included."""
    rows = table(spark, sf_dir, "enterprise_examples").select("example_id", "split", "source").join(p2_coverage(spark, sf_dir), "example_id", "left")
    return rows.groupBy("split", "source").agg(F.count("*").alias("n_examples"), F.count("n_overlaps").alias("n_overlapping"), F.coalesce(F.sum("n_overlaps"), F.lit(0)).alias("n_overlaps"), F.round(F.avg("coverage"), 4).alias("mean_coverage"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.lookalike_pairs(_titles(spark, sf_dir).unionByName(_channels(spark, sf_dir)))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title and channel name with its one form."""
    return lookalikes.with_forms(_titles(spark, sf_dir).unionByName(_channels(spark, sf_dir)), "text").select("record", "text", "canonical", "look")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.defective_pairs(table(spark, sf_dir, "sft_rows"), "row_id", "instruction", "input", "output", "lang")


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective pairs per source and kind of defect."""
    rows = table(spark, sf_dir, "sft_rows").select("row_id", "source").join(p4_found(spark, sf_dir), "row_id")
    return rows.groupBy("source", "defect").agg(F.count("*").alias("n_rows"))


def p4_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many defects each kind of evidence shows."""
    judged = defects.defective_pairs(table(spark, sf_dir, "sft_rows"), "row_id", "instruction", "input", "output", "lang", evidence=True)
    return judged.groupBy("defect", "evidence").agg(F.count("*").alias("n_rows"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return form_copies.form_copies(table(spark, sf_dir, "sft_rows"), "row_id", "input", "output")


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each distinct record, with its number of copies."""
    return form_copies.copy_counts(table(spark, sf_dir, "sft_rows"), "row_id", "input", "output")


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = table(spark, sf_dir, "catalog_entities")
    named = F.explode(F.concat(F.array("canonical_name", "display_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name")
    catalogue = entities.select(F.lit("catalog_entity").alias("list"), F.col("entity_id").alias("entity"), named)
    channel = table(spark, sf_dir, "entities_v1").select(F.explode("entities.channel").alias("c"))
    names = F.explode(F.concat(F.array("c.name"), F.coalesce("c.aliases", F.array().cast("array<string>")))).alias("name")
    return catalogue.unionByName(channel.select(F.lit("channel").alias("list"), F.col("c.id").alias("entity"), names))


def p6_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with the entity or channel it means, its cosine and its edits."""
    entries = table(spark, sf_dir, "alias_entries").select("entry_id", F.col("field_kind").alias("list"), F.col("entered_value").alias("entered"))
    return aliases.map_values(entries, _reference(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_mapped(spark, sf_dir).select("entry_id", "entity_id")


def p6_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that mean nothing in their list, most frequent first."""
    none = p6_mapped(spark, sf_dir).where(F.col("entity_id") == aliases.NONE).select("entry_id")
    rows = table(spark, sf_dir, "alias_entries").join(none, "entry_id").groupBy("field_kind", "entered_value").agg(F.count("*").alias("n_entries"))
    return rows.orderBy(F.desc("n_entries"), "field_kind", "entered_value")


def _sized(spark: SparkSession, sf_dir: str, *columns: str, tokenizer: str = TOKENIZER) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", *columns, token_count(F.col("text"), tokenizer).alias("tokens"))


def _packed(spark: SparkSession, sf_dir: str) -> list[tuple[str, int, int, DataFrame]]:
    sized = checkpointed(_sized(spark, sf_dir))
    limits = table(spark, sf_dir, "pack_limits").orderBy("limit_name").collect()  # one row for each capacity asked for
    return [(r["limit_name"], r["capacity_tokens"], r["separator_tokens"], packing.pack(sized, "doc_id", "tokens", r["capacity_tokens"], r["separator_tokens"])) for r in limits]


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document, or piece of a document, stands for each limit."""
    placed = [packed.select(F.lit(name).alias("limit_name"), *packed.columns) for name, _, _, packed in _packed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, placed)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, unused share and the least number of containers for each limit."""
    reports = [packing.fill_report(packed, capacity, separator).withColumn("limit_name", F.lit(name)) for name, capacity, separator, packed in _packed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, reports)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix with their numbers of copies."""
    return mixing.mix(_sized(spark, sf_dir, "source", "text"), table(spark, sf_dir, "mix_targets")).drop("posterior")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, reached and expected share of each source."""
    sized = checkpointed(_sized(spark, sf_dir, "source", "text"))
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.share_report(mixing.mix(sized, targets), sized, targets)


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document for abusive, hateful or sexually explicit wording."""
    return abuse.abuse_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where("flagged").select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, flagged documents and their rate per source."""
    documents = table(spark, sf_dir, "documents")
    scored = abuse.abuse_scores(documents, table(spark, sf_dir, "review_labels"), keep=["source"])
    return scored.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum(F.col("flagged").cast("long")).alias("n_flagged"), F.round(F.avg(F.col("flagged").cast("double")), 6).alias("rate"))


def p2_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps that can be none: within one side, of an unknown example, given twice, or with a coverage out of bounds."""
    splits = table(spark, sf_dir, "enterprise_examples").select("example_id", "split")
    found = p2_overlaps(spark, sf_dir).join(splits.select(F.col("example_id").alias("train_id"), F.col("split").alias("_a")), "train_id", "left").join(splits.select(F.col("example_id").alias("eval_id"), F.col("split").alias("_b")), "eval_id", "left")
    wrong = ~F.coalesce((F.col("_a") == "train") & (F.col("_b") != "train"), F.lit(False))
    each = found.groupBy("train_id", "eval_id").agg(F.count("*").alias("_n"), F.max(wrong).alias("_w"), F.min(F.col("coverage").between(winnow.COVERAGE, 1.0)).alias("_c"))
    return each.agg(F.count_if("_w").alias("n_not_across"), F.count_if(F.col("_n") > 1).alias("n_twice"), F.count_if(~F.col("_c")).alias("n_coverage"))


def p6_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per list, entries, entries without exactly one answer, and answers that the list hasn't."""
    listed = _reference(spark, sf_dir).select("list", F.col("entity").alias("entity_id"), F.lit(True).alias("_there")).distinct()
    entries = table(spark, sf_dir, "alias_entries").select("entry_id", F.col("field_kind").alias("list"))
    answers = p6_found(spark, sf_dir).groupBy("entry_id").agg(F.count("*").alias("_n"), F.first("entity_id").alias("entity_id"))
    each = entries.join(answers, "entry_id", "left").join(listed, ["list", "entity_id"], "left")
    return each.groupBy("list").agg(F.count("*").alias("n_entries"), F.count_if(F.coalesce(F.col("_n"), F.lit(0)) != 1).alias("n_not_once"), F.count_if(F.col("_there").isNull() & (F.col("entity_id") != aliases.NONE)).alias("n_unlisted"))


def p8_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per limit, containers over capacity or with gaps in their positions, and documents whose tokens don't come out exactly once."""
    sized = checkpointed(_sized(spark, sf_dir))
    out = []
    for r in table(spark, sf_dir, "pack_limits").orderBy("limit_name").collect():
        capacity, separator = r["capacity_tokens"], r["separator_tokens"]
        packed = checkpointed(packing.pack(sized, "doc_id", "tokens", capacity, separator))
        held = packed.groupBy("container").agg(F.sum("size").alias("t"), F.count("*").alias("n"), F.max("position").alias("p"), F.count_distinct("position").alias("d"))
        over = held.agg(F.count_if(F.col("t") + separator * (F.col("n") - 1) > capacity).alias("n_over"), F.count_if((F.col("p") + 1 != F.col("n")) | (F.col("d") != F.col("n"))).alias("n_gaps"))
        came = packed.groupBy("doc_id").agg(F.sum("size").alias("t"), F.count("*").alias("n"), F.max(F.col("start") + F.col("size")).alias("end"), F.count_distinct("start").alias("d"))
        joined = sized.join(came, "doc_id", "full")
        exact = F.coalesce((F.col("t") == F.col("tokens")) & (F.col("end") == F.col("tokens")) & (F.col("d") == F.col("n")) & (F.col("n") == F.ceil(F.col("tokens") / F.lit(capacity))), F.col("tokens") == 0)
        lost = joined.agg(F.count_if(~F.coalesce(exact, F.lit(False))).alias("n_not_once"))
        out += [x.withColumn("limit_name", F.lit(r["limit_name"])) for x in (over, lost)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)
    return both.groupBy("limit_name").agg(*[F.sum(c).alias(c) for c in ("n_over", "n_gaps", "n_not_once")])


def p9_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, documents used more often than its cap allows, and documents used that the table hasn't under that source."""
    targets = table(spark, sf_dir, "mix_targets").select("source", "max_repeats")
    there = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("_source"))
    used = p9_mix(spark, sf_dir).join(there, "doc_id", "left")
    each = used.groupBy("source").agg(F.max("copies").alias("_most"), F.count_if(~F.col("source").eqNullSafe(F.col("_source"))).alias("n_strange"))
    return targets.join(each, "source", "left").select("source", F.coalesce(F.col("_most") > F.col("max_repeats"), F.lit(False)).alias("over_cap"), F.coalesce("n_strange", F.lit(0)).alias("n_strange"))


QUERIES = {"p2_found": p2_found, "p2_overlaps": p2_overlaps, "p2_coverage": p2_coverage, "p2_report": p2_report, "p3_found": p3_found, "p3_canonical": p3_canonical, "p4_found": p4_found, "p4_report": p4_report, "p4_evidence": p4_evidence, "p5_found": p5_found, "p5_counts": p5_counts, "p6_found": p6_found, "p6_mapped": p6_mapped, "p6_unmatched": p6_unmatched, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates, "p2_violations": p2_violations, "p6_violations": p6_violations, "p8_violations": p8_violations, "p9_violations": p9_violations}
# what SQL can say of these operators' results: that they keep their invariants
ORACLE: dict[str, str] = {
    "p2_violations": "SELECT 0 AS n_not_across, 0 AS n_twice, 0 AS n_coverage",
    "p6_violations": "SELECT field_kind AS list, count(*) AS n_entries, 0 AS n_not_once, 0 AS n_unlisted FROM alias_entries GROUP BY 1",
    "p8_violations": "SELECT limit_name, 0 AS n_over, 0 AS n_gaps, 0 AS n_not_once FROM pack_limits",
    "p9_violations": "SELECT source, FALSE AS over_cap, 0 AS n_strange FROM mix_targets",
}
