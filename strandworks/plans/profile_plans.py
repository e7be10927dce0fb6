"""Named queries of dataset profiles, leakage, dedupe, splits, prompts and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip, token_estimate
from ..operators import profile, ranking
from ..session import table
from .sql import collapse, words
from .sql import strip as trimmed

SEED = 17


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(table(spark, sf_dir, "documents"), "text")


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_distribution(table(spark, sf_dir, "documents"), F.col("source"))


def class_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.imbalance(class_distribution(spark, sf_dir))


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, sf_dir, "documents")
    return documents.where("doc_id % 5 <> 0"), documents.where("doc_id % 5 = 0")


def leakage_exact_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.leakage(*_halves(spark, sf_dir), "doc_id", "text")


def leakage_across_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the evaluation splits that stand word for word in train."""
    rows = table(spark, sf_dir, "enterprise_examples")
    return profile.leakage(rows.where("split = 'train'"), rows.where("split <> 'train'"), "example_id", "user_input")


def quality_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.warnings(dataset_profile(spark, sf_dir), leakage_exact_norm(spark, sf_dir), class_imbalance(spark, sf_dir))


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with text, the first of each normalised text."""
    documents = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "source", "text")
    return ranking.keep_first(documents, profile.norm_hash(F.col("text")), "doc_id").select("doc_id", "source")


def split_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.hashed_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SEED, 0.8, 0.1)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_assignments(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def remove_leaks_from_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train documents without those whose normalised text is in the evaluation part (an extension: the policy acts)."""
    train, evaluation = _halves(spark, sf_dir)
    hashed = train.withColumn("_h", profile.norm_hash(F.col("text")))
    return hashed.join(evaluation.select(profile.norm_hash(F.col("text")).alias("_h")).where("_h IS NOT NULL"), "_h", "left_anti").select("doc_id")


def token_stats_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "sft_rows").select("source", token_estimate(F.col("output")).alias("t"))
    p95 = ranking.order_statistics(counted, "t", ["source"], {"p95": profile.p95_index()})
    return counted.groupBy("source").agg(F.min("t").alias("min"), F.max("t").alias("max"), F.round(F.avg("t"), 2).alias("mean")).join(p95.drop("n"), "source")


def sft_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completion of each row that has an instruction and an output; a blank input is left out."""
    asked, given, answer = (strip(F.coalesce(c, F.lit(""))) for c in ("instruction", "input", "output"))
    rows = table(spark, sf_dir, "sft_rows").where((asked != "") & (answer != ""))
    prompt = F.concat(F.lit("### Instruction:\n"), asked, F.when(given != "", F.concat(F.lit("\n\n### Input:\n"), given)).otherwise(""), F.lit("\n\n### Response:\n"))
    return rows.select("row_id", F.sha2(prompt, 256).alias("prompt_sha"), F.length(prompt).alias("prompt_chars"), F.sha2(answer, 256).alias("completion_sha"))


def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row the masked prompt positions and the padding that its batch of eight adds; word positions stand for token ids."""
    rows = table(spark, sf_dir, "sft_rows").select("row_id", token_estimate(F.concat_ws(" ", "instruction", "input")).alias("n_prompt"), token_estimate(F.col("output")).alias("n_output"))
    batch = F.floor((F.col("row_id") - 1) / 8)
    sized = rows.withColumn("batch", batch).withColumn("n", F.col("n_prompt") + F.col("n_output"))
    longest = F.max("n").over(Window.partitionBy("batch"))  # eight rows
    labels = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.when(i <= F.col("n_prompt"), -100).otherwise(i))
    padded = F.concat(F.when(F.col("n") > 0, labels).otherwise(F.array().cast("array<int>")), F.array_repeat(F.lit(-100), (F.col("_longest") - F.col("n")).cast("int")))
    full = sized.withColumn("_longest", longest).withColumn("labels", padded)
    return full.select("row_id", "n_prompt", "n_output", F.size("labels").alias("padded"), F.size(F.filter("labels", lambda x: x == -100)).alias("masked"))


def json_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose props hold a k of at least 50, by type."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf_dir, "events").where(k >= 50).groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("sum_k"))


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three index formulas side by side, on events' values in tenths."""
    values = table(spark, sf_dir, "events").select("event_type", F.floor(F.col("value") * 10).cast("long").alias("v"))
    n = F.col("n")
    picks = {"p50_floor": F.floor(F.lit(0.5) * (n - 1)).cast("long"), "p95_floor": profile.p95_index(), "p95_min": F.least(n - 1, F.floor(F.lit(0.95) * n).cast("long"))}
    return ranking.order_statistics(values, "v", ["event_type"], picks)


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exp of the mean loss per type, infinite from a mean of 20; two branches on scaled event values."""
    events = table(spark, sf_dir, "events")
    scaled = events.select("event_type", F.explode(F.array(F.struct(F.lit("low").alias("scale"), (F.col("value") / 100).alias("loss")), F.struct(F.lit("high").alias("scale"), (F.col("value") + 20).alias("loss")))).alias("s"))
    mean = scaled.groupBy("event_type", "s.scale").agg(F.avg("s.loss").alias("loss"))
    return mean.select("event_type", "scale", F.round("loss", 6).alias("loss"), F.when(F.col("loss") >= 20, F.lit(float("inf"))).otherwise(F.round(F.exp("loss"), 6)).alias("perplexity"))


PREPARATION = {"train_ratio": 0.8, "val_ratio": 0.1, "test_ratio": 0.1, "seed": 42, "deduplicate": True, "leakage_policy": "fail"}


def dataset_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of the documents as a dataset: by the hash of all their rows, their schema and how they are prepared."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    schema = ",".join(f"{n} {t}" for n, t in documents.dtypes)
    return spark.createDataFrame([(profile.dataset_id(profile.content_hash(documents), schema, PREPARATION),)], "dataset_id string")


_F = {f.__name__: f for f in (dataset_profile, class_distribution, class_imbalance, leakage_exact_norm, leakage_across_splits, quality_warnings, dedupe_keep_first, split_assignments, split_counts, token_stats_by_source, sft_prompt, label_mask, json_field_filter, latency_percentiles, perplexity, dataset_id)}
QUERIES = _F | {"ext_leakage_remove_from_train": remove_leaks_from_train}



_PROFILE = f"""d AS (SELECT text IS NOT NULL AS v, sha256({collapse('text')}) AS h, CASE WHEN text IS NOT NULL THEN {words('text')} END AS t FROM documents),
  prof AS (SELECT count(*) AS total, count_if(v) AS valid, count_if(NOT v) AS invalid, count_if(v) - count(DISTINCT h) AS duplicates, min(t) AS tokens_min, max(t) AS tokens_max,
    round(avg(t), 2) AS tokens_mean, coalesce(round(count_if(v) / count(*), 4), 0.0) AS schema_validity,
    list_sort(list(t) FILTER (t IS NOT NULL))[1 + floor(0.95::DOUBLE * (count(t) - 1))::BIGINT] AS tokens_p95 FROM d)"""


def _leak(train: str, evaluation: str, key: str, text: str) -> str:
    return f"""firsts AS (SELECT {collapse(text)} AS h, arg_min({text}, {key}) AS f FROM ({train}) WHERE {text} IS NOT NULL GROUP BY 1),
  leaks AS (SELECT count_if(coalesce(e.{text} = f.f, FALSE)) AS exact_leaks, count_if(f.f IS NOT NULL) AS normalised_leaks, count(*) AS evaluation_rows FROM ({evaluation}) e LEFT JOIN firsts f ON f.h = {collapse('e.' + text)} WHERE e.{text} IS NOT NULL)"""


_DOC_LEAK = _leak("SELECT * FROM documents WHERE doc_id % 5 <> 0", "SELECT * FROM documents WHERE doc_id % 5 = 0", "doc_id", "text")
_BALANCE = "balance AS (SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / min(n), 4) AS ratio, max(n) / min(n) > 5.0 AS imbalanced FROM (SELECT source, count(*) AS n FROM documents WHERE source <> '' GROUP BY 1))"
_SPLIT = f"""ordered AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('{SEED}|' || doc_id), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
  splits AS (SELECT doc_id, CASE WHEN r < floor(n * 0.8::DOUBLE) THEN 'train' WHEN r < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ordered)"""
ORACLE = {
    "dataset_profile": f"WITH {_PROFILE} SELECT * FROM prof",
    "class_distribution": "SELECT source AS label, count(*) AS n FROM documents WHERE source <> '' GROUP BY 1",
    "class_imbalance": f"WITH {_BALANCE} SELECT * FROM balance",
    "leakage_exact_norm": f"WITH {_DOC_LEAK} SELECT * FROM leaks",
    "leakage_across_splits": f"WITH {_leak('SELECT * FROM enterprise_examples WHERE split = $$train$$', 'SELECT * FROM enterprise_examples WHERE split <> $$train$$', 'example_id', 'user_input')} SELECT * FROM leaks",
    "quality_warnings": f"""WITH {_PROFILE}, {_DOC_LEAK}, {_BALANCE}, w AS (
        SELECT 0 AS place, CASE WHEN invalid > 0 THEN invalid || ' invalid rows' END AS warning FROM prof
        UNION ALL SELECT 1, CASE WHEN duplicates > 0 THEN duplicates || ' duplicate rows' END FROM prof
        UNION ALL SELECT 2, CASE WHEN normalised_leaks > 0 THEN normalised_leaks || ' leaked evaluation rows' END FROM leaks
        UNION ALL SELECT 3, CASE WHEN imbalanced THEN 'class imbalance above 5.0' END FROM balance) SELECT * FROM w WHERE warning IS NOT NULL""",
    "dedupe_keep_first": f"SELECT doc_id, source FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {collapse('text')} ORDER BY doc_id) = 1",
    "split_assignments": f"WITH {_SPLIT} SELECT doc_id, split FROM splits",
    "split_counts": f"WITH {_SPLIT} SELECT split, count(*) AS n FROM splits GROUP BY 1",
    "ext_leakage_remove_from_train": f"SELECT doc_id FROM documents WHERE doc_id % 5 <> 0 AND (text IS NULL OR {collapse('text')} NOT IN (SELECT {collapse('text')} FROM documents WHERE doc_id % 5 = 0 AND text IS NOT NULL))",
    "token_stats_by_source": f"SELECT source, min(t) AS min, max(t) AS max, round(avg(t), 2) AS mean, list_sort(list(t))[1 + floor(0.95::DOUBLE * (count(t) - 1))::BIGINT] AS p95 FROM (SELECT source, coalesce({words('output')}, 0) AS t FROM sft_rows) GROUP BY 1",
    "sft_prompt": f"""WITH p AS (SELECT row_id, {trimmed('instruction')} AS i, {trimmed('input')} AS g, {trimmed('output')} AS o FROM sft_rows),
        q AS (SELECT row_id, '### Instruction:' || chr(10) || i || CASE WHEN g <> '' THEN chr(10) || chr(10) || '### Input:' || chr(10) || g ELSE '' END || chr(10) || chr(10) || '### Response:' || chr(10) AS prompt, o FROM p WHERE i <> '' AND o <> '')
        SELECT row_id, sha256(prompt) AS prompt_sha, length(prompt) AS prompt_chars, sha256(o) AS completion_sha FROM q""",
    "label_mask": f"""WITH s AS (SELECT row_id, {words("concat_ws(' ', instruction, input)")} AS n_prompt, coalesce({words('output')}, 0) AS n_output FROM sft_rows),
        p AS (SELECT *, max(n_prompt + n_output) OVER (PARTITION BY (row_id - 1) // 8) AS padded FROM s) SELECT row_id, n_prompt, n_output, padded, padded - n_output AS masked FROM p""",
    "json_field_filter": "SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS sum_k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 GROUP BY 1",
    "latency_percentiles": """WITH v AS (SELECT event_type, floor(value * 10)::BIGINT AS v FROM events WHERE value IS NOT NULL), l AS (SELECT event_type, list_sort(list(v)) AS l, count(*) AS n FROM v GROUP BY 1)
        SELECT event_type, n, l[1 + floor(0.5::DOUBLE * (n - 1))::BIGINT] AS p50_floor, l[1 + floor(0.95::DOUBLE * (n - 1))::BIGINT] AS p95_floor, l[1 + least(n - 1, floor(0.95::DOUBLE * n)::BIGINT)] AS p95_min FROM l""",
    "perplexity": """WITH s AS (SELECT event_type, 'low' AS scale, value / 100 AS loss FROM events UNION ALL SELECT event_type, 'high', value + 20 FROM events), m AS (SELECT event_type, scale, avg(loss) AS loss FROM s GROUP BY 1, 2)
        SELECT event_type, scale, round(loss, 6) AS loss, CASE WHEN loss >= 20 THEN 'inf'::DOUBLE ELSE round(exp(loss), 6) END AS perplexity FROM m""",}
