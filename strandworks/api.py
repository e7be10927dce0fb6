"""One object with a method for each thing that users do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import media, pack, profile, ranking, rules, search
from .sources import files, sinks


class Engine:
    """Operators by the verbs that users know; every method takes and returns DataFrames or plain values."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    # catalogue of media
    def compile_channels(self, path: str, provider: str, version: str = "1.0.0", limit: int | None = None) -> DataFrame:
        return media.project_assets(files.channel_file(self.spark, path, limit), provider, version)

    def compile_pack(self, assets: DataFrame, archive: str, work: str, pack_id: str, version: str, provider: str) -> dict:
        return pack.compile_pack(assets, archive, work, pack_id, version, provider)

    def validate_pack(self, archive: str, work: str) -> list[str]:
        return pack.validate_pack(self.spark, archive, work)

    def packs(self, home: str) -> pack.PackManager:
        return pack.PackManager(self.spark, home)

    # use
    def search(self, assets: DataFrame, text: str = "", constraints: dict[str, str] | None = None, limit: int = 20) -> DataFrame:
        return search.search(assets, text, constraints, limit)

    def recommend(self, assets: DataFrame, constraints: dict[str, str] | None = None, limit: int = 20) -> DataFrame:
        return search.recommend(assets, constraints, limit)

    def resolve(self, assets: DataFrame, item_id: str) -> DataFrame:
        return search.resolve(assets, item_id)

    def play(self, assets: DataFrame, query: str = "", item_id: str = "") -> DataFrame:
        return search.play(assets, query, item_id)

    def resume(self, assets: DataFrame) -> DataFrame:
        return search.resume(assets)

    def parse_intent(self, utterances: DataFrame, column: str = "utterance") -> DataFrame:
        return utterances.select("*", rules.parse_intent(F.col(column), service=True).alias("result")).select(*utterances.columns, "result.*")

    def log_failed_queries(self, parsed: DataFrame, path: str) -> None:
        sinks.append_failed_queries(parsed, path)

    # datasets
    def inspect(self, path: str, evaluation: str | None = None) -> DataFrame:
        """Profile of a JSON-lines file; with an evaluation file also its leakage."""
        rows = files.json_lines(self.spark, path)
        profiled = profile.profile(rows, "line", F.col("value"))
        if evaluation is None:
            return profiled
        other = files.json_lines(self.spark, evaluation).where("valid")
        return profiled.join(profile.leakage(rows.where("valid"), other, "pos", "line"), F.lit(True))

    def prepare(self, path: str, output: str, train: float = 0.8, validation: float = 0.1, seed: int = 42, evaluation: str | None = None, policy: str = "fail") -> DataFrame:
        """Valid rows without repetitions as a snapshot in splits; (split, n).

        Of rows in the evaluation file policy "fail" makes an error, "remove_from_train" leaves them out.
        """
        rows = files.json_lines(self.spark, path).where("valid").select("pos", "line")
        kept = ranking.keep_first(rows, profile.norm_hash(F.col("line")), "pos")
        if evaluation is not None:
            asked = files.json_lines(self.spark, evaluation).where("valid").select(profile.norm_hash(F.col("line")).alias("_h"))
            hashed = kept.withColumn("_h", profile.norm_hash(F.col("line")))
            if policy == "remove_from_train":
                kept = hashed.join(asked, "_h", "left_anti").select("pos", "line")
            elif policy != "fail":
                raise ValueError(f"unknown leakage policy: {policy}")
            elif not hashed.join(asked, "_h", "left_semi").isEmpty():
                raise ValueError("rows of the evaluation file are in the training file")
        sinks.write_snapshot(ranking.hashed_split(kept, "pos", seed, train, validation), output)
        return self.spark.read.parquet(output).groupBy("split").agg(F.count("*").alias("n"))
