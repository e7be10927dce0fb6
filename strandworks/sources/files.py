"""Readers: JSON lines, training files by extension, playlists, experiment folders and archives."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


class MalformedLine(ValueError):
    """A line of a strict file that is no JSON object."""


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line, value, valid) of each line that isn't blank; value is a VARIANT, null where the line can't be read.

    pos rises in the order of lines within a file, with gaps.
    """
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    kept = lines.where(strip(F.col("value")) != "")
    return kept.select("pos", F.col("value").alias("line"), F.try_parse_json("value").alias("value")).withColumn("valid", F.col("value").isNotNull())


def strict_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """json_lines of a file whose every line must be an object; the first other line is an error that names its number."""
    rows = json_lines(spark, path)
    kind = F.schema_of_variant("value")
    wrong = rows.where(~F.col("valid") | ~kind.startswith("OBJECT")).orderBy("pos").limit(1).collect()
    if wrong:
        before = rows.where(F.col("pos") < wrong[0]["pos"]).count()
        raise MalformedLine(f"{path}: row {before + 1} is no JSON object")
    return rows


def training_file(spark: SparkSession, path: str) -> DataFrame:
    """instruction, input and output of a .json, .jsonl or .csv file; columns that it lacks are null, other files an error."""
    suffix = Path(path).suffix.lower()
    if suffix == ".jsonl":
        rows = spark.read.json(path)
    elif suffix == ".json":
        rows = spark.read.json(path, multiLine=True)
    elif suffix == ".csv":
        rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    else:
        raise ValueError(f"unsupported training file: {path}")
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in ("instruction", "input", "output")])


def split_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The train, validation and test part of a snapshot that is partitioned by split; parts are pruned, not filtered."""
    rows = spark.read.parquet(path)
    return {name: rows.where(F.col("split") == name).drop("split") for name in ("train", "validation", "test")}


def fetch(source: str, timeout: int = 30) -> str:
    """Text of a file or web address, read by the driver."""
    if source.startswith(("http://", "https://")):
        with urlopen(source, timeout=timeout) as response:  # noqa: S310
            return response.read().decode("utf-8")
    return Path(source).read_text(encoding="utf-8")


def playlists(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): playlists, a whole file per row, for operators.media.playlist_channels."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def channel_file(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Channels of a JSON file with a `channels` list; playlists, told by their first line, are read as such."""
    from ..operators.media import playlist_channels

    head = spark.read.text(path).limit(1).collect()
    if head and head[0][0].startswith("#EXTM3U"):
        channels = playlist_channels(playlists(spark, path))
        return channels.orderBy("path", "index").limit(limit) if limit is not None else channels
    schema = "channels array<struct<id string, name string, streamUrl string, logoUrl string, category string, country string, languages array<string>, flavor string, group string, altNames array<string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("channels").alias("index", "c"))
    named = rows.select("index", "c.id", "c.name", F.col("c.streamUrl").alias("stream_url"), F.col("c.logoUrl").alias("logo"), F.coalesce("c.category", "c.group").alias("category"), "c.country", "c.languages", "c.flavor", F.col("c.altNames").alias("alt_names"))
    return named.orderBy("index").limit(limit) if limit is not None else named


def experiments(spark: SparkSession, folder: str) -> DataFrame:
    """(id, value) of each experiment's manifest in a folder, in the order of ids; unreadable ones are left out."""
    rows = spark.read.text(f"{folder}/*/manifest.json", wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("value"))
    return rows.where("value IS NOT NULL").select(F.element_at(F.split("path", "/"), -2).alias("id"), "value").orderBy("id")


def archive_entries(spark: SparkSession, path: str) -> DataFrame:
    """(archive, entry, size, sha256, text) of each file inside of archives; entries that are no text have a null text."""
    import hashlib

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for entry in sorted(archive.namelist()):
                        raw = archive.read(entry)
                        try:
                            text = raw.decode("utf-8")
                        except UnicodeDecodeError:
                            text = None
                        rows.append((name, entry, len(raw), hashlib.sha256(raw).hexdigest(), text))
            yield pd.DataFrame(rows, columns=["archive", "entry", "size", "sha256", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(opened, "archive string, entry string, size long, sha256 string, text string")


def load_config(path: str, known: dict[str, set[str]]) -> dict:
    """A YAML or JSON configuration whose sections and keys must all be known."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML needs the yaml package") from error
        config = yaml.safe_load(text) or {}
    else:
        config = json.loads(text)
    unknown = sorted(set(config) - set(known)) + sorted(f"{s}.{k}" for s, keys in config.items() if s in known and isinstance(keys, dict) for k in set(keys) - known[s])
    if unknown:
        raise ValueError(f"unknown configuration keys: {', '.join(unknown)}")
    return config
