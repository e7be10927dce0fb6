"""Packs: assets with postings, counts, manifest and checksum as an archive; validation, and installed versions."""

from __future__ import annotations

import hashlib
import json
import shutil
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import index_terms, strip

# What a pack must hold, and the fields of its manifest.
ENTRIES = ["indexes/facets.json", "manifest.json", "media/assets.parquet", "metadata/report.json", "indexes/terms.parquet"]
MANIFEST = ["asset_count", "checksum", "pack_id", "playable_count", "provider", "version"]
_VERSION = r"\d{1,5}\.\d{1,5}\.\d{1,5}"


def postings(assets: DataFrame) -> DataFrame:
    """(term, ids): the assets that each term of their title, genres and language is in, pre-aggregated per asset."""
    said = F.concat_ws(" ", "title", F.array_join("genres", " "), F.array_join("language", " "))
    each = assets.select("id", F.explode(index_terms(said)).alias("term"))
    return each.groupBy("term").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def facets(assets: DataFrame) -> DataFrame:
    """(facet, value, n): assets by first genre and by each language."""
    genre = assets.select(F.lit("genre").alias("facet"), F.coalesce(F.get("genres", F.lit(0)), F.lit("unknown")).alias("value"))
    language = assets.select(F.lit("language").alias("facet"), F.explode("language").alias("value"))
    return genre.unionByName(language).groupBy("facet", "value").agg(F.count("*").alias("n"))


def _digest(root: Path) -> str:
    """Hash over the sorted names and contents of all files but the manifest."""
    total = hashlib.sha256()
    for file in sorted(p for p in root.rglob("*") if p.is_file()):
        name = file.relative_to(root).as_posix()
        if name != "manifest.json":
            total.update(name.encode())
            total.update(hashlib.sha256(file.read_bytes()).digest())
    return total.hexdigest()


def _single(df: DataFrame, target: Path) -> None:
    target.parent.mkdir(parents=True, exist_ok=True)
    folder = target.parent / f".{target.name}"
    df.coalesce(1).write.mode("overwrite").parquet(str(folder))
    shutil.move(str(next(folder.glob("part-*.parquet"))), target)
    shutil.rmtree(folder)


def compile_pack(assets: DataFrame, archive: str, work: str, pack_id: str, version: str, provider: str) -> dict:
    """Write a pack of the assets and return its manifest; no assets, or an id given twice, are an error.

    A pack is a single archive for a device, so its parts are single files.
    """
    counts = assets.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.coalesce(strip(F.col("stream_uri")), F.lit("")) != "").alias("playable")).first()
    if not counts["n"]:
        raise ValueError("a pack needs at least one asset")
    if counts["ids"] != counts["n"]:
        raise ValueError("asset ids must be unique")
    root = Path(work)
    shutil.rmtree(root, ignore_errors=True)
    _single(assets.orderBy("id"), root / "media/assets.parquet")
    _single(postings(assets).orderBy("term"), root / "indexes/terms.parquet")
    counted: dict[str, dict[str, int]] = {}
    for r in facets(assets).orderBy("facet", "value").collect():  # values of two facets
        counted.setdefault(r["facet"], {})[r["value"]] = r["n"]
    for name, value in (("indexes/facets.json", counted), ("metadata/report.json", {"asset_count": counts["n"], **counted})):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(json.dumps(value, sort_keys=True, ensure_ascii=False))
    manifest = {"pack_id": pack_id, "version": version, "provider": provider, "asset_count": counts["n"], "playable_count": counts["playable"], "checksum": _digest(root)}
    (root / "manifest.json").write_text(json.dumps(manifest, sort_keys=True))
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(p for p in root.rglob("*") if p.is_file()):
            out.write(file, file.relative_to(root).as_posix())
    return manifest


def validate_pack(spark: SparkSession, archive: str, work: str) -> list[str]:
    """Everything that is wrong with a pack; an empty list if nothing is."""
    root = Path(work)
    shutil.rmtree(root, ignore_errors=True)
    try:
        with zipfile.ZipFile(archive) as packed:
            unsafe = [n for n in packed.namelist() if n.startswith("/") or ".." in n.split("/")]
            if unsafe:
                return [f"unsafe entry {n}" for n in unsafe]
            packed.extractall(root)
    except (OSError, zipfile.BadZipFile) as error:
        return [f"no archive: {error}"]
    errors = [f"missing entry {n}" for n in ENTRIES if not (root / n).is_file()]
    try:
        manifest = json.loads((root / "manifest.json").read_text())
    except (OSError, ValueError):
        return [*errors, "manifest can't be read"]
    errors += [f"manifest lacks {n}" for n in MANIFEST if n not in manifest]
    if manifest.get("checksum") != _digest(root):
        errors.append("checksum differs")
    if (root / "media/assets.parquet").is_file():
        rows = spark.read.parquet(str(root / "media/assets.parquet")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(strip(F.col("stream_uri")), F.lit("")) != "").alias("playable")).first()
        errors += ["no assets"] * (not rows["n"]) + ["no playable asset"] * (not rows["playable"])
        errors += [f"{name} differs: {manifest.get(name)} and {there}" for name, there in (("asset_count", rows["n"]), ("playable_count", rows["playable"])) if manifest.get(name) != there]
    return errors


class PackManager:
    """Installed packs in folders by id and version, of which one version is active."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, Path(home)

    def install(self, archive: str, activate: bool = True) -> dict:
        """Install a valid pack; the first error of another is raised."""
        errors = validate_pack(self.spark, archive, str(self.home / ".incoming"))
        if errors:
            raise ValueError(errors[0])
        manifest = json.loads((self.home / ".incoming/manifest.json").read_text())
        target = self.home / manifest["pack_id"] / manifest["version"]
        shutil.rmtree(target, ignore_errors=True)
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.move(str(self.home / ".incoming"), target)
        if activate:
            self.activate(manifest["pack_id"], manifest["version"])
        return manifest

    def versions(self, pack_id: str) -> list[str]:
        """Installed versions, the newest by number last."""
        found = [p.name for p in (self.home / pack_id).glob("*") if p.is_dir()]
        return sorted(found, key=lambda v: tuple(int(x) if x.isdigit() else -1 for x in v.split(".")))

    def activate(self, pack_id: str, version: str) -> None:
        if version not in self.versions(pack_id):
            raise ValueError(f"{pack_id} {version} is not installed")
        (self.home / pack_id / "active").write_text(version)

    def deactivate(self, pack_id: str) -> None:
        (self.home / pack_id / "active").unlink(missing_ok=True)

    def remove(self, pack_id: str, version: str) -> None:
        if self.active(pack_id) == version:
            self.deactivate(pack_id)
        shutil.rmtree(self.home / pack_id / version, ignore_errors=True)

    def active(self, pack_id: str) -> str | None:
        marker = self.home / pack_id / "active"
        return marker.read_text() if marker.is_file() else None

    def assets(self, pack_id: str) -> DataFrame:
        version = self.active(pack_id)
        if version is None:
            raise ValueError(f"{pack_id} is not active")
        return self.spark.read.parquet(str(self.home / pack_id / version / "media/assets.parquet"))


def job_bundle(spark: SparkSession, files: str) -> DataFrame:
    """(path, size, sha256) of the files of a portable job, hashed where they are read."""
    return spark.read.format("binaryFile").load(files).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
