"""References to records that do not exist, kept incrementally.

The state is keyed by target and lies in key buckets in a shared folder: the lives of every parent seen so far, the
references seen so far, and the references that dangle now. A batch of arrivals probes new references against the parent
index, and probes again exactly those stored references whose target got a new or changed life: arriving parents resolve
waiting orphans, deletions reopen them. Only buckets in which the batch has keys are read or written.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_folder

LIFE = ["kind", "key", "born", "died", "seen_at"]
REFERENCE = ["kind", "key", "at", "table_name", "row_key", "field_name"]
DANGLING = ["table_name", "row_key", "field_name", "reason", "kind", "key", "at"]
BUCKETS = 16  # parts by key in which the state lies; so many that a usual batch touches few of them
CHUNK = 512  # lives of one parent in one row of the index
FOREVER = "9999-12-31 23:59:59"


def latest_lives(lives: DataFrame) -> DataFrame:
    """Of rows with the same kind, key and birth the one seen last; exact repeats collapse before the shuffle.

    A null birth means that the parent was there at all times; a null death that it is still there.
    """
    seen = F.struct(F.col("seen_at"), F.col("died"))
    latest = lives.groupBy("kind", "key", "born").agg(F.max(seen).alias("_last"))
    return latest.select("kind", "key", "born", F.col("_last.died").alias("died"), F.col("_last.seen_at").alias("seen_at"))


def parent_index(lives: DataFrame) -> DataFrame:
    """Rows of at most CHUNK lives of a parent, by birth: (kind, key, lives, since, until, _first, _always).

    A row answers for times from `since` until before `until`, and a parent's rows together for all times. Of each life it
    has the birth and how far it and all earlier lives reach, so one row tells whether any life holds at a time.
    """
    own = Window.partitionBy("kind", "key").orderBy(F.asc_nulls_first("born"))
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    never = F.lit(FOREVER).cast("timestamp")
    ranked = lives.select("kind", "key", "born", F.coalesce("died", never).alias("_d")).select(
        "kind", "key", "born", F.floor((F.row_number().over(own) - 1) / CHUNK).alias("chunk"), F.max("_d").over(upto).alias("reach"), F.lead("born").over(own).alias("_next"),
        F.first("born").over(upto).alias("_first"), F.max(F.col("born").isNull()).over(upto).alias("_always"))
    rows = ranked.groupBy("kind", "key", "chunk").agg(
        F.collect_list(F.struct(F.col("born").alias("b"), F.col("reach").alias("r"))).alias("lives"), F.min("born").alias("since"),
        F.max(F.coalesce("_next", never)).alias("until"), F.min("_first").alias("_first"), F.max("_always").alias("_always"))
    return rows.withColumn("since", F.when(F.col("chunk") > 0, F.col("since"))).drop("chunk")


def dangling(references: DataFrame, index: DataFrame) -> DataFrame:
    """References without a living target: missing (no such key), late (every life begins later) or deleted (otherwise).

    A null key is no reference. A reference without a time dangles only if its key is missing. A life holds from its
    birth until before its death. Both sides are shuffled by key, where AQE splits a hot target of the reference side; of
    a parent's index rows exactly one answers for a time, so no row multiplies.
    """
    asked = references.where("key IS NOT NULL").select(*REFERENCE, F.coalesce("at", F.lit("0001-01-01").cast("timestamp")).alias("_t")).alias("a")
    answers = (F.col("i.since").isNull() | (F.col("i.since") <= F.col("a._t"))) & ((F.col("a._t") < F.col("i.until")) | (F.col("i.until") == F.lit(FOREVER).cast("timestamp")))
    probed = asked.join(index.alias("i"), (F.col("a.kind") == F.col("i.kind")) & (F.col("a.key") == F.col("i.key")) & answers, "left")
    alive = F.exists("i.lives", lambda x: (x.b.isNull() | (x.b <= F.col("a._t"))) & (F.col("a._t") < x.r))
    reason = (
        F.when(F.col("i.lives").isNull(), "missing")
        .when(F.col("a.at").isNull() | alive, F.lit(None))
        .when(~F.col("i._always") & (F.col("i._first") > F.col("a.at")), "late")
        .otherwise("deleted")
    )
    return probed.select(*[f"a.{c}" for c in REFERENCE], reason.alias("reason")).where("reason IS NOT NULL").select(*DANGLING)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("kind", "key"), F.lit(buckets)).cast("int")


class OrphanStore:
    """The state in a folder: tables "lives", "references", "arrived" (lives as they came) and "pending", each in versions and buckets.

    References and arrivals are appended; of lives and pending references a batch writes the buckets it touches anew. The
    manifest says which versions make up each bucket; it is written after the tables of a batch, so a batch that fails
    leaves the state as it was, and a store opened on the folder goes on from there.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder or new_folder(spark), buckets
        self.schemas: dict[str, T.StructType] = {}
        self.version = 0
        self.held: dict[str, dict[int, list[int]]] = {name: {} for name in ("lives", "references", "arrived", "pending")}
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if self._files.exists(self._path(f"{self.folder}/manifest")):
            last = max((f.getPath().getName() for f in self._files.listStatus(self._path(f"{self.folder}/manifest"))), key=int)
            said = json.loads(spark.read.text(f"{self.folder}/manifest/{last}", wholetext=True).first()[0])
            self.version, self.buckets = said["version"], said["buckets"]
            self.held = {name: {int(b): v for b, v in of.items()} for name, of in said["held"].items()}
            self.schemas = {name: T.StructType.fromJson(x) for name, x in said["schemas"].items()}

    def _write(self, table: str, df: DataFrame, *by: str) -> None:
        self.schemas[table] = df.schema
        # AQE splits a bucket that is large, and joins small ones
        df.withColumn("bucket", _bucket(self.buckets)).hint("rebalance", "bucket").write.option("compression", "zstd").mode("overwrite").partitionBy(*by, "bucket").parquet(f"{self.folder}/{table}" if by else f"{self.folder}/{table}/version={self.version}")

    def _buckets(self, table: str, version: int) -> set[int]:
        path = self._path(f"{self.folder}/{table}/version={version}")
        names = [f.getPath().getName() for f in self._files.listStatus(path)] if self._files.exists(path) else []
        return {int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")}

    def read(self, table: str, buckets: set[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows of some buckets (all if not given), as of now or of one version."""
        held = self.held[table] if version is None else {b: [version] for b in self._buckets(table, version)}
        paths = [f"{self.folder}/{table}/version={v}/bucket={b}" for b, versions in sorted(held.items()) if buckets is None or b in buckets for v in versions]
        schema = self.schemas[table]
        return self.spark.read.schema(T.StructType([f for f in schema if f.name != "version"])).parquet(*paths) if paths else self.spark.createDataFrame([], T.StructType([f for f in schema if f.name != "version"]))

    def advance(self, new_lives: DataFrame, new_references: DataFrame) -> None:
        """Take in one batch of arrivals: lives (LIFE) and references (REFERENCE); rows with a null key are left out."""
        self.version += 1
        self._write("arrived", new_lives.where("key IS NOT NULL").select(*LIFE))
        self._write("references", new_references.where("key IS NOT NULL").select(*REFERENCE))
        self._step()

    def advance_all(self, new_lives: DataFrame, new_references: DataFrame, batches: int) -> list[DataFrame]:
        """Take in batches 1, 2, ... given by the column `version` of both streams, each read once; pending after each."""
        first = self.version
        for table, df, columns in (("arrived", new_lives, LIFE), ("references", new_references, REFERENCE)):
            self._write(table, df.where("key IS NOT NULL").select((F.col("version") + first).alias("version"), *columns), "version")
        out = []
        for _ in range(batches):
            self.version += 1
            self._step()
            out.append(self.pending())
        return out

    def _step(self) -> None:
        now = self.version
        changed_in, asked_in = self._buckets("arrived", now), self._buckets("references", now)
        touched = changed_in | asked_in
        arrived = self.read("arrived", version=now)
        if changed_in:
            before = [self.read("lives", changed_in)] if self.held["lives"] else []
            self._write("lives", latest_lives(reduce(DataFrame.unionByName, before, arrived)))
            self.held["lives"] |= {b: [now] for b in changed_in}
        elif "lives" not in self.schemas:
            self.schemas["lives"] = self.schemas["arrived"]
        asked = self.read("references", version=now)
        pending = None
        if now > 1 and changed_in:
            changed = arrived.select("kind", "key").distinct()
            asked = self.read("references", changed_in).join(changed, ["kind", "key"], "left_semi").select(*REFERENCE).unionByName(asked)
            pending = self.read("pending", touched).join(changed, ["kind", "key"], "left_anti").select(*DANGLING)
        elif now > 1:
            pending = self.read("pending", touched).select(*DANGLING)
        opened = dangling(asked, parent_index(self.read("lives", touched)))
        self._write("pending", opened if pending is None else pending.unionByName(opened))
        there = self._buckets("pending", now)
        self.held["pending"] |= {b: [now] if b in there else [] for b in touched}
        for table, buckets in (("references", asked_in), ("arrived", changed_in)):
            for b in buckets:
                self.held[table].setdefault(b, []).append(now)
        said = {"version": now, "buckets": self.buckets, "held": self.held, "schemas": {k: s.jsonValue() for k, s in self.schemas.items()}}
        self._say(f"{self.folder}/manifest/{now}", json.dumps(said))

    def _say(self, path: str, text: str) -> None:
        stream = self._files.create(self._path(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def pending(self) -> DataFrame:
        """The references that dangle now."""
        return self.read("pending").select(*DANGLING)


def snapshot(pending: DataFrame, period: str = "month") -> DataFrame:
    """Pending orphans per table, field, reason and period of the row's time, pre-aggregated before the shuffle."""
    at = F.date_trunc(period, "at").alias("period")
    return pending.groupBy("table_name", "field_name", "reason", at).agg(F.count("*").alias("n_dangling"))


def replay(lives: DataFrame, references: DataFrame, arrived: str, cuts: list, folder: str | None = None) -> list[DataFrame]:
    """The pending references after each of the arrival batches that the cuts (timestamps, ascending) make of two arrival streams.

    Both streams need a column `arrived`; rows without one belong to the first batch.
    """
    number = reduce(lambda n, cut: n + F.coalesce((F.col(arrived) >= F.lit(cut)).cast("int"), F.lit(0)), cuts, F.lit(1))
    store = OrphanStore(references.sparkSession, folder)
    return store.advance_all(lives.withColumn("version", number), references.withColumn("version", number), len(cuts) + 1)
