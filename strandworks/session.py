"""Session defaults and the two things every operator may ask of a session: a shared folder and a table by name."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("strandworks")
    conf = LOCAL_CONF | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(partitions)}
    # executors' Python workers must find this package wherever the driver was started
    root = str(Path(__file__).resolve().parent.parent)
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, as a lazily scanned parquet DataFrame."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only a local session, as in tests, makes itself one."""
    context = spark.sparkContext
    set_ = context._jsc.sc().getCheckpointDir()
    if set_.isDefined():
        return set_.get()
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="strandworks-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(jpath)
    files.deleteOnExit(jpath)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """df written once as a table in the shared folder and read from there.

    A lost executor costs no recomputation, later reads share the work and prune columns, and unlike checkpoint() nothing
    is computed twice. The table is deleted when the driver ends.
    """
    path = new_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
