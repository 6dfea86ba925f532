"""Session defaults and the shared scratch folder.

Everything that has to be written part-way through a job (round-trip
sources, cut lineage of iterative graph jobs) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  That folder is shared by all
executors; a machine-local temporary folder is only used when the setting
is absent, which is the case in unit tests on ``local[*]``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  ANSI mode is Spark 4's default; the
# library guards every divide and cast so that it runs either way.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "macroseries", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only if the session has none."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="macroseries-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/macroseries-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (used only by tests that inspect files)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any Hadoop file system; nothing happens if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Rounds:
    """Tables of an iteration, as Parquet below one folder of the shared checkpoint folder.

    ``put`` writes a table and reads it back, so a lost executor costs a re-read and plans stay
    short; ``add`` appends to one; ``drop`` deletes those that no later round reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, name)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.get(name, df.schema)

    def add(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.path}/{name}")

    def get(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.path}/{name}")


__all__ = ["DEFAULTS", "get_spark", "checkpoint_dir", "scratch_path", "local_path",
           "delete_path", "Rounds"]


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it back
    (reliable ``checkpoint``): a result used by several branches of a plan
    is computed once, and its lineage is cut, so a lost executor costs a
    re-read, not a recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
