"""Publishing a table that others read meanwhile (S8): versions and a pointer.

A version is written to a folder of its own and checked there; then one small pointer file is replaced
by a rename, which readers see before or after, never half. A job that fails before the rename leaves
the published table as it was. The pointer lists the versions that are kept, newest first; those that
fall off the list are deleted, so a reader that began with the version before can finish.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path

POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """(Path class, file system, file context) that serve ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.Path(path).getFileSystem(conf)
    return hadoop.Path, fs, hadoop.FileContext.getFileContext(fs.getUri(), conf)


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions the pointer lists, newest first; empty if nothing is published."""
    path = path.rstrip("/")
    Path, fs, _ = _hadoop(spark, path)
    pointer = Path(f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return []
    stream = fs.open(pointer)
    try:
        return list(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split())
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, versions: list[str]) -> None:
    """Replace the pointer by a rename that overwrites."""
    Path, fs, context = _hadoop(spark, path)
    staged = Path(f"{path}/{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    try:
        out.write(bytearray("\n".join(versions), "utf-8"))
    finally:
        out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(staged, Path(f"{path}/{POINTER}"), how)


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None,
            keep: int = 2) -> str:
    """Write ``df`` as the next version of the table at ``path`` and make it current; returns the
    version's name.

    ``check`` gets the version as written and raises if it must not be published; then, as when the
    write fails, the version is deleted and readers go on with the one before. ``keep`` versions
    are kept, the current one included. One publisher at a time: of two that switch at once the later
    one wins. An empty table is published like any other. ``df`` may read the table it replaces.
    A killed driver can leave an unlisted folder below ``versions``, which no reader sees.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/versions/{name}"
    try:
        df.write.parquet(folder)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(folder))
        old = published_versions(spark, path)
        _switch(spark, path, [name, *old[:keep - 1]])
    except BaseException:
        if name not in published_versions(spark, path):
            delete_path(spark, folder)
        raise
    for gone in old[keep - 1:]:
        delete_path(spark, f"{path}/versions/{gone}")
    return name


def read_published(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The current version of the table at ``path``, or the one ``back`` versions before."""
    versions = published_versions(spark, path)
    if back >= len(versions):
        raise FileNotFoundError(f"{path}: {len(versions)} published version(s), asked for {back} back")
    return spark.read.parquet(f"{path.rstrip('/')}/versions/{versions[back]}")
