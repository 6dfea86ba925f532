"""Scans and sinks.

Everything stays a distributed Spark read or write: globbed Parquet with
schema merging, the source file as a column, header CSV panels, XML
catalogues, tables and views.  Paths may be any Hadoop URI (``s3a://``,
``gs://``, ``abfss://``, ``hdfs://``), so publishing a result (S8) is a
write in place, no copy step.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import parse_quarter
from ..functions.scalar import nan_to_null


def scan_parquet(spark: SparkSession, paths: str | Sequence[str], merge_schema: bool = True,
                 with_file: str | None = None) -> DataFrame:
    """``read_parquet(glob, union_by_name=True[, filename=True])``.

    Files with different column sets are merged by name (missing columns
    are NULL).  ``with_file`` adds the source file URI as a column, taken
    from the hidden ``_metadata`` struct, which costs no extra scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)
    if with_file:
        df = df.withColumn(with_file, F.col("_metadata.file_path"))
    return df


def union_by_name(frames: Iterable[DataFrame], types: Mapping[str, str] | None = None) -> DataFrame:
    """Union of frames by column name, missing columns NULL.

    Where file groups disagree on a column's type, ``types`` casts it first,
    which is the case ``mergeSchema`` cannot widen.
    """
    out = None
    for df in frames:
        if types:
            df = df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def series_from_path(path, pattern: str = r"raw/(.+?)\.parquet(?:/|$)") -> Column:
    """Series id from a file path.

    The URI form of ``_metadata.file_path`` escapes characters (a blank is
    ``%20``), so the path is decoded first, with ``+`` protected.  A path
    that does not match gives ``''``, like ``regexp_extract`` in SQL.  The
    default pattern accepts both a file ``raw/<id>.parquet`` and the
    directory ``raw/<id>.parquet/part-...`` that Spark writes.
    """
    p = F.col(path) if isinstance(path, str) else path
    decoded = F.url_decode(F.regexp_replace(p, r"\+", "%2B"))
    return F.regexp_extract(decoded, pattern, 1)


def load_quarterly_csv(spark: SparkSession, path: str, period: str = "period",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Wide quarterly panel from header CSV (S3).

    The first column holds quarters (``2040Q1`` or ``2040q1``) and becomes
    a DATE column ``period``; every other column name is lower-cased and its
    values read as DOUBLE (text that is not a number, and NaN, become NULL).
    Columns in ``keep`` (e.g. a partition column) are left as they are.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    first = raw.columns[0]
    cols = [parse_quarter(F.col(f"`{first}`")).alias(period)]
    for c in raw.columns[1:]:
        if c in keep:
            cols.append(F.col(f"`{c}`"))
        else:
            cols.append(nan_to_null(F.col(f"`{c}`").try_cast("double")).alias(c.lower()))
    return raw.select(*cols)


def write_csv_partitioned(df: DataFrame, path: str, by: str | Sequence[str],
                          mode: str = "overwrite") -> str:
    """One CSV output per value of ``by`` (S4), with a header row."""
    by = [by] if isinstance(by, str) else list(by)
    df.write.mode(mode).partitionBy(*by).option("header", True).csv(path)
    return path


def materialize_table(df: DataFrame, name: str, path: str | None = None,
                      fmt: str = "parquet") -> DataFrame:
    """Materialise a query as a table (S5, S8): ``saveAsTable``; with a
    ``path`` the table is external and lives there (shared storage)."""
    w = df.write.mode("overwrite").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a view (S6); a later model reads it by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# Schema of the model catalogue's ``variable`` elements.
COEFF = T.ArrayType(T.StructType([T.StructField("cf_name", T.StringType()),
                                  T.StructField("cf_value", T.DoubleType())]))
CATALOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("equation_type", T.StringType()),
    T.StructField("stochastic_type", T.StringType()),
    T.StructField("standard_equation", T.StructType([
        T.StructField("python_equation", T.StringType()),
        T.StructField("coeff", COEFF)])),
    T.StructField("mce_equation", T.StructType([
        T.StructField("mce_group", T.StringType()),
        T.StructField("python_equation", T.StringType()),
        T.StructField("coeff", COEFF)])),
])


# Most variables in one file of a written catalogue, about a kilobyte each.
CATALOG_FILE_ROWS = 20_000


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """XML model catalogue, one row per ``variable`` element.

    Spark's built-in XML source; the schema is given, so there is no
    inference pass over the files.
    """
    return (spark.read.format("xml").option("rowTag", "variable")
            .schema(CATALOG_SCHEMA).load(path))


def write_catalog(df: DataFrame, path: str, file_rows: int = CATALOG_FILE_ROWS) -> str:
    """Write a catalogue in the same XML shape (root ``model``), ``file_rows`` variables a file at
    most: a reader can't split an XML file, so one task reads a file whole."""
    (df.write.mode("overwrite").format("xml").option("rootTag", "model")
     .option("rowTag", "variable").option("maxRecordsPerFile", file_rows).save(path))
    return path
