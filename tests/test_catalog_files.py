"""A catalogue's size decides how many partitions and files it has, not the cut of the part table."""

from pyspark.sql import functions as F

from macroseries.plans import standins
from macroseries.session import scratch_path
from macroseries.sources import files


def parts(spark, n):
    return spark.range(n).select(
        F.col("id").alias("p_partkey"), F.lit("red tin").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("SMALL").alias("p_type"), (F.col("id") % 50 + 1).cast("int").alias("p_size"),
        F.lit(9.5).alias("p_retailprice"))


def test_a_large_catalogue_has_many_partitions(spark, monkeypatch):
    d = scratch_path(spark, "parts")
    parts(spark, 1000).coalesce(1).write.parquet(f"{d}/part.parquet")
    monkeypatch.setattr(standins, "CATALOG_ROWS", 100)
    cat = standins.catalog_frame(spark, d)
    held = [r["n"] for r in cat.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(held) == 1000 and len(held) == 10 and max(held) <= 110
    assert cat.select("name").distinct().count() == 1000


def test_an_empty_catalogue(spark):
    d = scratch_path(spark, "parts")
    parts(spark, 0).write.parquet(f"{d}/part.parquet")
    assert standins.catalog_frame(spark, d).count() == 0


def test_a_catalogue_is_written_in_files_of_few_variables(spark):
    d = scratch_path(spark, "parts")
    parts(spark, 90).coalesce(1).write.parquet(f"{d}/part.parquet")
    cat = standins.catalog_frame(spark, d).drop("p_brand")
    path = files.write_catalog(cat, scratch_path(spark, "xml"), file_rows=20)
    back = files.read_catalog(spark, path)
    held = [r["n"] for r in back.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sorted(held) == [10, 20, 20, 20, 20]
    names = back.select("name", "standard_equation.python_equation")
    want = cat.select("name", "standard_equation.python_equation")
    assert sorted(map(str, names.collect())) == sorted(map(str, want.collect()))
