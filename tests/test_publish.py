"""Publishing by version and pointer: readers never see a half table; and range-pruned grids."""

import os

import pytest
from pyspark.sql import functions as F

from macroseries.functions import periods as P
from macroseries.operators import panel as PN
from macroseries.plans.queries import QUERIES
from macroseries.plans.standins import supplier_panel, supplier_panel_slice
from macroseries.session import local_path, scratch_path
from macroseries.sources import publish as PUB


def ids(df):
    return sorted(r["id"] for r in df.collect())


def versions_on_disk(path):
    return sorted(os.listdir(local_path(path) + "/versions"))


def test_a_failed_publish_leaves_the_old_table(spark):
    path = scratch_path(spark, "publish-test")
    with pytest.raises(FileNotFoundError):
        PUB.read_published(spark, path)
    first = PUB.publish(spark.range(5), path)
    reader = PUB.read_published(spark, path)

    def refuse(t):
        assert t.count() == 9
        raise ValueError("refused")

    with pytest.raises(ValueError):
        PUB.publish(spark.range(9), path, refuse)
    # a job that dies after some of its tasks have written
    broken = spark.range(0, 1000, 1, 20).select(
        F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        PUB.publish(broken, path)
    assert PUB.published_versions(spark, path) == [first] == versions_on_disk(path)
    assert ids(PUB.read_published(spark, path)) == ids(reader) == list(range(5))


def test_versions_are_pruned_and_may_read_what_they_replace(spark):
    path = scratch_path(spark, "publish-test")
    PUB.publish(spark.range(1), path, keep=2)
    names = []
    for k in range(1, 4):
        before = PUB.read_published(spark, path)
        names.append(PUB.publish(before.union(spark.range(k, k + 1)), path, keep=2))
        assert ids(before) == list(range(k))
    assert PUB.published_versions(spark, path) == names[:-3:-1]
    assert versions_on_disk(path) == sorted(names[-2:])
    assert ids(PUB.read_published(spark, path)) == [0, 1, 2, 3]
    assert ids(PUB.read_published(spark, path, back=1)) == [0, 1, 2]
    PUB.publish(spark.range(3).filter("id < 0"), path, keep=1)
    assert ids(PUB.read_published(spark, path)) == [] and len(versions_on_disk(path)) == 1
    with pytest.raises(ValueError):
        PUB.publish(spark.range(1), path, keep=0)


def test_slice_reads_only_its_range(spark, sf_dir):
    got = QUERIES["period_slice"](spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    whole = supplier_panel(spark, sf_dir)
    for start, end in (("1990Q1", "1992Q3"), ("1998Q4", "2003Q1"), ("1997Q2", "1997Q2"),
                       ("1997Q3", "1997Q2")):
        part = supplier_panel_slice(spark, sf_dir, start, end)
        assert sorted(part.collect()) == sorted(P.slice_periods(whole, start, end).select(
            *part.columns).collect())


def test_sliced_grid_of_odd_rows(spark):
    extents = spark.sql("""SELECT * FROM VALUES
        ('a', DATE'2000-01-01', DATE'2001-01-01'), (NULL, DATE'2000-07-01', DATE'2000-10-01'),
        ('b', NULL, NULL), ('c', DATE'1990-01-01', DATE'1991-01-01') t(entity, first, last)""")
    measures = spark.sql("""SELECT * FROM VALUES
        ('a', DATE'2000-07-01', 1.0D), ('a', DATE'2000-07-01', 2.0D), (NULL, DATE'2000-07-01', 3.0D),
        ('a', DATE'2005-01-01', 4.0D), ('b', DATE'2000-07-01', 5.0D), ('a', NULL, 6.0D)
        t(entity, period, x)""")
    got = PN.sliced_grid(extents, measures, "2000Q2", "2000Q4").collect()
    assert sorted([(r["entity"], str(r["period"]), r["x"]) for r in got], key=str) == sorted([
        ("a", "2000-04-01", None), ("a", "2000-07-01", 1.0), ("a", "2000-07-01", 2.0),
        ("a", "2000-10-01", None), (None, "2000-07-01", 3.0), (None, "2000-10-01", None)], key=str)
    assert PN.sliced_grid(extents.filter("false"), measures, "2000Q2", "2000Q4").count() == 0
