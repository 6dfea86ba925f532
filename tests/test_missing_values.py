"""NULL keys, NULL periods, nested paths and large ids keep their rows and values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from macroseries.functions import scalar
from macroseries.operators import checks, ordered, panel, recurrence, residuals
from macroseries.sources import files


def test_linear_recurrence_keeps_every_row(spark):
    q = [dt.date(2000 + k // 4, 1 + 3 * (k % 4), 1) for k in range(4)]
    data = [("a", q[0], 1.0), ("a", q[1], 9.0), ("a", q[2], 9.0), ("a", None, 7.0),
            (None, q[0], 2.0), (None, q[1], 9.0)]
    d = spark.createDataFrame(data, "entity string, period date, y double")
    for chunk in (256, 1):
        out = recurrence.linear_recurrence(d, "y", 0.5, 1.0, q[1], q[3], chunk=chunk)
        got = {(r["entity"], r["period"]): r["y"] for r in out.collect()}
        assert got == {("a", q[0]): 1.0, ("a", q[1]): 1.5, ("a", q[2]): 1.75, ("a", None): 7.0,
                       (None, q[0]): 2.0, (None, q[1]): 2.0}


def test_general_recurrence_is_the_same_in_any_bucket(spark):
    q = [dt.date(2000 + k // 4, 1 + 3 * (k % 4), 1) for k in range(5)]
    data = [("gap", q[0], 1.0, 1.0), ("gap", q[2], None, 1.0), ("gap", q[3], None, 1.0),
            ("gap", None, 7.0, 1.0), (None, q[0], 2.0, 0.0), (None, q[1], None, 1.0),
            ("twice", q[0], 4.0, 0.0), ("twice", q[1], None, 1.0), ("twice", q[1], None, 2.0)]
    data += [(f"full{k}", t, 1.0, 1.0) for k in range(5) for t in q]
    d = spark.createDataFrame(data, "entity string, period date, y double, z double")
    want = sorted(map(str, recurrence.linear_recurrence(
        d, "y", 0.5, F.col("z"), q[1], q[4]).select(d.columns).collect()))
    for kw in ({}, *({"vector_keys": ["entity"], "blocks": n} for n in (1, 7, 97))):
        got = recurrence.general_recurrence(d, "y", lambda prev, r: 0.5 * prev + r["z"], ["z"],
                                            q[1], q[4], **kw)
        assert sorted(map(str, got.select(d.columns).collect())) == want


def test_densify_keeps_undated_and_repeated_quarters(spark):
    q = [dt.date(2000 + k // 4, 1 + 3 * (k % 4), 1) for k in range(6)]
    data = [("a", q[1], 1.0), ("a", q[1], 2.0), ("a", q[4], 3.0), ("a", None, 4.0),
            (None, q[2], 5.0), ("undated", None, 6.0)]
    d = spark.createDataFrame(data, "entity string, period date, v double")

    def rows(df):
        return sorted(((r["entity"], r["period"], r["v"]) for r in df.collect()), key=str)
    assert rows(panel.densify(d)) == sorted(
        [*data, ("a", q[2], None), ("a", q[3], None)], key=str)
    inside = [("a", q[2], None), ("a", q[3], None), ("a", None, 4.0), (None, q[2], 5.0),
              (None, q[3], None), ("undated", None, 6.0)]
    got = rows(panel.densify(d, start=q[2], end=q[3]))
    assert [r for r in got if r[0] != "undated"] == sorted(
        [r for r in inside if r[0] != "undated"], key=str)
    assert ("undated", None, 6.0) in got
    early = rows(panel.densify(d.filter("entity = 'a' AND v = 3"), start=q[2], end=q[5]))
    assert early == sorted([("a", q[2], None), ("a", q[3], None), ("a", q[4], 3.0),
                            ("a", q[5], None)], key=str)


def test_scan_columns_carries_for_null_keys_and_dates(spark):
    data = [(None, dt.date(2000, 1, 5), 1.0), (None, dt.date(2000, 2, 5), None), (None, None, None),
            ("k", dt.date(2000, 1, 5), 4.0), ("k", dt.date(2000, 3, 5), None)]
    d = spark.createDataFrame(data, "k string, t date, v double")
    kw = dict(order="t", keys=["k"], lag=["v"], ffill=["v"], ffill_suffix="_f")
    plain = ordered.scan_columns(d, **kw)
    months = ordered.scan_columns(d, bucket=F.date_trunc("month", "t"), **kw)
    cols = ["k", "t", "v", "v__lag", "v_f"]
    assert sorted(map(str, plain.select(cols).collect())) == sorted(
        map(str, months.select(cols).collect()))


def test_backtest_index_beyond_int(spark):
    d = spark.createDataFrame([(3_000_000_000,)], "task_index long")
    assert residuals.backtest_fanout(d).first()["year"] == 3_000_002_004


def test_series_id_of_a_nested_path(spark):
    d = spark.createDataFrame([("s3://b/raw/us/GDP.parquet",), ("/raw/CPI.parquet/part-0.parquet",)],
                              "p string")
    assert [r[0] for r in d.select(files.series_from_path(F.col("p"))).collect()] == ["us/GDP", "CPI"]


def test_residual_name_is_one_rule(spark):
    names = ["x", "x_3", "x_3_b", "_1", "a_b"]
    d = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in d.select(scalar.endo_to_trac("n")).collect()] == [
        scalar.residual_name(n) for n in names]


def test_check_unique_by_digest_on_both_plans(spark):
    long = "x" * 5000
    data = [("a", 1), ("a", 1), ("", 2), ("", 2), ("", 3), (None, 4), (None, 4), (long, 5), (long, 5)]
    d = spark.createDataFrame(data, "t string, n int")
    for rows in (0, 1_000_000):
        got = {r["t"]: r["n"] for r in checks.check_unique(d, "t", broadcast_rows=rows).collect()}
        assert got == {"a": 2, "": 3, long: 2}
        pairs = checks.check_unique(d.toDF("t", "k"), ["t", "k"], broadcast_rows=rows).collect()
        assert {(r["t"], r["k"]): r["n"] for r in pairs} == {("a", 1): 2, ("", 2): 2, (long, 5): 2}
    assert checks.check_unique(d.filter("n > 9"), "t").count() == 0


def test_definitions_merge_by_name(spark):
    a, b, c = ((F.lit(k), F.lit(-k)) for k in range(3))
    assert residuals.merge_equations({"x": a, "y": b}, {"y": c, "z": a}) == {"x": a, "y": c, "z": a}
    with pytest.raises(ValueError):
        residuals.merge_equations({"x": a}, {"x": F.lit(1)})
