"""Recursions with several lags against a plain loop: NULLs, chunks, starting values, errors."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from macroseries.operators import recurrence
from macroseries.operators.autoregression import autoregression

KEYS = ("a", "b", None)


def quarter(k):
    return dt.date(2000 + k // 4, 1 + 3 * (k % 4), 1)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    out = []
    for e in KEYS:
        for k in range(40):
            out.append((e, quarter(k), rng.choice([None] + [float(rng.randint(1, 9))] * 12),
                        rng.choice([None] + [float(rng.randint(1, 9))] * 30)))
        out.append((e, None, 3.0, 1.0))
    return out + [("a", quarter(8), 50.0, 60.0)]


@pytest.fixture(scope="module")
def panel(spark, data):
    return spark.createDataFrame(data, "entity string, period date, y double, z double").repartition(5)


def loop(data, rule, start, end, init=None):
    """Row by row; ``rule(state, z)`` gives the new value, None for missing."""
    out = []
    for e in KEYS:
        state = ((init or {}).get(e, []) + [None] * 8)[:8]
        rows = [r for r in data if r[0] == e and r[1] is not None]
        for r in sorted(rows, key=lambda r: (r[1], r[2] or 0)):
            inside = (start is None or r[1] >= start) and (end is None or r[1] <= end)
            y = rule(state, r[3]) if inside else r[2]
            state = [y] + state[:7]
            out.append((e, r[1], y, r[3]))
        out += [r for r in data if r[0] == e and r[1] is None]
    return out


def check(got, want):
    def key(r):
        return str(r[0]), str(r[1]), -1.0 if r[3] is None else r[3]
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want) and sum(r[2] is not None for r in want) > 10
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[3] == w[3]
        assert (g[2] is None and w[2] is None) or math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-12)


def linear(lags):
    def rule(state, z):
        parts = [(a, state[i - 1]) for i, a in sorted(lags.items())] + [(0.1, z)]
        return None if any(v is None for _, v in parts) else sum(a * v for a, v in parts)
    return rule


@pytest.mark.parametrize("lags", [{1: 0.5, 2: 0.2, 4: -0.1}, {2: 0.5}, {1: 0.9}, {4: 0.5, 3: 0.0}])
@pytest.mark.parametrize("chunk", [3, 7, 256])
def test_autoregression_equals_a_loop(panel, data, lags, chunk):
    got = autoregression(panel, "y", lags, 0.1 * F.col("z"), quarter(6), quarter(30),
                         keys=["entity"], chunk=chunk)
    check(got.select("entity", "period", "y", "z").collect(),
          loop(data, linear(lags), quarter(6), quarter(30)))


@pytest.mark.parametrize("chunk", [3, 256])
def test_autoregression_from_starting_values(spark, panel, data, chunk):
    init = {"a": [1.0, 2.0, 3.0, 4.0], None: [5.0, 1.0]}
    table = spark.createDataFrame(list(init.items()), "entity string, init array<double>")
    lags = {1: 0.25, 2: 0.5}
    got = autoregression(panel, "y", lags, 0.1 * F.col("z"), keys=["entity"], chunk=chunk, init=table,
                         materialize_chunks=True)
    check(got.select("entity", "period", "y", "z").collect(),
          loop(data, linear(lags), None, None, init))
    assert autoregression(panel.filter("false"), "y", lags, keys=["entity"]).count() == 0


def test_autoregression_null_and_column_coefficients(spark):
    rows = [("k", quarter(k), float(k), None if k == 5 else 0.5) for k in range(9)]
    d = spark.createDataFrame(rows, "entity string, period date, y double, a double")
    got = {r["period"]: r["y"] for r in autoregression(
        d, "y", {2: F.col("a")}, 1.0, quarter(2), keys=["entity"], chunk=2).collect()}
    want = [0.0, 1.0]
    for k in range(2, 9):
        want.append(None if k == 5 or want[k - 2] is None else 0.5 * want[k - 2] + 1)
    assert [got[quarter(k)] for k in range(9)] == want


def test_autoregression_refuses_bad_lags(panel):
    for lags in ({}, {0: 1.0}, {17: 1.0}):
        with pytest.raises(ValueError):
            autoregression(panel, "y", lags, keys=["entity"])
    with pytest.raises(KeyError):
        autoregression(panel, "nothing", {1: 1.0}, keys=["entity"])


@pytest.mark.parametrize("blocks", [None, 1, 5])
def test_general_recurrence_of_order_three(spark, panel, data, blocks):
    def rule(state, z):
        if state[0] is None or state[2] is None or z is None:
            return None
        return min(0.5 * state[0] + 0.25 * state[2] + 1, z)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        got = recurrence.general_recurrence(
            panel, "y", lambda p, r: np.minimum(0.5 * p[0] + 0.25 * p[2] + 1, r["z"]), ["z"],
            quarter(6), quarter(30), keys=["entity"], blocks=blocks, order=3)
        check(got.select("entity", "period", "y", "z").collect(),
              loop(data, rule, quarter(6), quarter(30)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_general_recurrence_keeps_errors_to_their_keys(spark):
    rows = [(f"k{k}", quarter(t), 1.0 if t == 0 else None, float(t)) for k in range(40)
            for t in range(6)] + [("k7", None, 5.0, 1.0)]
    d = spark.createDataFrame(rows, "entity string, period date, y double, z double").withColumn(
        "n", F.substring("entity", 2, 3).cast("double"))

    def fn(prev, row):
        if np.any((row["n"] % 10 == 7) & (row["z"] == 3)):
            raise ValueError("no luck")
        return prev + row["z"]
    got = recurrence.general_recurrence(d, "y", fn, ["z", "n"], quarter(1), keys=["entity"],
                                        error_col="error").collect()
    assert len(got) == len(rows)
    for r in got:
        bad = r["entity"][1:].endswith("7")
        assert r["error"] == ("ValueError: no luck" if bad else None)
        t = None if r["period"] is None else int(r["z"])
        want = 5.0 if t is None else 1.0 if t == 0 else None if bad else 1.0 + t * (t + 1) / 2
        assert r["y"] == want
    with pytest.raises(Exception, match="no luck"):
        recurrence.general_recurrence(d, "y", fn, ["z", "n"], quarter(1), keys=["entity"]).collect()
