"""Replication vectors against the row-by-row bootstrap, also where residuals are missing."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from macroseries.operators import bootstrap, recurrence, replications

N, SEED = 30, 7


def quarter(k):
    return dt.date(2000 + k // 4, 1 + 3 * (k % 4), 1)


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(1)
    rows = [(e, quarter(k), rng.random(), None if (e, k) == ("b", 9) else rng.random())
            for e in ("a", "b", "late") for k in range(4 if e == "late" else 0, 12)]
    return spark.createDataFrame(rows + [("a", None, 1.0, 1.0)],
                                 "entity string, period date, x double, z double").repartition(3)


def test_shock_vectors_equal_the_join(panel):
    hist, sim = (quarter(0), quarter(7)), (quarter(8), quarter(11))
    resid = panel.filter(F.col("period") <= quarter(7))
    draws = bootstrap.bootstrap_draws(panel.select("period").filter(F.col("period") >= sim[0]), N,
                                      *hist, SEED)
    want = bootstrap.bootstrap_shocks(panel, resid, draws, ["x", "z"], N, 4, *sim, keys=["entity"])
    got = replications.explode_replications(replications.shock_vectors(
        panel, resid, ["x", "z"], N, *hist, *sim, SEED, keys=["entity"]), ["x", "z"], keys=["entity"])
    want = sorted(map(str, want.select(got.columns).collect()))
    assert sorted(map(str, got.collect())) == want
    # the late key lacks half of its history: fewer draws, but every draw of the others
    assert 2 * 4 * N < len(want) < 3 * 4 * N


def test_paths_growth_and_fan(spark):
    rows = [("k", [(quarter(t), [True, t != 1, True], [1.0, 2.0, None if t == 2 else 3.0])
                   for t in range(3)], 10.0)]
    df = spark.createDataFrame(rows, "entity string, steps array<struct<at:date,"
                                     "drawn:array<boolean>,s:array<double>>>, init double")
    p = replications.vector_paths(df, "y", 0.5, "s", "init", 3)
    p = replications.growth_vectors(p, "y", "g", 1)
    steps = p.first()["steps"]
    assert [s["y"] for s in steps] == [[6.0, 7.0, 8.0], [4.0, None, 7.0], [3.0, 5.5, None]]
    assert steps[0]["g"] == [None, None, None]
    assert steps[1]["g"] == [pytest.approx((4 / 6 - 1) * 100), None, pytest.approx(-12.5)]
    long = replications.explode_replications(p, ["y"], keys=["entity"])
    fan = {(r["period"], r["series"]): tuple(r)[3:] for r in replications.fan_vectors(
        p, ["y", "g"], keys=["entity"]).collect()}
    want = {(r["period"], "y"): tuple(r)[2:] for r in bootstrap.quantile_fan(
        long, "y", ["entity", "period"]).collect()}
    assert {k: v for k, v in fan.items() if k[1] == "y"} == want
    assert fan[(quarter(0), "g")] == (None,) * 4


def test_one_entity_s_failures_cost_others_nothing(spark):
    bad = {("a", 0), ("a", 2), ("a", 3), (None, 5)}
    rows = [(e, k, "no luck" if (e, k) in bad else None) for e in ("a", "b", None) for k in range(6)]
    status = spark.createDataFrame(rows, "entity string, repl int, error string")
    got = bootstrap.keep_good_replications(status, 4, 2, keys=["entity"]).collect()
    kept = {e: sorted(r["repl"] for r in got if r["entity"] == e and r["keep"]) for e in ("a", "b", None)}
    assert len(got) == 18 and kept == {"a": [1, 3, 4, 5], "b": [0, 1, 2, 3], None: [0, 1, 2, 3]}
    alone = bootstrap.keep_good_replications(status.filter("entity = 'a'").drop("entity"), 4, 2)
    assert sorted(r["repl"] for r in alone.collect() if r["keep"]) == kept["a"]


def test_steps_of_a_replication_count_once(spark):
    """A row per step gives what a row per replication gives, in one exchange by the keys."""
    rng = random.Random(4)
    rows = [(e, r, "bad" if rng.random() < 0.4 else None) for e in ("a", "b", None) for r in range(9)]
    status = spark.createDataFrame(rows, "entity string, repl int, error string")
    steps = status.withColumn("step", F.explode(F.array(F.lit(1), F.lit(2), F.lit(2), F.lit(None))))
    want = bootstrap.keep_good_replications(status, 5, 2, keys=["entity"])
    got = bootstrap.keep_good_replications(steps, 5, 2, keys=["entity"], steps="step")
    assert got.columns == ["entity", "repl", "error", "step", "keep"]
    kept = {(r["entity"], r["repl"]): r["keep"] for r in want.collect()}
    assert len(kept) == 27 and len(set(kept.values())) == 2
    rows = got.collect()
    assert len(rows) == 4 * 27 and all(kept[r["entity"], r["repl"]] == r["keep"] for r in rows)


def test_shocks_become_rows_after_the_join(spark, panel):
    """The join with the baseline moves a row per pair of quarters, not one per replication."""
    hist, sim, many = (quarter(0), quarter(7)), (quarter(8), quarter(11)), 400
    draws = bootstrap.bootstrap_draws(panel.select("period").filter(F.col("period") >= sim[0]), many,
                                      *hist, SEED)
    args = (panel, panel.filter(F.col("period") <= quarter(7)), draws, ["x", "z"], many, 4, *sim)
    got = bootstrap.bootstrap_shocks(*args, keys=["entity"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
    salted = bootstrap.bootstrap_shocks(*args, keys=["entity"], broadcast_rows=0, salt=5)
    assert sorted(map(str, got.collect())) == sorted(map(str, salted.collect()))


def test_paths_are_dealt_by_some_of_their_keys(spark):
    """With ``deal`` no later step by those keys needs an exchange, and rows are the same."""
    rows = [(e, r, quarter(k), float(r + k), 1.0) for e in ("a", "b", None) for r in range(40)
            for k in range(4)]
    df = spark.createDataFrame(rows, "entity string, repl int, period date, x double, y double")

    def step(prev, row):
        if (row["x"] == 17).any():
            raise ValueError("seventeen")
        return prev + row["x"]
    got, want = (recurrence.general_recurrence(df, "y", step, ["x"], quarter(1), keys=["entity", "repl"],
                                               error_col="error", deal=deal) for deal in (["entity"], []))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.filter("error IS NOT NULL").count() == 3 * 4 * 3
    kept = bootstrap.keep_good_replications(got, 30, 2, keys=["entity"], steps="period")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    with pytest.raises(ValueError):
        recurrence.general_recurrence(df, "y", step, ["x"], keys=["entity"], error_col="e", deal=["x"])


def test_numbers_of_keys_hold_across_batches():
    numbers, seen, rng = recurrence._Numbers(), {}, random.Random(2)
    for _ in range(60):
        code = [rng.randrange(-1 << 40, 1 << 40) for _ in range(500)] + rng.sample(sorted(seen), min(len(seen), 500))
        got = numbers(np.array(code, dtype=np.int64)).tolist()
        for c, n in zip(code, got):
            assert seen.setdefault(c, n) == n
    assert sorted(seen.values()) == list(range(len(seen)))
