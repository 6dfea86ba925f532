"""Hand-computed fixtures (FIXTURES.md) and documented invariants."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from macroseries.functions import periods as P
from macroseries.operators import bootstrap as B
from macroseries.operators import catalog as C
from macroseries.operators import checks as CK
from macroseries.operators import graph as G
from macroseries.operators import indicators as I
from macroseries.operators import panel as PN
from macroseries.operators import recurrence as R
from macroseries.operators import residuals as RS
from macroseries.operators.ordered import scan_columns
from macroseries.session import scratch_path
from macroseries.sources import files as SRC

D = dt.date
TS = dt.datetime


def q(y, n):
    return D(y, 3 * n - 2, 1)


# ---------------------------------------------------------------- indicator model
def test_indicator_fixture(spark):
    obs = spark.createDataFrame([
        ("CPIAUCSL", TS(2024, 1, 1), 100.0), ("CPIAUCSL", TS(2024, 2, 1), 101.0),
        ("VIXCLS", TS(2024, 1, 15), 13.0), ("GDPC1", TS(2024, 1, 1), 500.0),
    ], "series_id string, date timestamp, observation_value double")
    series = ["FEDFUNDS", "CPIAUCSL", "GDPC1", "UNRATE", "VIXCLS", "WALCL"]
    names = {"FEDFUNDS": "fed_funds_rate", "CPIAUCSL": "cpi", "GDPC1": "real_gdp",
             "UNRATE": "unemployment_rate", "VIXCLS": "vix", "WALCL": "fed_assets"}
    out = I.indicator_table(obs, series, names, {"inflation_mom": "cpi"},
                            ["real_gdp", "vix", "fed_assets"], ["fed_funds_rate", "unemployment_rate"])
    rows = [r.asDict() for r in out.collect()]
    assert [r["date"] for r in rows] == [TS(2024, 2, 1), TS(2024, 1, 15), TS(2024, 1, 1)]
    assert [r["inflation_mom"] for r in rows] == [None, None, None]
    assert [r["real_gdp"] for r in rows] == [500.0, 500.0, 500.0]
    assert [r["vix"] for r in rows] == [13.0, 13.0, None]


def test_bucketed_scan_equals_single_task_scan(spark, sf_dir):
    from macroseries.plans.queries import _wide
    w = _wide(spark, sf_dir)
    a = scan_columns(w, "date", lag=["purchase"], ffill=["click", "view"],
                     bucket=F.date_trunc("day", F.col("date")))
    b = scan_columns(w, "date", lag=["purchase"], ffill=["click", "view"], bucket=None)
    cols = ["date", "purchase__lag", "click", "view"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


# ---------------------------------------------------------------- recurrences
def _lur_panel(spark):
    return spark.createDataFrame(
        [("a", q(2040, k), 4.0 if k == 1 else None, 5.0) for k in range(1, 5)],
        "entity string, period date, lur double, lurnat double")


def test_linear_recurrence_fixture(spark):
    df = R.linear_recurrence(_lur_panel(spark), "lur", 0.9, 0.1 * F.col("lurnat"),
                             start="2040Q2", end="2040Q4")
    got = [r.lur for r in df.orderBy("period").collect()]
    assert got[0] == 4.0
    assert np.allclose(got[1:], [4.1, 4.19, 4.271])


def test_general_recurrence_fixture(spark):
    df = R.general_recurrence(_lur_panel(spark), "lur", lambda p, r: 0.9 * p + 0.1 * r["lurnat"],
                              ["lurnat"], start="2040Q2", end="2040Q4")
    got = [r.lur for r in df.orderBy("period").collect()]
    assert np.allclose(got, [4.0, 4.1, 4.19, 4.271])


def test_chunked_recurrence_equals_single_chunk(spark, sf_dir):
    from macroseries.plans.standins import supplier_panel
    q0 = supplier_panel(spark, sf_dir).withColumn("y", F.col("qty"))
    one = R.linear_recurrence(q0, "y", 0.5, 0.1 * F.col("qty"), start="1996Q1")
    many = R.linear_recurrence(q0, "y", 0.5, 0.1 * F.col("qty"), start="1996Q1", chunk=3)
    a = {(r.entity, r.period): r.y for r in one.collect()}
    b = {(r.entity, r.period): r.y for r in many.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or math.isclose(a[k], b[k], rel_tol=1e-12)


def test_decay_fixture(spark):
    df = spark.createDataFrame([("x", q(2040, 1), -0.0045), ("x", q(2040, 2), 1.0),
                                ("x", q(2040, 3), 1.0)], "entity string, period date, e double")
    got = [r.e for r in R.shock_decay(df, "e", 0.5, "2040Q2").orderBy("period").collect()]
    assert np.allclose(got, [-0.0045, -0.00225, -0.001125])


def test_growth_to_level_fixture(spark):
    rates = [6.8, 5.2, 4.5, 3.4, 2.7]
    rows = [("x", q(2039, 4), 100.0, None)] + [
        ("x", q(2040 + (i // 4), i % 4 + 1), None, g) for i, g in enumerate(rates)]
    df = spark.createDataFrame(rows, "entity string, period date, xgdp double, g double")
    out = PN.growth_to_level(df, "xgdp", "g", "2040Q1", "2041Q1")
    got = [r.xgdp for r in out.orderBy("period").collect()]
    want = 100.0 * np.cumprod([(g / 100 + 1) ** 0.25 for g in rates])
    assert got[0] == 100.0 and np.allclose(got[1:], want)


def test_series_rejects_leads_and_unknown_names(spark):
    s = PN.Series(_lur_panel(spark))
    with pytest.raises(ValueError):
        s("lur", 1)
    with pytest.raises(KeyError):
        s("nope", -1)
    with pytest.raises(KeyError):
        R.linear_recurrence(_lur_panel(spark), "nope", 0.5, 1.0, start="2040Q2")


# ---------------------------------------------------------------- panel edits
def test_edits_leave_outside_rows_unchanged(spark, sf_dir):
    from macroseries.plans.standins import supplier_panel
    base = supplier_panel(spark, sf_dir)
    edited = PN.add_shock(PN.set_values(PN.set_range(base, "qty", 0.0, "1998Q1", "1998Q4"),
                                        "rev", "1999Q1", [1.0, 2.0]), "qty", "2000Q1", 5.0)
    outside = ~F.col("period").between(D(1998, 1, 1), D(2000, 1, 1))
    cols = ["entity", "period", "qty", "rev"]
    assert sorted(base.filter(outside).select(cols).collect()) == \
        sorted(edited.filter(outside).select(cols).collect())


def test_unstack_of_stack_is_identity(spark, sf_dir):
    from macroseries.plans.standins import supplier_panel
    base = supplier_panel(spark, sf_dir).select("entity", "period", "qty", "rev")
    back = PN.drop_lead_columns(PN.unstack_leads(PN.stack_leads(base, "1998Q1", 4),
                                                 ["qty", "rev"], "1998Q1", 4))
    assert sorted(base.collect()) == sorted(back.select(base.columns).collect())


def test_lead_name_quirk():
    assert PN.is_lead_name("x_2y") and PN.is_lead_name("zrff5_1")
    assert not PN.is_lead_name("x_2y", anchored=True)


def test_trajectory_lists_must_match(spark):
    with pytest.raises(ValueError):
        PN.trajectory_override(_lur_panel(spark), ["lur"], ["a", "b"], ["c"])


def test_parse_quarter_either_case(spark):
    df = spark.createDataFrame([("2040Q1",), ("2040q3",), ("2040Q5",), ("junk",)], "s string")
    got = [r.p for r in df.select(P.parse_quarter("s").alias("p")).collect()]
    assert got == [D(2040, 1, 1), D(2040, 7, 1), None, None]


def test_report_pad_rounds_half_to_even(spark):
    df = spark.range(1, 41).select(F.col("id").alias("n"))
    got = {r.n: r.p for r in df.select("n", P.report_pad("n").alias("p")).collect()}
    for n, p in got.items():
        assert p == max(min(round(n / 4), 6), 2)


# ---------------------------------------------------------------- residuals, bootstrap
def test_residual_closure_and_demean(spark, sf_dir):
    from macroseries.plans.queries import _equations, _residual_panel
    r = _residual_panel(spark, sf_dir)
    c = RS.residual_closure(r, _equations(r)).filter(
        F.col("period").between(D(1996, 1, 1), D(2001, 10, 1)))
    assert c.filter(~F.col("qty_closes") | ~F.col("rev_closes")).count() == 0
    dm = B.demean(r, ["qty_trac"], "1996Q1", "1999Q4")
    means = dm.groupBy("entity").agg(F.avg("qty_trac").alias("m")).collect()
    assert all(abs(x.m) < 1e-6 for x in means if x.m is not None)


def test_draws_do_not_depend_on_partitioning(spark, sf_dir):
    sim = spark.createDataFrame([(q(2040, k),) for k in range(1, 5)], "period date")
    a = B.bootstrap_draws(sim.repartition(1), 50, "1975Q1", "2018Q4", 7)
    b = B.bootstrap_draws(sim.repartition(17), 50, "1975Q1", "2018Q4", 7)
    assert sorted(a.collect()) == sorted(b.collect())
    lo, hi = D(1975, 1, 1), D(2018, 10, 1)
    assert all(lo <= r.drawn_period <= hi for r in a.collect())


def test_keep_good_replications_rule(spark):
    status = spark.createDataFrame([(i, "boom" if i in (1, 3, 4) else None) for i in range(7)],
                                   "repl int, error string")
    keep = {r.repl: r.keep for r in B.keep_good_replications(status, 4, 2).collect()}
    # failures 1 and 3 are dropped; 4 stays with its error; first 4 of the rest
    assert [k for k, v in sorted(keep.items()) if v] == [0, 2, 4, 5]


def test_fan_bands_are_ordered(spark, sf_dir):
    from macroseries.plans.queries import quantile_fan
    bad = quantile_fan(spark, sf_dir).filter(
        (F.col("lo90") > F.col("lo70")) | (F.col("lo70") > F.col("hi70")) |
        (F.col("hi70") > F.col("hi90")))
    assert bad.count() == 0


def test_backtest_fixture(spark):
    tasks = spark.range(2).select(F.col("id").alias("task_index"))
    got = [tuple(r) for r in RS.backtest_fanout(tasks).orderBy("task_index").collect()]
    assert got == [(0, 2004, 2004.0, -1002.0), (1, 2005, 2003.0, -1001.0)]


def test_domain_violations_strict_raises(spark):
    df = spark.createDataFrame([("a", q(2040, 1), 0.0)], "entity string, period date, x double")
    ex = {"log_x": (F.when(F.col("x") > 0, F.ln("x")), ["x"])}
    assert RS.domain_violations(df, ex, ["entity"]).count() == 1
    with pytest.raises(Exception):
        RS.domain_violations(df, ex, ["entity"], strict=True).collect()


# ---------------------------------------------------------------- checks
def test_boundary_frames(spark):
    neg = spark.createDataFrame([("2024-01-01", -0.005, 100.0)], "date string, interest_rate double, gdp double")
    assert neg.collect()[0].interest_rate == -0.005
    gap = spark.createDataFrame([("2024-01-01", 100.0), ("2024-01-02", None)], "date string, gdp double")
    audit = {r.column: r.n_null for r in CK.null_audit(gap).collect()}
    assert audit == {"date": 0, "gdp": 1}


def test_nullable_key_checks(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    assert df.filter(F.col("id") == 1).count() == 1
    assert CK.check_not_null(df, "id").count() == 1
    assert CK.check_unique(df, "id").count() == 0
    with pytest.raises(CK.DataTestError):
        CK.raise_if_any(CK.check_not_null(df, "id"), label="not_null id")


# ---------------------------------------------------------------- catalogue, graphs
def test_tokens_fixture(spark):
    eqs = spark.createDataFrame(
        [("ptr", "ptr - ptr_aerr = 0.9 * ptr(-1) + 0.05 * picxfe(-1) + 0.05 * pitarg(-1)")],
        "name string, equation string")
    t = C.tokens(eqs.select("name", F.regexp_replace("equation", r"\s+", "").alias("equation")))
    got = [(r.variable, r.offset) for r in t.orderBy("pos").collect()]
    assert got == [("ptr", 0), ("ptr_aerr", 0), ("ptr", -1), ("picxfe", -1), ("pitarg", -1)]


def test_coefficient_rename(spark):
    cat = spark.createDataFrame(
        [("x", {"python_equation": "x=y_x_2", "coeff": [("y_x(2)", 0.5)]})],
        "name string, standard_equation struct<python_equation:string,"
        "coeff:array<struct<cf_name:string,cf_value:double>>>")
    assert [r.cf_name for r in C.coefficients(cat).collect()] == ["y_x_2"]


def test_xml_catalog_round_trip(spark):
    cat = spark.createDataFrame([
        ("x", "Behavioral", "YES", ("x = 0.5 * x(-1) + y_x_1", [("y_x(1)", 0.25)]), None),
        ("z", "Exogenous", None, None, None)], SRC.CATALOG_SCHEMA)
    path = scratch_path(spark, "xmltest")
    SRC.write_catalog(cat, path)
    back = {r.name: r for r in SRC.read_catalog(spark, path).collect()}
    assert back["x"].standard_equation.coeff[0].cf_value == 0.25
    assert back["z"].standard_equation is None and back["z"].stochastic_type is None


def test_graph_fixture(spark):
    nodes = spark.createDataFrame([(n,) for n in "abcd"], "node string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")],
                                  "src string, dst string")
    lv = {r.node: r.level for r in G.topo_levels(nodes, edges).collect()}
    assert lv == {"a": 0, "b": None, "c": None, "d": None}
    comps = G.scc(nodes, edges)
    ssc = G.smallest_source_component(nodes, edges, comps, G.topo_levels(nodes, edges))
    assert sorted(r.node for r in ssc.collect()) == ["b", "c"]
    order = {r.node: r.block_level for r in G.block_order(nodes, edges, comps).collect()}
    assert order["a"] < order["b"] == order["c"] < order["d"]


def test_block_order_respects_every_edge(spark, sf_dir):
    from macroseries.plans.queries import _graph
    n, e = _graph(spark, sf_dir)
    bo = G.block_order(n, e)
    lv = {r.node: (r.block, r.block_level) for r in bo.collect()}
    for r in e.collect():
        (bs, ls), (bd, ld) = lv[r.src], lv[r.dst]
        assert bs == bd or ls < ld


def test_growth_over_observed_values(spark):
    wide = spark.createDataFrame([(TS(2024, 1, 1), 100.0), (TS(2024, 1, 15), None),
                                  (TS(2024, 2, 1), 101.0)], "date timestamp, cpi double")
    prev_row = {r.date: r.g for r in I.inflation_mom(wide, "cpi", name="g").collect()}
    prev_obs = {r.date: r.g for r in I.inflation_mom(wide, "cpi", name="g",
                                                     over_observed=True).collect()}
    assert prev_row[TS(2024, 2, 1)] is None
    assert math.isclose(prev_obs[TS(2024, 2, 1)], 1.0)


def test_overrides_set_and_add(spark):
    panel = spark.createDataFrame([("a", q(2040, 1), 1.0, 10.0), ("a", q(2040, 2), None, 20.0)],
                                  "entity string, period date, x double, y double")
    ov = spark.createDataFrame([("a", q(2040, 1), "x", 5.0), ("a", q(2040, 2), "y", 1.0)],
                               "entity string, period date, series string, value double")
    s = {r.period: (r.x, r.y) for r in PN.apply_overrides(panel, ov, ["x", "y"]).collect()}
    assert s == {q(2040, 1): (5.0, 10.0), q(2040, 2): (None, 1.0)}
    a = {r.period: (r.x, r.y) for r in PN.apply_overrides(panel, ov, ["x", "y"], mode="add").collect()}
    assert a == {q(2040, 1): (6.0, 10.0), q(2040, 2): (None, 21.0)}


def test_missing_series_raises(spark):
    req = spark.createDataFrame([("xgdp",), ("lur",)], "name string")
    present = spark.createDataFrame([("xgdp",)], "name string")
    with pytest.raises(CK.MissingDataError):
        CK.raise_if_any(CK.missing_names(req, present), CK.MissingDataError, "missing series")


def test_csv_panel_load(spark):
    path = scratch_path(spark, "csvtest")
    spark.createDataFrame([("2040Q1", "1.5", "x"), ("2040q2", "NaN", "2")],
                          "Period string, XGDP string, LUR string") \
        .coalesce(1).write.option("header", True).csv(path)
    got = sorted(tuple(r) for r in SRC.load_quarterly_csv(spark, path).collect())
    assert got == [(D(2040, 1, 1), 1.5, None), (D(2040, 4, 1), None, 2.0)]


def test_salted_shock_join_equals_broadcast(spark, sf_dir):
    from macroseries.plans import queries as Q
    resid = Q._residual_panel(spark, sf_dir)
    dm = B.demean(resid, ["qty_trac"], Q.HIST_START, Q.HIST_END)
    draws = Q._draws(resid)
    args = (resid, dm, draws, ["qty_trac"], 40, 8, Q.SIM_START, Q.SIM_END)
    a = B.bootstrap_shocks(*args).filter(F.col("repl") < 40)
    b = B.bootstrap_shocks(*args, broadcast_rows=0, salt=7).filter(F.col("repl") < 40)
    assert sorted(a.collect()) == sorted(b.collect())


def test_keyed_bucketed_scan_equals_plain_window(spark, sf_dir):
    from pyspark.sql import Window
    from macroseries.plans.standins import supplier_panel
    q0 = supplier_panel(spark, sf_dir).select("entity", "period", "qty")
    got = scan_columns(q0, "period", keys=["entity"], lag=["qty"], ffill=["qty"],
                       bucket=F.year("period"), ffill_suffix="_ff")
    w = Window.partitionBy("entity").orderBy("period")
    want = q0.select("entity", "period", F.lag("qty").over(w).alias("qty__lag"),
                     F.last("qty", ignorenulls=True).over(
                         w.rowsBetween(Window.unboundedPreceding, 0)).alias("qty_ff"))
    cols = ["entity", "period", "qty__lag", "qty_ff"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_pct_change_fill_option(spark):
    df = spark.createDataFrame([("a", q(2040, k), v) for k, v in
                                [(1, 100.0), (2, None), (3, 110.0)]],
                               "entity string, period date, x double")
    plain = {r.period: r.g for r in PN.pct_change_n(df, ["x"], 1, suffix="_g")
             .select("period", F.col("x_g").alias("g")).collect()}
    filled = {r.period: r.g for r in PN.pct_change_n(df, ["x"], 1, suffix="_g", fill=True)
              .select("period", F.col("x_g").alias("g")).collect()}
    assert plain[q(2040, 3)] is None
    assert math.isclose(filled[q(2040, 3)], 10.0) and math.isclose(filled[q(2040, 2)], 0.0)
