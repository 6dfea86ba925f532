"""Registered queries: name -> builder(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in
full; its DuckDB twin lives in :mod:`macroseries.plans.oracles` under the same
name, with the same column names.
"""

from __future__ import annotations

from typing import Callable, Dict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import scalar as S
from ..operators import indicators as I
from ..operators import panel as PN
from ..operators import autoregression as AR
from ..operators import recurrence as R
from ..session import materialize
from .standins import (EVENT_SERIES, FFILL_SERIES, GROWTH_SERIES, RAW_SERIES,
                       observations, supplier_panel, supplier_panel_slice, table)

QUERIES: Dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c):
    """Round results of transcendental functions (ln, exp, pow): engines may
    differ in the last bit there; arithmetic results are left exact."""
    return F.round(c, 6)


# --------------------------------------------------------------------------
# Indicator model


def _wide(spark, d):
    return I.pivot_long(observations(spark, d), "date", "series_id", "observation_value",
                        EVENT_SERIES)


@query
def pivot_indicators(spark, d):
    return _wide(spark, d)


@query
def inflation_mom(spark, d):
    # the ordered scan reads its input twice: write the small wide table once
    w = materialize(_wide(spark, d).select("date", "purchase"))
    return I.inflation_mom(w, "purchase", name="purchase_mom")


@query
def forward_fill(spark, d):
    w = materialize(_wide(spark, d).select("date", "click", "signup", "view"))
    return I.forward_fill(w, ["click", "signup", "view"])


@query
def indicator_table(spark, d):
    return I.indicator_table(observations(spark, d), EVENT_SERIES, {}, GROWTH_SERIES,
                             FFILL_SERIES, RAW_SERIES)


# --------------------------------------------------------------------------
# Periods (P5-P10)


@query
def period_slice(spark, d):
    return supplier_panel_slice(spark, d, "1996Q1", "1997Q4")


@query
def parse_quarter(spark, d):
    o = table(spark, d, "orders")
    text = F.concat(F.year("o_orderdate").cast("string"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit("Q")).otherwise(F.lit("q")),
                    F.quarter("o_orderdate").cast("string"))
    return o.select("o_orderkey", text.alias("qtext"),
                    P.parse_quarter(text).alias("period"),
                    P.parse_quarter(F.col("o_orderpriority")).alias("bad"))


@query
def period_range(spark, d):
    o = table(spark, d, "orders")
    b = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("lo"),
                                   F.max("o_orderdate").alias("hi"))
    return b.select("o_custkey", F.explode(P.period_sequence("lo", "hi")).alias("period"))


@query
def period_arith(spark, d):
    o = table(spark, d, "orders")
    p = P.quarter_start("o_orderdate")
    return o.select("o_orderkey", p.alias("period"),
                    P.add_quarters(p, 23).alias("plus_23"),
                    P.add_quarters(p, -6).alias("minus_6"),
                    P.quarters_between(P.quarter_lit("1995Q1"), p).alias("since_start"))


@query
def report_window(spark, d):
    o = table(spark, d, "orders")
    b = o.groupBy("o_custkey").agg(P.quarter_start(F.min("o_orderdate")).alias("first_q"),
                                   P.quarter_start(F.max("o_orderdate")).alias("last_q"))
    n = P.quarters_between("first_q", "last_q")
    pad = P.report_pad(n)
    return b.select("o_custkey", n.alias("n_qtrs"), pad.alias("pad"),
                    P.add_quarters("first_q", -pad).alias("window_start"))


# --------------------------------------------------------------------------
# Panel edits


@query
def set_range(spark, d):
    q = supplier_panel(spark, d)
    q = PN.set_range(q, "qty", 0.0, "1998Q1", "1998Q4")
    q = PN.set_range(q, "regime", 0.0)
    q = PN.set_range(q, "regime", 1.0, "2000Q1", None)
    return q.select("entity", "period", "qty", "regime")


@query
def set_values(spark, d):
    q = supplier_panel(spark, d)
    q = PN.set_values(q, "rev", "1999Q1", [100.0, 200.0, 300.0, 400.0])
    return q.select("entity", "period", "rev")


@query
def add_shock(spark, d):
    q = supplier_panel(spark, d)
    return PN.add_shock(q, "qty", "1997Q2", 1000.0).select("entity", "period", "qty")


@query
def bulk_update(spark, d):
    q = supplier_panel(spark, d)
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    rev = li.groupBy(F.col("l_suppkey").alias("entity"),
                     P.quarter_start("l_shipdate").alias("period")).agg(
        F.sum("l_quantity").alias("qty"), F.round(F.sum("l_extendedprice"), 2).alias("rev"))
    rev = P.slice_periods(rev, "2000Q1", "2000Q4")
    long = rev.unpivot(["entity", "period"], ["qty", "rev"], "series", "value")
    return PN.bulk_update(q, long, ["qty", "rev"]).select("entity", "period", "qty", "rev")


@query
def panel_program(spark, d):
    q = supplier_panel(spark, d)
    steps = [
        lambda df: PN.set_range(df, "qty", 0.0, "1996Q1", "1996Q4"),
        lambda df: PN.add_shock(df, "rev", "1996Q3", 500.0),
        lambda df: PN.set_range(df, "qty", 1.0, "1996Q3", "1997Q2"),
        lambda df: PN.define(df, "y", F.col("qty") * 2),
    ]
    return PN.run_program(q, steps).select("entity", "period", "qty", "rev", "y")


@query
def add_missing_addfactors(spark, d):
    q = supplier_panel(spark, d).withColumn("qty_aerr", F.lit(1.0))
    return PN.add_missing_addfactors(q, ["qty", "rev", "zrff5_1"])


@query
def drop_lead_columns(spark, d):
    q = supplier_panel(spark, d)
    q = q.withColumns({"qty_1": F.col("qty"), "rev_12": F.col("rev"),
                       "v_2y": F.col("qty"), "rev2": F.col("rev") * 2})
    return PN.drop_lead_columns(q)


# --------------------------------------------------------------------------
# Lags, growth, leads, scalar functions


@query
def lag_expression(spark, d):
    q = supplier_panel(spark, d)
    s = PN.Series(q)
    q = PN.define(q, "lqty", S.log(s("qty")))
    q = PN.define(q, "d_qty", s("qty") - s("qty", -1))
    q = PN.define(q, "ma_rev", (s("rev") + s("rev", -1) + s("rev", -2)) / 3)
    return q.select("entity", "period", r6(F.col("lqty")).alias("lqty"), "d_qty", "ma_rev")


@query
def pct_change_4(spark, d):
    q = PN.pct_change_n(supplier_panel(spark, d), ["qty", "rev"], 4, suffix="_g4")
    return q.select("entity", "period", "qty_g4", "rev_g4")


@query
def growth_to_level(spark, d):
    q = PN.pct_change_n(supplier_panel(spark, d), ["qty"], 4, suffix="_g4")
    q = PN.growth_to_level(q, "rev", "qty_g4", "2000Q1", "2001Q4")
    return q.select("entity", "period", r6(F.col("rev")).alias("rev"))


@query
def stack_leads(spark, d):
    q = supplier_panel(spark, d).select("entity", "period", "qty", "rev")
    return PN.stack_leads(q, "1998Q1", 4)


@query
def unstack_leads(spark, d):
    q = supplier_panel(spark, d).select("entity", "period", "qty", "rev")
    st = PN.stack_leads(q, "1998Q1", 4)
    st = st.withColumns({f"qty_{k}": F.col(f"qty_{k}") * 10 for k in range(1, 4)})
    out = PN.unstack_leads(st, ["qty", "rev"], "1998Q1", 4)
    return PN.drop_lead_columns(out)


@query
def scalar_functions(spark, d):
    q = supplier_panel(spark, d)
    s = PN.Series(q)
    x = F.col("qty") - 200
    return q.select(
        "entity", "period",
        S.div(F.col("rev"), F.col("qty") - F.col("qty")).alias("f_div0"),
        S.div(F.col("rev"), F.col("qty")).alias("f_div"),
        r6(S.power(x, 0.5)).alias("f_pow"),
        r6(S.log(x)).alias("f_log"),
        r6(S.exp(F.col("qty") / 1000.0)).alias("f_exp"),
        S.abs_(x).alias("f_abs"),
        S.vmax(F.col("qty"), F.col("rev") / 100.0, s("qty", -1)).alias("f_max"),
        S.vmin(F.col("qty"), s("qty", -1)).alias("f_min"),
        S.ind_ltezero(x).alias("f_ind"),
        S.heaviside(x).alias("f_heav"),
        S.piecewise((F.lit(1), F.col("qty") > 300), (F.lit(2), F.col("qty") > 100)).alias("f_pw"),
        (-F.col("qty")).alias("f_neg"),
    )


# --------------------------------------------------------------------------
# Recurrences


@query
def recurrence_ar1(spark, d):
    q = supplier_panel(spark, d).withColumn("y", F.col("qty"))
    # fed straight from the lineitem aggregation: write the chunk table once
    q = R.linear_recurrence(q, "y", 0.5, 0.1 * F.col("qty"), start="1996Q1",
                            materialize_chunks=True)
    return q.select("entity", "period", "y")


@query
def recurrence_ar_k(spark, d):
    """Lags 1, 2 and 4 in one rule; chunks of a year, so that a path runs through several."""
    q = supplier_panel(spark, d).withColumn("y", F.col("qty"))
    q = AR.autoregression(q, "y", {1: 0.5, 2: 0.2, 4: -F.col("disc")}, 0.1 * F.col("qty"),
                          start="1996Q1", keys=["entity"], chunk=4, materialize_chunks=True)
    return q.select("entity", "period", r6(F.col("y")).alias("y"))


@query
def shock_decay(spark, d):
    q = supplier_panel(spark, d).withColumn("x", F.col("qty"))
    q = R.shock_decay(q, "x", 0.5, "1999Q1")
    return q.select("entity", "period", "x")


def _capped_growth(prev, row):
    # y = min(1.05 * y(-1), qty); np.minimum keeps a missing argument missing
    return np.minimum(1.05 * prev, row["qty"])


@query
def recurrence_general(spark, d):
    q = supplier_panel(spark, d).withColumn("y", F.col("qty"))
    q = R.general_recurrence(q, "y", _capped_growth, ["qty"], start="1996Q1",
                             vector_keys=["entity"])
    return q.select("entity", "period", "y")


@query
def recurrence_general_k(spark, d):
    """A user expression over two earlier values of the target."""
    q = supplier_panel(spark, d).withColumn("y", F.col("qty"))
    q = R.general_recurrence(q, "y", lambda prev, row: np.minimum(
        0.75 * prev[0] + 0.5 * prev[1], row["qty"]), ["qty"], start="1996Q1", keys=["entity"],
        order=2)
    return q.select("entity", "period", "y")


# --------------------------------------------------------------------------
# Trajectories and scenario report


def _with_trajectory(spark, d):
    q = supplier_panel(spark, d)
    return q.withColumn("qty_t", F.when(P.ordinal("period") % 3 == 0, F.col("qty") * 1.1))


@query
def trajectory_mask(spark, d):
    q = PN.trajectory_mask(_with_trajectory(spark, d), ["qty"])
    return q.select("entity", "period", "qty_t", "qty_switch")


@query
def trajectory_override(spark, d):
    q = PN.trajectory_override(_with_trajectory(spark, d), ["qty"], ["qty_t"], ["rev"])
    return q.select("entity", "period", "qty", "rev_gap")


@query
def baseline_vs_scenario(spark, d):
    base = materialize(supplier_panel(spark, d))  # read by both sides of the report
    sim = PN.set_range(base, "qty", F.col("qty") * 1.1, "2000Q1", "2001Q4")
    sim = PN.set_range(sim, "disc", F.col("disc") + 0.01, "2000Q1", "2001Q4")
    rep = PN.baseline_vs_scenario(base, sim, ["qty", "rev"], ["disc"], "2000Q1", "2001Q4")
    return rep


# --------------------------------------------------------------------------
# Residuals

from ..operators import bootstrap as B  # noqa: E402
from ..operators import replications as RP  # noqa: E402
from ..operators import residuals as RS  # noqa: E402
from ..session import materialize  # noqa: E402

RESID_START, RESID_END = "1996Q1", "2001Q4"
HIST_START, HIST_END = "1996Q1", "1999Q4"
SIM_START, SIM_END = "2000Q1", "2001Q4"
NREPL, NEXTRA, SEED = 200, 2, 1234


def _equations(q):
    s = PN.Series(q)
    return {
        "rev": (S.log(s("rev")), 0.8 * S.log(s("rev", -1)) + 0.1 * S.log(s("qty"))),
        # coefficients with endless decimal expansions keep rounded outputs
        # away from decimal ties
        "qty": (s("qty"), s("qty", -1) / 3 + s("rev") / 7000),
    }


def _residual_panel(spark, d):
    q = supplier_panel(spark, d)
    return RS.tracking_residuals(q, _equations(q), RESID_START, RESID_END)


@query
def tracking_residuals(spark, d):
    r = _residual_panel(spark, d)
    return r.select("entity", "period", r6(F.col("rev_trac")).alias("rev_trac"), "qty_trac")


@query
def replaced_definitions(spark, d):
    """One definition replaced and one added at run time."""
    q = supplier_panel(spark, d)
    s = PN.Series(q)
    eqs = RS.merge_equations(_equations(q), {
        "qty": (s("qty"), s("qty", -2) / 7 + s("rev") / 9000),
        "price": (s("rev"), s("rev", -1) / 3 + s("qty") * 11)})
    r = RS.tracking_residuals(q, eqs, RESID_START, RESID_END)
    return r.select("entity", "period", *[r6(F.col(f"{n}_trac")).alias(f"{n}_trac") for n in eqs])


@query
def residual_closure(spark, d):
    r = _residual_panel(spark, d)
    r = RS.residual_closure(r, _equations(r))
    return r.select("entity", "period", "rev_closes", "qty_closes")


@query
def residual_norm(spark, d):
    q = supplier_panel(spark, d)
    q = RS.residual_norm(q, _equations(q))
    return q.select("entity", "period", r6(F.col("resid_norm")).alias("resid_norm"))


@query
def domain_violations(spark, d):
    q = supplier_panel(spark, d)
    exprs = {"log_qty_less_200": (S.log(F.col("qty") - 200), ["qty"]),
             "rev_over_zero": (S.div(F.col("rev"), F.col("qty") - F.col("qty")), ["rev", "qty"])}
    return RS.domain_violations(q, exprs, keys=["entity"])


@query
def backtest_fanout(spark, d):
    tasks = table(spark, d, "orders").select(F.col("o_orderkey").alias("task_index"))
    return RS.backtest_fanout(tasks)


# --------------------------------------------------------------------------
# Bootstrap


def _resid(spark, d):
    """The residual panel, written once: every bootstrap step reads it, so
    the base tables are scanned once per query, not once per branch."""
    return materialize(_residual_panel(spark, d))


def _demeaned(resid):
    return B.demean(resid, ["qty_trac", "rev_trac"], HIST_START, HIST_END)


def _draws(resid):
    sim = P.slice_periods(resid.select("period"), SIM_START, SIM_END)
    return B.bootstrap_draws(sim, NREPL + NEXTRA, HIST_START, HIST_END, SEED)


def _vectors(resid):
    """All replications of an entity in one row, an array per simulated quarter."""
    return RP.shock_vectors(resid, _demeaned(resid), ["qty_trac", "rev_trac"], NREPL + NEXTRA,
                            HIST_START, HIST_END, SIM_START, SIM_END, SEED)


def _shocks(resid):
    return B.bootstrap_shocks(resid, _demeaned(resid), _draws(resid),
                              ["qty_trac", "rev_trac"], NREPL + NEXTRA, 8, SIM_START, SIM_END)


def _anchor(resid):
    return resid.filter(F.col("period") == P.quarter_lit(HIST_END)).select(
        "entity", F.col("qty").alias("init"))


def _path_vectors(resid):
    start = _vectors(resid).join(_anchor(resid), "entity", "left")
    return RP.vector_paths(start, "y", 0.5, "qty_trac", "init", NREPL + NEXTRA)


def _paths(resid):
    return RP.explode_replications(_path_vectors(resid), ["y"])


@query
def demean_residuals(spark, d):
    dm = _demeaned(_residual_panel(spark, d))
    return dm.select("entity", "period", r6(F.col("qty_trac")).alias("qty_trac"),
                     r6(F.col("rev_trac")).alias("rev_trac"))


@query
def bootstrap_draws(spark, d):
    return _draws(supplier_panel(spark, d))


@query
def bootstrap_shocks(spark, d):
    sh = _shocks(_resid(spark, d))
    return sh.select("entity", "repl", "period", r6(F.col("qty_trac")).alias("qty_trac"),
                     r6(F.col("rev_trac")).alias("rev_trac"))


@query
def bootstrap_paths(spark, d):
    return _paths(_resid(spark, d)).select("entity", "repl", "period", r6(F.col("y")).alias("y"))


def _failing_step(prev, row):
    # Stand-in for a solver that fails in some replications.
    if np.any(row["repl"] % 50 == 7):
        raise ValueError("replication failed to converge")
    return 0.5 * prev + row["qty_trac"]


def _errors(spark, d, code="repl", deal=()):
    """Paths with a step that fails where the expression ``code`` says so, dealt by ``deal``."""
    resid = _resid(spark, d)
    sh = _shocks(resid).withColumn("y", F.lit(None).cast("double"))
    an = _anchor(resid).withColumnRenamed("init", "__init")
    # the quarter before the simulation carries the start value
    pre = an.select("entity", F.explode(F.sequence(F.lit(0), F.lit(NREPL + NEXTRA - 1)))
                    .alias("repl"), P.quarter_lit(HIST_END).alias("period"),
                    F.lit(None).cast("double").alias("qty_trac"),
                    F.lit(None).cast("double").alias("rev_trac"), F.col("__init").alias("y"))
    panel = sh.unionByName(pre)
    out = R.general_recurrence(panel.withColumn("repl_d", F.expr(code).cast("double")), "y",
                               lambda p, r: _failing_step(p, {"repl": r["repl_d"],
                                                              "qty_trac": r["qty_trac"]}),
                               ["repl_d", "qty_trac"], start=SIM_START,
                               keys=["entity", "repl"], vector_keys=["entity", "repl"],
                               error_col="error", deal=deal)
    return out.filter(F.col("period") >= P.quarter_lit(SIM_START))


@query
def bootstrap_errors(spark, d):
    return _errors(spark, d).select("entity", "repl", "period", r6(F.col("y")).alias("y"), "error")


@query
def keep_good_replications(spark, d):
    paths = materialize(_errors(spark, d))  # read by two branches below
    status = paths.groupBy("repl").agg(F.max("error").alias("error"))
    keep = B.keep_good_replications(status, NREPL, NEXTRA)
    # at most NREPL rows, a parameter: broadcast, so the paths are not shuffled onto few keys
    return paths.join(F.broadcast(keep.filter("keep")), on="repl", how="left_semi") \
        .select("entity", "repl", "period", r6(F.col("y")).alias("y"), "error")


@query
def keep_good_per_entity(spark, d):
    """Every entity fails in other replications and is judged by itself."""
    # an entity's paths are in one task from the recursion on, and every quarter of a path has its
    # error: nothing is written, exchanged or joined again to tell which paths stay
    paths = _errors(spark, d, "repl + entity", deal=["entity"])
    keep = B.keep_good_replications(paths, NREPL, NEXTRA, keys=["entity"], steps="period")
    return keep.filter("keep") \
        .select("entity", "repl", "period", r6(F.col("y")).alias("y"), "error")


@query
def quantile_fan(spark, d):
    resid = _resid(spark, d)
    fan = RP.fan_vectors(RP.growth_vectors(_path_vectors(resid), "y", "y_g4", 4), ["y", "y_g4"])
    base = resid.filter(F.col("period") >= P.quarter_lit(SIM_START)) \
        .select("entity", "period", "qty_trac").withColumn("y", F.lit(None).cast("double"))
    base = R.linear_recurrence(base, "y", 0.5, F.col("qty_trac"), start=SIM_START,
                               init=_anchor(resid))
    base = PN.pct_change_n(base, ["y"], 4, suffix="_g4")
    base = base.select("entity", "period", F.explode(F.array(
        F.struct(F.lit("y").alias("series"), F.col("y").alias("base")),
        F.struct(F.lit("y_g4").alias("series"), F.col("y_g4").alias("base")))).alias("__b")) \
        .select("entity", "period", "__b.series", "__b.base")
    out = fan.join(base, on=["entity", "period", "series"], how="left")
    return out.select("entity", "period", "series",
                      *[r6(F.col(c)).alias(c) for c in ("base", "lo90", "lo70", "hi70", "hi90")])


@query
def bootstrap_trim(spark, d):
    resid = _resid(spark, d)
    hist = B.replicate(resid.filter(F.col("period") < P.quarter_lit(SIM_START))
                       .select("entity", "period", F.col("qty").alias("y")), NREPL + NEXTRA)
    paths = _paths(resid).select("entity", "repl", "period", "y")
    full = hist.select("entity", "repl", "period", "y").unionByName(paths)
    out = P.trim_window(full, SIM_START, SIM_END)
    return out.select("entity", "repl", "period", r6(F.col("y")).alias("y"))


# --------------------------------------------------------------------------
# Sources and sinks

from ..operators import catalog as C  # noqa: E402
from ..operators import checks as CK  # noqa: E402
from ..operators import graph as G  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import files as SRC  # noqa: E402
from ..sources import publish as PUB  # noqa: E402
from .standins import catalog_frame  # noqa: E402


@query
def scan_union_by_name(spark, d):
    base = scratch_path(spark, "raw")
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    early = F.coalesce(F.col("y") < 1998, F.lit(False))  # orders without a date go with the later ones
    o.filter(early).select("o_orderkey", "o_custkey", "o_totalprice") \
        .write.mode("overwrite").parquet(f"{base}/raw/early.parquet")
    o.filter(~early).select("o_orderkey", "o_custkey", "o_orderpriority") \
        .write.mode("overwrite").parquet(f"{base}/raw/late.parquet")
    df = SRC.scan_parquet(spark, f"{base}/raw/*.parquet", with_file="filename")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                     SRC.series_from_path("filename").alias("series_id"))


@query
def series_from_filename(spark, d):
    base = scratch_path(spark, "raw")
    nat = table(spark, d, "nation").join(
        table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    # one directory per series, written by Spark in one job: raw/series=<name>/part-*
    nat.select("n_nationkey", "n_name", F.col("r_name").alias("series")) \
        .write.mode("overwrite").partitionBy("series").parquet(f"{base}/raw")
    # read the files without partition discovery: the series comes from the path
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/raw") \
        .withColumn("filename", F.col("_metadata.file_path"))
    return df.select(SRC.series_from_path("filename", r"raw/series=([^/]+)/").alias("series_id"),
                     "n_nationkey", "n_name")


@query
def load_quarterly_csv(spark, d):
    path = scratch_path(spark, "csv")
    li = table(spark, d, "lineitem")
    wide = li.groupBy(F.col("l_returnflag").alias("entity"), P.quarter_start("l_shipdate").alias("p")) \
        .agg(F.sum("l_quantity").alias("QTY"), F.round(F.sum("l_extendedprice"), 2).alias("Rev"))
    text = P.quarter_text("p", lower=False)
    wide = wide.select(F.when(F.quarter("p") % 2 == 0, F.lower(text)).otherwise(text).alias("Quarter"),
                       "QTY", "Rev", "entity")
    SRC.write_csv_partitioned(wide, path, "entity")
    return SRC.load_quarterly_csv(spark, path, keep=["entity"])


@query
def csv_by_year_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                         F.year("o_orderdate").alias("year"))
    SRC.write_csv_partitioned(o, path, "year")
    back = spark.read.option("header", True).schema(
        "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, year INT").csv(path)
    return back


@query
def materialize_table(spark, d):
    t = indicator_table(spark, d)
    return SRC.materialize_table(t, "stg_indicators", scratch_path(spark, "tables"))


@query
def publish_swap(spark, d):
    """A customer table that others read meanwhile: published, replaced in vain by one whose ids repeat
    (its check fails), then replaced by one with balances; what readers see after either, and what a
    reader of the version before still sees."""
    path = scratch_path(spark, "published")
    c = table(spark, d, "customer")
    plain = c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("nation"),
                     F.lit(None).cast("double").alias("balance"))

    def unique(t):
        if CK.check_unique(t, "id").limit(1).count():
            raise ValueError("ids repeat")

    PUB.publish(plain, path, unique)
    try:
        PUB.publish(plain.unionByName(plain), path, unique)
        raise AssertionError("a table with repeated ids was published")
    except ValueError:
        kept = materialize(PUB.read_published(spark, path))
    PUB.publish(kept.drop("balance").join(c.select(F.col("c_custkey").alias("id"),
                                                   F.col("c_acctbal").alias("balance")), "id"),
                path, unique)
    seen = {"after_failure": kept, "current": PUB.read_published(spark, path),
            "before": PUB.read_published(spark, path, back=1)}
    return SRC.union_by_name(t.withColumn("seen", F.lit(k)) for k, t in seen.items())


@query
def view_chain(spark, d):
    first = table(spark, d, "customer").select(F.col("c_nationkey").alias("id")).unionByName(
        table(spark, d, "nation").select(F.lit(None).cast("int").alias("id")))
    SRC.create_view(first, "my_first_model")
    second = spark.table("my_first_model").filter(F.col("id") == 1)
    return SRC.create_view(second, "my_second_model")


# --------------------------------------------------------------------------
# Checks (A6, A7, U3)


def _docs_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source") \
        .join(table(spark, d, "labels"), "doc_id", "left")


@query
def null_audit(spark, d):
    return CK.null_audit(_docs_labels(spark, d), ["lang", "source", "quality", "toxic"])


@query
def check_unique(spark, d):
    return CK.check_unique(table(spark, d, "documents"), "text")


@query
def check_not_null(spark, d):
    return CK.check_not_null(_docs_labels(spark, d), "quality").select("doc_id")


# Series the stand-in indicator model needs (fixed model configuration).
REQUIRED_SERIES = EVENT_SERIES + ["refund"]


@query
def missing_series(spark, d):
    req = spark.createDataFrame([(n,) for n in REQUIRED_SERIES], "name string")
    present = table(spark, d, "events").select(F.col("event_type").alias("name"))
    return CK.missing_names(req, present)


# --------------------------------------------------------------------------
# Catalogue and equations


@query
def catalog_scan(spark, d):
    path = scratch_path(spark, "xml")
    SRC.write_catalog(catalog_frame(spark, d).drop("p_brand"), path)
    cat = SRC.read_catalog(spark, path)
    coeff = F.col("standard_equation.coeff")
    return cat.select("name", "equation_type", "stochastic_type",
                      F.col("standard_equation.python_equation").alias("python_equation"),
                      F.when(coeff.isNotNull(), F.size(coeff)).alias("n_coeff"),
                      F.col("mce_equation.mce_group").alias("mce_group"))


@query
def catalog_predicates(spark, d):
    cat = catalog_frame(spark, d)
    return C.endogenous(cat).select(F.lit("endogenous").alias("predicate"), "name") \
        .unionByName(C.exogenous(cat).select(F.lit("exogenous").alias("predicate"), "name")) \
        .unionByName(C.stochastic(cat).select(F.lit("stochastic").alias("predicate"), "name"))


@query
def catalog_override(spark, d):
    cat = catalog_frame(spark, d)
    return C.override_equations(C.equations(cat), C.mce_equations(cat, "mcap+wp"))


@query
def catalog_coefficients(spark, d):
    return C.coefficients(catalog_frame(spark, d))


def _tokens(spark, d):
    return C.tokens(C.equations(catalog_frame(spark, d)))


@query
def missing_coefficients(spark, d):
    cat = catalog_frame(spark, d)
    return C.missing_coefficients(C.tokens(C.equations(cat)), C.coefficients(cat))


@query
def equation_tokens(spark, d):
    return _tokens(spark, d)


def _edges(spark, d):
    cat = catalog_frame(spark, d)
    return C.edges(C.tokens(C.equations(cat)), C.endogenous(cat))


@query
def equation_edges(spark, d):
    return _edges(spark, d)


@query
def equation_lead_profile(spark, d):
    return C.lead_profile(_tokens(spark, d))


@query
def stack_tokens(spark, d):
    return C.stack_tokens(_tokens(spark, d), 3)


@query
def split_lead_names(spark, d):
    names = C.stack_tokens(_tokens(spark, d), 3).select(F.col("variable").alias("name")).distinct()
    return names.select("name", C.is_lead("name").alias("is_lead"))


@query
def equation_text_functions(spark, d):
    p = table(spark, d, "part")
    cat = catalog_frame(spark, d).filter(F.col("standard_equation").isNotNull())
    raw = F.col("standard_equation.python_equation")
    cat = cat.join(p.select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("name"),
                            "p_size", "p_brand"), ["name", "p_brand"])
    return cat.select(
        "name", S.clean_eq(raw).alias("clean"), S.flip_equals(S.clean_eq(raw)).alias("flipped"),
        S.endo_to_trac(F.col("name")).alias("trac"),
        S.endo_to_trac(F.concat("name", F.lit("_"), (F.col("p_size") % 3).cast("string"), F.lit("x")))
        .alias("trac_lead"),
        S.is_number(F.col("p_size").cast("string")).alias("size_is_number"),
        S.is_number(F.col("p_brand")).alias("brand_is_number"))


@query
def prune_unused_series(spark, d):
    cat = catalog_frame(spark, d)
    return C.used_inputs(C.exogenous(cat), C.tokens(C.equations(cat)))


@query
def new_input_series(spark, d):
    cat = catalog_frame(spark, d)
    eqs = C.equations(cat).withColumn("order", F.regexp_extract("name", r"(\d+)", 1).cast("long"))
    known = C.endogenous(cat).unionByName(C.exogenous(cat))
    return C.new_inputs(eqs, known)


@query
def exogenize_catalog(spark, d):
    cat = catalog_frame(spark, d)
    names = cat.filter((F.col("p_brand") == "Brand#1") & F.col("standard_equation").isNotNull()) \
        .select("name")
    kept, inputs = C.exogenize(C.equations(cat), C.exogenous(cat), names)
    return kept.select("name", F.lit("equation").alias("kind")).unionByName(
        inputs.select("name", F.lit("input").alias("kind")))


# --------------------------------------------------------------------------
# Graphs (A4, E4-E7, O3) on the equation dependency graph


def _graph(spark, d):
    cat = catalog_frame(spark, d)
    nodes = C.endogenous(cat).select(F.col("name").alias("node"))
    return nodes, _edges(spark, d)


@query
def in_degree(spark, d):
    n, e = _graph(spark, d)
    return G.in_degree(n, e)


@query
def topo_levels(spark, d):
    n, e = _graph(spark, d)
    return G.topo_levels(n, e)


@query
def scc(spark, d):
    n, e = _graph(spark, d)
    return G.scc(n, e).filter(F.col("size") > 1)


@query
def smallest_source_component(spark, d):
    n, e = _graph(spark, d)
    comps = G.scc(n, e)
    return G.smallest_source_component(n, e, comps, G.topo_levels(n, e))


@query
def block_order(spark, d):
    n, e = _graph(spark, d)
    return G.block_order(n, e)


def bootstrap_scale_case(spark, d, nrepl: int = 1000, nextra: int = 5,
                         start: str = "1996Q1", end: str = "2001Q4"):
    """Benchmark-only: the reference demo's replication count (1000 + 5 spare)
    over a 24-quarter simulation, for every supplier, ending in the fan.
    Residuals are drawn from the same 24 quarters."""
    resid = materialize(RS.tracking_residuals(supplier_panel(spark, d),
                                              _equations(supplier_panel(spark, d)), start, end))
    n = nrepl + nextra
    dm = B.demean(resid, ["qty_trac", "rev_trac"], start, end)
    vectors = RP.shock_vectors(resid, dm, ["qty_trac", "rev_trac"], n, start, end, start, end, SEED)
    anchor = resid.filter(F.col("period") == P.add_quarters(P.quarter_lit(start), -1)) \
        .select("entity", F.col("qty").alias("init"))
    paths = RP.vector_paths(vectors.join(anchor, "entity", "left"), "y", 0.5, "qty_trac", "init", n)
    return RP.fan_vectors(RP.growth_vectors(paths, "y", "y_g4", 4), ["y", "y_g4"])
