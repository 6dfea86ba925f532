"""Residual bootstrap: demean, draw, shock, propagate, filter, fan
(R4-R9, W8, O2, A2, A3, J2, J3, P10).

Data layout: residuals are a panel ``(entity, period, <v>_trac ...)``;
replications add the key ``repl``.  Draws are one small table
``(repl, period, drawn_period)`` shared by every entity and series, so the
cross-correlation of shocks is kept.  Its size is ``nrepl x horizon``, two
parameters, never the data; it is broadcast only under
:data:`BROADCAST_ROWS`.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.periods import add_quarters, ordinal, quarters_between
from .panel import KEYS, PERIOD, _in_range

# Largest draw table (rows) that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 5_000_000

# Fixed constants of the portable integer mix used for the draws: the same
# numbers are used by the SQL oracle, so both engines draw identically.
MIX_PRIME = 2147483647
MIX_SEED = 7919
MIX_REPL = 104729
MIX_PERIOD = 1299709
MIX_ADD1 = 12345
MIX_ADD2 = 67891


def demean(df: DataFrame, cols: Sequence[str], start=None, end=None,
           keys: Sequence[str] = KEYS, period: str = PERIOD) -> DataFrame:
    """``x - mean(x)`` over the window, per key (R4, A2): rows of the window
    only; missing values are skipped by the mean and stay missing.

    The mean is summed in period order (an ordered, unbounded frame), so the
    result does not depend on how rows happen to be partitioned: floating
    sums are not associative, and replications must be reproducible.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(period)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    sl = df.filter(_in_range(period, start, end))
    return sl.withColumns({c: F.col(c) - F.avg(F.col(c)).over(w) for c in cols})


def draw_index(seed, repl, period, n) -> Column:
    """Uniform index in ``[0, n)`` from (seed, replication, quarter).

    A pure function of its inputs, so draws do not depend on partitioning
    or task retries (unlike ``rand()``).  Two squaring rounds modulo a prime
    break the linear pattern of the first mix.
    """
    p = F.lit(MIX_PRIME).cast("bigint")
    x0 = F.pmod(as_col(seed).cast("bigint") * MIX_SEED + as_col(repl).cast("bigint") * MIX_REPL
                + ordinal(period).cast("bigint") * MIX_PERIOD, p)
    x1 = F.pmod(x0 * x0 + MIX_ADD1, p)
    x2 = F.pmod(x1 * x1 + MIX_ADD2, p)
    return F.pmod(x2, as_col(n).cast("bigint")).cast("int")


def bootstrap_draws(sim_periods: DataFrame, nrepl: int, resid_start, resid_end, seed: int,
                    period: str = PERIOD) -> DataFrame:
    """``(repl, period, drawn_period)``: for every replication and simulated
    quarter one historical quarter, uniform with replacement (R5, J3).

    ``sim_periods`` holds the simulated quarters (one row each).  The
    replications are generated with ``explode(sequence(...))`` per quarter,
    not with a cross join.
    """
    rs = as_col(resid_start, literal=True)
    n = quarters_between(rs, as_col(resid_end, literal=True)) + 1
    d = sim_periods.select(period).distinct() \
        .withColumn("repl", F.explode(F.sequence(F.lit(0), F.lit(nrepl - 1))))
    return d.select("repl", period,
                    add_quarters(rs, draw_index(F.lit(seed), F.col("repl"), F.col(period), n))
                    .alias("drawn_period"))


def bootstrap_shocks(baseline: DataFrame, resid: DataFrame, draws: DataFrame,
                     cols: Sequence[str], nrepl: int, horizon: int, sim_start, sim_end,
                     keys: Sequence[str] = KEYS, period: str = PERIOD,
                     broadcast_rows: int | None = None, salt: int = 64) -> DataFrame:
    """Baseline residuals over the simulation window plus the demeaned
    residuals of the drawn quarters (R6, J2): ``(keys..., repl, period, cols...)``.

    ``draws`` has ``nrepl * horizon`` rows; it is broadcast when that bound is
    below ``broadcast_rows`` (:data:`BROADCAST_ROWS`), so the residual side is
    never shuffled for this join.  Beyond it the join key (a historical
    quarter) has too few values to spread a shuffle, so it is salted: the
    residual rows, one per entity and quarter, are copied into ``salt``
    buckets and the draws go to bucket ``repl mod salt``.

    The replications that draw the same quarter for the same simulated quarter stay one row, with an
    array, until the baseline has joined: only then they become rows, so that join moves no
    replicated rows.
    """
    keys = list(keys)
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    dr = draws.select("repl", F.col(period).alias("__sim"), F.col("drawn_period").alias(period))
    rs = resid.select(*keys, period, *[F.col(c).alias(f"__d_{c}") for c in cols])
    together = F.collect_list(F.struct("repl")).alias("__repls")
    if nrepl * horizon <= limit:
        dr = dr.groupBy("__sim", period).agg(together)
        drawn = rs.join(F.broadcast(dr), on=period, how="inner")
    else:
        dr = dr.withColumn("__salt", F.pmod(F.col("repl"), F.lit(salt)))
        dr = dr.groupBy("__sim", period, "__salt").agg(together)
        rs = rs.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        drawn = rs.join(dr, on=[period, "__salt"], how="inner")
    drawn = drawn.select(*keys, "__repls", F.col("__sim").alias(period), *[f"__d_{c}" for c in cols])
    # a fixed number of partitions: adaptive execution would size them by rows not yet replicated
    spark = baseline.sparkSession
    drawn = drawn.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                  spark.sparkContext.defaultParallelism), *keys, period)
    base = baseline.filter(_in_range(period, sim_start, sim_end)).select(*keys, period, *cols)
    out = base.join(drawn, on=keys + [period], how="inner")
    return out.select(*keys, period, *[(F.col(c) + F.col(f"__d_{c}")).alias(c) for c in cols],
                      F.inline("__repls")).select(*keys, "repl", period, *cols)


def replicate(df: DataFrame, nrepl: int) -> DataFrame:
    """Every row once per replication ``0..nrepl-1`` (a generator, no join)."""
    return df.withColumn("repl", F.explode(F.sequence(F.lit(0), F.lit(nrepl - 1))))


def keep_good_replications(status: DataFrame, nrepl: int, nextra: int,
                           repl: str = "repl", error: str = "error",
                           keys: Sequence[str] = (), steps: str | None = None) -> DataFrame:
    """Which replications to return (W8, O2): walking in replication order,
    drop the first ``nextra`` failed ones, then keep the first ``nrepl`` of
    the rest (failures beyond ``nextra`` stay, with their error).

    ``status`` has one row per replication ``(repl, error)``; it has
    ``nrepl + nextra`` rows, a parameter, so the two ordered windows over
    it are small.  Returns ``(repl, keep)`` for all replications.

    With ``keys`` every key (e.g. each entity, a model of its own) has its own status rows and is
    judged by itself, so that one key's failure costs no other key a replication: ``(keys..., repl,
    keep)``.  A key's rows are as few as above; NULL keys are keys like any other.
    With ``keys`` and ``steps``, a column, ``status`` holds a replication's steps, one row each and
    all with its error: they count once, and all columns are returned, with ``keep``.  One exchange
    by the keys and one sort serve every window.
    """
    failed = F.col(error).isNotNull()
    if keys:
        run = Window.partitionBy(*keys).orderBy(F.col(repl))
        run = run.rowsBetween(Window.unboundedPreceding, Window.currentRow) if steps is None else \
            run.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        s = status.withColumn("__once", F.lit(True) if steps is None else F.row_number().over(
            Window.partitionBy(*keys, repl).orderBy(F.col(steps))) == 1)
        s = s.withColumn("__failed", F.sum((failed & F.col("__once")).cast("int")).over(run))
        s = s.withColumn("__stays", ~(failed & (F.col("__failed") <= nextra)))
        rank = F.sum((F.col("__stays") & F.col("__once")).cast("int")).over(run)
        out = [*keys, repl] if steps is None else status.columns
        return s.select(*out, (F.col("__stays") & (rank <= nrepl)).alias("keep"))
    w_f = Window.partitionBy(failed).orderBy(F.col(repl))
    s = status.withColumn("__dropped", failed & (F.row_number().over(w_f) <= nextra))
    rest = s.filter(~F.col("__dropped"))
    rest = rest.withColumn("__rank", F.row_number().over(Window.orderBy(F.col(repl))))
    kept = rest.filter(F.col("__rank") <= nrepl).select(repl, F.lit(True).alias("keep"))
    return status.select(repl).join(kept, on=repl, how="left") \
        .select(repl, F.coalesce(F.col("keep"), F.lit(False)).alias("keep"))


def quantile_fan(paths: DataFrame, value: str, by: Sequence[str],
                 qs: Sequence[float] = (0.05, 0.15, 0.85, 0.95),
                 names: Sequence[str] = ("lo90", "lo70", "hi70", "hi90")) -> DataFrame:
    """Exact quantiles with linear interpolation across replications, per
    ``by`` (A3, R9): ``v[lo] + (v[hi] - v[lo]) * (p - lo)`` with
    ``p = q * (n - 1)`` over the n non-missing values.

    Computed from ranks, not with per-group hash buffers: one shuffle on
    ``by``, a sort within each group (which spills to disk), then only the
    two order statistics around each quantile are kept and combined in the
    same partitions.  A group of only missing values gives NULLs.
    """
    by = list(by)
    v = F.col(value)
    w_sorted = Window.partitionBy(*by).orderBy(v.asc_nulls_last())
    w_all = Window.partitionBy(*by)
    ranked = paths.select(*by, v.alias("__v"),
                          (F.row_number().over(w_sorted) - 1).alias("__r"),
                          F.count(v).over(w_all).alias("__n"))
    pos = {q: F.lit(float(q)) * (F.col("__n") - 1) for q in qs}
    need = F.col("__r") == 0
    for q in qs:
        need = need | (F.col("__r") == F.floor(pos[q])) | (F.col("__r") == F.ceil(pos[q]))
    picked = ranked.filter(need)
    aggs = []
    for q, name in zip(qs, names):
        lo, hi = F.floor(pos[q]), F.ceil(pos[q])
        v_lo = F.max(F.when(F.col("__r") == lo, F.col("__v")))
        v_hi = F.max(F.when(F.col("__r") == hi, F.col("__v")))
        frac = F.max(pos[q] - lo)
        aggs.append(F.when(F.max("__n") > 0, v_lo + (v_hi - v_lo) * frac).alias(name))
    return picked.groupBy(*by).agg(*aggs)
