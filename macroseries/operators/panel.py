"""Quarterly panel operators.

A panel is a DataFrame ``(keys..., period DATE, <series> DOUBLE ...)`` with at
most one row per ``(keys, period)``.  ``keys`` (entity, scenario,
replication, ...) is the unit of parallelism: every window is partitioned by
it, so a window holds one entity's quarters, a number bounded by the
calendar, never by the size of the data.  Lags count rows, so lag-based
operators expect a dense grid: build it with :func:`densify` (D4).
"""

from __future__ import annotations

import re
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_col
from ..functions.periods import (add_quarters, period_sequence, quarters_between,
                                 report_pad)
from ..functions.scalar import div

KEYS = ("entity",)
PERIOD = "period"


def _window(keys: Sequence[str], period: str):
    return Window.partitionBy(*keys).orderBy(F.col(period).asc_nulls_last())


def densify(df: DataFrame, keys: Sequence[str] = KEYS, period: str = PERIOD,
            start=None, end=None) -> DataFrame:
    """Complete the quarter grid of every key (P7); new rows have NULL series.

    Without ``start``/``end`` each key spans its own first to last quarter;
    with them, rows outside are dropped.  Rows without a period and rows that
    repeat a quarter are kept as they are (``check_unique`` reports the
    latter).  Every row adds the missing quarters up to its successor, so
    the input is read once and sorted within its key (a sort that spills):
    nothing is gathered, no self-join, no cross join.
    """
    keys = list(keys)
    vals = [f for f in df.schema.fields if f.name not in keys and f.name != period]
    kind = df.schema[period].dataType
    first = None if start is None else as_col(start, literal=True)
    last = None if end is None else as_col(end, literal=True)
    p, none = F.col(period), F.array().cast(T.ArrayType(T.DateType()))
    w = _window(keys, period)
    nxt, begins = F.lead(p).over(w), F.row_number().over(w) == 1

    def quarters(lo, hi):
        return F.when(quarters_between(lo, hi) >= 0, period_sequence(lo, hi)).otherwise(none)

    # the quarters after this row and before the next one (the end, after the last dated row)
    lo, hi = add_quarters(p, 1), F.when(nxt.isNotNull(), add_quarters(nxt, -1))
    if first is not None:
        lo = F.greatest(lo, first)
    if last is not None:
        hi = F.least(F.coalesce(hi, last), last)
    new = F.when(p.isNotNull(), quarters(lo, hi)).otherwise(none)
    if first is not None:
        # the quarters before the first row
        before = F.least(add_quarters(p, -1), last if last is not None else add_quarters(p, -1))
        new = F.concat(new, F.when(begins, quarters(first, before)).otherwise(none))
    new = F.transform(new, lambda x: F.struct(x.cast(kind).alias("t"), F.lit(False).alias("own")))
    keep = p.isNull() | _in_range(period, start, end)
    own = F.filter(F.array(F.struct(p.alias("t"), F.lit(True).alias("own"))), lambda _: keep)
    grid = df.select(*keys, *[f.name for f in vals], own.alias("__own"), new.alias("__new"))
    grid = grid.select(*keys, *[f.name for f in vals],
                       F.explode(F.concat("__own", "__new")).alias("__g"))
    return grid.select(*keys, F.col("__g.t").alias(period),
                       *[F.when(F.col("__g.own"), F.col(f.name)).alias(f.name) for f in vals])


class Series:
    """Lag-expression builder bound to a panel.

    ``s = Series(df)``; ``s("xgdp")`` is the current value, ``s("xgdp", -1)``
    the previous quarter.  A positive offset raises ``ValueError``; an
    unknown series raises ``KeyError`` when the expression is built.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str] = KEYS, period: str = PERIOD):
        self.columns = set(df.columns)
        self.keys = list(keys)
        self.period = period
        self.window = _window(self.keys, period)

    def __call__(self, name: str, offset: int = 0) -> Column:
        if offset > 0:
            raise ValueError("a lag expression can't look ahead: offset must be 0 or negative")
        if name not in self.columns:
            raise KeyError(f"series not in panel: {name}")
        if offset == 0:
            return F.col(name)
        return F.lag(F.col(name), -offset).over(self.window)

    def __getattr__(self, name: str) -> Column:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name, 0)


def sliced_grid(extents: DataFrame, measures: DataFrame, start, end, keys: Sequence[str] = KEYS,
                period: str = PERIOD, first: str = "first", last: str = "last") -> DataFrame:
    """``loc[start:end]`` of the dense quarter grid (P5 of P7) without reading the other quarters.

    ``extents`` has each key's ``first`` and ``last`` quarter, one row a key; ``measures`` the key's rows
    by quarter, which the caller filters before aggregating, so that the range reaches the scan. The
    result is that of ``slice_periods(densify(whole panel), start, end)``: every quarter of the range
    within the key's extent, series NULL where ``measures`` has no row. NULL keys are a key; keys whose
    extent is NULL or misses the range give no rows; measures outside range or extent are left out;
    rows of ``measures`` that repeat a quarter are each kept.
    """
    keys = list(keys)
    lo = F.greatest(F.col(first), as_col(start, literal=True))
    hi = F.least(F.col(last), as_col(end, literal=True))
    grid = extents.filter(F.col(first).isNotNull() & F.col(last).isNotNull() & (lo <= hi)).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.explode(period_sequence(lo, hi)).alias("__at"))
    match = F.col("__at") == F.col(period)
    for k in keys:
        match = match & F.col(f"__{k}").eqNullSafe(F.col(k))
    values = [c for c in measures.columns if c not in keys and c != period]
    return grid.join(measures, match, "left").select(
        *[F.col(f"__{k}").alias(k) for k in keys], F.col("__at").alias(period), *values)


def define(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """New or replaced series from a non-recursive expression."""
    return df.withColumn(name, expr)


def _in_range(period: str, start, end) -> Column:
    c = F.col(period)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= as_col(start, literal=True))
    if end is not None:
        cond = cond & (c <= as_col(end, literal=True))
    return cond


def set_range(df: DataFrame, col: str, value, start=None, end=None,
              period: str = PERIOD) -> DataFrame:
    """``loc[start:end, col] = value`` (T1, T5).  A new column is NULL outside."""
    old = F.col(col) if col in df.columns else F.lit(None).cast("double")
    return df.withColumn(col, F.when(_in_range(period, start, end),
                                     as_col(value).cast("double")).otherwise(old))


def set_values(df: DataFrame, col: str, start, values: Sequence[float],
               period: str = PERIOD) -> DataFrame:
    """``loc[start:start+len-1, col] = values``: one value per quarter.

    The short list is a literal array indexed by the quarter offset, so no
    join is needed.
    """
    k = quarters_between(as_col(start, literal=True), F.col(period))
    arr = F.array(*[F.lit(float(v)) if v is not None else F.lit(None).cast("double")
                    for v in values])
    old = F.col(col) if col in df.columns else F.lit(None).cast("double")
    hit = (k >= 0) & (k < len(values))
    return df.withColumn(col, F.when(hit, F.element_at(arr, (k + 1).cast("int"))).otherwise(old))


def add_shock(df: DataFrame, col: str, at, amount: float, period: str = PERIOD) -> DataFrame:
    """``loc[at, col] += amount`` (T3); a missing value stays missing."""
    return df.withColumn(col, F.when(F.col(period) == as_col(at, literal=True),
                                     F.col(col) + F.lit(float(amount))).otherwise(F.col(col)))


def apply_overrides(df: DataFrame, overrides: DataFrame, series_list: Sequence[str],
                    keys: Sequence[str] = KEYS, period: str = PERIOD,
                    series: str = "series", value: str = "value", mode: str = "set") -> DataFrame:
    """Upsert a long override table ``(keys..., period, series, value)``.

    ``mode='set'`` overwrites where an override exists, ``'add'`` adds it
    (missing stays missing).  The override table is made wide with the given
    series list (conditional maxima: one shuffle; of repeated overrides the
    largest value counts) and left-joined on ``(keys, period)``.
    No broadcast hint: the table can be as large as the panel; AQE
    broadcasts it when it measures small.
    """
    keys = list(keys)
    wide = overrides.groupBy(*keys, period).agg(
        *[F.max(F.when(F.col(series) == s, F.col(value))).alias(f"__new_{s}")
          for s in series_list])
    out = df.join(wide, on=keys + [period], how="left")
    upd = {}
    for s in series_list:
        new = F.col(f"__new_{s}")
        old = F.col(s) if s in df.columns else F.lit(None).cast("double")
        if mode == "set":
            upd[s] = F.when(new.isNotNull(), new).otherwise(old)
        elif mode == "add":
            upd[s] = old + F.coalesce(new, F.lit(0.0))
        else:
            raise ValueError(f"unknown mode {mode!r}")
    return out.withColumns(upd).drop(*[f"__new_{s}" for s in series_list])


def bulk_update(df: DataFrame, overrides: DataFrame, series_list: Sequence[str],
                keys: Sequence[str] = KEYS, period: str = PERIOD, **kw) -> DataFrame:
    """Overwrite many series in a window from a long table (T4)."""
    return apply_overrides(df, overrides, series_list, keys, period, mode="set", **kw)


def run_program(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Several statements on one panel, in order; the later one wins."""
    for step in steps:
        df = step(df)
    return df


_LEAD_RE = re.compile(r"_\d+")


def is_lead_name(name: str, anchored: bool = False) -> bool:
    """``_<digits>`` anywhere in the name (Q4), or only at the end."""
    if anchored:
        return re.search(r"_\d+$", name) is not None
    return _LEAD_RE.search(name) is not None


def drop_lead_columns(df: DataFrame, anchored: bool = False) -> DataFrame:
    """Drop helper columns named like ``x_3``."""
    return df.drop(*[c for c in df.columns if is_lead_name(c, anchored)])


def add_missing_addfactors(df: DataFrame, endo_names: Sequence[str]) -> DataFrame:
    """Add absent ``<v>_aerr`` / ``<v>_trac`` columns filled with 0.

    Names that look like leads (``zrff5_1``) are skipped.
    """
    present = set(df.columns)
    new = {}
    for suffix in ("_aerr", "_trac"):
        for v in endo_names:
            name = v + suffix
            if not is_lead_name(v) and name not in present and name not in new:
                new[name] = F.lit(0.0)
    return df.withColumns(new) if new else df


def pct_change_n(df: DataFrame, cols: Sequence[str], n: int = 4, keys: Sequence[str] = KEYS,
                 period: str = PERIOD, suffix: str = "", fill: bool = False,
                 times: float = 100.0) -> DataFrame:
    """``pct_change(n) * 100`` per key (W3).  ``fill`` forward-fills first,
    as old pandas did."""
    w = _window(keys, period)
    src = {c: c for c in cols}
    if fill:
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = df.withColumns({f"__ff_{c}": F.last(F.col(c), ignorenulls=True).over(run)
                             for c in cols})
        src = {c: f"__ff_{c}" for c in cols}
    out = {c + suffix: (div(F.col(src[c]), F.lag(F.col(src[c]), n).over(w)) - 1) * times
           for c in cols}
    df = df.withColumns(out)
    return df.drop(*[f"__ff_{c}" for c in cols]) if fill else df


def growth_to_level(df: DataFrame, level: str, growth: str, start, end,
                    keys: Sequence[str] = KEYS, period: str = PERIOD,
                    out: str | None = None, periods_per_year: int = 4) -> DataFrame:
    """Turn annual growth rates into levels (W4, J4):
    ``level[start:end] = level[start-1] * cumprod((g/100 + 1) ** 0.25)``.

    The anchor ``level[start-1]`` is found with a window over the key (no
    join), and the product is a running window product (signs kept).
    """
    out = out or level
    s = as_col(start, literal=True)
    in_rng = _in_range(period, start, end)
    w_all = Window.partitionBy(*keys)
    w_run = _window(keys, period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    anchor = F.max(F.when(F.col(period) == add_quarters(s, -1), F.col(level))).over(w_all)
    factor = F.when(in_rng, F.pow(F.col(growth) / 100.0 + 1.0, 1.0 / periods_per_year))
    cum = F.product(factor).over(w_run)
    old = F.col(level) if level in df.columns else F.lit(None).cast("double")
    return df.withColumn(out, F.when(in_rng, anchor * cum).otherwise(old))


def stack_leads(df: DataFrame, start, n_periods: int, cols: Sequence[str] | None = None,
                keys: Sequence[str] = KEYS, period: str = PERIOD) -> DataFrame:
    """Lead columns ``x_1 .. x_{n-1}`` that, on the ``start`` row, hold the next
    quarters' values of every series (W6); NULL on other rows."""
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys and c != period]
    w = _window(keys, period)
    at = F.col(period) == as_col(start, literal=True)
    new = {f"{c}_{k}": F.when(at, F.lead(F.col(c), k).over(w))
           for c in cols for k in range(1, n_periods)}
    return df.withColumns(new)


def unstack_leads(df: DataFrame, cols: Sequence[str], start, n_periods: int,
                  keys: Sequence[str] = KEYS, period: str = PERIOD) -> DataFrame:
    """Inverse of :func:`stack_leads` (W7): for k = 1..n-1 the value of ``x`` at
    ``start + k`` becomes ``x_k`` of the start row.  One unordered window per
    key carries the start row's lead array to the other rows."""
    keys = list(keys)
    s = as_col(start, literal=True)
    w_all = Window.partitionBy(*keys)
    k = quarters_between(s, F.col(period))
    hit = (k >= 1) & (k <= n_periods - 1)
    upd = {}
    for c in cols:
        arr = F.array(*[F.col(f"{c}_{j}") for j in range(1, n_periods)])
        carried = F.first(F.when(F.col(period) == s, arr), ignorenulls=True).over(w_all)
        upd[c] = F.when(hit, F.element_at(carried, k.cast("int"))).otherwise(F.col(c))
    return df.withColumns(upd)


def trajectory_mask(df: DataFrame, targets: Sequence[str], suffix: str = "_t") -> DataFrame:
    """Switch ``<t>_switch`` = 1 where a trajectory exists, trajectory NULL -> 0."""
    upd = {}
    for t in targets:
        traj = F.col(t + suffix)
        upd[t + "_switch"] = traj.isNotNull().cast("int")
        upd[t + suffix] = F.coalesce(traj, F.lit(0.0))
    return df.withColumns(upd)


def trajectory_restore(df: DataFrame, targets: Sequence[str], suffix: str = "_t") -> DataFrame:
    """Undo the placeholder of :func:`trajectory_mask`: switch 0 -> NULL."""
    return df.withColumns({t + suffix: F.when(F.col(t + "_switch") == 1, F.col(t + suffix))
                           for t in targets}).drop(*[t + "_switch" for t in targets])


def trajectory_override(df: DataFrame, targets: Sequence[str], trajectories: Sequence[str],
                        instruments: Sequence[str]) -> DataFrame:
    """Force targets onto their trajectory where present; report the gap.

    Output per target: ``<target>`` forced, and ``<instrument>_gap`` =
    trajectory - model value (NULL where no trajectory).
    """
    if not (len(targets) == len(trajectories) == len(instruments)):
        raise ValueError("targets, trajectories and instruments must have the same length")
    upd = {}
    for t, tr, ins in zip(targets, trajectories, instruments):
        upd[ins + "_gap"] = F.col(tr) - F.col(t)
        upd[t] = F.coalesce(F.col(tr), F.col(t))
    # compute gaps from the original target values
    gaps = {k: v for k, v in upd.items() if k.endswith("_gap")}
    forced = {k: v for k, v in upd.items() if not k.endswith("_gap")}
    return df.withColumns(gaps).withColumns(forced)


def baseline_vs_scenario(base: DataFrame, sim: DataFrame, levels: Sequence[str],
                         rates: Sequence[str], start, end, keys: Sequence[str] = KEYS,
                         period: str = PERIOD) -> DataFrame:
    """Report of a scenario against its baseline.

    Levels are shown as 4-quarter growth, rates as they are; the window is
    ``[start - pad, end]`` with ``pad = clamp(round(n/4), 2, 6)`` and ``n`` the
    quarters from start to end.  Output is
    long: ``(keys..., period, series, base, sim, diff)``.
    """
    keys = list(keys)
    names = list(levels) + list(rates)

    def prep(df, tag):
        g = pct_change_n(df.select(*keys, period, *names), levels, 4, keys, period)
        return g.select(*keys, period, *[F.col(c).alias(f"{tag}__{c}") for c in names])

    s, e = as_col(start, literal=True), as_col(end, literal=True)
    n = quarters_between(s, e)
    lo = add_quarters(s, -report_pad(n))
    joined = prep(base, "b").join(prep(sim, "s"), on=keys + [period], how="inner")
    joined = joined.filter(F.col(period).between(lo, e))
    stacked = joined.select(*keys, period, F.explode(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(f"b__{c}").alias("base"),
                 F.col(f"s__{c}").alias("sim")) for c in names])).alias("__r"))
    return stacked.select(*keys, period, "__r.series", "__r.base", "__r.sim",
                          (F.col("__r.sim") - F.col("__r.base")).alias("diff"))


def null_to_zero(df: DataFrame, cols: Mapping[str, float] | Sequence[str]) -> DataFrame:
    """Fill NULLs of the given columns with 0 (or given defaults)."""
    if not isinstance(cols, Mapping):
        cols = {c: 0.0 for c in cols}
    return df.fillna(dict(cols))
