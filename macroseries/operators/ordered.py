"""Ordered scans that do not funnel a whole series into one task.

``lag(x) over (order by date)`` and ``last_value(x ignore nulls) over (...)``
with no ``PARTITION BY`` put the whole table into a single task.  Here the
rows are split into buckets (``keys`` + a coarse bucket of the order column,
e.g. the month of a date); the window runs per bucket in parallel, and the
value that crosses a bucket border comes from a one-row-per-bucket summary
(a partial aggregation, so it is pre-aggregated before the shuffle).  The
summary is the only thing ordered per ``keys``; it has one row per bucket,
which is bounded by the calendar, not by the data.  It is joined back on
``keys + bucket``; AQE turns that join into a broadcast only when the
summary measures small at run time.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "__bucket"


def _bucketed(df: DataFrame, bucket: Column | None) -> tuple[DataFrame, list[str]]:
    if bucket is None:
        return df, []
    return df.withColumn(_B, bucket), [_B]


def scan_columns(df: DataFrame, order: str, keys: Sequence[str] = (),
                 lag: Sequence[str] = (), ffill: Sequence[str] = (),
                 bucket: Column | None = None, lag_suffix: str = "__lag",
                 ffill_suffix: str = "") -> DataFrame:
    """Add ``<c><lag_suffix>`` = previous row's value for every c in ``lag``,
    and forward-fill every c in ``ffill`` (replacing it when ``ffill_suffix``
    is empty), both ordered by ``order`` within ``keys``.

    ``bucket`` (optional) is a coarse, order-preserving function of the
    order column; with it the per-row windows run per bucket.
    """
    keys = list(keys)
    lag, ffill = list(lag), list(ffill)
    df, bcols = _bucketed(df, bucket)
    part = keys + bcols
    w = Window.partitionBy(*part).orderBy(F.col(order).asc_nulls_last())
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = {}
    for c in lag:
        local[c + lag_suffix] = F.lag(c).over(w)
    for c in ffill:
        local[c + ffill_suffix] = F.last(c, ignorenulls=True).over(w_run)
    if not bcols:
        return df.withColumns(local)

    # Summary: the last row's value (for lag) and the last non-null value
    # (for ffill) of every bucket.
    aggs = [F.max_by(F.col(c), F.col(order)).alias(f"__last_{c}") for c in lag]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__lastnn_{c}")
             for c in ffill]
    summary = df.groupBy(*part).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(F.col(_B).asc_nulls_last())
    carry = {}
    for c in lag:
        carry[f"__prev_{c}"] = F.lag(f"__last_{c}").over(ws)
    for c in ffill:
        carry[f"__carry_{c}"] = F.last(f"__lastnn_{c}", ignorenulls=True).over(
            ws.rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(*part, *[v.alias(k) for k, v in carry.items()])

    first = "__first"
    out = df.withColumns(local).withColumn(first, F.row_number().over(w) == 1)
    right = summary.select(*[F.col(p).alias(f"__on_{p}") for p in part], *carry)
    same = [F.col(p).eqNullSafe(F.col(f"__on_{p}")) for p in part]
    out = out.join(right, on=same, how="left").drop(*[f"__on_{p}" for p in part])
    fix = {}
    for c in lag:
        fix[c + lag_suffix] = F.when(F.col(first), F.col(f"__prev_{c}")).otherwise(
            F.col(c + lag_suffix))
    for c in ffill:
        fix[c + ffill_suffix] = F.coalesce(F.col(c + ffill_suffix), F.col(f"__carry_{c}"))
    out = out.withColumns(fix)
    return out.drop(first, _B, *carry.keys())
