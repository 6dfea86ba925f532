"""Indicator table: long observations -> wide table -> growth and fills
(A1, W1, W2, O1, T15).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import truncate
from ..functions.scalar import div
from ..session import materialize
from .ordered import scan_columns


def pivot_long(obs: DataFrame, index: Sequence[str] | str, series: str, value: str,
               series_list: Sequence[str], names: Mapping[str, str] | None = None,
               agg: str = "max") -> DataFrame:
    """``MAX(CASE WHEN series = s THEN value END) ... GROUP BY index`` (A1).

    The series list is always given: no extra job to find the distinct
    values, and a series absent from the data still becomes a (NULL)
    column.  Written as conditional aggregates, exactly like the SQL: one
    partial aggregation map-side, one shuffle on ``index``, one final
    aggregation (``DataFrame.pivot`` would add a second shuffle on
    ``(index, series)``).
    """
    index = [index] if isinstance(index, str) else list(index)
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg,
          "first": lambda c: F.first(c, ignorenulls=True)}[agg]
    names = dict(names or {})
    return obs.groupBy(*index).agg(*[
        fn(F.when(F.col(series) == F.lit(s), F.col(value))).alias(names.get(s, s))
        for s in series_list])


def pct_change(col: str, prev: str, times: float = 100.0) -> Column:
    """``(x / prev - 1) * 100``; NULL when prev is 0 or missing."""
    return (div(F.col(col), F.col(prev)) - 1) * times


def indicator_table(obs: DataFrame, series_list: Sequence[str],
                    names: Mapping[str, str], growth: Mapping[str, str],
                    ffill: Sequence[str], raw: Sequence[str], date: str = "date",
                    series: str = "series_id", value: str = "observation_value",
                    keys: Sequence[str] = (), bucket: str | None = "month",
                    sort: bool = True, materialize_wide: bool = True) -> DataFrame:
    """The indicator model.

    ``obs`` is long ``(keys..., date, series, value)``.  ``growth`` maps an
    output name to the (renamed) series whose previous-row growth it holds;
    ``ffill`` lists the series forward-filled; ``raw`` the ones passed
    through.  Output is ordered newest first unless ``sort`` is false.

    The wide table (one row per date) is written once to the shared
    checkpoint folder before the ordered scans, which read it twice (rows
    and bucket summary): the observations are scanned once.
    """
    keys = list(keys)
    wide = pivot_long(obs, keys + [date], series, value, series_list, names)
    if materialize_wide:
        wide = materialize(wide)
    b = truncate(bucket, F.col(date)) if bucket else None
    lag_cols = list(dict.fromkeys(growth.values()))
    scanned = scan_columns(wide, order=date, keys=keys, lag=lag_cols, ffill=ffill, bucket=b)
    cols = [F.col(k) for k in keys] + [F.col(date)]
    cols += [F.col(c) for c in raw]
    cols += [pct_change(src, src + "__lag").alias(out) for out, src in growth.items()]
    cols += [F.col(c) for c in ffill]
    out = scanned.select(*cols)
    if sort:
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in keys],
                          F.col(date).desc_nulls_last())
    return out


def inflation_mom(wide: DataFrame, col: str, date: str = "date", keys: Sequence[str] = (),
                  name: str | None = None, over_observed: bool = False,
                  bucket: str | None = "month") -> DataFrame:
    """Previous-row growth in percent.

    ``over_observed`` compares with the previous non-null value instead of
    the previous row (quirk Q3 of the reference is the default).
    """
    name = name or f"{col}_mom"
    b = truncate(bucket, F.col(date)) if bucket else None
    if over_observed:
        tmp = wide.withColumn("__obs", F.col(col))
        s = scan_columns(tmp, order=date, keys=keys, lag=["__obs"], bucket=b)
        # previous observed = ffill of the lagged column
        s = scan_columns(s, order=date, keys=keys, ffill=["__obs__lag"], bucket=b)
        return s.withColumn(name, pct_change(col, "__obs__lag")).drop("__obs", "__obs__lag")
    s = scan_columns(wide, order=date, keys=keys, lag=[col], bucket=b)
    return s.withColumn(name, pct_change(col, col + "__lag")).drop(col + "__lag")


def forward_fill(wide: DataFrame, cols: Sequence[str], date: str = "date",
                 keys: Sequence[str] = (), bucket: str | None = "month") -> DataFrame:
    """``last_value(x IGNORE NULLS) OVER (... ROWS UNBOUNDED PRECEDING)``."""
    b = truncate(bucket, F.col(date)) if bucket else None
    return scan_columns(wide, order=date, keys=keys, ffill=cols, bucket=b)
