"""Quarterly periods as Spark columns (P5-P10).

A period is a ``DATE`` on the first day of its quarter.  Arithmetic uses the
integer ordinal ``year * 4 + quarter - 1`` so that differences are exact and
joins on "the quarter n before" are plain equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import as_col


def quarter_start(c) -> Column:
    """Truncate a date or timestamp to the first day of its quarter (DATE).

    Built from the wall-clock fields, so it does not depend on the session
    time zone (``date_trunc`` would pass a ``TIMESTAMP_NTZ`` through the
    session zone).
    """
    c = as_col(c)
    return F.make_date(F.year(c), (F.quarter(c) - 1) * 3 + 1, F.lit(1))


def truncate(unit: str, c) -> Column:
    """Truncate a timestamp to ``hour``, ``day``, ``month``, ``quarter`` or
    ``year`` as a ``TIMESTAMP_NTZ`` wall-clock value, independent of the
    session time zone."""
    c = as_col(c)
    zero = F.lit(0)
    y, mo, d = F.year(c), F.month(c), F.dayofmonth(c)
    if unit == "hour":
        return F.make_timestamp_ntz(y, mo, d, F.hour(c), zero, zero)
    if unit == "day":
        return F.make_timestamp_ntz(y, mo, d, zero, zero, zero)
    if unit == "month":
        return F.make_timestamp_ntz(y, mo, F.lit(1), zero, zero, zero)
    if unit == "quarter":
        return F.make_timestamp_ntz(y, (F.quarter(c) - 1) * 3 + 1, F.lit(1), zero, zero, zero)
    if unit == "year":
        return F.make_timestamp_ntz(y, F.lit(1), F.lit(1), zero, zero, zero)
    raise ValueError(f"unknown unit {unit!r}")


def ordinal(c) -> Column:
    """Quarter ordinal ``year*4 + quarter - 1`` of a date column."""
    c = as_col(c)
    return (F.year(c) * 4 + F.quarter(c) - 1).cast("int")


def from_ordinal(o) -> Column:
    """Inverse of :func:`ordinal`."""
    o = as_col(o)
    y = F.floor(o / 4).cast("int")
    q = (o - y * 4).cast("int")
    return F.make_date(y, q * 3 + 1, F.lit(1))


def parse_quarter(s) -> Column:
    """Parse ``'2040Q1'`` or ``'2040q1'`` (surrounding blanks allowed) to a DATE.

    Text that is not a quarter gives NULL, never an error.
    """
    s = F.upper(F.trim(as_col(s)))
    pat = r"^(\d{4})Q([1-4])$"
    y = F.regexp_extract(s, pat, 1)
    q = F.regexp_extract(s, pat, 2)
    ok = y != F.lit("")
    return F.when(ok, F.make_date(y.cast("int"), q.cast("int") * 3 - 2, F.lit(1)))


def quarter_text(c, lower: bool = False) -> Column:
    """Format a date as ``YYYYQn`` (or ``YYYYqn``)."""
    c = as_col(c)
    return F.concat(F.year(c).cast("string"), F.lit("q" if lower else "Q"),
                    F.quarter(c).cast("string"))


def add_quarters(c, n) -> Column:
    """``period + n`` quarters."""
    return F.add_months(as_col(c), as_col(n) * 3)


def quarters_between(start, end) -> Column:
    """``(end - start).n``: whole quarters from start to end."""
    return ordinal(end) - ordinal(start)


def period_sequence(start, end) -> Column:
    """Array of quarter starts from ``start`` to ``end`` inclusive."""
    return F.sequence(quarter_start(start), quarter_start(end), F.expr("INTERVAL 3 MONTHS"))


def explode_periods(df: DataFrame, start, end, name: str = "period") -> DataFrame:
    """One row per quarter of ``[start, end]`` for every input row."""
    return df.withColumn(name, F.explode(period_sequence(start, end)))


def slice_periods(df: DataFrame, start, end, period: str = "period") -> DataFrame:
    """Inclusive date-range slice ``loc[start:end]`` (P5)."""
    c = F.col(period)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= as_col(start, literal=True))
    if end is not None:
        cond = cond & (c <= as_col(end, literal=True))
    return df.filter(cond)


def report_pad(n) -> Column:
    """History padding of a report: ``max(min(round(n/4), 6), 2)``.

    Python's ``round`` is banker's rounding, hence ``bround``.
    """
    return F.greatest(F.least(F.bround(as_col(n) / 4.0, 0), F.lit(6.0)), F.lit(2.0)).cast("int")


def trim_window(df: DataFrame, sim_start, sim_end, period: str = "period",
                history: int = 6) -> DataFrame:
    """Keep the simulation window plus ``history`` earlier quarters (P10)."""
    start = add_quarters(as_col(sim_start, literal=True), -history)
    return df.filter(F.col(period).between(start, as_col(sim_end, literal=True)))


def quarter_lit(q: str) -> Column:
    """Literal DATE for a quarter string such as ``'2001Q4'``."""
    return parse_quarter(F.lit(q))
