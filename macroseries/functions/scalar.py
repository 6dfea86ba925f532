"""Scalar functions allowed in series expressions.

All are JVM-side Column expressions.  Policy for numeric-domain trouble
(D2/D3): a result that is NaN, or an argument that is NaN, becomes NULL;
``/ 0`` is NULL (``try_divide``), never an ANSI error.  Infinity from
``exp`` overflow is kept and reported by ``domain_violations``.
"""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col


def nan_to_null(x) -> Column:
    x = as_col(x)
    return F.when(~F.isnan(x), x)


def div(a, b) -> Column:
    """``a / b``; NULL when ``b`` is 0 (F1)."""
    return nan_to_null(F.try_divide(as_col(a), as_col(b)))


def power(a, b) -> Column:
    """``a ** b``; a negative base with a fractional exponent is NULL (F2)."""
    return nan_to_null(F.pow(as_col(a), as_col(b)))


def log(x) -> Column:
    """Natural log; NULL for x <= 0."""
    x = as_col(x)
    return F.when(x > 0, F.ln(x))


def exp(x) -> Column:
    """Exponential (F4); overflow gives Infinity."""
    return F.exp(as_col(x))


def abs_(x) -> Column:
    """Absolute value."""
    return F.abs(as_col(x))


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def vmax(*args) -> Column:
    """Row-wise max; a missing argument makes the result missing."""
    cols = [nan_to_null(a) for a in args]
    if len(cols) == 1:
        return cols[0]
    return F.when(~_any_null(cols), F.greatest(*cols))


def vmin(*args) -> Column:
    """Row-wise min; a missing argument makes the result missing."""
    cols = [nan_to_null(a) for a in args]
    if len(cols) == 1:
        return cols[0]
    return F.when(~_any_null(cols), F.least(*cols))


def ind_ltezero(x) -> Column:
    """0 if x > 0 else 1; missing counts as not > 0."""
    return F.when(nan_to_null(x) > 0, F.lit(0)).otherwise(F.lit(1))


def heaviside(x) -> Column:
    """1 if x > 0 else 0 (F8)."""
    return F.when(nan_to_null(x) > 0, F.lit(1)).otherwise(F.lit(0))


def piecewise(*pairs) -> Column:
    """First-true choice: ``piecewise((v1, c1), (v2, c2), ...)`` (F8).

    No branch true gives NULL.
    """
    out = None
    for v, c in pairs:
        out = F.when(as_col(c), as_col(v)) if out is None else out.when(as_col(c), as_col(v))
    return out


def clean_eq(s) -> Column:
    """Remove every whitespace character."""
    return F.regexp_replace(as_col(s), r"\s+", "")


def flip_equals(s) -> Column:
    """``lhs = rhs`` -> ``rhs-(lhs)`` (F9); text after a second ``=`` is dropped."""
    parts = F.split(as_col(s), "=")
    return F.concat(F.try_element_at(parts, F.lit(2)), F.lit("-("),
                    F.try_element_at(parts, F.lit(1)), F.lit(")"))


# fixed format value: a name and the digits of its lead
_LEAD = r"^(.*?)(_\d+)"


def residual_name(name: str) -> str:
    """Name of a series' residual, for a name known when the plan is built."""
    lead = re.match(_LEAD, name)
    base, digits = lead.groups() if lead else (name, "")
    return base + "_trac" + digits


def endo_to_trac(name) -> Column:
    """Residual name: ``v`` -> ``v_trac``, ``v_3`` -> ``v_trac_3``.

    As in the reference, text after the first ``_<digits>`` is dropped.
    """
    n = as_col(name)
    head = F.regexp_extract(n, _LEAD, 1)
    tail = F.regexp_extract(n, _LEAD, 2)
    return F.when(tail == "", F.concat(n, F.lit("_trac"))).otherwise(
        F.concat(head, F.lit("_trac"), tail))


def is_number(s) -> Column:
    """Does the text parse as a floating-point number."""
    return as_col(s).try_cast("double").isNotNull()


# Names of the functions allowed inside model equations (fixed values; they
# are the identifiers that tokenising must not treat as series names).
SUPPORTED_FUNCTIONS = ["log", "exp", "max", "min", "abs", "ind_ltezero"]

# Python callables for user expressions.
FUNCTIONS = {
    "log": log,
    "exp": exp,
    "max": vmax,
    "min": vmin,
    "abs": abs_,
    "ind_ltezero": ind_ltezero,
}
