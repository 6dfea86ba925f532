"""Equation residuals on a panel.

Equations are given as ``{name: (lhs Column, rhs Column)}`` built with
:class:`~macroseries.operators.panel.Series`; lags are data, so every
residual is one projection over one window stage (no recursion).
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import endo_to_trac, residual_name
from .panel import PERIOD, _in_range

Equation = Tuple[Column, Column]


def merge_equations(equations: Mapping[str, Equation],
                    new: Mapping[str, Equation]) -> dict[str, Equation]:
    """Definitions replaced or added at run time (X2): ``new`` wins by name,
    names not yet known are appended in their order.

    Each definition is a pair ``(lhs, rhs)`` of columns; anything else raises
    ``ValueError`` before a job starts.
    """
    for name, eq in new.items():
        if not (isinstance(eq, tuple) and len(eq) == 2 and all(isinstance(c, Column) for c in eq)):
            raise ValueError(f"{name}: a definition is a pair (lhs, rhs) of columns")
    return {**equations, **new}


def tracking_residuals(df: DataFrame, equations: Mapping[str, Equation], start=None, end=None,
                       period: str = PERIOD) -> DataFrame:
    """``<v>_trac`` such that ``rhs + v_trac - lhs = 0`` inside the window.

    Outside the window the residual keeps its value (0 when new).
    """
    rng = _in_range(period, start, end)
    upd = {}
    for name, (lhs, rhs) in equations.items():
        col = residual_name(name)
        old = F.col(col) if col in df.columns else F.lit(0.0)
        upd[col] = F.when(rng, lhs - rhs).otherwise(old)
    return df.withColumns(upd)


def residual_closure(df: DataFrame, equations: Mapping[str, Equation], tol: float = 1e-9,
                     suffix: str = "_closes") -> DataFrame:
    """``|rhs + v_trac - lhs| <= tol`` per equation (R2); NULL where inputs are missing."""
    upd = {}
    for name, (lhs, rhs) in equations.items():
        gap = rhs + F.col(residual_name(name)) - lhs
        upd[name + suffix] = F.abs(gap) <= F.lit(tol) * F.greatest(F.lit(1.0), F.abs(lhs))
    return df.withColumns(upd)


def residual_norm(df: DataFrame, equations: Mapping[str, Equation],
                  name: str = "resid_norm") -> DataFrame:
    """Euclidean norm of the equation residuals ``rhs - lhs`` per row."""
    sq = [F.pow(rhs - lhs, 2) for lhs, rhs in equations.values()]
    return df.withColumn(name, F.sqrt(reduce(lambda a, b: a + b, sq)))


def domain_violations(df: DataFrame, exprs: Mapping[str, Tuple[Column, Sequence[str]]],
                      keys: Sequence[str], period: str = PERIOD,
                      strict: bool = False) -> DataFrame:
    """Rows where every input is present but the result is missing, NaN or
    infinite (R3, policy D2): ``(keys..., period, expr, value)``.

    ``strict`` makes the job fail at the first violation (``raise_error``),
    like the reference's warnings-as-errors.
    """
    items = []
    for name, (expr, inputs) in exprs.items():
        ok_in = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs], F.lit(True))
        bad = expr.isNull() | F.isnan(expr) | (F.abs(expr) == F.lit(float("inf")))
        items.append(F.when(ok_in & bad, F.struct(F.lit(name).alias("expr"),
                                                  expr.cast("double").alias("value"))))
    out = df.select(*keys, period, F.explode(F.array(*items)).alias("__v")) \
        .filter(F.col("__v").isNotNull()) \
        .select(*keys, period, "__v.expr", "__v.value")
    if strict:
        out = out.withColumn("value", F.raise_error(F.concat(
            F.lit("numeric domain violation in "), F.col("expr"))).cast("double"))
    return out


def backtest_fanout(tasks: DataFrame, index: str = "task_index", base_year: int = 2004,
                    matrix: Sequence[Sequence[float]] = ((1.0, 2.0), (3.0, 4.0)),
                    stamp: bool = False) -> DataFrame:
    """One small linear solve per task (R10): ``year = base + i`` and
    ``matrix . x = [i, year]``.

    The 2x2 system is solved by Cramer's rule in Column expressions (JVM, in
    the scan's stage).  ``stamp`` adds the run time, kept out of comparisons.
    """
    year = F.lit(base_year) + F.col(index).cast("long")
    df = tasks.select(F.col(index), year.alias("year"))
    (a, b), (c, d) = matrix
    det = a * d - b * c
    if det == 0:
        raise ValueError("singular matrix")
    i, y = F.col(index).cast("double"), F.col("year").cast("double")
    df = df.withColumns({"result_x0": (F.lit(d) * i - F.lit(b) * y) / F.lit(det),
                         "result_x1": (F.lit(a) * y - F.lit(c) * i) / F.lit(det)})
    if stamp:
        df = df.withColumn("timestamp", F.current_timestamp())
    return df


__all__ = ["tracking_residuals", "residual_closure", "residual_norm", "domain_violations",
           "backtest_fanout", "endo_to_trac"]
