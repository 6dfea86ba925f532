"""Recursive assignment with any lags: ``y = a1*y(-1) + a2*y(-2) + ... + b``.

With lags up to k, what a row hands on is the vector of the last k values, and a row's rule is an
affine map of that vector.  Maps compose, so a long series needs no single sequential task:

* level 1 -- a chunk's sorted rows are folded into one map.  A map holds, for each of the k values
  leaving the chunk, a constant and one coefficient per value entering it.  A coefficient is NULL
  where a value doesn't depend on an entering value at all, which is not the same as depending on it
  with weight 0: only the latter passes a NULL on;
* level 2 -- the maps of a key are applied one after the other to its starting vector, which gives
  the vector entering each chunk;
* level 3 -- every chunk is folded again from its entering vector and emits its rows.

All three levels are JVM folds over arrays of at most ``chunk`` quarters or one map per chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.periods import ordinal
from ..session import materialize
from .panel import KEYS, PERIOD, _in_range

#: Lags above this make the chunk maps larger than they are worth.
MAX_ORDER = 16


def _combine(x: Column, lags: Sequence[int], value) -> Column:
    """``a1 * value(1) + a2 * value(2) + ... + b`` with the coefficients of row ``x``."""
    return reduce(add, [x[f"a{i}"] * value(i) for i in lags] + [x["b"]])


def _chunk_map(rows: str, lags: Sequence[int], order: int) -> Column:
    """The map of a chunk: per leaving value (newest first) its constant ``c`` and coefficients
    ``m`` over the entering values (newest first)."""
    none = F.lit(None).cast("double")

    def identity(i: int) -> Column:
        return F.struct(F.lit(0.0).alias("c"),
                        F.array(*[F.lit(1.0) if j == i else none for j in range(order)]).alias("m"))

    def step(acc, x):
        def coefficient(j: int) -> Column:
            parts = [acc[i - 1]["m"][j] for i in lags]
            total = reduce(add, [F.coalesce(x[f"a{i}"] * p, F.lit(0.0))
                                 for i, p in zip(lags, parts)])
            return F.when(x["inside"] & reduce(or_, [p.isNotNull() for p in parts]), total)

        # a NULL coefficient or constant leaves the constant NULL, and with it the value
        new = F.struct(
            F.when(x["inside"], _combine(x, lags, lambda i: acc[i - 1]["c"]))
            .otherwise(x["own"]).alias("c"),
            F.array(*[coefficient(j) for j in range(order)]).alias("m"))
        return F.array(new, *[acc[i] for i in range(order - 1)])

    # the casts say that everything may be NULL: a fold's result has its start value's type
    zero = F.array(*[identity(i) for i in range(order)]).cast(
        "array<struct<c:double,m:array<double>>>")
    return F.aggregate(rows, zero, step)


def autoregression(df: DataFrame, target: str, lags: Mapping[int, object], b=0.0, start=None,
                   end=None, keys: Sequence[str] = KEYS, period: str = PERIOD, chunk: int = 256,
                   init: DataFrame | None = None, materialize_chunks: bool = False) -> DataFrame:
    """``target = sum(a * target(-i) for i, a in lags) + b`` over ``[start, end]``.

    ``lags`` maps lags (1, 2, ...) to numbers or Columns, ``b`` is a number or Column; they may use
    other series and their lags, not the target itself.  ``target(-i)`` is the value ``i`` rows
    before in the key's period order (fill gaps with ``densify`` where a missing quarter must
    count): already rewritten inside the range, as it stands outside.

    ``init`` optionally gives the values before the key's first row: some of the keys and an array
    ``init``, newest first; without it, or where it is shorter, they are NULL.  NULL passes on exactly
    as in a sequential loop: through every lag the rule names, whatever its weight, and no other.
    Rows without a period keep their value and stand outside the path; rows that repeat a quarter
    are steps of their own, ordered by their values.  NULL keys are keys like any other.

    A range of up to ``chunk`` quarters is one sequential fold, bit-identical to a loop; longer ones
    are folded chunk by chunk in parallel.  ``materialize_chunks`` writes the chunk table once where
    the input is expensive to compute: two branches read it.
    """
    if target not in df.columns:
        raise KeyError(f"series not in panel: {target}")
    steps = sorted(lags)
    if not steps or steps[0] < 1 or steps[-1] > MAX_ORDER:
        raise ValueError(f"lags must be between 1 and {MAX_ORDER}: {steps}")
    order, keys, cols = steps[-1], list(keys), df.columns
    origin = ordinal(as_col(start, literal=True)) if start is not None else F.lit(0)
    kk = [f"__k_{k}" for k in keys]
    dated = F.col(period).isNotNull()
    rows = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, kk)],
        F.floor((ordinal(period) - origin) / chunk).alias("__c"),
        # undated rows stand outside every path: in lots of any rows, so none grows with the data
        F.when(~dated, F.floor(F.monotonically_increasing_id() / chunk)).alias("__lot"),
        F.struct(F.col(period).alias("at"),
                 (dated & _in_range(period, start, end)).alias("inside"),
                 F.col(target).cast("double").alias("own"),
                 *[as_col(lags[i]).cast("double").alias(f"a{i}") for i in steps],
                 as_col(b).cast("double").alias("b"),
                 F.struct(*[F.col(c) for c in cols]).alias("row")).alias("__x"))
    chunks = rows.groupBy(*kk, "__c", "__lot").agg(F.sort_array(F.collect_list("__x")).alias("__xs"))
    if materialize_chunks:
        chunks = materialize(chunks)

    maps = chunks.filter(F.col("__c").isNotNull()).select(
        *kk, F.struct("__c", _chunk_map("__xs", steps, order).alias("s")).alias("__map"))
    maps = maps.groupBy(*kk).agg(F.sort_array(F.collect_list("__map")).alias("__maps"))
    if init is not None:
        on = [k for k in init.columns if k in keys]
        given = init.select(*[F.col(k).alias(f"__i_{k}") for k in on],
                            F.col("init").cast("array<double>").alias("__init"))
        same = reduce(lambda p, q: p & q, [F.col(f"__k_{k}").eqNullSafe(F.col(f"__i_{k}"))
                                           for k in on])
        maps = maps.join(given, same, "left").drop(*[f"__i_{k}" for k in on])
    else:
        maps = maps.withColumn("__init", F.lit(None).cast("array<double>"))
    state = F.array(*[F.get("__init", F.lit(i)) for i in range(order)])
    first = F.struct(state.alias("y"), F.array().alias("out")).cast(
        "struct<y:array<double>,out:array<struct<__c:bigint,y:array<double>>>>")

    def enter(acc, x):
        def leaving(i: int) -> Column:
            slot = x["s"][i]
            return reduce(add, [F.when(slot["m"][j].isNull(), 0.0)
                                .otherwise(slot["m"][j] * acc["y"][j]) for j in range(order)]
                          + [slot["c"]])
        return F.struct(F.array(*[leaving(i) for i in range(order)]).alias("y"),
                        F.concat(acc["out"], F.array(F.struct(x["__c"].alias("__c"),
                                                              acc["y"].alias("y")))).alias("out"))

    entering = F.aggregate("__maps", first, enter, lambda acc: acc["out"])
    entering = maps.select(*[F.col(k).alias(f"__on{k}") for k in kk], F.explode(entering).alias("__e"))
    entering = entering.select(*[f"__on{k}" for k in kk], F.col("__e.__c").alias("__on__c"),
                               F.col("__e.y").alias("__y"))

    def emit(acc, x):
        y = F.when(x["inside"], _combine(x, steps, lambda i: acc["y"][i - 1])).otherwise(x["own"])
        return F.struct(F.array(y, *[acc["y"][i] for i in range(order - 1)]).alias("y"),
                        F.concat(acc["out"], F.array(y)).alias("out"))

    before = F.coalesce("__y", F.array(*[F.lit(None).cast("double")] * order))
    before = F.struct(before.alias("y"), F.array().alias("out")).cast(
        "struct<y:array<double>,out:array<double>>")
    values = F.aggregate("__xs", before, emit, lambda acc: acc["out"])
    same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"__on{c}")) for c in [*kk, "__c"]])
    solved = chunks.join(entering, same, "left").select(F.explode(F.arrays_zip(
        F.col("__xs.row").alias("row"), values.alias("y"))).alias("__e"))
    return solved.select(*[F.col("__e.y").alias(c) if c == target
                           else F.col("__e.row").getField(c).alias(c) for c in cols])


__all__ = ["autoregression", "MAX_ORDER"]
