"""Recursive assignment over a range.

``y = a * y(-1) + b`` where every period sees the value already rewritten in
the period before.  The work is parallel across keys (entity, replication)
and, for the linear case, also *within* a key:

* level 1 -- quarters are cut into chunks of ``chunk`` quarters counted from
  the range start (no window needed).  Each chunk's sorted rows are folded in
  the JVM (``aggregate``) into its affine map ``Y -> A*Y + B``;
* level 2 -- the maps are folded per key from the value just before the
  range, giving the value ``Y_in`` entering each chunk;
* level 3 -- each chunk is folded again from its ``Y_in``, emitting its rows.

No group ever holds more than ``chunk`` rows (level 1) or
``quarters / chunk`` rows (level 2), so one very long series is spread over
many tasks.  NULL propagates exactly as in a sequential loop.

The general (non-linear) form streams partitions that are sorted by period
through a numpy step function: it runs once per quarter on the vector of all
keys of a partition, so Python is called quarters x partitions times, never
once per row.  Linear rules with several lags are in ``autoregression``.
"""

from __future__ import annotations

from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_col
from ..functions.periods import add_quarters, ordinal
from ..session import materialize
from .panel import KEYS, PERIOD, _in_range


def linear_recurrence(df: DataFrame, target: str, a, b, start=None, end=None,
                      keys: Sequence[str] = KEYS, period: str = PERIOD,
                      chunk: int = 256, init: DataFrame | None = None,
                      materialize_chunks: bool = False) -> DataFrame:
    """``target = a * target(-1) + b`` over ``[start, end]`` (T9, linear order 1).

    ``a`` and ``b`` are numbers or Columns; they may use other series and
    their lags (see :class:`~macroseries.operators.panel.Series`), not the
    target itself.  Rows outside the range keep their value and restart the
    recursion, so the first quarter of the range sees the target's value in
    the quarter before.  Without a start the first row has no predecessor,
    so the whole path is NULL, as in the reference.

    ``init`` optionally gives the value before the range as a table with
    some of the keys and a column ``init`` (e.g. one row per entity for all
    of its replications), for panels that hold no row before ``start``.

    The input is read once and every row travels through the chunk arrays
    (no join back).  The chunk table feeds two branches (carry and final
    fold); pass ``materialize_chunks=True`` when the input is expensive to
    recompute (e.g. straight from a large scan), so it is written once to
    the shared folder instead of being computed twice.  Chunks count quarters from ``start``, so a range of up
    to ``chunk`` quarters is one sequential fold, bit-identical to a loop;
    longer ranges are folded chunk by chunk in parallel.
    """
    if target not in df.columns:
        raise KeyError(f"series not in panel: {target}")
    keys = list(keys)
    cols = df.columns
    origin = ordinal(as_col(start, literal=True)) if start is not None else F.lit(0)
    rows = df.select(
        F.struct(*[F.col(c) for c in cols]).alias("__row"), *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.coalesce(_in_range(period, start, end), F.lit(False)).alias("__in"),
        as_col(a).cast("double").alias("__a"), as_col(b).cast("double").alias("__b"),
        F.col(target).cast("double").alias("__t"),
        F.floor((ordinal(period) - origin) / chunk).alias("__c"))
    kk = [f"__k_{k}" for k in keys]

    # level 1: sorted rows of a chunk and the chunk's map Y -> A*Y + B; a row
    # outside the range resets the path to its own value
    elem = F.struct(F.col("__row").getField(period).alias("t"), "__in", "__a", "__b", "__t", "__row")
    xs = rows.groupBy(*kk, "__c").agg(F.sort_array(F.collect_list(elem)).alias("__xs"))
    if materialize_chunks:
        # read by two branches (carry and final fold): written once, so the
        # input (and whatever scan feeds it) is computed once
        xs = materialize(xs)

    def step1(acc, x):
        return F.struct(
            F.when(x["__in"], x["__a"] * acc["y"] + x["__b"]).otherwise(x["__t"]).alias("y"),
            F.when(x["__in"], acc["p"] * x["__a"]).otherwise(F.lit(0.0)).alias("p"),
            (acc["r"] | ~x["__in"]).alias("r"))

    zero = F.struct(F.lit(0.0).alias("y"), F.lit(1.0).alias("p"), F.lit(False).alias("r"))
    affine = F.aggregate("__xs", zero, step1)
    # rows without a period stand outside the path: their chunk maps a value to itself
    dated = F.col("__c").isNotNull()
    summ = xs.select(*kk, "__c", F.when(dated, affine["p"]).otherwise(1.0).alias("A"),
                     F.when(dated, affine["y"]).otherwise(0.0).alias("B"),
                     (dated & affine["r"]).alias("R"))

    # level 2: per key, the value entering each chunk
    summ = summ.groupBy(*kk).agg(
        F.sort_array(F.collect_list(F.struct("__c", "A", "B", "R"))).alias("__cs"))
    if init is not None:
        on = [k for k in init.columns if k in keys]
        summ = summ.join(init.select(*[F.col(k).alias(f"__k_{k}") for k in on],
                                     F.col("init").cast("double").alias("__init")),
                         on=[f"__k_{k}" for k in on], how="left")
    else:
        summ = summ.withColumn("__init", F.lit(None).cast("double"))
    carry_t = T.ArrayType(T.StructType([T.StructField("__c", T.LongType()),
                                        T.StructField("Y", T.DoubleType())]))
    zero2 = F.struct(F.col("__init").alias("y"), F.array().cast(carry_t).alias("out"))

    def step2(acc, x):
        nxt = F.when(x["R"], x["B"]).otherwise(x["A"] * acc["y"] + x["B"])
        return F.struct(nxt.alias("y"), F.concat(acc["out"], F.array(
            F.struct(x["__c"].alias("__c"), acc["y"].alias("Y")))).alias("out"))

    carry = summ.select(*kk, F.explode(F.aggregate("__cs", zero2, step2,
                                                   lambda acc: acc["out"])).alias("__k"))
    carry = carry.select(*kk, F.col("__k.__c").alias("__c"), F.col("__k.Y").alias("__Y"))

    # level 3: each chunk folded again from its entering value; the fold
    # emits only the doubles, which are then zipped back onto the rows
    zero3 = F.struct(F.col("__Y").alias("y"), F.array().cast("array<double>").alias("out"))

    def step3(acc, x):
        y = F.when(x["__in"], x["__a"] * acc["y"] + x["__b"]).otherwise(x["__t"])
        return F.struct(y.alias("y"), F.concat(acc["out"], F.array(y)).alias("out"))

    ys = F.aggregate("__xs", zero3, step3, lambda acc: acc["out"])
    on = kk + ["__c"]
    entering = carry.select(*[F.col(c).alias(f"__on{c}") for c in on], "__Y")
    solved = xs.join(entering, on=[F.col(c).eqNullSafe(F.col(f"__on{c}")) for c in on]) \
        .select(F.explode(F.arrays_zip(F.col("__xs.__row").alias("row"), ys.alias("y")))
                .alias("__e"))
    row = F.col("__e").getField("row")
    return solved.select(*[F.col("__e").getField("y").alias(c) if c == target
                           else row.getField(c).alias(c) for c in cols])


def shock_decay(df: DataFrame, target: str, rho: float, start, end=None,
                keys: Sequence[str] = KEYS, period: str = PERIOD) -> DataFrame:
    """``target = rho * target(-1)`` from ``start`` (T10): the closed form
    ``x0 * rho**k`` from the anchor quarter before ``start``; one unordered
    window per key, no join."""
    s = as_col(start, literal=True)
    rng = _in_range(period, start, end)
    w = Window.partitionBy(*keys)
    x0 = F.max_by(F.col(target), F.when(F.col(period) < s, F.col(period))).over(w)
    k = ordinal(period) - ordinal(add_quarters(s, -1))
    return df.withColumn(target, F.when(rng, x0 * F.pow(F.lit(float(rho)), k))
                         .otherwise(F.col(target)))


def general_recurrence(df: DataFrame, target: str, fn: Callable, inputs: Sequence[str],
                       start=None, end=None, keys: Sequence[str] = KEYS,
                       period: str = PERIOD, error_col: str | None = None,
                       vector_keys: Sequence[str] = (), blocks: int | None = None,
                       order: int = 1, deal: Sequence[str] = ()) -> DataFrame:
    """``target[t] = fn(target[t-1], row_t)`` over ``[start, end]`` (T9 general, X3).

    ``fn(prev, row)`` gets the previous (already rewritten) values and the current rows as a mapping
    of ``inputs`` to values, as vectors with one element per key; missing is NaN.  Write it with
    numpy operations.  With ``order`` k above 1, ``prev`` has k rows: ``prev[0]`` is ``target(-1)``,
    ``prev[k - 1]`` is ``target(-k)``.

    The rows of a key go to one partition, whose rows are sorted by period (a sort that spills) and
    streamed in Arrow batches: every batch is worked on a step at a time, with all keys that have a
    row in it, and what is kept between batches is ``order`` values per key.  So neither a key's nor
    a partition's rows are ever in memory together, the input is evaluated once, nothing is counted
    first, and Python is called quarters x partitions times, not once per row.  ``blocks`` sets the
    number of partitions (by default Spark's); ``vector_keys`` has no effect any more: every key is
    part of a vector.

    ``prev`` is the value on the key's previous row, as in :func:`linear_recurrence` and in lags:
    fill gaps with ``densify`` where a missing quarter must count.  Rows without a period keep their
    value and stand outside the path; rows that repeat a quarter are steps of their own, ordered by
    value.  No key sees another's rows, so the result does not depend on partitions or batches.

    With ``error_col`` an exception is caught and its text returned in that column on all of the
    key's rows, with NULL values inside the range, instead of failing the job (R8); the keys that
    raised are isolated by bisection.  Since earlier rows have left by then, this takes one more
    exchange by key, or by ``deal``, some of the keys, so that steps that follow and work by those
    need no exchange of their own.
    """
    if target not in df.columns:
        raise KeyError(f"series not in panel: {target}")
    keys = list(keys)
    inputs = [c for c in inputs if c != target]
    names = df.columns
    dated = F.col(period).isNotNull()
    # columns that are doubles already don't travel twice
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    own, *read = [c if c in doubles else f"__d{k}" for k, c in enumerate([target, *inputs])]
    more = [F.col(c).cast("double").alias(a) for c, a in zip([target, *inputs], [own, *read]) if c != a]
    rows = df.select(*names, (dated & _in_range(period, start, end)).alias("__in"),
                     dated.alias("__dated"), *more)
    if not keys:
        rows = rows.repartition(1)
    elif blocks:
        rows = rows.repartition(blocks, *keys)
    else:
        rows = rows.repartition(*keys)
    rows = rows.sortWithinPartitions(period, *keys, own, *read)
    schema = T.StructType([T.StructField(target, T.DoubleType()) if f.name == target else f
                           for f in df.schema.fields] + [T.StructField("__in", T.BooleanType()),
                                                         T.StructField("__error", T.StringType())])

    def run(batches):
        number_of: list = []
        failed: dict[int, str] = {}
        lost = np.zeros(1024, dtype=bool)
        state = np.full((order, 1024), np.nan)

        def step(at, path, y, ins):
            """New values of rows ``at``, no two of one path; those that fail get an error."""
            try:
                prev = state[:, path[at]]
                y[at] = fn(prev if order > 1 else prev[0], {c: v[at] for c, v in ins.items()})
            except Exception as e:  # noqa: BLE001 - the error becomes data (R8)
                if error_col is None:
                    raise
                if len(at) == 1:
                    failed[int(path[at[0]])] = f"{type(e).__name__}: {e}"
                    lost[path[at[0]]] = True
                    y[at] = np.nan
                    return
                step(at[:len(at) // 2], path, y, ins)
                step(at[len(at) // 2:], path, y, ins)

        for b in batches:
            path = _paths(b, keys, number_of)
            while path.size and path.max() >= state.shape[1]:
                state = np.concatenate([state, np.full_like(state, np.nan)], axis=1)
                lost = np.concatenate([lost, np.zeros_like(lost)])
            ins = {c: _doubles(b.column(a)) for c, a in zip(inputs, read)}
            y = _doubles(b.column(own))
            inside = b.column("__in").to_numpy(zero_copy_only=False)
            live = np.flatnonzero(b.column("__dated").to_numpy(zero_copy_only=False))
            # the k-th rows of all paths in the batch make step k
            nth = pd.Series(path[live]).groupby(path[live]).cumcount().to_numpy()
            live = live[np.argsort(nth, kind="stable")]
            for at in np.split(live, np.cumsum(np.bincount(nth))[:-1]) if len(live) else ():
                hit = at[inside[at]]
                if failed:
                    y[hit[lost[path[hit]]]] = np.nan
                    hit = hit[~lost[path[hit]]]
                if len(hit):
                    step(hit, path, y, ins)
                state[1:, path[at]] = state[:-1, path[at]]
                state[0, path[at]] = y[at]
            out = {c: b.column(c) for c in names}
            # NaN from the Python side means missing
            out[target] = pa.array(y, mask=np.isnan(y))
            error = np.full(b.num_rows, None, dtype=object)
            bad = np.flatnonzero(lost[path])
            error[bad] = [failed[p] for p in path[bad].tolist()]
            yield pa.RecordBatch.from_arrays(
                [*out.values(), b.column("__in"), pa.array(error, pa.string())],
                names=[*names, "__in", "__error"])

    solved = rows.mapInArrow(run, schema)
    if error_col is None:
        return solved.drop("__in", "__error")
    if deal:
        if not set(deal) <= set(keys):
            raise ValueError(f"deal {list(deal)} must be keys")
        solved = solved.repartition(*deal)
    whole = F.max("__error").over(Window.partitionBy(*keys))
    solved = solved.withColumn("__error", whole)
    lost = F.col("__in") & F.col("__error").isNotNull()
    return solved.select(*[F.when(~lost, F.col(c)).alias(c) if c == target else F.col(c)
                           for c in names], F.col("__error").alias(error_col))


def _doubles(column: pa.Array) -> np.ndarray:
    """A writable copy with NaN for NULL."""
    return np.array(column.to_numpy(zero_copy_only=False), dtype=np.float64)


def _paths(batch: pa.RecordBatch, keys: Sequence[str], number_of: list) -> np.ndarray:
    """A number per row, the same for rows with equal keys (NULL and NaN are values like any other);
    ``number_of`` keeps the numbers from batch to batch: for every key those of its values, and for
    every key after the first those of pairs (number by the keys before, number of the value)."""
    if not keys:
        return np.zeros(batch.num_rows, dtype=np.int64)
    if not number_of:
        number_of += [({}, _Numbers()) for _ in keys]
    path = None
    for k, (values, pairs) in zip(keys, number_of):
        seen = batch.column(k).dictionary_encode("encode")
        number = np.array([values.setdefault("NaN" if isinstance(v, float) and v != v else v,
                                             len(values)) for v in seen.dictionary.to_pylist()],
                          dtype=np.int64)
        number = number[seen.indices.to_numpy(zero_copy_only=False)]
        path = number if path is None else pairs((path << 32) | number)
    return path


class _Numbers:
    """Numbers codes in the order of their coming. Codes are found by bisection in sorted arrays, a
    large one and a small one of the latest codes, so that new ones seldom move them all."""

    def __init__(self):
        self.parts = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in range(2)]
        self.n = 0

    def __call__(self, code: np.ndarray) -> np.ndarray:
        code, back = np.unique(code, return_inverse=True)
        out = np.full(len(code), -1, dtype=np.int64)
        for codes, numbers in self.parts:
            if len(codes):
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                out = np.where(codes[at] == code, numbers[at], out)
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = np.arange(self.n, self.n + len(new))
            self.n += len(new)
            large, small = self.parts
            small = self._merged(small, (code[new], out[new]))
            if len(small[0]) ** 2 > 10_000 * max(len(large[0]), 10_000):
                large, small = self._merged(large, small), (code[:0], out[:0])
            self.parts = [large, small]
        return out[back]

    @staticmethod
    def _merged(a, b):
        codes, numbers = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(codes, kind="stable")
        return codes[order], numbers[order]