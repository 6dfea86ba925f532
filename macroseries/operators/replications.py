"""Bootstrap replications as vectors.

One row per key holds all simulated quarters, and every quarter an array over the replications.  Drawn
quarters are a pure function of (seed, replication, quarter), so each key looks its residuals up in an
array of its own history: adding shocks, running the recursion, growth rates and the quantile fan all
happen inside a row.  Only unreplicated rows are exchanged, when keys meet their history and are
dealt to tasks; results are exploded at the very end.

A key's row holds quarters x replications numbers, both parameters: the number of keys, which grows
with the data, only adds rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.periods import quarters_between
from .bootstrap import draw_index
from .panel import KEYS, PERIOD, _in_range


def shock_vectors(baseline: DataFrame, resid: DataFrame, cols: Sequence[str], nrepl: int,
                  resid_start, resid_end, sim_start, sim_end, seed: int,
                  keys: Sequence[str] = KEYS, period: str = PERIOD,
                  keep: Sequence[str] = ()) -> DataFrame:
    """``(keys..., steps)``: per simulated quarter of ``baseline``, in order, a struct of the quarter
    (``at``), ``drawn`` and ``cols``, the last two with one element per replication: the baseline's
    value plus the (demeaned) residual of the quarter drawn.

    The same draws as :func:`~macroseries.operators.bootstrap.bootstrap_draws`.  ``drawn`` is false,
    and the values NULL, where the key has no residual row for the drawn quarter.  Both inputs hold
    at most one row per key and quarter (a key's repeated quarter in ``resid`` raises an error);
    rows without a period, and keys that only one input has, don't come up.  NULL keys are keys like
    any other.  ``keep`` names columns of ``baseline`` that each step takes along.
    """
    keys, cols = list(keys), list(cols)
    kk = [f"__k_{k}" for k in keys]
    start = as_col(resid_start, literal=True)
    n = quarters_between(start, as_col(resid_end, literal=True)) + 1
    named = [F.col(k).alias(a) for k, a in zip(keys, kk)]
    past = resid.filter(_in_range(period, resid_start, resid_end)).select(
        *named, quarters_between(start, F.col(period)).alias("__q"), *cols)
    past = past.groupBy(*kk).agg(F.map_from_entries(F.collect_list(F.struct(
        "__q", F.struct(*cols)))).alias("__past"))
    past = past.select(*[F.col(a).alias(f"__p{a}") for a in kk], F.transform(
        F.sequence(F.lit(0), n - 1), lambda q: F.try_element_at("__past", q)).alias("__past"))
    sims = baseline.filter(F.col(period).isNotNull() & _in_range(period, sim_start, sim_end)).select(
        *named, F.struct(F.col(period).alias("at"), *cols, *keep).alias("__s"))
    sims = sims.groupBy(*kk).agg(F.sort_array(F.collect_list("__s")).alias("__sims"))
    same = reduce(lambda p, q: p & q, [F.col(a).eqNullSafe(F.col(f"__p{a}")) for a in kk])
    both = sims.join(past, same)
    # rows are small here and grow by the replications below: a fixed number of partitions keeps
    # adaptive execution from putting them into few tasks by their size now
    spark = baseline.sparkSession
    both = both.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                spark.sparkContext.defaultParallelism), *kk)

    repls = F.sequence(F.lit(0), F.lit(nrepl - 1))
    both = both.withColumn("__sims", F.transform("__sims", lambda s: F.struct(
        s.alias("s"), F.transform(repls, lambda r: F.get(
            F.col("__past"), draw_index(F.lit(seed), r, s["at"], n))).alias("h"))))

    def shocked(x: Column, c: str) -> Column:
        return F.transform(x["h"], lambda h: x["s"][c] + h[c]).alias(c)

    def step(x: Column) -> Column:
        return F.struct(
            x["s"]["at"].alias("at"), *[x["s"][c].alias(c) for c in keep],
            F.transform(x["h"], lambda h: h.isNotNull()).alias("drawn"),
            *[shocked(x, c) for c in cols])
    return both.select(*[F.col(a).alias(k) for k, a in zip(keys, kk)],
                       F.transform("__sims", step).alias("steps"))


def vector_paths(df: DataFrame, target: str, a: float, shock: str, init: str,
                 nrepl: int) -> DataFrame:
    """``df`` with ``target``, an array over replications, in every step: from the value in column
    ``init`` on, ``target = a * target(-1) + shock``.  A replication without a residual passes its
    value on and has a NULL in that quarter."""
    inner = df.schema["steps"].dataType.elementType
    out = f"array<struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in inner)}," \
          f"{target}:array<double>>>"
    zero = F.struct(F.array_repeat(F.col(init).cast("double"), nrepl).alias("y"),
                    F.array().alias("out")).cast(f"struct<y:array<double>,out:{out}>")

    def walk(acc, s):
        y = F.transform(acc["y"], lambda p, i: F.when(
            F.get(s["drawn"], i), a * p + F.get(s[shock], i)).otherwise(p))
        return F.struct(y.alias("y"), F.concat(acc["out"], F.array(F.struct(
            *[s[f.name].alias(f.name) for f in inner], y.alias(target)))).alias("out"))

    return df.withColumn("steps", F.transform(
        F.aggregate("steps", zero, walk, lambda acc: acc["out"]), lambda s: F.struct(
            *[s[f.name].alias(f.name) for f in inner],
            F.transform(s[target], lambda v, i: F.when(F.get(s["drawn"], i), v)).alias(target))))


def growth_vectors(df: DataFrame, source: str, out: str, n: int) -> DataFrame:
    """``out = 100 * (source / source(-n) - 1)`` in every step, NULL for the first ``n`` steps,
    missing values and a zero base."""
    names = df.schema["steps"].dataType.elementType.names

    before = F.concat(F.array_repeat(F.lit(None).cast("array<double>"), n),
                      F.transform("steps", lambda s: s[source]))

    def grow(s, b):
        return F.struct(*[s[c].alias(c) for c in names], F.transform(s[source], lambda v, i: (
            v / F.nullif(F.get(b, i), F.lit(0.0)) - 1) * 100).alias(out))
    return df.withColumn("steps", F.zip_with(
        "steps", F.slice(before, F.lit(1), F.size("steps")), grow))


def explode_replications(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS,
                         period: str = PERIOD) -> DataFrame:
    """One row per key, replication and simulated quarter with ``cols``, where a residual was drawn."""
    def cells(s: Column) -> Column:
        return F.transform(s["drawn"], lambda drawn, repl: F.when(drawn, F.struct(
            s["at"].alias("at"), repl.alias("repl"), *[F.get(s[c], repl).alias(c) for c in cols])))
    # "outer", since Spark computes the array twice more to filter rows before a plain explode
    v = df.select(*keys, F.explode_outer(F.flatten(F.transform("steps", cells))).alias("__v"))
    return v.filter(F.col("__v").isNotNull()).select(
        *keys, "__v.repl", F.col("__v.at").alias(period),
        *[F.col("__v").getField(c).alias(c) for c in cols])


def fan_vectors(df: DataFrame, cols: Sequence[str],
                qs: Sequence[float] = (0.05, 0.15, 0.85, 0.95),
                names: Sequence[str] = ("lo90", "lo70", "hi70", "hi90"),
                keys: Sequence[str] = KEYS, period: str = PERIOD) -> DataFrame:
    """Exact quantiles across replications per key, quarter and series of ``cols``, with linear
    interpolation between the two values around each (as ``quantile_fan``, which see): sorted inside
    the row, no exchange.  Without a value the quantiles are NULL."""
    def series(s: Column) -> Column:
        return F.array(*[F.struct(s["at"].alias("at"), F.lit(c).alias("series"), F.array_sort(
            F.filter(s[c], lambda v: v.isNotNull())).alias("v")) for c in cols])
    s = df.select(*keys, F.explode_outer(F.flatten(F.transform("steps", series))).alias("__f"))
    s = s.filter(F.col("__f").isNotNull())
    v, n = F.col("__f.v"), F.size("__f.v")

    def quantile(q: float) -> Column:
        at = F.lit(float(q)) * (n - 1)
        low, high = F.get(v, F.floor(at).cast("int")), F.get(v, F.ceil(at).cast("int"))
        return F.when(n > 0, low + (high - low) * (at - F.floor(at)))
    return s.select(*keys, F.col("__f.at").alias(period), "__f.series", *[quantile(q).alias(c) for q, c in zip(qs, names)])


__all__ = ["shock_vectors", "vector_paths", "growth_vectors", "explode_replications", "fan_vectors"]
