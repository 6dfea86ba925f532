"""Data checks (A6, A7, U3): each returns the failing rows as a DataFrame;
``raise_if_any`` turns a non-empty result into an error with one small
action (``limit(n)``), never a full collect."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: most repeated digests that are broadcast (32 bytes each)
BROADCAST_DIGESTS = 1_000_000


class MissingDataError(Exception):
    """Series required by the model are absent from the data."""


class DataTestError(Exception):
    """A ``unique`` / ``not_null`` check returned failing rows."""


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column: ``(column, n_null)``.

    One pass, one partial aggregation; NaN counts as missing.
    """
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float")}
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if c in numeric:
            miss = miss | F.isnan(F.col(c))
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null")) for c in cols]))
        .alias("__a")).select("__a.column", "__a.n_null")


def check_unique(df: DataFrame, key: str | Sequence[str], prehash: bool | None = None,
                 broadcast_rows: int = BROADCAST_DIGESTS) -> DataFrame:
    """Keys that occur more than once, NULL keys ignored (A7 ``unique``):
    ``(key..., n)``.

    For wide keys (strings, e.g. whole documents) the first pass counts
    256-bit digests, so its shuffle carries one digest per distinct key.  The
    repeated digests are written once and counted: up to ``broadcast_rows``
    they are broadcast and only texts that repeat move, combined before their
    shuffle; beyond, a shuffled semi join finds the same rows.  Exact
    equality of the full key decides in the end.  ``prehash`` defaults to on
    for string keys.
    """
    key = [key] if isinstance(key, str) else list(key)
    nn = df.select(*key)
    for k in key:
        nn = nn.filter(F.col(k).isNotNull())
    if prehash is None:
        prehash = any(df.schema[k].dataType.typeName() in ("string", "binary") for k in key)
    if prehash:
        digest = F.concat(*[F.unhex(F.sha2(F.col(k).cast("binary") if t in ("string", "binary")
                                           else F.col(k).cast("string").cast("binary"), 256))
                            for k, t in ((k, df.schema[k].dataType.typeName()) for k in key)])
        nn = nn.withColumn("__h", digest)
        rep = materialize(nn.groupBy("__h").agg(F.count(F.lit(1)).alias("__n"))
                          .filter(F.col("__n") > 1).select("__h"))
        if rep.count() <= broadcast_rows:
            rep = F.broadcast(rep)
        nn = nn.join(rep, on="__h", how="left_semi").select(*key)
    return nn.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is NULL (A7 ``not_null``)."""
    return df.filter(F.col(col).isNull())


def missing_names(required: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Required names that are absent (U3): a left anti join."""
    return required.select(name).distinct().join(present.select(name).distinct(), on=name, how="left_anti")


def raise_if_any(df: DataFrame, error: type[Exception] = DataTestError, label: str = "",
                 show: int = 5) -> DataFrame:
    """Raise when ``df`` has rows; the message names up to ``show`` of them."""
    rows = df.limit(show).collect()
    if rows:
        raise error(f"{label}: {[tuple(r) for r in rows]}")
    return df
