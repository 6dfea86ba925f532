"""Model catalogue and equation tables.

The catalogue is a DataFrame with one row per variable (see
:data:`macroseries.sources.files.CATALOG_SCHEMA`); equations are a table
``(name, equation)``.  Tokenising is ``regexp_extract_all`` + ``posexplode``
(JVM side), so any number of equations is split across tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import SUPPORTED_FUNCTIONS, clean_eq

# A variable mention: an identifier of two or more characters starting with
# a lower-case letter, optionally followed by an integer offset in brackets.
TOKEN_RE = r"\b([a-z]\w+)(?:\((-?\d+)\))?(?!\w)"
# Coefficient names as they appear in equations, e.g. ``y_xgdp_2``.
COEF_RE = r"^y_\w+_\d+$"
# MCE groups selectable by name (fixed values of the catalogue format).
MCE_GROUPS = {"mcap": ["mcap"], "wp": ["mcwp"], "mcap+wp": ["mcap", "mcwp"]}


# ----------------------------------------------------------------- predicates
def endogenous(cat: DataFrame) -> DataFrame:
    """Names of variables that have a standard equation."""
    return cat.filter(F.col("standard_equation").isNotNull()).select("name")


def exogenous(cat: DataFrame) -> DataFrame:
    """Names with ``equation_type = 'Exogenous'``."""
    return cat.filter(F.col("equation_type") == "Exogenous").select("name")


def stochastic(cat: DataFrame) -> DataFrame:
    """Names whose ``stochastic_type`` is present and not ``NO``."""
    return cat.filter(F.col("stochastic_type") != "NO").select("name")


def equations(cat: DataFrame) -> DataFrame:
    """``(name, equation)`` with whitespace removed."""
    return cat.filter(F.col("standard_equation.python_equation").isNotNull()).select(
        "name", clean_eq(F.col("standard_equation.python_equation")).alias("equation"))


def mce_equations(cat: DataFrame, mce_type: str | Sequence[str]) -> DataFrame:
    """Alternative equations by group name or by explicit variable list."""
    mce = cat.filter(F.col("mce_equation.python_equation").isNotNull())
    if isinstance(mce_type, str):
        if mce_type != "all":
            if mce_type not in MCE_GROUPS:
                raise ValueError(f"unknown mce_type {mce_type!r}")
            mce = mce.filter(F.col("mce_equation.mce_group").isin(MCE_GROUPS[mce_type]))
    else:
        mce = mce.filter(F.col("name").isin(list(mce_type)))
    return mce.select("name", clean_eq(F.col("mce_equation.python_equation")).alias("equation"))


def override_equations(base: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by name (J5, X2): new equations replace old ones, new names are
    appended: ``(name, equation, source)``."""
    b = base.select("name", F.col("equation").alias("__old"))
    n = new.select("name", F.col("equation").alias("__new"))
    j = b.join(n, on="name", how="full_outer")
    return j.select("name", F.coalesce("__new", "__old").alias("equation"),
                    F.when(F.col("__new").isNotNull(), F.lit("override"))
                    .otherwise(F.lit("base")).alias("source"))


def coefficients(cat: DataFrame, which: str = "standard_equation") -> DataFrame:
    """``(name, cf_name, cf_value)``; ``y_x(2)`` is renamed ``y_x_2``."""
    c = cat.select("name", F.explode(F.col(f"{which}.coeff")).alias("__c"))
    return c.select("name", F.regexp_replace(F.col("__c.cf_name"), r"y_(.*?)\((\d+)\)", "y_$1_$2")
                    .alias("cf_name"), F.col("__c.cf_value").alias("cf_value"))


# ----------------------------------------------------------------- tokens
def tokens(eqs: DataFrame, keep_functions: bool = False) -> DataFrame:
    """One row per variable mention (E1): ``(name, pos, variable, offset, is_coef)``.

    ``pos`` counts mentions from 0 in the order they appear; function names
    are dropped; ``x`` has offset 0 and ``x(-2)`` offset -2.
    """
    m = eqs.select("name", F.posexplode(F.regexp_extract_all(F.col("equation"),
                                                           F.lit(TOKEN_RE), 0)).alias("pos", "m"))
    t = m.select("name", "pos",
                 F.regexp_extract("m", r"^([a-z]\w+)", 1).alias("variable"),
                 F.coalesce(F.regexp_extract("m", r"\((-?\d+)\)$", 1).try_cast("int"),
                            F.lit(0)).alias("offset"))
    if not keep_functions:
        t = t.filter(~F.col("variable").isin(SUPPORTED_FUNCTIONS))
    return t.withColumn("is_coef", F.col("variable").rlike(COEF_RE))


def edges(tok: DataFrame, endo: DataFrame) -> DataFrame:
    """Contemporaneous dependencies ``src -> dst`` (E2): a variable mentioned at
    offset 0 on the right of ``dst``'s equation, if it is endogenous; the
    equation's own variable is excluded (no self-loops, Q12)."""
    t = tok.filter((F.col("offset") == 0) & ~F.col("is_coef") & (F.col("variable") != F.col("name")))
    # never a broadcast: the names of a large model would pass through the driver
    t = t.join(endo.select(F.col("name").alias("variable")).hint("merge"), on="variable",
               how="left_semi")
    return t.select(F.col("variable").alias("src"), F.col("name").alias("dst")).distinct()


def lead_profile(tok: DataFrame) -> DataFrame:
    """Per equation: longest lead (at least 0) and whether any lead exists (A5)."""
    return tok.groupBy("name").agg(F.greatest(F.max("offset"), F.lit(0)).alias("max_lead"),
                                   F.bool_or(F.col("offset") > 0).alias("has_leads"))


def stack_tokens(tok: DataFrame, n_periods: int) -> DataFrame:
    """Copies of every equation shifted by 1..n-1 periods (E3):
    ``(name, shift, pos, variable, offset)``.  After the shift a positive
    offset k becomes the lead series ``v_k`` at offset 0; the copies are a
    generator (``explode(sequence)``), not a join."""
    s = tok.withColumn("shift", F.explode(F.sequence(F.lit(1), F.lit(n_periods - 1))))
    off = F.col("offset") + F.col("shift")
    return s.select("name", "shift", "pos",
                    F.when(off > 0, F.concat(F.col("variable"), F.lit("_"), off.cast("string")))
                    .otherwise(F.col("variable")).alias("variable"),
                    F.when(off > 0, F.lit(0)).otherwise(off).alias("offset"))


def missing_coefficients(tok: DataFrame, coefs: DataFrame) -> DataFrame:
    """Coefficients used in equations but absent from the catalogue."""
    used = tok.filter(F.col("is_coef")).select("name", F.col("variable").alias("cf_name")).distinct()
    return used.join(coefs.select("cf_name"), on="cf_name", how="left_anti")


def used_inputs(exo: DataFrame, tok: DataFrame) -> DataFrame:
    """Exogenous series that some equation mentions (P14, exact token match)."""
    used = tok.select(F.col("variable").alias("name")).distinct()
    # never a broadcast: the mentions are several times the catalogue's rows
    return exo.join(used.hint("merge"), on="name", how="left_semi")


def new_inputs(eqs: DataFrame, known: DataFrame) -> DataFrame:
    """Words of the equations that are not functions, known names or numbers
    (U4): ``(name, first_seen)`` with the first position of each word over
    the equations in ``eqs`` order of ``(order, pos)``."""
    words = eqs.select(F.col("order"), F.posexplode(F.split(
        F.trim(F.regexp_replace("equation", r"[^\w]+", " ")), " ")).alias("pos", "name"))
    words = words.filter((F.col("name") != "") & ~F.col("name").rlike(r"^\d")
                         & ~F.col("name").isin(SUPPORTED_FUNCTIONS))
    words = words.join(known.select("name"), on="name", how="left_anti")
    return words.groupBy("name").agg(F.min(F.struct("order", "pos")).alias("first_seen")) \
        .select("name", F.col("first_seen.order").alias("order"), F.col("first_seen.pos").alias("pos"))


def is_lead(name: Column | str) -> Column:
    """Names like ``x_3`` (P16): ``_\\d+`` anywhere, as the reference searches."""
    c = F.col(name) if isinstance(name, str) else name
    return c.rlike(r"_\d+")


def exogenize(eqs: DataFrame, exo: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turn listed variables into inputs (P17): their equations are dropped
    and their names join the input list (deduplicated).  ``<v>_trac`` of an
    exogenized variable is no longer an input, nor is a series that has an
    equation.  Returns ``(eqs, inputs)``."""
    n = names.select("name").distinct()
    kept = eqs.join(n, on="name", how="left_anti")
    tracs = n.select(F.concat("name", F.lit("_trac")).alias("name"))
    inputs = exo.select("name").unionByName(n).distinct().join(tracs, on="name", how="left_anti")
    inputs = inputs.join(kept.select("name").distinct(), on="name", how="left_anti")
    return kept, inputs
