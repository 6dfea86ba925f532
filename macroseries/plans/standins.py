"""Stand-in inputs built from the driver's tables.

* observations: ``events`` -> long ``(series_id, date, observation_value)``;
* panel Q: ``lineitem`` per supplier and ship quarter, on a dense quarter grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.periods import add_quarters, quarter_start, truncate
from ..operators.panel import densify, sliced_grid
from ..session import materialize

# Fixed values of the stand-in indicator model: the five event types play the
# series, and their roles mirror the reference model's columns (two passed
# through, one turned into growth, the rest forward-filled).
EVENT_SERIES = ["click", "error", "purchase", "signup", "view"]
RAW_SERIES = ["error", "signup"]
GROWTH_SERIES = {"purchase_mom": "purchase"}
FFILL_SERIES = ["click", "view"]


# Catalogue rows per partition: a row gives about a kilobyte of XML and ten tokens.
CATALOG_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observation table from ``events``: hour, type, value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("series_id"),
                     truncate("hour", F.col("ts")).alias("date"),
                     F.col("value").alias("observation_value"))


def _supplier_measures(lineitem: DataFrame) -> DataFrame:
    """Panel Q's rows: one partial+final aggregation on ``(l_suppkey, quarter)``."""
    return lineitem.groupBy(F.col("l_suppkey").alias("entity"),
                            quarter_start("l_shipdate").alias("period")).agg(
        F.sum("l_quantity").alias("qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("rev"),
        # average discount from whole percentage points: exact in any engine
        (F.sum(F.round(F.col("l_discount") * 100)) / F.count("l_discount") / 100).alias("disc"))


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel Q: ``(entity, period, qty, rev, disc)`` per supplier and quarter, on the per-supplier
    quarter grid (quarters without shipments are NULL)."""
    return densify(_supplier_measures(table(spark, sf_dir, "lineitem")), keys=["entity"],
                   period="period")


def supplier_panel_slice(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    """The quarters ``start`` to ``end`` of panel Q: every row is read for its supplier and date alone,
    measures only where the ship date lies in the range."""
    li = table(spark, sf_dir, "lineitem")
    extents = li.groupBy(F.col("l_suppkey").alias("entity")).agg(
        quarter_start(F.min("l_shipdate")).alias("first"),
        quarter_start(F.max("l_shipdate")).alias("last"))
    after = add_quarters(as_col(end, literal=True), 1)
    rows = li.filter((F.col("l_shipdate") >= as_col(start, literal=True))
                     & (F.col("l_shipdate") < after))
    return sliced_grid(extents, _supplier_measures(rows), start, end, ["entity"])


def catalog_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model catalogue built from ``part``: one variable ``v<partkey>`` per part.

    Parts with ``p_size % 5 = 0`` are exogenous (no equation).  The others
    get an equation that mentions the type word at a lag, the first name
    word inside ``log``, the parent variable ``v<partkey div 2>``, for some
    a second variable ``v<4 * partkey>`` (which closes cycles), a lead of the
    second name word, and for some a coefficient the catalogue lacks.
    """
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.lit("v"), k.cast("string"))
    words = F.split(F.lower(F.col("p_name")), " ")
    w1, w2 = F.element_at(words, 1), F.element_at(words, -1)
    t = F.lower(F.col("p_type"))

    def txt(c):
        return c.cast("string")

    eq = F.concat(
        name, F.lit(" - "), name, F.lit("_aerr = y_"), name, F.lit("_1 * "), t, F.lit("(-"),
        txt(s % 4), F.lit(") + y_"), name, F.lit("_2 * log("), w1, F.lit(") + 0.5 * v"),
        txt(F.floor(k / 2)),
        F.when(s % 7 == 0, F.concat(F.lit(" + 0.1 * v"), txt(k * 4))).otherwise(F.lit("")),
        F.when(s % 3 > 0, F.concat(F.lit(" + "), w2, F.lit("("), txt(s % 3), F.lit(")")))
        .otherwise(F.lit("")),
        F.when(s % 4 == 3, F.concat(F.lit(" + y_"), name, F.lit("_3 * "), w2)).otherwise(F.lit("")))
    has_eq = s % 5 != 0
    coeff = F.array(
        F.struct(F.concat(F.lit("y_"), name, F.lit("(1)")).alias("cf_name"),
                 (F.col("p_retailprice") / 1000).alias("cf_value")),
        F.struct(F.concat(F.lit("y_"), name, F.lit("(2)")).alias("cf_name"),
                 (s.cast("double") / 10.0).alias("cf_value")))
    group = F.when(s % 6 == 1, F.lit("mcap")).when(s % 6 == 2, F.lit("mcwp")) \
        .when(s % 6 == 4, F.lit("other"))
    mce = F.struct(group.alias("mce_group"),
                   F.concat(name, F.lit(" = "), name, F.lit("(1) + "), w1).alias("python_equation"),
                   F.array(F.struct(F.concat(F.lit("y_"), name, F.lit("(3)")).alias("cf_name"),
                                    (s.cast("double") / 100.0).alias("cf_value"))).alias("coeff"))
    # every catalogue query reads the catalogue in several branches: written once to the shared
    # folder, in partitions by the number of rows and not by how the table's file happens to be cut
    # (a file of a few megabytes holds a million variables)
    p = p.repartition(max(1, -(-p.count() // CATALOG_ROWS)))
    return materialize(p.select(
        name.alias("name"),
        F.when(has_eq, F.lit("Behavioral")).otherwise(F.lit("Exogenous")).alias("equation_type"),
        F.when(s % 3 == 0, F.lit("NO")).when(s % 3 == 1, F.lit("YES")).alias("stochastic_type"),
        F.when(has_eq, F.struct(eq.alias("python_equation"), coeff.alias("coeff")))
        .alias("standard_equation"),
        F.when(has_eq & group.isNotNull(), mce).alias("mce_equation"),
        F.col("p_brand")))
