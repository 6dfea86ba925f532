"""Quality rules as a learned decision list, in DataFrame operations only.

Per document: word and symbol counts, repeated lines and repeated 8-word windows, and ratios of
them. Sequential covering learns the list: a rule grows one threshold condition at a time by
information gain over the labelled rows that no earlier rule covers, is pruned on held-back rows,
and is kept when precise there. Each step is one small aggregation over (feature, bin) counts. The
list becomes an ordered ``CASE WHEN``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import write_once

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
QUANTILES, MAX_RULES, MAX_CONDITIONS = 24, 12, 4
MIN_PRECISION, MIN_COVER = 0.97, 5
FEATURES = ["mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio",
            "upper_ratio", "mark_ratio", "line_words"]


def _with_later(hashes: str, k: int):
    """Hash of an element and the one ``k`` places on."""
    return lambda x, i: F.xxhash64(x, F.get(F.col(hashes), i + k))


def _below(feature: str):
    return lambda t: t < F.col(feature)


def measure(docs: DataFrame) -> DataFrame:
    """Counts and ratios of every row of ``docs`` (doc_id, text); NULL text has no words. A ratio
    without a denominator is 0."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(
        r"[^\x20\x09-\x0D]")))
    bare = F.regexp_replace("text", SPACE, "")
    d = d.select("doc_id", "words", F.size("words").alias("n"), F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                 F.length(bare).alias("word_chars"),
                 (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).alias("n_symbols"),
                 F.length(F.regexp_replace(bare, r"\P{Lu}+", "")).alias("n_upper"),
                 F.length(F.regexp_replace(bare, r"[\p{L}\p{N}]+", "")).alias("n_marks"))
    # hashes of windows of 2, 4 and 8 words; each level is read twice, so none is computed again
    d = d.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    for k in (1, 2, 4):
        d = d.withColumn(f"h{2 * k}", F.transform(f"h{k}", _with_later(f"h{k}", k)))
    d = d.withColumn("win", F.slice("h8", F.lit(1), F.greatest(F.col("n") - WINDOW + 1, F.lit(0))))
    d = d.withColumn("again", F.size("win") > F.size(F.array_distinct("win")))
    d = d.withColumn("sorted", F.when(F.col("again"), F.sort_array(F.transform(
        "win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("at", F.when(F.col("again"), F.sort_array(F.transform(F.filter(
        "sorted", lambda x, i: (x["h"] == F.coalesce(F.get("sorted", i - 1)["h"], F.bitwise_not(x["h"])))
        | (x["h"] == F.coalesce(F.get("sorted", i + 1)["h"], F.bitwise_not(x["h"])))), lambda x: x["i"]))))
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(
        F.get("at", i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    d = d.select("doc_id", F.col("n").cast("long").alias("n_words"),
                 F.col("word_chars").cast("long").alias("word_chars"),
                 F.col("n_symbols").cast("long").alias("n_symbols"),
                 F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
                 F.when(F.col("again"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
                 "n_lines", F.size(F.array_distinct("h1")).alias("n_distinct"), "n_upper", "n_marks")

    def ratio(a: str, b: str, name: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")),
                          F.lit(0.0)).alias(name)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", ratio("word_chars", "n_words", "mean_word_chars"),
                    ratio("n_symbols", "word_chars", "symbol_ratio"),
                    ratio("n_dup_lines", "n_lines", "dup_line_ratio"),
                    ratio("n_repeat_words", "n_words", "repeat_ratio"),
                    ratio("n_distinct", "n_words", "distinct_ratio"),
                    ratio("n_upper", "word_chars", "upper_ratio"),
                    ratio("n_marks", "word_chars", "mark_ratio"),
                    ratio("n_words", "n_lines", "line_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` (above) or ``feature <= threshold``; ``bin`` is the threshold's
    place among the feature's thresholds."""
    feature: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.threshold if self.above else c <= self.threshold

    def binned(self) -> Column:
        c = F.col(f"bin_{self.feature}")
        return c > self.bin if self.above else c <= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Midpoints between neighbouring quantiles of either class, per feature."""
    q = [k / QUANTILES for k in range(QUANTILES + 1)]
    got = rows.groupBy("bad").agg(*[F.percentile_approx(f, F.array(*map(F.lit, q)), 10_000).alias(f)
                                    for f in FEATURES]).collect()
    out = {}
    for f in FEATURES:
        v = sorted({x for r in got for x in (r[f] or [])})
        out[f] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    return out


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def learn(features: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Rules for label 0, in order, from ``features`` (see ``measure``) and ``labels`` (doc_id,
    quality 0/1). Ids that are NULL or labelled both ways, and documents that fail the base rules,
    teach nothing; without rows of both classes there are no rules."""
    lab = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
           .agg(F.min("quality").alias("q0"), F.max("quality").alias("q1")).filter("q0 = q1"))
    rows = features.filter(~base_failed()).join(lab, "doc_id")
    rows = rows.select((F.col("q0") == 0).cast("int").alias("bad"),
                       (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
                       .alias("held"), *FEATURES)
    rows = write_once(rows, "labelled")
    cuts = _thresholds(rows)
    if not any(cuts.values()):
        return []
    bins = [F.size(F.filter(F.array(*[F.lit(t) for t in cuts[f]]) if cuts[f] else
                            F.expr("cast(array() as array<double>)"),
                            _below(f))).alias(f"bin_{f}") for f in FEATURES]
    rows = write_once(rows.select("bad", "held", *bins), "binned")
    stack = ", ".join(f"'{f}', bin_{f}" for f in FEATURES)

    def counts(d: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
        got = (d.select("bad", F.expr(f"stack({len(FEATURES)}, {stack}) as (f, b)"))
               .groupBy("f", "b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")))
        out: dict = {}
        for r in got.collect():
            out.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"])
        return out

    def grow(d: DataFrame) -> list[Condition]:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            table = counts(d)
            if not table:
                return rule
            p0, n0 = map(sum, zip(*next(iter(table.values())).values()))
            if not p0 or not n0:
                return rule
            best, gain = None, 0.0
            for f in FEATURES:
                p = n = 0
                for b, t in enumerate(cuts[f]):  # rows with bin <= b lie at or below threshold b
                    dp, dn = table[f].get(b, (0, 0))
                    p, n = p + dp, n + dn
                    for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                        g = _gain(p0, n0, x, y)
                        if g > gain + 1e-9:
                            best, gain = Condition(f, above, t, b), g
            if best is None:
                return rule
            rule.append(best)
            d = d.filter(best.binned())
        return rule

    def all_of(rule: list[Condition]) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & c.binned()
        return out

    def prune(d: DataFrame, rule: list[Condition]) -> tuple[list[Condition], int, int]:
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        got = d.agg(*[F.sum(F.when(all_of(h) & (F.col("bad") == y), 1).otherwise(0))
                      for h in heads for y in (1, 0)]).first()
        val = [(got[2 * k] or 0, got[2 * k + 1] or 0) for k in range(len(heads))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in val]
        k = max(range(len(heads)), key=lambda i: (round(worth[i], 6), -i))
        return heads[k], *val[k]

    rules: list[list[Condition]] = []
    left = rows
    while len(rules) < MAX_RULES:
        rule = grow(left.filter(~F.col("held")))
        if not rule:
            break
        rule, p, n = prune(left.filter("held"), rule)
        if p + n < MIN_COVER or p / (p + n) < MIN_PRECISION:
            break
        rules.append(rule)
        left = left.filter(~all_of(rule))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as an ordered conditional: the number of the first rule that holds (from
    1), 0 when none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, k) if out is None else out.when(cond, k)
    return F.lit(0) if out is None else out.otherwise(0)


def decide(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Measure every row of ``docs``, learn the list and apply it: the counts and ratios, ``rule``
    (0: none), base_failed and kept. Rows that repeat an id are each measured (and teach twice); a
    NULL id is measured and never taught from; empty tables give an empty result."""
    feats = write_once(measure(docs), "measures")
    rules = learn(feats, labels)
    return (feats.withColumn("rule", verdict(rules)).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
