"""Cross-entropy difference scoring: two n-gram models of equal order and smoothing, one of a target
corpus and one of the background corpus, over one vocabulary. A document's score is the mean over its
tokens of target loss minus background loss; lower means closer to the target.

Tokens are the characters of the lower-cased text (white space runs are one space), so no word is out
of vocabulary; the vocabulary is every character of the background, up to 65,534 (the rarest beyond
that share one id). Models are of order 4 with Witten-Bell smoothing down to the uniform
distribution. Counts cover every document: tasks send one row per distinct 4-gram, and the lower
orders are sums of it. The model's size is measured; it goes out in blocks of at most
``BLOCK`` 4-grams, and documents carry their partial sums from block to block.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import U64, write_once

ORDER = 4
VOCABULARY = 65_534
BLOCK = 2_000_000
CHUNK = 1 << 20
START, RARE = 0, 1
_SPACE = re.compile(r"\s+")


def characters(text: str | None) -> np.ndarray:
    t = _SPACE.sub(" ", (text or "").lower()).strip()
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def vocabulary(texts: DataFrame) -> np.ndarray:
    """Code points of ``texts`` (text), sorted; id = position + 2 (0: start, 1: rare)."""
    def run(batches):
        for b in batches:
            seen = np.zeros(0x110000, dtype=np.int64)
            for t in b["text"]:
                c = characters(t)
                if len(c) > 4096:
                    seen += np.bincount(c, minlength=0x110000)
                else:
                    np.add.at(seen, c, 1)
            k = np.flatnonzero(seen)
            yield pd.DataFrame({"c": k, "n": seen[k]})
    got = texts.select("text").mapInPandas(run, "c bigint, n bigint")
    top = got.groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(VOCABULARY)
    return np.sort(np.array([r["c"] for r in top.select("c").collect()], dtype=np.uint32))


def _grams(text: str | None, ids: np.ndarray) -> np.ndarray:
    """The key of each character's 4-gram: three ids before it (``START`` before the text), its own."""
    c = characters(text)
    x = np.zeros(len(c) + ORDER - 1, dtype=U64)
    x[ORDER - 1:] = ids[c]
    key = np.zeros(len(c), dtype=U64)
    for k in range(ORDER):
        key = (key << U64(16)) | x[k:k + len(c)]
    return key


def _ids(vocab: np.ndarray) -> np.ndarray:
    ids = np.full(0x110000, RARE, dtype=np.uint16)
    ids[vocab] = np.arange(len(vocab), dtype=np.uint16) + 2
    return ids


def counts(docs: DataFrame, vocab: np.ndarray) -> DataFrame:
    """(key, background, target) over ``docs`` (text, is_target): one row per 4-gram."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        ids = _ids(shared.value)
        for b in batches:
            parts, marks, size = [], [], 0
            for k, (text, target) in enumerate(zip(b["text"], b["is_target"]), 1):
                g = _grams(text, ids)
                parts.append(g)
                marks.append(np.full(len(g), bool(target)))
                size += len(g)
                if size >= CHUNK or k == len(b):
                    key, inv = np.unique(np.concatenate(parts), return_inverse=True)
                    mark = np.concatenate(marks)
                    yield pd.DataFrame({
                        "key": key.view(np.int64), "background": np.bincount(
                            inv, minlength=len(key)).astype(np.int64),
                        "target": np.bincount(inv[mark], minlength=len(key)).astype(np.int64)})
                    parts, marks, size = [], [], 0
    got = docs.select("text", "is_target").mapInPandas(
        run, "key bigint, background bigint, target bigint")
    return got.groupBy("key").agg(F.sum("background").alias("background"),
                                  F.sum("target").alias("target"))


def estimate(grams: DataFrame, n_vocab: int) -> DataFrame:
    """(key, target_loss, background_loss) in bits per 4-gram of ``grams``."""
    lower = grams
    prob = None
    sides = ("background", "target")
    tables = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):
        lower = lower.groupBy(F.col("key").bitwiseAND(F.lit((1 << (16 * n)) - 1)).alias("key")).agg(
            *[F.sum(s).alias(s) for s in sides])
        tables[n] = write_once(lower, "grams")
        lower = tables[n]
    for n in range(1, ORDER + 1):
        t = tables[n].withColumn("context", F.shiftrightunsigned("key", 16))
        ctx = t.groupBy("context").agg(
            *[F.sum(s).alias(f"sum_{s}") for s in sides],
            *[F.count(F.when(F.col(s) > 0, 1)).alias(f"kinds_{s}") for s in sides])
        t = t.join(ctx, "context")
        if prob is None:
            t = t.withColumn("p_background", F.lit(1.0 / n_vocab)).withColumn(
                "p_target", F.lit(1.0 / n_vocab))
        else:
            t = t.withColumn("tail", F.col("key").bitwiseAND(F.lit((1 << (16 * (n - 1))) - 1)))
            t = t.join(prob.withColumnRenamed("key", "tail"), "tail")
        t = t.select("key", *[((F.col(s) + F.col(f"kinds_{s}") * F.col(f"p_{s}")) / (
            F.col(f"sum_{s}") + F.col(f"kinds_{s}"))).alias(f"q_{s}") for s in sides],
            *[F.col(f"p_{s}") for s in sides], *[F.col(f"sum_{s}") for s in sides])
        # a context the corpus never shows says nothing: keep the lower order
        prob = t.select("key", *[F.when(F.col(f"sum_{s}") > 0, F.col(f"q_{s}")).otherwise(
            F.col(f"p_{s}")).alias(f"p_{s}") for s in sides])
        if n < ORDER:
            prob = write_once(prob, "probabilities")
    return prob.select("key", (-F.log2("p_target")).alias("target_loss"),
                       (-F.log2("p_background")).alias("background_loss"))


def score(docs: DataFrame, model: DataFrame, vocab: np.ndarray, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens, xent_target, xent_background and score of every row of ``docs`` (doc_id,
    text). A 4-gram that the background lacks costs log2 of the vocabulary in both models. A text
    without characters has 0 tokens and NULL losses."""
    spark = docs.sparkSession
    size = model.count()
    blocks = max(1, -(-size // block))
    ids = spark.sparkContext.broadcast(vocab)
    none = float(np.log2(len(vocab) + 1))
    schema = ("doc_id bigint, text string, n_tokens bigint, found bigint, t double, b double")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("found"),
                      F.lit(0.0).alias("t"), F.lit(0.0).alias("b"))
    for k in range(blocks):
        part = model.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k).toPandas()
        key = part["key"].to_numpy(dtype=np.int64).view(U64)
        o = np.argsort(key)
        shared = spark.sparkContext.broadcast(
            (key[o], part["target_loss"].to_numpy(dtype=np.float32)[o],
             part["background_loss"].to_numpy(dtype=np.float32)[o]))
        last = k == blocks - 1

        def run(batches, shared=shared, last=last):
            own = _ids(ids.value)
            want, lt, lb = shared.value
            for batch in batches:
                n, found, t, b = (batch[c].to_numpy(copy=True)
                                  for c in ("n_tokens", "found", "t", "b"))
                for i, text in enumerate(batch["text"]):
                    g, c = np.unique(_grams(text, own), return_counts=True)
                    n[i] = c.sum()
                    if len(want) and len(g):
                        at = np.minimum(np.searchsorted(want, g), len(want) - 1)
                        hit = want[at] == g
                        found[i] += c[hit].sum()
                        t[i] += float(c[hit] @ lt[at[hit]].astype(float))
                        b[i] += float(c[hit] @ lb[at[hit]].astype(float))
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                    "text": None if last else batch["text"],
                                    "n_tokens": n, "found": found, "t": t, "b": b})
        out = out.mapInPandas(run, schema)
    missing = (F.col("n_tokens") - F.col("found")) * none

    def mean(c: str) -> Column:
        return F.when(F.col("n_tokens") > 0, (F.col(c) + missing) / F.col("n_tokens"))
    out = out.select("doc_id", "n_tokens", mean("t").alias("xent_target"),
                     mean("b").alias("xent_background"))
    return out.withColumn("score", F.col("xent_target") - F.col("xent_background"))


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by the difference of cross-entropies under models
    of the documents named in ``target_ids`` (doc_id) and of all documents.

    NULL ids are never targets; rows that repeat a document count each; NULL and empty texts add
    nothing and get NULL losses; empty tables give an empty result."""
    ids = target_ids.select(F.col("doc_id").alias("tid")).filter("tid IS NOT NULL").distinct()
    # a merge join at every size: the ids grow with the corpus, so they are never broadcast
    marked = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id") == F.col("tid"),
                                                "left")
    marked = marked.select("text", F.col("tid").isNotNull().alias("is_target"))
    vocab = vocabulary(docs)
    grams = write_once(counts(marked, vocab), "grams")
    model = write_once(estimate(grams, len(vocab) + 1), "model")
    return score(docs, model, vocab)
