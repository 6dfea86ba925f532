"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot products.

Tokens are runs of letters, digits or punctuation; features are hashed one- and two-token n-grams
(a token that repeats its predecessor is one feature of its own, whatever the token), counted over
the whole text and scaled to unit length, and a constant.

Training: at most ``sample_rows`` labelled rows (the smallest hashes of the id), dealt to shards of
about ``rows_per_shard``; each shard runs FTRL in a Spark task and the weights are averaged by rows.
The model is bounded by 2**DIM_BITS weights, so it is collected and broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import RUN_CLASSES, U64, mix, token_hashes

DIM_BITS = 18
SAMPLE_ROWS = 20_000
ROWS_PER_SHARD = 2_500
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
_SAME = 1


def features(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature indices of a text's token hashes, and their values (index 0: constant)."""
    if len(h) == 0:
        return np.zeros(1, dtype=np.int64), np.ones(1)
    shift = U64(64 - DIM_BITS)
    two = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:]) >> shift
    two[h[:-1] == h[1:]] = _SAME
    idx, cnt = np.unique(np.concatenate([h >> shift, two]), return_counts=True)
    val = cnt / np.sqrt(np.dot(cnt, cnt))
    return np.concatenate([[0], idx.astype(np.int64)]), np.concatenate([[1.0], val])


def ftrl(rows: list, labels: list, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal logistic regression."""
    z = np.zeros(1 << DIM_BITS)
    n = np.zeros(1 << DIM_BITS)

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0,
                        -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for (i, v), y in zip(rows, labels):
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ v, -35, 35))) - y) * v
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(1 << DIM_BITS))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
        rows_per_shard: int = ROWS_PER_SHARD) -> np.ndarray:
    """Train on ``labels`` (doc_id, quality 0/1) joined to ``docs`` (doc_id, text). Rows with a
    NULL id or label and ids labelled both ways are left out; no rows give zero weights."""
    lab = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
           .agg(F.min("quality").alias("y"), F.max("quality").alias("y1")).filter("y = y1"))
    lab = lab.select("doc_id", "y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    shards = max(1, -(-lab.count() // rows_per_shard))
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(mix(pdf["doc_id"].to_numpy().astype(np.int64).view(U64)), kind="stable")
        pdf = pdf.iloc[order]
        x = [features(h) for h in token_hashes(pdf["text"].tolist(), RUN_CLASSES, fold=False)]
        w = ftrl(x, pdf["y"].tolist())
        i = np.flatnonzero(w)
        # the row after the last feature counts the shard's rows
        return pd.DataFrame({"i": np.append(i, len(w)), "w": np.append(w[i], 1.0) * len(pdf)})

    parts = rows.groupBy("shard").applyInPandas(train, "i bigint, w double")
    got = parts.groupBy("i").agg(F.sum("w").alias("w")).toPandas()
    weights = np.zeros((1 << DIM_BITS) + 1)
    weights[got["i"].to_numpy(dtype=np.int64)] = got["w"].to_numpy(dtype=float)
    return weights[:-1] / max(1.0, weights[-1])


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """Probability of label 1 as a column on ``docs`` (NULL and empty text: the constant's)."""
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def logistic(s: pd.Series) -> pd.Series:
        w = model.value
        out = np.empty(len(s))
        for k, h in enumerate(token_hashes(s.tolist(), RUN_CLASSES, fold=False)):
            i, v = features(h)
            out[k] = w[i] @ v
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return logistic(F.coalesce(F.col(text), F.lit("")))
