"""Language identification by hierarchical discrimination: a linear classifier predicts the
language family, then one-versus-one linear support vector machines separate the languages within it.

Features: hashed one-, two- and three-character grams of the lower-cased letters of the whole text,
scaled to unit length. Training takes about ``rows_per_language`` labelled rows of each language (a
hash of the id decides, so the sample is the same on every run), deals them to ``shards`` Spark tasks
that run averaged sub-gradient steps on the hinge loss, and averages the weights. The model has
(families + language pairs) * 2**DIM_BITS weights and is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import U64, mix

DIM_BITS = 14
ROWS_PER_LANGUAGE = 1500
SHARDS = 6
EPOCHS = 4
SCHEMA = "lang_pred string, score double"
# fixed values: family of a language code; other codes are families of their own
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indo-aryan": "hi ur bn mr gu pa ne",
    "semitic": "ar he mt am",
    "celtic": "ga gd cy br",
}
_FAMILY_OF = {code: fam for fam, codes in FAMILIES.items() for code in codes.split()}
_NOT_LETTERS = regex.compile(r"\P{L}+")
_MUL = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), lang)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Indices and values of a text's grams; None without letters."""
    clean = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not clean:
        return None
    c = np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = c.astype(U64)
    acc = c * _MUL[0]
    keys = [acc]
    for k in (1, 2):
        acc = acc[:-1] * _MUL[k] + c[k:] * _MUL[0]
        keys.append(acc)
    x = np.bincount((mix(np.concatenate(keys)) >> U64(64 - DIM_BITS)).astype(np.int64),
                    minlength=1 << DIM_BITS)
    i = np.flatnonzero(x)
    v = np.sqrt(x[i])
    return i, v / np.sqrt(v @ v)


@dataclass
class Model:
    """Weights per family, and per pair of languages of one family (positive: the first)."""
    langs: list[str] = field(default_factory=list)
    families: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 1 << DIM_BITS), np.float32))

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.langs:
            return "und", 0.0
        m = self.weights[:, x[0]] @ x[1] * 4.0
        fam, p = self.families[0], 1.0
        if len(self.families) > 1:
            e = np.exp(m[:len(self.families)] - m[:len(self.families)].max())
            k = int(e.argmax())
            fam, p = self.families[k], float(e[k] / e.sum())
        mine = [x for x in self.langs if family_of(x) == fam]
        if len(mine) == 1:
            return mine[0], p
        win = dict.fromkeys(mine, 0.0)
        for k, (a, b) in enumerate(self.pairs, len(self.families)):
            if a in win and b in win:
                first = 1 / (1 + np.exp(-m[k]))
                win[a] += first
                win[b] += 1 - first
        best = max(mine, key=lambda x: (win[x], x))
        return best, float(p * win[best] / (len(mine) - 1))


def _svm(x: list, y: np.ndarray, epochs: int = EPOCHS, lam: float = 1e-4) -> np.ndarray:
    """Averaged Pegasos: hinge loss, labels +1 / -1 weighted to equal class mass."""
    w = np.zeros(1 << DIM_BITS)
    total = np.zeros(1 << DIM_BITS)
    pos, neg = max(1, (y > 0).sum()), max(1, (y < 0).sum())
    weight = np.where(y > 0, len(y) / 2 / pos, len(y) / 2 / neg)
    t, kept = 0, 0
    for e in range(epochs):
        order = np.argsort(mix(np.arange(len(y), dtype=U64) + U64(1 + e * 1_000_003)))
        for k in order:
            i, v = x[k]
            t += 1
            if y[k] * (w[i] @ v) < 1:
                w[i] += y[k] * min(weight[k], 10.0) * v / np.sqrt(1 + lam * t) * 0.2
        total += w
        kept += 1
    return total / max(1, kept)


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, shards: int = SHARDS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang). Rows with a NULL lang, and texts without letters,
    teach nothing; no rows give a model that answers ``und``."""
    d = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = d.groupBy("lang").agg(F.count(F.lit(1)).alias("c"))
    part = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 40)) / float(1 << 40)
    rows = d.join(F.broadcast(sizes.filter("c > 0")), "lang").filter(
        part * F.col("c") <= float(rows_per_language))
    langs = sorted(r["lang"] for r in sizes.collect())
    if not langs:
        return Model()
    families = sorted({family_of(x) for x in langs})
    pairs = [p for p in combinations(langs, 2) if family_of(p[0]) == family_of(p[1])]

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "lang"], kind="stable")
        got = [(features(t), x) for t, x in zip(pdf["text"], pdf["lang"])]
        got = [g for g in got if g[0] is not None]
        x, lang = [g[0] for g in got], np.array([g[1] for g in got], dtype=object)
        fam = np.array([family_of(v) for v in lang], dtype=object)
        out = []
        for k in range(len(families) + len(pairs)):
            if k < len(families):
                use = np.arange(len(x))
                y = np.where(fam == families[k], 1.0, -1.0)
            else:
                a, b = pairs[k - len(families)]
                use = np.flatnonzero((lang == a) | (lang == b))
                y = np.where(lang[use] == a, 1.0, -1.0)
            if len(use) and len(set(y)) > 1:
                w = _svm([x[i] for i in use], y)
                i = np.flatnonzero(w)
                out.append(pd.DataFrame({"m": k, "i": i, "w": w[i]}))
        if not out:
            return pd.DataFrame({"m": [], "i": [], "w": []}).astype({"m": int, "i": int})
        return pd.concat(out)

    parts = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))
    parts = parts.groupBy("shard").applyInPandas(train, "m bigint, i bigint, w double")
    w = parts.groupBy("m", "i").agg((F.sum("w") / shards).alias("w")).toPandas()
    weights = np.zeros((len(families) + len(pairs), 1 << DIM_BITS), dtype=np.float32)
    weights[w["m"].to_numpy(dtype=int), w["i"].to_numpy(dtype=int)] = w["w"].to_numpy(dtype=float)
    return Model(langs, families, pairs, weights)


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct(lang_pred, score) as a column on ``docs``: ``und`` and 0 for a NULL text or one
    without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCHEMA)
    def identify(s: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in s], columns=["lang_pred", "score"])

    return identify(F.col(text))
