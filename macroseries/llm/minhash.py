"""Near-duplicate components by b-bit MinHash.

Per document: the set of its word shingles, ``bands * rows`` minima under multiply-xor hashes, one
64-bit key per band of ``rows`` minima, and a packed signature of the ``BITS`` low bits of each
(remixed) minimum. Documents with equal sets are one class, named by the smallest id. Classes that
share a band key are candidates; the signatures' bit counts estimate their similarity, corrected
for chance agreement of the kept bits; candidates near the threshold are confirmed on full sets.

No bucket is expanded into all of its pairs. Each bucket first compares its members with three
leaders (the member with most bucket mates, and two drawn by hash). The links found give components,
and only buckets that still hold several components are looked at again: members with too many rare
shingles to reach the threshold leave first, then members of different components are compared, and
members that share rare shingles are found by these. That second pass is exact: every pair that
shares a bucket is in one component, or excluded by a bound, or was estimated. What the method can miss is a pair that shares
no band (5e-6 at similarity 0.8 with 40 bands of 6) or whose estimate is far too low (margin 5
standard errors).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import U64, mix, shingles, token_hashes, write_once

BANDS, ROWS, BITS = 40, 6, 2
MARGIN = 0.15
RARE = 128
_MINIMA = BANDS * ROWS
_PER_LONG = 64 // BITS
_LONGS = -(-_MINIMA // _PER_LONG)


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    r = mix(np.arange(1, 2 * _MINIMA + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return (r[:_MINIMA].astype(np.uint32) | np.uint32(1))[:, None], (
        r[_MINIMA:] >> U64(32)).astype(np.uint32)[:, None]


_MUL, _XOR = _hash_family()
_ODD = mix(np.arange(1, ROWS + 1, dtype=U64)) | U64(1)
_BAND = mix(np.arange(101, 101 + BANDS, dtype=U64))


def _minima(s: np.ndarray) -> np.ndarray:
    x = (s >> U64(32)).astype(np.uint32)
    m = np.full(_MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(m, ((x[None, i:i + 1024] ^ _XOR) * _MUL).min(axis=1), out=m)
    return m


def _band_keys(m: np.ndarray) -> np.ndarray:
    return mix((m.reshape(BANDS, ROWS).astype(U64) * _ODD).sum(axis=1, dtype=U64) + _BAND)


def _signature(m: np.ndarray) -> np.ndarray:
    r = m ^ (m >> np.uint32(16))
    r = r * np.uint32(0x7FEB352D)
    r ^= r >> np.uint32(15)
    low = np.zeros(_LONGS * _PER_LONG, dtype=U64)
    low[:_MINIMA] = r & np.uint32((1 << BITS) - 1)
    shift = np.arange(_PER_LONG, dtype=U64) * U64(BITS)
    return (low.reshape(_LONGS, _PER_LONG) << shift).sum(axis=1, dtype=U64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    a = int(mix(s).sum(dtype=U64)) if len(s) else 0
    b = int(mix(s ^ U64(0xA5A5A5A55A5A5A5A)).sum(dtype=U64)) if len(s) else 0
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def _longs(rows: list[np.ndarray], width: int | None = None) -> pa.Array:
    """An Arrow list<int64> of the given uint64 rows."""
    off = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=off[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=U64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(U64).view(np.int64)))


SIGNATURE_SCHEMA = ("doc_id bigint, text_hash bigint, n_shingles bigint, set_a bigint, "
                    "set_b bigint, bands array<bigint>, sig array<bigint>")
SET_SCHEMA = "doc_id bigint, set_a bigint, set_b bigint, shingle_set array<bigint>"
NONE = np.zeros(0, dtype=U64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: set size, 128-bit set digest, band keys and packed signature."""
    def run(batches):
        for b in batches:
            n, da, db, bands, sigs = [], [], [], [], []
            for h in token_hashes(b.column("text").to_pylist()):
                s = shingles(h, width)
                a, c = _digest(s)
                n.append(len(s))
                da.append(a)
                db.append(c)
                m = _minima(s) if len(s) else None
                bands.append(NONE if m is None else _band_keys(m))
                sigs.append(NONE if m is None else _signature(m))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()),
                 pa.array(da, pa.int64()), pa.array(db, pa.int64()), _longs(bands), _longs(sigs)],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "sig"])
    return _texts(docs).mapInArrow(run, SIGNATURE_SCHEMA)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                       F.xxhash64("text").alias("text_hash"))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for b in batches:
            sets, da, db = [], [], []
            for h in token_hashes(b.column("text").to_pylist()):
                s = shingles(h, width)
                a, c = _digest(s)
                sets.append(s)
                da.append(a)
                db.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(da, pa.int64()), pa.array(db, pa.int64()),
                 _longs(sets)], names=["doc_id", "set_a", "set_b", "shingle_set"])
    return docs.select("doc_id", "text").mapInArrow(run, SET_SCHEMA)


def estimate(a: str, b: str):
    """Similarity from two packed signatures: bit counts give the share of agreeing minima, from
    which agreement by chance (2**-BITS) is taken out."""
    mask = int("1".rjust(BITS, "0") * _PER_LONG, 2)
    miss = F.lit(0)
    for i in range(_LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        k = 1
        while k < BITS:
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
            k *= 2
        miss = miss + F.bit_count(x.bitwiseAND(F.lit(mask - (1 << 64) * (mask >> 63))))
    chance = 2.0 ** -BITS
    return ((_MINIMA - miss) / F.lit(float(_MINIMA)) - chance) / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest reachable
    node. Alternating star contractions, each round written to the shared folder."""
    e = write_once(edges.filter("a <> b").select(F.least("a", "b").alias("a"),
                                                 F.greatest("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("m").alias("a"),
                                                            F.col("v").alias("b")).distinct())
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(least, "b").filter("a <> m")
                 .select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionByName(least.select(F.col("m").alias("a"), "b")).distinct())
        e = write_once(small, "cc")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose sets of ``width``-word shingles have
    ``100 * intersection >= percent * union`` and return one row per row of ``docs`` (doc_id, text):
    doc_id, n_shingles, component_id (smallest linked id, itself included), kept, text_hash.

    Empty and NULL texts have an empty set and are linked with nothing; a NULL doc_id is linked
    with nothing and kept. Rows that repeat an id and a text each get their (equal) row. An empty
    table gives an empty result. Extra columns are ignored."""
    sig = write_once(signatures(docs, width), "minhash")
    real = sig.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = write_once(
        real.groupBy("set_a", "set_b", F.col("n_shingles").alias("n"))
        .agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "sig"), "doc_id").alias("v"))
        .select("set_a", "set_b", "n", "rep", "v.bands", "v.sig"), "classes")

    member = classes.select("rep", "n", F.explode("bands").alias("key"))
    mates = member.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).filter("mates > 1")
    member = write_once(member.join(mates, "key"), "buckets")
    body = write_once(_bodies(docs, classes, member, width), "sets")

    degree = member.groupBy("rep").agg(F.sum(F.col("mates") - 1).alias("deg"))
    leaders = member.join(degree, "rep").groupBy("key").agg(
        F.array_distinct(F.array(
            -F.max(F.struct("deg", (-F.col("rep")).alias("r")))["r"],
            F.min(F.struct(F.xxhash64(F.lit(1), "rep"), "rep"))["rep"],
            F.min(F.struct(F.xxhash64(F.lit(2), "rep"), "rep"))["rep"])).alias("leaders"))
    pairs = (member.join(leaders, "key").select("rep", F.explode("leaders").alias("l"))
             .filter("rep <> l").select(F.least("rep", "l").alias("a"),
                                        F.greatest("rep", "l").alias("b")).distinct())
    links = write_once(_confirm(pairs, body, percent), "links")
    comp = write_once(components(links), "components")

    rest = _open_pairs(member, body, comp, percent)
    more = write_once(_confirm(rest, body, percent), "links")
    if not more.isEmpty():
        stars = comp.select(F.col("component").alias("a"), F.col("node").alias("b"))
        comp = write_once(components(stars.unionByName(more)), "components")

    named = classes.select("set_a", "set_b", F.col("n").alias("n_shingles"), "rep")
    named = named.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_a", "set_b", "n_shingles",
                         F.coalesce("component", "rep").alias("class_component"))
    out = sig.select("doc_id", "text_hash", "set_a", "set_b", "n_shingles")
    out = out.join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")


def _bodies(docs: DataFrame, classes: DataFrame, member: DataFrame, width: int) -> DataFrame:
    """rep, n, sig and full set of every class in a bucket with others."""
    reps = classes.join(member.select("rep").distinct(), "rep", "left_semi")
    ids = reps.select(F.col("rep").alias("doc_id"))
    sets = _sets(_texts(docs).join(ids, "doc_id", "left_semi"), width)
    sets = sets.withColumnRenamed("doc_id", "rep")
    return (reps.join(sets, ["rep", "set_a", "set_b"]).select("rep", "n", "sig", "shingle_set")
            .groupBy("rep").agg(F.first("n").alias("n"), F.first("sig").alias("sig"),
                                F.first("shingle_set").alias("shingle_set")))


def _confirm(pairs: DataFrame, body: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate is near the threshold and whose full sets reach it."""
    def side(c: str, col: str) -> DataFrame:
        return body.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"),
                           F.col(col).alias(f"v_{c}"))
    near = (pairs.join(side("a", "sig"), "a").join(side("b", "sig"), "b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .filter(estimate("v_a", "v_b") >= percent / 100 - MARGIN).select("a", "b"))
    full = near.join(side("a", "shingle_set"), "a").join(side("b", "shingle_set"), "b")
    both = F.size(F.array_intersect("v_a", "v_b"))
    return (full.withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both")))
            .select("a", "b"))


def _open_pairs(member: DataFrame, body: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and may reach the threshold.

    A shingle is rare when at most ``RARE`` open classes hold it. Two classes without a common rare
    shingle have at most ``min(n - rare)`` shingles in common, which excludes most members of a
    bucket before it is joined with itself; classes with ``s`` common rare shingles are found
    by joining on those, at most ``RARE`` classes each, and have at most that plus ``s``."""
    m = member.select("key", "rep", "n").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    m = m.select("key", "rep", "n", F.coalesce("component", "rep").alias("comp"))

    def several(x: DataFrame) -> DataFrame:
        k = (x.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                  F.min("n").alias("n_min"))
             .filter("c0 <> c1").select("key", "n_min"))
        return x.join(k, "key")

    m = write_once(several(m), "open")
    ids = m.select("rep", "n", "comp").distinct()
    tok = body.select("rep", F.explode("shingle_set").alias("s")).join(
        ids.select("rep"), "rep", "left_semi")
    few = tok.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") <= RARE)
    rare = write_once(tok.join(few, "s"), "rare")
    ids = ids.join(rare.groupBy("rep").agg(F.count(F.lit(1)).alias("rare")), "rep", "left")
    ids = ids.withColumn("rare", F.coalesce("rare", F.lit(0)))
    ids = write_once(ids.withColumn("r", F.col("n") - F.col("rare")), "open-ids")

    def side(x: DataFrame, c: str, keys: list[str]) -> DataFrame:
        return x.select(*keys, *[F.col(v).alias(f"{v}_{c}") for v in ("rep", "n", "comp", "r")])

    def possible(shared):
        i = F.least("r_a", "r_b") + shared
        return (F.col("comp_a") != F.col("comp_b")) & (
            100 * i >= percent * (F.col("n_a") + F.col("n_b") - i))

    m = m.join(ids.select("rep", "rare", "r"), "rep")
    m = m.filter(100 * F.col("r") >= percent * (F.greatest("n_min", "r") + F.col("rare")))
    m = write_once(several(m.select("key", "rep", "n", "comp", "r")).drop("n_min"), "open")
    a, b = side(m, "a", ["key"]), side(m, "b", ["key"])
    plain = a.join(b, (a["key"] == b["key"]) & (F.col("rep_a") < F.col("rep_b"))
                   & possible(F.lit(0)))

    few = rare.filter("df > 1").select("s", "rep").join(ids, "rep")
    x, y = side(few, "a", ["s", "rare"]), side(few, "b", ["s", F.col("rare").alias("rare_b")])
    both = x.join(y, (x["s"] == y["s"]) & (F.col("rep_a") < F.col("rep_b"))
                  & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                  & possible(F.least("rare", "rare_b")))
    both = both.groupBy("rep_a", "rep_b", "n_a", "n_b", "comp_a", "comp_b", "r_a", "r_b").agg(
        F.count(F.lit(1)).alias("shared")).filter(possible(F.col("shared")))
    return plain.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).unionByName(
        both.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))).distinct()
