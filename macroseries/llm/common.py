"""Helpers shared by the training-data operators: inputs, tables written once, row numbers
without a single-task window, and hashing of a text's tokens with numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macroseries.session import scratch_path

U64 = np.uint64
CHUNK_BYTES = 1 << 20
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: what several
    branches read is computed once, columns still prune, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict = {}


def held_by_worker(make, *args):
    """``make(*args)``, kept in a Python worker for the tasks that follow. A worker outlives a job's
    stages, so it keeps one such object: what an earlier stage's operator left goes first."""
    key = (make, args)
    if key not in _held:
        _held.clear()
        _held[key] = make(*args)
    return _held[key]


def crc_mod3(doc_id: str) -> Column:
    """crc32 of the id as text, mod 3 (NULL for a NULL id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str,
                buckets: int = 256) -> DataFrame:
    """Number the rows of each key from 0 without gaps. A key's rows are dealt to ``buckets`` by
    the hash of ``order``, numbered there, and shifted by the sizes of the buckets before, so that
    a hot key is never sorted in one task. Rows equal in ``order`` get numbers in any order."""
    b = free_name(df, "bucket")
    base = free_name(df, "base")
    cnt = free_name(df, "cnt")
    d = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = d.groupBy(*keys, b).agg(F.count(F.lit(1)).alias(cnt))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, b, F.coalesce(F.sum(cnt).over(before), F.lit(0)).alias(base))
    rank = F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order)).cast("long") - 1
    return (d.withColumn(out, rank).join(sizes, [*keys, b])
            .withColumn(out, F.col(out) + F.col(base)).drop(b, base))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = np.array(x, dtype=U64)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(29)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(32)
    return x


def byte_classes(*groups: bytes, rest: int = 0) -> np.ndarray:
    """Class of each byte value: 0 for white space, i for the i-th group, ``rest`` for others."""
    t = np.full(256, rest, dtype=np.uint8)
    for i, g in enumerate(groups, 1):
        t[list(g)] = i
    t[list(SPACE_BYTES)] = 0
    return t


WORD_CLASSES = byte_classes(rest=1)
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: runs of letters (ASCII letters and the bytes of all other characters), digits, punctuation
RUN_CLASSES = byte_classes(LETTERS, b"0123456789", rest=3)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_pow = np.ones(1, dtype=U64)
_inv = np.ones(1, dtype=U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _pow, _inv
    while len(_pow) < n:
        k = len(_pow)
        step, back = pow(_BASE, k, 1 << 64), pow(pow(_BASE, -1, 1 << 64), k, 1 << 64)
        _pow = np.concatenate([_pow, _pow * U64(step)])
        _inv = np.concatenate([_inv, _inv * U64(back)])
    return _pow, _inv


def token_hashes(texts: list, classes: np.ndarray = WORD_CLASSES, fold: bool = True):
    """Yield, per text, the 64-bit hashes of its tokens in order (None: no tokens).

    A token is a maximal run of bytes of one non-zero class; ``fold`` lower-cases A-Z. Texts are
    hashed about a megabyte at a time, so memory is bounded by that and the longest text."""
    batch: list[bytes] = []
    size = 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass")
        batch.append(b)
        size += len(b)
        if size >= CHUNK_BYTES:
            yield from _hash_batch(batch, classes, fold)
            batch, size = [], 0
    if batch:
        yield from _hash_batch(batch, classes, fold)


def _hash_batch(batch: list[bytes], classes: np.ndarray, fold: bool):
    data = np.frombuffer(b" " + b" ".join(batch) + b" ", dtype=np.uint8)
    cls = classes[data]
    if fold:
        data = FOLD[data]
    edges = np.flatnonzero(cls[1:] != cls[:-1]) + 1
    kind = cls[edges]
    start = edges[kind != 0]
    end = np.append(edges[1:], len(data))[kind != 0]
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:len(data)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))
    doc_start = np.cumsum([1] + [len(b) + 1 for b in batch])
    cut = np.searchsorted(start, doc_start)
    for i in range(len(batch)):
        yield h[cut[i]:cut[i + 1]]


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's ``width``-word shingles; a shorter text is one shingle."""
    if len(h) == 0:
        return h
    width = min(width, len(h))
    n = len(h) - width + 1
    acc = np.full(n, U64(width), dtype=U64)
    for k in range(width):
        acc = acc * U64(0x9FB21C651E98DF25) + h[k:k + n]
    return np.unique(mix(acc))
