"""Embedding whitening by bit-sliced scatter.

Entries become integers. The integers of some thousand rows are shifted to start at 0 per dimension
and cut into bit planes: one bit per row, packed into 64-bit words. The sum of products of two
dimensions is the sum over pairs of their planes of ``2**(p + q)`` times the set bits that the two
planes share (AND, then popcount), so it is exact. Sums of all rows are added in Spark as 32-bit limbs,
centred as integers of any size at the driver (one number per pair of dimensions, whatever the number
of rows), and only the finished covariance becomes floating point for ``eigh``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
MAX_COMPONENTS = 8
#: Rows whose planes are packed together: planes of 64 dimensions then fit a core's cache.
PLANE_ROWS = 4096
#: Entries whose integer would not be exact as a double are no numbers here.
LARGEST = 1 << 52
LIMBS, LIMB_BITS = 5, 32
#: An eigenvalue below this share of the largest is zero but for rounding.
ZERO = 1e-12
OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
       "explained double, identity_error double")


def integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that can be used, and their entries as ``floor(SCALE * c)``.

    Used are vectors of ``dim`` entries, all of them finite numbers below ``LARGEST`` in size."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
                          .to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * x)
        good = (np.abs(x) < LARGEST).all(axis=1)
    return rows[good], x[good].astype(np.int64)


def scatter(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and sums of products of the columns of an integer matrix, by bit planes."""
    n, dim = z.shape
    low = z.min(axis=0)
    y = (z - low).astype(np.uint64)
    wide = int(np.abs(z).max()) >= 1 << 24
    kind = object if wide else np.int64
    bits = [int(v).bit_length() for v in y.max(axis=0)]
    owner = np.repeat(np.arange(dim), bits)
    place = np.concatenate([np.arange(b) for b in bits]).astype(np.int64)
    words = -(-n // 64)
    planes = np.zeros((len(owner), 8 * words), dtype=np.uint8)
    for k, (d, p) in enumerate(zip(owner.tolist(), place.tolist())):
        bit = ((y[:, d] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bit)
        planes[k, :len(packed)] = packed
    planes = planes.view(np.uint64)
    product = np.zeros((dim, dim), dtype=kind)
    total = np.zeros(dim, dtype=kind)
    first = np.cumsum([0, *bits])
    weight = np.array([1 << int(p) for p in place], dtype=kind)
    live = [d for d in range(dim) if bits[d]]
    starts = first[live]
    for k in range(len(owner)):
        d = int(owner[k])
        base = int(first[d])
        shared = np.bitwise_count(planes[base:] & planes[k]).sum(axis=1, dtype=np.int64)
        shared = shared.astype(kind) * weight[base:] * weight[k]
        later = live.index(d)
        product[d, live[later:]] += np.add.reduceat(shared, starts[later:] - base)
        total[d] += int(shared[k - base]) // int(weight[k])
    product = np.triu(product) + np.triu(product, 1).T
    m = low.astype(kind)
    return (total + n * m,
            product + np.outer(m, total) + np.outer(total, m) + n * np.outer(m, m))


def _limbs(values: list[int]) -> np.ndarray:
    """Two's-complement limbs of integers: LIMBS x len(values), all but the last non-negative."""
    out = np.zeros((LIMBS, len(values)), dtype=np.int64)
    mask = (1 << LIMB_BITS) - 1
    for j in range(LIMBS - 1):
        out[j] = [(v >> (j * LIMB_BITS)) & mask for v in values]
    out[LIMBS - 1] = [v >> ((LIMBS - 1) * LIMB_BITS) for v in values]
    return out


@dataclass
class Whitening:
    """Fitted on ``n`` vectors: integer ``sums`` per dimension (of floor(SCALE * c)), eigenvalues
    (falling), unit components (columns), and the trace of the covariance."""
    n: int
    dim: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent vector length (of a tie, the longest); 0 without vectors."""
    size = F.size(column)
    got = (vectors.filter(F.col(column).isNotNull() & (size > 0)).groupBy(size.alias("d"))
           .agg(F.count(F.lit(1)).alias("c")).agg(F.max(F.struct("c", "d")).alias("m")).first()["m"])
    return int(got["d"]) if got else 0


def _moments(vectors: DataFrame, column: str, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Number of used vectors, sums, and sums of products as Python integers (dim x dim)."""
    row, col = np.triu_indices(dim)
    place = np.concatenate([[-1], np.arange(dim), dim + np.arange(len(row))])

    def run(batches):
        total = np.zeros((LIMBS, 1 + dim + len(row)), dtype=np.int64)
        for b in batches:
            _, z = integers(b.column(0), dim)
            for at in range(0, len(z), PLANE_ROWS):
                part = z[at:at + PLANE_ROWS]
                s, p = scatter(part)
                total += _limbs([len(part), *s.tolist(), *p[row, col].tolist()])
        limb, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[at]), pa.array(limb), pa.array(total[limb, at])],
            names=["place", "limb", "v"])
    sums = (vectors.select(column).mapInArrow(run, "place bigint, limb bigint, v bigint")
            .groupBy("place", "limb").agg(F.sum("v").alias("v")).collect())
    whole = dict.fromkeys(place.tolist(), 0)
    for r in sums:
        whole[r["place"]] += r["v"] << (LIMB_BITS * r["limb"])
    product = np.zeros((dim, dim), dtype=object)
    product[row, col] = product[col, row] = [whole[k] for k in place[1 + dim:].tolist()]
    return whole[-1], [whole[k] for k in range(dim)], product


def _project(z: np.ndarray, m: Whitening) -> np.ndarray:
    """Whitened coordinates; NaN on components without variance."""
    mean = np.array([s / m.n for s in m.sums])
    k = len(m.values)
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(m.values > ZERO * m.values[0], 1 / np.sqrt(np.abs(m.values)), np.nan)
    return (z - mean) @ m.components[:, :k] * scale


def _identity_error(vectors: DataFrame, column: str, m: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all vectors."""
    k = len(m.values)
    row, col = np.triu_indices(k)

    def run(batches):
        total = np.zeros(k + len(row))
        for b in batches:
            w = _project(integers(b.column(0), m.dim)[1], m)
            total += np.concatenate([w.sum(axis=0), (w.T @ w)[row, col]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)],
                                         names=["place", "v"])
    got = (vectors.select(column).mapInArrow(run, "place bigint, v double")
           .groupBy("place").agg(F.sum("v").alias("v")).orderBy("place").collect())
    total = np.array([r["v"] for r in got])
    # the vectors were centred before multiplying; what rounding left of their mean goes too
    mean = total[:k] / m.n
    cov = total[k:] / m.n - mean[row] * mean[col]
    return float(np.nanmax(np.abs(cov - (row == col)), initial=0.0))


def fit(vectors: DataFrame, column: str = "embedding",
        components: int = MAX_COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors (None without any). One pass for the sums, one that
    measures the whitened covariance; the driver holds one number per pair of dimensions."""
    dim = dimension(vectors, column)
    if not dim:
        return None
    n, sums, product = _moments(vectors, column, dim)
    if not n:
        return None
    s = np.array(sums, dtype=object)
    centred = n * product - np.outer(s, s)
    cov = np.array([[v / (n * n) for v in r] for r in centred.tolist()], dtype=np.float64)
    values, vecs = np.linalg.eigh(cov)
    k = min(components, dim)
    m = Whitening(n, dim, sums, np.maximum(values[::-1][:k], 0.0), vecs[:, ::-1][:, :k],
                  float(np.trace(cov)))
    m.identity_error = _identity_error(vectors, column, m)
    return m


def _deviation(z: np.ndarray, m: Whitening) -> list[int | None]:
    """Exact sum over dimensions of ``(n * x - S)**2`` per row (the shift of x cancels); None where
    a 64-bit integer can't hold it."""
    s = np.array(m.sums, dtype=object)
    most = max((max(abs(m.n * int(a) - t), abs(m.n * int(b) - t))
                for a, b, t in zip(z.min(axis=0), z.max(axis=0), m.sums)), default=0)
    if most * most * m.dim < 1 << 63:
        d = m.n * z - s.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = m.n * z.astype(object) - s
    return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
           components: int = MAX_COMPONENTS) -> DataFrame:
    """Per vector of ``vectors`` (key, array of numbers) and component from 1 on: n, deviation,
    whitened, explained and identity_error.

    Left out are vectors that are NULL, hold a NULL or non-finite entry or one of 2**42 and more
    (its integer would not be exact), and vectors of another length than the most frequent one (of a
    tie, the longest). Rows that repeat an id or vector count each; NULL ids are values like any
    other. Components without variance have a NULL ``whitened`` and don't count in
    ``identity_error``. Equal eigenvalues: any orthonormal choice, the same for all rows.
    ``deviation`` is NULL beyond 64 bits. An empty table gives no rows; extra columns are ignored."""
    d = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("embedding"))
    m = fit(d, "embedding", components)
    if m is None:
        rest = [x.split() for x in OUT.split(", ")[1:]]
        return d.filter(F.lit(False)).selectExpr(
            "vec_id", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in rest])
    k = len(m.values)
    explained = m.values / m.trace if m.trace > 0 else np.zeros(k)
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for at in range(0, b.num_rows, PLANE_ROWS):
                rows, z = integers(b.column(1).slice(at, PLANE_ROWS), m.dim)
                w = _project(z, m).ravel()
                size = len(rows)
                each = pa.array(np.repeat(np.arange(size), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows + at)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * k, m.n, dtype=np.int64)),
                    pa.array(_deviation(z, m) if size else [], pa.int64()).take(each),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * k, m.identity_error))], names=names)
    return d.mapInArrow(run, OUT)
