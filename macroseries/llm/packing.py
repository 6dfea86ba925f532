"""Sequence packing by shortest-pack-first over the length histogram.

Documents are tokenised once, in Spark tasks; a document longer than a sequence is cut into full
pieces and a rest. Only the histogram of piece lengths (at most ``max_tokens`` numbers) reaches the
driver, where lengths are placed longest first, always into the pack that holds least, as counts of
equal packs. The placements are ranges of ranks within a length; pieces are numbered within their
length and look their place up.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import number_rows, write_once
from macroseries.llm.wordbpe import PIECES, RUNS, word_encoder

MAX_TOKENS, END_ID = 4096, 2
#: Documents that a task holds at a time besides the batch it was sent.
ROWS = 1000
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
           with_ids: bool = False, kept: tuple[int, int] = (RUNS, PIECES)) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text): ids then ``end_id``, cut every
    ``max_tokens``. A NULL text is empty: one piece, the end id. ``with_ids`` adds ``ids``.
    ``kept``: most runs and pieces of runs whose ids a worker keeps; fewer take less memory and more
    time, and the rows are the same."""
    schema = SCHEMA + (", ids binary" if with_ids else "")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        import zlib
        encode = word_encoder(path, *kept)
        for b in (x.slice(at, ROWS) for x in batches for at in range(0, x.num_rows, ROWS)):
            cols: list[list] = [[] for _ in range(6)]
            texts = [t or "" for t in b.column("text").to_pylist()]
            for doc, ids in zip(b.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                for at in range(0, len(ids), 4 * max_tokens):
                    part = ids[at:at + 4 * max_tokens]
                    for c, v in zip(cols, (doc, at // 4, len(part) // 4, zlib.crc32(part),
                                           len(ids) // 4)):
                        c.append(v)
                    if with_ids:
                        cols[5].append(part)
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(run, schema)


@dataclass
class Placement:
    """Pieces of ``length`` with ranks from ``rank`` on: ``times`` of them side by side in each
    sequence from ``sequence`` on, the first at ``offset``."""
    length: int
    rank: int
    times: int
    sequence: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], max_tokens: int) -> list[Placement]:
    """Place every length of the histogram, longest first, into the pack that holds least; a new
    pack is opened when that one has no room. Packs that hold equally much are kept as ranges."""
    out: list[Placement] = []
    packs: dict[int, list[tuple[int, int]]] = {}
    filled: list[int] = []
    n_seq = 0

    def put(total: int, first: int, count: int) -> None:
        if count and total < max_tokens:
            if not packs.get(total):
                heapq.heappush(filled, total)
                packs[total] = []
            packs[total].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            while filled and not packs.get(filled[0]):
                packs.pop(heapq.heappop(filled), None)
            if not filled or filled[0] + length > max_tokens:
                per = max_tokens // length
                for count, times in ((left // per, per), (1 if left % per else 0, left % per)):
                    if count:
                        out.append(Placement(length, rank, times, n_seq, 0))
                        put(times * length, n_seq, count)
                        rank += count * times
                        n_seq += count
                break
            total = filled[0]
            first, count = packs[total].pop()
            use = min(left, count)
            out.append(Placement(length, rank, 1, first, total))
            if use < count:
                packs[total].append((first + use, count - use))
            put(total + length, first, use)
            rank += use
            left -= use
    return out


def pack(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
         with_ids: bool = False, kept: tuple[int, int] = (RUNS, PIECES)) -> DataFrame:
    """Pack the documents (doc_id, text) into sequences of at most ``max_tokens``: one row per piece
    with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Rows that repeat a document are packed each; NULL ids are values like any other; an empty table
    gives an empty result. Extra columns are ignored. ``kept`` as in ``pieces``."""
    cut = write_once(pieces(docs, path, max_tokens, end_id, with_ids, kept), "pieces")
    hist = {r["length"]: r["c"] for r in
            cut.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}
    places = shortest_pack_first(hist, max_tokens)
    places.sort(key=lambda p: (p.length, p.rank))
    # at most max_tokens lengths, each in few ranges: bounded by the histogram, not by the data
    bits = 44
    shared = docs.sparkSession.sparkContext.broadcast(np.array(
        [((p.length << bits) + p.rank, p.times, p.sequence, p.offset) for p in places],
        dtype=np.int64).reshape(-1, 4))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = shared.value
        n, r = length.to_numpy(dtype=np.int64), rank.to_numpy(dtype=np.int64)
        k = np.searchsorted(t[:, 0], (n << bits) + r, side="right") - 1
        nth = (n << bits) + r - t[k, 0]
        return pd.DataFrame({"sequence_id": t[k, 2] + nth // t[k, 1],
                             "offset": t[k, 3] + nth % t[k, 1] * n})

    ranked = number_rows(cut, ["length"], ["doc_id", "start"], "rank")
    out = ranked.withColumn("at", place("length", "rank"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    return out.select(*cols, "at.sequence_id", "at.offset")
