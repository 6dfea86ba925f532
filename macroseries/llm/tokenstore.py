"""Token ids in binary files of independent zstandard frames with a trailing seek table.

File format (the public zstandard seekable format, so that any zstandard reader can also decompress a
file from front to back):

* data frames, each compressed by itself: little-endian unsigned 32-bit ids, document after document.
  A frame closes at a document's end once it is full; a document longer than a frame has frames of
  its own;
* a skippable frame with the document index: per document its id (or none) and its number of ids;
* a skippable frame with the seek table: compressed size, size and checksum (low 32 bits of XXH64 of
  the ids) of every data frame, and the footer that ends the file.

Documents are range-partitioned by id and every task streams its range into files, so files in the
manifest's order hold all ids in ascending document order. The manifest, written through Spark's
commit protocol, names the files of the attempts that succeeded: what a lost executor leaves behind is
never read. Readers seek to the frames of the documents asked for and decompress nothing else.
"""

from __future__ import annotations

import re
import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroseries.llm.common import free_name
from macroseries.llm.wordbpe import word_encoder

END_ID = 1
FRAME_BYTES, FILE_BYTES, LEVEL = 64 << 10, 64 << 20, 3
# fixed values of the zstandard seekable format
SKIP_INDEX, SKIP_SEEK, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
MANIFEST = ("part int, seq int, path string, n_docs bigint, n_ids bigint, n_bytes bigint, "
            "n_null bigint, first_doc bigint, last_doc bigint")
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _store(path: str):
    """File system and name of a path that executors share (local or shared disk, hdfs, s3)."""
    from pyarrow import fs
    uri = re.sub(r"^file:/*", "/", re.sub(r"^s3[an]:", "s3:", path))
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _checksum(data: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """Streams documents into one file; only the index and seek table stay in memory."""

    def __init__(self, path: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard
        store, name = _store(path)
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.path, self.frame_bytes = path, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.out = store.open_output_stream(name, compression=None)
        self.waiting: list[bytes] = []
        self.size = self.written = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append a document's ids (little-endian unsigned 32-bit)."""
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._frame(b"".join(self.waiting))
        for at in range(0, len(ids) - self.frame_bytes + 1, self.frame_bytes):
            self._frame(ids[at:at + self.frame_bytes])
        tail = ids[len(ids) - len(ids) % self.frame_bytes:]
        self.waiting.append(tail)
        self.size += len(tail)
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)

    def _frame(self, data: bytes) -> None:
        packed = self.pack(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), _checksum(data)))
        self.written += len(packed)
        self.waiting, self.size = [], 0

    def close(self) -> tuple:
        """Write index and seek table; the file's manifest entry from ``path`` on."""
        if self.size:
            self._frame(b"".join(self.waiting))
        null = np.array([d is None for d in self.docs], dtype=np.uint8)
        ids = np.array([d or 0 for d in self.docs], dtype="<i8")
        lengths = np.array(self.lengths, dtype="<i8")
        index = struct.pack("<Q", len(ids)) + self.pack(
            ids.tobytes() + lengths.tobytes() + null.tobytes())
        table = np.array(self.frames, dtype="<u4").tobytes()
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_END)
        for magic, data in ((SKIP_INDEX, index), (SKIP_SEEK, table)):
            self.out.write(struct.pack("<II", magic, len(data)) + data)
            self.written += 8 + len(data)
        self.out.close()
        known = ids[null == 0]
        return (self.path, len(ids), int(lengths.sum()), self.written, int(null.sum()),
                int(known[0]) if len(known) else None, int(known[-1]) if len(known) else None)


class FileReader:
    """Random access to one file: ``docs`` (ids, None for NULL), ``starts``, and ``ids(k)``.

    ``bytes_read`` and ``frames_read`` count what was fetched and decompressed."""

    def __init__(self, path: str):
        import zstandard
        store, name = _store(path)
        self.path = path
        self.f = store.open_input_file(name)
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.bytes_read = self.frames_read = 0
        end = self.f.size()
        n, flags, magic = struct.unpack("<IBI", self._read(end - 9, 9)) if end >= 17 else (0, 0, 0)
        if magic != SEEK_END or flags != CHECKSUMS or 12 * n + 17 > end:
            raise ValueError(f"{path}: no seek table")
        table = self._read(end - 9 - 12 * n, 12 * n)
        self.frames = np.frombuffer(table, dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.begin = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        first = int(self.at[-1])
        magic, size = struct.unpack("<II", self._read(first, 8))
        if magic != SKIP_INDEX:
            raise ValueError(f"{path}: no document index")
        index = self._read(first + 8, size)
        n, = struct.unpack("<Q", index[:8])
        data = self.unpack(index[8:])
        ids, lengths = np.frombuffer(data, dtype="<i8", count=2 * n).reshape(2, n)
        null = np.frombuffer(data, dtype=np.uint8, offset=16 * n)
        self.docs = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.n_null = int(null.sum())
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self._kept = (-1, b"")

    def _read(self, at: int, size: int) -> bytes:
        self.bytes_read += size
        return self.f.read_at(size, at)

    def _frame(self, k: int) -> bytes:
        if self._kept[0] != k:
            size, full, checksum = self.frames[k].tolist()
            data = self.unpack(self._read(int(self.at[k]), size), max_output_size=full)
            self.frames_read += 1
            if len(data) != full or _checksum(data) != checksum:
                raise ValueError(f"{self.path}: frame {k} does not match its checksum")
            self._kept = (k, data)
        return self._kept[1]

    def ids(self, k: int) -> bytes:
        """The ids of the ``k``-th document, from its frames alone."""
        a, b = 4 * int(self.starts[k]), 4 * int(self.starts[k + 1])
        first = bisect_right(self.begin, a) - 1
        last = bisect_left(self.begin, b)
        parts = []
        for frame in range(first, last):
            base = int(self.begin[frame])
            parts.append(self._frame(frame)[max(a - base, 0):b - base])
        return b"".join(parts)

    def find(self, doc_id: int) -> range:
        """Positions of the documents with this id: known ids ascend, after those without one."""
        return range(bisect_left(self.docs, doc_id, self.n_null),
                     bisect_right(self.docs, doc_id, self.n_null))

    def close(self) -> None:
        self.f.close()


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID,
                 frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every row of ``docs`` (doc_id, text), each followed by ``end_id``, below
    ``path`` in ascending doc_id order.

    NULL text is empty (the end id alone); rows with a NULL doc_id come first; rows that share a
    doc_id are all written, in any order, and a hot id is spread over tasks; an empty table gives
    an empty manifest. Extra columns are ignored. A task holds one batch of texts and a frame."""
    if frame_bytes % 4 or frame_bytes <= 0:
        raise ValueError("frame_bytes must be a positive multiple of 4")
    end = np.array([end_id], dtype="<u4").tobytes()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    tie = free_name(d, "tie")
    d = d.withColumn(tie, F.monotonically_increasing_id())
    d = d.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).drop(tie)
    fields = [c.split()[0] for c in MANIFEST.split(", ")]

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode = word_encoder(vocabulary)
        out, seq = None, 0

        def done():
            row = (part, seq, *out.close())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string() if n == "path" else
                          pa.int32() if n in ("part", "seq") else pa.int64())
                 for n, v in zip(fields, row)], names=fields)

        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(),
                                encode(b.column("text").to_pylist())):
                if out is None:
                    out = FileWriter(f"{path}/data/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids.zst",
                                     frame_bytes)
                out.add(doc, ids + end)
                if out.written >= file_bytes:
                    yield done()
                    out, seq = None, seq + 1
        if out is not None:
            yield done()
    d.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")


def _files(spark: SparkSession, path: str) -> list:
    """Manifest rows in order: one per file, however many documents it holds."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()
    return sorted(rows, key=lambda r: (r["part"], r["seq"]))


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    names = [c.split()[0] for c in DOCS.split(", ")]
    types = [pa.int64()] * 3 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _rows(f: FileReader, positions, base: int) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for k in positions:
        ids = f.ids(k)
        rows.append((f.docs[k], base + int(f.starts[k]), len(ids) // 4, ids))
        size += len(ids)
        if size > 8 << 20 or len(rows) >= 10_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned
    32-bit, the end id included) of the documents below ``path``.

    ``wanted`` (doc_id) asks for some documents by id: only files whose range of ids holds one of
    them are opened and only the frames of these documents are decompressed; unknown and NULL ids
    give no row, repeated ones one. Without it every file is read, one task each. A frame that does
    not match its checksum raises an error. The driver holds one manifest row per file."""
    files = _files(spark, path)
    paths = [r["path"] for r in files]
    base = np.concatenate([[0], np.cumsum([r["n_ids"] for r in files], dtype=np.int64)]).tolist()
    if wanted is None:
        def run(batches):
            for b in batches:
                for k in b.column("file").to_pylist():
                    f = FileReader(paths[k])
                    yield from _rows(f, range(len(f.docs)), base[k])
                    f.close()
        every = spark.range(0, len(files), 1, max(1, len(files))).select(F.col("id").alias("file"))
        return every.mapInArrow(run, DOCS)

    known = [(r["first_doc"], r["last_doc"], k) for k, r in enumerate(files)
             if r["first_doc"] is not None]
    first, last = [x[0] for x in known], [x[1] for x in known]
    number = [x[2] for x in known]

    def place(batches):
        for b in batches:
            doc, file = [], []
            for d in b.column("doc_id").to_pylist():
                for k in range(bisect_left(last, d), bisect_right(first, d)):
                    doc.append(d)
                    file.append(number[k])
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(file, pa.int64())],
                                             names=["doc_id", "file"])

    def fetch(batches):
        f, k = None, -1
        for b in batches:
            cut = b.column("file").to_numpy(zero_copy_only=False)
            ids = b.column("doc_id").to_pylist()
            at = 0
            while at < len(ids):
                to = int(np.searchsorted(cut, cut[at], side="right"))
                if cut[at] != k:
                    if f is not None:
                        f.close()
                    k = int(cut[at])
                    f = FileReader(paths[k])
                yield from _rows(f, (p for d in ids[at:to] for p in f.find(d)), base[k])
                at = to
        if f is not None:
            f.close()
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    placed = ids.mapInArrow(place, "doc_id bigint, file bigint")
    return placed.repartition("file").sortWithinPartitions("file", "doc_id").mapInArrow(fetch, DOCS)
