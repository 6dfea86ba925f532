"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes into tokens. Every token points to the token farthest to the right
that overlaps it; doubling these pointers for all tokens of a batch at once leads each to the last
token of its component, which labels its group. Since both sequences cut the same bytes, the overlapping
pairs (links) are the pieces between neighbouring token ends of either side.

How often two tokens are linked is counted over all documents. Pair counts are added in every task
before they are shuffled; documents get them back from a broadcast while the table of pairs is under
``BROADCAST_PAIRS`` rows, and by a join beyond.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macroseries.llm.common import write_once
from macroseries.llm.wordbpe import _OTHER

TOGETHER = 1 << 20
#: Pairs sent to every executor at most (17 bytes each), and kept by a counting task.
BROADCAST_PAIRS, TASK_PAIRS = 4_000_000, 4_000_000
GROUPS = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
          "pairs binary, times binary")
# fixed values: how a byte-level vocabulary file must cut text for the fast encoder to stand in
SPLITTER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BPE = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None,
             "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 letters
    stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids by a byte-level BPE file of the tokenizers library; special tokens' strings are text.

    Where the file is a plain byte-level BPE whose ids follow its merges, tiktoken encodes texts of
    common characters with the same vocabulary, some three times as fast."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        letters = _byte_letters()
        self.bytes = [b""] * self.tok.get_vocab_size()
        for token, i in self.tok.get_vocab().items():
            self.bytes[i] = (bytes(map(letters.__getitem__, token)) if letters.keys() >= set(token)
                             else token.encode())
        self.fast = self._fast(path)

    def _fast(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        model, split = conf["model"], conf.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        plain = (all(model.get(k) == v for k, v in PLAIN_BPE.items())
                 and conf.get("normalizer") is None and split.get("type") == "ByteLevel"
                 and split.get("use_regex") and not split.get("add_prefix_space")
                 and all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges)))
        if not plain:
            return None
        import tiktoken
        ranks = {self.bytes[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("bytes", pat_str=SPLITTER, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out = [None if self.fast is None or _OTHER.search(t) else self.fast(t) for t in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, self.tok.encode_batch_fast([texts[k] for k in rest],
                                                         add_special_tokens=False)):
            out[k] = e.ids
        return out


class Pieces:
    """Ids by a sentencepiece model; bytes of a piece with U+2581 as space."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(self.sp.id_to_piece(i)[3:5], 16)]) if self.sp.is_byte(i) else
                      self.sp.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(self.sp.get_piece_size())]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """For every A token, then every B token, the last A token of its component. ``end_a`` and
    ``end_b`` are the rising ends of two cuts of the same bytes."""
    n = len(end_a)
    # the token of the other side that covers a token's last byte
    over_a = np.searchsorted(end_b, end_a)
    over_b = np.searchsorted(end_a, end_b)
    # ... is the farthest right it overlaps; where both end together, the A token is the last
    nxt = np.concatenate([np.where(end_b[over_a] > end_a, n + over_a, np.arange(n)), over_b])
    while True:
        far = nxt[nxt]
        if np.array_equal(far, nxt):
            return nxt
        nxt = far


class _Pair:
    """Both tokenizers with the byte lengths and printed forms of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.len_a = np.array([len(x) for x in self.a.bytes])
        self.len_b = np.array([len(x) for x in self.b.bytes])
        self.n_b = len(self.b.bytes)
        self.code = np.dtype("<u4" if len(self.a.bytes) * self.n_b < 1 << 32 else "<u8")
        # token k of A inside (2k) and at the end (2k + 1) of its group, then those of B
        self.printed = [f"{k}{c}" for n, sep in ((len(self.a.bytes), ",|"), (self.n_b, ",;"))
                        for k in range(n) for c in sep]

    def align(self, docs: list, texts: list) -> Iterator[pa.RecordBatch]:
        """GROUPS rows of some documents."""
        whole = [t or "" for t in texts]
        ids_a, ids_b = self.a([" " + t for t in whole]), self.b(whole)
        full = []
        for t, a, b in zip(whole, ids_a, ids_b):
            raw = b" " + t.encode()
            full.append(bool(t) and b"".join(map(self.a.bytes.__getitem__, a)) == raw
                        and b"".join(map(self.b.bytes.__getitem__, b)) == raw)
        a_of, b_of = ([x if k else [] for x, k in zip(ids, full)] for ids in (ids_a, ids_b))
        doc = np.arange(len(docs))
        size_a, size_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a_of, b_of))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (a_of, b_of))
        doc_a = np.repeat(doc, size_a)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # documents stand one after the other, so no component reaches over a document's end
        last = terminals(end_a, end_b) if len(a) else np.zeros(0, dtype=np.int64)
        last_a, last_b = last[:len(a)], last[len(a):]
        n_groups = np.bincount(doc_a[last_a == np.arange(len(a))], minlength=len(docs))
        ends = np.union1d(end_a, end_b)
        link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        link_doc = doc_a[link_a]
        n_links = np.bincount(link_doc, minlength=len(docs))
        pairs, times = self._pairs(link_doc, a[link_a] * self.n_b + b[link_b], len(docs))
        yield pa.RecordBatch.from_arrays([
            pa.array(docs, pa.int64()), pa.array(size_a), pa.array(size_b), pa.array(n_groups),
            pa.array(n_links), pa.array(self._print(a, b, last_a, last_b, size_a + size_b)),
            pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
            names=[c.split()[0] for c in GROUPS.split(", ")])

    def _pairs(self, doc: np.ndarray, code: np.ndarray, n: int) -> tuple[list, list]:
        """Per document its distinct linked pairs of ids, as codes, and how often it has each."""
        order = np.lexsort((code, doc))
        doc, code = doc[order], code[order]
        new = np.ones(len(code), dtype=bool)
        new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(code))).astype("<u4")
        code, cut = code[at].astype(self.code), np.searchsorted(doc[at], np.arange(n + 1))
        return tuple([x[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])] for x in (code, times))

    def _print(self, a, b, last_a, last_b, sizes) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document: A ids, then B ids of each group, in order."""
        close_a = np.append(last_a[1:] != last_a[:-1], True) if len(a) else last_a.astype(bool)
        close_b = np.append(last_b[1:] != last_b[:-1], True) if len(b) else last_b.astype(bool)
        code = np.concatenate([2 * a + close_a, 2 * (b + len(self.a.bytes)) + close_b])
        group = np.concatenate([last_a, last_b])
        code = code[np.argsort(2 * group + np.repeat([0, 1], [len(a), len(b)]), kind="stable")]
        words = list(map(self.printed.__getitem__, code.tolist()))
        cut = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip(cut, cut[1:])]


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> _Pair:
    """Loaded once per Python worker."""
    return _Pair(path_a, path_b)


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b, n_groups, n_links, ``groups`` (ids as
    ``a1,a2|b1;a3|b2,b3``), and the distinct linked pairs as codes (A id times the size of B's
    vocabulary plus B id) with how often the document links each. No tokens, so zeros and an empty
    string, for a NULL or empty text and for one that either tokenizer doesn't reproduce."""
    def run(batches):
        tokenizers = _pair(path_a, path_b)
        for b in batches:
            docs, texts, size = [], [], 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                docs.append(doc)
                texts.append(text)
                size += len(text or "")
                if size >= TOGETHER:
                    yield from tokenizers.align(docs, texts)
                    docs, texts, size = [], [], 0
            if docs:
                yield from tokenizers.align(docs, texts)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, GROUPS)


def _numbers(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def pair_counts(aligned: DataFrame, code: np.dtype, n_b: int,
                task_pairs: int = TASK_PAIRS) -> DataFrame:
    """code, n (documents that hold the pair linked) and best (no pair of the same A id is in more
    documents). Tasks add up what they read before the shuffle, at most ``task_pairs`` pairs or one
    batch at a time."""
    def run(batches):
        parts, size = [], 0

        def add():
            codes, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n)],
                                              names=["code", "n"])
        for b in batches:
            parts.append(_numbers(b.column("pairs"), code))
            size += len(parts[-1])
            if size >= task_pairs:
                yield add()
                parts, size = [], 0
        if parts:
            yield add()
    got = aligned.select("pairs").mapInArrow(run, "code bigint, n bigint")
    got = got.groupBy("code").agg(F.sum("n").alias("n"))
    # an A id is linked with at most all ids of B: a bounded window
    same = Window.partitionBy(F.expr(f"code div {n_b}"))
    return got.select("code", "n", (F.col("n") == F.max("n").over(same)).alias("best"))


def _scored_by_broadcast(aligned: DataFrame, pairs: DataFrame, code: np.dtype) -> DataFrame:
    table = pairs.orderBy("code").toArrow()
    shared = aligned.sparkSession.sparkContext.broadcast(
        (table["code"].to_numpy().astype(code), table["n"].to_numpy(),
         table["best"].to_numpy()))
    kept = [f for f in aligned.schema.fields if f.name not in ("row", "pairs", "times")]
    names = [f.name for f in kept]

    def run(batches):
        codes, n, best = shared.value
        for b in batches:
            at = np.searchsorted(codes, _numbers(b.column("pairs"), code))
            times = _numbers(b.column("times"), np.dtype("<u4")).astype(np.int64)
            size = [len(x) // code.itemsize for x in b.column("pairs").to_pylist()]
            cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(times * x[at])]) for x in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array((s[cut[1:]] - s[cut[:-1]]).astype(np.int64))
                                                for s in sums],
                names=[*names, "n_best", "count_sum"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return aligned.select(*names, "pairs", "times").mapInArrow(
        run, f"{schema}, n_best bigint, count_sum bigint")


def _scored_by_join(aligned: DataFrame, pairs: DataFrame, code: np.dtype) -> DataFrame:
    """A document has a row per distinct pair, so no pair has more rows than there are documents."""
    zero = F.lit(0).cast("long")

    def run(batches):
        for b in batches:
            held = _numbers(b.column("pairs"), code)
            size = [len(x) // code.itemsize for x in b.column("pairs").to_pylist()]
            times = _numbers(b.column("times"), np.dtype("<u4")).astype(np.int64)
            row = np.repeat(b.column("row").to_numpy(), size)
            for at in range(0, len(held), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[part]), pa.array(held[part].astype(np.int64)),
                     pa.array(times[part])], names=["row", "code", "times"])
    held = aligned.select("row", "pairs", "times").mapInArrow(
        run, "row bigint, code bigint, times bigint")
    sums = held.join(pairs, "code").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "row", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b, n_groups, n_links, n_best (links whose pair's
    count is the highest of their A id, ties included), count_sum (the counts of all links added) and
    groups_sha256; ``with_groups`` adds ``groups`` itself. A pair's count is the number of rows of
    ``docs`` that hold it linked.

    NULL and empty texts, and texts whose bytes either tokenizer changes, have no tokens: zeros and
    an empty string. Rows that repeat a document count each; NULL ids are values like any other; an
    empty table gives no rows. Extra columns are ignored."""
    tokenizers = _pair(path_a, path_b)
    code, n_b = tokenizers.code, tokenizers.n_b
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"] + ["groups"] * with_groups
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = write_once(groups(docs, path_a, path_b).select(
        F.monotonically_increasing_id().alias("row"), *keep,
        digest.alias("groups_sha256"), "pairs", "times"), "aligned")
    pairs = write_once(pair_counts(aligned, code, n_b), "pairs")
    small = pairs.count() <= broadcast_pairs
    scored = (_scored_by_broadcast if small else _scored_by_join)(aligned, pairs, code)
    return scored.select(*keep[:5], "n_best", "count_sum", "groups_sha256", *keep[5:])
