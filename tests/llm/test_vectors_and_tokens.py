"""Whitening, cross-tokenizer alignment and token files against brute force and exact round trips."""

import gc
import hashlib
import io
import json
import os
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from macroseries.llm import align, decontam, packing, queries, tokenstore, whitening, wordbpe
from macroseries.llm.common import table
from macroseries.session import scratch_path

from .test_operators import none, odd, rows  # noqa: F401

os.environ["TOKENIZERS_PARALLELISM"] = "false"
CHARS = ([chr(c) for c in [*range(1, 0x250), *range(0x2010, 0x2060), 0x20AC, 0x3A3, 0x4F60, 0x1F600]]
         + list("'s't re've'll'd   <|>.,!?0123456789") * 10)


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(CHARS, k=rng.randint(0, 40))) for _ in range(n)]


# ---------------------------------------------------------------- words of a vocabulary

def test_a_worker_keeps_the_tables_of_one_operator():
    """A worker that goes on to packing drops the tokens that decontamination left there."""
    tokens = decontam._tokens()
    tokens.ids(["some", "words"])
    assert decontam._tokens() is tokens
    left = weakref.ref(tokens)
    del tokens
    enc = wordbpe.word_encoder(packing.vocabulary_path())
    gc.collect()
    assert left() is None
    assert wordbpe.word_encoder(packing.vocabulary_path()) is enc
    assert wordbpe.word_encoder(packing.vocabulary_path(), 10, 5).max_runs == 10


def test_few_kept_runs_give_the_same_pieces(spark):
    texts = [*random_texts(2500, 6), None, "", "word " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    few = packing.pieces(docs, packing.vocabulary_path(), kept=(50, 20)).collect()
    many = packing.pieces(docs, packing.vocabulary_path(), with_ids=True).collect()
    assert sorted(map(tuple, few)) == sorted(tuple(r)[:5] for r in many)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in many)


@pytest.mark.parametrize("name, splits", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_word_encoder_equals_the_library(name, splits):
    from tokenizers import Tokenizer
    path = packing.vocabulary_path(name)
    tok, enc = Tokenizer.from_file(path), wordbpe.WordEncoder(path, runs=300, pieces=100)
    assert enc.split is splits
    texts = [*random_texts(3000, 5), "", "a" * 3000, "<|endoftext|> x", "don't 'S İstanbul ΣΑΣ"]
    got = list(enc(texts))
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == want


def test_pieces_follow_the_vocabulary_file(spark, tmp_path):
    """A file that asks for another normaliser is not split or lower-cased by fixed rules."""
    from tokenizers import Tokenizer
    with open(packing.vocabulary_path(), encoding="utf-8") as f:
        conf = json.load(f)
    conf["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "cat"}, "content": "dog"})
    path = tmp_path / "words.json"
    path.write_text(json.dumps(conf), encoding="utf-8")
    text = "The CAT sat, the cats don't sit"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist()
           for r in packing.pieces(docs, str(path), with_ids=True).collect()}
    ids = Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids
    assert ids != Tokenizer.from_file(packing.vocabulary_path()).encode(text, add_special_tokens=False).ids
    assert got == {1: [*ids, 2], 2: [2]}


# ---------------------------------------------------------------- 11 whitening

@pytest.mark.parametrize("n, dim, low, high", [
    (1000, 7, -500, 600), (130, 3, -2**40, 2**40), (1, 4, 5, 6), (65, 2, 7, 8), (70, 5, -2**51, 2**51)])
def test_scatter_is_exact(n, dim, low, high):
    z = np.random.default_rng(n).integers(low, high, (n, dim))
    z[:, 1] = low
    s, p = whitening.scatter(z)
    exact = z.astype(object)
    assert (s == exact.sum(axis=0)).all() and (p == exact.T @ exact).all()


def brute_whitening(ids, vectors):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(8, x.shape[1])
    dev = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for r in x]
    return dev, centred @ vecs[:, :k], values, k


def check_whitening(got, ids, vectors):
    dev, projected, values, k = brute_whitening(ids, vectors)
    by_row = defaultdict(list)
    for r in got:
        by_row[r["vec_id"]].append(r)
    assert len(got) == len(ids) * k
    sign = {}
    for i, d, p in zip(ids, dev, projected):
        for r in by_row[i]:
            c = r["component"] - 1
            assert (r["n"], r["deviation"]) == (len(ids), d)
            assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9, abs=1e-15)
            assert r["identity_error"] < 1e-9
            if values[c] > 1e-9 * values[0]:
                want = p[c] / np.sqrt(values[c])
                sign.setdefault(c, np.sign(want) * np.sign(r["whitened"]) or 1)
                assert r["whitened"] == pytest.approx(sign[c] * want, rel=1e-7, abs=1e-9)
            else:
                assert r["whitened"] is None


def test_whitening_of_the_table(spark, sf_dir):
    data = rows(table(spark, sf_dir, "embeddings"))
    check_whitening(rows(queries.op11_whitening(spark, sf_dir)),
                    [r["vec_id"] for r in data], [r["embedding"] for r in data])


def test_whitening_odd_vectors(spark):
    good = [[0.5, -1.25, 3.0], [0.1, 0.2, 3.0], [90.0, -7.0, 3.0], [0.1, 0.2, 3.0]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0],
           [1e300, 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    data = [(k, v, "x", 1) for k, v in enumerate(good + bad)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n string, component int")
    check_whitening(rows(whitening.whiten(df.repartition(3))), [0, 1, 2, 3], good)
    null_id = rows(whitening.whiten(df.withColumn("vec_id", F.lit(None))))
    assert len(null_id) == 12 and {r["vec_id"] for r in null_id} == {None}
    one = rows(whitening.whiten(df.filter("vec_id = 0")))
    assert [(r["deviation"], r["whitened"], r["identity_error"]) for r in one] == [(0, None, 0.0)] * 3
    for nothing in (df.filter("false"), df.filter("vec_id in (4, 5)"), df.filter("vec_id = 7")):
        got = whitening.whiten(nothing)
        assert got.columns == [c.split()[0] for c in whitening.OUT.split(", ")]
        assert got.count() == 0
    ints = spark.createDataFrame([(1, [1]), (2, [5])], "vec_id long, embedding array<int>")
    check_whitening(rows(whitening.whiten(ints)), [1, 2], [[1], [5]])


def test_deviation_beyond_64_bits(spark):
    far = spark.createDataFrame([(1, [1e12]), (2, [0.0]), (3, [0.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in rows(whitening.whiten(far))}
    assert got == {1: None, 2: None, 3: None}
    s = [0.0] * 40 + [1e4]
    mixed = spark.createDataFrame([(k, [v]) for k, v in enumerate(s)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in rows(whitening.whiten(mixed))}
    assert got[0] == (1024 * 10**4) ** 2 and got[40] == (40 * 1024 * 10**4) ** 2


# ---------------------------------------------------------------- 12 alignment

def brute_alignment(data):
    """Per row: n_a, n_b, n_groups, n_links, n_best, count_sum, digest; by comparing byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = align.vocabulary_paths()
    tok = Tokenizer.from_file(path_a)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    letters = align._byte_letters()
    count, links, out = Counter(), [], []
    for _, text in data:
        t = text or ""
        raw = (" " + t).encode()
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        cut = []
        for pieces in ([bytes(letters[c] for c in tok.id_to_token(i)) for i in a],
                       [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in zip(b, map(sp.id_to_piece, b))]):
            at, spans = 0, []
            for p in pieces:
                spans.append((at, at + len(p)))
                at += len(p)
            cut.append((b"".join(pieces), spans))
        if not t or cut[0][0] != raw or cut[1][0] != raw:
            links.append([])
            out.append((0, 0, 0, 0, ""))
            continue
        sa, sb = cut[0][1], cut[1][1]
        pairs, first = [], 0
        for i, (x, y) in enumerate(sa):
            while sb[first][1] <= x:
                first += 1
            k = first
            while k < len(sb) and sb[k][0] < y:
                pairs.append((a[i], b[k]))
                k += 1
        both = sorted({y for _, y in sa} & {y for _, y in sb})
        text, start = [], 0
        for end in both:
            text.append("|".join(",".join(str(i) for i, (x, y) in zip(ids, s) if start <= x and y <= end)
                                 for ids, s in ((a, sa), (b, sb))) if len(t) < 3000 else "")
            start = end
        count.update(set(pairs))
        links.append(pairs)
        out.append((len(a), len(b), len(both), len(pairs),
                    hashlib.sha256(";".join(text).encode()).hexdigest() if len(t) < 3000 else None))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(d, *o[:4], sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), o[4])
            for (d, _), o, x in zip(data, out, links)]


def same_alignment(got, want):
    long = {w[:7] for w in want if w[7] is None}
    got = [(*g[:7], None) if g[:7] in long else g for g in got]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_alignment_of_the_table(spark, sf_dir):
    data = [(r["doc_id"], r["text"]) for r in rows(table(spark, sf_dir, "documents"))]
    same_alignment([tuple(r) for r in queries.op12_alignment(spark, sf_dir).collect()],
                   brute_alignment(data))


@pytest.mark.parametrize("limit", [0, align.BROADCAST_PAIRS])
def test_alignment_odd_texts(spark, odd, none, limit):  # noqa: F811
    paths = align.vocabulary_paths()
    data = [(r["doc_id"], r["text"]) for r in rows(odd)]
    got = align.align(odd.repartition(3), *paths, broadcast_pairs=limit)
    same_alignment([tuple(r) for r in got.collect()], brute_alignment(data))
    assert align.align(none, *paths, broadcast_pairs=limit).count() == 0
    data = [(k, t) for k, t in enumerate([*random_texts(400, 7), "a▁b", "x  y \n\n z", "<s> </s> <0x41>"])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = align.align(df, *paths, with_groups=True, broadcast_pairs=limit).collect()
    same_alignment([tuple(r)[:8] for r in got], brute_alignment(data))
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest()
                                      if r["groups"] else "") for r in got)


def test_terminals_label_the_groups():
    rng = np.random.default_rng(3)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(size - 1) < p) + 1, size) for p in rng.random(2)]
        last = align.terminals(*ends)
        common = np.intersect1d(*ends)
        want = np.concatenate([np.searchsorted(ends[0], common[np.searchsorted(common, e)]) for e in ends])
        assert (last == want).all()


def test_a_counting_task_adds_up_in_parts(spark, odd):  # noqa: F811
    paths = align.vocabulary_paths()
    got = align.groups(odd, *paths)
    pair = align._pair(*paths)
    whole, parts = (sorted(map(tuple, align.pair_counts(got, pair.code, pair.n_b, k).collect()))
                    for k in (1 << 20, 1))
    assert whole == parts and whole


# ---------------------------------------------------------------- 13 token files

def brute_tokens(data):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    out = {}
    for k, (doc, text) in enumerate(data):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out[k] = (doc, np.array(ids, dtype="<u4").tobytes())
    return list(out.values())


def test_token_files_of_the_table(spark, sf_dir):
    data = sorted((r["doc_id"], r["text"] or "") for r in rows(table(spark, sf_dir, "documents")))
    want, start = [], 0
    for doc, ids in brute_tokens(data):
        want.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = sorted(tuple(r) for r in queries.op13_token_files(spark, sf_dir).collect())
    assert got == want


def test_token_files_odd_rows_and_reads(spark, odd, none):  # noqa: F811
    path = scratch_path(spark, "tokens-test")
    vocabulary = packing.vocabulary_path()
    tokenstore.write_tokens(odd.repartition(3), path, vocabulary, frame_bytes=1024, file_bytes=2048)
    got = sorted(rows(tokenstore.read_tokens(spark, path)), key=lambda r: r["start"])
    want = brute_tokens([(r["doc_id"], r["text"]) for r in rows(odd)])
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in got if r["doc_id"] is not None) == sorted(
        w for w in want if w[0] is not None)
    assert [bytes(r["ids"]) for r in got if r["doc_id"] is None] == [w[1] for w in want if w[0] is None]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    ask = spark.createDataFrame([(5,), (7,), (7,), (99,), (None,)], "doc_id long")
    some = rows(tokenstore.read_tokens(spark, path, ask))
    assert sorted(r["start"] for r in some) == [r["start"] for r in got if r["doc_id"] in (5, 7)]
    assert all(r in got for r in some)
    empty = scratch_path(spark, "tokens-test")
    tokenstore.write_tokens(none, empty, vocabulary)
    assert tokenstore.read_tokens(spark, empty).count() == 0
    assert tokenstore.read_tokens(spark, empty, ask).count() == 0
    with pytest.raises(ValueError):
        tokenstore.write_tokens(none, empty, vocabulary, frame_bytes=6)


def test_many_ranges_keep_the_order(spark, sf_dir):
    """Many small partitions and files, and one id that a third of the rows share."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, 400).otherwise(F.col("doc_id")))
    path = scratch_path(spark, "tokens-test")
    keys = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        tokenstore.write_tokens(docs, path, packing.vocabulary_path(), file_bytes=1 << 16)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = rows(spark.read.parquet(f"{path}/manifest"))
    assert len({r["part"] for r in files}) > 5 and len(files) > 8
    assert sum(r["first_doc"] <= 400 <= r["last_doc"] for r in files) > 2
    got = sorted(rows(tokenstore.read_tokens(spark, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in rows(docs))
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    ask = docs.select("doc_id").filter("doc_id < 40 or doc_id = 400")
    some = rows(tokenstore.read_tokens(spark, path, ask))
    assert sorted(r["start"] for r in some) == [r["start"] for r in got
                                                if r["doc_id"] < 40 or r["doc_id"] == 400]


@pytest.mark.parametrize("frame", [64, 4096, 65536])
def test_one_file(tmp_path, frame):
    import zstandard
    rng = random.Random(frame)
    for trial in range(12):
        path = f"{tmp_path}/{trial}.ids.zst"
        sizes = [rng.choice([0, 1, 15, 16, 17, 1000, frame // 4, frame // 2, 20_000])
                 for _ in range(rng.choice([0, 1, 5, 60]))]
        docs = [(None if k < 2 else k // 2, np.random.default_rng(k).integers(0, 49_000, n)
                 .astype("<u4").tobytes()) for k, n in enumerate(sizes)]
        w = tokenstore.FileWriter(path, frame)
        for d, ids in docs:
            w.add(d, ids)
        w.close()
        f = tokenstore.FileReader(path)
        assert f.docs == [d for d, _ in docs]
        for k in rng.sample(range(len(docs)), len(docs)):
            assert f.ids(k) == docs[k][1]
        with open(path, "rb") as raw:
            data = raw.read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        if docs and any(sizes):
            assert plain.read() == b"".join(ids for _, ids in docs)


def test_reads_only_the_frames_asked_for_and_checks_them(tmp_path):
    path = f"{tmp_path}/x.ids.zst"
    rng = np.random.default_rng(1)
    w = tokenstore.FileWriter(path, 4096)
    docs = [rng.integers(0, 49_000, 500).astype("<u4").tobytes() for _ in range(1000)]
    for k, ids in enumerate(docs):
        w.add(k, ids)
    w.close()
    f = tokenstore.FileReader(path)
    head = f.bytes_read
    assert f.ids(700) == docs[700] and f.frames_read == 1
    assert f.bytes_read - head < 2 * 4096 and head < os.path.getsize(path) / 20
    at, checksum = int(f.at[350]), f.frames[350][2]
    size = int(f.frames[350][0])
    import zstandard
    with open(path, "r+b") as raw:
        raw.seek(at + size // 2)
        byte = raw.read(1)
        raw.seek(at + size // 2)
        raw.write(bytes([byte[0] ^ 1]))
    f = tokenstore.FileReader(path)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        f.ids(700)
    assert f.ids(3) == docs[3] and checksum != 0
    with open(path, "wb") as raw:
        raw.write(b"no token file at all, whatever")
    with pytest.raises(ValueError):
        tokenstore.FileReader(path)
