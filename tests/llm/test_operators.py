"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on the
small tables and on rows with NULLs, empty and long texts, ties, repeats and clashing columns."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from macroseries.llm import (crossent, decontam, kdshard, langid, minhash, packing, quality, queries,
                             rules, template, warc)
from macroseries.llm.common import number_rows, table
from macroseries.session import local_path, scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}
LONG = "alpha beta gamma delta " * 5000 + "end"
ODD_TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "the cat sat on the mat today"),
             (5, "the cat sat on the mat today"), (5, "the cat sat on the mat today"),
             (6, "The CAT sat on the mat today"), (7, LONG), (8, "#$% 123 ... !!"),
             (9, "İstanbul ΣΣ 你好 \U0001f600 <|endoftext|> x")]
CLASH = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, "
         "score string, shard string, rank string, bucket string, text_hash string, v string")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(i, t, "en", "s", 0, "x", "x", "x", "x", "x", "x", "x") for i, t in ODD_TEXTS], CLASH)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASH)


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- 1 WARC

def expected_records(pages):
    first = defaultdict(lambda: None)
    for p in pages:
        d = (p["html"] or "").encode()
        if p["page_id"] is not None and (first[d] is None or p["page_id"] > first[d]):
            first[d] = p["page_id"]
    out = []
    for p in pages:
        d = (p["html"] or "").encode()
        again = first[d] is not None and p["page_id"] != first[d]
        out.append((p["page_id"], len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(),
                    "revisit" if again else "response", first[d] if again else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark, sf_dir):
    got = [tuple(r) for r in queries.op1_warc(spark, sf_dir).collect()]
    assert sorted(got, key=str) == expected_records(rows(table(spark, sf_dir, "pages")))


def test_warc_odd_rows_and_ranges(spark):
    data = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://a/ b\r\nX: y%", ""), (4, "u", None),
            (None, "v", "x"), (6, "w", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\né" * 3000),
            (7, "z", "y"), (7, "z", "y"), (None, "q", "only"), (None, "q", "only")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(2)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    back = warc.read_back(spark, path)
    got = sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                   r["refers_to"]) for r in rows(back)], key=str)
    assert got == expected_records([dict(zip(("page_id", "url", "html"), d)) for d in data])
    assert {(r["page_id"], r["url"]) for r in rows(back)} == {(d[0], d[1]) for d in data}
    idx = warc.index(spark, path)
    some = idx.filter("record_type = 'response'")
    for gap, size in ((0, 1), (10, 200), (1 << 20, 1 << 20)):
        payload = sorted((bytes(r["payload"]) for r in rows(warc.read_records(some, gap, size))))
        want = sorted((d[2] or "").encode() for d in data if (d[0], d[2]) not in {
            (1, "x"), (None, "x"), (3, "")})
        assert payload == want
    empty = scratch_path(spark, "warc-test")
    warc.write_archives(pages.filter("false"), empty)
    assert warc.read_back(spark, empty).count() == 0
    assert sorted(rows(warc.records(pages, broadcast_rows=0)), key=str) == sorted(
        rows(warc.records(pages)), key=str)


def test_warc_members_and_plain_archives(spark):
    """Each member is a whole record, the stream of all members is a plain archive, and a plain
    archive gives the same records."""
    data = [(k, f"http://a/{k}", f"text {k} é\r\n\r\n" * (k * 700)) for k in range(9)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    idx = rows(warc.index(spark, path).orderBy("offset"))
    packed = open(local_path(idx[0]["path"]), "rb").read()
    plain = gzip.decompress(packed)
    for r in idx:
        record = gzip.decompress(packed[r["offset"]:r["offset"] + r["length"]])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert record in plain
    other = scratch_path(spark, "warc-plain")
    spark.createDataFrame([(plain.decode(),)], "value string").coalesce(1).write.option(
        "lineSep", "\r\n\r\n").text(other)
    name = next(iter(spark.read.format("binaryFile").load(other).select("path").first()))
    with open(local_path(name), "r+b") as f:
        f.truncate(len(plain))
    want = {d[0]: d[2].encode() for d in data}
    for at in (path, other):
        got = rows(warc.read_records(warc.index(spark, at), max_read=5000))
        assert {r["page_id"]: bytes(r["payload"]) for r in got} == want and len(got) == len(data)


# ---------------------------------------------------------------- 2 decontamination

def bench(spark):
    return spark.createDataFrame([
        (1, "A train leaves Paris at 9 km and reaches Lyon after 250 km. How fast was the train "
            "going from Paris to Lyon on average that day?"),
        (2, "Which of these seven words is spelled with two letters that never follow each other?"),
        (2, "Which of these seven words is spelled with two letters that never follow each other?"),
        (3, None), (4, ""), (5, "short one")], "item_id long, text string")


def test_decontamination_finds_copies_and_new_parameters(spark):
    docs = spark.createDataFrame([
        (10, "Filler first. Which of these seven words is spelled with two letters that never "
             "follow each other? Filler last."),
        (11, "a train leaves Oslo at 7 miles and reaches Bergen after 300 miles. How fast was the "
             "train going from Oslo to Bergen on average that day?".replace("a train", "A train")),
        (12, "A train leaves Oslo at 7 miles and reaches Bergen after 300 miles. How fast was the "
             "train going from Rome to Kiel on average that day?"),
        (13, "Which of these seven words is spelled in a way that nobody else would have chosen"),
        (14, None), (15, ""), (None, "WHICH of these seven words is spelled with two letters that "
                                     "never follow each other"), (16, LONG)],
        "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in rows(decontam.contaminated(docs, bench(spark)))}
    assert set(got) == {(10, 2), (11, 1), (None, 2)}
    assert got[(11, 1)]["reparameterised"] and not got[(10, 2)]["reparameterised"]
    assert decontam.contaminated(docs, bench(spark), block=3).count() == 3
    assert decontam.contaminated(docs.filter("false"), bench(spark)).count() == 0
    assert decontam.contaminated(docs, bench(spark).filter("false")).count() == 0


WORDY = ("the quiet harbour master counted seventeen wooden boats before breakfast while two gulls argued "
         "over bread near an old lighthouse that nobody had painted since spring").split()


@pytest.mark.parametrize("n", [9, 12, 16, 20, 22, 26])
def test_decontamination_finds_edited_copies(spark, n):
    item = WORDY[:n]
    mid, third = n // 2, n // 3
    edits = [item[:mid] + ["however"] + item[mid:], item[:mid] + item[mid + 1:],
             item[:mid] + ["however"] + item[mid + 1:]]
    if n >= 16:
        edits.append(item[:third] + ["well"] + item[third:2 * third] + ["so"] + item[2 * third:])
    if n >= 26:
        edits.append(["nothing"] * 30 + item[4:17] + ["else"] * 30)
    docs = spark.createDataFrame([(k, "once " + " ".join(e) + " again") for k, e in enumerate(edits)]
                                 + [(99, " ".join(item[:4] + ["x"] * 30 + item[-4:]))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"] for r in rows(decontam.contaminated(docs, bench))}
    assert got == set(range(len(edits)))


def test_decontamination_slots_that_conflict_or_coincide(spark):
    trip, sum_ = bench(spark).first()["text"], (
        "A baker sells 12 loaves in the morning and 8 rolls in the evening, then buys 2 sacks of "
        "flour and 2 jars of salt. How much does he carry home?")
    names = ("Last week Anna, Bert and Carla met Dora near Essen, while Felix, Georg and Hanna "
             "waited for Ida and then walked home with Jonas and his old dog")
    docs = spark.createDataFrame([
        (1, trip.replace("from Paris", "from Lyon")),
        (2, sum_.replace("12", "9").replace(" 8 ", " 9 ")),
        (3, sum_.replace("2 sacks", "3 sacks").replace("2 jars", "4 jars")),
        (4, names.upper()), (5, names.lower()), (6, names)], "doc_id long, text string")
    items = spark.createDataFrame([(1, trip), (2, sum_), (3, names)],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"]
           for r in rows(decontam.contaminated(docs, items))}
    assert got == {(1, 1): True, (2, 2): True, (3, 2): True, (4, 3): False, (5, 3): False,
                   (6, 3): False}


def test_decontamination_finds_short_items(spark):
    items = spark.createDataFrame([
        (1, "What is 12 + 30?"), (2, "2 + 2 = 4"), (3, "What is the capital of France?"),
        (4, "Solve 3 x"), (5, "7 km")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Exam. Question: what is 12 + 30? Answer below"), (2, "What is 12 - 30?"),
        (3, "so 2+2=4 holds"), (4, 'He asked: "What is the capital of Peru?"'),
        (5, "Question What is the capital of Peru"), (6, "Berlin is the capital of Germany"),
        (7, "To solve 3 x we divide"), (8, "Solve 3 x\nthen stop"), (9, "7 km"),
        (10, "ran 7 km today"), (11, "Question: What is the capital of France?"), (12, "What is")],
        "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in rows(decontam.contaminated(docs, items))}
    assert got == {(1, 1), (3, 2), (4, 3), (5, 3), (8, 4), (9, 5), (11, 3)}


def test_decontamination_against_brute_force(spark, sf_dir):
    items = rows(table(spark, sf_dir, "benchmark"))
    grams = defaultdict(set)
    for b in items:
        w = words(re.sub(r"[^\w\s]", " ", b["text"]))
        for k in range(len(w) - 7):
            grams[tuple(w[k:k + 8])].add((b["item_id"], k))
    want = set()
    for d in rows(table(spark, sf_dir, "documents")):
        w = words(re.sub(r"[^\w\s]", " ", d["text"] or ""))
        seen = defaultdict(set)
        for k in range(len(w) - 7):
            for i, p in grams.get(tuple(w[k:k + 8]), ()):
                seen[i].add(p)
        n = {b["item_id"]: len(words(re.sub(r"[^\w\s]", " ", b["text"]))) - 7 for b in items}
        want |= {(d["doc_id"], i) for i, p in seen.items() if len(p) >= 0.6 * n[i]}
    got = {(r["doc_id"], r["item_id"]) for r in rows(queries.op2_decontamination(spark, sf_dir))}
    assert want and want <= got
    assert len(got - want) <= 0.1 * len(want)


# ---------------------------------------------------------------- 3 packing

def check_packing(pieces, texts, size=4096):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    ids = [np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
           for _, t in texts]
    want = Counter((d, len(x), zlib.crc32(x[:size].tobytes())) for (d, _), x in zip(texts, ids))
    got = Counter((p["doc_id"], p["doc_tokens"], p["ids_crc32"]) for p in pieces if p["start"] == 0)
    assert got == want
    assert sum(p["length"] for p in pieces) == sum(map(len, ids))
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(seqs) == list(range(len(seqs)))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= size
    return sum(map(len, ids)) / (size * max(1, len(seqs)))


def test_packing(spark, sf_dir, odd, none):
    docs = table(spark, sf_dir, "documents")
    texts = [(r["doc_id"], r["text"]) for r in rows(docs)]
    assert check_packing(rows(queries.op3_packing(spark, sf_dir)), texts) > 0.98
    check_packing(rows(packing.pack(odd, packing.vocabulary_path())), ODD_TEXTS)
    assert packing.pack(none, packing.vocabulary_path()).count() == 0


def test_shortest_pack_first_is_the_sequential_rule():
    rng = np.random.default_rng(3)
    for cap in (7, 64):
        hist = {int(x): int(rng.integers(1, 40)) for x in rng.integers(1, cap + 1, 12)}
        packs = []
        for n in sorted(hist, reverse=True):
            for _ in range(hist[n]):
                low = min(range(len(packs)), key=packs.__getitem__, default=None)
                if low is None or packs[low] + n > cap:
                    packs.append(n)
                else:
                    packs[low] += n
        got = defaultdict(int)
        ends = defaultdict(int)
        for p in packing.shortest_pack_first(hist, cap):
            ends[p.length] = max(ends[p.length], p.rank)
        placed = sorted(packing.shortest_pack_first(hist, cap), key=lambda p: (p.length, p.rank))
        for k, p in enumerate(placed):
            last = k + 1 == len(placed) or placed[k + 1].length != p.length
            upto = hist[p.length] if last else placed[k + 1].rank
            for r in range(p.rank, upto):
                got[p.sequence + (r - p.rank) // p.times] += p.length
        assert sorted(got.values()) == sorted(packs)


# ---------------------------------------------------------------- 4 quality rules

def measures(text):
    t = text or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = set()
    for k in range(len(w) - 7):
        if win[tuple(w[k:k + 8])] > 1:
            hit.update(range(k, k + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit))


def test_rule_measures(spark, sf_dir, odd, none):
    extra = spark.createDataFrame(
        [(20, "a b c d e f g h i a b c d e f g h x\nq\nq\n \nq"), (21, "w " * 9), (22, "w " * 8),
         (23, "a|b #$%&<>* \U0001f600 \n\n"), (24, "x" * 50_000)], "doc_id long, text string")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for d in (table(spark, sf_dir, "documents"), odd, extra):
        want = Counter((r["doc_id"], *measures(r["text"])) for r in rows(d))
        got = Counter((r["doc_id"], *(r[c] for c in cols)) for r in rows(rules.measure(d)))
        assert got == want
    labels = spark.createDataFrame([(5, 0), (None, 1)], "doc_id long, quality int")
    assert rules.decide(odd, labels).count() == len(ODD_TEXTS)
    assert rules.decide(none, labels.filter("false")).count() == 0


def test_rules_keep_good_and_drop_bad(spark, sf_dir):
    got = queries.op4_quality_rules(spark, sf_dir)
    lab = table(spark, sf_dir, "labels")
    q = {(r["quality"], r["kept"]): r["n"] for r in rows(
        got.filter("not base_failed").join(lab, "doc_id").groupBy("quality", "kept")
        .agg(F.count(F.lit(1)).alias("n")))}
    assert q[(1, True)] >= 0.99 * (q[(1, True)] + q.get((1, False), 0))
    assert q.get((0, False), 0) >= 0.8 * (q.get((0, True), 0) + q.get((0, False), 0))
    assert got.filter("base_failed and kept").count() == 0


# ---------------------------------------------------------------- 5 sharding

def check_shards(got, texts, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards
    for s in by.values():
        assert sorted(s) == list(range(len(s)))
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    return [load[k] for k in range(shards)]


def test_sharding(spark, sf_dir, odd, none):
    docs = table(spark, sf_dir, "documents")
    texts = [(r["doc_id"], r["text"]) for r in rows(docs)]
    big = max(len((t or "").encode()) for _, t in texts)
    load = check_shards(rows(queries.op5_sharding(spark, sf_dir)), texts, 16)
    assert max(load) - min(load) <= 4 * big
    check_shards(rows(kdshard.shard(odd, shards=5)), ODD_TEXTS, 5)
    assert kdshard.shard(none).count() == 0
    same = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("one text of many copies")).otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    load = check_shards(rows(kdshard.shard(same, shards=7)),
                        [(r["doc_id"], r["text"]) for r in rows(same)], 7)
    assert max(load) - min(load) <= 0.05 * sum(load) / 7
    assert len({r["shard"] for r in rows(kdshard.shard(same, target_bytes=10_000))}) == round(
        sum(load) / 10_000)


def test_rows_that_repeat_a_document_are_parted(spark):
    """A sixth of the rows, nearly nine tenths of the bytes, are one document (or have no id)."""
    for hot in (7, None):
        data = [(k, f"text {k} " + "x" * (k % 29)) for k in range(1998)] + [(hot, "y" * 1000)] * 400
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
        load = check_shards(rows(kdshard.shard(docs, shards=16)), data, 16)
        assert max(load) <= 1.1 * min(load)


def test_number_rows_is_gapless(spark):
    d = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = defaultdict(list)
    for r in rows(number_rows(d, ["k"], ["id"], "n", buckets=7)):
        got[r["k"]].append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


# ---------------------------------------------------------------- 6 cross-entropy difference

def brute_losses(texts, target):
    def grams(t):
        c = "\0\0\0" + re.sub(r"\s+", " ", (t or "").lower()).strip()
        return [c[k:k + 4] for k in range(len(c) - 3)]
    vocab = {ch for t in texts for ch in grams(t) for ch in ch[-1]}
    out = []
    for side in (target, [True] * len(texts)):
        n = [Counter() for _ in range(5)]
        for t, use in zip(texts, side):
            if use:
                for g in grams(t):
                    for k in range(1, 5):
                        n[k][g[-k:]] += 1
        ctx, kinds = [Counter() for _ in range(5)], [Counter() for _ in range(5)]
        for k in range(1, 5):
            for g, c in n[k].items():
                ctx[k][g[:-1]] += c
                kinds[k][g[:-1]] += 1

        def p(g, k):
            low = 1 / (len(vocab) + 1) if k == 1 else p(g, k - 1)
            h = g[-k:-1] if k > 1 else ""
            if not ctx[k][h]:
                return low
            return (n[k][g[-k:]] + kinds[k][h] * low) / (ctx[k][h] + kinds[k][h])
        out.append([np.mean([-np.log2(p(g, 4)) for g in grams(t)]) if grams(t) else None
                    for t in texts])
    return out


def test_cross_entropy_difference(spark, none):
    texts = [None, "", "abc abd", "ABC  abd\n", "the cat", "the dog sat", "zzz", "x" * 300,
             "你好 \U0001f600"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = spark.createDataFrame([(4,), (5,), (5,), (None,), (99,)], "doc_id long")
    t, b = brute_losses(texts, [i in (4, 5) for i in range(len(texts))])
    vocab = crossent.vocabulary(docs)
    marked = docs.withColumn("is_target", F.col("doc_id").isin(4, 5))
    model = crossent.estimate(crossent.counts(marked, vocab), len(vocab) + 1)
    for got in (crossent.cross_entropy_difference(docs, ids),
                crossent.score(docs, model, vocab, block=7)):
        for r in rows(got):
            if t[r["doc_id"]] is None:
                assert r["n_tokens"] == 0 and r["score"] is None
            else:
                assert r["xent_target"] == pytest.approx(t[r["doc_id"]], rel=1e-5)
                assert r["xent_background"] == pytest.approx(b[r["doc_id"]], rel=1e-5)
    assert crossent.cross_entropy_difference(none, ids).count() == 0


# ---------------------------------------------------------------- 7 main text

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";'
        '</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a>'
        '</ul></nav><div class="ad">Buy</div><div id="cookie-notice">We use cookies</div><article>'
        '<h1>Title {0}</h1><p>One &amp; two&nbsp;{0}\n  three<br>four<p>Next <b>bold</b>{0}'
        '<aside>Side</aside><form><input>Name</form><table><tr><td>a<td>b</table></article>'
        '<section class="comments"><p>First!</p></section><footer>&copy; me</footer></body></html>')


def test_main_text(spark):
    data = [(k, f"https://Host.example/{k}", PAGE.format(k)) for k in range(8)]
    data += [(100, "https://b.example/", None), (101, None, ""), (102, "x", "just text < b"),
             (None, "https://Host.example/9", PAGE.format("n")), (7, data[7][1], data[7][2]),
             (103, "https://b.example/", "<article><p>cut of"), (104, "u", "<div class='ad'>x")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = rows(template.main_text(pages))
    assert len(got) == len(data) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3] == "Title 3\nOne & two 3 three four\nNext bold3\na\nb"
    assert text[None] == "Title n\nOne & two n three four\nNext boldn\na\nb"
    assert (text[100], text[101], text[102], text[103], text[104]) == (
        "", "", "just text < b", "cut of", "")
    assert template.main_text(pages.filter("false")).count() == 0


def test_template_removes_constant_text(spark):
    html = "<body><div>Welcome to the site</div><div><p>Body {0}</p><p>More {0}</p></div><div>End</div>"
    pages = spark.createDataFrame([(k, f"http://h/{k}", html.format(k)) for k in range(6)],
                                  "page_id long, url string, html string")
    assert {r["text"] for r in rows(template.main_text(pages))} == {
        f"Body {k}\nMore {k}" for k in range(6)}
    few = pages.filter("page_id < 3")
    assert all(r["text"].startswith("Welcome") for r in rows(template.main_text(few)))


def test_pages_whose_hashes_share_their_low_bits(spark):
    page = "<div>Welcome</div><div><p>Body</p></div><div>End</div><i>{0}</i>"
    low: dict[int, str] = {}
    for k in range(400_000):
        source = page.format(k)
        twin = low.setdefault(template._hash(source) & 0x7FFFFFFF, source)
        if twin != source:
            break
    else:
        pytest.skip("no two hashes share 31 bits")
    sources = [source, twin, *(page.format(f"x{k}") for k in range(4))]
    pages = spark.createDataFrame([(k, f"http://h/{k}", x) for k, x in enumerate(sources)],
                                  "page_id long, url string, html string")
    got = template.templates(template._pages(pages)).first()
    assert got["pages"] == 6


def test_template_of_layouts_and_optional_boxes(spark):
    box = "<div><h3>Letter</h3><b>Join us</b><hr>Mail</div>"
    post = "<html><body><article><h1>T{0}</h1><p>Body {0}</p>" + "{1}</article></body></html>"
    listing = ("<html><body><table><tr><td>All posts</td></tr><tr><td>Hit {0}</td></tr><caption>By date"
               "</caption></table><dl><dt>End of list</dt></dl></body></html>")
    data = [("a", post.format(k, box if k else "")) for k in range(24)]
    data += [("b", listing.format(k)) for k in range(6)]
    data += [("b", post.format(k, "")) for k in range(6)] + [("b", "<p>Error")]
    # the same article under other titles is no template
    data += [("c", f"<html><title>{k}</title><body><article><p>x{'<p>y' * (k % 2)}<p>Same one<p>Same two"
                   f"<p>Same three</article><i>{k}</i>") for k in range(24)]
    data += [("c", post.format(k, "")) for k in range(4)]
    pages = spark.createDataFrame([(k, f"http://{h}/{k}", x) for k, (h, x) in enumerate(data)],
                                  "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in rows(template.main_text(pages))}
    assert [text[k] for k in range(24)] == [f"T{k}\nBody {k}" for k in range(24)]
    assert [text[k] for k in range(24, 30)] == [f"Hit {k}" for k in range(6)]
    assert [text[k] for k in range(30, 36)] == [f"T{k}\nBody {k}" for k in range(6)]
    assert text[36] == "Error"
    assert all(text[k].endswith("Same one\nSame two\nSame three") for k in range(37, 61))


@pytest.mark.parametrize("html", [
    "<body class='single comments-open'>{0}</body>", "<div class='site has-sidebar'>{0}</div>",
    "<div class='layout with-header'>{0}</div>", "<div class='no-sidebar'>{0}</div>",
    "<form>{0}</form>", "<div class='sidebar'><div class=widget>{0}</div></div>",
    "<main class=comments>{0}</main>",
    "{0}<div class='comment-list'><article class=comment>First!</article></div>",
    "{0}<div id=comments>Reply</div><div class='cookie-notice'>We use</div>"])
def test_wrappers_do_not_hide_the_article(html):
    inner = ("<article class='post has-comments'>One<div class='related'>More</div><form>Name</form>"
             "<p class='no-share'>Two</p></article>")
    assert [t for _, t in template.Page(html.format(inner)).candidates()[1]] == ["One", "Two"]
    assert template.Page("<div class='x comments'>Hi</div>Text").candidates() == (
        False, [("", "Text")])


def test_main_text_is_the_article(spark, sf_dir):
    for p, r in zip(sorted(rows(table(spark, sf_dir, "pages")), key=lambda r: r["page_id"]),
                    sorted(rows(queries.op7_main_text(spark, sf_dir)), key=lambda r: r["page_id"])):
        import html
        body = p["html"].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", body)))
        want = "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in parts) if x)
        assert r["text"] == want


# ---------------------------------------------------------------- 8 language

def test_language(spark, sf_dir, odd, none):
    docs = table(spark, sf_dir, "documents")
    got = queries.op8_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")),
                                   F.min("score"), F.max("score")).first()
    assert r[0] >= 0.97 and 0 <= r[1] <= r[2] <= 1
    model = langid.fit(docs)
    out = rows(odd.select("doc_id", langid.predict(odd, model).alias("p")))
    assert {r["doc_id"] for r in out if r["p"]["lang_pred"] == "und"} == {1, 2, 3, 8}
    for text in ("² ½ ①", "Ⅷ 12 ٣", "_-_"):
        assert langid.features(text) is None
    assert langid.features("² a") is not None
    assert langid.fit(none).langs == []
    assert rows(odd.select(langid.predict(odd, langid.Model()).alias("p")))[0]["p"][0] == "und"


# ---------------------------------------------------------------- 9 quality classifier

def test_quality_classifier(spark, sf_dir, odd, none):
    got = queries.op9_quality_classifier(spark, sf_dir)
    lab = table(spark, sf_dir, "labels")
    r = got.filter("held_out").join(lab, "doc_id").agg(
        F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()
    assert r[0] >= 0.95
    labels = spark.createDataFrame([(4, 1), (8, 0), (6, 0), (6, 1), (None, 1), (7, None)],
                                   "doc_id long, quality int")
    w = quality.fit(odd, labels)
    assert all(0 <= r["s"] <= 1 for r in rows(odd.select(quality.score(odd, w).alias("s"))))
    zero = quality.fit(none, labels)
    assert not zero.any()
    assert none.select(quality.score(none, zero)).count() == 0


# ---------------------------------------------------------------- 10 near duplicates

def brute_components(docs, width):
    sets = []
    for _, t in docs:
        w = words(t)
        n = min(width, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and min(
                    len(a), len(b)) * 5 >= 4 * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= 80 * (len(a) + len(b) - k):
                    up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), None if d is None else least[find(i)])
                   for i, (d, _) in enumerate(docs))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, sf_dir, odd, none, width):
    docs = [(r["doc_id"], r["text"]) for r in rows(table(spark, sf_dir, "documents"))]
    base = [f"w{k}" for k in range(120)]
    rng = np.random.default_rng(5)
    for k in range(150):  # a group whose members are mostly too far from each other
        w = list(base)
        for i in rng.choice(120, rng.integers(0, 9), replace=False):
            w[i] = f"e{rng.integers(0, 400)}"
        docs.append((10_000 + k, " ".join(w)))
    docs += [(20_000 + k, t) for k, t in enumerate(["a b c", "a b c", "A b c", "a b d", "a"])]
    docs += ODD_TEXTS
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in rows(minhash.near_duplicates(d, width)))
    assert got == brute_components(docs, width)
    assert minhash.near_duplicates(none, width).count() == 0


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 102), (102, 101)],
                              "a long, b long")
    got = {r["node"]: r["component"] for r in rows(minhash.components(e))}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}
