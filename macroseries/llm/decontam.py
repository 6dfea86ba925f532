"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: lower-cased words stay literal; numbers, units that
stand by a number and names (runs of capitalised words inside a sentence) become typed placeholders
whose values are kept as slots. Windows of ``WINDOW`` template tokens with at least ``LITERALS``
literal ones are hashed and looked up in each document. Every hit names an alignment of document and
item, on which the two are compared token by token; alignments that lie near each other (words were
added or left out) are judged together. An item is held when the document has half of its windows,
three quarters of its tokens, or a passage of ``PASSAGE`` literal tokens without a gap. A name stands
for one document value, the one it has most often (its own, if as often as any); where it has another,
the token doesn't match. Numbers and units are free: equal ones may be different parameters, different
ones may become equal. So a verbatim copy, an edited one and a question whose numbers, names or units
were exchanged throughout are all caught, a chance mix of names is not.

Which words are names depends on their case, so the lower-cased tokens, all of them literal, are
windowed and compared in the same way: a copy in capitals or small letters is found by those, and so
is any short item or one of numbers, which is one window. An item of less than ``LITERALS`` tokens is
held where it stands between stops (a sentence, a line, a quotation), not as a part of other words.

The benchmark goes out in blocks of whole items, about ``BLOCK`` windows each, so each broadcast is
bounded; documents only send the items they hold.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroseries.llm.common import U64, held_by_worker, mix, write_once

WINDOW, LITERALS = 8, 4
MIN_COVERAGE, TOKEN_COVERAGE, PASSAGE, RUN = 0.5, 0.75, 13, 3
CHUNK = 1 << 20
BLOCK = 1 << 20
CACHE = 400_000
# brackets, quotes and colons end a sentence as full stops do: the word behind them is no name
_STOPS = ".!?\n:;…\"'“”„‘’«»()[]{}¿¡"
_OPERATORS = "+-−*×·/÷=<>≤≥^"
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|["
                    + re.escape(_STOPS) + r"]+|[%$€£¥°]|[" + re.escape(_OPERATORS) + "]")
# fixed values: units recognised beside a number
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms "
    "pound pounds ounce ounces ton tons tonne tonnes ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years mph kph hz khz mhz ghz w kw v a j kj cal kcal c f k degree degrees percent dollar "
    "dollars cent cents euro euros usd eur gbp kb mb gb tb bit bits byte bytes".split())
_SIGNS = frozenset("% $ € £ ¥ °".split())
_WORD, _CAP, _NUM, _UNIT, _STOP, _SIGN = range(6)
_NAME, _OP = 6, 7
_PLACE = mix(np.arange(1001, 1008, dtype=U64))
_STEP = U64(0x9FB21C651E98DF25)


class _Tokens:
    """Class and hash of each distinct token; forgotten when ``CACHE`` distinct ones are held."""

    def __init__(self):
        self.seen: dict[str, int] = {}
        self.hash = np.zeros(0, dtype=U64)
        self.kind = np.zeros(0, dtype=np.int8)

    @staticmethod
    def _kind(t: str, low: str) -> int:
        if t[0].isdigit():
            return _NUM
        if t in _SIGNS:
            return _SIGN
        if t[0] in _STOPS:
            return _STOP
        if t in _OPERATORS:
            return _OP
        if low in UNITS:
            return _UNIT
        return _CAP if len(t) > 1 and t[0].isupper() and t[1:] == low[1:] else _WORD

    def ids(self, toks: list[str]) -> np.ndarray:
        seen = self.seen
        try:
            return np.array([seen[t] for t in toks], dtype=np.int64)
        except KeyError:
            if len(seen) > CACHE:
                self.__init__()
                seen = self.seen
        new = [t for t in dict.fromkeys(toks) if t not in seen]
        n = len(seen)
        if n + len(new) > len(self.hash):
            room = 2 * (n + len(new))
            self.hash = np.concatenate([self.hash[:n], np.zeros(room - n, dtype=U64)])
            self.kind = np.concatenate([self.kind[:n], np.zeros(room - n, dtype=np.int8)])
        for k, t in enumerate(new, n):
            low = t.lower()
            seen[t] = k
            self.hash[k] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass"))
            self.kind[k] = self._kind(t, low)
        return np.array([seen[t] for t in toks], dtype=np.int64)


def _tokens() -> _Tokens:
    """One table per Python worker: its tokens serve the tasks that follow."""
    return held_by_worker(_Tokens)


class Sequence(NamedTuple):
    """Tokens of texts laid end to end; text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``."""
    h: np.ndarray
    slot: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    last: np.ndarray
    opens: np.ndarray


class Parsed:
    """Texts as a sequence of template tokens and one of lower-cased tokens."""

    def __init__(self, texts: list, tokens: _Tokens):
        self.toks: list[str] = []
        size = []
        for t in texts:
            got = _TOKEN.findall(t or "")
            self.toks += got
            self.toks.append("\n")
            size.append(len(got) + 1)
        ids = tokens.ids(self.toks)
        kind, h = tokens.kind[ids], tokens.hash[ids]
        text = np.repeat(np.arange(len(size)), size)
        each = np.arange(len(size) + 1)
        # operators are tokens beside a number only, and of the lower-cased tokens only
        at = np.flatnonzero(kind != _OP)
        k = kind[at]
        before = np.concatenate([[_STOP], k[:-1]])
        after = np.concatenate([k[1:], [_STOP]])
        s = np.full(len(k), -1, dtype=np.int8)
        s[k == _NUM] = _NUM
        s[(k == _UNIT) & ((before == _NUM) | (before == _SIGN))] = _UNIT
        s[(k == _SIGN) & ((before == _NUM) | (after == _NUM))] = _UNIT
        s[(k == _CAP) & (before != _STOP)] = _NAME
        keep = (k != _STOP) & ~((k == _SIGN) & (s < 0))
        at, s = at[keep], s[keep]
        starts = np.flatnonzero(~((s == _NAME) & (np.concatenate([[-1], s[:-1]]) == _NAME)))
        out = mix(h[at[starts]])
        slot = s[starts]
        out[slot >= 0] = _PLACE[slot[slot >= 0]]
        first = at[starts]
        self.template = Sequence(out, slot, np.searchsorted(text[first], each), first,
                                 at[np.append(starts, len(at))[1:] - 1],
                                 (kind[first] == _CAP) & (slot < 0))
        used = np.zeros(len(kind), dtype=bool)
        used[at] = True
        near = np.zeros(len(kind), dtype=bool)
        near[1:] |= kind[:-1] == _NUM
        near[:-1] |= kind[1:] == _NUM
        at = np.flatnonzero(used | ((kind == _OP) & near))
        self.folded = Sequence(mix(h[at]), np.full(len(at), -1, dtype=np.int8),
                               np.searchsorted(text[at], each), at, at,
                               np.zeros(len(at), dtype=bool))
        self.stop = kind == _STOP

    def value(self, view: Sequence, k: int) -> str:
        return " ".join(t.lower() for t in self.toks[view.first[k]:view.last[k] + 1])

    def alone(self, view: Sequence, lo: int, hi: int) -> bool:
        """Whether nothing but stops stands beside tokens ``lo`` to ``hi``."""
        a, b = view.first[lo], view.last[hi - 1]
        return (a == 0 or self.stop[a - 1]) and self.stop[b + 1]


def windows(h: np.ndarray, widths: set[int]):
    """(width, hashes) of the windows of each of ``widths`` tokens."""
    acc = np.zeros(len(h), dtype=U64)
    for w in range(1, max(widths, default=0) + 1):
        n = len(h) - w + 1
        if n <= 0:
            return
        acc = acc[:n] * _STEP + h[w - 1:]
        if w in widths:
            yield w, mix(acc + U64(w))


def _width(n: int) -> int:
    """Items of up to ``WINDOW`` tokens are one window; those of a longer one are a third of it, so
    that two words more in it leave a window whole."""
    return n if n <= WINDOW else min(WINDOW, max(LITERALS, n // 3))


def _inside(ok: np.ndarray, w: int) -> np.ndarray:
    """Where ``w`` values from here on are all true."""
    run = np.concatenate([[0], np.cumsum(ok)])
    return run[w:] - run[:-w] == w


def _spread(ok: np.ndarray, w: int) -> np.ndarray:
    """The values covered by runs of at least ``w`` true ones."""
    out = np.zeros(len(ok), dtype=bool)
    start = _inside(ok, w)
    for k in range(w):
        out[k:k + len(start)] |= start
    return out


class Item(NamedTuple):
    h: np.ndarray
    literal: np.ndarray
    slots: dict[int, str]
    name: np.ndarray
    width: int
    allowed: np.ndarray
    opens: dict[int, str]


class Index:
    """Windows of a block of items: sorted hashes with item and position, and the items' tokens."""

    def __init__(self, parsed: Parsed, view: Sequence):
        self.items: list[Item] = []
        rows: dict[int, list] = {}
        for k, (lo, hi) in enumerate(zip(view.bounds[:-1], view.bounds[1:])):
            n, w = int(hi - lo), _width(int(hi - lo))
            kinds = view.slot[lo:hi]
            lit = np.concatenate([[0], np.cumsum(kinds < 0)])
            allowed = lit[w:] - lit[:-w] >= (
                1 if view is parsed.folded else LITERALS) if n else np.zeros(0, dtype=bool)
            opens = {int(p): parsed.value(view, lo + p) for p in np.flatnonzero(view.opens[lo:hi])}
            self.items.append(Item(view.h[lo:hi], kinds < 0,
                                   {int(p): parsed.value(view, lo + p)
                                    for p in np.flatnonzero(kinds >= 0)}, kinds == _NAME, w, allowed,
                                   opens))
            pos = np.flatnonzero(allowed)
            seeds = [view.h[lo:hi]]
            if n and opens:
                # the word that opens a sentence reads as a name where no stop stands before it
                seeds.append(np.where(view.opens[lo:hi], _PLACE[_NAME], view.h[lo:hi]))
            for _, got in (x for h in seeds for x in windows(h, {w})):
                rows.setdefault(w, []).append((got[pos], np.full(len(pos), k), pos))
        self.widths = {}
        for w, parts in rows.items():
            h, item, pos = (np.concatenate(x) for x in zip(*parts))
            o = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, dtype=bool)
            seen[h >> U64(44)] = True
            self.widths[w] = (h[o], item[o], pos[o], seen)

    def hits(self, view: Sequence) -> dict[tuple[int, int], set[int]]:
        """The alignments (first token in the text) per (text, item) of every window that matches."""
        out: dict[tuple[int, int], set[int]] = {}
        text = np.repeat(np.arange(len(view.bounds) - 1), np.diff(view.bounds))
        for w, got in windows(view.h, set(self.widths)):
            want, item, pos, seen = self.widths[w]
            p = np.flatnonzero(seen[got >> U64(44)] & (text[:len(got)] == text[w - 1:]))
            lo, hi = np.searchsorted(want, got[p]), np.searchsorted(want, got[p], side="right")
            for a, x, y in zip(p[hi > lo], lo[hi > lo], hi[hi > lo]):
                t = int(text[a])
                for k in range(x, y):
                    out.setdefault((t, int(item[k])), set()).add(
                        int(a) - int(view.bounds[t]) - int(pos[k]))
        return out

    def held(self, parsed: Parsed, view: Sequence, min_coverage: float):
        """(text, item, coverage, no slot differs, windows matched, windows) of every item held."""
        for (t, k), shifts in self.hits(view).items():
            item = self.items[k]
            lo, hi = view.bounds[t], view.bounds[t + 1]
            best = None
            order, upto = sorted(shifts), -1
            for i, s in enumerate(order):
                j = bisect_right(order, s + max(WINDOW, len(item.h) // 2))
                if j <= upto:
                    continue
                upto = j
                near = order[i:j]
                if len(item.h) < LITERALS:
                    near = [x for x in near if parsed.alone(view, lo + x, lo + x + len(item.h))]
                got = near and _judge(item, view.h[lo:hi], lambda p: parsed.value(view, lo + p),
                                      near, min_coverage)
                if got and (best is None or got > best):
                    best = got
                if best and best[0] == len(item.h) and best[2]:
                    break
            if best:
                tokens, n, same = best
                yield t, k, tokens / len(item.h), same, n, int(item.allowed.sum())


def _judge(item: Item, doc: np.ndarray, value, shifts: list[int], min_coverage: float):
    """(tokens and windows of the item that the document has on the alignments ``shifts``, no slot
    differs); None when that is too little."""
    n = len(item.h)
    equal = []
    for s in shifts:
        lo, hi = max(0, -s), min(n, len(doc) - s)
        eq = np.zeros(n, dtype=bool)
        eq[lo:hi] = item.h[lo:hi] == doc[s + lo:s + hi]
        for p, word in item.opens.items():
            if lo <= p < hi and doc[s + p] == _PLACE[_NAME]:
                eq[p] = value(s + p).split()[-1] == word
        equal.append(_spread(eq, min(RUN, n)))
    pairs = [{int(p): value(s + p) for p in np.flatnonzero(eq & ~item.literal)}
             for s, eq in zip(shifts, equal)]
    names: dict[str, dict[str, set[int]]] = {}
    for of in pairs:
        for p, b in of.items():
            if item.name[p]:
                names.setdefault(item.slots[p], {}).setdefault(b, set()).add(p)
    stands = {}
    for a, to in names.items():
        most = max(map(len, to.values()))
        top = [b for b, at in to.items() if len(at) == most]
        stands[a] = a if a in top else top[0] if len(top) == 1 else None
    right, wrong = set(), set()
    for eq, of in zip(equal, pairs):
        for p in [p for p in of if item.name[p]]:
            if of[p] == stands[item.slots[p]]:
                right.add(p)
            else:
                wrong.add(p)
                eq[p] = False
                del of[p]
    windows_ = np.logical_or.reduce([_inside(eq, item.width) for eq in equal]) & item.allowed
    tokens = int(np.logical_or.reduce(equal).sum())
    if (windows_.sum() < min_coverage * item.allowed.sum()
            and (n <= WINDOW or tokens < TOKEN_COVERAGE * n or len(right) < len(wrong - right))
            and max(_passage(eq, item.literal) for eq in equal) < PASSAGE):
        return None
    return (tokens, int(windows_.sum()), not wrong - right and all(
        item.slots[p] == b for of in pairs for p, b in of.items()))


def _passage(ok: np.ndarray, literal: np.ndarray) -> int:
    """Literal tokens in the longest run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
    lit = np.concatenate([[0], np.cumsum(literal)])
    return int(max(lit[edges[1::2]] - lit[edges[::2]], default=0))


_HELD = ("doc_id bigint, item_id bigint, n_windows bigint, item_windows int, coverage double, "
         "reparameterised boolean, text_hash bigint, item_key bigint")


def _chunks(texts: list):
    """Slices of ``texts`` of about ``CHUNK`` characters."""
    lo = size = 0
    for k, t in enumerate(texts, 1):
        size += len(t or "")
        if size >= CHUNK or k == len(texts):
            yield lo, k
            lo, size = k, 0


def _search(docs: DataFrame, items: list, min_coverage: float) -> DataFrame:
    parsed = Parsed([r["text"] for r in items], _Tokens())
    shared = docs.sparkSession.sparkContext.broadcast(
        (Index(parsed, parsed.template), Index(parsed, parsed.folded),
         [(r["item_id"], r["item_key"]) for r in items]))

    def run(batches):
        tokens = _tokens()
        index, folded, keys = shared.value
        for b in batches:
            out = []
            texts = list(b["text"])
            for lo, hi in _chunks(texts):
                got = Parsed(texts[lo:hi], tokens)
                best: dict[tuple[int, int], tuple] = {}
                for t, k, *found in index.held(got, got.template, min_coverage):
                    best[t, k] = tuple(found)
                # lower-cased tokens know no slots: they say more only of a verbatim copy
                for t, k, *found in folded.held(got, got.folded, min_coverage):
                    if (t, k) not in best or found[0] == 1:
                        best[t, k] = tuple(found)
                for (t, k), (share, same, n, of) in best.items():
                    out.append((b["doc_id"].iloc[lo + t], keys[k][0], n, of, share, not same,
                                b["text_hash"].iloc[lo + t], keys[k][1]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _HELD.split(", ")]).astype(
                {"doc_id": "Int64", "item_id": "Int64"})
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64("text").alias("text_hash"), "text")
    return d.mapInPandas(run, _HELD)


def contaminated(docs: DataFrame, bench: DataFrame, min_coverage: float = MIN_COVERAGE,
                 block: int = BLOCK) -> DataFrame:
    """One row per document (doc_id, text) and benchmark item (item_id, text) that it holds:
    doc_id, item_id, n_windows (matched on near alignments), item_windows, coverage (share of the
    item's tokens), reparameterised (some slot differs), text_hash.

    NULL and empty texts hold nothing and are held by nothing; rows that repeat a document or an
    item count once; a NULL id is a value like any other; empty tables give an empty result."""
    items = write_once(bench.select(
        F.col("item_id").cast("long").alias("item_id"), "text",
        F.xxhash64("item_id", "text").alias("item_key")).dropDuplicates(["item_key"]), "bench-items")
    # a window takes at least two characters of a text, seldom less than four
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * block)))
    found = None
    for k in range(blocks):
        part = items.filter(F.pmod("item_key", F.lit(blocks)) == k).collect()
        if part:
            got = _search(docs, part, min_coverage)
            found = got if found is None else found.unionByName(got)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _HELD)
    return found.dropDuplicates(["doc_id", "text_hash", "item_id", "item_key"]).drop("item_key")
