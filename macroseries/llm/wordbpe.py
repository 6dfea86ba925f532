"""Token ids of whole texts for vocabularies whose tokens never cross white space.

Such a tokenizer gives a run of characters without white space the same ids wherever it stands. So a
text is normalised, split at white space, and the ids of each run are looked up; the tokenizers
library encodes runs that are new, many in one call. Texts with characters outside the ranges below,
and vocabularies whose file asks for another normaliser, splitter or model, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np

from macroseries.llm.common import held_by_worker

#: Most runs, and most pieces of runs, kept by one Python worker (about 200 bytes each).
RUNS, PIECES = 1_000_000, 300_000
TOGETHER = 1 << 18
# fixed values: what a vocabulary file must ask for to be split at white space here
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"}]}
# fixed values: the same splitter, for text up to U+024F and common punctuation
_OTHER = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞€]|<\|")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[\d\xb2\xb3\xb9\xbc-\xbe]"
                    r"|(?:[^\s\w]|_)+")


def splits_at_space(path: str) -> bool:
    """Does the vocabulary file ask for the normaliser, splitter and model that this module knows?"""
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    split = conf.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [{}])[0]
    model = conf.get("model") or {}
    return (conf.get("normalizer") == NORMALIZER and first.get("type") == "Split"
            and first.get("pattern") == {"Regex": SPLITTER} and bool(first.get("invert"))
            and first.get("behavior") == "Removed" and len(split["pretokenizers"]) == 2
            and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>"
            and not model.get("dropout") and not model.get("ignore_merges"))


def _oldest(kept: dict) -> dict:
    """The half that came first: common runs come early, so the table keeps most of its use."""
    return dict(islice(kept.items(), len(kept) // 2))


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes (no special tokens added)."""

    def __init__(self, path: str, runs: int = RUNS, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.split = splits_at_space(path)
        # the same model (not a copy) for pieces, which are normalised and split here
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.max_runs, self.max_pieces = runs, pieces
        self.runs: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def _learn_pieces(self, new: list[str]) -> None:
        """Pieces joined by spaces are encoded in one call; a piece ends with its last token."""
        got = self.model.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0]
        ids = np.array(got.ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new) or (len(ends) and ends[-1] != len(ids)):
            self.pieces.update(zip(new, self._whole(new)))
            return
        data, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        self.pieces.update(zip(new, [data[a:b] for a, b in zip(at, at[1:])]))

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of runs that are not kept yet; they are kept from now on."""
        cut = [(w, _PIECE.findall(w)) for w in new]
        kept = self.pieces
        lack = list({p for _, c in cut for p in c if p not in kept})
        if lack:
            self._learn_pieces(lack)
        got = {w: kept[c[0]] if len(c) == 1 else b"".join([kept[p] for p in c]) for w, c in cut}
        self.runs.update(got)
        if len(self.runs) > self.max_runs:
            self.runs = _oldest(self.runs)
        if len(kept) > self.max_pieces:
            self.pieces = _oldest(kept)
        return got

    def _split(self, texts: list[str]) -> list[bytes]:
        lack, found = [], []
        for text in texts:
            words = unicodedata.normalize("NFC", text).lower().split()
            got = list(map(self.runs.get, words))
            if None in got:
                lack.append((got, [(i, words[i]) for i, g in enumerate(got) if g is None]))
            found.append(got)
        if lack:
            new = self._learn({w for _, at in lack for _, w in at})
            for got, at in lack:
                for i, w in at:
                    got[i] = new[w]
        return [b"".join(got) for got in found]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order. About ``TOGETHER`` characters are encoded at a time."""
        batch: list[str] = []
        size = 0
        for text in texts:
            if not self.split or _OTHER.search(text):
                yield from self._split(batch)
                batch, size = [], 0
                yield from self._whole([text])
                continue
            batch.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._split(batch)
                batch, size = [], 0
        yield from self._split(batch)


def word_encoder(path: str, runs: int = RUNS, pieces: int = PIECES) -> WordEncoder:
    """One encoder per Python worker: what it keeps serves the tasks that follow."""
    return held_by_worker(WordEncoder, path, runs, pieces)
