"""Main-text extraction by equivalence-class template deduction.

Pages of one host come from one template. Per page, tokens are counted: tags with the path they stand
on, and text blocks with theirs. Tokens of a host with the same occurrence vector (as often on the
same pages) form an equivalence class; vectors are compared by two sums of hashes, so a hot host
is only counted, never gathered: what goes to one task are the tokens of its valid classes. A class is
valid when it is large and frequent enough. Classes on every page are the template's skeleton; one on
a part of the pages (a layout, an optional box) is template as well when it nests: every token of it
stands in an element that stands, down from the root, in elements of such classes. What is left
between template tokens are the slots. The main text is
the slots of the article: blocks that belong to the template, and regions for menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comments, are not content.

Text is taken as template only when its class is on ``MIN_PAGES`` pages of different html or more
(inside an article: ``MIN_ARTICLE_PAGES``), so copies of a page don't erase each other.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_PAGES, MIN_ARTICLE_PAGES, MIN_CLASS = 5, 20, 3
# fixed values: HTML elements by role
_RAW = frozenset("script style textarea title xmp noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_BOILER = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form frame head iframe input map menu "
    "nav noframes noscript object optgroup option script search select style svg template textarea "
    "title xmp".split())
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("article aside body div dl footer form header main nav ol section table td th "
                   "ul".split())
# fixed values: words of class, id and role attributes that mark boilerplate
_HINTS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs consent cookie "
    "cookies copyright dropdown footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices overlay pagination pager popup promo promoted "
    "recommendations recommended related share sharing sidebar signin signup skip social sponsor "
    "sponsored subscribe toolbar widget widgets complementary contentinfo alert".split())
_COMMENTS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
_HINTED = _HINTS | _COMMENTS
# fixed values: parts of such names that say nothing
_PLAIN = frozenset(
    "area bar block bottom box column container global group inner left list outer right section site "
    "slot text title top unit wrap wrapper".split())
_ARTICLE_WORDS = frozenset("article content entry main post story".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_INSIDE = re.compile(r"/(?:article|main)/")
_WORDS = re.compile(r"[a-z]+")
#: kinds of tokens
TAG, TEXT, ARTICLE_TAG = range(3)
#: a token that every page has: it counts a host's pages
PAGE = 0
TOKENS = "host string, token bigint, seen bigint, page bigint, parent bigint, kind int"
TEMPLATE = "host string, pages bigint, template array<bigint>, on array<bigint>"
CANDIDATES = ("page_id bigint, url string, host string, article boolean, tokens array<bigint>, "
              "body binary")
RESULT = "page_id bigint, url string, text string, n_chars bigint, n_slots int"


def host_of(url: str) -> Column:
    """Lower-cased host of a URL column, empty when there is none (or no URL)."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1),
                              F.lit("")))


def _hash(*parts: str) -> int:
    h = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) * (h >> 63)


def _hinted(words: str) -> bool:
    """Whether a class, id or role names boilerplate: as a whole, or by parts that all do
    (``cookie-notice``) or say nothing (``comment-list``); not ``has-sidebar``, ``comments-open``."""
    for word in words.lower().split():
        parts = _WORDS.findall(word)
        if not _HINTED.isdisjoint(parts) and all(p in _HINTED or p in _PLAIN for p in parts):
            return True
    return False


def _role(name: str, attrs: str, in_article: bool) -> int:
    """2: the article; 1: boilerplate; 3: boilerplate unless it wraps the article; 0: neither."""
    values = [m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)]
    words = {w for v in values for w in _WORDS.findall(v.lower())}
    if name in ("article", "main"):
        return 2
    if name == "form":
        return 3
    if name in _BOILER or name == "header" and not in_article:
        return 1
    if name not in ("html", "body") and any(map(_hinted, values)) and (
            words & _COMMENTS or not words & _ARTICLE_WORDS):
        return 3
    return 2 if words & {"articlebody"} else 0


def _element(path: str) -> int:
    """The token of the element at ``path``; 0 for the root."""
    return _hash(f"{path}<{path.rpartition('/')[2]}") if path else 0


class Page:
    """Blocks of a page in order: (path, text, in article, in boilerplate); and its tag tokens."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool, bool]] = []
        self.tags: dict[str, int] = {}
        self.parent: dict[str, str] = {}
        self._stack: list[tuple[str, int, str]] = []
        self._parts: list[str] = []
        self._article = self._boiler = 0
        # elements that are boilerplate unless they wrap the article: the open ones, and of each block
        self._soft: list[int] = []
        self._block_soft: list[tuple[int, ...]] = []
        self._n_soft = self._articles = 0
        self._wrapped: dict[int, int] = {}
        self._main: set[int] = set()
        at = 0
        find = _MARKUP.search
        while m := find(source, at):
            self._text(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(name)
            else:
                self._start(name, m[3])
                if name in _RAW:
                    close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                    at = close.start() if close else len(source)
        self._text(source[at:])
        self._flush()
        spared = {k for k, n in self._wrapped.items() if n == self._articles or k in self._main}
        self.blocks = [(path, text, a, b or any(k not in spared for k in soft))
                       for (path, text, a, b), soft in zip(self.blocks, self._block_soft)]

    def _text(self, raw: str) -> None:
        if raw:
            self._parts.append(entities.unescape(raw) if "&" in raw else raw)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            self._parts = []
            if text:
                path = self._stack[-1][2] if self._stack else ""
                self.blocks.append((path, text, self._article > 0, self._boiler > 0))
                self._block_soft.append(tuple(self._soft))

    def _pop(self, depth: int) -> None:
        while len(self._stack) > depth:
            _, role, _ = self._stack.pop()
            self._article -= role == 2
            self._boiler -= role == 1
            if role == 3:
                self._soft.pop()

    def _start(self, name: str, attrs: str) -> None:
        if name == "br":
            self._parts.append(" ")
            return
        if name in _BLOCK or name in _BOILER:
            self._flush()
        if closes := _CLOSES.get(name):
            for k in range(len(self._stack) - 1, -1, -1):
                if self._stack[k][0] in closes:
                    self._pop(k)
                    break
                if self._stack[k][0] in _SCOPE:
                    break
        if name in _BLOCK and self._stack and self._stack[-1][0] == "p":
            self._pop(len(self._stack) - 1)
        role = _role(name, attrs, self._article > 0)
        up = self._stack[-1][2] if self._stack else ""
        # inline elements, and what stands below 32 levels of them, don't lengthen the path
        path = f"{up}/{name}" if name in _BLOCK or name in _BOILER else up
        if path.count("/") > 32:
            path = up
        token = f"{path}<{name}"
        self.tags[token] = self.tags.get(token, 0) + 1
        self.parent[token] = up if path != up else path
        if name not in _VOID and not attrs.endswith("/"):
            self._stack.append((name, role, path))
            self._article += role == 2
            self._boiler += role == 1
            if role == 3:
                self._soft.append(self._n_soft)
                self._n_soft += 1
            elif role == 2 and not self._boiler:
                self._articles += 1
                for k in self._soft:
                    self._wrapped[k] = self._wrapped.get(k, 0) + 1
                    if name == "main":
                        self._main.add(k)

    def _end(self, name: str) -> None:
        if name in _BLOCK or name in _BOILER:
            self._flush()
        for k in range(len(self._stack) - 1, -1, -1):
            if self._stack[k][0] == name:
                self._pop(k)
                break

    def tokens(self) -> dict[int, tuple[int, int, int]]:
        """Per token: how often it is seen, the token of the element it stands in, its kind."""
        out = {_hash(t): (n, _element(self.parent[t]), ARTICLE_TAG if _INSIDE.search(t) else TAG)
               for t, n in self.tags.items()}
        for path, text, _, _ in self.blocks:
            k = _hash(path, text)
            out[k] = (out[k][0] + 1 if k in out else 1, _element(path), TEXT)
        return out

    def candidates(self) -> tuple[bool, list[tuple[str, str]]]:
        """Whether the page has an article, and the blocks (path, text) that are not boilerplate: of
        the article where there is one."""
        article = any(a and not b for _, _, a, b in self.blocks)
        return article, [(path, text) for path, text, a, b in self.blocks
                         if not b and (a or not article)]


def _pick(texts: list[str], on: list[int], article: bool, pages: int) -> list[str]:
    """The texts that are no template, of which ``on`` has the pages of the host's ``pages``; a page
    of nothing else keeps what only a part of the pages has."""
    least = MIN_ARTICLE_PAGES if article else MIN_PAGES
    return [t for t, n in zip(texts, on) if n < least] or [
        t for t, n in zip(texts, on) if n < max(least, pages)]


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"),
                        host_of("url").alias("host"))


def occurrences(pages: DataFrame) -> DataFrame:
    """host, token, seen, page, parent and kind of every distinct token of each page (page: a hash
    of its html)."""
    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for host, source in zip(b["host"], b["html"]):
                page = _hash(source)
                got = Page(source).tokens()
                out += [(host, t, n, page, up, kind) for t, (n, up, kind) in got.items()]
                if got:
                    out.append((host, PAGE, 1, page, 0, TAG))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in TOKENS.split(", ")])
    return pages.select("host", "html").mapInPandas(run, TOKENS)


def templates(pages: DataFrame) -> DataFrame:
    """Per host: pages of different html, and the texts of its template with the pages of each.

    Classes are keyed by the occurrence vector (two sums of hashes over pages and counts, and the
    number of pages). Valid are those of at least ``MIN_CLASS`` tokens on at least ``MIN_PAGES``."""
    once = F.xxhash64("page", "seen")
    token = occurrences(pages).dropDuplicates(["host", "token", "page"]).groupBy(
        "host", "token").agg(
        F.sum(once.bitwiseAND(F.lit(0x7FFFFFFF))).alias("v1"),
        F.sum(F.shiftrightunsigned(once, 33)).alias("v2"),
        F.count(F.lit(1)).alias("on"), F.sum("seen").alias("seen"), F.max("parent").alias("parent"),
        F.max("kind").alias("kind")).filter(F.col("on") >= MIN_PAGES)
    # elements of a class too small to be valid still have others nested in them; inside an article,
    # where paragraphs are, only those that are once on a page
    kind = token.groupBy("host", "v1", "v2", "on").agg(
        (F.max("seen") == F.col("on")).alias("once"),
        F.collect_list("token").alias("tokens"), F.collect_list("parent").alias("parents"),
        F.collect_list("kind").alias("kinds"))
    valid = kind.filter((F.size("tokens") >= MIN_CLASS) | F.exists("kinds", lambda x: x != TEXT))

    def nest(of: pd.DataFrame) -> pd.DataFrame:
        classes = list(zip(of["on"], of["tokens"], of["parents"], of["kinds"],
                           of["once"]))
        pages = next(int(c[0]) for c in classes if PAGE in c[1])
        # elements nest from the root down, each in one that is taken; then whole classes
        taken, template = {0}, {}
        todo = {t: p for _, tokens, parents, kinds, once in classes
                for t, p, x in zip(tokens, parents, kinds) if x == TAG or x == ARTICLE_TAG and once}
        while good := [t for t, p in todo.items() if p in taken]:
            taken.update(good)
            for t in good:
                del todo[t]
        for on, tokens, parents, kinds, _ in classes:
            if len(tokens) - (PAGE in tokens) >= MIN_CLASS and (
                    on == pages or all(p in taken for p in parents)):
                template.update((int(t), int(on)) for t, x in zip(tokens, kinds) if x == TEXT)
        return pd.DataFrame({"host": of["host"].iloc[:1], "pages": pages,
                             "template": [list(template)], "on": [list(template.values())]})
    return valid.groupBy("host").applyInPandas(nest, TEMPLATE)


def candidates(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, host, whether it has an article, the tokens of its candidate blocks, and
    their texts, one a line, packed by zlib: html isn't moved, nor text unpacked."""
    def run(batches):
        for b in batches:
            out = []
            for page_id, url, source, host in zip(b["page_id"], b["url"], b["html"], b["host"]):
                article, blocks = Page(source).candidates()
                body = "\n".join(text for _, text in blocks).encode("utf-8", "surrogatepass")
                out.append((page_id, url, host, article, [_hash(*x) for x in blocks],
                            zlib.compress(body)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATES.split(", ")]).astype(
                {"page_id": "Int64"})
    return pages.select("page_id", "url", "html", "host").mapInPandas(run, CANDIDATES)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_slots of every row of ``pages`` (page_id, url,
    html). NULL and empty html give an empty text; a page without a URL, or on a host of few
    pages, is read by its own structure alone; rows that repeat a page are each extracted and count
    once for the template; an empty table gives an empty result.

    Candidate blocks meet their host's template in the join, where each block gets the number of
    pages that have it as template; the template itself goes no further."""
    p = _pages(pages)
    found = candidates(p).join(templates(p), "host", "left")
    at = F.expr("transform(tokens, t -> coalesce(element_at(on, "
                "cast(nullif(array_position(template, t), 0) as int)), 0L))")

    def run(batches):
        for b in batches:
            out = []
            for page_id, url, article, on, n, body in zip(
                    b["page_id"], b["url"], b["article"], b["on"], b["pages"], b["body"]):
                texts = zlib.decompress(body).decode("utf-8", "surrogatepass").split("\n")
                kept = _pick(texts, on, article, int(n))
                text = "\n".join(kept)
                out.append((page_id, url, text, len(text), len(kept)))
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars", "n_slots"]).astype(
                {"page_id": "Int64"})
    return found.select("page_id", "url", "article", at.alias("on"),
                        F.coalesce("pages", F.lit(0)).alias("pages"), "body").mapInPandas(run, RESULT)
