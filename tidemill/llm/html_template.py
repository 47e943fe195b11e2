"""HTML extraction by deducing templates from equivalence classes.

1. Each page becomes tokens: tags with the containers they stand in, and texts
   with theirs. A token's occurrence vector over the pages of its host is how
   often each page has it. Vectors are never built: a digest over (page, count)
   pairs, added up with partial sums, is equal for equal vectors.
2. Tokens of a host with equal vectors form an equivalence class. A class is
   valid if a twentieth of the pages have it, ``MIN_PAGES`` or half of them at
   least, and it has ``MIN_CLASS`` tokens or more, and it nests if its tokens
   stand in containers of one class.
3. The nested valid classes are the host's template, wherever they stand. Texts
   that belong to it are the site's; what remains are the slots' contents.
4. Names and classes of containers label the slots. Slots of menus, notices,
   adverts, forms, comments and the like are left out. If one ``article`` or
   ``main`` holds at least as much of the rest as stands outside, it is taken
   alone, else all of the rest.

Copies of an article recur like a template. Classes that only some pages have
are therefore left in a page of which they make up more than half, and an article
of which nothing would remain is taken whole.

A host may hold any share of the pages: only token counts are grouped by host.
Pages of hosts too rare for a template are extracted by their containers alone.
Null html is empty; null urls are one host. Repeated rows count as pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import besides, prepared, stored, unused
from tidemill.llm.common import col as named

MIN_CLASS = 3
#: A host with fewer pages has no template.
MIN_PAGES = 4
#: A class is on one in so many pages of its host at least, which also bounds a host's template.
ONE_IN = 20

_RAW = "script|style|textarea|noscript|template|title|iframe|svg|select|button"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
#: An attribute with its value, so that no value is read as a name; or a string without a name.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
SIGNS = frozenset("class id role itemprop hidden".split())

CONTAINERS = frozenset("html head body header nav main article section aside footer form div ul ol dl table dialog menu figure details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr caption figcaption hr address summary legend tbody thead tfoot".split())
#: Containers that hold no part of an article, by name and by a class, id or role, whole but for a number at its end.
ASIDE = frozenset("head nav aside footer form dialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "disqus dialog discussion footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay paywall "
    "popup promo promoted promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
_NUMBER = re.compile(r"[-_0-9]+$")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def signs_of(attrs: str) -> tuple[str, frozenset]:
    """A tag's class, id and role without digits, and their words."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return "", frozenset()
    found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _ATTRIBUTE.finditer(attrs) if m[1]]
    found = [(n, v) for n, v in found if n in SIGNS]
    sign = ",".join(f"{n}={re.sub(r'[0-9]+', '', v)}" for n, v in found)
    words = {_NUMBER.sub("", w) for n, v in found if n not in ("itemprop", "hidden") for w in v.split()}
    if any(n == "hidden" for n, _ in found):
        words.add("notice")
    return sign, frozenset(words)


class Box:
    """An open container: where it stands, its outermost article, and whether its name or its words set it aside."""

    __slots__ = ("article", "by_name", "by_words", "name", "path", "up")

    def __init__(self, name: str, path: str, up: Box | None, article: Box | None, by_name: bool, by_words: bool):
        self.name, self.path, self.up, self.by_name, self.by_words = name, path, up, by_name, by_words
        self.article = article

    def around(self) -> Iterator[Box]:
        """This container and those it stands in."""
        box = self
        while box is not None:
            yield box
            box = box.up

    def aside(self) -> bool:
        return any(b.by_name or b.by_words for b in self.around())


class Page:
    """The tokens of a page, and its texts by block with what encloses them.

    An article is never set aside by the words of what holds it, and by its
    names only if the page has another article outside of such containers.
    """

    def __init__(self, source: str):
        self.tokens: Counter = Counter()
        self.parents: dict[str, str] = {}
        self.texts: list[tuple[int, str, str, Box]] = []  # block, text, token, container
        self.stack: list[Box] = [Box("", "", None, None, False, False)]
        self.articles: list[Box] = []  # those in no other
        self.text_tokens: dict[str, Box] = {}
        self.block = 0
        for m in _TOKEN.finditer(source):
            if m["name"]:
                self.tag(m["name"].lower(), bool(m["close"]), m["attrs"])
            elif m["text"]:
                self.text(m["text"])
        for box in self.articles:
            for b in box.around():
                b.by_words = False
        if all(box.aside() for box in self.articles):
            for box in self.articles:
                for b in box.around():
                    b.by_name = False

    def seen(self, token: str) -> None:
        self.tokens[token] += 1
        self.parents[token] = self.stack[-1].path

    def tag(self, name: str, close: bool, attrs: str) -> None:
        if name in BLOCKS:
            self.block += 1
        if close:
            if name in CONTAINERS and any(s.name == name for s in self.stack):
                while self.stack.pop().name != name:
                    pass
            self.seen(f"{self.stack[-1].path}</{name}")
            return
        sign, words = signs_of(attrs)
        up = self.stack[-1]
        token = f"{up.path}/{name}[{sign}]" if sign else f"{up.path}/{name}"
        self.seen(token)
        if name in CONTAINERS and not attrs.endswith("/"):
            is_article = name in ("article", "main") or "articlebody" in sign
            by_name = name in ASIDE or name == "header" and up.article is None
            by_words = name not in ("html", "body") and not is_article and bool(words & ASIDE_WORDS)
            box = Box(name, token, up, up.article, by_name and not is_article, by_words)
            if is_article and up.article is None:
                box.article = box
                self.articles.append(box)
            self.stack.append(box)
        elif name == "br":
            self.texts.append((self.block, " ", "", up))

    def text(self, raw: str) -> None:
        box = self.stack[-1]
        token = ""
        if raw.strip():
            token = f"{box.path}#{' '.join(raw.split())}"
            self.seen(token)
            self.text_tokens[token] = box
        self.texts.append((self.block, raw, token, box))

    def main_text(self, everywhere: set | frozenset, elsewhere: set | frozenset) -> str:
        """The blocks of the slots that hold the article; the template's texts are those of all pages and those of some."""
        slots = [(t, token_number(t[2])) for t in self.texts if not t[3].aside()]
        rest = [(t, n) for t, n in slots if n not in everywhere]
        if not size_of(t for t, _ in rest):
            rest = [(t, n) for t, n in slots if t[3].article]
        within = [(t, n) for t, n in rest if t[3].article]
        if len({id(t[3].article) for t, _ in within if t[1].strip()}) == 1 and 2 * size_of(t for t, _ in within) >= size_of(t for t, _ in rest):
            rest = within
        own = [(t, n) for t, n in rest if n not in elsewhere]
        if 2 * size_of(t for t, _ in own) >= size_of(t for t, _ in rest):
            rest = own
        blocks: dict[int, list[str]] = {}
        for (block, raw, _, _), _ in rest:
            blocks.setdefault(block, []).append(raw)
        # character references may span no tags, so each text is decoded whole
        joined = (" ".join("".join(entities.unescape(x) for x in b).split()) for b in blocks.values())
        return "\n\n".join(b for b in joined if b)


def size_of(texts: Iterable[tuple]) -> int:
    return sum(len(raw.strip()) for _, raw, _, _ in texts)


def token_number(token: str) -> int:
    """A 64-bit number for a token; 0 for none."""
    if not token:
        return 0
    return np.uint64(xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))).astype(np.int64).item()


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(named(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def occurrences(pages: DataFrame) -> DataFrame:
    """``host, page, token, parent, n, slot`` for pages given as ``host, page, html``; a slot is a text that is not set aside."""

    def scan(batches) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for host, page, source in zip(pdf["host"], pdf["page"], pdf["html"], strict=True):
                p = Page(source)
                texts = p.text_tokens
                rows += [(host, page, token_number(t), token_number(p.parents[t]), n, t in texts and not texts[t].aside()) for t, n in p.tokens.items()]
            yield pd.DataFrame(rows, columns=["host", "page", "token", "parent", "n", "slot"])

    return pages.mapInPandas(scan, "host string, page long, token long, parent long, n long, slot boolean")


def templates(pages: DataFrame) -> DataFrame:
    """``host, token, class, parent_class, slot, everywhere``: the nested valid classes of every host."""
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    vectors = occurrences(pages).groupBy("host", "token", "parent").agg(
        F.count(F.lit(1)).alias("seen"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.max("slot").alias("slot")
    )
    often = f"seen * 2 >= pages or seen >= {MIN_PAGES} and seen * {ONE_IN} >= pages"
    frequent = stored(vectors.filter("seen > 1").join(hosts, "host").filter(often), "frequent-tokens")
    keys = ["host", "seen", "total", "vector"]
    classes = frequent.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min("token").alias("class")).filter(F.col("size") >= MIN_CLASS)
    members = frequent.join(classes, keys).select("host", "token", "parent", "class", "slot", (F.col("seen") == F.col("pages")).alias("everywhere"))
    enclosing = members.select("host", F.col("token").alias("parent"), F.col("class").alias("parent_class"))
    # a class nests if its tokens stand in containers of its own class and of one other at most
    placed = members.join(enclosing, ["host", "parent"], "left")
    others = F.when(F.col("parent_class") != F.col("class"), F.col("parent_class"))
    nests = placed.groupBy("host", "class").agg(F.min(others).alias("low"), F.max(others).alias("high")).filter("low is null or low = high")
    return members.join(nests.select("host", "class", F.col("low").alias("parent_class")), ["host", "class"]).select("host", "token", "class", "parent_class", "slot", "everywhere")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", result: str = "main_text") -> DataFrame:
    """``pages`` with a column ``result``: the main text of the page."""
    prepared(pages.sparkSession)
    host, found, out = unused(pages, "host", "template_tokens", result)
    source = F.coalesce(named(html_col).cast("string"), F.lit(""))
    plain = pages.select(host_of(url_col).alias("host"), F.xxhash64(named(url_col), source).alias("page"), source.alias("html"))
    # one row per host; written first, so that its size decides how it is joined
    tokens = F.struct(*[F.collect_set(F.when(c, F.col("token"))).alias(n) for n, c in (("everywhere", F.col("everywhere")), ("elsewhere", ~F.col("everywhere")))])
    by_host = stored(templates(plain).filter("slot").groupBy("host").agg(tokens.alias("tokens")), "templates")

    def read(sources: pd.Series, everywhere: pd.Series, elsewhere: pd.Series) -> pd.Series:
        known = [[frozenset(() if t is None else t) for t in tokens] for tokens in (everywhere, elsewhere)]
        return pd.Series([Page(s).main_text(*t) for s, *t in zip(sources, *known, strict=True)], dtype=object)

    joined = pages.withColumn(host, host_of(url_col)).join(by_host.select(F.col("host").alias(host), F.col("tokens").alias(found)), host, "left")
    text = F.pandas_udf(read, "string")(source, F.col(found)["everywhere"], F.col(found)["elsewhere"])
    return joined.withColumn(out, text).select(*besides(pages, result), F.col(out).alias(result))
