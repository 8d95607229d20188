"""Main text of web pages by template deduction from equivalence classes.

Pages of one host come from a template. Its tokens, tags with their path and short blocks of text, are found by their
occurrence vectors: how often a token stands in each page of the host. Tokens with equal vectors form a class. A class is
valid if it occurs in at least ``MOST_PAGES`` of the host's pages, has two tokens or is a block of text, and nests: its reach, from the mean
place of its first to that of its last token, lies inside that of another valid class or beside it. Nested valid classes
are the template, and what stands between their tokens are its slots.

Vectors are never gathered. A vector over all pages of a host, however many, is known by the sum of the hashes of its entries
(page, count); that sum, and the sums behind mean places, combine before the shuffle.

A page's text comes from the slots that hold its article. A slot belongs to what its tags say it is: menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out, and if the page marks an ``article`` or
``main`` part, all slots inside and no others count. On other pages, blocks that are themselves template tokens (the same
text in most pages of the host) belong to no slot. Hosts with fewer than ``FEWEST`` pages have no template; their tags decide alone.

Character references are decoded and white space in a block becomes one blank; blocks are joined in page order by one blank.
Null and empty pages have an empty text. Broken markup is read as far as it goes: tags that are never closed end with
the part that contains them, an unclosed comment, script or style ends with the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, with_results
from roamsight.llm.urls import host
from roamsight.sources.staging import stage

FEWEST = 5
MOST_PAGES = 0.6
#: Longer blocks of text are content, not template.
LONGEST_CONSTANT = 2_000
#: Rows of the template that may be broadcast; beyond, pages are dealt out by host and salt.
BROADCAST_ROWS = 200_000
SALTS = 32

#: Elements whose content is never text, elements beside the article, and elements that do not end a block.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "textarea"}
BESIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label", "input", "figure"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub"
    " sup time tt u var wbr img br".split()
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
#: A new one of these ends an open one.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCK_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Words of class, id and role that name parts beside the article.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|"
    r"notices?|cookies?|consent|gdpr|alert|popup|modal|overlay|comments?|replies|reply|discussion|disqus|respond|forms?|"
    r"subscribe|newsletter|signup|login|search|share|sharing|social|related|recommend\w*|widget\w*|toolbar|pagination|pager|"
    r"navigation|complementary|contentinfo|skip)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
#: These name the head of the page outside the article, and the article's own heading inside.
HEADS = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-]|\d)", re.IGNORECASE)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
#: Words that name adverts also on elements inside a block, where the others may name what a link is about.
ADVERT = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*)(?:$|[\s_-]|\d)", re.IGNORECASE)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WHITE = re.compile(r"\s+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)


@dataclass
class Node:
    """An open element: its name, path, and what it means for the text inside."""

    name: str
    path: str
    beside: bool
    main: bool


@dataclass
class Page:
    """Blocks of text as (path, text, beside, inside a main part), and tokens in page order."""

    blocks: list[tuple[str, str, bool, bool]] = field(default_factory=list)
    tokens: list[str] = field(default_factory=list)


class Scanner:
    """Finds comments, declarations and tags from left to right, in time that grows with the text however broken it is.

    A tag ends at the first > outside of quotes. Where none follows, its < is text. Quotes that such a search has
    passed lead nowhere, so a later search that comes upon one of them ends there.
    """

    def __init__(self, text: str):
        self.text, self.last = text, text.rfind(">")
        self.nowhere: set[int] = set()
        self.missing: dict[str, int] = {}

    def _quote_end(self, quote: str, at: int) -> int:
        if at >= self.missing.get(quote, len(self.text)):
            return -1
        end = self.text.find(quote, at)
        if end < 0:
            self.missing[quote] = at
        return end

    def _tag_end(self, at: int) -> int:
        passed = []
        while at <= self.last:
            stop = STOP.search(self.text, at)
            if stop[0] == ">":
                return stop.start()
            if stop.start() in self.nowhere:
                break
            passed.append(stop.start())
            end = self._quote_end(stop[0], stop.end())
            if end < 0:
                break
            at = end + 1
        self.nowhere.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str | None, str]:
        """(start, end, name of a tag or None, its attributes) of the next of them; start is -1 if there is none."""
        text = self.text
        while (start := text.find("<", at)) >= 0:
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                return start, len(text) if end < 0 else end + 3, None, ""
            if text[start + 1 : start + 2] in ("!", "?") and start < self.last:
                return start, text.find(">", start) + 1, None, ""
            tag = TAG.match(text, start)
            if tag and (end := self._tag_end(tag.end())) >= 0:
                return start, end + 1, tag[1], text[tag.end() : end]
            at = start + 1
        return -1, len(text), None, ""


def parse(text: str) -> Page:
    """Blocks and tokens of one page in a single pass."""
    page = Page()
    stack = [Node("", "", False, False)]
    pieces: list[str] = []

    def end_block() -> None:
        if pieces:
            block = WHITE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if block:
                top = stack[-1]
                page.blocks.append((top.path, block, top.beside, top.main))
                if len(block) <= LONGEST_CONSTANT:
                    page.tokens.append(f"{top.path}#{block}")

    scanner, at = Scanner(text), 0
    advert, inside = "", 0  # an open advert inside a block, and how many elements of its name are open
    while True:
        start, end, tag, attributes = scanner.next(at)
        if start < 0:
            if not advert:
                pieces.append(text[at:])
            break
        if not advert:
            pieces.append(text[at:start])
        at = end
        if tag is None:
            continue
        name = tag.lower()
        closing = text[start + 1] == "/"
        if name in INLINE:
            if name == "br" and not advert:
                pieces.append(" ")
            elif advert:
                inside += (name == advert) * (-1 if closing else 1)
                advert = advert if inside else ""
            elif not closing and name not in VOID and not attributes.endswith("/"):
                named = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
                if ADVERT.search(named) or HIDDEN.search(attributes):
                    advert, inside = name, 1
            continue
        advert = ""  # a new block ends it
        end_block()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
            page.tokens.append(f"{stack[-1].path}/{name}>")
            continue
        enders = SELF_CLOSING.get(name, set()) | ({"p"} if name in BLOCK_ENDS_P else set())
        if stack[-1].name in enders:
            stack.pop()
        parent = stack[-1]
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(text, at)
            at = close.end() if close else len(text)
            continue
        named = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
        path = f"{parent.path}/{name}" + (f".{named}".replace("#", "") if named else "")
        page.tokens.append(path)
        if name in VOID or attributes.endswith("/"):
            continue
        beside = name in BESIDE and not (name in ("header", "figure") and parent.main) or name in SILENT
        beside = parent.beside or beside or bool(MARKED.search(named)) or bool(not parent.main and HEADS.search(named))
        beside = beside or bool(HIDDEN.search(attributes))
        main = parent.main or (name in ("article", "main") or "main" in named.lower().split()) and not beside
        stack.append(Node(name, path, beside, main))
    end_block()
    return page


def digest(token: str) -> int:
    """Signed 64 bits; odd for a block of text, even for a tag."""
    value = xxhash.xxh3_64_intdigest(token) & ~1 | ("#" in token)
    return value - (value >> 63 << 64)


_COUNTED = "host string, token bigint, entries bigint, pages bigint, places double"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: sum of the hashes of the vector's entries, number of pages, sum of relative places.

    Added up within the task as far as memory allows.
    """
    sums: dict[tuple[str, int], list] = {}

    def flush() -> pa.RecordBatch:
        keys, values = list(sums), list(sums.values())
        sums.clear()
        columns = [[k[0] for k in keys], [k[1] for k in keys], [v[0] - (v[0] >> 63 << 64) for v in values], [v[1] for v in values], [v[2] for v in values]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        names = ["host", "token", "entries", "pages", "places"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for name, number, text in zip(batch["host"].to_pylist(), batch["page"].to_pylist(), batch["html"], strict=True):
            if not text.is_valid:
                continue
            counts: dict[int, int] = {}
            place: dict[int, float] = {}
            tokens = parse(text.as_py()).tokens
            for i, token in enumerate(map(digest, tokens)):
                counts[token] = counts.get(token, 0) + 1
                place.setdefault(token, i / len(tokens))
            for token, count in counts.items():
                entry = xxhash.xxh3_64_intdigest(f"{number}:{count}")
                have = sums.get((name, token))
                if have is None:
                    sums[name, token] = [entry, 1, place[token]]
                else:
                    have[0] = (have[0] + entry) & ((1 << 64) - 1)
                    have[1] += 1
                    have[2] += place[token]
            if len(sums) > 200_000:
                yield flush()
    if sums:
        yield flush()


def deduce(pages: DataFrame) -> DataFrame:
    """Templates: (host, tokens) with the digests of the tokens in valid classes, of hosts with enough pages.

    ``pages`` has (host, page, html), ``page`` a number of the page. A template has as many tokens as a page can share with most
    others, so a row is bounded by the length of a page.
    """
    counted = pages.mapInArrow(_count, _COUNTED).groupBy("host", "token").agg(
        # 64-bit sums that wrap; they only serve as a digest of the vector
        F.expr("cast(pmod(sum(cast(entries as decimal(38,0))), 18446744073709551616BD) as string)").alias("vector"),
        F.sum("pages").alias("pages"),
        (F.sum("places") / F.sum("pages")).alias("place"),
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= FEWEST)
    often = counted.where("pages > 1").join(totals, "host").where(F.col("pages") >= MOST_PAGES * F.col("host_pages"))
    classes = often.groupBy("host", "vector").agg(
        F.collect_set("token").alias("tokens"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    classes = classes.where((F.size("tokens") > 1) | (F.col("tokens")[0] % 2 != 0))  # one tag frames nothing
    return classes.groupBy("host").agg(_nested(F.collect_list(F.struct("first", "last", "tokens"))).alias("tokens"))


def nest(classes: list[dict]) -> list[list[int]]:
    """Tokens of the classes that nest, outer ones first; a class that crosses the reach of an earlier one is left out."""
    open_, kept = [], []
    for one in sorted(classes, key=lambda c: (c["first"], -c["last"], min(c["tokens"]))):
        while open_ and open_[-1] < one["first"]:
            open_.pop()
        if open_ and one["last"] > open_[-1]:
            continue
        open_.append(one["last"])
        kept.append(one["tokens"])
    return kept


def _nested(classes: Column) -> Column:
    @F.arrow_udf("array<bigint>")
    def tokens(lists: pa.Array) -> pa.Array:
        return pa.array([[t for c in nest(found) for t in c] for found in lists.to_pylist()], pa.list_(pa.int64()))

    return tokens(classes)


def main_text(text: str, constant: frozenset[int] | set[int]) -> str:
    """The article of one page; ``constant`` holds the digests of its host's template tokens."""
    page = parse(text)
    blocks = [b for b in page.blocks if not b[2]]
    if any(main for *_, main in blocks):
        blocks = [b for b in blocks if b[3]]
    elif constant:
        blocks = [b for b in blocks if len(b[1]) > LONGEST_CONSTANT or digest(f"{b[0]}#{b[1]}") not in constant]
    return " ".join(block for _, block, _, _ in blocks)


def _texts(page: Column, tokens: Column) -> Column:
    @F.arrow_udf("string")
    def texts(pages: pa.Array, templates: pa.Array) -> pa.Array:
        known: dict = {}
        out = []
        for one, template in zip(pages, templates, strict=True):
            constant: frozenset[int] = frozenset()
            if template.is_valid:
                raw = template.values.to_numpy().tobytes()
                constant = known.get(raw) or known.setdefault(raw, frozenset(template.as_py()))
            out.append(main_text(one.as_py(), constant) if one.is_valid else "")
        return pa.array(out, pa.string())

    return texts(page, tokens)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Pages with the main text in ``text``."""
    name = host(F.col(url_col))
    narrow = pages.select(name.alias("host"), F.xxhash64(url_col, html_col).alias("page"), F.col(html_col).alias("html"))
    narrow = narrow.where("html <> ''")
    template = stage(deduce(narrow), "templates")
    own, salt = fresh(pages, "page_host"), fresh(pages, "salt")
    rows = pages.withColumn(own, name)
    of, tokens, copy = (fresh(pages, n) for n in ("template_host", "template_tokens", "template_salt"))
    template = template.select(F.col("host").alias(of), F.col("tokens").alias(tokens))
    if template.select(F.explode(tokens)).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(template), rows[own] == template[of], "left")
    else:
        copies = template.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(url_col, html_col), F.lit(SALTS)).cast("int"))
        joined = rows.join(copies, (rows[own] == copies[of]) & (rows[salt] == copies[copy]), "left")
    results = with_results(joined, {text_col: _texts(F.col(html_col), F.col(tokens))})
    return results.select(*[f"`{c}`" for c in pages.columns if c.lower() != text_col.lower()], text_col)
