"""Main text of pages by deducing the template of their host.

Pages of a host come out of a template.  Tokens are elements (by their path of tags and classes)
and blocks of text; a token's occurrence vector says how often it is on each page.  Tokens with
the same vector form an equivalence class.  A class on most pages of its host is part of the
template; classes are nested by the paths of their elements.  What lies between template tokens are
slots: the text below an element of the template, without the blocks that are template tokens.  The main
slot is the element whose slot holds most text outside links, summed over the host's pages, and outside parts
whose names say that they are menus, notices, comments and the like.  Where elements hold much of it, one that
is named as an article goes before others; a name alone wins nothing.  Template texts are dropped from the slot.

Vectors are compared by a hash: the xor over pages of a hash of page and count.  So a token is one row
however many pages it is on, and pages are never gathered per host.  Copies of an article on many
pages count as one page, else they would look like template.  Near copies share classes of texts that are
most of what their pages say; such classes are no template.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import slices, stored
from tillwright.llm.link_trust import host_of

#: A class is template if it is on this many pages (by default), on this share of the host's, and has two tokens.
LEAST_PAGES, LEAST_SHARE, LEAST_TOKENS = 8, 0.6, 2
#: Texts of about as many pages (by this factor) that are this share of the text of their pages are those
#: of near copies.
COPY_FACTOR, COPY_SHARE = 0.8, 2 / 3
#: Without a named article element, a main element has to hold this share of the text.
MAIN_SHARE = 0.7
#: An element of a template that is named as an article has to hold this share of the text in slots.
NAMED_SHARE = 0.3
#: Templates of at most so many bytes together are broadcast.
BROADCAST_BYTES = 16 << 20

RAW = {
    "script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "object", "canvas", "annotation",
    "annotation-xml",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements inside a line; they neither end a block nor count as places.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var",
    "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup",
    "munder", "mover", "munderover", "mtable", "mtr", "mtd", "mstyle", "mpadded", "mphantom",
}
#: Elements that are no main text wherever they are.
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "datalist", "option"}
#: Words in classes, ids and roles that say the same.
ASIDE_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "aside", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "hidden",
    "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination",
    "popup", "promo", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget", "alert", "form",
}
HEADER_WORDS = {"header", "masthead", "topbar"}
MAIN_WORDS = {"article", "main", "content", "post", "entry", "story"}
#: Words of names that tell the state of an element: ``has-sidebar`` is no sidebar.
STATE_WORDS = {"has", "no", "with", "without", "open", "opened", "closed", "enabled", "disabled"}
#: Last words of names that tell the shape or place of what the words before name: ``comment-list``.
SHAPE_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "group", "icons",
    "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "panel", "post", "posts", "right",
    "row", "section", "slot", "thread", "title", "top", "unit", "wrap", "wrapper",
}
#: A start tag of the key closes open elements of the value, as browsers do.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

#: A quote that nothing closes is a character; a tag that nothing ends reaches to the end of the page.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^'">]|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^>]*>"""
    r"""|<[a-zA-Z!?/][^>]*\Z""",
    re.DOTALL,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
_WORD = re.compile(r"[a-zA-Z]+")


@dataclass
class Block:
    path: str
    text: str
    linked: int  # characters inside links
    aside: bool


@dataclass
class Page:
    """Blocks in order, and how often each element path occurs."""

    blocks: list[Block] = field(default_factory=list)
    elements: Counter = field(default_factory=Counter)


def _head(words: list[str]) -> str:
    """What a name of several words names: its last word that is no shape, as in ``user-comments`` and ``comment-list``."""
    return next((word for word in reversed(words) if word not in SHAPE_WORDS), "")


def _named_aside(tag: str, names: dict[str, str], words: set[str], article: bool = False) -> bool:
    """Whether names say that an element is no main text.

    A main element is none unless hidden.  Names with a word of a state say what else is there.  Of an article, or an element with a
    name in main words alone, only names that are nothing but aside words say it.  Inside an ``article`` a name says what its head
    is: ``user-comments`` are comments, ``search-algorithms`` are no search.  Elsewhere any word does.
    """
    if "hidden" in words:
        return True
    if tag == "main" or not words & ASIDE_WORDS:
        return False
    spelt = [_WORD.findall(name) for value in names.values() for name in value.split()]
    spelt = [part for part in spelt if part and not STATE_WORDS & {*part}]
    parts = [set(part) for part in spelt]
    main = tag == "article" or any(part & MAIN_WORDS and not part & ASIDE_WORDS for part in parts)
    if article and not main:
        return any(_head(part) in ASIDE_WORDS for part in spelt)
    return any(part <= ASIDE_WORDS if main else part & ASIDE_WORDS for part in parts)


def _label(tag: str, attributes: str, article: bool) -> tuple[str, set[str], bool]:
    """How an element is called in paths, the words in its names, and whether they make it an aside."""
    if not attributes.strip():
        return tag, set(), False
    words: list[str] = []
    names = {"class": "", "id": "", "role": ""}
    for name, value in _NAMES.findall(attributes):
        names[name.lower()] = value.strip("\"'").lower()
    for value in names.values():
        words += _WORD.findall(value)
    label = ".".join([tag, *_WORD.findall(names["class"])])
    words = {*words, *({"hidden"} if _HIDDEN.search(attributes) else ())}
    return label, words, _named_aside(tag, names, words, article)


def parse(html: str) -> Page:
    """The blocks and elements of a page.  Markup that is cut off or wrongly nested is taken as browsers do."""
    page = Page()
    # tag, path, aside by name, aside by tag or hidden, in an article
    stack: list[tuple[str, str, bool, bool, bool]] = [("", "", False, False, False)]
    pieces: list[tuple[str, bool]] = []
    links = at = 0

    def end_block() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(piece for piece, _ in pieces)).split())
            if text:
                linked = sum(len(piece.strip()) for piece, link in pieces if link)
                page.blocks.append(Block(stack[-1][1], text, min(linked, len(text)), stack[-1][2] or stack[-1][3]))
            pieces.clear()

    def close(depth: int) -> None:
        end_block()
        del stack[depth:]

    while True:
        match = _MARKUP.search(html, at)
        text = html[at : match.start() if match else len(html)]
        if text:
            pieces.append((text, links > 0))
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] == "/", match[3]
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
        elif tag in VOID:
            if tag == "hr":
                end_block()
            elif tag == "br":
                pieces.append((" ", False))
        elif tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
        elif closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            else:
                end_block()
            links = 0
        else:
            end_block()
            # A block ends an open paragraph; items end items of the same list.
            ended = CLOSES.get(tag, set()) | {"p"}
            if stack[-1][0] in ended:
                close(len(stack) - 1)
                if tag == "tr" and stack[-1][0] == "tr":
                    close(len(stack) - 1)
            _, path, aside, surely, article = stack[-1]
            label, words, named = _label(tag, attributes, article)
            article = article or tag == "article"
            header = tag == "header" or (words & HEADER_WORDS and not words & MAIN_WORDS)
            surely = surely or tag in ASIDE or "hidden" in words
            # The main element of a page is no aside by what stands around it.
            aside = (aside and tag != "main") or named or bool(header and not article)
            path = f"{path}/{label}"
            outer = tag in ("html", "body")
            stack.append((tag, path, aside and not outer, surely and not outer, article))
            page.elements[path] += 1
            links = 0
    end_block()
    return page


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - 2**63


def _named(path: str) -> int:
    """2 for a path that ends in an article, 1 for one that ends in a main part by tag or class, else 0."""
    label = path.rsplit("/", 1)[-1].split(".")
    return 2 if label[0] == "article" else 1 if label[0] == "main" or MAIN_WORDS & set(label[1:]) else 0


def main_path(masses: dict[str, int]) -> str | None:
    """The element that holds the main text, from the text outside links below each path.

    A named element wins over others, the one with the most text over other named ones, the outer
    over an inner one with the same text.  Without one, it is the deepest that holds most text.
    """
    if not masses or max(masses.values()) <= 0:
        return None
    best = max(masses, key=lambda p: (_named(p) if masses[p] > 0 else 0, masses[p], -p.count("/"), p))
    if _named(best):
        return best
    total = max(masses.values())
    return max((p for p in masses if masses[p] >= MAIN_SHARE * total), key=lambda p: (p.count("/"), masses[p], p))


def main_slot(masses: dict[str, int], texts: list[tuple[str, int]]) -> str | None:
    """The element of a template that holds the main text.

    ``masses`` has the text outside links below each element, ``texts`` the paths and such text of the
    template's own blocks.  The difference is the element's slot.
    """
    slots = dict(masses)
    for path, mass in texts:
        for prefix in _prefixes(path):
            if prefix in slots:
                slots[prefix] -= mass
    most = max(slots.values(), default=0)
    if most <= 0:
        return None
    named = {path: mass for path, mass in slots.items() if _named(path) and mass >= NAMED_SHARE * most}
    return main_path(named or {path: mass for path, mass in slots.items() if not _named(path)} or slots)


def _prefixes(path: str) -> list[str]:
    steps = path.split("/")
    return ["/".join(steps[: k + 1]) for k in range(1, len(steps))]


def _plain(block: Block) -> int:
    return 0 if block.aside else max(0, len(block.text) - 2 * block.linked)


def page_masses(page: Page, template: set[int] = frozenset()) -> dict[str, int]:
    """The text outside links below each path, without that of the template."""
    masses: Counter = Counter()
    for block in page.blocks:
        if not block.aside and not (template and _hash("text", block.path, block.text) in template):
            for prefix in _prefixes(block.path):
                masses[prefix] += _plain(block)
    return masses


def extract(page: Page, main: str | None, template: set[int]) -> str:
    """The blocks of the main element (the host's, or else the page's own) that are no template text."""
    if main is None or main not in page.elements:
        main = main_path(page_masses(page, template))
    kept = [
        block.text
        for block in page.blocks
        if not block.aside
        and (main is None or block.path == main or block.path.startswith(main + "/"))
        and _hash("text", block.path, block.text) not in template
    ]
    return "\n\n".join(kept)


_TOKENS = "host string, page long, token long, n int, is_text boolean, path string, mass long, plain long, whole long"
_NAMES_OF_TOKENS = ["host", "page", "token", "n", "is_text", "path", "mass", "plain", "whole"]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each token of a page.

    Elements have the text outside links below them as ``plain``.  Texts have their length as ``mass`` and that
    of all texts of the page as ``whole``, and their part outside links as ``plain``.
    """
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    for batch in slices(batches, 200):
        rows = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parse(html or "")
            # Copies of an article, whatever stands around it, are one page.
            article = _hash("page", *(block.text for block in page.blocks if not block.aside))
            masses = page_masses(page)
            rows.append((host, article, 0, 1, False, None, 0, 0, 0))
            for path, n in page.elements.items():
                rows.append((host, article, _hash("element", path), n, False, path, 0, masses.get(path, 0), 0))
            texts: Counter = Counter()
            lengths: Counter = Counter()
            plain: Counter = Counter()
            paths: dict[int, str] = {}
            for block in page.blocks:
                token = _hash("text", block.path, block.text)
                paths[token] = block.path
                texts[token] += 1
                lengths[token] += 0 if block.aside else len(block.text)
                plain[token] += _plain(block)
            whole = lengths.total()
            rows += [(host, article, t, n, True, paths[t], lengths[t], plain[t], whole) for t, n in texts.items()]
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _NAMES_OF_TOKENS)


def occurrences(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per host and token its occurrence ``vector`` as a hash, the ``pages`` it is on, and how often.

    ``pages`` has ``host`` and ``html``.  Both counts are combined before their shuffles, and their
    keys hold the token, so a host with most pages is spread like others.  Tokens of fewer pages than a
    template needs are left out; token 0 is on every page.
    """
    seen = pages.mapInArrow(_tokens, _TOKENS)
    same = [F.max(c).alias(c) for c in ("n", "is_text", "path", "mass", "plain", "whole")]
    once = seen.groupBy("host", "token", "page").agg(*same)
    return once.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.sum("n").alias("n"),
        F.max("is_text").alias("is_text"), F.max("path").alias("path"),
        *(F.sum(c).alias(c) for c in ("mass", "plain", "whole")),
    ).where((F.col("pages") >= least_pages) | (F.col("token") == 0))


def templates(tokens: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per host the single ``elements`` of its template and its template ``texts``, each with text outside links.

    That of an element is all below it, that of a text its own, over all pages.  Both lists are about as long as a
    page: their tokens are on most pages of the host.
    """
    totals = tokens.where("token = 0").select("host", F.col("pages").alias("host_pages"))
    frequent = tokens.where(F.col("pages") >= least_pages).join(totals, "host").where(F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    # Near copies are changed here and there, so their classes are of about as many pages, not of the same.
    order, near = F.round(1000 * F.log("pages")).cast("long"), -round(1000 * math.log(COPY_FACTOR))
    alike = Window.partitionBy("host").orderBy(order).rangeBetween(-near, near)
    length = F.when(F.col("is_text"), F.col("mass") / F.col("pages")).otherwise(0.0)
    share = F.sum(length).over(alike) * F.col("pages") / F.col("whole")
    copied = (F.col("mass") > 0) & (F.col("whole") > 0) & (share > COPY_SHARE)
    frequent = frequent.withColumn("copied", F.coalesce(copied, F.lit(False)))
    classes = frequent.groupBy("host", "vector").agg(F.count("*").alias("size")).where(F.col("size") >= LEAST_TOKENS)
    valid = frequent.join(classes, ["host", "vector"])
    # An element that is there once a page can be the place of the main text; texts are dropped.
    single = F.when(~F.col("is_text") & (F.col("token") != 0) & (F.col("n") == F.col("pages")), F.struct("path", "plain"))
    text = F.when(F.col("is_text") & ~F.col("copied"), F.struct("token", "path", "plain"))
    return valid.groupBy("host").agg(F.collect_list(single).alias("elements"), F.collect_list(text).alias("texts"))


def _few_bytes(deduced: DataFrame) -> bool:
    paths = sum(F.aggregate(c, F.lit(0), lambda n, x: n + F.length(x["path"]) * 4 + 40) for c in ("elements", "texts"))
    whole = deduced.agg(F.sum(paths + 40 + F.coalesce(F.length("host"), F.lit(0)) * 4)).first()[0]
    return (whole or 0) <= BROADCAST_BYTES


def extract_pages(spark: SparkSession, pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Pages of hosts without a template (fewer than ``least_pages`` different ones, or no common one) are judged by
    themselves.  A NULL or
    empty page, and one without main text, gives an empty text.  A NULL url belongs to the host
    without name.  Repeated rows are extracted each; an empty table gives no rows; other columns
    are not read.  Templates of up to ``BROADCAST_BYTES`` are broadcast to the pages; more are
    joined by a shuffle, with the same result.
    """
    url = pages["url"].cast("string")
    placed = pages.select(
        pages["page_id"].cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"),
        pages["html"].cast("string").alias("html"),
    )
    tokens = stored(spark, occurrences(placed.select("host", "html"), least_pages), "tokens")
    deduced = stored(spark, templates(tokens, least_pages), "templates")
    joined = placed.join(F.broadcast(deduced) if _few_bytes(deduced) else deduced, "host", "left").drop("host")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in slices(batches, 200):
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("html", "elements", "texts"))
            for html, elements, dropped in zip(*columns, strict=True):
                key = tuple(tuple(tuple(x.values()) for x in found or ()) for found in (elements, dropped))
                if key not in known:
                    known.clear()  # rows of a host mostly come together
                    known[key] = main_slot(dict(key[0]), [t[1:] for t in key[1]]), {t[0] for t in key[1]}
                texts.append(extract(parse(html or ""), *known[key]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(work, "page_id long, url string, text string, n_chars long")
