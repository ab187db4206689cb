"""Main text of web pages by two passes of block rules.

Method: a page is cut into blocks at block-level tags.  The first pass labels each block from itself alone: many links are
bad; long blocks with many stop words are good; what is short, or has few stop words, is left open.  In the second pass open
blocks take the labels of their nearest decided neighbours.

Markup says more than words where it says anything: what stands in menus, page headers, footers, sidebars, forms, scripts and
the like, by tag, role or the words of its class and id, is no main text whatever it reads like; and where a page marks
its article (one `article`, else `main`, else several articles), blocks outside are bad, and inside an open block is bad only between
bad ones.  Without such a mark the edges of a page count as bad neighbours, and so do marked menus and the rest.

Stop words are those of the language, of the lists below, that has most of them on the page.

Cases: null html is empty and gives an empty text; so does a page without main text.  Tags that are never closed end with
what holds them; an unclosed comment runs to the end; `br` is a space.  Rows are kept as they are, with null or shared ids too.
Pages of any length are read in one pass.  Further columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

STOP = {
    name: frozenset(words.split())
    for name, words in {
        "en": "the of and to in is that for it as with be by on not he his are this at from or have an was you which but they a",
        "de": "der die das und in zu den mit von ist nicht ein eine sich des auf für im dem als auch es an werden aus er hat dass sie nach",
        "fr": "de la le et les des en un une du que est dans qui par pour au il sur pas plus ne se ce avec son sont elle à l",
        "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí es",
        "it": "di e il la che in un per è a con non si le del da i dei una al sono come anche ma più gli nel alla della lo",
        "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à",
    }.items()
}
ANY = frozenset().union(*STOP.values())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
APART = frozenset("nav footer aside form menu dialog select button label svg object audio video canvas datalist option fieldset".split())  # and header outside an article
ENDED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tr": {"table"}, "option": {"select"}}
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class and id that name what is no main text.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist reply replies disqus respond responses share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar pagination pager skip copyright".split()
)
TITLED = frozenset("article entry post content story section page".split())  # with "header": the head of an article
NOT_ITS_OWN = frozenset("has with no without is".split())  # "has-sidebar" is no sidebar
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

DEPTH = 512  # of open elements; what is deeper is as its holder is
MAX_LINKS, SHORT_LINKS, SHORT, LONG, MANY, SOME = 0.5, 0.2, 70, 200, 0.3, 0.15

TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[^\W\d_]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    tag: str
    apart: bool  # stands in what is no main text by its markup
    article: int  # number of the outermost article that holds it, or 0
    main: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _marks(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is set apart, and whether it is marked as the main text."""
    apart = tag in APART or tag == "header" and not inside
    main = tag == "main"
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                apart = True
            elif name == "role":
                apart, main = apart or value.lower() in ROLES, main or value.lower() == "main"
            elif name == "itemprop":
                main = main or value == "articleBody"
            elif name in ("class", "id") and tag not in ("html", "body", "main"):
                for one in value.split():
                    words = {x.lower() for x in PART.findall(one)}
                    hits = words & APART_WORDS
                    if "header" in hits and (inside or words & TITLED):
                        hits = hits - {"header"}
                    apart = apart or bool(hits) and not words & NOT_ITS_OWN
    return apart, main and not apart


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in order."""
    found: list[Block] = []
    #: open elements: (tag, set apart, article, main, in a link)
    stack: list[tuple[str, bool, int, bool, bool]] = [("", False, 0, False, False)]
    articles, at, end, now = 0, 0, len(page), None
    last = page.rfind(">")  # behind it no tag ends

    def say(text: str):
        nonlocal now
        if "&" in text:
            text = html.unescape(text)
        if now is None:
            if not text or text.isspace():
                return
            tag = next((x[0] for x in reversed(stack) if x[0] in BLOCKS), "")
            now = Block(tag, *stack[-1][1:4])
            found.append(now)
        elif stack[-1][1] != now.apart:  # an inline element set apart, in a block that is not, or behind one
            if not text.isspace():
                now = Block(now.tag, *stack[-1][1:4])
                found.append(now)
        now.parts.append(text)
        if stack[-1][4]:
            now.linked += len("".join(text.split()))

    while at < end:
        m = TAG.search(page, at) if at <= last or "<!--" in page[at:] else None
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        block = tag in BLOCKS
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if not block and stack[k][0] in BLOCKS:  # an inline end tag does not end blocks
                    break
        elif tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag == "br":
            if now is not None:
                now.parts.append(" ")
        elif tag not in VOID and len(stack) < DEPTH:
            if block or tag in ENDED_BY:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p" and block or stack[k][0] in ENDED_BY.get(tag, ()):
                        del stack[k:]
                        if tag not in ENDED_BY:
                            break
                    elif stack[k][0] in HOLDS.get(tag, ()) or stack[k][0] in BLOCKS and tag not in ENDED_BY:
                        break
            _, apart, article, main, link = stack[-1]
            off, marked = _marks(tag, m[3], bool(article) or main)
            if tag == "article" and not (apart or off) and not article:
                articles += 1
                article = articles
            stack.append((tag, apart or off, article, main or marked and not apart, link or tag == "a"))
        if block or tag == "option":
            now = None
    for b in found:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in found if b.text]


def labelled(page: str) -> list[tuple[str, bool]]:
    """(text, whether it is main text) of each block."""
    found = blocks(page)
    words = [WORD.findall(b.text.lower()) for b in found]
    hits = [[w for w in ws if w in ANY] for ws in words]
    stop = max(STOP.values(), key=lambda s: sum(w in s for ws in hits for w in ws))
    stops = [sum(w in stop for w in ws) for ws in hits]
    articles = {b.article for b in found if b.article and not b.apart}
    if len(articles) == 1:
        inside = [b.article in articles for b in found]
    elif any(b.main and not b.apart for b in found):
        inside = [b.main for b in found]
    else:
        inside = [b.article > 0 for b in found]
    marked = any(x and not b.apart for x, b in zip(inside, found, strict=True))

    first: list[bool | None] = []  # the first pass: good, bad or open
    for b, ws, n, within in zip(found, words, stops, inside, strict=True):
        links, share = b.linked / max(len(b.text) - b.text.count(" "), 1), n / max(len(ws), 1)
        if b.apart or marked and not within or links > MAX_LINKS:
            first.append(False)
        elif len(b.text) < SHORT:
            first.append(False if links > SHORT_LINKS and not marked else None)
        elif share >= MANY and len(b.text) >= LONG or marked and share >= SOME:
            first.append(True)
        else:
            first.append(None if share >= SOME or marked or len(b.text) >= LONG and links <= SHORT_LINKS else False)

    decided = [i for i, label in enumerate(first) if label is not None and not (marked and (found[i].apart or not inside[i]))]
    out, k = [], 0
    for i, b in enumerate(found):
        while k < len(decided) and decided[k] < i:
            k += 1
        label = first[i]
        if label is None:  # the second pass
            before, after = decided[k - 1] if k else None, decided[k] if k < len(decided) else None
            left = first[before] if before is not None else marked
            right = first[after] if after is not None else marked
            if left == right or marked:
                label = left or right
            elif b.tag in HEADS:
                label = right  # a heading belongs to what follows
            else:
                near, far = i - (before if before is not None else -1), (after if after is not None else len(found)) - i
                label = left if near < far else right if far < near else stops[i] > 0
        out.append((b.text, bool(label)))
    if not marked and not any(label for _, label in out):  # no block decides for good: open ones that are no markup's are all there is
        out = [(b.text, label is None) for b, label in zip(found, first, strict=True)]
    return out


def main_text(page: str) -> str:
    return "\n\n".join(text for text, good in labelled(page) if good)


def _extracted(batches):
    for b in batches:
        texts = [main_text(x or "") for x in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page, row by row."""
    c.settle(pages.sparkSession)
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url {pages.schema['url'].dataType.simpleString()}, text string"
    return c.mapped(pages.select("page_id", "url", "html"), _extracted, schema).withColumn("n_chars", F.length("text").cast("long"))


def page_blocks(pages: DataFrame) -> DataFrame:
    """page_id, place, text, good: each block with its label."""

    def run(batches):
        for b in batches:
            rows = [(i, k, text, good) for i, x in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist(), strict=True) for k, (text, good) in enumerate(labelled(x or ""))]
            ids, places, texts, labels = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field("page_id").type), pa.array(places, pa.int32()), pa.array(texts, pa.string()), pa.array(labels, pa.bool_())], ["page_id", "place", "text", "good"])

    c.settle(pages.sparkSession)
    return c.mapped(pages.select("page_id", "html"), run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, place int, text string, good boolean")


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
