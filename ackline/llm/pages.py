"""Main text of web pages, with site templates removed.

A page is parsed into elements, and every element subtree has a hash. Spark
counts on how many different pages of a host each subtree with text stands;
those that recur on many are the site's template and are deleted, together with
elements that by their kind or name are not part of an article. What is left is
taken from the page's article or main element, or else from its body.

Copies of one page count once: they say nothing about the site's template. A
host may have any number of template subtrees, as every page is joined only to
those that stand on itself.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, map_batches, prepare
from ackline.llm.urls import split_url
from ackline.plans.joins import lookup_join

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
# An opening tag of the left kind closes an open element of the right kinds.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

# Never part of an article, by kind.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form iframe object svg math canvas audio video button select"
    " textarea datalist dialog menu".split()
)
# Nor by a word of their class, id or role.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar comment comments disqus replies"
    " respond cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup share sharing social"
    " breadcrumb breadcrumbs nav navbar navigation menu footer pagination pager related recommended widget toolbar masthead"
    " contentinfo complementary search alert dialog skip".split()
)
# These only outside the article: it may have a heading of its own.
OUTSIDE = frozenset("header banner".split())
MAIN = frozenset(["article", "main"])

_WORD = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "parts", "dropped", "inside", "digest", "said")

    def __init__(self, tag: str, dropped: bool, inside: bool):
        self.tag, self.dropped, self.inside = tag, dropped, inside
        self.parts: list[str | Element] = []
        self.digest = 0
        self.said = False


class TreeBuilder(HTMLParser):
    """Elements of a page; forgiving about tags that are not closed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("#page", False, False)
        self.open = [self.root]

    def _close_upto(self, index: int) -> None:
        del self.open[index:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_one({"p"}, BLOCKS - {"p"})
        if tag in CLOSES:
            self._end_one(CLOSES[tag], HOLDS.get(tag, set()))
        parent = self.open[-1]
        named = dict(attrs)
        words = set(_WORD.findall(" ".join(filter(None, (named.get("class"), named.get("id"), named.get("role")))).lower()))
        inside = parent.inside or tag in MAIN or "main" == (named.get("role") or "").lower()
        dropped = parent.dropped or tag in DROPPED
        if not dropped and tag not in ("html", "body") and tag not in MAIN:
            dropped = bool(words & NAMED) or (not inside and (tag == "header" or bool(words & OUTSIDE)))
            dropped = dropped or "hidden" in named or (named.get("aria-hidden") or "").lower() == "true"
            dropped = dropped or "display:none" in (named.get("style") or "").replace(" ", "").lower()
        if not dropped and tag in MAIN:
            dropped = bool(words & NAMED)
        element = Element(tag, dropped, inside)
        parent.parts.append(element)
        if tag not in VOID:
            self.open.append(element)

    def _end_one(self, kinds: set[str], fence: set[str] | frozenset[str]) -> None:
        """End the nearest open element of ``kinds``, unless one of ``fence`` is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in kinds:
                return self._close_upto(i)
            if self.open[i].tag in fence:
                return None

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                return self._close_upto(i)

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def parse(html: str | None) -> tuple[Element, list[Element]]:
    """The page, and all its elements, children before their parents; each with its digest and whether it says anything."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    order, waiting = [], [builder.root]
    while waiting:
        element = waiting.pop()
        order.append(element)
        waiting.extend(p for p in element.parts if isinstance(p, Element))
    order.reverse()
    for element in order:
        said = [p if isinstance(p, str) else f"\0{p.digest}" for p in element.parts]
        element.said = any(bool(p.strip()) if isinstance(p, str) else p.said for p in element.parts)
        element.digest = xxhash.xxh3_64_intdigest("\1".join([element.tag, *said]).encode("utf-8", "surrogatepass")) - (1 << 63)
    return builder.root, order


def article_text(html: str | None, template: frozenset[int] = frozenset(), template_inside: frozenset[int] = frozenset()) -> str:
    """Blocks of the article in page order, joined by an empty line.

    ``template`` has the digests of subtrees to delete outside the page's main
    element, ``template_inside`` those within it.
    """
    root, order = parse(html)
    only_main = any(e.inside and not e.dropped for e in order)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    # (element, next part): no recursion, pages may nest deeply.
    stack: list[tuple[Element, int]] = [(root, 0)]
    while stack:
        element, at = stack.pop()
        if at == 0 and element.tag in BLOCKS:
            flush()
        if at == len(element.parts):
            if element.tag in BLOCKS:
                flush()
            continue
        stack.append((element, at + 1))
        part = element.parts[at]
        if isinstance(part, str):
            if element.inside or not only_main:
                line.append(part)
        elif part.tag in ("br", "td", "th"):
            line.append(" ")
            if not part.dropped:
                stack.append((part, 0))
        elif not part.dropped and part.digest not in (template_inside if part.inside else template):
            stack.append((part, 0))
    flush()
    return "\n\n".join(blocks)


def subtrees(pages: DataFrame) -> DataFrame:
    """``(host, page, digest, inside)``: the different subtrees with text of every page."""

    def list_them(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, prints, digests, insides = [], [], [], []
        for host, page, html in zip(*[batch.column(c).to_pylist() for c in ("host", "page", "html")]):
            order = parse(html)[1]
            found = {(e.digest, e.inside) for e in order if e.said and not e.dropped and e.tag not in ("#page", "html", "body")}
            for digest, inside in found:
                hosts.append(host)
                prints.append(page)
                digests.append(digest)
                insides.append(inside)
        made = [pa.array(hosts, pa.string()), *[pa.array(v, pa.int64()) for v in (prints, digests)], pa.array(insides, pa.bool_())]
        return pa.RecordBatch.from_arrays(made, names=["host", "page", "digest", "inside"])

    return map_batches(pages.select("host", "page", "html"), list_them, "host string, page long, digest long, inside boolean")


def page_templates(
    pages: DataFrame, *, least: int = 5, share: float = 0.1, many: int = 100, share_inside: float = 0.5
) -> DataFrame:
    """``(host, page, outside, within)``: digests of the template subtrees that stand on each page.

    ``page`` is a hash of the html, so copies of a page are one page. A subtree
    outside the page's main element is template from ``share`` of the host's
    pages or ``many`` pages on, whichever is fewer; one within it, which may be
    a passage that articles quote, from ``share_inside`` on. Either has to stand
    on ``least`` pages.
    """
    each = keep(subtrees(pages), "page-subtrees")
    counted = each.groupBy("host", "digest", "inside").agg(F.count_distinct("page").alias("uses"))
    counted = keep(counted.filter(F.col("uses") >= least), "subtree-counts")
    sizes = keep(pages.groupBy("host").agg(F.count_distinct("page").alias("pages")), "host-sizes")
    known = lookup_join(counted, sizes, ["host"], spread=["digest"])
    outside = F.least(share * F.col("pages"), F.lit(many))
    wanted = F.when(F.col("inside"), share_inside * F.col("pages")).otherwise(outside)
    recurring = keep(known.filter(F.col("uses") >= wanted).select("host", "digest", "inside"), "site-templates")
    found = lookup_join(each, recurring, ["host", "digest", "inside"], "left_semi", spread=["page"])
    return found.groupBy("host", "page").agg(
        F.collect_set(F.when(~F.col("inside"), F.col("digest"))).alias("outside"),
        F.collect_set(F.when(F.col("inside"), F.col("digest"))).alias("within"),
    )


def extract_text(pages: DataFrame, **limits) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``.

    A null or empty ``html`` has an empty text. Pages without host (null URL)
    have no site template. Repeated rows are one page of their host.
    """
    prepare(pages.sparkSession)
    host, _ = split_url(F.col("url"))
    hosted = pages.select(F.col("page_id").cast("long"), "url", "html", host.alias("host"), F.xxhash64("html").alias("page"))
    templates = keep(page_templates(hosted.filter("host != '' AND html != ''"), **limits), "page-templates")
    joined = hosted.join(templates, ["host", "page"], "left")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("html", "outside", "within")]
        texts = [article_text(html, frozenset(outside or ()), frozenset(within or ())) for html, outside, within in zip(*columns)]
        made = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        return pa.RecordBatch.from_arrays(made, names=["page_id", "url", "text", "n_chars"])

    given = joined.select("page_id", "url", "html", "outside", "within")
    return map_batches(given, extract, "page_id long, url string, text string, n_chars long")
