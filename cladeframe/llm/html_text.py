"""Main text of web pages, with site templates removed.

Each page is parsed by a task into blocks of text and elements, an element being a hash of its subtree (tag, class, text,
children) and the blocks it spans. Spark counts, per host, the different pages that hold a subtree; subtrees that recur
across many of a host's pages are its template, and their blocks go. A subtree counts only if it has TEMPLATE_WORDS words
or more, so that short sentences which happen to recur stay; a menu counts as a whole. Besides, elements which by tag, role
or class are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments are left out,
and only the article is kept where a page has one (else its main element, else its body). Class names count as whole
names, or if every part between - and _ is a word of furniture or one of the words that go with them ("cookie-banner",
"site-footer"); a name that has any other part doesn't ("share-price", "elementor-widget-container"), nor one that says that the
element merely has or goes with furniture ("has-sidebar", "comments-open"), and never on html or body. Text of unwanted inline
elements goes, that around them stays. If all articles and main elements stand in furniture, but in no menu, aside, footer
or hidden element, and hold more text than is left outside, what surrounds them is a wrapper and they are kept. If nothing
is left at all, forms are taken for wrappers. A block of text inside an article or main element is never template by
itself: passages that articles repeat stay.

Pages of equal content count once per host and subtree, so copies of an article don't turn it into a template. Counts
are aggregated before the shuffle; a host with a third of all pages is spread by subtree and by salt. Elements meet the
templates on (host, subtree), not on the host, and what comes back is a list of blocks for each page. If the tables of
templates or of such lists are counted to be small they are broadcast and no text moves; otherwise Spark shuffles the
pages by a hash of the page.

Cases: a null or empty html gives the empty text. A null url is a host of its own. Repeated rows and equal ids are pages
of their own and get equal texts. Broken markup is read as browsers do, roughly: unknown end tags are ignored, open
elements end with their parent. Very long and deeply nested pages are parsed whole, without recursion; a page must fit a task.
Blocks stand in page order, so there are no ties. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written

MIN_PAGES, GROW, MIN_SHARE, TEMPLATE_WORDS, SALTS = 5, 2.0, 0.2, 5, 64
#: Names of HTML elements and what class names of page furniture are made of.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video select textarea button datalist".split())
FURNITURE = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
CLASSES = frozenset("ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related rail respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
#: What stands beside such words in class names.
BESIDE = frozenset("all area author bar block blocks body bottom box boxes button buttons center col column container date desktop fixed form global group header heading icon icons inner item items label left link links list lists logo main meta mobile module outer page panel post posts primary reply right row secondary section side site slot sticky story stories strip text thread title top unit wrap wrapper zone".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: What holds blocks of text, rather than being one.
CONTAINERS = frozenset("aside center details dialog div dl fieldset footer form header menu nav ol section table ul".split())
#: Where a class name never makes furniture of it: the page itself.
WHOLE = frozenset("html body".split())
HARD = frozenset("nav footer aside dialog menu".split())
NAME = re.compile(r"[a-z]+")
BLANK = re.compile(r"\s+")


class Page(HTMLParser):
    """blocks: [text, wanted by tag and class, inside an article, inside main, wanted
    if wrappers of articles are, wanted if forms are]; elements: [hash, first block, end block, words, loose]."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.elements: list[list] = []
        self.text: list[str] = []
        self.number: Counter[str] = Counter()  # of open elements by tag
        #: open elements: tag, name for the hash, first block, hash parts, unseen, furniture, in article, in main, furniture
        #: within the outermost article or main (None: in neither or in hard furniture), furniture but for forms, in hard
        #: furniture, unwanted inline
        self.open: list[list] = [["", "", 0, [], False, False, False, False, None, False, False, False]]
        self.level = [self.open[0]]  # for each open element the innermost that isn't inline
        self.feed(html)
        self.close()
        while len(self.open) > 1:
            self.pop()
        self.flush()

    def flush(self) -> None:
        text = BLANK.sub(" ", "".join(self.text)).strip()
        self.text = []
        if text:
            top = self.level[-1]
            self.open[-1][3].append(text)
            self.blocks.append([text, not top[5], top[6], top[7], top[8] is False, not top[9]])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            if self.open[-1][0] != "p" and tag != "option":
                self.end_open({"p"}, {"td", "th", "table", "button", "object"} | {"div", "article", "section", "li", "body"})
            elif self.open[-1][0] == "p":
                self.pop()
        if tag in CLOSES:
            self.end_open(*CLOSES[tag])
        if tag in ("br", "td", "th", "img"):
            self.text.append(" ")
        if tag in VOID:
            return
        top = self.open[-1]
        known = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "style")}
        names = [] if tag in WHOLE or not known else [NAME.findall(n) for n in f"{known.get('class', '')} {known.get('id', '')}".split()]
        names = [n for parts in names if all(n in CLASSES or n in BESIDE for n in parts) for n in parts]
        article = top[6] or tag == "article"
        hidden = "hidden" in known or known.get("aria-hidden") == "true" or "display:none" in known.get("style", "").replace(" ", "")
        own = hidden or known.get("role") in ROLES - {"form"} or (tag in FURNITURE and tag != "form") or any(n in CLASSES for n in names) or ((tag == "header" or "header" in names) and not article)
        furniture = top[5] or own or tag == "form" or known.get("role") == "form"
        main = top[7] or tag == "main" or known.get("role") == "main"
        hard = top[10] or hidden or tag in HARD or known.get("role") in ROLES - {"form"}
        inside = None
        if top[8] is not None or ((tag in ("article", "main") or known.get("role") == "main") and not hard):
            inside = bool(top[8] or own or tag == "form" or known.get("role") == "form")
        inline = tag not in BLOCK and tag not in UNSEEN and tag not in WHOLE
        self.number[tag] += 1
        self.open.append([tag, f"{tag}.{known.get('class', '')}", len(self.blocks), [], top[4] or tag in UNSEEN, furniture, article and not furniture, main, inside, top[9] or own, hard, inline and (top[11] or own)])
        self.level.append(self.level[-1] if inline else self.open[-1])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if self.number[tag]:
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data: str) -> None:
        if not self.open[-1][4] and not self.open[-1][11]:
            self.text.append(data)

    def end_open(self, tags: set, within: set) -> None:
        """End the innermost open element of these tags, unless one of `within` stands closer."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] in tags:
                while len(self.open) > depth:
                    self.pop()
                return
            if self.open[depth][0] in within:
                return

    def pop(self) -> None:
        if self.open[-1][0] in BLOCK or self.open[-1][0] in UNSEEN:
            self.flush()
        tag, name, first, parts, _, _, article, main, *_ = self.open.pop()
        self.level.pop()
        self.number[tag] -= 1
        h = xxhash.xxh64_intdigest("\x00".join([name, *parts]).encode("utf-8", "surrogatepass"))
        self.open[-1][3].append(f"\x01{h}")
        if first < len(self.blocks):
            words = sum(b[0].count(" ") + 1 for b in self.blocks[first:]) if len(self.blocks) - first < 50 else TEMPLATE_WORDS
            inside, holds = article or main, tag in CONTAINERS
            if holds or not inside:
                self.elements.append([h - 2**63, first, len(self.blocks), words, holds and not inside])


PARSED = [
    ("digest", pa.int64()), ("blocks", pa.list_(pa.string())), ("wanted", pa.list_(pa.bool_())),
    ("elements", pa.list_(pa.struct([("h", pa.int64()), ("first", pa.int32()), ("upto", pa.int32()), ("loose", pa.bool_())]))),
]
PARSED_DDL = "digest long, blocks array<string>, wanted array<boolean>, elements array<struct<h: long, first: int, upto: int, loose: boolean>>"


def parsed(html: str | None) -> tuple[int, list[str], list[bool], list[dict]]:
    page = Page((html or "").encode("utf-8", "replace").decode())
    article = any(b[1] and b[2] for b in page.blocks)
    main = not article and any(b[1] and b[3] for b in page.blocks)
    wanted = [bool(b[1] and (b[2] if article else b[3] if main else True)) for b in page.blocks]
    if not article and not main:
        size = lambda own: sum(len(b[0]) for b, w in zip(page.blocks, own) if w)
        wrapped = [b[4] for b in page.blocks]
        if size(wrapped) > size(wanted):
            wanted = wrapped
        elif not any(wanted):
            wanted = [b[5] for b in page.blocks]
    texts = [b[0] for b in page.blocks]
    digest = xxhash.xxh64_intdigest("\n".join(texts).encode()) - 2**63
    elements = {}
    for h, first, upto, words, loose in page.elements:
        if words >= TEMPLATE_WORDS and not elements.get((first, upto), (0, False))[1] and (loose or (first, upto) not in elements):
            elements[first, upto] = h, loose
    return digest, texts, wanted, [{"h": h, "first": a, "upto": b, "loose": loose} for (a, b), (h, loose) in elements.items()]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = ["id", "url", "host"]
    for batch in batches:
        htmls = batch.column("html")
        for at in range(0, len(htmls), 200):
            cols = list(zip(*(parsed(h.as_py()) for h in htmls[at : at + 200])))
            arrays = [*[batch.column(c)[at : at + 200] for c in own], *[pa.array(c, t) for c, (_, t) in zip(cols, PARSED)]]
            yield pa.RecordBatch.from_arrays(arrays, [*own, *[name for name, _ in PARSED]])


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, grow: float = GROW, min_share: float = MIN_SHARE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) for every row. A loose subtree, one that holds blocks outside articles, is template if it stands in
    min_pages + grow * log2(pages / min_pages) different pages of its host or more: a number that hardly grows, so that the menu
    of one section of a large host counts. Others must stand in min_share of the host's pages as well."""
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    parts = written(rows.mapInArrow(_parse, f"id {kind}, url string, host string, {PARSED_DDL}"), "pages-parsed")
    # pages of equal texts count once for each subtree; a host's own key is never a shuffle key by itself
    seen = parts.select("host", "digest", F.explode("elements").alias("e")).select("host", "digest", F.col("e.h").alias("h"), F.col("e.loose").alias("loose")).distinct()
    counts = seen.groupBy("host", "h", "loose").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    different = parts.select("host", "digest").distinct()
    sizes = different.groupBy("host", F.pmod("digest", F.lit(SALTS)).alias("salt")).agg(F.count("*").alias("pages")).groupBy("host").agg(F.sum("pages").alias("pages"))
    counts = written(counts, "subtree-counts")
    few = small(written(sizes.join(small(written(counts.select("host").distinct(), "template-hosts")), "host", "left_semi"), "host-sizes"))
    floor = min_pages + grow * F.log2(F.col("pages") / min_pages)
    templates = small(written(counts.join(few, "host").where((F.col("n") >= floor) & (F.col("loose") | (F.col("n") >= min_share * F.col("pages")))).select("host", "h", "loose"), "page-templates"))

    # which blocks each page loses: elements meet templates on (host, h), so no page is moved and no host is one task
    row = F.struct(F.xxhash64("id", "url", "host", "digest", F.to_json("elements")).alias("a"), F.xxhash64(F.lit(7), "digest", "host", "url", "id", F.to_json("wanted")).alias("b"))
    parts = parts.withColumn("page", row)
    spans = parts.select("page", "host", F.explode("elements").alias("e")).select("page", "host", F.col("e.h").alias("h"), F.col("e.first").alias("first"), F.col("e.upto").alias("upto"), F.col("e.loose").alias("loose"))
    gone = spans.join(templates, ["host", "h", "loose"]).groupBy("page").agg(F.collect_set(F.struct("first", "upto")).alias("spans"))
    gone = gone.select("page", F.array_distinct(F.flatten(F.transform("spans", lambda e: F.sequence(e["first"], e["upto"] - 1)))).alias("gone"))
    both = parts.select("page", "id", "url", "blocks", "wanted").join(small(written(gone, "template-blocks")), "page", "left")
    numbered = F.filter(F.transform("blocks", lambda b, i: F.struct(b.alias("b"), i.cast("int").alias("i"), F.get("wanted", i).alias("w"))), lambda x: x["w"])
    left = F.filter(numbered, lambda x: F.col("gone").isNull() | ~F.array_contains("gone", x["i"]))
    text = F.array_join(F.transform(left, lambda x: x["b"]), "\n")
    return both.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))
