"""Main text of web pages by tree scoring.

Every block of text gives points (one, one for each comma, one for each 100
characters up to three), less its share of link text, to the element that holds
it. Points go on to all ancestors: whole where an element has all of them from
one child, which only wraps it, and ``DISCOUNT`` of them where they come from
several. So the element around scattered paragraphs outweighs each of them
however deep they stand. The element with most points, again less its link
share, is the best container; an ``article`` or ``main`` element around it takes
its place. Siblings of it that score well or read as text are kept too.

Parts that are no text of the article by their element or role (menus, headers,
footers, sidebars, notices, adverts, forms, comments) are left out, as are
those whose class or id says so and nothing else (``sidebar-left``). Where a name says
more (``social-policy``), links and place decide: such a part is kept with few
links, inside ``article`` or ``main`` or with ``READS`` characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rt rp button
    math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mtable mtr mtd semantics mstyle mpadded menclose mfenced""".split())
FURNITURE = frozenset("nav header footer aside form script style noscript template select option textarea input svg annotation annotation-xml iframe object canvas audio video dialog menu head title".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog status menu menubar toolbar form".split())
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsors sponsored promo promos promotion
    promoted banner banners cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login popup modal overlay
    sidebar sidebars sidenav nav navbar navigation menu menus menubar breadcrumb breadcrumbs crumbs footer masthead topbar toolbar related recommended
    recommendations share sharing social widget widgets pagination pager search header disqus respond replies feedback""".split()
)
# Words beside one of these that say nothing of the content.
PLAIN = frozenset(
    """a aside area article bar block body bottom box btn button buttons card cell center col column container content cta div el element fixed float full global group holder
    horizontal image img in inline inner item items js large layout left li link links list main message mobile module nav new outer page panel part position post primary region right
    row secondary section site skin slot small sticky story sub text tile title top unit vertical view widget wide wrap wrapper zone the of and for on by no is has""".split()
)
COMMENTS = re.compile(r"comments?(list|section|box|area|form|thread|wrap|body)?$|disqus$|respond$|repl(y|ies)$")
START = re.compile(r"(advert|sidebar|navbar|breadcrumb|newsletter|sponsor)")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table tbody thead".split())
DISCOUNT, READS = 0.55, 200
OFF, PERHAPS = 1, 2


def furniture(tag: str, attrs: dict[str, str | None]) -> int:
    """``OFF`` for a part that is no text of an article, ``PERHAPS`` where only a
    word among others of its class or id says so, else 0."""
    if tag in FURNITURE:
        return OFF
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I):
        return OFF
    if tag in ("html", "body", "main"):
        return 0
    if (attrs.get("role") or "").lower() in ROLES:
        return OFF
    found = 0
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = {t.lower() for t in TOKEN.findall(name) if not t.isdigit()}
        whole = {t for t in re.split(r"[^a-z0-9]+", name.lower()) if t and not t.isdigit()}
        if any(COMMENTS.match(t) for t in words | whole):
            return OFF
        marks = {t for t in words | whole if t in MARKS or START.match(t)}
        if marks and tag != "article" and not re.fullmatch("h[1-6]", tag):
            if min(len(words - marks - PLAIN), len(whole - marks - PLAIN)) == 0:
                return OFF
            found = PERHAPS
    return found


class PageTree(HTMLParser):
    """Elements by number (a parent is less than its children) and the blocks of
    text in page order, each with the element it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.off, self.main = ["#page"], [0], [False], [False]
        self.perhaps: list[int] = []
        self.open, self.links, self.buttons = [0], 0, 0
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.text: list[str] = []
        self.linked = self.pressed = 0

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text and self.pressed < len(text):  # a button alone is no text
                at = next(e for e in reversed(self.open) if self.tag[e] not in INLINE)
                self.blocks.append((at, text, min(self.linked, len(text))))
            self.text, self.linked, self.pressed = [], 0, 0

    def close_to(self, depth: int):
        if any(self.tag[e] not in INLINE for e in self.open[depth:]):
            self.flush()
        self.links -= sum(self.tag[e] == "a" for e in self.open[depth:])
        self.buttons -= sum(self.tag[e] == "button" for e in self.open[depth:])
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")
        elif tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag == "br":
            return
        if tag not in INLINE:
            for d in range(len(self.open) - 1, 0, -1):
                t = self.tag[self.open[d]]
                if t == "p" or t in CLOSES.get(tag, ()):
                    self.close_to(d)
                    if t == "p" or tag != "tr":
                        break
                elif t not in INLINE and not (tag == "tr" and t in ("td", "th")):
                    break
            self.flush()
        a = dict(attrs)
        kind = furniture(tag, a)
        off = self.off[self.open[-1]] or kind == OFF
        if kind == PERHAPS and not off:
            self.perhaps.append(len(self.tag))
        self.open.append(len(self.tag))
        self.tag.append(tag)
        self.parent.append(self.open[-2])
        self.off.append(off)
        self.main.append(not off and (tag in ("article", "main") or (a.get("role") or "").lower() in ("main", "article") or a.get("itemprop") == "articleBody"))
        self.links += tag == "a"
        self.buttons += tag == "button"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for d in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[d]]
            if t == tag:
                self.close_to(d)
                return
            if tag in INLINE and t not in INLINE:
                return

    def handle_data(self, data):
        if not self.off[self.open[-1]]:
            self.text.append(data)
            if (self.links or self.buttons) and (n := len(" ".join(data.split()))):
                self.linked += n * bool(self.links)
                self.pressed += n * bool(self.buttons)


def main_text(html: str | None) -> str:
    """The article of a page as blocks joined by line feeds; empty if it has none."""
    if not html:
        return ""
    page = PageTree()
    page.feed(html)
    page.close()
    page.flush()
    if not page.blocks:
        return ""
    n = len(page.tag)
    chars, linked, anchors = [0] * n, [0] * n, [0] * n
    for i, t in enumerate(page.tag):
        anchors[i] = int(t == "a" and not page.off[i])
    for at, text, links in page.blocks:
        chars[at] += len(text)
        linked[at] += links
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        anchors[p] += anchors[i]
    share = lambda e: linked[e] / chars[e] if chars[e] else 0.0
    inside = page.main[:]
    for i in range(1, n):
        inside[i] = inside[i] or inside[page.parent[i]]
    for i in page.perhaps:
        page.off[i] = share(i) > 0.3 or not (inside[i] or chars[i] >= READS)
    for i in range(1, n):
        page.off[i] = page.off[i] or page.off[page.parent[i]]
    page.blocks = [b for b in page.blocks if not page.off[b[0]]]
    if not page.blocks:
        return ""
    # Points an element holds itself, its children's, and how many children give some.
    points, passed, givers = [0.0] * n, [0.0] * n, [0] * n
    for at, text, links in page.blocks:
        own = (1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)) * (1 - links / len(text))
        # A paragraph scores for what holds it; text that stands in no paragraph scores for its own element.
        e = page.parent[at] if page.tag[at] in ("p", "li", "pre", "td", "th", "blockquote", "dd", "dt") or re.fullmatch("h[1-6]", page.tag[at]) else at
        points[e] += own
    for i in range(n - 1, -1, -1):
        points[i] += passed[i] if givers[i] == 1 and not points[i] else DISCOUNT * passed[i]
        if i and points[i]:
            passed[page.parent[i]] += points[i]
            givers[page.parent[i]] += 1
    score = [points[e] * (1 - share(e)) for e in range(n)]
    best = max(range(n), key=lambda e: (score[e], -e))
    if score[best] <= 0:
        return ""
    e = best
    while e:
        if page.main[e]:
            best = e
            break
        e = page.parent[e]
    kept = [False] * n
    kept[best] = True
    if best:
        least = max(10.0, score[best] * 0.2)
        for s in range(1, n):
            if page.parent[s] == page.parent[best] and s != best and not page.off[s] and chars[s]:
                reads = page.tag[s] != "a" and share(s) < 0.25
                kept[s] = reads and (score[s] >= least or page.tag[s] == page.tag[best] or page.tag[s] in ("p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure", "section") or bool(re.fullmatch("h[1-6]", page.tag[s])))
    own = kept[:]
    for i in range(1, n):
        kept[i] = own[i] or kept[page.parent[i]]
        if not inside[i] and page.tag[i] in LISTS and anchors[i] > 1 and share(i) > 0.8:  # a menu by its links
            kept[i] = False
    return "\n".join(text for at, text, _ in page.blocks if kept[at])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, url, text, n_chars (code
    points), one row per input row, repeated rows too. A null or empty page and
    one without an article have an empty text; an empty table has no rows. Of
    containers with equal points the first is taken. A page is one task's work,
    in time linear in its length but for the depth of open elements."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
