"""Main text of web pages from streaming parser events.

The standard library's parser emits tags and text; each block of text becomes a line with its
characters, tags and link characters.  The text-to-tag ratio per line is smoothed with a Gaussian
and lines above the threshold (the standard deviation of the smoothed ratios, at most their mean)
cluster into content lines.  The content region is the smallest element that holds nearly all of
their text, or an article or main element that holds most of it, with its sibling parts.  Every line
of the region and every content line outside of it is kept, unless it is inside boilerplate (menus,
headers, footers, sidebars, notices, adverts, forms, comments).  A box with a class word that says so
plainly (advert, cookie, sidebar, footer, comments) goes wherever it stands, unless it holds the title
or half of the content.  Other class or id words such as "related" only vote inside the region: the
block goes if its own text-to-tag ratio or its links say so too.

Elements are numbered in the order they open, and each knows its range of lines, so sums over an
element are differences of running totals: the work grows with the page, not with its depth.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keelson.session import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Text that is never shown, or is not part of an article.
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title".split())
ASIDE = frozenset("nav footer aside form button select option textarea label fieldset dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
# Elements that can be the content region.
CONTAINERS = frozenset("html body div section article main center td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that a class or id word can mark as a boilerplate block.
BOXES = frozenset("div section ul ol dl table tbody tr td header figure center details".split())
# Class or id words that mark boilerplate, and roles that do.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies share sharing social related recommended widget toolbar pagination pager copyright skip".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
# A name such as has-sidebar or with-comments describes a container, not the part itself.
_ABOUT = frozenset("has with no without page layout is js".split())


# A header block inside an article holds its title.
MARKS_INSIDE = MARKS - {"header"}
# Readers' comments, by names made of nothing but these words.
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
_OF_COMMENTS = COMMENTS | frozenset("list area body section form thread item wrap wrapper container content box meta author text template count".split())


# Class words that say plainly what a box is.
PLAIN = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar footer cookie cookies consent gdpr notice notices newsletter subscribe subscription signup popup modal".split())
TALK = frozenset("comment comments disqus".split())
# May be a part of the text or the readers' comments on it.
EITHER = frozenset("discussion discussions".split())


def split_words(name: str) -> list[str]:
    return [w.lower() for w in _SPLIT.split(name) if w]


def marked(names: str, marks: frozenset = MARKS) -> bool:
    """True if one of the class names (or the id) starts or ends with a boilerplate word."""
    for name in names.split():
        words = split_words(name)
        if words and words[0] not in _ABOUT and (words[0] in marks or words[-1] in marks):
            return True
    return False


def of_comments(names: str) -> bool:
    """True if one of the names says nothing else than readers' comments."""
    return any(not COMMENTS.isdisjoint(words) and _OF_COMMENTS.issuperset(words) for words in map(split_words, names.split()))


def plain_words(names: str, sure: frozenset) -> bool:
    """True if a name starts or ends with one of the words (or holds a word of ``TALK``, if that is asked)."""
    for words in map(split_words, names.split()):
        if words and words[0] not in _ABOUT and words[:2] != ["ad", "hoc"]:
            if words[0] in sure or words[-1] in sure or sure is TALK and not TALK.isdisjoint(words):
                return True
    return False


# Elements that a start tag closes when they are still open.
CLOSED_BY = {"p": frozenset("p"), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
_ENDS_P = BLOCKS - {"br"}
SIGMA = 1.0
# Share of the content lines' text that makes an article or main element the region.
MOST = 0.7
# Share of it that any other region must hold.
NEARLY = 0.95
# A block with a boilerplate class goes if its own ratio is below this share of the threshold.
THIN = 0.25


class Mark:
    """An element with a boilerplate word: its id if only that has one, where it stands, and whether
    its names are plain, mean readers' comments or may mean them."""
    __slots__ = ("box", "slug", "inner", "header", "plain", "talk", "either")

    def __init__(self, box: bool, slug: str | None, inner: bool, header: bool, plain: bool, talk: bool, either: bool):
        self.box, self.slug, self.inner, self.header, self.plain, self.talk, self.either = box, slug, inner, header, plain, talk, either


class Line:
    __slots__ = ("parts", "tags", "links", "head")

    def __init__(self):
        self.parts, self.tags, self.links, self.head = [], 0, 0, ""


class Events(HTMLParser):
    """Parser events -> lines outside of certain boilerplate, and the elements they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # name, number, boilerplate
        self.names: Counter = Counter()  # open elements by name
        self.blocks: list[int] = []      # places of block elements in ``open``
        self.nodes: list[int] = [0]      # open containers and marked elements
        self.number = 0
        self.off = 0      # open boilerplate elements
        self.link = 0     # open links
        self.article = 0  # open article or main elements
        self.named: list[int] = []  # article and main elements
        self.talk: list[int] = []   # elements of readers' comments
        self.marks: dict[int, Mark] = {}
        self.about: dict[int, tuple] = {0: (0, "", frozenset())}  # container -> parent, name, classes
        self.lines = [Line()]
        self.span: dict[int, tuple[int, int]] = {0: (0, 0)}  # container or marked element -> its lines
        self.last: dict[int, int] = {0: 0}  # ... -> the largest number inside of it

    def close(self):
        super().close()
        while self.open:
            self._pop()
        self.span[0], self.last[0] = (0, len(self.lines)), self.number

    def _break(self):
        if self.lines[-1].parts:
            self.lines.append(Line())
        else:
            self.lines[-1].head = ""

    def _pop(self):
        name, number, off = self.open.pop()
        self.names[name] -= 1
        self.off -= off
        self.link -= name == "a"
        self.article -= name in ("article", "main")
        if self.blocks and self.blocks[-1] == len(self.open):
            self.blocks.pop()
        if self.nodes[-1] == number:
            self.nodes.pop()
            self.span[number] = (self.span[number][0], len(self.lines) - (not self.lines[-1].parts))
            self.last[number] = self.number

    def _boilerplate(self, tag: str, attrs: list) -> bool:
        if tag in HIDDEN or tag in ASIDE or (tag == "header" and not self.article):
            return True
        if tag in ("article", "main", "body", "html"):
            return tag == "article" and any(n in ("class", "id") and v and of_comments(v) for n, v in attrs)
        for name, value in attrs:
            if name == "role" and (value or "").lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name in ("class", "id") and value and tag in BOXES and of_comments(value):
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _mark(self, tag: str, attrs: list) -> Mark | None:
        if tag not in BLOCKS or tag in HEADINGS or tag in ("article", "main", "body", "html"):
            return None
        marks = MARKS_INSIDE if self.article else MARKS
        names = {n: v for n, v in attrs if n in ("class", "id") and v}
        box = tag in BOXES
        # An id of a section is a link target more often than a kind.
        kinds = [v for n, v in names.items() if n == "class" or tag != "section"] if box else []
        talk = any(plain_words(v, TALK) for v in kinds)
        either = not talk and any(plain_words(v, EITHER) for v in kinds)
        found = {n: v for n, v in names.items() if marked(v, marks)}
        if not found and not talk and not either:
            return None
        plain = any(plain_words(v, PLAIN) for v in kinds)
        header = bool(found) and not any(marked(v, MARKS_INSIDE) for v in found.values())
        return Mark(box, None if "class" in found or not found else found["id"], self.article > 0, header, plain, talk, either)

    def handle_starttag(self, tag, attrs):
        self.lines[-1].tags += not self.off
        if tag in BLOCKS:
            if tag in _ENDS_P or tag in CLOSED_BY:
                self._close_implied(tag)
            self._break()
        if tag in VOID:
            return
        off = self._boilerplate(tag, attrs)
        self.number += 1
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, self.number, off))
        self.names[tag] += 1
        self.off += off
        self.link += tag == "a"
        mark = None if self.off else self._mark(tag, attrs)
        if mark:
            self.marks[self.number] = mark
        if mark and mark.talk or off and any(n in ("class", "id") and v and of_comments(v) for n, v in attrs):
            self.talk.append(self.number)
        if tag in CONTAINERS:
            self.about[self.number] = (self.nodes[-1], tag, frozenset((dict(attrs).get("class") or "").split()))
        if mark or tag in CONTAINERS:
            self.nodes.append(self.number)
            self.span[self.number] = (len(self.lines) - 1, 0)
        self.article += tag in ("article", "main")
        if not self.off and tag in ("article", "main"):
            self.named.append(self.number)
        if tag in HEADINGS:
            self.lines[-1].head = tag

    def _close_implied(self, tag: str):
        """A block start closes an open p, an item start closes the open item, up to the nearest block."""
        if self.blocks and self.open[self.blocks[-1]][0] in CLOSED_BY.get(tag, frozenset()) | {"p"}:
            to = self.blocks[-1]
            while len(self.open) > to:
                self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.lines[-1].tags += not self.off
        if not self.names[tag]:
            return
        while self.open:
            last = self.open[-1][0]
            self._pop()
            if last == tag:
                break
        if tag in BLOCKS:
            self._break()

    def handle_data(self, data):
        if self.off:
            return
        line = self.lines[-1]
        if not line.parts and data.isspace():
            return
        line.parts.append(data)
        if self.link:
            line.links += len(data)


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over the lines (the kernel reaches three sigma)."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(soft: np.ndarray) -> float:
    return min(soft.std(), soft.mean())


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Flags of the lines in content clusters."""
    soft = smooth(ratios)
    return soft >= threshold(soft)


class Page:
    """The lines with text of a page; sums over the lines of an element."""

    def __init__(self, events: Events):
        self.events, self.texts, self.lines = events, [], []
        before = [0]  # lines with text before each line
        for line in events.lines:
            text = " ".join("".join(line.parts).split())
            if text:
                self.lines.append(line)
                self.texts.append(text)
            before.append(len(self.texts))
        self.span = {n: (before[lo], before[max(lo, hi)]) for n, (lo, hi) in events.span.items()}
        self.size = np.array([len(t) for t in self.texts], dtype=float)
        self.own = self.size - np.minimum(self.size, [line.links for line in self.lines])
        self.tags = np.array([line.tags for line in self.lines], dtype=float)
        if len(self.texts):
            self.soft = smooth(self.own / np.maximum(1, self.tags))
            self.bar = threshold(self.soft)
            self.chosen = self.soft >= self.bar
            self.title = self.totals(np.array([line.head == "h1" for line in self.lines], dtype=float))
            self.of_size, self.of_own, self.of_tags = self.totals(self.size), self.totals(self.own), self.totals(self.tags)
            self.of_weight = self.totals(self.own * self.chosen)

    @staticmethod
    def totals(values: np.ndarray) -> np.ndarray:
        return np.r_[0, np.cumsum(values)]

    def sum(self, totals: np.ndarray, n: int) -> float:
        lo, hi = self.span[n]
        return float(totals[hi] - totals[lo])

    def within(self, elements) -> np.ndarray:
        """Flags of the lines in any of the elements."""
        edge = np.zeros(len(self.lines) + 1, np.int64)
        for n in elements:
            lo, hi = self.span[n]
            edge[lo] += 1
            edge[hi] -= 1
        return np.cumsum(edge[:-1]) > 0


class Marked:
    """Judges the marked blocks of a page: ``gone`` are boilerplate, ``doubt`` waits for the region."""

    def __init__(self, page: Page):
        self.page, self.events = page, page.events
        self.gone: set[int] = set()
        self.doubt: set[int] = set()
        for m, mark in self.events.marks.items():
            if page.span[m][0] == page.span[m][1]:
                continue
            if self._plainly(m):
                self.gone.add(m)
            elif not (mark.plain or self.words(m)):
                continue  # may be comments, but is not
            elif mark.inner:
                if self._voted(m):
                    self.gone.add(m)
            elif not (self._titled(m) and not self._linked(m) or self._wraps(m)):
                self.doubt.add(m)

    def words(self, m: int) -> bool:
        """There is more to the block than a name that may mean comments."""
        return not self.events.marks[m].either

    def _inside(self, numbers: list[int], m: int) -> int:
        """How many of the (ascending) element numbers are inside of the block."""
        return bisect_right(numbers, self.events.last[m]) - bisect_left(numbers, m + 1)

    def _plainly(self, m: int) -> bool:
        """The block is what its names say: it is not the title's place, nor half of the content (for
        comments: half of it, with an article among them)."""
        mark, page = self.events.marks[m], self.page
        talk = mark.talk or mark.either and not self._chapter(m)
        if not mark.box or not (mark.plain or talk) or page.sum(page.title, m) or mark.plain and not talk and self._titled(m) and not self._linked(m):
            return False
        most = 2 * page.sum(page.of_weight, m) >= page.of_weight[-1] > 0
        return not most or talk and not self._inside(self.events.named, m)

    def _chapter(self, m: int) -> bool:
        """A part of the text under a heading of its own, without anything marked as a comment."""
        first = self.page.span[m][0]
        return bool(self.page.lines[first].head) and not EITHER.isdisjoint(split_words(self.page.texts[first])) and not self._inside(self.events.talk, m)

    def _linked(self, m: int) -> bool:
        return 2 * self.page.sum(self.page.of_own, m) < self.page.sum(self.page.of_size, m)

    def _titled(self, m: int) -> bool:
        """The id is the block's own heading, so it is a link target and says nothing about its role."""
        mark, first = self.events.marks[m], self.page.span[m][0]
        if not mark.slug or not self.page.lines[first].head:
            return False
        return mark.inner or set(split_words(self.page.texts[first])).issuperset(split_words(mark.slug))

    def _wraps(self, m: int) -> bool:
        """The block is the page's main part: it has the title or the article and most of the content."""
        named, page = self.events.named, self.page
        if self._inside(named, m) < len(named) or not named and not page.sum(page.title, m):
            return False
        return page.sum(page.of_weight, m) >= MOST * page.of_weight[-1]

    def _voted(self, m: int) -> bool:
        """The block's own ratio or its links say boilerplate too."""
        mark, page = self.events.marks[m], self.page
        if not mark.box:
            return False
        if self._linked(m):
            return True
        if self._titled(m):
            return False
        ratio = page.sum(page.of_own, m) / max(1, page.sum(page.of_tags, m))
        return ratio < (THIN if mark.slug else 1) * page.bar

    def free(self) -> np.ndarray:
        """Flags of the lines outside of boilerplate and of doubtful blocks."""
        return ~self.page.within(self.gone | self.doubt)

    def settle(self, region: set[int]) -> None:
        """Doubtful blocks outside of the region go, those inside of it are voted on."""
        whole = any(self.events.about[n][1] in ("", "html", "body") for n in region)
        inside = self.page.within(region)
        for m in self.doubt:
            mark = self.events.marks[m]
            if not inside[self.page.span[m][0]]:
                self.gone.add(m)
            elif whole:
                if mark.box:
                    self.gone.add(m)
            elif not (mark.header and self.page.sum(self.page.title, m)) and self._voted(m):
                self.gone.add(m)
        self.doubt = set()


def content_region(page: Page, free: np.ndarray) -> set[int]:
    """The elements whose free lines are content (0 is the whole page)."""
    events = page.events
    inside = page.totals((page.own * page.chosen + 1e-9 * page.size) * free)
    links = page.totals((page.size - 2 * page.own) * free)  # link characters less the others
    some = page.totals(free.astype(float))
    total, named = inside[-1], set(events.named)
    # An inner element has a larger number than the outer one.
    whole = [n for n in events.about if page.sum(some, n) and page.sum(inside, n) >= NEARLY * total]
    hints = [n for n in events.named if page.sum(inside, n) >= MOST * total]
    region = max((n for n in whole if events.about[n][1] in ("article", "main") and n in named), default=None)
    if region is None:
        region = max(hints, key=lambda n: (page.sum(inside, n), n)) if hints else max(whole, default=0)
    parent, tag, classes = events.about[region]
    # Parts of one text stand side by side in elements of the same kind.
    parts = {region}
    if region and (classes or tag in ("article", "section")):
        for n, (up, name, names) in events.about.items():
            alike = names == classes or tag in ("article", "section") and not names.isdisjoint(classes)
            if name == tag and alike and (tag == "article" or up == parent) and page.sum(links, n) <= 1e-6:
                parts.add(n)
    return parts


def extract(html: str | None) -> tuple[str, list[str]]:
    """(text, its blocks) of one page."""
    if not html:
        return "", []
    events = Events()
    events.feed(html)
    events.close()
    page = Page(events)
    if not page.texts:
        return "", []
    marked_blocks = Marked(page)
    free = marked_blocks.free()
    if not free.any():
        return "", []
    region = content_region(page, free)
    marked_blocks.settle(region)
    free = marked_blocks.free()
    wanted = free & (page.chosen & (2 * page.own > page.size) | page.within(region))
    blocks = [t for t, w in zip(page.texts, wanted) if w]
    return " ".join(blocks), blocks


def _extract(html: str, names: list[str]):
    def run(batches):
        for batch in batches:
            found = [extract(h) for h in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([t for t, _ in found], pa.string()), pa.array([b for _, b in found], pa.list_(pa.string()))], names=[*names, "_text", "_blocks"])

    return run


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Adds ``_text`` (the blocks joined by one space) and ``_blocks`` to the columns ``keep``
    (default: all).  One map pass, no shuffle, whole pages.

    Null, empty and text-free pages: empty text, no blocks.  Markup that is never closed counts as
    closed at the end.  Repeated rows are extracted each; an empty table gives no rows.
    """
    ship(pages.sparkSession)
    names = list(keep if keep is not None else pages.columns)
    clash = {"_text", "_blocks"} & set(names)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    schema = T.StructType([*[pages.schema[n] for n in names], T.StructField("_text", T.StringType()), T.StructField("_blocks", T.ArrayType(T.StringType()))])
    return pages.select(*dict.fromkeys([*names, html])).mapInArrow(_extract(html, names), schema)
