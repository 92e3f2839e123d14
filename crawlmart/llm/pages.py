"""Main text of HTML pages by the ratio of text to tags.

The parser of the standard library streams a page's events. Block tags cut it into lines; each
line knows its characters, its tags and its characters inside links, and whether it stands in
a part that is no content: menus, headers, footers, sidebars, forms, scripts, comments of
readers and the like. Tag, role and the words of class and id are evidence for that, and the
share of the page's text that the part holds, or of an article in it, is evidence against it.
The ratio of characters to
tags is smoothed over neighbouring lines by a Gaussian, and a two-means clustering of the
smoothed ratios gives the threshold of content. Where a page marks articles, each adds to the
score of its lines what its text weighs against the text outside of all marks, and nothing if
it is a small part, such as a teaser. Regions are the marked articles, boxes and runs of
blocks with content in them; only lists of links go from a region.

A page is cut into text and tags before the parser gets them one by one, so that each place
is looked at once whatever the markup: comments end at ``-->`` or, if that is missing, at the
next ``>``, as do declarations and marked sections; a tag ends at the first ``>`` outside of
its quoted values, or, once one has no such end, at the first of all.

Defined results: a null or empty page has no text; equal rows give equal results; a tag or
comment that the page's end cuts off is left out, with what follows its ``<``; all else of a
page is read; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmart.llm.common import small_batches

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: Their text is no part of what a page says.
SILENT = frozenset(
    "script style noscript template head title svg math iframe object canvas video audio map "
    "select option datalist textarea".split()
)
NOT_CONTENT = frozenset("nav header footer aside form button dialog menu fieldset".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu "
    "menubar toolbar".split()
)
#: Words of class and id that mark a part as no content.
WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer header "
    "masthead cookie cookies consent gdpr notice notification alert popup modal overlay "
    "newsletter subscribe signup login form search share sharing social related recommended "
    "recommendations comment comments disqus replies respond widget toolbar pagination pager "
    "skip copyright legal tags".split()
)
#: The others of the tags, roles and words above also stand at wrappers of whole pages.
WEAK = frozenset("form fieldset".split())
STRONG_WORDS = frozenset("comment comments disqus replies respond".split())
#: What a class has, or has not, it is not itself.
MODIFIERS = frozenset("has with no without".split())
ARTICLE = frozenset("article main".split())
#: An open paragraph ends where one of these begins.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An open one of these ends where its like begins.
ENDS_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: They make up a box of text and are none themselves.
NO_BOX = HEADINGS | frozenset(
    "html body p li ul ol dl dt dd blockquote pre figure figcaption table caption thead tbody "
    "tfoot tr hr address center".split()
)
SPACE = re.compile(r"\s+")
#: What stands in them is no markup.
RAW = re.compile(r"(?i)(?:script|style|textarea|title|iframe|xmp|noembed|noframes)\Z")
TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)")
#: The rest of a tag; a quote that nothing closes is a character like any other.
REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")
ATTRIBUTE = re.compile(r"""([^\s/>="']++)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
TOLD = frozenset("class id role hidden aria-hidden style".split())  # attributes that are read


@dataclass(frozen=True)
class Ratio:
    radius: int = 2  # lines on either side that the smoothing reaches
    sigma: float = 1.0
    rounds: int = 20  # of the clustering, at most
    full: float = 50.0  # characters to a tag, from which more are no further evidence of text
    apart: float = 4.0  # times that one mean is of the other, if there are two clusters
    link_share: float = 0.8  # of a line's characters, from which it is a link
    strong: float = 20.0  # times the text outside of strong marks that one must hold to count
    spare: int = 10  # characters that are added to that text
    held: float = 8.0  # times that the text of an article inside a part weighs more
    mark: float = 4.0  # added to the logarithm in an article as large as the unmarked text
    slope: float = 3.0  # of that, by the logarithm of the article's size against that text


@dataclass
class Line:
    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    bar: int = 0  # number of the innermost part around it that is marked as no content
    article: int = 0  # number of the outermost marked article around it
    inner: int = 0  # of the innermost
    heading: bool = False
    box: int = 0

    def joined(self) -> str:
        return SPACE.sub(" ", "".join(self.text)).strip()


def _words(value: str) -> set[str]:
    """Words of a class or id, without those that follow a modifier."""
    out: set[str] = set()
    for token in value.split():
        words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
        for word in words:
            if word in MODIFIERS:
                break
            out.add(word)
    return out


def _marks(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[int, bool]:
    """(no content: 0 no mark, 1 weak, 2 strong; article) of a start tag."""
    bar, article = 0, tag in ARTICLE
    if tag in NOT_CONTENT:
        bar = 1 if tag in WEAK else 2
    for name, value in attrs:
        word = (value or "").strip().lower()
        if name == "hidden":
            bar = 2
        elif name == "role":
            if word in ROLES:
                bar = max(bar, 1 if word in WEAK else 2)
            article = article or word in ARTICLE
        elif name in ("class", "id"):
            words = _words(value or "")
            bar = max(bar, 2 if words & STRONG_WORDS else 1 if words & WORDS else 0)
        elif name == "aria-hidden" and word == "true":
            bar = 2
        elif name == "style" and re.search(r"display\s*:\s*none", value or ""):
            bar = 2
    return bar if tag not in ("body", "html") else 0, article


class _Lines(HTMLParser):
    """Cuts a page into lines. Keeps the open tags, each with what it marks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines = [Line()]
        #: tag, article, silent, and the bar, the box and the article around it
        self.open: list[tuple[str, bool, bool, int, int, int]] = []
        self.bars = [(0, 0, 0)]  # of each its strength, and the bar and the article around it
        self.bar = 0
        self.marked = [0]  # of each article the bar it is to be weighed for
        self.inner = 0
        self.boxes = [0]  # of each box the one around it
        self.box = 0
        self.depth: Counter[str] = Counter()  # how many of each tag are open
        self.articles = self.silent = self.links = 0
        self.article = 0  # number of the last outermost marked article

    def _push(self, tag: str, bar: int, article: bool) -> None:
        silent = tag in SILENT
        self.open.append((tag, article, silent, self.bar, self.box, self.inner))
        around = self.bar
        if bar:
            self.bars.append((bar, around, self.inner))
            self.bar = len(self.bars) - 1
        if article:  # a strong mark at an article itself is about the article
            self.marked.append(around if bar == 2 else self.bar)
            self.inner = len(self.marked) - 1
        if tag not in INLINE and tag not in NO_BOX:
            self.boxes.append(self.box)
            self.box = len(self.boxes) - 1
        self.depth[tag] += 1
        self.article += article and not self.articles
        self.articles += article
        self.silent += silent
        self.links += tag == "a"

    def _pop(self) -> None:
        tag, article, silent, self.bar, self.box, self.inner = self.open.pop()
        self.depth[tag] -= 1
        self.articles -= article
        self.silent -= silent
        self.links -= tag == "a"

    def _close(self, tag: str) -> None:
        if self.depth[tag]:
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()

    def _new_line(self) -> None:
        line = self.lines[-1]
        if line.text or line.tags:
            self.lines.append(Line())
        self.lines[-1].bar = self.bar
        self.lines[-1].article = self.article if self.articles else 0
        self.lines[-1].inner = self.inner
        self.lines[-1].box = self.box

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            if self.open[-1][0] == tag and tag not in VOID:
                self._push(tag, 0, False)
            elif tag != "body" or not self.depth["head"]:
                return
            else:  # a head that was never closed ends at the body
                self._close("head")
        if tag in ENDS_P and self.open and self.open[-1][0] == "p":
            self._pop()
        elif tag in ENDS_LIKE and self.open and self.open[-1][0] in ENDS_LIKE[tag]:
            self._pop()
        bar, article = _marks(tag, attrs)
        if tag not in VOID:
            self._push(tag, bar, article)
        if tag not in INLINE or bar:
            self._new_line()
        self.lines[-1].tags += 1
        self.lines[-1].heading = self.lines[-1].heading or tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        block = tag not in INLINE or any(x[0] == tag and x[3] != self.bar for x in self.open[-1:])
        self.lines[-1].tags += 1
        self._close(tag)
        if block and not self.silent:
            self._new_line()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.lines[-1].text.append(data)
            if self.links:
                self.lines[-1].linked += len(data.strip())


def pieces(page: str) -> Iterator[str]:
    """The text and the tags of a page in order, each tag with the attributes that are read."""
    n, at, quotes = len(page), 0, True
    last, comments = page.rfind(">"), page.rfind("-->")
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield page[at:]
            return
        if i > at:
            yield page[at:i]
        kind = page[i + 1 : i + 2]
        name = TAG.match(page, i)
        if not name and (not kind or kind not in "/!?"):
            yield "&lt;"
            at = i + 1
            continue
        if i > last:  # the page ends inside it
            return
        if not name:
            if page.startswith("<!--", i) and i + 2 <= comments:
                at = page.find("-->", i + 2) + 3
                continue
            end = page.find(">", i + 1)
            at = end + 1
            closed = re.match(r"[a-zA-Z][^\s/>]*", page[i + 2 : end]) if kind == "/" else None
            if closed:
                yield f"</{closed[0]}>"
            continue
        rest = REST.match(page, name.end()) if quotes else None
        if rest is None:
            quotes = False
            at = page.find(">", i) + 1
        else:
            at = rest.end()
        written = page[name.end() : at - 1]
        told = [
            f' {m[1].lower()}="{(m[2] or m[3] or m[4] or "").replace(chr(34), "&quot;")}"'
            for m in (ATTRIBUTE.finditer(written) if written and not written.isspace() else ())
            if m[1].lower() in TOLD
        ]
        tag = name[1].replace('"', "").replace("'", "").replace("<", "").replace("=", "")
        yield f"<{tag}{''.join(told)}{'/' * written.endswith('/')}>"
        if RAW.match(tag) and not written.endswith("/"):
            closing = re.compile(f"(?i)</{re.escape(tag)}(?=[\\s/>])").search(page, at)
            at = closing.start() if closing else n


def smoothed(values: list[float], ratio: Ratio) -> list[float]:
    """A Gaussian mean of each value and its neighbours."""
    reach = range(-ratio.radius, ratio.radius + 1)
    kernel = [math.exp(-(k**2) / (2 * ratio.sigma**2)) for k in reach]
    out = []
    for i in range(len(values)):
        near = [(w, values[i + k]) for k, w in zip(reach, kernel, strict=True) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def threshold(values: list[float], ratio: Ratio) -> float:
    """Half way between the two means of the logarithms; below all if they are no two clusters."""
    low, high = min(values), max(values)
    for _ in range(ratio.rounds):
        cut = (low + high) / 2
        below = [v for v in values if v < cut]
        above = [v for v in values if v >= cut]
        new = (sum(below) / len(below) if below else low, sum(above) / len(above))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low > math.log(ratio.apart) else -math.inf


def boxes_of(lines: list[Line], around: list[int]) -> list[int]:
    """The box of each line. A box with one line belongs to the box around it, if that is none
    of the page's own."""
    held = [0] * len(around)
    for line in lines:
        held[line.box] += 1
    for box in range(len(around) - 1, 0, -1):
        held[around[box]] += held[box]
    out = []
    for line in lines:
        box = line.box
        while held[box] == 1 and around[box]:
            box = around[box]
        out.append(box)
    return out


def no_content(lines: list[tuple[Line, str]], parser: _Lines, ratio: Ratio) -> list[bool]:
    """Whether each bar holds, strong ones first. One does not where its part, or an article in
    it, holds so much of the text that its marks cannot be about the content; an article
    elsewhere counts for more than its text. Weak bars that would leave no text do not hold
    either."""
    bars = parser.bars
    sizes = [max(0, len(text) - x.linked) for x, text in lines]
    within = [False] * len(bars)  # a part with strong marks
    for b, (strength, around, _) in enumerate(bars):
        within[b] = strength == 2 or within[around]
    free = sum(n for (x, _), n in zip(lines, sizes, strict=True) if not within[x.bar])
    holds, strong = [False] * len(bars), [False] * len(bars)
    for level in (2, 1):
        whole, marked = [0] * len(bars), [0] * len(parser.marked)
        for (x, _), n in zip(lines, sizes, strict=True):
            if not holds[x.bar]:
                whole[x.bar] += n
                marked[x.inner] += n
        total, left, article = sum(whole), list(whole), [0] * len(bars)
        for n, b in zip(marked[1:], parser.marked[1:], strict=True):
            article[b] = max(article[b], n)
        inside, most = list(article), max(article)  # largest articles, in whatever holds
        for b in range(len(bars) - 1, 0, -1):
            strength, around, in_article = bars[b]
            if strength == level and not holds[b]:
                other = ratio.strong * (free + ratio.spare) if level == 2 else 0.0
                if not in_article and most > inside[b]:
                    other = max(other, ratio.held * most)
                rest = (0, 0) if level == 2 else (total - whole[b], total - article[b])
                much = left[b] > max(other, rest[0]) or ratio.held * article[b] > max(other, rest[1])
                holds[b] = not much
            whole[around] += whole[b]
            inside[around] = max(inside[around], inside[b])
            if not holds[b]:
                left[around] += left[b]
                article[around] = max(article[around], article[b])
        for b, (_, around, _) in enumerate(bars):
            holds[b] = holds[b] or holds[around]
        if level == 2:
            strong = list(holds)
    some = any(n and not holds[x.bar] for (x, _), n in zip(lines, sizes, strict=True))
    return holds if some else strong


def priors(lines: list[tuple[Line, str]], ratio: Ratio) -> dict[int, float]:
    """What each marked article adds to the score of its lines."""
    size: Counter[int] = Counter()
    for x, text in lines:
        size[x.article] += max(0, len(text) - x.linked)
    out = {0: 0.0}
    for article, n in size.items():
        if article:
            against = math.log(n / size[0]) if n and size[0] else math.inf if n else -math.inf
            out[article] = min(ratio.mark, max(0.0, ratio.mark + ratio.slope * against))
    return out


def main_text(page: str | None, ratio: Ratio = Ratio()) -> str:
    if not page:
        return ""
    parser = _Lines()
    for piece in pieces(page):
        parser.feed(piece)
    parser.close()
    lines = [(x, x.joined()) for x in parser.lines]
    lines = [(x, text) for x, text in lines if text]
    barred = no_content(lines, parser, ratio)
    lines = [(x, text) for x, text in lines if not barred[x.bar]]
    if not lines:
        return ""

    link = [x.linked >= ratio.link_share * len(text) for x, text in lines]
    ratios = [len(text) / max(1, x.tags) for x, text in lines]
    dense = smoothed([math.log1p(min(r, ratio.full)) for r in ratios], ratio)
    prior = priors(lines, ratio)
    dense = [v + prior[x.article] for v, (x, _) in zip(dense, lines, strict=True)]
    cut = threshold(dense, ratio)
    chosen = [i for i, v in enumerate(dense) if v >= cut and not link[i]]
    # Short lines between content, in a box or an article with content, and headings above it
    # belong to its region.
    boxes = boxes_of([x for x, _ in lines], parser.boxes)
    full = {(lines[i][0].article, boxes[i]) for i in chosen}
    ends: dict[int, tuple[int, int]] = {}
    for i in chosen:
        article = lines[i][0].article
        ends[article] = (ends.get(article, (i, i))[0], i)
    taken = []
    for i, (x, _) in enumerate(lines):
        first, last = ends.get(x.article, (i + 1, i))
        within = first <= i <= last or (x.article, boxes[i]) in full
        taken.append(within or first <= last and prior[x.article] > 0)
    for i in range(len(lines) - 2, -1, -1):
        same = lines[i][0].article == lines[i + 1][0].article
        taken[i] = taken[i] or lines[i][0].heading and same and taken[i + 1]
    # Lists of links do not; one link between lines of text does, and a heading that is one.
    text_at = [x and not y for x, y in zip(taken, link, strict=True)]

    def stays(i: int) -> bool:
        if not taken[i] or not link[i]:
            return taken[i]
        near = [k for k in (i - 1, i + 1) if 0 <= k < len(lines) and text_at[k]]
        return len(near) == 2 or lines[i][0].heading and i + 1 in near

    return " ".join(text for i, (_, text) in enumerate(lines) if stays(i))


def extract(pages: DataFrame, ratio: Ratio = Ratio()) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py(), ratio) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(x) for x in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    small_batches(pages.sparkSession)
    plain = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(run, schema)
