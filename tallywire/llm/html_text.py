"""Main text of web pages by tree scoring.

A page is read into a tree. Each block with text passes points, for its length and its commas, to the elements around
it: all to its parent, half to the next, less further up. An element's points are discounted by its link density.
The element with most points is the container; if it lies in an `article` or `main`, that is taken instead. Siblings of
a container that is neither are kept when they have a fair share of its points, or few links and prose; siblings of an
article when they have few links and are articles, or lie in the same `main`.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and reader comments are left
out wherever they stand, by element, role, class or id. Two kinds are judged by what they hold, once the page is read: a
form around most of the page's text and all its articles is no form, and a name that only contains a word of both uses ("share-price") stands
for article text if the element lies in an article, has few links and no marked part inside.

Edge cases: null or empty html, or a page without text, gives an empty text. Unclosed, misnested and stray tags are
read as browsers would nearly do; nothing recurses, so depth does not matter. Rows are kept as they are, repeats too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import ship_code

ship_code(__name__)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>",
    re.S,
)
ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: elements that never hold article text
OUT = frozenset(
    "head script style title noscript template iframe nav header footer aside form button select option textarea input label "
    "fieldset svg math canvas object embed audio video map dialog menu noembed noframes search".split()
)
#: roles, and words of classes and ids, of what is not the article
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments commentlist "
    "community consent cookie cookies copyright discussion disqus foot footer footnav gdpr header login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted "
    "promotion reactions recommended related replies reply respond responses rss share shares sharing sidebar sidebars signup "
    "skyscraper social sponsor sponsored subscribe subscription teaser toolbar tooltip topbar widget widgets".split()
)
ARTICLE_MARKS = frozenset("comment comments reply teaser related ad advert promo sponsored".split())
#: marks that article text uses too, and words that go with them where they do name another part
EITHER = frozenset(
    "alert alerts community copyright discussion notice notices promotion reactions recommended related replies responses share shares social".split()
)
USUAL = frozenset(
    "a and area article articles bar block body bottom box btn button buttons col column container content count counts footer group heading icon "
    "icons inner item items js legal like link links list lists main media module more news outer page panel post posts reader readers row section "
    "site stories story text the this title to tool tools top user users videos widget wrap wrapper you your".split()
)
#: marks that are common headings, so as an id they may name a section
HEADINGS = frozenset("community copyright discussion notice notices reactions responses".split())
BESIDE = frozenset("with has no without hide show near".split())
STATES = frozenset("open closed enabled disabled visible left right active".split())
#: elements whose own class does not decide
ROOTS = frozenset(("html", "body", "main", "article"))
#: a start tag of the first kind closes an open element of the second, up to the given borders
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_BORDERS = frozenset("article aside blockquote body button caption div dl fieldset figure footer form header html li main nav object section table td th ul ol".split())
TEXT_BLOCKS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure".split())
#: share of linked characters below which a part has few links, and characters of a block of prose
FEW_LINKS, PROSE = 0.25, 80
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
NOT_WORD = re.compile(r"[^a-z0-9]+")


#: what stands against an element: nothing, a name of both uses, a form, a mark, its kind
IN, DOUBT, FORM, MARKED, OUTSIDE = range(5)


def _marked(value: str, marks: frozenset) -> int:
    """MARKED if a name of the value names another part of a page, and does not say it is absent or beside ("has-sidebar").

    DOUBT if the names only hold marks of both uses beside words that do not go with another part.
    """
    worst = IN
    for name in {*value.lower().split(), *CAMEL.sub("-", value).lower().split()}:
        words = NOT_WORD.split(name)
        hits = [
            word
            for i, word in enumerate(words)
            if word in marks and not (i and words[i - 1] in BESIDE) and not (i + 1 < len(words) and words[i + 1] in STATES)
        ]
        if hits:
            both = EITHER.issuperset(hits) and not all(w in marks or w in USUAL or w.isdigit() or not w for w in words)
            worst = max(worst, DOUBT if both else MARKED)
    return worst


def _unwanted(name: str, attrs: str) -> int:
    worst = FORM if name == "form" else OUTSIDE if name in OUT else IN
    if worst == OUTSIDE or not attrs or attrs.isspace():
        return worst
    for found in ATTR.finditer(attrs):
        key = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return OUTSIDE
        if key == "role" and value.lower() in ROLES:
            return OUTSIDE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return OUTSIDE
        if key in ("class", "id") and (name not in ROOTS or name == "article"):
            mark = _marked(value, MARKS if name != "article" else ARTICLE_MARKS)
            if mark == MARKED and key == "id" and name in ("section", "div") and value.lower() in HEADINGS:
                mark = DOUBT
            worst = max(worst, mark)
    return worst


class Page:
    """The tree as lists by element number, in page order: a parent has a smaller number than its children."""

    def __init__(self, html: str):
        self.name, self.parent, self.out, self.link, self.block, self.why = ["#"], [-1], [False], [False], [0], [IN]
        self.texts: list[tuple[int, str]] = []  # (element, decoded text)
        self.stack = [0]
        at, size = 0, len(html)
        while at < size:
            tag = TAG.search(html, at)
            if tag is None:
                self._text(html[at:])
                break
            if tag.start() > at:
                self._text(html[at : tag.start()])
            at = tag.end()
            if tag["data"] is not None:
                self._text(tag["data"])
            elif tag["name"]:
                name = tag["name"].lower()
                if tag["end"]:
                    self._close(name)
                else:
                    self._open(name, tag["attrs"])
                    if name in RAW:
                        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
                        at = end.end()
                        self._close(name)

    def _text(self, text: str) -> None:
        here = self.stack[-1]
        if not self.out[here]:
            self.texts.append((here, unescape(text)))

    def _pop_to(self, names: set | frozenset, borders: set | frozenset) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.name[self.stack[i]]
            if name in names:
                del self.stack[i:]
                return
            if name in borders:
                return

    def _open(self, name: str, attrs: str) -> None:
        if name in BLOCK:
            self._pop_to({"p"}, P_BORDERS)
        if name in CLOSES:
            self._pop_to(*CLOSES[name])
        here, number = self.stack[-1], len(self.name)
        self.name.append(name)
        self.parent.append(here)
        self.why.append(_unwanted(name, attrs))
        self.out.append(self.out[here] or self.why[-1] >= MARKED)
        self.link.append(self.link[here] or name == "a")
        self.block.append(number if name in BLOCK else self.block[here])
        if name in BLOCK or name == "br":
            self.texts.append((here, "\n"))  # parts what stands before from what follows
        if name not in VOID and not (attrs and attrs.endswith("/") and name not in BLOCK):
            self.stack.append(number)

    def _close(self, name: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.name[self.stack[i]] == name:
                if name in BLOCK:
                    self.texts.append((self.parent[self.stack[i]], "\n"))
                del self.stack[i:]
                return
            if self.name[self.stack[i]] in ("article", "main", "table") and name not in BLOCK:
                return

    def _lengths(self) -> tuple[list[int], list[int], dict[int, list[int]]]:
        """Characters and linked characters of every element, and characters and commas that blocks hold themselves."""
        n = len(self.name)
        length, linked = [0] * n, [0] * n
        own: dict[int, list[int]] = {}
        for element, text in self.texts:
            size = len(text) - text.count("\n") if text.isspace() is False else 0
            if size and not self.out[element]:
                length[element] += size
                linked[element] += size * self.link[element]
                cell = own.setdefault(self.block[element], [0, 0])
                cell[0] += size
                cell[1] += text.count(",") + text.count("，") + text.count("、")
        for i in range(n - 1, 0, -1):
            length[self.parent[i]] += length[i]
            linked[self.parent[i]] += linked[i]
        return length, linked, own

    def _settle(self) -> None:
        """Take out forms and doubtful names that do not hold article text."""
        if not any(why in (DOUBT, FORM) for why in self.why):
            return
        n = len(self.name)
        length, linked, _ = self._lengths()
        # paragraphs, articles and marked parts inside; in an article
        parts, articles, marks, article = [0] * n, [0] * n, [0] * n, [False] * n
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            parts[up] += parts[i] + (self.name[i] == "p" and not self.out[i])
            articles[up] += articles[i] + (self.name[i] in ("article", "main") and not self.out[i])
            marks[up] += marks[i] + (self.why[i] == MARKED)
        for i in range(1, n):
            up = self.parent[i]
            article[i] = article[up] or self.name[up] in ("article", "main")
            if self.why[i] == FORM:
                stays = 2 * length[i] > length[0] and articles[i] == articles[0] and (articles[0] > 0 or parts[i] > 1)
            elif self.why[i] == DOUBT:
                stays = article[i] and not marks[i] and linked[i] < FEW_LINKS * length[i]
            else:
                stays = True
            self.out[i] = self.out[i] or self.out[up] or not stays

    def main_text(self) -> str:
        n = len(self.name)
        self._settle()
        length, linked, own = self._lengths()
        if not length[0]:
            return ""

        points = [0.0] * n
        for block, (size, commas) in own.items():
            value = 1 + commas + min(size / 100, 3)
            if self.name[block] not in TEXT_BLOCKS and self.name[block] not in ("li", "td", "th", "dd", "dt", "figcaption"):
                points[block] += value  # text straight in a container
            share, up = 1.0, self.parent[block]
            for level in range(6):
                if up < 0:
                    break
                points[up] += value * share
                share, up = 1 / (2 if level == 0 else 3 * level), self.parent[up]
        score = [p * (1 - linked[i] / length[i]) if length[i] and not self.out[i] else 0.0 for i, p in enumerate(points)]
        best = max(range(n), key=lambda i: (score[i], -i))
        kept = self._kept(best, score, length, linked, {b for b, (size, _) in own.items() if size >= PROSE})
        inside = [False] * n
        for i in range(n):
            inside[i] = i in kept or (i > 0 and inside[self.parent[i]])
        parts = [t if inside[e] else "\n" for e, t in self.texts if not self.out[e]]
        return " ".join("".join(parts).split())

    def _kept(self, best: int, score: list[float], length: list[int], linked: list[int], prose: set[int]) -> set[int]:
        top = up = best
        while up > 0:
            if self.name[up] == "article":
                top = up  # the outermost
            elif self.name[up] == "main":
                if self.name[top] != "article":
                    return {up}
                break
            up = self.parent[up]
        article = self.name[top] == "article"
        if not article and (best == 0 or self.name[best] in ("html", "body")):
            return {best}
        kept, around = {top}, self.parent[top]
        holds = set()  # elements with a block of prose
        for block in prose:
            while block > around and block not in holds:
                holds.add(block)
                block = self.parent[block]
        for i in range(around + 1, len(self.name)):
            if self.parent[i] == around and not self.out[i] and length[i]:
                few_links = linked[i] < FEW_LINKS * length[i]
                if article:
                    fair = few_links and (self.name[i] == "article" or self.name[around] == "main")
                else:
                    fair = score[i] >= 0.2 * score[best] or (few_links and (self.name[i] in TEXT_BLOCKS or i in holds))
                if fair:
                    kept.add(i)
        if not article and any(e == around and not t.isspace() for e, t in self.texts):
            kept = {around}  # text between the siblings belongs to them
        return kept


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *kept, html = batch.columns
        texts = pa.array((main_text(x.as_py()) for x in html), pa.string())
        yield pa.RecordBatch.from_arrays([*kept, texts], batch.schema.names)


def extract_text(pages: DataFrame, html_col: str = "html", to: str = "main_text") -> DataFrame:
    """`pages` with the column `to` in place of the html column and of any of that name. One pass, no shuffle."""
    kept = [c for c in pages.columns if c not in (html_col, to)]
    frame = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_col).alias(to))
    return frame.mapInArrow(_extracted, frame.withColumn(to, F.col(to).cast("string")).schema)
