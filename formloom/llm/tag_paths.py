"""Main text of web pages by tag-path ratios (operator 5).

Method: the blocks of a page are gathered by their root-to-leaf path of block
tags.  Each path has its text length and punctuation per block, smoothed over
neighbouring blocks; its share of link text and class or id words of
boilerplate lower the fused ratio.  The best path's parent (or its article) is
the content container.  Ratios decide everywhere: a path outside the container
stays at a good share of the best one, a path inside it at a small share, and
the short blocks of an article (paragraphs, headings, items, cells) unless
links or boilerplate words speak against them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_of

#: Shares of the best ratio at which a path stays: outside an article or main
#: element; outside another container; inside a container, where text stands
#: loose in it or its leaf is hinted at; inside an article; and inside, where the
#: leaf is a part of running text (hinted ones as inside an article).
OUTSIDE_ARTICLE, OUTSIDE, LOOSE, INSIDE, FLOW_INSIDE = 1.0, 0.25, 0.4, 0.05, 0.005
#: Factor for each element of a path whose class or id hints at boilerplate.
HINTED = 0.2

SILENT = frozenset("script style head title noscript template svg iframe object canvas math audio video".split())
BOILERPLATE = frozenset("nav header footer aside form button select textarea dialog menu fieldset label option".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar footer header masthead comment comments reply replies disqus share sharing social "
    "related recommended newsletter subscribe signup login popup modal toolbar pagination pager widget".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address center details summary hgroup".split()
) | BOILERPLATE
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre address summary".split())
#: A start tag ends these when they are open, up to the nearest other block.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
BREAKS = frozenset(("br", "hr"))
#: Characters that a punctuation mark counts for.
SIGNS = 10
#: Marks a hinted element in a path.
MARK = "~"
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟]")
WORD = re.compile(r"[a-z]+")


class Blocks(HTMLParser):
    """``found``: (path, text, link characters) of each block, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # tag, hides its content, hinted
        self.hidden = self.links = 0
        self.text: list[str] = []
        self.linked = 0
        self.found: list[tuple[tuple[str, ...], str, int]] = []

    def flush(self) -> None:
        if text := " ".join("".join(self.text).split()):
            path = tuple(t + MARK * hinted for t, _, hinted in self.stack if t in BLOCK)
            self.found.append((path, text, self.linked))
        self.text, self.linked = [], 0

    def pop(self) -> None:
        tag, hides, _ = self.stack.pop()
        self.hidden -= hides
        self.links -= tag == "a"

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS or tag in BLOCK:
            self.flush()
        if tag in VOID:
            return
        if tag in BLOCK:
            ends = ENDS.get(tag, {"p"})
            while any(t in ends for t, *_ in self.stack) and self.reaches(ends):
                self.pop()
        self.stack.append((tag, self.hides(tag, attrs), self.hints(attrs)))
        self.hidden += self.stack[-1][1]
        self.links += tag == "a"

    def reaches(self, ends) -> bool:
        """Is one of these open, with nothing but inline tags above it?"""
        for tag, *_ in reversed(self.stack):
            if tag in ends:
                return True
            if tag in BLOCK:
                return False
        return False

    @staticmethod
    def hides(tag, attrs) -> bool:
        """Not text at all, or boilerplate by the tag's or role's meaning."""
        if tag in SILENT or tag in BOILERPLATE:
            return True
        if tag in ("html", "body", "main", "article"):
            return False
        return any(name == "hidden" or name == "role" and (value or "").lower() in ROLES for name, value in attrs)

    @staticmethod
    def hints(attrs) -> bool:
        """Whether a word of the class or id is one of boilerplate."""
        return any(name in ("class", "id") and not HINTS.isdisjoint(WORD.findall((value or "").lower())) for name, value in attrs)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if any(t == tag for t, *_ in self.stack):
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def blocks(html: str) -> list[tuple[tuple[str, ...], str, int]]:
    parser = Blocks()
    parser.feed(re.sub(r"<[A-Za-z/!?][^<>]*\Z", "", html))  # a page may end inside a tag
    parser.close()
    parser.flush()
    return parser.found


def path_ratios(found) -> dict[tuple[str, ...], float]:
    """The fused ratio of each path: characters a block, raised by punctuation
    and smoothed over neighbours, lowered by links and by hinted elements."""
    length, signs, linked, count = (defaultdict(int) for _ in range(4))
    for path, text, links in found:
        length[path] += len(text)
        signs[path] += len(PUNCTUATION.findall(text))
        linked[path] += min(links, len(text))
        count[path] += 1
    ratio = {p: length[p] / count[p] * (1 + SIGNS * signs[p] / length[p]) for p in length}
    along = [ratio[path] for path, _, _ in found]
    smoothed = defaultdict(float)
    for i, (path, _, _) in enumerate(found):
        near = along[max(0, i - 1) : i + 2]
        smoothed[path] += (along[i] + sum(near) / len(near)) / 2
    own = lambda p: (1 - linked[p] / length[p]) ** 2 * HINTED ** sum(t.endswith(MARK) for t in p)
    return {p: smoothed[p] / count[p] * own(p) for p in smoothed}


def content_paths(ratios: dict[tuple[str, ...], float]) -> set[tuple[str, ...]]:
    """The paths that belong to the article."""
    plain = lambda t: t.removesuffix(MARK)
    in_article = lambda p: any(plain(t) in ("article", "main") for t in p)
    best = max(ratios, key=lambda p: (ratios[p] * (4 if in_article(p) else 1), p))
    depth = next((i for i, t in enumerate(best) if plain(t) in ("article", "main")), len(best) - 2) + 1
    container = best[:depth]

    def least(path) -> float:
        if path[:depth] != container:
            return OUTSIDE_ARTICLE if in_article(container) else OUTSIDE
        leaf = path[-1] if path else ""
        if plain(leaf) in FLOW:
            return INSIDE if leaf.endswith(MARK) else FLOW_INSIDE
        return INSIDE if in_article(container) and not leaf.endswith(MARK) else LOOSE

    return {p for p, ratio in ratios.items() if ratio >= least(p) * ratios[best]}


def main_text(html: str) -> str:
    """Blocks of the content paths, one to a line."""
    found = blocks(html)
    content = content_paths(path_ratios(found)) if found else set()
    return "\n".join(text for path, text, _ in found if path in content)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null and empty pages have the text "".  Pages are judged alone, so repeated
    rows, null ids or urls and extra columns change nothing; an empty table
    gives an empty table.
    """

    def work(batch):
        texts = [main_text(h) for h in batch["html"]]
        return {
            "page_id": pa.array(batch["page_id"], pa.int64()), "url": pa.array(batch["url"], pa.string()),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64()),
        }

    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), "url", text_of(html_col).alias("html"))
    return map_batches(plain, "page_id long, url string, text string, n_chars long", work)
