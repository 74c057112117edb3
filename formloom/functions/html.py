"""Readable text of web pages, as an Arrow-batched function."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements without readable text, and elements that break lines.
SILENT = frozenset(
    ("script", "style", "head", "nav", "header", "footer", "noscript", "form", "button", "select")
)
BREAKING = frozenset(("br", "p", "div", "li", "tr", "h1", "h2", "h3", "h4"))


class _Reader(HTMLParser):
    """Collects text outside silent elements, which may nest."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def _tag(self, tag: str, step: int) -> None:
        if tag in SILENT:
            self.depth = max(0, self.depth + step)
        elif tag in BREAKING and not self.depth:
            self.out.append("\n")

    def handle_starttag(self, tag, attrs):
        self._tag(tag, 1)

    def handle_endtag(self, tag):
        self._tag(tag, -1)

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def _read(page: str | None) -> str:
    reader = _Reader()
    reader.feed(page or "")
    text = re.sub("[\u00a0\u2009\u202f\u200b]", " ", "".join(reader.out))
    lines = (re.sub(r"[ \t]+", " ", line).strip() for line in text.splitlines())
    return "\n".join(line for line in lines if line)


@F.pandas_udf(StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    """Text of each page; nesting of silent elements needs a real parser."""
    return pages.map(_read)
