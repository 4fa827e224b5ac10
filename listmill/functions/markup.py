"""Listing HTML made safe, and what changed between two wordings."""

from __future__ import annotations

import difflib
import html
from collections import deque
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags that are kept (without attributes, but for the address of a link), and tags whose contents go too.
KEPT = frozenset("p br ul ol li strong b em i u h1 h2 h3 h4 h5 h6 table thead tbody tr th td blockquote div span a".split())
DROPPED = frozenset("script style iframe object".split())


class _Safe(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: deque[str] = deque()
        self.depth = 0  # of dropped tags that are open

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.depth += tag in DROPPED
        if tag in KEPT and not self.depth:
            self.out.append(f"<{tag}{self.link(attrs) if tag == 'a' else ''}>")

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.depth = max(0, self.depth - 1)
        elif tag in KEPT - {"br"} and not self.depth:
            self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self.depth:
            self.out.append(html.escape(data))

    @staticmethod
    def link(attrs: list[tuple[str, str | None]]) -> str:
        """Web addresses only, opened elsewhere."""
        href = next((v or "" for k, v in reversed(attrs) if k == "href"), "")
        web = href.lower().startswith(("http://", "https://"))
        return f' href="{html.escape(href)}" target="_blank" rel="noopener noreferrer"' if web else ""


def safe(markup: str | None) -> str:
    parser = _Safe()
    parser.feed(markup or "")
    return "".join(parser.out)


@F.pandas_udf(T.StringType())
def safe_html(s: pd.Series) -> pd.Series:
    return s.map(safe)


def changed_lines(old: str, new: str) -> list[str]:
    """'- ' and '+ ' lines that aren't blank, in the order of the texts."""
    return [x for x in difflib.ndiff(old.splitlines(), new.splitlines()) if x[:2] in ("- ", "+ ") and x[2:].strip()]


@F.pandas_udf(T.ArrayType(T.StringType()))
def wording_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([changed_lines(a or "", b or "") for a, b in zip(old, new, strict=True)])
