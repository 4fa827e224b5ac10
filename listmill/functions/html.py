"""HTML to plain text, and the structure of pages, on the standard library's parser as Arrow UDFs.

Text inside head, script, style and template is dropped; line breaks and block elements end a line; list items are indented two spaces a level below
the first, those of ordered lists are numbered when they have text, and their further lines stand two spaces deeper; entities become characters; joiners
that hide within words are taken out; lines are in NFC with single spaces and without empty ones. What the rules can't express (tables, pictures,
preformatted text, lists with own numbering) yields no text but a reason.
"""

from __future__ import annotations

import json
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements by what they mean for the text.
DROPPED = frozenset("head script style template".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header html legend li main menu nav ol p section summary ul".split())
UNSUPPORTED = frozenset("table img pre".split())
HIDDEN = dict.fromkeys(map(ord, "​⁠﻿­"))
_TAG_LIKE = re.compile(r"<([A-Z]{0,3}\d+)>")


def _fields(**kinds: T.DataType) -> T.StructType:
    """As objects, not DDL: workers import this module without a session."""
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


class Unsupported(Exception):
    pass


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.now: list[str] = []
        self.dropped: list[str] = []
        self.lists: list[list] = []  # [kind, items so far]
        self.item: list[list] = []  # [prefix of the first line, depth, begun]

    def end_line(self) -> None:
        line = " ".join(unicodedata.normalize("NFC", "".join(self.now).translate(HIDDEN)).split())
        self.now = []
        if not line:
            return
        if self.item:
            mark, depth, begun = self.item[-1]
            if not begun:
                if self.lists and self.lists[-1][0] == "ol":
                    self.lists[-1][1] += 1
                    mark = f"{self.lists[-1][1]}. "
                self.item[-1][2] = True
                line = "  " * (depth - 1) + mark + line
            else:
                line = "  " * depth + line
        self.lines.append(line)

    def handle_starttag(self, tag, attrs):
        if tag in DROPPED:
            self.dropped.append(tag)
        if self.dropped:
            return
        names = {k for k, _ in attrs}
        if tag in UNSUPPORTED:
            raise Unsupported(tag)
        if tag == "ol" and names & {"start", "reversed", "type"} or tag == "li" and "value" in names:
            raise Unsupported(f"{tag}[{sorted(names & {'start', 'reversed', 'type', 'value'})[0]}]")
        if tag in ("br", "hr") or tag in BLOCKS:
            self.end_line()
        if tag in ("ul", "ol", "menu"):
            self.lists.append([tag, 0])
        elif tag == "li":
            self.item.append(["", max(1, len(self.lists)), False])

    def handle_endtag(self, tag):
        if self.dropped:
            if tag == self.dropped[-1]:
                self.dropped.pop()
            return
        if tag in BLOCKS:
            self.end_line()
        if tag in ("ul", "ol", "menu") and self.lists:
            self.lists.pop()
        elif tag == "li" and self.item:
            self.item.pop()

    def handle_data(self, data):
        if not self.dropped:
            self.now.append(data.replace("\r", " ").replace("\n", " "))


def to_text(html: str | None) -> tuple[str | None, str | None]:
    """text, reason: one of them null, or both."""
    if html is None:
        return None, None
    parser = _Text()
    try:
        parser.feed(_TAG_LIKE.sub(r"&lt;\1&gt;", html))
        parser.close()
        parser.end_line()
    except Unsupported as e:
        return None, str(e)
    return "\n".join(parser.lines) or None, None


@F.pandas_udf(_fields(text=T.StringType(), reason=T.StringType()))
def normalized(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([to_text(x) for x in s], columns=["text", "reason"])


class _Structure(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.canonical, self.links, self.words, self.stack, self.data = [], None, 0, 0, [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("title", "script", "style", "template", "noscript"):
            self.stack.append((tag, a.get("type") or ""))
        if tag == "link" and (a.get("rel") or "").lower() == "canonical" and self.canonical is None:
            self.canonical = a.get("href")
        self.links += tag == "a" and bool(a.get("href"))

    def handle_endtag(self, tag):
        if self.stack and self.stack[-1][0] == tag:
            self.stack.pop()

    def handle_data(self, data):
        if not self.stack:
            self.words += len(data.split())
        elif self.stack[-1][0] == "title":
            self.title.append(data)
        elif self.stack[-1] == ("script", "application/ld+json"):
            self.data.append(data)


def postings(value) -> int:
    """Job postings in linked data, however deep."""
    if isinstance(value, list):
        return sum(map(postings, value))
    if not isinstance(value, dict):
        return 0
    kind = value.get("@type")
    return int("JobPosting" in (kind if isinstance(kind, list) else [kind])) + sum(postings(v) for v in value.values() if isinstance(v, (dict, list)))


@F.pandas_udf(_fields(title=T.StringType(), canonical=T.StringType(), links=T.LongType(), words=T.LongType(), postings=T.LongType()))
def structure(s: pd.Series) -> pd.DataFrame:
    rows = []
    for x in s:
        p = _Structure()
        p.feed(x or "")
        p.close()
        found = 0
        for data in p.data:
            try:
                found += postings(json.loads(data))
            except ValueError:
                continue
        rows.append((" ".join("".join(p.title).split()) or None, p.canonical, p.links, p.words, found))
    return pd.DataFrame(rows, columns=["title", "canonical", "links", "words", "postings"])
