"""Names of people and companies, addresses, phones, identifiers in text."""

from __future__ import annotations

import hashlib
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings of company names that say their legal form.
LEGAL = "pte ltd|private limited|pty ltd|co ltd|sdn bhd|limited|ltd|llp|llc|inc|incorporated|corporation|corp|plc|gmbh|ag|bhd|pty|pte|co"
#: Country code, lengths of national numbers and first digits of mobile ones.
PHONES = {"SG": ("65", (8,), "89"), "HK": ("852", (8,), "5679"), "TH": ("66", (8, 9), "689"), "AU": ("61", (9,), "4"), "NZ": ("64", (8, 9, 10), "2")}


def plain_letters(name: str) -> str:
    """Lower case, without accents and marks, single spaces."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^\w\s]|_", " ", bare.casefold()).split())


def same_name(a: str, b: str, any_order: bool = False) -> bool:
    x, y = plain_letters(a).split(), plain_letters(b).split()
    return bool(x) and (sorted(x) == sorted(y) if any_order else x == y)


def without_legal_ending(name: str) -> str:
    """Without the words of its legal form, however many."""
    out, before = " ".join(re.sub(r"[.,()]", " ", name).split()), None
    while out != before:
        before, out = out, re.sub(rf"(?i)\s+(?:{LEGAL})$", "", out)
    return out


def company_key(name: Column) -> Column:
    """The same as a column of lower case, for grouping by employer."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[.,()]", " "), r"\s+", " "))
    return F.regexp_replace(bare, rf"(?:\s+(?:{LEGAL}))+$", "")


def first_known(sources: dict[str, Column], otherwise: str) -> Column:
    """name, source: the first source that isn't null, in their order."""
    found = F.coalesce(*(F.when(c.isNotNull(), F.struct(c.alias("name"), F.lit(s).alias("source"))) for s, c in sources.items()))
    return F.coalesce(found, F.struct(F.lit(otherwise).alias("name"), F.lit("none").alias("source")))


def named(name: str | None, names: list[str]) -> bool:
    """Is a name one of some, begins with one that ends in *, or goes on after one at a word's end?"""
    if not name:
        return False
    low = " ".join(name.casefold().split())
    for n in names:
        key = " ".join(n.casefold().split())
        if key.endswith("*"):
            if low.startswith(key[:-1]):
                return True
        elif low == key or low.startswith(key) and not low[len(key)].isalnum():
            return True
    return False


def slug(text: str) -> str:
    """ASCII words joined by hyphens; text without any gets t and the start of its SHA-1."""
    found = re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")
    return found or "t" + hashlib.sha1(text.encode()).hexdigest()[:8]


def requisitions(text: Column, most: int = 2) -> Column:
    """The first identifiers of vacancies in a text: R, JR or REQ and at least four digits."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.upper(text), F.lit(r"\b(?:JR|REQ|R)[-_ ]?\d{4,}\b"), F.lit(0))), 1, most)


def phones(text: str, market: str) -> list[tuple[str, str]]:
    """(number with country code, mobile or landline) of a market's numbers in a text, each once, in order."""
    code, lengths, mobile = PHONES[market]
    out: dict[str, str] = {}
    for m in re.finditer(r"(?<![\w.])\+?[\d(][\d\s().-]{5,18}\d(?!\w)", text):
        digits = re.sub(r"\D", "", m[0])
        if m[0].startswith("+") or (digits.startswith(code) and len(digits) - len(code) in lengths):
            if not digits.startswith(code):
                continue
            digits = digits[len(code) :]
        national = digits.lstrip("0") if market not in ("SG", "HK") else digits
        if len(national) in lengths:
            out.setdefault(f"+{code}{national}", "mobile" if national[0] in mobile else "landline")
    return list(out.items())


def phones_near(text: str, name: str, market: str, before: int = 40, after: int = 80) -> list[str]:
    """Numbers within so many characters before or after a name."""
    found = []
    for m in re.finditer(re.escape(name), text, re.I):
        found += [n for n, _ in phones(text[max(0, m.start() - before) : m.end() + after], market)]
    return list(dict.fromkeys(found))


def email(pattern: str, first: str, last: str, domain: str) -> str:
    """An address by a pattern of {first}, {last}, {f} and {l}."""
    a, b = (plain_letters(x).replace(" ", "") for x in (first, last))
    return f"{pattern.format(first=a, last=b, f=a[:1], l=b[:1])}@{domain.lower()}"


def title_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the words of two titles."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), "[^0-9a-z]+"), lambda w: w != "")) for c in (a, b))
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(0.0)
