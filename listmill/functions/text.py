"""Text functions on columns, and the exact Unicode forms as Arrow UDFs where Spark's built-ins differ."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, as Python's str.split() parts at it. Spelled out, it matches several times faster than a Unicode class does.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = f"[{SPACE}]+"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it (a projection of its own would be merged with what reads it)."""
    return F.element_at(F.transform(F.array(value), f), 1)


def norm_scalar(c: Column) -> Column:
    """Trimmed of Unicode white space; blank becomes null."""
    return F.nullif(F.regexp_replace(c, f"^{SPACES}|{SPACES}$", ""), F.lit(""))


#: White space but the space itself, and the runs that aren't one space: most words are parted by one, and nothing is to be replaced there.
_ODD = SPACE.replace(r"\x20", r"\x1f")
_RUNS = f" *[{_ODD}][{SPACE}]*|  [{SPACE}]*"


def collapse(c: Column) -> Column:
    """White space runs become one space; trimmed."""
    return F.trim(F.regexp_replace(c, _RUNS, " "))


def filled(c: Column) -> Column:
    """Empty text becomes null; c is worked out once."""
    return let(c, lambda x: F.when(x != "", x))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def norm_array(c: Column) -> Column:
    """Without null and blank members, in order, with repeats; empty becomes null."""
    kept = F.filter(F.transform(c, norm_scalar), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def _latin() -> str:
    """Letters whose Unicode name begins with LATIN, as the inside of a character class."""
    ranges: list[list[int]] = []
    for i in range(0x30000):
        if unicodedata.category(chr(i))[0] == "L" and unicodedata.name(chr(i), "").startswith("LATIN "):
            if ranges and ranges[-1][1] == i - 1:
                ranges[-1][1] = i
            else:
                ranges.append([i, i])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)


LATIN = _latin()


#: Characters that are no letters of other scripts, in ranges of which the first hold nearly all of most Latin texts.
_PLAIN = r"\x00-\xa9\xab-\xb4\xb6-\xb9\xbb-\x{2af}\x{1e00}-\x{1eff}\x{2010}-\x{205e}\x{20a0}-\x{20bf}"


def _matching_lines(text: Column) -> Column:
    """Lines that have a Latin letter, without words that have letters of other scripts."""
    foreign = rf"(?<![^{SPACE}])[^{SPACE}]*?[\p{{L}}&&[^{LATIN}]][^{SPACE}]*"
    lines = F.split(text, "\n")
    bare = F.when(text.rlike(f"[^{_PLAIN}]"), F.transform(lines, lambda line: F.regexp_replace(line, foreign, " "))).otherwise(lines)
    return F.filter(bare, lambda line: line.rlike(f"[{LATIN}]"))


def matching_text(text: Column) -> Column:
    """What of a text counts for matching: words without letters of other scripts, one space between them, in lines that have a Latin letter. ASCII texts stay as they are; nothing left is null."""
    kept = F.array_join(F.transform(_matching_lines(text), collapse), "\n")
    return filled(F.when(is_ascii(text), text).otherwise(kept))


def document(title: Column, text: Column) -> Column:
    """Title and matching text joined, white space collapsed, lower case; null if there is nothing, or a text without any Latin letter (its title alone would say too little)."""

    def joined(usable: Column) -> Column:
        return F.when(text.isNull() | (usable != "") | ~text.rlike(f"[^{SPACE}]"), filled(F.lower(collapse(F.concat_ws(" ", title, usable)))))

    return let(F.when(is_ascii(text), text).otherwise(F.array_join(_matching_lines(text), "\n")), joined)


def fingerprint(doc: Column) -> Column:
    return F.sha2(doc, 256)


def shingles(doc: Column, k: int = 5) -> Column:
    """Distinct k-word strings of a document whose words one space parts; a document of at most k words is one."""

    def of(words: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.concat_ws(" ", *(F.get(words, i + j) for j in range(k))))
        return F.when(F.size(words) <= k, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(many))

    return let(F.split(doc, " "), of)


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_ids(doc: pd.Series) -> pd.Series:
    """Sorted distinct ids of a document's shingles: the first 8 bytes of BLAKE2b at that digest size, big-endian and signed."""

    def ids(d: str | None) -> list[int] | None:
        if d is None:
            return None
        words = d.split(" ")
        found = {d} if len(words) <= 5 else {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}
        return sorted({int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big", signed=True) for x in found})

    return doc.map(ids)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Share of a's members that b has; 0 if a is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)


def like_escaped(text: str) -> str:
    """A LIKE pattern that finds the text anywhere."""
    return "%" + re.sub(r"([\\%_])", r"\\\1", text) + "%"


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """casefold and white space collapsed; blank becomes null."""
    return s.map(lambda x: (" ".join(x.casefold().split()) or None) if x is not None else None)


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x) if x is not None else None)


#: Frequent English words by which a text is taken for English, and what the reasons say.
COMMON = (
    "the", "and", "of", "to", "in", "a", "for", "with", "on", "is", "as", "or", "you", "our", "we", "be", "by", "will", "are", "an", "at", "this", "that", "from", "your", "have",
    "work", "experience", "team", "role", "skills", "years", "ability", "business", "support",
)
NOT_ENGLISH, FEW_WORDS = "JD not in English: %d%% %s letters", "JD not in English: few common English words"
#: Scripts that are named, and thresholds: letters, share of foreign ones, words, share of common ones.
SCRIPTS = (("Thai", r"\p{IsThai}"), ("Japanese", r"\p{IsHiragana}\p{IsKatakana}\u30fc\uff70"), ("Korean", r"\p{IsHangul}"), ("Chinese", r"\p{IsHan}"), ("Arabic", r"\p{IsArabic}"), ("Cyrillic", r"\p{IsCyrillic}"))
LETTERS, FOREIGN, WORDS, SHARE = 200, (2, 5), 60, 15


def not_english(text: Column) -> Column:
    """Why a text isn't taken for English, or null: mostly letters of other scripts, or hardly any common English word."""
    text = F.coalesce(text, F.lit(""))
    named = "".join(x for _, x in SCRIPTS)

    def by_script(both: Column) -> Column:
        letters, foreign = both["letters"], both["foreign"]
        counts = [F.struct(F.length(F.regexp_replace(foreign, f"[^{x}]", "")).alias("n"), (-F.length(F.regexp_extract(foreign, f"^[^{x}]*", 0))).alias("at"), F.lit(name).alias("name")) for name, x in SCRIPTS]
        rest = F.regexp_replace(foreign, f"[{named}]", "")
        counts.append(F.struct(F.length(rest).alias("n"), (-F.length(F.regexp_extract(foreign, f"^[{named}]*", 0))).alias("at"), F.lit("non-Latin").alias("name")))
        most = F.element_at(F.sort_array(F.array(*counts), asc=False), 1)["name"]
        enough = (letters >= LETTERS) & (F.length(foreign) * FOREIGN[1] >= letters * FOREIGN[0])
        return F.when(enough, F.format_string(NOT_ENGLISH, F.floor(F.length(foreign) * 100 / letters).cast("int"), most))

    letters = F.regexp_replace(text, r"[^\p{L}]", "")
    script = let(F.struct(F.length(letters).alias("letters"), F.regexp_replace(letters, f"[{LATIN}\\x{{ff21}}-\\x{{ff3a}}\\x{{ff41}}-\\x{{ff5a}}]", "").alias("foreign")), by_script)
    common = F.regexp_count(text, F.lit(r"(?i)(?<![A-Za-z])(?:" + "|".join(COMMON) + ")(?![A-Za-z])"))
    words = F.regexp_count(text, F.lit("[A-Za-z]+"))
    few = let(F.struct(words.alias("n"), common.alias("common")), lambda x: F.when((x["n"] >= WORDS) & (x["common"] * SHARE < x["n"]), F.lit(FEW_WORDS)))
    return F.coalesce(F.when(~is_ascii(text), script), few)


def search(expression: str, of: Column, longest: int = 2000, deepest: int = 40) -> Column:
    """A Boolean search as a predicate: words, "phrases", AND, OR, NOT, parentheses; words side by side are joined by AND."""
    if len(expression) > longest:
        raise ValueError("the expression is too long")
    tokens = re.findall(r'"[^"]*"|[()]|[^\s()"]+', expression)
    if expression.count('"') % 2 or tokens.count("(") > deepest:
        raise ValueError("quotes or parentheses don't fit")
    at = 0

    def peek() -> str | None:
        return tokens[at] if at < len(tokens) else None

    def take() -> str:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def either() -> Column:
        out = both()
        while peek() == "OR":
            take()
            out = out | both()
        return out

    def both() -> Column:
        out = single()
        while (t := peek()) is not None and t not in ("OR", ")"):
            if t == "AND":
                take()
            out = out & single()
        return out

    def single() -> Column:
        t = peek()
        if t is None or t in (")", "AND", "OR"):
            raise ValueError("a word is missing")
        take()
        if t == "NOT":
            return ~single()
        if t == "(":
            out = either()
            if peek() != ")":
                raise ValueError("a parenthesis is open")
            take()
            return out
        return of.ilike(like_escaped(t.strip('"')))

    out = either()
    if peek() is not None:
        raise ValueError("a parenthesis is closed too often")
    return out
