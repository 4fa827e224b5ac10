"""What is sent to a language model about a listing, and the contracts that its answers are held to. A checked answer is null, or says what is wrong with it."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a description that are sent; kinds of lines, what years may be of, and levels.
SENT = 16_000
LINE_TYPES = ("years", "tool", "credential", "industry", "language", "work_rights", "education", "contract", "internship", "students_only", "condition", "other")
YEARS_OF = ("overall", "not_named", "thing", "managing_people", "impossible")
LANGUAGE_LEVELS = ("not_stated", "basic_spoken", "business_or_written")
EDUCATION_LEVELS = ("doctorate_only", "degree")
LINE_FIELDS = ("quote", "type", "status", "detail", "things", "needs", "number", "years_of", "level")
#: Signs of quotes and dashes that count as plain ones, and marks of list items.
_PLAIN = {ord(a): b for b, signs in {"'": "‘’", '"': "“”", "-": "‐‑‒–—−"}.items() for a in signs}
_ITEM = re.compile(r"^\s*(?:[•·▪*]\s*|-\s+|\d+[.)]\s+)")


def advertiser_line(advertiser: Column, hiring: Column) -> Column:
    """The advertiser, and for whom it hires if that is another."""
    other = (hiring != "") & (hiring != F.coalesce(advertiser, F.lit("")))
    return F.concat(F.coalesce(advertiser, F.lit("")), F.when(other, F.concat(F.lit(", hiring for "), hiring)).otherwise(""))


def sent_text(description: Column) -> Column:
    return F.substring(F.coalesce(description, F.lit("")), 1, SENT)


def listing_input(template: str, **fields: Column) -> Column:
    """The template with {fields} put in, each once read and never read again, whatever braces it holds."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(F.coalesce(fields[p], F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)))


def input_hash(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.array(*(F.coalesce(p, F.lit("")) for p in parts))), 256)


def quoted(text: str) -> str:
    """As quotes are compared: compatibility forms, plain quotes and dashes, no mark of a list item, single spaces, case folded."""
    return " ".join(_ITEM.sub("", unicodedata.normalize("NFKC", text).translate(_PLAIN)).split()).casefold()


def closed_up(text: str) -> str:
    """quoted(), without a space before punctuation that ends a word."""
    return re.sub(r"(?<=[\w)]) (?=[.,;:!?](?:\s|$))", "", quoted(text))


def found_in(quote: str, texts: Sequence[str | None], form: Callable[[str], str] = quoted) -> bool:
    wanted = form(quote)
    return bool(wanted) and any(wanted in form((t or "")[:SENT]) for t in texts)


@F.pandas_udf(T.BooleanType())
def quote_found(quote: pd.Series, title: pd.Series, description: pd.Series) -> pd.Series:
    """Does a quote stand in the title or the description that were sent?"""
    return pd.Series([q is not None and found_in(q, (t, d), closed_up) for q, t, d in zip(quote, title, description, strict=True)])


def _checked(rules: Sequence[tuple[str, Callable[[], bool]]]) -> str | None:
    """The first rule that doesn't hold. Later rules may rely on earlier ones."""
    return next((says for says, holds in rules if not holds()), None)


def _texts(x, least: int = 0) -> bool:
    return isinstance(x, list) and len(x) >= least and all(isinstance(v, str) and v.strip() for v in x)


def triage_error(answer: object, title: str | None, description: str | None, verdicts: Sequence[str]) -> str | None:
    a: Mapping = answer if isinstance(answer, dict) else {}
    return _checked([
        ("needs exactly profession, quote and verdict", lambda: set(a) == {"profession", "quote", "verdict"}),
        ("fields must be text that isn't blank", lambda: _texts(list(a.values()))),
        ("unknown verdict", lambda: a["verdict"] in verdicts),
        ("profession exceeds 12 words", lambda: len(a["profession"].split()) <= 12),
        ("quote was not found", lambda: found_in(a["quote"], (title, description))),
    ])


def _line_error(line: object, texts: Sequence[str | None], years_of: Sequence[str]) -> str | None:
    x: Mapping = line if isinstance(line, dict) else {}
    number = lambda: x["number"]
    kind = lambda *names: x["type"] in names
    return _checked([
        ("a line needs exactly nine fields", lambda: set(x) == set(LINE_FIELDS)),
        ("unknown type, status or needs", lambda: x["type"] in LINE_TYPES and x["status"] in ("required", "preferred", "unknown") and x["needs"] in ("all", "any_one", "any_one_or_similar")),
        ("quote and detail must be text that isn't blank", lambda: _texts([x["quote"], x["detail"]])),
        ("quote exceeds 60 words or was not found", lambda: len(x["quote"].split()) <= 60 and found_in(x["quote"], texts, closed_up)),
        ("things and years_of must be lists of text", lambda: _texts(x["things"]) and _texts(x["years_of"])),
        ("unknown years_of", lambda: set(x["years_of"]) <= set(years_of)),
        ("number must be finite or null", lambda: number() is None or (type(number()) in (int, float) and math.isfinite(number()))),
        ("years need a number from 0 to 50 and years_of", lambda: not kind("years") or (number() is not None and 0 <= number() <= 50 and len(x["years_of"]) > 0)),
        ("impossible years stand alone", lambda: not kind("years") or "impossible" not in x["years_of"] or x["years_of"] == ["impossible"]),
        ("years of a thing need its name", lambda: not kind("years") or "thing" not in x["years_of"] or len(x["things"]) > 0),
        ("years_of is for years only", lambda: kind("years") or not x["years_of"]),
        ("months of a contract are whole, from 1 to 120", lambda: not kind("contract") or number() is None or (1 <= number() <= 120 and int(number()) == number())),
        ("number is for years and contracts only", lambda: kind("years", "contract") or number() is None),
        ("a language needs a name and a level", lambda: not kind("language") or (len(x["things"]) > 0 and x["level"] in LANGUAGE_LEVELS)),
        ("education needs a level", lambda: not kind("education") or x["level"] in EDUCATION_LEVELS),
        ("level is for languages and education only", lambda: kind("language", "education") or x["level"] is None),
    ])


def extraction_error(answer: object, title: str | None, description: str | None, kinds: Sequence[str], work_groups: Sequence[str] = ()) -> str | None:
    a: Mapping = answer if isinstance(answer, dict) else {}
    found = _checked([
        ("needs exactly kinds, lines, recruitment_firm and public_sector", lambda: set(a) == {"kinds", "lines", "recruitment_firm", "public_sector"}),
        ("needs one to three different known kinds", lambda: _texts(a["kinds"], 1) and len(set(a["kinds"])) == len(a["kinds"]) <= 3 and set(a["kinds"]) <= set(kinds)),
        ("flags must be true or false", lambda: type(a["recruitment_firm"]) is bool and type(a["public_sector"]) is bool),
        ("lines must be a list", lambda: isinstance(a["lines"], list)),
    ])
    return found or next((e for line in a["lines"] if (e := _line_error(line, (title, description), (*work_groups, *YEARS_OF)))), None)


def shortened(quote: str, most: int = 30) -> str:
    """A quote's first words."""
    words = quote.split()
    return quote if len(words) <= most else " ".join(words[:most])


def response_schema(kinds: Sequence[str], work_groups: Sequence[str] = ()) -> dict:
    """JSON schema of an extraction, from the same lists as its checks."""
    text, texts = {"type": "string"}, {"type": "array", "items": {"type": "string"}}
    closed = lambda **p: {"type": "object", "additionalProperties": False, "required": list(p), "properties": p}
    line = closed(
        quote=text, type={**text, "enum": list(LINE_TYPES)}, status={**text, "enum": ["required", "preferred", "unknown"]}, detail=text, things=texts, needs={**text, "enum": ["all", "any_one", "any_one_or_similar"]},
        number={"type": ["number", "null"]}, years_of={"type": "array", "items": {**text, "enum": [*work_groups, *YEARS_OF]}}, level={"type": ["string", "null"], "enum": [*LANGUAGE_LEVELS, *EDUCATION_LEVELS, None]},
    )
    return closed(kinds={"type": "array", "minItems": 1, "maxItems": 3, "items": {**text, "enum": list(kinds)}}, lines={"type": "array", "items": line}, recruitment_firm={"type": "boolean"}, public_sector={"type": "boolean"})


def known(rows: DataFrame, answers: DataFrame, key: str = "input_hash") -> DataFrame:
    """Answers to what rows ask, each once."""
    return answers.join(rows.select(key).distinct(), key, "left_semi")


def linked(rows: DataFrame, answers: DataFrame, terminal: Sequence[str]) -> DataFrame:
    """rows with `answered`: by an answer they hold already, or one to the same input; an input that failed for good isn't reopened by another's answer. rows: input_hash, held (its own answer's hash), reason."""
    one = answers.select("input_hash", F.lit(True).alias("_known")).distinct()
    over = F.coalesce(F.col("reason").isin(*terminal), F.lit(False)) & ~F.col("held").eqNullSafe(F.col("input_hash"))
    return rows.join(one, "input_hash", "left").withColumn("answered", F.col("held").isNotNull() | (F.coalesce("_known", F.lit(False)) & ~over)).drop("_known")


def cohort(rows: DataFrame, waiting: Column) -> DataFrame:
    """input_hash, ids, n: what is still to be asked, each input once, with the listings that wait for it."""
    return rows.where(waiting).groupBy("input_hash").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.count("*").alias("n"))
