"""Ordered rules over a listing and what is known of it: requirements, employer flags, buckets.

Preferences are a plain dictionary, checked by check_preferences; rules are pure, so a batch of rows can go through a pandas UDF (bucketed).
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Phrases in a quote that make it a preference, and that make it not essential unless a must-word stands in it too.
PREFERENCE = ("preferred", "preferably", "nice to have", "good to have", "advantage", "bonus", "a plus")
NOT_ESSENTIAL = ("not essential", "not required", "not necessary")
MUST = ("must", "mandatory")
#: Requirement types that bind even where the status isn't known.
BINDING = frozenset(("years", "language", "work_rights", "contract", "internship", "students_only"))


def norm_name(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


def effective_status(line: Mapping[str, Any]) -> str:
    """required, preferred or unknown, from a line's status and its quote."""
    quote = norm_name(line.get("quote") or "")
    if any(p in quote for p in PREFERENCE) or (any(p in quote for p in NOT_ESSENTIAL) and not any(p in quote.split() for p in MUST)):
        return "preferred"
    status = line.get("status") or "unknown"
    return "required" if status == "unknown" and line.get("type") in BINDING else status


def resolve(name: str, known: Mapping[str, str]) -> str:
    """have, lack, other or wall; a name that isn't known is lacking."""
    return known.get(norm_name(name), "lack")


def combine(outcomes: Sequence[str], needs: str | None) -> list[str]:
    """What several alternatives come to: each for `all`, else one."""
    if needs == "all":
        return list(outcomes)
    if "have" in outcomes:
        return ["have"]
    if needs == "any_one_or_similar" or "other" in outcomes:
        return ["other"]
    return ["wall"] if outcomes and all(o == "wall" for o in outcomes) else ["lack"]


def years_zone(asked: float, has: float, stretch: float, limit: float) -> tuple[int, float]:
    """0 within what is comfortable, 1 up to a stretch, 2 up to a limit, 3 beyond; and the excess over what is comfortable."""
    zone = 0 if asked <= has else 1 if asked <= stretch else 2 if asked <= limit else 3
    return zone, max(0.0, asked - has)


class Evaluation(NamedTuple):
    lacks: tuple[str, ...]
    walls: tuple[str, ...]
    zone: int
    excess: float
    preferred_held: int


def evaluate(lines: Sequence[Mapping[str, Any]], preferences: Mapping[str, Any]) -> Evaluation:
    """Requirement lines against what a person has."""
    known = {norm_name(k): v for k, v in preferences.get("things", {}).items()}
    years = preferences.get("years", {})
    lacks: dict[str, str] = {}
    walls, held, worst = [], 0, (0, 0.0)
    for line in lines:
        status, kind, things = effective_status(line), line.get("type"), line.get("things") or []
        got = combine([resolve(t, known) for t in things], line.get("needs")) if things else []
        if status == "preferred":
            held += "have" in got
            continue
        if status != "required":
            continue
        if kind == "years" and line.get("number") is not None:
            groups = [years.get(norm_name(g), years.get("*", (0, 0, 0))) for g in line.get("years_of") or ["*"]]
            worst = max(worst, min(years_zone(float(line["number"]), *g) for g in groups))
        for outcome, name in zip(got, things if line.get("needs") == "all" else [" or ".join(things)], strict=False):
            if outcome == "lack":
                lacks.setdefault(norm_name(name), name)
            elif outcome == "wall":
                walls.append(kind or "thing")
    return Evaluation(tuple(lacks[k] for k in sorted(lacks)), tuple(sorted(set(walls))), worst[0], worst[1], held)


def repeat_key(bucket: str, lacks: Sequence[str] | None) -> tuple:
    """What two results must share to count as the same: the bucket and the lacks, in any order and case."""
    return bucket, tuple(sorted({norm_name(x) for x in lacks or ()}))


def listing_market(country: Column, market: Column, known: Sequence[str] = ("SG", "HK", "TH")) -> Column:
    return F.when(country.isin(*known), country).otherwise(market)


def closed(board: Column, status: Column, later_sweeps: Column, boards: Sequence[str] = ("mcf", "jobstreet", "jobsdb", "seek")) -> Column:
    """Whether a listing is closed on its board: null on boards that can't tell; two later full sweeps without it, or its own status, say so."""
    return (
        F.when(~F.coalesce(board.isin(*boards), F.lit(False)), F.lit(None).cast("boolean"))
        .when((F.coalesce(later_sweeps, F.lit(0)) >= 2) | F.lower(status).isin("closed", "expired"), F.lit(True))
        .when(F.lower(status).isin("open", "re-open", "active"), F.lit(False))
    )


class Bucket(NamedTuple):
    bucket: str
    reason: str | None
    decided_by: str


def bucket(row: Mapping[str, Any], triage: Mapping[str, Any] | None, extraction: Mapping[str, Any] | None, preferences: Mapping[str, Any]) -> Bucket:
    """The first rule that decides: history, title, language, verdict, missing answers, exclusions, walls, limits, preference."""
    if row.get("history"):
        return Bucket("not_sorted", "history", "date")
    if row.get("title_reason"):
        return Bucket("title_filter", row["title_reason"], "title")
    if row.get("language_reason"):
        return Bucket("ineligible", row["language_reason"], "language")
    if triage is not None and triage.get("verdict") != "accept":
        to = {"language": "ineligible", "non_technical": "non_tech"}.get(triage.get("verdict"), "tech_not_for_me")
        return Bucket(to, triage.get("quote"), "triage")
    if triage is None or extraction is None:
        return Bucket("not_sorted", row.get("deferred"), "pending")
    kinds, answers = list(extraction.get("kinds") or ()), preferences.get("kinds", {})
    said = [answers.get(k, "maybe") for k in kinds]
    lines = list(extraction.get("lines") or ())
    types = {x.get("type") for x in lines if effective_status(x) == "required"}
    for kind in ("internship", "students_only"):
        if kind in types:
            return Bucket("tech_not_for_me", kind, "extraction")
    if said and all(a == "no" for a in said):
        return Bucket("tech_not_for_me", "kind", "preferences")
    months = [x["number"] for x in lines if x.get("type") == "contract" and x.get("number") is not None]
    short = bool(months) and min(months) < preferences.get("contract_months", 0)
    if short and preferences.get("short_contract") == "no":
        return Bucket("tech_not_for_me", "contract", "preferences")
    if extraction.get("public_sector") and preferences.get("public_sector") == "no":
        return Bucket("tech_not_for_me", "public_sector", "preferences")
    got = evaluate(lines, preferences)
    for wall in ("language", "work_rights"):
        if wall in got.walls:
            return Bucket("ineligible", wall, "requirements")
    if got.walls:
        return Bucket("ineligible", got.walls[0], "requirements")
    if len(got.lacks) >= preferences.get("most_lacks", 2):
        return Bucket("ineligible", ", ".join(got.lacks), "requirements")
    if got.zone == 3:
        return Bucket("ineligible", "years", "requirements")
    pay = row.get("salary_max")
    if pay is not None and row.get("salary_currency") == preferences.get("currency") and row.get("salary_period") in ("Monthly", "Annual"):
        if (pay / 12 if row["salary_period"] == "Annual" else pay) <= preferences.get("salary_floor", -1):
            return Bucket("less_interested", "salary", "preferences")
    if "limited" in said:
        return Bucket("less_interested", "kind", "preferences")
    if said and all(a in ("maybe", "no") for a in said):
        return Bucket("less_interested", "kind", "preferences")
    if short:
        return Bucket("less_interested", "contract", "preferences")
    if got.zone == 2:
        return Bucket("less_interested", "years", "requirements")
    if said[:1] == ["preferred"] and got.zone == 0 and not got.lacks:
        return Bucket("top_picks", None, "preferences")
    return Bucket("in_lane", ", ".join(got.lacks) or ("years" if got.zone else None), "requirements")


def check_preferences(preferences: Mapping[str, Any]) -> list[str]:
    """What is wrong with preferences; nothing if they can be used."""
    out = [f"things: {k} is {v}" for k, v in preferences.get("things", {}).items() if v not in ("have", "lack", "other", "wall")]
    out += [f"kinds: {k} is {v}" for k, v in preferences.get("kinds", {}).items() if v not in ("preferred", "yes", "limited", "maybe", "no")]
    out += [f"years: {k} must rise" for k, v in preferences.get("years", {}).items() if len(v) != 3 or list(v) != sorted(v)]
    return out


def bucketed(preferences: Mapping[str, Any]):
    """A pandas UDF from JSON of row, triage and extraction to bucket, reason, decided_by. Preferences are some KB and go along."""
    if wrong := check_preferences(preferences):
        raise ValueError("; ".join(wrong))
    kind = T.StructType([T.StructField(n, T.StringType()) for n in Bucket._fields])

    @F.pandas_udf(kind)
    def udf(row: pd.Series, triage: pd.Series, extraction: pd.Series) -> pd.DataFrame:
        load = lambda x: json.loads(x) if x else None
        return pd.DataFrame([bucket(load(r) or {}, load(t), load(e), preferences) for r, t, e in zip(row, triage, extraction, strict=True)], columns=list(Bucket._fields))

    return udf
