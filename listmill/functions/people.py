"""People found for a listing: which group a title puts them in, who is the same person, who is looked up first."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .names import plain_letters

#: Groups in the order they are shown, kinds of provenance from best to worst, and words of titles.
GROUPS = ("named_on_listing", "recruiter", "hiring_manager_or_team", "also_at_company")
PROVENANCE = ("publicly_observed", "provider_observed", "provider_inferred")
RECRUITING = r"\b(talent|recruit\w*|sourcer|sourcing|hr|human resources?|people partner)\b"
LEADING = r"\b(head|director|vice president|vp|chief|manager|lead|principal)\b"
SENIOR = r"\b(senior|sr|staff|principal|lead)\b"
JUNIOR = r"\b(intern|internship|trainee|graduate|student|apprentice)\b"
EXECUTIVE = r"\b(ceo|coo|cfo|cto|cio|chief|president|founder|managing director|general manager|executive director)\b"
BOARD = r"\b(board|non[- ]executive|chair\w*|advis[eo]r\w*|trustee)\b"
SENIORITY = ("senior", "sr", "junior", "jr", "lead", "manager", "mgr", "vp", "avp", "svp", "head", "director", "principal", "staff", "associate", "assistant", "executive", "chief", "intern", "i", "ii", "iii", "iv", "group")
PLACES = (
    "and", "of", "the", "for", "in", "apac", "emea", "asia", "sea", "global", "regional", "singapore", "hong", "kong", "thailand", "australia", "new", "zealand", "sg", "hk", "th", "au", "nz", "based", "remote", "hybrid",
    "contract", "permanent",
)
NOUNS = ("engineer", "specialist", "analyst", "consultant", "officer", "architect", "developer", "scientist", "partner", "advisor", "expert")
SYNONYMS = {
    "analytics": ("data", "insights"), "data": ("analytics",), "insights": ("analytics", "data"), "intelligence": ("analytics", "data"), "software": ("engineering",), "engineering": ("software",),
    "machine": ("ml", "ai"), "learning": ("ml",),
}


def _has(title: Column, words: str) -> Column:
    return F.coalesce(title.rlike(f"(?i){words}"), F.lit(False))


def team_words(title: Column) -> Column:
    """What the team does: the title without words of rank and place, then its words that aren't general nouns; six at most."""
    kept = F.filter(F.regexp_extract_all(F.regexp_replace(F.coalesce(title, F.lit("")), r"\(.*?\)", " "), F.lit("[A-Za-z][A-Za-z&+]*"), F.lit(0)), lambda w: ~F.lower(w).isin(*SENIORITY, *PLACES))
    single = F.filter(kept, lambda w: (F.length(w) >= 4) & ~F.lower(w).isin(*NOUNS))
    return F.slice(F.array_distinct(F.filter(F.concat(F.array(F.array_join(kept, " ")), single), lambda w: w != "")), 1, 6)


def matching_words(team: Column) -> Column:
    """Single words of the team's phrases that a title can share, with words that mean the same."""
    single = F.filter(F.flatten(F.transform(team, lambda p: F.split(F.lower(p), " "))), lambda w: (F.length(w) >= 4) & ~w.isin(*NOUNS))
    same = F.create_map(*(x for word, others in SYNONYMS.items() for x in (F.lit(word), F.array(*map(F.lit, others)))))
    return F.array_distinct(F.concat(single, F.flatten(F.transform(single, lambda w: F.coalesce(F.element_at(same, w), F.array().cast("array<string>"))))))


def shared_words(title: Column, team: Column) -> Column:
    """Those that a person's title has, sorted."""
    own = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    return F.array_sort(F.array_intersect(matching_words(team), own))


def group_of(title: Column, team: Column, on_listing: Column, only_posts: Column) -> Column:
    """The group of one person by the title alone; those who only wrote posts have none."""
    named = F.size(shared_words(title, team)) > 0
    return (
        F.when(on_listing, "named_on_listing").when(only_posts, None).when(_has(title, JUNIOR), "also_at_company").when(_has(title, RECRUITING), "recruiter")
        .when(named, "hiring_manager_or_team").otherwise("also_at_company")
    )


def leader_tier(title: Column) -> Column:
    """0 runs the company, 1 leads, 2 neither; a seat on the board leads nothing."""
    return F.when(_has(title, BOARD), 2).when(_has(title, EXECUTIVE), 0).when(_has(title, LEADING), 1).otherwise(2)


def rank_in_group(group: Column, title: Column) -> Column:
    team = F.when(_has(title, LEADING), 0).when(_has(title, SENIOR), 1).otherwise(2)
    return F.when(group == "hiring_manager_or_team", team).when(group == "also_at_company", leader_tier(title)).otherwise(0)


def classified(people: DataFrame, listing: str, place: str) -> DataFrame:
    """people with group, rank and position within their listing: by group, then rank, then market, then the order they were found in. people: title, team, on_listing, only_posts, in_market."""
    rows = people.withColumn("group", group_of(F.col("title"), F.col("team"), F.col("on_listing"), F.col("only_posts")))
    rows = rows.withColumn("rank", rank_in_group(F.col("group"), F.col("title")))
    at = F.array_position(F.array(*map(F.lit, GROUPS)), F.col("group"))
    order = W.partitionBy(listing).orderBy(F.coalesce(at, F.lit(len(GROUPS) + 1)), "rank", ~F.col("in_market"), place)
    return rows.withColumn("position", F.row_number().over(order))


def key_people(people: DataFrame, listing: str, recruiters: int, team: int) -> DataFrame:
    """classified() people who are looked up first: all named on the listing, the first recruiters, the first of the team; where a listing has no team, leaders of the company stand in for it."""
    none = ~F.max(F.coalesce(F.col("group") == "hiring_manager_or_team", F.lit(False))).over(W.partitionBy(listing))
    stands = F.when(none & (F.col("group") == "also_at_company") & (leader_tier(F.col("title")) < 2), "hiring_manager_or_team").otherwise(F.col("group"))
    rows = people.withColumn("_as", stands).withColumn("_n", F.row_number().over(W.partitionBy(listing, "_as").orderBy("position")))
    keep = (F.col("_as") == "named_on_listing") | ((F.col("_as") == "recruiter") & (F.col("_n") <= recruiters)) | ((F.col("_as") == "hiring_manager_or_team") & (F.col("_n") <= team))
    return rows.where(keep).drop("_as", "_n")


def profile_key(url: Column) -> Column:
    """A comparable form of a profile's address; null for internal ids, which differ by who writes them."""
    name = F.regexp_extract(F.coalesce(url, F.lit("")), r"linkedin\.com/in/([^/?#]+)", 1)
    return F.when((name != "") & ~name.rlike(r"^AC[a-zA-Z0-9_-]{20,}$"), F.lower(name))


def half_name(name: str) -> tuple[str, str] | None:
    """Given names and initial, where only the surname's initial is printed."""
    m = re.fullmatch(r"(.+?)\s+([A-Za-z])\.", (name or "").strip())
    return (m[1], m[2]) if m else None


def completed(name: str, profile: str | None) -> str:
    """A half name made whole by a profile's address that begins with the given names and goes on with the initial."""
    half = half_name(name)
    if not half or not profile:
        return name
    letters = "".join(p for p in re.split(r"[-_]", profile.lower()) if not re.search(r"\d", p))
    given = re.sub("[^a-z]", "", plain_letters(half[0]))
    rest = letters[len(given) :] if letters.startswith(given) else ""
    return f"{half[0]} {rest.capitalize()}" if len(rest) > 1 and rest.isalpha() and rest[0] == half[1].lower() else name


def alike(a: str, b: str, any_order: bool = False) -> bool:
    """One name, or a half name and a whole one that it fits; any_order: also the same words in another order."""
    x, y = plain_letters(a), plain_letters(b)
    if not x or not y:
        return False
    if x == y or (any_order and sorted(x.split()) == sorted(y.split())):
        return True
    for half, whole in ((half_name(a), y), (half_name(b), x)):
        if half and re.match(rf"{re.escape(plain_letters(half[0]))} {half[1].lower()}", whole):
            return True
    return False


PERSON = "listing long, place long, name string, title string, profile string, email string, found_by string, provenance string, only_posts boolean, in_market boolean"


def merged_people(people: DataFrame) -> DataFrame:
    """One row a person of each listing (columns as PERSON; profile as by profile_key()): the earliest keeps its name, later ones fill gaps.

    Who is whose depends on the order, so a listing's people, some dozens, are gone through together.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for p in rows.sort_values("place").astype(object).where(rows.notna(), None).to_dict("records"):
            same = next((k for k in kept if (k["profile"] and k["profile"] == p["profile"]) or alike(k["name"], p["name"], "sgdi" in (k["found_by"], p["found_by"]))), None)
            if same is None:
                kept.append(p)
                continue
            same |= {c: p[c] for c in ("title", "profile", "email") if not same[c]}
            if half_name(same["name"]) and not half_name(p["name"]):
                same["name"] = p["name"]
            same["only_posts"], same["in_market"] = same["only_posts"] and p["only_posts"], same["in_market"] or p["in_market"]
            same["provenance"] = min(same["provenance"], p["provenance"], key=PROVENANCE.index)
            same["found_by"] = "listing" if "listing" in (same["found_by"], p["found_by"]) else same["found_by"]
        return pd.DataFrame(kept, columns=rows.columns)

    return people.select(*(c.split()[0] for c in PERSON.split(", "))).groupBy("listing").applyInPandas(one, PERSON)


def spells(local: Column, name: Column) -> Column:
    """Does the part of an e-mail address before the @ spell a name: first and last name in either order, initials for one, or the first name alone?"""
    ws = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    first, last, letters = F.get(ws, 0), F.element_at(ws, -1), F.regexp_replace(F.lower(local), "[^a-z]", "")
    initial = lambda w: F.substring(w, 1, 1)
    return F.when(F.size(ws) >= 2, letters.isin(F.concat(first, last), F.concat(last, first), F.concat(initial(first), last), first, F.concat(first, initial(last)))).otherwise(False)


def addresses(name: Column, domain: Column, patterns: Sequence[str]) -> Column:
    """E-mail addresses that patterns such as {first}.{last} or {f}{last} make of a name with two words or more."""
    ws = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    first, last = F.get(ws, 0), F.element_at(ws, -1)
    fill = {"{first}": first, "{last}": last, "{f}": F.substring(first, 1, 1), "{l}": F.substring(last, 1, 1)}

    def made(pattern: str) -> Column:
        return F.concat(*(fill.get(p, F.lit(p)) for p in re.split(r"(\{\w+\})", pattern) if p), F.lit("@"), domain)

    return F.when((F.size(ws) >= 2) & (domain != ""), F.array_distinct(F.array(*map(made, patterns))))


def names_title(text: Column, title: Column) -> Column:
    """Does a text have the title's words together and in order, words of place left out of both?"""
    ws = lambda c: F.array_join(F.filter(F.regexp_extract_all(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\(.*?\)", " ")), F.lit("[a-z][a-z&+]*"), F.lit(0)), lambda w: ~w.isin(*PLACES)), " ")
    return (ws(title) != "") & F.concat(F.lit(" "), ws(text), F.lit(" ")).contains(F.concat(F.lit(" "), ws(title), F.lit(" ")))
