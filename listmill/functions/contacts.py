"""Contacts: names and addresses printed in a text, directory entries, accounts on pages, where an e-mail domain comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import people, urls
from .text import let

#: What a printed address looks like, a name of two to four capitalised words, what announces a name, a registration behind one, and words that aren't part of it.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
NAME = r"(?:(?:Ms|Mr|Mrs|Mdm|Dr)\.?[ \t]+)?([A-Z][a-zA-Z'-]+(?:[ \t]+[A-Z][a-zA-Z'-]+){1,3})"
ANNOUNCED = r"(?i:\b(?:contact(?:\s+person)?|reach\s+out\s+to|speak\s+to|write\s+to|(?:send|email)\s+(?:your\s+)?(?:cv|resume|application)s?\s+to|personnel\s+name|consultant|recruiter))\s*:?\s+"
REGISTERED = r"\s*[|(,\-–]?\s*(?i:(?:EA\s*)?(?:Personnel\s*)?(?:Reg(?:istration)?\.?\s*(?:No\.?|Number)?|Registration)\s*[:#.]?\s*R\d{6,7}[A-Z]?)"
BEFORE = ("senior", "consultant", "recruiter", "recruitment", "manager", "executive", "partner", "director", "lead", "specialist", "associate", "principal", "hr", "contact", "please", "email", "call")
NOT_NAMES = ("us", "our", "the", "human", "resources", "team", "talent")
#: Parts of directory pages.
ENTRY, AGENCY = r'(?s)<li class="type-d">(.*?)</li>', r'(?s)<p class="col-md-12 title"[^>]*><a [^>]*>(.*?)</a></p>'
DESIGNATION, PHONE = r'(?s)<p class="col-md-6 title">(.*?)</p>', r'fa-phone"></span>([^<]*)<'
PERSON, MAIL, TITLES, SURNAME = r'(?s)fa-user"></span><a [^>]*>(.*?)</a>', r'fa-envelope"></span>(?:<span[^>]*>)?([^<]*@[^<]*)<', r"^(?:Ms|Mr|Mrs|Mdm|Dr|Prof|Er)\.?\s+", r"^[A-Z][A-Z'-]+$"
#: Hosts of accounts, path words there that aren't accounts, hosts that are nobody's own, and the order of channels.
SOCIAL = {"x.com": "x", "twitter.com": "x", "instagram.com": "instagram"}
NOT_HANDLES = ("i", "search", "hashtag", "intent", "share", "home", "explore", "p", "reel", "reels", "stories", "status", "accounts", "about", "login")
NOT_OWN = ("linkedin.", "facebook.", "github.", "medium.", "youtube.", "wikipedia.", "x.com", "twitter.", "instagram.", "tiktok.")
CHANNELS = ("direct_line", "mobile", "github", "x", "instagram", "personal_site")
HIDDEN = ("private advertiser", "confidential", "company confidential", "undisclosed")


def printed_addresses(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(EMAIL), F.lit(0)))


def names_in(text: Column) -> Column:
    """Names that a text announces or puts before a registration number, without words of roles before them; two words at least."""
    text = F.coalesce(text, F.lit(""))
    found = F.concat(F.regexp_extract_all(text, F.lit(ANNOUNCED + NAME), F.lit(1)), F.regexp_extract_all(text, F.lit(NAME + REGISTERED), F.lit(1)))
    bare = F.transform(found, lambda n: F.array_join(F.split(F.regexp_replace(n, rf"(?i)^(?:(?:{'|'.join(BEFORE)})[ \t]+)+", ""), r"[ \t]+"), " "))
    whole = F.filter(bare, lambda n: n.contains(" ") & ~F.lower(n).rlike(rf"(?:^| )(?:{'|'.join(NOT_NAMES)})(?: |$)"))
    return F.array_distinct(whole)


def contact(kind: Column, value: Column) -> Column:
    """kind, value of a board's contact; a kind that isn't known is read off the value."""
    kind, value = F.lower(F.trim(F.coalesce(kind, F.lit("")))), F.trim(F.coalesce(value, F.lit("")))
    known = F.when(kind.isin("email", "phone"), kind).when(value.rlike(f"^{EMAIL}$"), "email").otherwise("phone")
    return F.when(value != "", F.struct(known.alias("kind"), value.alias("value")))


def surname_last(name: Column) -> Column:
    """Capital surnames before given names go behind them, in title case; a name all or none of whose words are capital stays."""

    def of(ws: Column) -> Column:
        capital = lambda w: w.rlike(SURNAME)
        given = F.array_position(F.transform(ws, capital), F.lit(False)).cast("int")
        turned = F.concat(F.slice(ws, given, F.size(ws)), F.slice(ws, F.lit(1), given - 1))
        moved = F.array_join(F.transform(turned, lambda w: F.when(capital(w), F.initcap(F.lower(w))).otherwise(w)), " ")
        return F.when(F.forall(ws, capital) | ~F.exists(ws, capital), F.array_join(ws, " ")).otherwise(moved)

    return let(F.split(F.trim(name), r"\s+"), of)


def _said(of: Column, pattern: str) -> Column:
    plain = F.regexp_replace(F.regexp_extract(of, pattern, 1), r"\s+", " ")
    for sign, char in {"&amp;": "&", "&#39;": "'", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&nbsp;": " "}.items():
        plain = F.replace(plain, F.lit(sign), F.lit(char))
    return F.nullif(F.trim(plain), F.lit(""))


def officers(pages: DataFrame, id_: str, markup: str) -> DataFrame:
    """id, place, name, designation, department, phone, email of each person on a directory page. Awards after a comma and titles before a name go; the last agency is the department."""
    each = pages.select(id_, F.posexplode(F.regexp_extract_all(F.col(markup), F.lit(ENTRY), F.lit(1))).alias("place", "entry"))
    entry, agencies = F.col("entry"), F.regexp_extract_all(F.col("entry"), F.lit(AGENCY), F.lit(1))
    name = surname_last(F.trim(F.regexp_replace(F.substring_index(_said(entry, PERSON), ",", 1), TITLES, "")))
    rows = each.select(id_, "place", name.alias("name"), _said(entry, DESIGNATION).alias("designation"), F.when(F.size(agencies) > 1, F.trim(F.element_at(agencies, -1))).alias("department"), _said(entry, PHONE).alias("phone"), _said(entry, MAIL).alias("email"))
    return rows.where("name is not null")


def account(url: Column, title: Column, name: Column) -> Column:
    """kind, value, url of the account that a page of a search is, if its title names the person; null otherwise."""
    host, handle = F.coalesce(urls.host(url), F.lit("")), F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*/+([^/?#]+)", 1)
    kind = F.lit(None).cast("string")
    for h, k in SOCIAL.items():
        kind = F.when(host == h, k).otherwise(kind)
    ws = F.regexp_extract_all(F.lower(name), F.lit("[a-z]+"), F.lit(0))
    label = F.regexp_replace(F.substring_index(host, ".", 1), "[^a-z]", "")
    own = (host != "") & ~host.rlike("|".join(p.replace(".", r"\.") for p in NOT_OWN)) & (F.size(ws) >= 2) & label.contains(F.get(ws, 0)) & label.contains(F.element_at(ws, -1))
    social = F.when((handle != "") & ~F.lower(handle).isin(*NOT_HANDLES), F.struct(kind.alias("kind"), F.when(kind == "x", F.concat(F.lit("@"), handle)).otherwise(handle).alias("value"), F.concat(F.lit("https://"), host, F.lit("/"), handle).alias("url")))
    site = F.when(own, F.struct(F.lit("personal_site").alias("kind"), host.alias("value"), F.concat(F.lit("https://"), host).alias("url")))
    named = F.lower(F.coalesce(title, F.lit(""))).contains(F.lower(name)) & (name != "")
    return F.when(named, F.when(kind.isNotNull(), social).otherwise(site))


def ordered_channels(rows: DataFrame, person: str) -> DataFrame:
    """person, place, kind, value: each channel once, in the order channels are shown, then as they were found. rows: person, at, kind, value."""
    one = rows.groupBy(person, "kind", "value").agg(F.min("at").alias("at"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, CHANNELS)), F.col("kind")), F.lit(0)), F.lit(len(CHANNELS) + 1))
    return one.select(person, F.row_number().over(W.partitionBy(person).orderBy(rank, "at", "value")).alias("place"), "kind", "value")


def email_kind(printed: Column, found: Column, status: Column, seen: Column) -> Column:
    """What is known of an address: whether it was printed, found or built, and what a mailbox check said."""
    guess = F.when(found & seen, "unchecked_seen_online").when(found, "pattern_guess").otherwise("unchecked_our_guess")
    valid = F.when(printed | found, "valid_mailbox_found").otherwise("valid_mailbox_built")
    return F.when(status == "valid", valid).when(status == "invalid", "no_mailbox").when(printed, "unchecked_seen_online").otherwise(guess)


def company(copies: DataFrame, listing: str) -> DataFrame:
    """listing, name, found_by: whom a listing is for, by an earlier listing, its own copy with a company id, its copy's name, or what it says itself. copies: listing, own_name, copy_name, company_id, earlier_name."""
    shown = lambda c: F.when(~F.lower(F.trim(c)).isin(*HIDDEN) & (F.trim(c) != ""), c)
    c = F.col
    no_copy = c("copy_name").isNull() & c("company_id").isNull()
    pick = (
        F.when(no_copy & c("earlier_name").isNotNull(), F.struct(c("earlier_name").alias("name"), F.lit("earlier_linkedin_listing").alias("found_by")))
        .when(c("company_id").isNotNull(), F.struct(F.coalesce("copy_name", "own_name").alias("name"), F.lit("linkedin_company_id").alias("found_by")))
        .when(c("copy_name").isNotNull(), F.struct(c("copy_name").alias("name"), F.lit("linkedin_copy_name").alias("found_by")))
        .otherwise(F.struct(c("own_name").alias("name"), F.lit("listing_name").alias("found_by")))
    )
    return copies.select(listing, pick.alias("_p")).select(listing, shown(c("_p.name")).alias("name"), F.when(shown(c("_p.name")).isNotNull(), c("_p.found_by")).alias("found_by"))


def owners(printed: DataFrame, named: DataFrame, listing: str) -> DataFrame:
    """listing, email, name of each printed address, with the one person whose name it spells; the first of several, none if nobody fits. named: listing, place, name."""
    both = printed.join(named, listing, "left")
    fits = people.spells(F.substring_index("email", "@", 1), F.col("name"))
    return both.groupBy(listing, "email").agg(F.min_by(F.when(fits, F.col("name")), F.when(fits, F.col("place"))).alias("name"))
