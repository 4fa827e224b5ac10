"""Small aggregates over costs, searches and failures, and the words they are reported in."""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nights are counted in a zone eight hours ahead of UTC, without daylight saving.
ZONE, OFFSET = "Asia/Singapore", timezone(timedelta(hours=8))


def midnight(now: Column) -> Column:
    """The latest local midnight, as UTC (timestamps without zone hold UTC)."""
    return (F.date_trunc("day", now + F.expr("INTERVAL 8 HOURS")) - F.expr("INTERVAL 8 HOURS")).cast("timestamp_ntz")


def month_start(now: Column) -> Column:
    return (F.date_trunc("month", now + F.expr("INTERVAL 8 HOURS")) - F.expr("INTERVAL 8 HOURS")).cast("timestamp_ntz")


def new_id(*parts: str, now: datetime | None = None) -> str:
    """parts_YYYYMMDD_HHMMSS_xxxx in local time: sorts by time, and two at once differ."""
    stamp = (now or datetime.now(timezone.utc)).astimezone(OFFSET).strftime("%Y%m%d_%H%M%S")
    return "_".join((*parts, stamp, secrets.token_hex(2)))


def age_words(days: Column) -> Column:
    """Elapsed days in words; halves of weeks and months round to even."""
    weeks, months = (F.bround(days / F.lit(float(n))).cast("long") for n in (7, 30))
    return (
        F.when(days <= 0, "today").when(days == 1, "1 day ago").when(days < 14, F.format_string("%d days ago", days))
        .when(days < 60, F.format_string("%d weeks ago", weeks)).otherwise(F.format_string("%d months ago", months))
    )


def seen_words(nights: Column) -> Column:
    return F.when(nights.isNull(), "—").when(nights <= 0, "today").when(nights == 1, "yesterday").otherwise(F.format_string("%d days ago", nights))


def average_seconds(searches: DataFrame, last: int) -> DataFrame:
    """seconds: how long the last finished searches ran on average; null before any has."""
    recent = searches.where("started_at is not null and finished_at is not null").orderBy(F.desc("finished_at"), "id").limit(last)
    micros = F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return recent.agg(F.avg(micros / 1e6).alias("seconds"))


def searches_since(searches: DataFrame, start: Column) -> DataFrame:
    return searches.where(F.col("requested_at") >= start).agg(F.count("*").alias("n"))


def credits(spent: DataFrame, run: str) -> DataFrame:
    """run, credits: those that could be measured; a run with none has 0."""
    return spent.groupBy(run).agg(F.coalesce(F.sum("credits"), F.lit(0.0)).alias("credits"))


def without_cost(runs: DataFrame) -> DataFrame:
    """Runs that await their cost, the oldest first."""
    return runs.where("cost_usd is null").orderBy("started_at", "id")


def latest_of_group(searches: DataFrame, anchors: DataFrame, group: str, key: Sequence[str], ok: Column | None = None) -> DataFrame:
    """group and its most recently requested search (with ok: among those for which it holds). anchors: group, key."""
    rows = searches if ok is None else searches.where(ok)
    return rows.join(anchors.select(group, *key), [*key]).groupBy(group).agg(F.max_by(F.struct(*searches.columns), F.struct("requested_at", "search_id")).alias("_s")).select(group, "_s.*")


def found_rows(found: DataFrame, latest: DataFrame, group: str, run: str) -> DataFrame:
    """Rows that the latest search of each group found."""
    return found.join(latest.select(group, run), run)


def cached_share(receipts: DataFrame, by: str) -> DataFrame:
    """by, cost_usd, cached: the share of input tokens that came from a cache, in whole percent; null without any tokens."""
    all_ = F.sum("cached_tokens") + F.sum("input_tokens")
    return receipts.groupBy(by).agg(F.sum("cost_usd").alias("cost_usd"), F.when(all_ > 0, F.bround(F.sum("cached_tokens") * 100 / all_).cast("long")).alias("cached"))


def failures(items: DataFrame) -> DataFrame:
    """id, stage, attempts, reason: a row for each listing whose input failed for good. items: stage, outcome, ids, attempts, correction."""
    return items.where("outcome = 'terminal'").select(F.explode("ids").alias("id"), F.initcap("stage").alias("stage"), "attempts", short_reason(F.col("correction")).alias("reason"))


#: What a diagnostic says, by the first of these phrases in it.
TITLES = (
    ("private preferences:|private configuration |private triage prompt is unconfigured|private extraction prompt is unconfigured", "Private configuration invalid"),
    ("gemini batch|job_state_failed", "Gemini Batch job failed"), ("deployed wheel identity", "Cleaning code out of date"), ("provider items still failed", "Gemini refused JDs"),
    ("stalemapping|canonical mapping not current", "Job grouping out of date"), (r"databricks|/api/2\.", "Databricks unavailable"), ("gemini|google http", "Gemini request failed"), ("review", "Review refresh failed"),
)


def error_title(value: Column) -> Column:
    """The first title whose phrase a diagnostic has; any other is a failed step, and none is a dash."""
    found, low = F, F.lower(F.coalesce(value, F.lit("")))
    for phrases, title in TITLES:
        found = found.when(low.rlike(phrases), title)
    return found.when(low != "", "Step failed").otherwise("—")


def short_reason(value: Column, longest: int = 220) -> Column:
    """One line without keys, provider references, times and raw bodies."""
    text = F.trim(F.regexp_replace(F.coalesce(value, F.lit("—")), r"\s+", " "))
    for pattern, instead in ((r"(?i)([?&](?:key|token|password)=)[^ &]+", "$1[private]"), (r"\b(?:batches|files|cachedContents)/[^\s,;]+", "[private provider reference]"), (r"\b\d{4}-\d\d-\d\dT\S+", "[saved time]")):
        text = F.regexp_replace(text, pattern, instead)
    head = F.regexp_extract(text, r"^([^{\[]*)", 1)
    bare = F.regexp_replace(head, r"^[ :]+|[ :]+$", "")
    body = text.contains("{") | text.rlike(r'\[\s*[\{"\d]')
    text = F.when(body, F.concat(F.when(bare != "", F.concat(bare, F.lit(". "))).otherwise(""), F.lit("Detailed diagnostics are saved privately."))).otherwise(text)
    return F.when(F.length(text) > longest, F.concat(F.substring(text, 1, longest), F.lit("…"))).otherwise(text)


def salary_label(raw: Column, low: Column, high: Column, currency: Column, period: Column) -> Column:
    """The source's own words, else a band from the bounds."""
    amount = lambda x: F.regexp_replace(F.format_number(x, 2), r"\.?0+$", "")
    band = F.when(low.isNull(), amount(high)).otherwise(F.concat(amount(low), F.when(high.isNotNull() & (high != low), F.concat(F.lit(" – "), amount(high))).otherwise("")))
    side = F.when(high.isNull(), "From").when(low.isNull(), "Up to")
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.when(blank(raw).isNotNull(), raw).when(low.isNull() & high.isNull(), "Not supplied").otherwise(F.concat_ws(" ", side, F.coalesce(blank(currency), F.lit("Currency not supplied")), band, blank(period)))


def source_line(name: Column, status: Column, failed: Column) -> Column:
    """A sentence about a source that came back partial or failed."""
    fetches = F.concat(F.lit(": "), F.regexp_replace(F.format_number(failed, 0), r"\.0*$", ""), F.lit(" JD fetch"), F.when(failed != 1, "es").otherwise(""), F.lit(" failed."))
    return F.when(status == "partial", F.concat(name, F.lit(" came back partial"), F.when(F.coalesce(failed, F.lit(0)) > 0, fetches).otherwise("."))).otherwise(F.concat(name, F.lit(" failed.")))
