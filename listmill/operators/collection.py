"""Collection runs: rows that a source returned, what a run saw and fetched, and whether that is plausible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A run is broken if so many of its fetches fail, once so many were tried; boards whose sweeps must be full.
FAILURES, TRIED = 0.30, 20
SWEPT = ("mcf", "jobstreet", "jobsdb", "seek", "indeed", "linkedin")


def country_subdomain(url: Column, suffix: str = ".linkedin.com") -> Column:
    """Two letters before the suffix of an address's host, or null: no sign of a country. Only the host counts, not what the path or query says."""
    host = F.lower(F.regexp_extract(F.trim(url), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_extract(host, rf"^([a-z]{{2}})\Q{suffix}\E$", 1), F.lit(""))


def filled(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def row_class(id_: Column, pattern: str, texts: Sequence[Column], in_market: Column) -> Column:
    """valid, rejected (another market) or malformed: an id that doesn't fit, or a blank text."""
    sound = F.coalesce(F.trim(id_).rlike(f"^(?:{pattern})$"), F.lit(False))
    for text in texts:
        sound = sound & filled(text)
    return F.when(~sound, "malformed").when(F.coalesce(in_market, F.lit(False)), "valid").otherwise("rejected")


def market_of(country: Column, market: Column, location: Column, tokens: Sequence[str]) -> Column:
    """Is a row of the market: by the country of its address, else by words of its location."""
    return F.when(country.isNotNull(), country == market).otherwise(F.coalesce(F.lower(location).rlike("|".join(rf"\Q{t}\E" for t in tokens)), F.lit(False)))


def chosen_rows(rows: DataFrame, id_: str, encountered: Sequence[str], last: bool) -> DataFrame:
    """One row of each id: the one that was encountered last, or first."""
    order = F.struct(*encountered)
    best = rows.groupBy(id_).agg((F.max_by if last else F.min_by)(F.struct(*(c for c in rows.columns if c != id_)), order).alias("_row"))
    return best.select(id_, "_row.*")


def card_signal(listed: Column, fields: Mapping[str, Column]) -> Column:
    """listed|digest of the card's fields as JSON with sorted keys; a missing field counts as null."""
    card = F.struct(*(fields[name].alias(name) for name in sorted(fields)))
    return F.concat(listed, F.lit("|"), F.sha2(F.to_json(card, {"ignoreNullFields": "false"}), 256))


def counters(rows: DataFrame, run: str, state: Column, outcome: Column) -> DataFrame:
    """Of each run: unique_seen, new_jobs, changed_jobs, jds_intended, jds_fetched, fetch_failures, backlog_remaining, status, broken.

    state: new, changed, unresolved or unchanged; outcome: fetched, failed, deferred, or null where nothing was to be fetched.
    """
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    per = rows.groupBy(run).agg(
        F.count("*").alias("unique_seen"), n(state == "new").alias("new_jobs"), n(state == "changed").alias("changed_jobs"), n(outcome.isin("fetched", "failed")).alias("jds_intended"),
        n(outcome == "fetched").alias("jds_fetched"), n(outcome == "failed").alias("fetch_failures"), n(outcome == "deferred").alias("backlog_remaining"),
    )
    partial = (F.col("fetch_failures") > 0) | (F.col("backlog_remaining") > 0)
    return per.withColumn("status", F.when(partial, "partial").otherwise("ok")).withColumn("broken", (F.col("jds_intended") >= TRIED) & (F.col("fetch_failures") > FAILURES * F.col("jds_intended")))


def problem(status: Column, board: Column, swept: Column, succeeded: Column, full_sweep: Column) -> Column:
    """Did a run lose coverage: it failed or never ended, or is partial for want of searches (lost payloads alone are routine)."""
    lost = F.coalesce(succeeded < swept, F.lit(False)) | (board.isin(*SWEPT) & F.coalesce(~full_sweep, F.lit(False)))
    return F.coalesce(status.isin("failed", "running", "missing") | ((status == "partial") & lost), F.lit(False))


def implausible(unique: Column, floor: Column, ceiling: Column, canary_total: Column, failed_terms: Column, terms: Column) -> Column:
    """Why a sweep can't be trusted, or null."""
    return (
        F.when(canary_total == 0, "a canary term found nothing").when(failed_terms > FAILURES * terms, "too many terms failed").when(unique > ceiling, "above the ceiling").when(unique < floor, "below the floor")
    )


def finished(runs: DataFrame, ends: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """runs with what their ends say; blank text counts as null, and runs that haven't ended stay as they are."""
    typed = dict(runs.dtypes)
    said = ends.select(key, *(F.nullif(F.trim(c), F.lit("")).cast(typed[c]).alias(f"_{c}") for c in columns), F.lit(True).alias("_ended"))
    both = runs.join(said, key, "left")
    return both.select(*(F.when(F.col("_ended"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in runs.columns))


def first_sightings(pages: DataFrame, term: str, page: str, hits: str) -> DataFrame:
    """board_job_id, signal, term of each job's first sighting, in the order of terms, pages and places on them. hits: array of struct(id, signal)."""
    each = pages.select(F.col(term).alias("term"), F.col(page).alias("_page"), F.posexplode(hits).alias("_at", "_hit")).where("_hit.id is not null")
    return each.groupBy(F.col("_hit.id").alias("board_job_id")).agg(F.min_by(F.struct(F.col("_hit.signal").alias("signal"), "term"), F.struct("term", "_page", "_at")).alias("_f")).select("board_job_id", "_f.*")


def execution(runs: DataFrame, intended: DataFrame) -> DataFrame:
    """place, board, market, status, runtime (1m05s): the runs of one execution in the order of their starts, then the pairs that have none."""
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    runtime = F.when(F.col("finished_at").isNotNull(), F.format_string("%dm%02ds", F.floor(seconds / 60).cast("long"), seconds % 60))
    ran = runs.select(F.row_number().over(W.orderBy("started_at", "board", "market")).alias("place"), "board", "market", "status", runtime.alias("runtime"))
    missing = intended.join(runs, ["board", "market"], "left_anti").select(F.lit(None).cast("int").alias("place"), "board", "market", F.lit("missing").alias("status"), F.lit(None).cast("string").alias("runtime"))
    return ran.unionByName(missing)
