"""Review reads: filters, states that an owner gave to listings, the context of a listing, saved jobs.

Listings have id, board, market, board_job_id, canonical_job_id, bucket, title, advertiser_name, hiring_company_name, is_recruitment_firm and the times they were first and last seen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text

#: Buckets in scope, best first; windows of days; longest list of kept ids; reasons that a later night decides anew.
IN_SCOPE = ("top_picks", "in_lane", "less_interested")
WINDOWS = ("3", "7", "14", "28", "all")
KEPT = 16_000
STATES = ("read_at", "starred_at", "saved_to_apply_at")


def rank_in(c: Column, names: Sequence[str]) -> Column:
    """The place of a value in a list; what isn't in it comes last."""
    place = F.array_position(F.array(*map(F.lit, names)), F.coalesce(c, F.lit(""))).cast("int")
    return F.when(place > 0, place - 1).otherwise(len(names))


def judged(first_seen: Column, start: Column, bucket: Column, reason: Column, deferred: Sequence[str]) -> Column:
    """Is a listing decided: within the window, with a bucket, and not for a reason that only puts it off."""
    return F.coalesce((first_seen >= start) & bucket.isNotNull() & ~F.coalesce(reason.isin(*deferred), F.lit(False)), F.lit(False))


@dataclass(frozen=True)
class Filters:
    """What a reader asked for; empty means no restriction."""

    markets: Sequence[str] = ()
    buckets: Sequence[str] = ()
    boards_off: Sequence[str] = ()  # "SG:mcf"
    board: str = ""
    ranges: Sequence[tuple[datetime, datetime]] = ()
    q: str = ""
    title: str = ""
    exclude: str = ""
    company: str = ""
    posted_by: str = ""  # employer or recruitment
    description: str = ""
    leaders: Column | None = field(default=None, compare=False)  # widens the bucket filter


def predicates(f: Filters) -> dict[str, Column]:
    """A predicate for each thing asked for, by name."""
    col = lambda c: F.coalesce(F.col(c), F.lit(""))
    has = lambda c, x: col(c).ilike(text.like_escaped(x))
    out: dict[str, Column] = {}
    if f.markets:
        out["market"] = F.col("market").isin(*f.markets)
    if f.buckets:
        asked = F.coalesce(F.col("bucket"), F.lit("not_sorted")).isin(*f.buckets)
        out["bucket"] = asked if f.leaders is None else asked | f.leaders
    if f.boards_off:
        out["board"] = ~F.concat_ws(":", "market", "board").isin(*f.boards_off)
    elif f.board:
        out["board"] = F.col("board") == f.board.lower()
    if f.ranges:
        out["seen"] = reduce(or_, ((F.col("listing_first_seen_at") >= F.lit(a)) & (F.col("listing_first_seen_at") < F.lit(b)) for a, b in f.ranges))
    if f.q.strip():
        out["q"] = reduce(or_, (has(c, f.q.strip()) for c in ("title", "advertiser_name", "hiring_company_name")))
    if f.title:
        out["title"] = has("title", f.title)
    if f.exclude:
        out["exclude"] = ~has("title", f.exclude)
    if f.company:
        out["company"] = has("advertiser_name", f.company)
    if f.posted_by:
        out["posted_by"] = F.coalesce(F.col("is_recruitment_firm") == F.lit(f.posted_by == "recruitment"), F.lit(False))
    if f.description:
        try:
            out["description"] = text.search(f.description, col("description_text"))
        except ValueError:  # an expression that can't be read is left out, as the reader is told
            pass
    return out


def where(f: Filters, skip: str | None = None) -> Column:
    """All predicates together, but for the one whose own counts are wanted."""
    return reduce(and_, (p for name, p in predicates(f).items() if name != skip), F.lit(True))


def chips(f: Filters) -> list[tuple[str, str]]:
    """name, words of each restriction, as shown with a way to remove it."""
    said = {"market": ", ".join(f.markets), "bucket": ", ".join(f.buckets), "board": f.board or ("not " + ", ".join(f.boards_off) if f.boards_off else ""), "q": f.q.strip(), "title": f.title, "exclude": f.exclude and f"not {f.exclude}", "company": f.company, "posted_by": f.posted_by and f"posted by {f.posted_by}", "description": f.description}
    return [(name, words) for name, words in said.items() if words]


def late_columns(chosen: DataFrame, wide: DataFrame, id_: str, columns: Sequence[str]) -> DataFrame:
    """Chosen rows with wide columns joined last, so they don't travel through what chose the rows."""
    return chosen.join(wide.select(id_, *columns), id_)


def kept_ids(value: str) -> list[int]:
    """Ids of a comma-separated list; anything else is refused."""
    if not value:
        return []
    if len(value) > KEPT or not all(x.isascii() and x.isdigit() for x in value.split(",")):
        raise ValueError("not a list of ids")
    return [int(x) for x in value.split(",")]


def shown(rows: DataFrame, states: DataFrame, id_: str, show: str, kept: Sequence[int] = ()) -> DataFrame:
    """Rows that are unread, read, or all; those kept on the page stay, whatever their state. states: id, read_at."""
    both = rows.join(states.select(id_, "read_at"), id_, "left")
    want = {"unread": F.col("read_at").isNull(), "read": F.col("read_at").isNotNull(), "all": F.lit(True)}[show]
    return both.where(want | F.col(id_).isin([int(x) for x in kept]))


def group_key(group: Column, *listing: Column) -> Column:
    """A listing's group, or itself where it has none."""
    return F.coalesce(F.concat(F.lit("group:"), group), F.concat_ws(":", F.lit("listing"), *listing))


def states_by_group(anchors: DataFrame, key: str, stamps: Sequence[str]) -> DataFrame:
    """key, the earliest of each stamp, and the anchors of the group."""
    return anchors.groupBy(key).agg(*(F.min(s).alias(s) for s in stamps), F.array_sort(F.collect_set("listing")).alias("members"))


def resolved(rows: DataFrame, states: DataFrame, key: str, stamps: Sequence[str]) -> DataFrame:
    """rows with their state: that of the group which holds the listing now, else that of the row's own (perhaps older) group. states: as states_by_group()."""
    by_member = states.select(F.explode("members").alias("listing"), *(F.col(s).alias(f"_m_{s}") for s in stamps), F.lit(True).alias("_m"))
    by_group = states.select(F.col(key), *(F.col(s).alias(f"_g_{s}") for s in stamps))
    both = rows.join(by_member, "listing", "left").join(by_group, key, "left")
    return both.select(*rows.columns, *(F.when(F.col("_m"), F.col(f"_m_{s}")).otherwise(F.col(f"_g_{s}")).alias(s) for s in stamps))


def changed_state(anchors: DataFrame, key: str, group: Column, stamp: str, at: Column | None) -> DataFrame:
    """anchors with one stamp set (the first stays) or cleared (at None) for all of the groups for which `group` holds."""
    if at is None:
        return anchors.withColumn(stamp, F.when(~F.coalesce(group, F.lit(False)), F.col(stamp)))
    return anchors.withColumn(stamp, F.when(group, F.coalesce(F.min(stamp).over(W.partitionBy(key)), at)).otherwise(F.col(stamp)))


def copies(rows: DataFrame, group: str, listing: Sequence[str], last: Sequence[str]) -> DataFrame:
    """rows (one a listing) with copy_kind by each row's group, seen from the group's first listing: this, other (the latest of its board and market), or earlier."""
    per = W.partitionBy(group)
    board = W.partitionBy(group, *listing[:-1]).orderBy(*(F.desc(c) for c in last))
    first = F.min(F.struct(*listing)).over(per)
    kind = F.when(F.struct(*listing) == first, "this").when(F.row_number().over(board) == 1, "other").otherwise("earlier")
    return rows.withColumn("copy_kind", kind)


def advertiser_windows(rows: DataFrame, advertiser: str, seen: str, now: Column, windows: Sequence[str] = WINDOWS) -> DataFrame:
    """advertiser, days, in_scope, others: jobs first seen within each window, one pass for all windows."""
    scope = F.coalesce(F.col("bucket").isin(*IN_SCOPE), F.lit(False))
    each = []
    for w in windows:
        recent = F.lit(True) if w == "all" else F.col(seen) >= now - F.expr(f"INTERVAL {int(w)} DAYS")
        each.append(F.struct(F.lit(w).alias("days"), F.count_if(recent & scope).alias("in_scope"), F.count_if(recent & ~scope).alias("others")))
    return rows.groupBy(advertiser).agg(F.array(*each).alias("_w")).select(advertiser, F.inline("_w"))


def possible_repeats(rows: DataFrame, key: Sequence[str], now: Column, days: int = 30) -> DataFrame:
    """a, b: listings of one advertiser with the same title on different boards, in different groups or none, both first seen lately.

    An equal join on advertiser and title, on rows of the window only.
    """
    lately = rows.where(F.col("listing_first_seen_at") >= now - F.expr(f"INTERVAL {int(days)} DAYS")).withColumn("_title", F.lower(text.collapse(F.col("title")))).where("_title <> ''")
    x, y = lately.alias("x"), lately.alias("y")
    same = reduce(and_, (F.col(f"x.{k}") == F.col(f"y.{k}") for k in (*key, "_title")))
    apart = ~F.coalesce(F.col("x.canonical_job_id") == F.col("y.canonical_job_id"), F.lit(False))
    return x.join(y, same & (F.col("x.board") < F.col("y.board")) & apart).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def saved_jobs(jobs: DataFrame, priority: bool = False, posted_by: str = "all", order: str = "priority") -> DataFrame:
    """place, id of saved jobs: starred first, then by bucket, then latest saved first (order priority), or just that (added)."""
    if posted_by not in ("all", "employer", "recruitment") or order not in ("priority", "added"):
        raise ValueError("unknown filter of saved jobs")
    keep = F.col("saved_to_apply_at").isNotNull()
    if priority:
        keep = keep & F.col("starred_at").isNotNull()
    if posted_by != "all":
        keep = keep & F.coalesce(F.col("is_recruitment_firm") == F.lit(posted_by == "recruitment"), F.lit(False))
    first = [F.col("starred_at").isNull(), rank_in(F.col("bucket"), IN_SCOPE)] if order == "priority" else []
    place = F.row_number().over(W.orderBy(*first, F.desc("saved_to_apply_at"), F.desc("id")))  # an owner's saved jobs, some hundreds
    return jobs.where(keep).select(place.alias("place"), "id")


def saved_in_list_order(jobs: DataFrame, group: str, buckets: Sequence[str]) -> DataFrame:
    """place, group, id: one job of each group (no repeat, best bucket, newest wording, largest id), starred first, then by bucket, then earliest saved first."""
    best = W.partitionBy(group).orderBy(F.col("repeat_of_id").isNotNull(), rank_in(F.col("bucket"), buckets), F.desc("wording_first_seen_at"), F.desc("id"))
    one = jobs.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    return one.select(F.row_number().over(W.orderBy(F.col("starred_at").isNull(), rank_in(F.col("bucket"), buckets), "saved_to_apply_at", "id")).alias("place"), group, "id")


def summary(rows: DataFrame, last_night: Column, hot: Sequence[str]) -> DataFrame:
    """P0 (hot and new since the last night), P1 (hot) and P2 (all): groups and listings. boards: an array for each group."""
    is_hot = F.coalesce(F.col("bucket").isin(*hot), F.lit(False))
    new = is_hot & (F.col("listing_first_seen_at") >= last_night)
    n = lambda c, name: [F.count_if(c).alias(f"{name}_groups"), F.coalesce(F.sum(F.when(c, F.size("boards"))), F.lit(0)).alias(f"{name}_listings")]
    return rows.agg(*n(new, "p0"), *n(is_hot, "p1"), *n(F.lit(True), "p2"))


def company_key(bucket: Column, recruitment: Column, board: Column, hiring: Column, advertiser: Column, id_: Column) -> Column:
    """By what listings are clustered: the advertiser, the hiring company where a recruitment firm posted it on a board that names it, else the listing itself."""
    key = F.when(F.coalesce(recruitment, F.lit(False)), F.when(board == "mcf", hiring)).otherwise(advertiser)
    return F.coalesce(F.when(bucket.isin(*IN_SCOPE), key), F.concat(F.lit("listing:"), id_))


def requirement_rows(lines: DataFrame, id_: str) -> DataFrame:
    """id, quote, note, details: lines of requirements that share their quote and note are one row, in the order of the lines (of several that begin at one place: quote, note). lines: id, place, quote, note, detail."""
    last = [F.struct(F.col(c).isNull(), c) for c in ("place", "detail")]
    per = lines.groupBy(id_, "quote", "note").agg(F.min("place").alias("place"), F.array_sort(F.collect_list(F.when(F.col("detail").isNotNull(), F.struct(*last, "detail")))).alias("_d"))
    order = [F.asc_nulls_last(c) for c in ("place", "quote", "note")]
    detail = F.when(F.size("_d") > 0, F.array_join(F.transform("_d", lambda x: x["detail"]), ", "))
    return per.select(id_, F.row_number().over(W.partitionBy(id_).orderBy(*order)).alias("row"), "quote", "note", detail.alias("detail"))


#: Listings of one advertiser that are listed together for the history: a run of values as Parquet packs them, so that the list repeats as the same bytes; and selected listings that go through such a list at once.
LISTED, CHOSEN = 504, 128


def advertiser_history(chosen: DataFrame, mine: DataFrame) -> DataFrame:
    """selected, id, this_job: each selected listing with every listing of its advertiser in the owner's history. chosen: selected, advertiser_name, own; mine: id, advertiser_name, canonical_job_id.

    The pairs grow with the square of an advertiser's listings. They are made from lists by two loops, and follow one another so that columnar files of them stay small: a list of ids is repeated
    for one selected listing after another. Only lists are shuffled, never pairs.
    """
    n = int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def listed(rows: DataFrame, key: Sequence[str], order: Sequence[str], size: int, name: str) -> DataFrame:
        place = F.row_number().over(W.partitionBy(*key).orderBy(*order))
        parts = rows.where("advertiser_name is not null").withColumn("_part", F.floor((place - 1) / size))
        return parts.groupBy(*key, "_part").agg(F.sort_array(F.collect_list(F.struct(*order))).alias(name))

    lists = listed(mine, ["advertiser_name"], ["canonical_job_id", "id"], LISTED, "_listed")
    blocks = listed(chosen, ["advertiser_name", "own"], ["selected"], CHOSEN, "_chosen").drop("_part")
    both = blocks.join(lists.select("advertiser_name", "_part"), "advertiser_name")
    key = ["advertiser_name", "_part"]
    # a list meets its blocks in one task, sorted by list; a fixed number of tasks, as small inputs of these loops have large results
    met = both.repartition(n, *key).join(lists.repartition(n, *key).hint("merge"), key)
    one = met.select("own", "_listed", F.inline("_chosen").alias("selected"))
    return one.select("selected", "own", F.explode("_listed").alias("_m")).select("selected", "_m.id", F.col("_m.canonical_job_id").eqNullSafe(F.col("own")).alias("this_job"))


def progress(items: DataFrame, seconds: Mapping[str, float]) -> DataFrame:
    """total, done, failed, percent, left (seconds of the longer queue): how far searches of each kind are. items: kind, status."""
    waiting = F.col("status").isin("queued", "searching")
    left = F.greatest(*(F.count_if(waiting & (F.col("kind") == k)) * F.lit(float(s)) for k, s in seconds.items()))
    done, total = F.count_if(~waiting), F.count("*")
    return items.agg(total.alias("total"), done.alias("done"), F.count_if(F.col("status") == "failed").alias("failed"), F.when(total > 0, F.round(done * 100 / total)).otherwise(0.0).alias("percent"), left.alias("left"))
