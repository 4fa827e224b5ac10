"""Review reads over orders and their customers, which stand for listings and advertisers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import review
from ..sources.tables import read
from .registry import query

_BOARDS, _MARKETS, _BUCKETS = ("mcf", "seek", "linkedin", "indeed"), ("SG", "HK", "TH"), ("top_picks", "in_lane", "less_interested", "not_sorted")
_L = f"""l AS (SELECT o_orderkey AS id, {list(_BOARDS)}[(o_orderkey % 4 + 1)::INT] AS board, {list(_MARKETS)}[(c_nationkey % 3 + 1)::INT] AS market, CASE WHEN o_custkey % 11 > 0 THEN 'g' || o_custkey % 200 END AS canonical_job_id,
CASE WHEN o_custkey % 5 < 4 THEN {list(_BUCKETS)}[(o_custkey % 5 + 1)::INT] END AS bucket, o_orderpriority AS title, c_mktsegment AS advertiser_name, c_name AS hiring_company_name, o_orderdate AS seen, CASE WHEN c_nationkey <> 0 THEN c_acctbal < 0 END AS is_recruitment_firm, o_totalprice AS price, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _pick(names: tuple, c) -> F.Column:
    return F.element_at(F.array(*map(F.lit, names)), (c + 1).cast("int"))


def listings(spark: SparkSession, d: str) -> DataFrame:
    both = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_custkey")
    return both.select(
        F.col("o_orderkey").alias("id"), _pick(_BOARDS, F.col("o_orderkey") % 4).alias("board"), _pick(_MARKETS, F.col("c_nationkey") % 3).alias("market"), F.when(k % 11 > 0, F.concat(F.lit("g"), (k % 200).cast("string"))).alias("canonical_job_id"),
        F.when(k % 5 < 4, F.get(F.array(*map(F.lit, _BUCKETS)), (k % 5).cast("int"))).alias("bucket"), F.col("o_orderpriority").alias("title"), F.col("c_mktsegment").alias("advertiser_name"), F.col("c_name").alias("hiring_company_name"),
        F.col("o_orderdate").alias("listing_first_seen_at"), F.when(F.col("c_nationkey") != 0, F.col("c_acctbal") < 0).alias("is_recruitment_firm"), F.col("o_totalprice").alias("price"), k,
    )


_F = review.Filters(
    markets=("SG", "HK"), buckets=("top_picks", "not_sorted"), boards_off=("SG:mcf", "HK:seek"), ranges=((dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)), (dt.datetime(1999, 6, 1), dt.datetime(2000, 1, 1))),
    q="er", exclude="5-low", company="R", posted_by="employer",
)
_PARTS = {
    "market": "market IN ('SG', 'HK')", "bucket": "coalesce(bucket, 'not_sorted') IN ('top_picks', 'not_sorted')", "board": "(market || ':' || board) NOT IN ('SG:mcf', 'HK:seek')",
    "rest": "((seen >= TIMESTAMP '1996-01-01' AND seen < TIMESTAMP '1997-01-01') OR (seen >= TIMESTAMP '1999-06-01' AND seen < TIMESTAMP '2000-01-01')) AND (title ILIKE '%er%' OR advertiser_name ILIKE '%er%' OR hiring_company_name ILIKE '%er%') AND title NOT ILIKE '%5-low%' AND advertiser_name ILIKE '%R%' AND is_recruitment_firm IS FALSE",
}


@query(f"WITH {_L} SELECT id FROM l WHERE {' AND '.join(_PARTS.values())}")
def review_filters(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).where(review.where(_F)).select("id")


@query(f"WITH {_L} " + " UNION ALL ".join(f"SELECT '{own}' AS facet, {expr} AS value, count(*) AS n FROM l WHERE {' AND '.join(p for name, p in _PARTS.items() if name != own)} GROUP BY 2" for own, expr in (("market", "market"), ("bucket", "coalesce(bucket, 'not_sorted')"), ("board", "board"))))
def facets_without_own(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each facet under all filters but its own."""
    rows, out = listings(spark, d).withColumn("bucket", F.coalesce("bucket", F.lit("not_sorted"))), None
    for name in ("market", "bucket", "board"):
        part = rows.where(review.where(_F, skip=name)).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("facet"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT doc_id, n_chars, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 AND lang = 'en'""")
def late_descriptions(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    chosen = docs.where("lang = 'en'").select("doc_id", "n_chars").join(read(spark, d, "labels").where("quality = 1 and toxic = 0").select("doc_id"), "doc_id")
    return review.late_columns(chosen, docs, "doc_id", ["text"])


@query(f"""WITH {_L} SELECT id, coalesce(seen >= TIMESTAMP '1997-01-01' AND bucket IS NOT NULL AND title NOT IN ('1-URGENT', '5-LOW'), false) AS judged FROM l""")
def judged_listings(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("id", review.judged(F.col("listing_first_seen_at"), F.lit("1997-01-01").cast("timestamp_ntz"), F.col("bucket"), F.col("title"), ["1-URGENT", "5-LOW"]).alias("judged"))


@query("""WITH s AS (SELECT DISTINCT user_id AS id, max(ts) FILTER (WHERE event_type = 'click' AND value > 60) OVER (PARTITION BY user_id) AS read_at FROM events) SELECT id FROM s WHERE read_at IS NULL OR id IN (1, 2, 3)""")
def unread_rows(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events")
    states = events.where("event_type = 'click' and value > 60").groupBy(F.col("user_id").alias("id")).agg(F.max("ts").alias("read_at"))
    return review.shown(events.select(F.col("user_id").alias("id")).distinct(), states, "id", "unread", review.kept_ids("1,2,3")).select("id")


_A = """a AS (SELECT user_id AS listing, 'g' || user_id % 30 AS grp, CASE WHEN value < 30 THEN ts END AS read_at, CASE WHEN value > 90 THEN ts END AS starred_at FROM events WHERE event_type = 'click')"""


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    when = lambda c, name: F.when(c, F.col("ts")).alias(name)
    return read(spark, d, "events").where("event_type = 'click'").select(F.col("user_id").alias("listing"), F.concat(F.lit("g"), (F.col("user_id") % 30).cast("string")).alias("grp"), when(F.col("value") < 30, "read_at"), when(F.col("value") > 90, "starred_at"))


@query(f"""WITH {_A}, s AS (SELECT grp, min(read_at) AS read_at, min(starred_at) AS starred_at, list(DISTINCT listing) AS members FROM a GROUP BY 1), m AS (SELECT unnest(members) AS listing, read_at, starred_at FROM s),
r AS (SELECT DISTINCT user_id AS listing, 'g' || user_id % 40 AS grp FROM events) SELECT r.listing, r.grp, CASE WHEN m.listing IS NOT NULL THEN m.read_at ELSE s.read_at END AS read_at, CASE WHEN m.listing IS NOT NULL THEN m.starred_at ELSE s.starred_at END AS starred_at FROM r LEFT JOIN m USING (listing) LEFT JOIN s USING (grp)""")
def resolved_states(spark: SparkSession, d: str) -> DataFrame:
    """The state of the group that holds a listing now goes before that of the group its row names."""
    stamps = ["read_at", "starred_at"]
    states = review.states_by_group(_anchors(spark, d), "grp", stamps)
    rows = read(spark, d, "events").select(F.col("user_id").alias("listing"), F.concat(F.lit("g"), (F.col("user_id") % 40).cast("string")).alias("grp")).distinct()
    return review.resolved(rows, states, "grp", stamps)


@query(f"""WITH {_A}, b AS (SELECT *, min(starred_at) OVER (PARTITION BY grp) AS first FROM a) SELECT listing, grp, read_at, CASE WHEN grp IN ('g1', 'g2') THEN coalesce(first, TIMESTAMP '2024-03-01') ELSE starred_at END AS starred_at, CASE WHEN grp = 'g3' THEN NULL ELSE read_at END AS unread_at FROM b""")
def state_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = review.changed_state(_anchors(spark, d), "grp", F.col("grp").isin("g1", "g2"), "starred_at", F.lit("2024-03-01").cast("timestamp_ntz"))
    return review.changed_state(rows.withColumn("unread_at", F.col("read_at")), "grp", F.col("grp") == "g3", "unread_at", None)


@query(f"""WITH {_L}, c AS (SELECT *, min((board, market, id)) OVER (PARTITION BY canonical_job_id) AS first, row_number() OVER (PARTITION BY canonical_job_id, board, market ORDER BY seen DESC, id DESC) AS r FROM l WHERE canonical_job_id IS NOT NULL)
SELECT id, CASE WHEN (board, market, id) = first THEN 'this' WHEN r = 1 THEN 'other' ELSE 'earlier' END AS copy_kind FROM c""")
def listing_copies(spark: SparkSession, d: str) -> DataFrame:
    rows = listings(spark, d).where("canonical_job_id is not null")
    return review.copies(rows, "canonical_job_id", ["board", "market", "id"], ["listing_first_seen_at", "id"]).select("id", "copy_kind")


@query(f"""WITH {_L}, w AS (SELECT unnest(['3', '7', '14', '28', 'all']) AS days) SELECT advertiser_name, days, count(*) FILTER (WHERE recent AND coalesce(bucket IN ('top_picks', 'in_lane', 'less_interested'), false)) AS in_scope, count(*) FILTER (WHERE recent AND NOT coalesce(bucket IN ('top_picks', 'in_lane', 'less_interested'), false)) AS others
FROM (SELECT *, days = 'all' OR seen >= TIMESTAMP '2001-07-20' - to_days(CASE WHEN days = 'all' THEN 0 ELSE days::INT END) AS recent FROM l, w) GROUP BY 1, 2""")
def advertiser_windows(spark: SparkSession, d: str) -> DataFrame:
    return review.advertiser_windows(listings(spark, d), "advertiser_name", "listing_first_seen_at", F.lit("2001-07-20").cast("timestamp_ntz"))


@query(f"""WITH {_L}, r AS (SELECT * FROM l WHERE seen >= TIMESTAMP '2001-07-31' - INTERVAL 120 DAY) SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.hiring_company_name[-1:] = b.hiring_company_name[-1:] AND a.advertiser_name = b.advertiser_name AND lower(a.title) = lower(b.title) AND a.board < b.board AND (a.canonical_job_id IS NULL OR b.canonical_job_id IS NULL OR a.canonical_job_id <> b.canonical_job_id)""")
def possible_repeats(spark: SparkSession, d: str) -> DataFrame:
    rows = listings(spark, d).withColumn("employer", F.substring("hiring_company_name", -1, 1))
    return review.possible_repeats(rows, ["employer", "advertiser_name"], F.lit("2001-07-31").cast("timestamp_ntz"), 120)


_J = "j AS (SELECT *, CASE WHEN price > 450000 THEN seen END AS saved_at, CASE WHEN price > 480000 THEN seen END AS starred_at, CASE WHEN id % 9 = 0 THEN id - 1 END AS repeat_of_id FROM l)"


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    seen = F.col("listing_first_seen_at")
    return listings(spark, d).withColumns({"saved_to_apply_at": F.when(F.col("price") > 450000, seen), "starred_at": F.when(F.col("price") > 480000, seen), "repeat_of_id": F.when(F.col("id") % 9 == 0, F.col("id") - 1), "wording_first_seen_at": seen})


_RANK = "CASE bucket WHEN 'top_picks' THEN 0 WHEN 'in_lane' THEN 1 WHEN 'less_interested' THEN 2 ELSE 3 END"


@query(f"""WITH {_L}, {_J} SELECT row_number() OVER (ORDER BY starred_at IS NULL, {_RANK}, saved_at DESC, id DESC) AS place, id FROM j WHERE saved_at IS NOT NULL AND is_recruitment_firm IS FALSE""")
def saved_jobs(spark: SparkSession, d: str) -> DataFrame:
    return review.saved_jobs(_jobs(spark, d), posted_by="employer")


@query(f"""WITH {_L}, {_J}, o AS (SELECT *, row_number() OVER (PARTITION BY canonical_job_id ORDER BY repeat_of_id IS NOT NULL, {_RANK}, seen DESC, id DESC) AS r FROM j WHERE saved_at IS NOT NULL AND canonical_job_id IS NOT NULL) SELECT row_number() OVER (ORDER BY starred_at IS NULL, {_RANK}, saved_at, id) AS place, canonical_job_id, id FROM o WHERE r = 1""")
def saved_in_list_order(spark: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(spark, d).where("saved_to_apply_at is not null and canonical_job_id is not null")
    return review.saved_in_list_order(jobs, "canonical_job_id", review.IN_SCOPE)


@query(f"""WITH {_L}, g AS (SELECT canonical_job_id, min(bucket) AS bucket, max(seen) AS seen, count(DISTINCT board) AS boards FROM l WHERE canonical_job_id IS NOT NULL GROUP BY 1), h AS (SELECT *, coalesce(bucket IN ('in_lane', 'top_picks'), false) AS hot, seen >= TIMESTAMP '2001-07-20' AS new FROM g)
SELECT count(*) FILTER (WHERE hot AND new) AS p0_groups, coalesce(sum(boards) FILTER (WHERE hot AND new), 0)::BIGINT AS p0_listings, count(*) FILTER (WHERE hot) AS p1_groups, coalesce(sum(boards) FILTER (WHERE hot), 0)::BIGINT AS p1_listings, count(*) AS p2_groups, sum(boards)::BIGINT AS p2_listings FROM h""")
def review_summary(spark: SparkSession, d: str) -> DataFrame:
    groups = listings(spark, d).where("canonical_job_id is not null").groupBy("canonical_job_id").agg(F.min("bucket").alias("bucket"), F.max("listing_first_seen_at").alias("listing_first_seen_at"), F.collect_set("board").alias("boards"))
    return review.summary(groups, F.lit("2001-07-20").cast("timestamp_ntz"), ["in_lane", "top_picks"])


@query(f"""WITH {_L} SELECT id, CASE WHEN bucket IN ('top_picks', 'in_lane', 'less_interested') THEN coalesce(CASE WHEN coalesce(is_recruitment_firm, false) THEN CASE WHEN board = 'mcf' THEN hiring_company_name END ELSE advertiser_name END, 'listing:' || id) ELSE 'listing:' || id END AS key FROM l""")
def company_clusters(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return listings(spark, d).select("id", review.company_key(c("bucket"), c("is_recruitment_firm"), c("board"), c("hiring_company_name"), c("advertiser_name"), c("id").cast("string")).alias("key"))


@query("""WITH g AS (SELECT l_orderkey, l_returnflag AS quote, l_linestatus AS note, min(l_linenumber) AS place, string_agg(l_shipdate::DATE::VARCHAR || '/' || l_partkey, ', ' ORDER BY l_linenumber, l_shipdate::DATE::VARCHAR || '/' || l_partkey) AS detail FROM lineitem GROUP BY 1, 2, 3) SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY place, quote, note) AS row, quote, note, detail FROM g""")
def requirement_groups(spark: SparkSession, d: str) -> DataFrame:
    detail = F.concat(F.to_date("l_shipdate").cast("string"), F.lit("/"), F.col("l_partkey").cast("string"))
    lines = read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("place"), F.col("l_returnflag").alias("quote"), F.col("l_linestatus").alias("note"), detail.alias("detail"))
    return review.requirement_rows(lines, "l_orderkey")


@query("""WITH i AS (SELECT CASE WHEN event_type = 'view' THEN 'links' ELSE 'people' END AS kind, CASE WHEN value < 10 THEN 'queued' WHEN value < 12 THEN 'searching' WHEN value > 95 THEN 'failed' ELSE 'done' END AS status FROM events), w AS (SELECT count(*) FILTER (WHERE kind = 'links') * 40.0 AS links, count(*) FILTER (WHERE kind = 'people') * 90.0 AS people FROM i WHERE status IN ('queued', 'searching'))
SELECT count(*) AS total, count(*) FILTER (WHERE status NOT IN ('queued', 'searching')) AS done, count(*) FILTER (WHERE status = 'failed') AS failed, round(count(*) FILTER (WHERE status NOT IN ('queued', 'searching')) * 100 / count(*)) AS percent, (SELECT greatest(links, people)::DOUBLE FROM w) AS left FROM i""")
def search_progress(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("value") < 10, "queued").when(F.col("value") < 12, "searching").when(F.col("value") > 95, "failed").otherwise("done")
    items = read(spark, d, "events").select(F.when(F.col("event_type") == "view", "links").otherwise("people").alias("kind"), status.alias("status"))
    return review.progress(items, {"links": 40.0, "people": 90.0})


@query(f"""WITH {_L}, {_J}, mine AS (SELECT advertiser_name, id, canonical_job_id FROM j WHERE saved_at IS NOT NULL AND canonical_job_id IS NOT NULL) SELECT s.id AS selected, m.id, m.canonical_job_id IS NOT DISTINCT FROM s.canonical_job_id AS this_job FROM l s JOIN mine m USING (advertiser_name) WHERE s.price > 495000""")
def advertiser_history(spark: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(spark, d)
    mine = jobs.where("saved_to_apply_at is not null and canonical_job_id is not null").select("advertiser_name", "id", "canonical_job_id")
    chosen = jobs.where("price > 495000").select(F.col("id").alias("selected"), "advertiser_name", F.col("canonical_job_id").alias("own"))
    return review.advertiser_history(chosen, mine)
