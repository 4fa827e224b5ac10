"""The nightly extract and collection runs: events stand for observations, each in a run of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import collection, extract, reports
from ..sources.tables import read
from .registry import query

_MARK = "2024-01-20 00:00:00"
_RUNS = "runs AS (SELECT event_id AS run_id, ts AS started_at, CASE WHEN value >= 5 THEN ts + to_hours(floor(value)::INT) END AS finished_at FROM events)"
_OBS = "obs AS (SELECT event_id AS run_id, event_type AS board, user_id % 50 AS job, 't' || floor(value / 20)::INT AS title, CASE WHEN user_id % 3 > 0 THEN 'a' || user_id % 3 END AS advertiser, CASE WHEN event_type <> 'error' OR value > 40 THEN 'h' END AS content_hash, CASE WHEN value >= 10 THEN 'f' || floor(value / 20)::INT END AS fingerprint FROM events)"


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _runs(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("value") >= 5, F.expr("timestampadd(HOUR, cast(floor(value) as int), ts)"))
    return read(spark, d, "events").select(F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), end.alias("finished_at"))


def _observations(spark: SparkSession, d: str) -> DataFrame:
    band = F.floor(F.col("value") / 20).cast("int").cast("string")
    return read(spark, d, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("board"), (F.col("user_id") % 50).alias("job"), F.concat(F.lit("t"), band).alias("title"), F.when(F.col("user_id") % 3 > 0, F.concat(F.lit("a"), F.col("user_id") % 3)).alias("advertiser"),
        F.when((F.col("event_type") != "error") | (F.col("value") > 40), "h").alias("content_hash"), F.when(F.col("value") >= 10, F.concat(F.lit("f"), band)).alias("fingerprint"),
    )


@query(f"""WITH {_RUNS}, {_OBS}, seen AS (SELECT * FROM obs JOIN runs USING (run_id)), l AS (SELECT board, job, min(started_at) AS listing_first_seen_at FROM seen GROUP BY ALL),
w AS (SELECT *, sha256('["' || title || '","' || coalesce(advertiser, '') || '"]') AS wkey FROM seen WHERE content_hash IS NOT NULL AND (started_at >= TIMESTAMP '{_MARK}' OR (started_at < TIMESTAMP '{_MARK}' AND (finished_at IS NULL OR finished_at >= TIMESTAMP '{_MARK}')))),
a AS (SELECT board, job, wkey, min(started_at) AS wording_first_seen_at, max(started_at) AS wording_last_seen_at, max(run_id) FILTER (WHERE (started_at, run_id) = (m_at, m_run)) AS latest_run_id, arg_max(fingerprint, (started_at, run_id)) FILTER (WHERE fingerprint IS NOT NULL) AS fingerprint
  FROM (SELECT *, max(started_at) OVER (PARTITION BY board, job, wkey) AS m_at, arg_max(run_id, (started_at, run_id)) OVER (PARTITION BY board, job, wkey) AS m_run FROM w) GROUP BY ALL)
SELECT a.board, a.job, a.wkey, w.title, w.advertiser, a.latest_run_id, a.fingerprint, l.listing_first_seen_at, a.wording_first_seen_at, a.wording_last_seen_at FROM a JOIN l USING (board, job) JOIN w ON w.board = a.board AND w.job = a.job AND w.wkey = a.wkey AND w.run_id = a.latest_run_id""")
def wording_extract(spark: SparkSession, d: str) -> DataFrame:
    return extract.wordings(_observations(spark, d), _runs(spark, d), _at(_MARK), ["board", "job"], ["title", "advertiser"])


@query(f"""WITH {_RUNS} SELECT run_id, started_at < TIMESTAMP '{_MARK}' AS late FROM runs WHERE started_at >= TIMESTAMP '{_MARK}' OR finished_at IS NULL OR finished_at >= TIMESTAMP '{_MARK}'""")
def late_finishers(spark: SparkSession, d: str) -> DataFrame:
    mark = extract.high_water(read(spark, d, "events").where(F.col("ts") < _at(_MARK)).select(_at(_MARK).alias("seen")), "seen")
    return _runs(spark, d).crossJoin(F.broadcast(mark)).where(extract.since(F.col("mark"))).select("run_id", (F.col("started_at") < F.col("mark")).alias("late"))


@query("""WITH s AS (SELECT p_brand, sum(octet_length(encode('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_size":' || p_size || '}')))::BIGINT AS size FROM part GROUP BY 1) SELECT p_brand, size, greatest(1, ceil(size / 1000))::BIGINT AS buckets FROM s""")
def read_plan(spark: SparkSession, d: str) -> DataFrame:
    return extract.read_plan(read(spark, d, "part").select("p_brand", "p_name", "p_size"), ["p_brand"], 1000)


@query("""SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids, sum(o_custkey)::BIGINT AS total FROM orders""")
def bucketed_scan(spark: SparkSession, d: str) -> DataFrame:
    """All buckets together are the table: one of two, and the halves of the other."""
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    parts = [extract.bucket(rows, "o_orderkey", n, k) for n, k in ((2, 0), *extract.halves(2, 1))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("ids"), F.sum("o_custkey").alias("total"))


_STATE = "CASE WHEN value < 30 THEN 'new' WHEN value < 50 THEN 'changed' WHEN value < 60 THEN 'unresolved' ELSE 'unchanged' END"
_OUTCOME = "CASE WHEN value < 60 THEN CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'failed' WHEN event_type = 'signup' AND value < 2 THEN 'deferred' ELSE 'fetched' END END"


@query(f"""WITH s AS (SELECT user_id, {_STATE} AS state, {_OUTCOME} AS outcome FROM events), n AS (SELECT user_id, count(*) AS unique_seen, count(*) FILTER (WHERE state = 'new') AS new_jobs, count(*) FILTER (WHERE state = 'changed') AS changed_jobs,
count(*) FILTER (WHERE outcome IN ('fetched', 'failed')) AS jds_intended, count(*) FILTER (WHERE outcome = 'fetched') AS jds_fetched, count(*) FILTER (WHERE outcome = 'failed') AS fetch_failures, count(*) FILTER (WHERE outcome = 'deferred') AS backlog_remaining FROM s GROUP BY 1)
SELECT *, CASE WHEN fetch_failures > 0 OR backlog_remaining > 0 THEN 'partial' ELSE 'ok' END AS status, jds_intended >= 20 AND fetch_failures > 0.30 * jds_intended AS broken FROM n""")
def collection_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("user_id", F.expr(_STATE).alias("state"), F.expr(_OUTCOME).alias("outcome"))
    return collection.counters(rows, "user_id", F.col("state"), F.col("outcome"))


@query("""WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'partial' ELSE CASE WHEN o_custkey % 2 = 0 THEN 'failed' ELSE 'running' END END AS status, ['mcf', 'seek', 'other'][(o_custkey % 3 + 1)::INT] AS board, o_custkey % 10 AS swept, o_orderkey % 10 AS succeeded, o_custkey % 4 <> 0 AS full_sweep FROM orders)
SELECT o_orderkey, status IN ('failed', 'running') OR (status = 'partial' AND (succeeded < swept OR (board <> 'other' AND NOT full_sweep))) AS problem FROM r""")
def collection_problems(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "partial").when(key % 2 == 0, "failed").otherwise("running")
    board = F.element_at(F.array(*map(F.lit, ("mcf", "seek", "other"))), (key % 3 + 1).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", collection.problem(status, board, key % 10, F.col("o_orderkey") % 10, key % 4 != 0).alias("problem"))


@query("""WITH r AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS canary FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN canary = 0 THEN 'a canary term found nothing' WHEN failed > 0.30 * n THEN 'too many terms failed' WHEN n > 14 THEN 'above the ceiling' WHEN n < 8 THEN 'below the floor' END AS why FROM r""")
def plausible_sweeps(spark: SparkSession, d: str) -> DataFrame:
    per = read(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"), F.count_if(F.col("o_orderpriority").like("1%")).alias("canary"))
    return per.select("o_custkey", collection.implausible(F.col("n"), F.lit(8), F.lit(14), F.col("canary"), F.col("failed"), F.col("n")).alias("why"))


@query("""SELECT p_partkey, p_size || '|' || sha256('{"brand":"' || p_brand || '","kind":' || CASE WHEN p_size % 4 = 0 THEN 'null' ELSE '"' || p_type || '"' END || ',"name":"' || p_name || '"}') AS signal FROM part""")
def card_signals(spark: SparkSession, d: str) -> DataFrame:
    fields = {"name": F.col("p_name"), "kind": F.when(F.col("p_size") % 4 != 0, F.col("p_type")), "brand": F.col("p_brand")}
    return read(spark, d, "part").select("p_partkey", collection.card_signal(F.col("p_size").cast("string"), fields).alias("signal"))


@query("""WITH h AS (SELECT event_type AS term, user_id AS page, event_id AS spot, user_id % 40 AS job, floor(value)::BIGINT AS signal FROM events) SELECT job::VARCHAR AS board_job_id, arg_min(signal, (term, page, spot)) AS signal, min(term) AS term FROM h GROUP BY job""")
def first_sightings(spark: SparkSession, d: str) -> DataFrame:
    hit = F.struct("event_id", F.struct((F.col("user_id") % 40).cast("string").alias("id"), F.floor("value").alias("signal")).alias("h"))
    pages = read(spark, d, "events").groupBy("event_type", "user_id").agg(F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["h"]).alias("hits"))
    return collection.first_sightings(pages, "event_type", "user_id", "hits")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type <> 'error') WHERE r = 1""")
def last_encountered(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").where("event_type <> 'error'").select("user_id", "ts", "event_id", "value")
    return collection.chosen_rows(rows, "user_id", ["ts", "event_id"], last=True).select("user_id", "event_id", "value")


_URL = "CASE s_suppkey % 5 WHEN 0 THEN 'https://' || cc || '.linkedin.com/jobs/view/' || s_suppkey WHEN 1 THEN 'https://www.linkedin.com/jobs/sg.linkedin.com' WHEN 2 THEN 'https://' || cc || '.linkedin.com.example.com/x' WHEN 3 THEN NULL ELSE 'HTTPS://SG.LinkedIn.com:443/jobs?x=th.linkedin.com' END"


@query(f"""WITH s AS (SELECT *, ['sg', 'th', 'au', 'hk'][(s_nationkey % 4 + 1)::INT] AS cc FROM supplier), u AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 5 = 0 THEN cc WHEN s_suppkey % 5 = 4 THEN 'sg' END AS country FROM s)
SELECT s_suppkey, country, CASE WHEN s_nationkey = 3 THEN 'malformed' WHEN CASE WHEN country IS NOT NULL THEN country = 'sg' ELSE s_nationkey < 10 END THEN 'valid' ELSE 'rejected' END AS class FROM u""")
def collected_row_classes(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "supplier").withColumn("cc", F.element_at(F.array(*map(F.lit, ("sg", "th", "au", "hk"))), (F.col("s_nationkey") % 4 + 1).cast("int"))).withColumn("url", F.expr(_URL))
    place = F.when(F.col("s_nationkey") < 10, "Jurong, Singapore").otherwise("Bangkok")
    country = collection.country_subdomain(F.col("url"))
    market = collection.market_of(country, F.lit("sg"), place, ["singapore"])
    title = F.when(F.col("s_nationkey") == 3, " ").otherwise(F.col("s_name"))
    return rows.select("s_suppkey", country.alias("country"), collection.row_class(F.col("s_suppkey").cast("string"), r"\d+", [title, place], market).alias("class"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'closed' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 1.5 ELSE o_totalprice END AS o_totalprice FROM orders""")
def run_updates(spark: SparkSession, d: str) -> DataFrame:
    runs = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ends = runs.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("closed").alias("o_orderstatus"), F.when(F.col("o_orderkey") % 6 == 0, " ").otherwise("1.5").alias("o_totalprice"))
    return collection.finished(runs, ends, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""WITH r AS (SELECT event_type AS board, 'm' || user_id AS market, min(ts) AS a, CASE WHEN count(*) > 5 THEN max(ts) END AS b, CASE WHEN count(*) > 5 THEN 'ok' ELSE 'running' END AS status FROM events WHERE event_type <> 'view' OR user_id % 2 = 0 GROUP BY 1, 2),
i AS (SELECT DISTINCT event_type AS board, 'm' || user_id AS market FROM events), s AS (SELECT *, date_diff('microsecond', a, b) // 1000000 AS sec FROM r)
SELECT row_number() OVER (ORDER BY a, board, market)::INT AS place, board, market, status, CASE WHEN b IS NOT NULL THEN (sec // 60) || 'm' || lpad((sec % 60)::VARCHAR, 2, '0') || 's' END AS runtime FROM s UNION ALL SELECT NULL, board, market, 'missing', NULL FROM i ANTI JOIN r USING (board, market)""")
def execution_summary(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events").select(F.col("event_type").alias("board"), F.concat(F.lit("m"), "user_id").alias("market"), "ts", "user_id")
    many = F.count("*") > 5
    runs = events.where("board <> 'view' or user_id % 2 = 0").groupBy("board", "market").agg(F.min("ts").alias("started_at"), F.when(many, F.max("ts")).alias("finished_at"), F.when(many, "ok").otherwise("running").alias("status"))
    return collection.execution(runs, events.select("board", "market").distinct())


@query("""SELECT round(avg(date_diff('microsecond', a, b)) / 1e6, 3) AS seconds FROM (SELECT user_id, min(ts) AS a, CASE WHEN user_id % 4 > 0 THEN max(ts) END AS b FROM events GROUP BY user_id ORDER BY b DESC NULLS LAST, user_id LIMIT 10) WHERE b IS NOT NULL""")
def recent_search_seconds(spark: SparkSession, d: str) -> DataFrame:
    searches = read(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"))
    searches = searches.withColumn("finished_at", F.when(F.col("id") % 4 > 0, F.col("finished_at")))
    return reports.average_seconds(searches, 10).select(F.round("seconds", 3).alias("seconds"))


@query("""SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-19 16:00:00'""")
def searches_since_midnight(spark: SparkSession, d: str) -> DataFrame:
    return reports.searches_since(read(spark, d, "events").withColumnRenamed("ts", "requested_at"), reports.midnight(_at("2024-01-20 10:30:00")))


@query("""SELECT o_custkey, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0)::DOUBLE AS credits FROM orders GROUP BY 1""")
def credits_used(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("credits"))
    return reports.credits(rows, "o_custkey").select("o_custkey", F.col("credits").cast("double").alias("credits"))


@query("""SELECT row_number() OVER (ORDER BY ts, event_id) AS place, event_id AS id FROM events WHERE event_type = 'error' AND value < 5""")
def runs_without_cost(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    rows = read(spark, d, "events").where("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("ts").alias("started_at"), F.when(F.col("value") >= 5, F.col("value")).alias("cost_usd"))
    return reports.without_cost(rows).select(F.row_number().over(W.orderBy("started_at", "id")).alias("place"), "id")


@query("""WITH s AS (SELECT event_id AS search_id, user_id, ts, CASE WHEN value < 60 THEN 'done' ELSE 'failed' END AS status FROM events WHERE event_type = 'click'), g AS (SELECT user_id % 20 AS grp, s.* FROM s WHERE status = 'done'), l AS (SELECT grp, arg_max(search_id, (ts, search_id)) AS search_id FROM g GROUP BY grp)
SELECT grp, search_id, l_orderkey, l_linenumber FROM l JOIN lineitem ON l_orderkey = search_id""")
def latest_search_rows(spark: SparkSession, d: str) -> DataFrame:
    searches = read(spark, d, "events").where("event_type = 'click'").select(F.col("event_id").alias("search_id"), "user_id", F.col("ts").alias("requested_at"), F.when(F.col("value") < 60, "done").otherwise("failed").alias("status"))
    anchors = searches.select("user_id", (F.col("user_id") % 20).alias("grp")).distinct()
    latest = reports.latest_of_group(searches, anchors, "grp", ["user_id"], F.col("status") == "done")
    found = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("search_id"), "l_orderkey", "l_linenumber")
    return reports.found_rows(found, latest, "grp", "search_id").select("grp", "search_id", "l_orderkey", "l_linenumber")


@query("""WITH r AS (SELECT l_returnflag AS stage, sum(l_extendedprice) AS cost, sum(l_quantity::BIGINT) AS cached, sum(l_linenumber::BIGINT * 10) AS input FROM lineitem GROUP BY 1) SELECT stage, round(cost, 2) AS cost_usd, CASE WHEN cached + input > 0 THEN round_even(100.0 * cached / (cached + input), 0)::BIGINT END AS cached FROM r""")
def token_shares(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_extendedprice").alias("cost_usd"), F.col("l_quantity").cast("long").alias("cached_tokens"), (F.col("l_linenumber") * 10).cast("long").alias("input_tokens"))
    return reports.cached_share(rows, "stage").select("stage", F.round("cost_usd", 2).alias("cost_usd"), "cached")


_SAID = "CASE event_id % 7 WHEN 0 THEN 'Gemini batch failed' WHEN 1 THEN 'HTTP 503 from /api/2.0/sql' WHEN 2 THEN NULL WHEN 3 THEN 'review login' WHEN 4 THEN 'google HTTP status 429' WHEN 5 THEN 'provider items still failed: 12' ELSE 'disk is full' END"


@query(f"""WITH e AS (SELECT event_id, {_SAID} AS said FROM events) SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'Gemini Batch job failed' WHEN 1 THEN 'Databricks unavailable' WHEN 2 THEN '—' WHEN 3 THEN 'Review refresh failed' WHEN 4 THEN 'Gemini request failed' WHEN 5 THEN 'Gemini refused JDs' ELSE 'Step failed' END AS title FROM e""")
def error_titles(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", reports.error_title(F.expr(_SAID)).alias("title"))


@query("""SELECT user_id AS id, CASE event_type WHEN 'error' THEN 'Triage' ELSE 'Extraction' END AS stage, event_id AS attempts, CASE WHEN event_id % 2 = 0 THEN 'Bad answer. Detailed diagnostics are saved privately.' ELSE 'see batches? ' || repeat('x', 207) || '…' END AS reason FROM events WHERE event_type IN ('error', 'view') AND value > 80
UNION ALL SELECT user_id + 1000, CASE event_type WHEN 'error' THEN 'Triage' ELSE 'Extraction' END, event_id, CASE WHEN event_id % 2 = 0 THEN 'Bad answer. Detailed diagnostics are saved privately.' ELSE 'see batches? ' || repeat('x', 207) || '…' END FROM events WHERE event_type IN ('error', 'view') AND value > 80""")
def failure_rows(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("event_id") % 2 == 0, F.lit('Bad answer: {"a": [1, 2]}')).otherwise(F.concat(F.lit("see \n batches?  "), F.repeat(F.lit("x"), F.lit(300))))
    items = read(spark, d, "events").where("event_type in ('error', 'view')").select(
        F.when(F.col("event_type") == "error", "triage").otherwise("extraction").alias("stage"), F.when(F.col("value") > 80, "terminal").otherwise("valid").alias("outcome"),
        F.array("user_id", F.col("user_id") + 1000).alias("ids"), F.col("event_id").alias("attempts"), said.alias("correction"),
    )
    return reports.failures(items)


@query("""WITH o AS (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2001-08-02') AS days FROM orders) SELECT o_orderkey, CASE WHEN days <= 0 THEN 'today' WHEN days = 1 THEN '1 day ago' WHEN days < 14 THEN days || ' days ago' WHEN days < 60 THEN round_even(days / 7, 0)::INT || ' weeks ago' ELSE round_even(days / 30, 0)::INT || ' months ago' END AS age,
CASE WHEN days <= 0 THEN 'today' WHEN days = 1 THEN 'yesterday' ELSE days || ' days ago' END AS seen FROM o""")
def age_words(spark: SparkSession, d: str) -> DataFrame:
    days = F.datediff(F.lit("2001-08-02").cast("date"), F.to_date("o_orderdate"))
    return read(spark, d, "orders").select("o_orderkey", reports.age_words(days).alias("age"), reports.seen_words(days).alias("seen"))


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'Negotiable' END AS raw, CASE WHEN o_custkey % 3 > 0 THEN floor(o_totalprice) + CASE WHEN o_custkey % 5 = 0 THEN 0.5 ELSE 0 END END AS low, CASE WHEN o_custkey % 4 > 0 THEN floor(o_totalprice) * CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 1 END END AS high FROM orders),
f AS (SELECT *, regexp_replace(format('{:,.2f}', low), '\\.?0+$', '') AS l, regexp_replace(format('{:,.2f}', high), '\\.?0+$', '') AS h FROM o)
SELECT o_orderkey, CASE WHEN raw IS NOT NULL THEN raw WHEN low IS NULL AND high IS NULL THEN 'Not supplied' ELSE CASE WHEN high IS NULL THEN 'From ' WHEN low IS NULL THEN 'Up to ' ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN 'SGD ' ELSE 'Currency not supplied ' END || CASE WHEN low IS NULL THEN h ELSE l || CASE WHEN high IS NOT NULL AND high <> low THEN ' – ' || h ELSE '' END END || CASE WHEN o_orderkey % 3 = 0 THEN ' Monthly' ELSE '' END END AS label FROM f""")
def salary_displays(spark: SparkSession, d: str) -> DataFrame:
    k, price = F.col("o_custkey"), F.floor("o_totalprice").cast("double")
    low = F.when(k % 3 > 0, price + F.when(k % 5 == 0, 0.5).otherwise(0.0))
    high = F.when(k % 4 > 0, price * F.when(k % 2 == 0, 2.0).otherwise(1.0))
    raw, code, period = F.when(F.col("o_orderkey") % 7 == 0, "Negotiable"), F.when(F.col("o_orderkey") % 2 == 0, "SGD"), F.when(F.col("o_orderkey") % 3 == 0, "Monthly")
    return read(spark, d, "orders").select("o_orderkey", reports.salary_label(raw, low, high, code, period).alias("label"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN s_name || ' came back partial' || CASE WHEN s_suppkey % 3 = 0 THEN '.' ELSE ': ' || format('{:,}', s_suppkey * 97) || ' JD fetch' || CASE WHEN s_suppkey * 97 <> 1 THEN 'es' ELSE '' END || ' failed.' END ELSE s_name || ' failed.' END AS line FROM supplier WHERE s_suppkey > 0""")
def source_lines(spark: SparkSession, d: str) -> DataFrame:
    failed = F.when(F.col("s_suppkey") % 3 == 0, 0).otherwise(F.col("s_suppkey") * 97)
    status = F.when(F.col("s_nationkey") % 2 == 0, "partial").otherwise("failed")
    return read(spark, d, "supplier").where("s_suppkey > 0").select("s_suppkey", reports.source_line(F.col("s_name"), status, failed).alias("line"))
