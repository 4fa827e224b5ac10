"""Histories of events: users stand for listings, event types for wordings, ts and event_id for chronology."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import history, merge
from ..sources import json
from ..sources.tables import read
from .registry import query

SPLIT = "2024-01-20 00:00:00"


def split() -> F.Column:
    return F.lit(SPLIT).cast("timestamp_ntz")


@query("""SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(value, (ts, event_id)) AS latest_value FROM events GROUP BY ALL""")
def membership_first_seen_latest(spark: SparkSession, d: str) -> DataFrame:
    return history.memberships(read(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id", "value")


@query("""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def representative_latest(spark: SparkSession, d: str) -> DataFrame:
    return history.representative(read(spark, d, "events"), "user_id", "ts", "event_id", ["event_id", "event_type", "value"])


@query("""WITH e AS (SELECT *, ts::DATE AS day FROM events), m AS (SELECT user_id, max(day) AS day FROM e GROUP BY user_id) SELECT user_id, count(DISTINCT event_type) AS n FROM e JOIN m USING (user_id, day) GROUP BY user_id HAVING count(DISTINCT event_type) > 1""")
def ambiguous_representatives(spark: SparkSession, d: str) -> DataFrame:
    return history.ambiguous(read(spark, d, "events").withColumn("day", F.to_date("ts")), "user_id", "day", ["event_type"])


@query("""SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) FILTER (WHERE event_type <> 'error') = 0""")
def never_usable_entities(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    return history.never(rows, ["user_id", "day"], F.col("event_type") != "error")


@query("""SELECT DISTINCT user_id, least(event_type, before) AS lo, greatest(event_type, before) AS hi FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE event_type <> 'error') WHERE before <> event_type""")
def wording_transitions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    return history.transitions(rows, ["user_id"], "ts", "event_id", "event_type")


@query(f"""WITH t AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE ts < TIMESTAMP '{SPLIT}')
SELECT user_id, least(event_type, before) AS lo, greatest(event_type, before) AS hi FROM t WHERE before <> event_type EXCEPT SELECT user_id, least(event_type, before), greatest(event_type, before) FROM p WHERE before <> event_type""")
def new_transitions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events")
    now, then = (history.transitions(x, ["user_id"], "ts", "event_id", "event_type") for x in (rows, rows.where(F.col("ts") < split())))
    return now.subtract(then)


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type <> 'error') AS current_event_type FROM events GROUP BY user_id""")
def current_assignment(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    return history.current_assignment(rows, "user_id", "ts", "event_id", "event_type")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY substr(ts::VARCHAR, 1, 10) DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def prior_state_latest(spark: SparkSession, d: str) -> DataFrame:
    order = [F.date_format("ts", "yyyy-MM-dd").desc(), F.desc("event_id")]
    return history.latest(read(spark, d, "events"), ["user_id", "event_type"], order).select("user_id", "event_type", "event_id", "value")


_LAST = "SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events WHERE ts {} TIMESTAMP '" + SPLIT + "' GROUP BY ALL"


@query(f"""WITH p AS (SELECT user_id, event_type, CASE WHEN event_type <> 'view' THEN value END AS value FROM ({_LAST.format('<')})), n AS ({_LAST.format('>=')})
SELECT n.user_id, n.event_type, CASE WHEN p.user_id IS NULL THEN 'new' WHEN p.value IS NULL THEN 'unresolved' WHEN p.value <> n.value THEN 'changed' ELSE 'unchanged' END AS state FROM n LEFT JOIN p USING (user_id, event_type)""")
def change_diff_states(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events")
    last = lambda x: x.groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    prior = last(rows.where(F.col("ts") < split())).withColumn("value", F.when(F.col("event_type") != "view", F.col("value")))
    return merge.diff_states(prior, last(rows.where(F.col("ts") >= split())), ["user_id", "event_type"], "value")


@query(f"""SELECT event_id, user_id FROM events e JOIN (SELECT user_id, max(ts) AS m FROM events WHERE event_id % 3 <> 0 AND ts < TIMESTAMP '{SPLIT}' GROUP BY 1) USING (user_id) WHERE event_id % 3 = 0 AND (ts, event_id) <= (m, (SELECT max(x.event_id) FROM events x WHERE x.user_id = e.user_id AND x.ts = m AND x.event_id % 3 <> 0))""")
def out_of_order_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events")
    return merge.out_of_order(rows.where((F.col("event_id") % 3 != 0) & (F.col("ts") < split())), rows.where(F.col("event_id") % 3 == 0), "user_id", ["ts", "event_id"], "event_id")


@query(f"""WITH rows_ AS (SELECT *, 0 AS s FROM events WHERE ts < TIMESTAMP '{SPLIT}' UNION ALL SELECT *, 1 AS s FROM events WHERE ts >= TIMESTAMP '2024-01-15')
SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(value, (ts, event_id, s)) AS value, arg_max(props, (ts, event_id, s)) FILTER (WHERE props IS NOT NULL) AS props FROM rows_ GROUP BY ALL""")
def keyed_upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("stamp", F.struct("ts", "event_id")).withColumn("first_seen", F.col("ts")).withColumn("last_seen", F.col("ts"))
    old, new = rows.where(F.col("ts") < split()), rows.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return merge.upsert(old, new, ["user_id", "event_type"], ["first_seen"], ["last_seen"], "stamp", ["value"], ["props"])


@query("""WITH n AS (SELECT (ts + INTERVAL 5 HOUR)::DATE AS night, event_type, user_id FROM events) SELECT night, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM n GROUP BY ALL""")
def night_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("night", dates.night(F.col("ts")))
    return rows.groupBy("night", "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("""WITH n AS (SELECT DISTINCT user_id, (ts + INTERVAL 5 HOUR)::DATE AS night FROM events), f AS (SELECT user_id, min(night) AS night FROM n GROUP BY 1)
SELECT night, count(*) AS new_users FROM f GROUP BY 1""")
def new_per_night(spark: SparkSession, d: str) -> DataFrame:
    first = read(spark, d, "events").groupBy("user_id").agg(F.min(dates.night(F.col("ts"))).alias("night"))
    return first.groupBy("night").agg(F.count("*").alias("new_users"))


@query("""WITH f AS (SELECT event_id, user_id, event_type, (ts + INTERVAL 5 HOUR)::DATE AS night, floor(value)::BIGINT AS k FROM events)
SELECT a.event_id, (SELECT arg_min(b.event_id, (b.night, b.event_id)) FROM f b WHERE b.event_type = a.event_type AND b.k = a.k AND b.user_id <> a.user_id AND b.night >= a.night - 30 AND b.night < a.night) AS repeat_of FROM f a""")
def repeat_lookback(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", "user_id", "event_type", dates.night(F.col("ts")).alias("night"), F.floor("value").alias("k"))
    return history.earlier_copy(rows, "event_id", ["event_type", "k"], "night", "user_id", 30)


@query("""WITH n AS (SELECT *, (ts + INTERVAL 5 HOUR)::DATE AS night FROM events), w AS (SELECT list_sort(list(DISTINCT night), 'DESC')[3] AS since FROM n) SELECT event_id, user_id, night FROM n, w WHERE night >= since""")
def published_nights_window(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", "user_id", dates.night(F.col("ts")).alias("night"))
    since = rows.select("night").distinct().agg(dates.published(F.collect_set("night"), 2).alias("since"))
    return rows.join(F.broadcast(since), F.col("night") >= F.col("since")).drop("since")


@query("""WITH j AS (SELECT event_id, user_id, (props::JSON->>'k')::BIGINT AS k, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[' || props || ']' WHEN 2 THEN (props::JSON->>'k') ELSE '"' || event_type || '"' END AS value FROM events) SELECT event_id, user_id, k, CASE json_type(value::JSON) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' ELSE 'number' END AS kind FROM j""")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k long", json.STRICT)["k"]
    value = F.when(F.col("event_id") % 4 == 0, F.col("props")).when(F.col("event_id") % 4 == 1, F.concat(F.lit("["), "props", F.lit("]"))).when(F.col("event_id") % 4 == 2, k.cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    return read(spark, d, "events").select("event_id", "user_id", k.alias("k"), json.kind(value).alias("kind"))


@query("""SELECT conv_id, turn, role, lag(role) OVER w AS previous_role, lag(text) OVER w IS NOT DISTINCT FROM text AS repeats, count(*) OVER (PARTITION BY conv_id) AS turns FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def conversation_previous_turn(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    one = W.partitionBy("conv_id")
    order = one.orderBy("turn")
    return read(spark, d, "conversations").select("conv_id", "turn", "role", F.lag("role").over(order).alias("previous_role"), F.lag("text").over(order).eqNullSafe(F.col("text")).alias("repeats"), F.count("*").over(one).alias("turns"))
