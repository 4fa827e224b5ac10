"""Keyed writes, queues, estimates and state over events, orders, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names, rules, titles
from ..operators import budget, history, merge
from ..sources.tables import read
from .registry import query


@query("""SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS deviation, quantile_disc(l_quantity, 0.9) AS at_share FROM lineitem""")
def estimate_stats(spark: SparkSession, d: str) -> DataFrame:
    got = budget.estimate(read(spark, d, "lineitem"), "l_quantity", 0.9)
    return got.select("n", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"), "at_share")


@query("""WITH s AS (SELECT o_orderkey, o_custkey, sum(o_totalprice) OVER w > 400000 OR sum(1) OVER w > 5 AS over FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)) SELECT o_orderkey, o_custkey FROM s WHERE NOT over""")
def budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").withColumn("one", F.lit(1))
    return budget.prefix_within(rows, [F.asc("o_orderdate"), F.asc("o_orderkey")], {"o_totalprice": 400000, "one": 5}, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("""SELECT user_id, CASE WHEN bool_or(event_type = 'purchase' AND value > 95) THEN 'valid' WHEN count(*) >= 60 THEN 'terminal' ELSE 'retry' END AS outcome FROM events GROUP BY user_id""")
def attempt_outcomes(spark: SparkSession, d: str) -> DataFrame:
    status = F.when((F.col("event_type") == "purchase") & (F.col("value") > 95), "valid").otherwise("invalid")
    return budget.outcomes(read(spark, d, "events").withColumn("status", status), "user_id", 60)


@query("""WITH l AS (SELECT o_custkey, max(o_orderdate) AS m, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY 1), b AS (SELECT l.*, ['mcf', 'seek', 'linkedin'][(o_custkey % 3 + 1)::INT] AS board, (CASE WHEN m < TIMESTAMP '1998-01-01' THEN 2 ELSE 0 END) AS later FROM l)
SELECT o_custkey, CASE WHEN board = 'linkedin' THEN NULL WHEN later >= 2 OR s = 'F' THEN true WHEN s = 'O' THEN false END AS closed FROM b""")
def closure_flags(spark: SparkSession, d: str) -> DataFrame:
    last = read(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("m"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"))
    board = F.element_at(F.array(*map(F.lit, ("mcf", "seek", "linkedin"))), (F.col("o_custkey") % 3 + 1).cast("int"))
    status = F.when(F.col("s") == "F", "closed").when(F.col("s") == "O", "open")
    later = F.when(F.col("m") < F.lit("1998-01-01").cast("timestamp_ntz"), 2).otherwise(0)
    return last.select("o_custkey", rules.closed(board, status, later).alias("closed"))


@query(r"""SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)(^|[^a-z0-9])steel(s|es)?([^a-z0-9]|$)') THEN NULL WHEN regexp_matches(p_name, '(?i)(^|[^a-z0-9])part(s|es)?([^a-z0-9]|$)') THEN 'part' WHEN regexp_matches(p_name, '(?i)(^|[^a-z0-9])ring(s|es)?([^a-z0-9]|$)') THEN 'ring' END AS phrase FROM part""")
def title_phrase_filter(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", titles.first_phrase(F.col("p_name"), ["part", "ring"], ["steel"]).alias("phrase"))


@query(r"""SELECT s_suppkey, regexp_replace(trim(regexp_replace(regexp_replace(lower(s_name || ' Pte. Ltd.'), '[.,()]', ' ', 'g'), '\s+', ' ', 'g')), '(\s+(pte ltd|ltd|pte|co|inc))+$', '') AS key FROM supplier""")
def company_keys(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").select("s_suppkey", names.company_key(F.concat("s_name", F.lit(" Pte. Ltd."))).alias("key"))


@query("""SELECT event_type, min(ts) FILTER (WHERE value > 50) AS first_high, min(ts) FILTER (WHERE value > 90) AS first_top, list_sort(list(DISTINCT user_id)) AS members FROM events GROUP BY 1""")
def group_states(spark: SparkSession, d: str) -> DataFrame:
    first = lambda least, name: F.min(F.when(F.col("value") > least, F.col("ts"))).alias(name)
    return read(spark, d, "events").groupBy("event_type").agg(first(50, "first_high"), first(90, "first_top"), F.array_sort(F.collect_set("user_id")).alias("members"))


@query("""SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7 AND p_retailprice < 1500 UNION SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""")
def member_expansion(spark: SparkSession, d: str) -> DataFrame:
    here = read(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    anchors = read(spark, d, "part").where("p_size = 7 and p_retailprice < 1500").select(F.col("p_partkey").alias("l_partkey"))
    return read(spark, d, "lineitem").join(anchors, "l_partkey", "left_semi").select("l_suppkey").union(read(spark, d, "supplier").join(F.broadcast(here), "s_nationkey", "left_semi").select("s_suppkey")).distinct()


@query("""SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_writer_wins(spark: SparkSession, d: str) -> DataFrame:
    return history.latest(read(spark, d, "events"), ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")]).select("user_id", "event_type", "value")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS r FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS seq FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'X', o_totalprice, 1 FROM orders WHERE o_orderkey % 2 = 0)) WHERE r = 1""")
def last_writer_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").withColumn("seq", F.lit(0))
    return merge.upsert(rows.where("o_orderkey % 3 <> 0"), rows.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"], [], [], "seq", ["o_orderstatus", "o_totalprice"])


@query("""SELECT removed, count(*) FILTER (WHERE (removed = 'status' OR o_orderstatus = 'O') AND (removed = 'priority' OR o_orderpriority LIKE '1%') AND (removed = 'price' OR o_totalprice > 200000)) AS n FROM orders, (SELECT unnest(['none', 'status', 'priority', 'price']) AS removed) GROUP BY 1""")
def filter_alternatives(spark: SparkSession, d: str) -> DataFrame:
    chips = {"status": F.col("o_orderstatus") == "O", "priority": F.col("o_orderpriority").like("1%"), "price": F.col("o_totalprice") > 200000}
    counts = []
    for removed in ("none", *chips):
        keep = F.lit(True)
        for name, chip in chips.items():
            keep = keep if name == removed else keep & chip
        counts.append(F.struct(F.lit(removed).alias("removed"), F.count_if(keep).alias("n")))
    return read(spark, d, "orders").agg(F.array(*counts).alias("all")).select(F.inline("all"))


@query("""SELECT o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next, row_number() OVER w AS place, count(*) OVER (PARTITION BY o_custkey) AS siblings FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)""")
def sibling_links(spark: SparkSession, d: str) -> DataFrame:
    one = W.partitionBy("o_custkey")
    w = one.orderBy(F.desc("o_totalprice"), "o_orderkey")
    return read(spark, d, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("previous"), F.lead("o_orderkey").over(w).alias("next"), F.row_number().over(w).alias("place"), F.count("*").over(one).alias("siblings"))


@query("""SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING bool_or(event_type = 'signup') AND bool_or(event_type = 'purchase') AND NOT bool_or(event_type = 'error' AND value > 99)""")
def stage_mix(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    per = read(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or(kind == "signup").alias("a"), F.bool_or(kind == "purchase").alias("b"), F.bool_or((kind == "error") & (F.col("value") > 99)).alias("c"))
    return per.where("a and b and not c").select("user_id", "n")


@query("""SELECT o_custkey, list(o_orderkey || ':' || o_orderstatus ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY 1""")
def ordered_members(spark: SparkSession, d: str) -> DataFrame:
    line = F.struct("o_orderdate", "o_orderkey", F.concat_ws(":", "o_orderkey", "o_orderstatus").alias("t"))
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["t"]).alias("orders"))


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2000-01-01 19:00:00') AS start, count(*) AS n FROM events GROUP BY 1""")
def tumbling_nights(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").groupBy(F.window("ts", "1 day", "1 day", "19 hours").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) <= 100 AS chosen FROM events WHERE event_type = 'view'""")
def fetch_targets(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").where("event_type = 'view'")
    chosen = rows.orderBy(F.desc("value"), "event_id").limit(100).select("event_id", F.lit(True).alias("chosen"))
    return rows.select("event_id").join(chosen, "event_id", "left").select("event_id", F.coalesce("chosen", F.lit(False)).alias("chosen"))
