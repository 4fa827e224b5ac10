"""Merges, checks, joins, rankings, facets and reports over orders, line items, customers and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text, titles
from ..operators import candidates, history, merge, ranking
from ..sources.tables import read
from .registry import query


def day(value: str):
    return F.lit(value).cast("timestamp_ntz")


@query("""SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0) AS before, (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS added, (SELECT count(*) FROM orders) AS now, true AS append_only""")
def append_only_batch(spark: SparkSession, d: str) -> DataFrame:
    now = read(spark, d, "orders")
    return merge.append_only(now.where("o_orderkey % 10 <> 0"), now, ["o_orderkey"])


@query("""WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 45)
SELECT side, count(*) AS n FROM (SELECT 'left' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'right' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)) GROUP BY 1""")
def reconcile_both_ways(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    return merge.reconcile(a, read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("k")), "k")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, o_custkey, 'N' FROM orders WHERE o_orderkey % 4 = 0""")
def insert_only_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return merge.insert_only(rows.where("o_orderkey % 4 <> 0"), rows.withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"])


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, round(CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END, 2) AS c_acctbal FROM customer WHERE c_acctbal < 0 OR c_custkey % 7 = 0""")
def change_only_update(spark: SparkSession, d: str) -> DataFrame:
    old = read(spark, d, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    new = old.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"), F.round(F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), 2).alias("c_acctbal"))
    return merge.changed(old, new, ["c_custkey"], ["c_mktsegment", "c_acctbal"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_key_check(spark: SparkSession, d: str) -> DataFrame:
    return merge.duplicate_keys(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'order_without_customer' AS name, count(*) AS violations FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'null_status', count(*) FROM orders WHERE o_orderstatus IS NULL
UNION ALL SELECT 'negative_total', count(*) FROM orders WHERE o_totalprice < 0 UNION ALL SELECT 'repeated_key', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'customer_below_zero', count(*) FROM customer WHERE c_acctbal < 0""")
def invariant_counts(spark: SparkSession, d: str) -> DataFrame:
    orders, customer = read(spark, d, "orders"), read(spark, d, "customer")
    return merge.invariants({
        "order_without_customer": orders.join(customer, orders.o_custkey == customer.c_custkey, "left_anti"), "null_status": orders.where("o_orderstatus is null"), "negative_total": orders.where("o_totalprice < 0"),
        "repeated_key": merge.duplicate_keys(orders, ["o_orderkey"]), "customer_below_zero": customer.where("c_acctbal < 0"),
    })


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey""")
def candidate_block_self_join(spark: SparkSession, d: str) -> DataFrame:
    return candidates.block_pairs(read(spark, d, "part"), "p_partkey", ["p_brand", "p_type", "p_size"])


@query("""WITH r AS (SELECT a.p_partkey AS a, b.p_partkey AS b, 'brand_type_size' AS route FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey
UNION ALL SELECT a.p_partkey, b.p_partkey, 'name' FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey) SELECT a, b, list_sort(list(DISTINCT route)) AS routes FROM r GROUP BY ALL""")
def route_union_provenance(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    return candidates.union_routes({"brand_type_size": candidates.block_pairs(part, "p_partkey", ["p_brand", "p_type", "p_size"]), "name": candidates.block_pairs(part, "p_partkey", ["p_name", "p_size"])})


@query("""SELECT route, count(*) AS n FROM (SELECT unnest(['all', 'source:' || source, 'lang:' || lang]) AS route FROM documents) GROUP BY 1""")
def array_route_explode(spark: SparkSession, d: str) -> DataFrame:
    route = F.explode(F.array(F.lit("all"), F.concat(F.lit("source:"), "source"), F.concat(F.lit("lang:"), "lang")))
    return read(spark, d, "documents").select(route.alias("route")).groupBy("route").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT c_nationkey AS g, date_trunc('month', o_orderdate) AS swept FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), l AS (SELECT o_custkey, c_nationkey AS g, max(o_orderdate) AS last_seen FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT o_custkey, last_seen, count(*) FILTER (WHERE swept > last_seen) AS later FROM l LEFT JOIN s USING (g) GROUP BY ALL""")
def absence_sweeps(spark: SparkSession, d: str) -> DataFrame:
    seen = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", F.col("c_nationkey").alias("g"), "o_orderdate")
    sweeps = seen.select("g", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("swept")).distinct()
    return history.unanswered_since(seen, "o_custkey", "o_orderdate", sweeps, ["g"], "swept")


@query("""SELECT d.doc_id, d.lang, l.quality, l.toxic, l.doc_id IS NOT NULL AS answered FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def answers_left_join(spark: SparkSession, d: str) -> DataFrame:
    labels = read(spark, d, "labels").withColumn("answered", F.lit(True))
    return read(spark, d, "documents").join(labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic", F.coalesce("answered", F.lit(False)).alias("answered"))


@query("""SELECT o_orderkey, o_custkey, o_orderdate FROM orders a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND (b.o_orderdate, b.o_orderkey) > (a.o_orderdate, a.o_orderkey))""")
def not_exists_newer(spark: SparkSession, d: str) -> DataFrame:
    return history.latest(read(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "o_custkey", "o_orderdate")


@query("""SELECT c_custkey, t.o_orderkey AS top_order, t.o_totalprice AS top_price, n.statuses, n.first_order FROM customer LEFT JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) t ON true
LEFT JOIN (SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS statuses, min(o_orderdate) AS first_order FROM orders GROUP BY 1) n ON n.o_custkey = c_custkey""")
def lateral_top1(spark: SparkSession, d: str) -> DataFrame:
    per = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min_by(F.struct("o_orderkey", "o_totalprice"), F.struct(-F.col("o_totalprice"), "o_orderkey")).alias("t"), F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"), F.min("o_orderdate").alias("first_order")
    )
    return read(spark, d, "customer").select("c_custkey").join(per, "c_custkey", "left").select("c_custkey", F.col("t.o_orderkey").alias("top_order"), F.col("t.o_totalprice").alias("top_price"), "statuses", "first_order")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_returnflag = 'N' AND l_quantity >= 49 OR (l_returnflag = 'R' AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000))""")
def leader_scope_filter(spark: SparkSession, d: str) -> DataFrame:
    leaders = read(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("_leader")).distinct()
    scope = ((F.col("l_returnflag") == "N") & (F.col("l_quantity") >= 49)) | ((F.col("l_returnflag") == "R") & F.col("_leader").isNotNull())
    return read(spark, d, "lineitem").join(leaders, "l_suppkey", "left").where(scope).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("""WITH q AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS bucket, CASE WHEN l_discount > 0.05 THEN l_quantity END AS held, o_orderdate, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS company FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT *, row_number() OVER (ORDER BY bucket, held DESC NULLS LAST, o_orderdate DESC, l_orderkey DESC, l_linenumber, l_suppkey) AS position FROM q)
SELECT l_orderkey, l_linenumber, l_suppkey, position, min(position) OVER (PARTITION BY coalesce('c:' || company, 'a:' || l_orderkey || '/' || l_linenumber)) AS leader FROM p""")
def ranked_clustered_queue(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    rows = rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.when(flag == "R", 0).when(flag == "A", 1).otherwise(2).alias("bucket"), F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("held"), "o_orderdate", F.when(flag != "N", F.col("l_suppkey")).alias("company"))
    order = [F.asc("bucket"), F.desc_nulls_last("held"), F.desc("o_orderdate"), F.desc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_suppkey")]
    return ranking.clustered(rows, order, F.col("company"), F.concat_ws("/", "l_orderkey", "l_linenumber")).select("l_orderkey", "l_linenumber", "l_suppkey", "position", "leader")


@query("""WITH r AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*) AS n FROM r WHERE o_orderpriority LIKE '1%' AND c_mktsegment <> 'BUILDING' GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM r WHERE o_orderstatus = 'O' AND c_mktsegment <> 'BUILDING' GROUP BY ALL
UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM r WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '1%' GROUP BY ALL""")
def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderstatus", "o_orderpriority", "c_mktsegment")
    return ranking.facets(rows, {"o_orderstatus": F.col("o_orderstatus") == "O", "o_orderpriority": F.col("o_orderpriority").like("1%"), "c_mktsegment": F.col("c_mktsegment") != "BUILDING"})


@query("""SELECT o_orderkey, o_totalprice, ordinal FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS ordinal FROM orders) WHERE ordinal BETWEEN 51 AND 100""")
def page_window(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranking.page(ranking.ranked(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")], "ordinal"), "ordinal", 2, 50)


@query("""SELECT DISTINCT ON (l_partkey) l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_partkey, l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC""")
def distinct_on_representative(spark: SparkSession, d: str) -> DataFrame:
    return history.representative(read(spark, d, "lineitem").withColumn("tie", F.struct("l_orderkey", "l_linenumber", "l_extendedprice")), "l_partkey", "l_shipdate", "tie", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("""SELECT doc_id, lang FROM documents WHERE (text ILIKE '%the%' AND text ILIKE '%tion %' AND NOT text ILIKE '%license%') OR text ILIKE '% der die %'""")
def boolean_text_search(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where(text.search('(the AND "tion " NOT license) OR " der die "', F.col("text"))).select("doc_id", "lang")


@query(r"""SELECT p_partkey, p_name FROM part WHERE p_name || CASE p_size % 3 WHEN 0 THEN '_100%' WHEN 1 THEN 'x100%' ELSE '_100x' END ILIKE '%G\_100\%%' ESCAPE '\'""")
def like_escaped_search(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("p_size") % 3 == 0, "_100%").when(F.col("p_size") % 3 == 1, "x100%").otherwise("_100x")
    return read(spark, d, "part").where(F.concat("p_name", end).ilike(text.like_escaped("G_100%"))).select("p_partkey", "p_name")


@query("""WITH r AS (SELECT n_name, o_orderstatus, o_orderpriority LIKE '1%' AS urgent FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) FILTER (WHERE urgent) AS urgent, round(100.0 * count(*) FILTER (WHERE urgent) / count(*), 2)::DOUBLE AS urgent_share FROM r GROUP BY 1""")
def validation_pivot(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority").like("1%")
    return rows.groupBy("n_name").agg(F.count("*").alias("total"), *(F.count_if(status == s).alias(s.lower()) for s in "FOP"), F.count_if(urgent).alias("urgent"), F.round(100.0 * F.count_if(urgent) / F.count("*"), 2).alias("urgent_share"))


@query("""SELECT stage, tier, round(sum(cost), 2) AS total, count(*) AS n FROM (SELECT 'orders' AS stage, o_orderpriority AS tier, o_totalprice AS cost FROM orders UNION ALL SELECT 'lineitem', l_returnflag, l_extendedprice * (1 - l_discount) FROM lineitem) GROUP BY ALL""")
def cost_union_totals(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").select(F.lit("orders").alias("stage"), F.col("o_orderpriority").alias("tier"), F.col("o_totalprice").alias("cost"))
    b = read(spark, d, "lineitem").select(F.lit("lineitem").alias("stage"), F.col("l_returnflag").alias("tier"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("cost"))
    return a.unionByName(b).groupBy("stage", "tier").agg(F.round(F.sum("cost"), 2).alias("total"), F.count("*").alias("n"))


@query("""WITH g AS (SELECT o_orderkey, o_orderdate, sum(CASE WHEN l_quantity > 2 THEN l_extendedprice END) AS cost FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL HAVING count(CASE WHEN l_quantity > 2 THEN 1 END) = count(*)), t AS (SELECT * FROM g ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10)
SELECT CASE WHEN count(*) = 10 THEN round(avg(cost), 4) END AS mean_cost, count(*) AS n FROM t""")
def complete_groups_average(spark: SparkSession, d: str) -> DataFrame:
    cost = F.when(F.col("l_quantity") > 2, F.col("l_extendedprice"))
    rows = read(spark, d, "orders").join(read(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    per = rows.groupBy("o_orderkey", "o_orderdate").agg(F.sum(cost).alias("cost"), F.count(cost).alias("known"), F.count("*").alias("n")).where("known = n")
    last = per.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10)
    return last.agg(F.when(F.count("*") == 10, F.round(F.avg("cost"), 4)).alias("mean_cost"), F.count("*").alias("n"))


_TOKENS = "list_filter(list_distinct(regexp_split_to_array(lower({}), '[^0-9a-z]+')), lambda x: x <> '' AND x NOT IN ('senior', 'snr', 'sr', 'junior', 'jr'))"


@query(f"""WITH t AS (SELECT p_partkey, p_brand, p_size, {_TOKENS.format('p_name')} AS w FROM part), p AS (SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(a.w, b.w)) AS shared, len(a.w) AS na, len(b.w) AS nb FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT a, b, (na > 0 AND nb > 0 AND shared = least(na, nb)) OR shared >= 2 AS compatible, na > 0 AND nb > 0 AND shared = 0 AS disjoint FROM p""")
def title_rules(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    w = part.select("p_partkey", titles.tokens(F.col("p_name")).alias("w"))
    pairs = candidates.block_pairs(part, "p_partkey", ["p_brand", "p_size"])
    both = pairs.join(w.select(F.col("p_partkey").alias("a"), F.col("w").alias("wa")), "a").join(w.select(F.col("p_partkey").alias("b"), F.col("w").alias("wb")), "b")
    return both.select("a", "b", titles.compatible(F.col("wa"), F.col("wb")).alias("compatible"), titles.disjoint(F.col("wa"), F.col("wb")).alias("disjoint"))


@query("""SELECT o_custkey, o_orderkey, r AS place, total FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders WHERE o_orderstatus = 'O') WHERE r <= 3""")
def queue_positions(spark: SparkSession, d: str) -> DataFrame:
    one = W.partitionBy("o_custkey")
    rows = read(spark, d, "orders").where("o_orderstatus = 'O'").withColumn("place", F.row_number().over(one.orderBy("o_orderdate", "o_orderkey"))).withColumn("total", F.count("*").over(one))
    return rows.where("place <= 3").select("o_custkey", "o_orderkey", "place", "total")
