"""Addresses, titles, answers and people of research on a listing, made from suppliers, parts, pages and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import answers, contacts, markup, names, people, text, titles, vacancy
from ..operators import merge
from ..sources import standard
from ..sources.tables import read
from .registry import query

_URLS = """u AS (SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN 'https://boards.greenhouse.io/acme' || s_nationkey || '/jobs/' || (400000 + s_suppkey) WHEN 1 THEN 'https://jobs.lever.co/acme' || s_nationkey || '/x' WHEN 2 THEN 'https://acme.wd3.myworkdayjobs.com/en-US/site/job/Role_' || (10000 + s_suppkey)
WHEN 3 THEN 'https://www.indeed.com/viewjob?jk=' || (1000 + s_suppkey) WHEN 4 THEN 'https://www.example' || s_nationkey || '.com/careers' WHEN 5 THEN 'https://example.com.sg/jobs/senior-data-engineer-' || s_suppkey WHEN 6 THEN 'https://example.org/about/news/' || (20000 + s_suppkey) ELSE 'https://jobs.smartrecruiters.com/Acme' || s_nationkey || '/7439' || s_suppkey || '-role' END AS url FROM supplier)"""
_MADE = _URLS[_URLS.index("CASE") : _URLS.index(" AS url")]


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").withColumn("url", F.expr(_MADE))


@query(f"""WITH {_URLS} SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 2 THEN 'workday' WHEN 7 THEN 'smartrecruiters' END AS vendor, s_suppkey % 8 = 3 AS aggregator,
CASE WHEN s_suppkey % 8 IN (0, 1) THEN regexp_extract(url, '(acme[0-9]+)', 1) WHEN s_suppkey % 8 = 2 THEN 'acme' WHEN s_suppkey % 8 = 7 THEN regexp_extract(url, '(Acme[0-9]+)', 1) END AS tenant FROM u""")
def hiring_systems(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("url")
    return _addresses(spark, d).select("s_suppkey", vacancy.vendor_of(url).alias("vendor"), vacancy.is_aggregator(url).alias("aggregator"), vacancy.tenant_of(url).alias("tenant"))


@query(f"""WITH {_URLS} SELECT s_suppkey, s_suppkey % 8 <> 4 AND NOT (s_suppkey % 8 = 1 AND false) AS could_be, CASE s_suppkey % 8 WHEN 0 THEN true WHEN 2 THEN true WHEN 5 THEN true WHEN 6 THEN true WHEN 7 THEN length('7439' || s_suppkey || '-role') > 10 AND length('7439' || s_suppkey) >= 5 ELSE false END AS looks_like FROM u""")
def vacancy_addresses(spark: SparkSession, d: str) -> DataFrame:
    return _addresses(spark, d).select("s_suppkey", vacancy.could_be_one_vacancy(F.col("url")).alias("could_be"), vacancy.looks_like_one_vacancy(F.col("url")).alias("looks_like"))


#: Ids of a title that are one row, parts of a class whose pairs are made apart, and ids that go through another title's at once.
IDS, TURNS, RUN = 1000, 8, 16
_TW = "list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ('senior', 'junior', 'lead', 'staff', 'engineer', 'role')))"


@query(f"""WITH p AS (SELECT p_partkey, p_brand, p_type, 'Senior ' || p_name || ' engineer (' || p_type || ')' AS mine, p_name || ' ' || CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'lead role' END AS base FROM part), w AS (SELECT *, {_TW.format("regexp_replace(mine, '[(].*?[)]', ' ', 'g')")} AS a, {_TW.format('base')} AS b FROM p),
x AS (SELECT m.p_partkey AS id, o.p_partkey AS other, len(list_intersect(m.a, o.b)) / len(m.a) AS covered, len(list_intersect(m.a, o.b)) / len(list_distinct(m.a || o.b)) AS similarity FROM w m JOIN w o ON m.p_brand = o.p_brand AND m.p_type = o.p_type) SELECT id, other, covered >= 0.6 AS agrees, round(similarity, 6) AS similarity FROM x""")
def title_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Each different title is parted into words once, each pair of different titles of a class is judged once and stands for all pairs of their rows.

    Spark's compiled steps hold all rows that come of one, and the pairs of a title with its class can be millions. So a step with a lambda, which isn't compiled, stands before each of the loops:
    no step holds more than the lists a title meets, or RUN times IDS pairs.
    """
    part, key = read(spark, d, "part"), ["p_brand", "p_type"]
    blank = F.lit("")
    title = F.coalesce(F.concat(F.lit("Senior "), "p_name", F.lit(" engineer ("), "p_type", F.lit(")")), blank)
    base = F.coalesce(F.concat("p_name", F.lit(" "), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("lead role")), blank)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)

    def rows_of(title: Column) -> DataFrame:
        """key, title, ids: up to IDS ids of the rows of a title."""
        place = F.row_number().over(W.partitionBy(*key, "title").orderBy("p_partkey"))
        placed = part.dropna(subset=key).select(*key, title.alias("title"), "p_partkey").withColumn("chunk", F.floor((place - 1) / IDS))
        return placed.groupBy(*key, "title", "chunk").agg(F.collect_list(F.struct("p_partkey")).alias("ids")).drop("chunk")

    # few rows make many pairs: they are dealt by class and turn in a fixed number of partitions, as their own size would leave them in one
    dealt = [*key, "turn"]
    core = F.regexp_replace("title", r"\(.*?\)", " ")
    plain = lambda ids: F.transform(ids, lambda i: i["p_partkey"])
    a = rows_of(title).withColumn("turn", F.pmod(F.xxhash64("title"), F.lit(TURNS))).select(*dealt, F.col("ids").alias("a"), vacancy.listing_words(F.col("title")).alias("x"), vacancy.title_words(core).alias("y")).repartition(n, *dealt)
    b = rows_of(base).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(TURNS - 1).cast("long")))).select(*dealt, plain("ids").alias("b"), vacancy.title_words(F.col("title")).alias("z")).repartition(n, *dealt)
    agrees, similarity = vacancy.words_agree(F.col("x"), F.col("z")), F.round(vacancy.words_similarity(F.col("y"), F.col("z")), 6)
    judged = a.join(b, dealt).select("a", "b", agrees.alias("agrees"), similarity.alias("similarity"))
    runs = F.transform(F.sequence(F.lit(1), F.size("a"), F.lit(RUN)), lambda i: F.slice("a", i, RUN))
    few = judged.withColumn("a", runs).select(F.explode("a").alias("a"), "b", "agrees", "similarity").withColumn("a", plain("a"))
    return few.select(F.explode("a").alias("id"), "b", "agrees", "similarity").select("id", F.explode("b").alias("other"), "agrees", "similarity")


@query("""WITH c AS (SELECT l_orderkey AS listing, 'u' || l_partkey || '-' || l_linenumber || '-' || l_suppkey AS url, l_returnflag = 'R' AS hit, l_discount AS share, l_quantity / 50 AS similarity FROM lineitem WHERE l_orderkey < 2000), r AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY hit DESC, share DESC, similarity DESC, url) AS place FROM c WHERE hit OR similarity >= 0.45) SELECT listing, place, url FROM r WHERE place <= 6""")
def best_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").where("l_orderkey < 2000").select(F.col("l_orderkey").alias("listing"), F.concat_ws("-", F.concat(F.lit("u"), "l_partkey"), "l_linenumber", "l_suppkey").alias("url"), (F.col("l_returnflag") == "R").alias("hit"), F.col("l_discount").alias("share"), (F.col("l_quantity") / 50).alias("similarity"))
    return vacancy.best_candidates(rows, "listing")


@query("""WITH c AS (SELECT o_custkey AS listing, 'u' || o_orderkey AS url, left(o_orderpriority, 1)::INT AS step, row_number() OVER (PARTITION BY o_custkey, left(o_orderpriority, 1) ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderstatus = 'F' AS accepted FROM orders) SELECT listing, arg_min(url, (step, place, url)) AS url, min(step) AS step FROM c WHERE accepted GROUP BY 1""")
def first_accepted(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    step = F.substring("o_orderpriority", 1, 1).cast("int")
    place = F.row_number().over(W.partitionBy("o_custkey", F.substring("o_orderpriority", 1, 1)).orderBy(F.desc("o_totalprice"), "o_orderkey"))
    rows = read(spark, d, "orders").select(F.col("o_custkey").alias("listing"), F.concat(F.lit("u"), "o_orderkey").alias("url"), step.alias("step"), place.alias("place"), (F.col("o_orderstatus") == "F").alias("accepted"))
    return vacancy.first_accepted(rows, "listing")


@query(f"""WITH {_URLS}, p AS (SELECT *, (s_suppkey * 37 % 100) / 100 AS share, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'Some text' END AS text FROM u) SELECT s_suppkey, CASE WHEN s_suppkey % 8 = 3 THEN 'aggregator' WHEN s_suppkey % 8 = 4 THEN 'not_specific' WHEN s_suppkey % 8 = 6 THEN 'non_job_path' WHEN text = '' THEN 'unreadable' WHEN share >= 0.3 THEN 'content_strong' WHEN share >= 0.15 AND s_suppkey % 2 = 0 THEN 'content_weak_title' WHEN s_suppkey % 3 = 0 THEN 'weak_facets_only' ELSE 'read_clean_no_match' END AS verdict,
CASE WHEN s_suppkey % 8 IN (3, 4, 6) THEN NULL WHEN s_suppkey % 10 = 0 THEN 'requisition' WHEN s_suppkey % 2 = 1 THEN NULL WHEN share >= 0.3 THEN 'content' WHEN share >= 0.15 AND s_suppkey % 3 = 0 THEN 'content+location' END AS footing FROM p""")
def vacancy_verdicts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = _addresses(spark, d).withColumns({"share": (k * 37 % 100) / 100, "text": F.when(k % 9 == 0, "").otherwise("Some text")})
    found = F.when(k % 3 == 0, F.array(F.lit("company"), F.lit("title"))).otherwise(F.array(F.lit("company")))
    verdict = vacancy.verdict(F.col("url"), F.col("text"), F.col("share"), found, k % 2 == 0)
    footing = vacancy.accepted(F.col("share"), k % 2 == 0, k % 2 == 0, k % 3 == 0, F.lit("A title"), k % 10 == 0, ~(k % 8).isin(3, 4, 6))
    return rows.select("s_suppkey", verdict.alias("verdict"), footing.alias("footing"))


@query("""WITH p AS (SELECT p_partkey, p_name || CASE p_size % 4 WHEN 0 THEN ' (R' || (100000 + p_partkey) || ')' WHEN 1 THEN ' Job No: AB-' || (700000 + p_partkey) WHEN 2 THEN ' #' || (50000 + p_partkey) || ' and #0000123' ELSE '' END AS title FROM part) SELECT p_partkey, CASE p_partkey >= 0 WHEN true THEN CASE WHEN title LIKE '%(R%' THEN ['R' || (100000 + p_partkey)] WHEN title LIKE '%Job No%' THEN ['AB-' || (700000 + p_partkey)] WHEN title LIKE '%#%' THEN [(50000 + p_partkey)::VARCHAR] ELSE [] END END AS ids FROM p""")
def requisition_numbers(spark: SparkSession, d: str) -> DataFrame:
    n, size = F.col("p_partkey"), F.col("p_size") % 4
    end = F.when(size == 0, F.concat(F.lit(" (R"), n + 100000, F.lit(")"))).when(size == 1, F.concat(F.lit(" Job No: AB-"), n + 700000)).when(size == 2, F.concat(F.lit(" #"), n + 50000, F.lit(" and #0000123"))).otherwise("")
    return read(spark, d, "part").select("p_partkey", vacancy.requisition_ids(F.concat("p_name", end), F.lit(None).cast("string")).alias("ids"))


_FIRM = "CASE s_suppkey % 5 WHEN 0 THEN 'The Northern Star Group Pte Ltd' WHEN 1 THEN 'Acme Holdings Limited' WHEN 2 THEN 'Example Consulting Group' WHEN 3 THEN 'Bluewater' ELSE 'AB Data Centre Co' END"
_SITE = "CASE s_nationkey % 5 WHEN 0 THEN 'https://www.northernstar.com.sg/jobs' WHEN 1 THEN 'https://acmegroup.com/careers' WHEN 2 THEN 'https://ecg.example/jobs' WHEN 3 THEN 'https://boards.greenhouse.io/bluewater' ELSE 'https://www.indeed.com/acme' END"


@query("""WITH s AS (SELECT s_suppkey, s_suppkey % 5 AS c, s_nationkey % 5 AS w FROM supplier) SELECT s_suppkey, CASE c WHEN 0 THEN ['nsgpl'] WHEN 1 THEN ['ahl'] WHEN 2 THEN ['ecg'] WHEN 3 THEN [] ELSE ['abdc', 'abdcco'] END AS initials,
CASE w WHEN 0 THEN c = 0 WHEN 1 THEN c = 1 WHEN 2 THEN c = 2 WHEN 3 THEN c = 3 ELSE false END AS controls, CASE c WHEN 0 THEN true WHEN 1 THEN false ELSE false END AS named FROM s""")
def company_ownership(spark: SparkSession, d: str) -> DataFrame:
    firm = F.expr(_FIRM)
    return read(spark, d, "supplier").select("s_suppkey", F.array_sort(vacancy.acronyms(firm)).alias("initials"), vacancy.controls(F.expr(_SITE), firm).alias("controls"), vacancy.names_company(F.lit("Careers - Northern Star"), firm).alias("named"))


@query("""SELECT s_suppkey AS id, 't' || s_nationkey AS tenant, v AS vendor, CASE v WHEN 'lever' THEN '' ELSE 'Perth' END AS location, s_name AS title, 'https://x.test/' || s_suppkey AS url FROM supplier, (SELECT unnest(['greenhouse', 'lever', 'ashby']) AS v)""")
def vendor_job_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists of three hiring systems, each in its own shape, as one table."""
    rows = read(spark, d, "supplier").select(F.concat(F.lit("t"), "s_nationkey").alias("tenant"), "s_name", F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("https://x.test/"), "s_suppkey").alias("url"))
    shapes = {
        "greenhouse": F.struct(F.col("s_name").alias("title"), F.struct(F.lit("Perth").alias("name")).alias("location"), F.col("url").alias("absolute_url"), "id"),
        "lever": F.struct(F.col("s_name").alias("text"), F.lit(None).cast("struct<location: string>").alias("categories"), F.col("url").alias("hostedUrl"), "id"),
        "ashby": F.struct(F.col("s_name").alias("title"), F.lit("Perth").alias("location"), F.col("url").alias("jobUrl"), "id"),
    }
    out = None
    for vendor, shape in shapes.items():
        each = rows.groupBy("tenant").agg(F.collect_list(shape).alias("jobs"))
        body = F.to_json("jobs") if vendor == "lever" else F.to_json(F.struct("jobs"))
        part = vacancy.jobs_of(each.select("tenant", body.alias("body")), vendor)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("id", F.col("id").cast("long"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN ['https://www.blueriver.com', 'https://www.blueriver.sg', 'https://www.blue-river.com', 'https://www.blue-river.sg', 'https://www.blue.com', 'https://www.blue.sg'] ELSE ['https://www.nation.com', 'https://www.nation.sg'] END AS sites FROM supplier""")
def site_guesses(spark: SparkSession, d: str) -> DataFrame:
    firm = F.when(F.col("s_suppkey") % 2 == 0, "Blue River Pte Ltd").otherwise("The Nation Group")
    return read(spark, d, "supplier").select("s_suppkey", vacancy.guesses(firm, [".com", ".sg"]).alias("sites"))


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_name END, '') || CASE WHEN c_mktsegment <> 'BUILDING' THEN ', hiring for ' || c_mktsegment ELSE '' END AS line FROM customer""")
def advertiser_lines(spark: SparkSession, d: str) -> DataFrame:
    hiring = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return read(spark, d, "customer").select("c_custkey", answers.advertiser_line(F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")), hiring).alias("line"))


@query("""SELECT doc_id, sha256('Title: ' || coalesce(lang, '') || chr(10) || 'JD: ' || left(coalesce(text, ''), 16000)) AS digest FROM documents""")
def listing_inputs(spark: SparkSession, d: str) -> DataFrame:
    sent = answers.listing_input("Title: {title}\nJD: {jd}", title=F.col("lang"), jd=answers.sent_text(F.col("text")))
    return read(spark, d, "documents").select("doc_id", F.sha2(sent, 256).alias("digest"))


_INPUT = "sha256('[\"' || lang || '\",\"' || source || '\"]')"


@query(f"""WITH r AS (SELECT doc_id AS id, {_INPUT} || n_chars % 50 AS input_hash, CASE WHEN doc_id % 4 = 0 THEN {_INPUT} || n_chars % 50 END AS held, CASE WHEN doc_id % 7 = 0 THEN 'failed_twice' END AS reason FROM documents), a AS (SELECT DISTINCT input_hash FROM r WHERE id % 3 = 0),
l AS (SELECT r.*, held IS NOT NULL OR (a.input_hash IS NOT NULL AND reason IS NULL) AS answered FROM r LEFT JOIN a USING (input_hash)) SELECT input_hash, list_sort(list(id)) AS ids, count(*) AS n FROM l WHERE NOT answered GROUP BY 1""")
def answer_cohorts(spark: SparkSession, d: str) -> DataFrame:
    """Inputs that no stored answer covers, each once, with the listings that wait for it."""
    key = F.concat(answers.input_hash(F.col("lang"), F.col("source")), (F.col("n_chars") % 50).cast("string"))
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("id"), key.alias("input_hash"), F.when(F.col("doc_id") % 4 == 0, key).alias("held"), F.when(F.col("doc_id") % 7 == 0, "failed_twice").alias("reason"))
    found = answers.known(rows, rows.where("id % 3 = 0").select("input_hash").distinct())
    return answers.cohort(answers.linked(rows, found, ["failed_twice"]), ~F.col("answered"))


@query("""WITH b AS (SELECT item_id, text, CASE item_id % 3 WHEN 0 THEN '•  ' || upper(left(text, 60)) WHEN 1 THEN replace(left(text, 60), ' ', '  ') ELSE 'zz ' || left(text, 60) END AS quote FROM benchmark) SELECT item_id, item_id % 3 < 2 AS found FROM b""")
def quotes_found(spark: SparkSession, d: str) -> DataFrame:
    head, rest = F.substring("text", 1, 60), F.col("item_id") % 3
    quote = F.when(rest == 0, F.concat(F.lit("•  "), F.upper(head))).when(rest == 1, F.replace(head, F.lit(" "), F.lit("  "))).otherwise(F.concat(F.lit("zz "), head))
    return read(spark, d, "benchmark").select("item_id", answers.quote_found(quote, F.lit("title"), F.col("text")).alias("found"))


_PEOPLE = "p AS (SELECT o_custkey AS listing, o_orderkey AS place, ['Head of Data', 'Data Analyst', 'Talent Partner', 'Graduate Trainee', 'Chief Executive', 'Board Advisor', 'Cook', 'Senior Analytics Lead'][(o_orderkey % 8 + 1)::INT] AS title, o_orderkey % 8 AS t, o_orderstatus = 'F' AS in_market, o_totalprice > 480000 AS on_listing, o_totalprice < 20000 AS only_posts FROM orders)"


@query(f"""WITH {_PEOPLE}, g AS (SELECT *, CASE WHEN on_listing THEN 0 WHEN only_posts THEN 4 WHEN t IN (3, 4, 5, 6) THEN 3 WHEN t = 2 THEN 1 ELSE 2 END AS grp FROM p), r AS (SELECT *, CASE WHEN grp = 2 THEN CASE WHEN t IN (0, 7) THEN 0 ELSE 2 END WHEN grp = 3 THEN CASE t WHEN 4 THEN 0 ELSE 2 END ELSE 0 END AS rank FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY grp, rank, NOT in_market, place) AS position FROM r), k AS (SELECT *, CASE WHEN NOT bool_or(grp = 2) OVER (PARTITION BY listing) AND grp = 3 AND t = 4 THEN 2 ELSE grp END AS stands FROM o),
n AS (SELECT *, row_number() OVER (PARTITION BY listing, stands ORDER BY position) AS n FROM k) SELECT listing, place, CASE WHEN grp < 4 THEN ['named_on_listing', 'recruiter', 'hiring_manager_or_team', 'also_at_company'][grp + 1] END AS "group", rank, position FROM n WHERE stands = 0 OR (stands = 1 AND n <= 1) OR (stands = 2 AND n <= 2)""")
def key_people(spark: SparkSession, d: str) -> DataFrame:
    """Who of those found for a listing is looked up first."""
    names_ = ("Head of Data", "Data Analyst", "Talent Partner", "Graduate Trainee", "Chief Executive", "Board Advisor", "Cook", "Senior Analytics Lead")
    rows = read(spark, d, "orders").select(
        F.col("o_custkey").alias("listing"), F.col("o_orderkey").alias("place"), F.element_at(F.array(*map(F.lit, names_)), (F.col("o_orderkey") % 8 + 1).cast("int")).alias("title"), people.team_words(F.lit("Senior Data Engineer")).alias("team"),
        (F.col("o_orderstatus") == "F").alias("in_market"), (F.col("o_totalprice") > 480000).alias("on_listing"), (F.col("o_totalprice") < 20000).alias("only_posts"),
    )
    return people.key_people(people.classified(rows, "listing", "place"), "listing", 1, 2).select("listing", "place", "group", "rank", "position")


@query()
def merged_people(spark: SparkSession, d: str) -> DataFrame:
    """The customers of a nation and segment taken for people found by several steps; those with the same last digits are one person."""
    digits = F.substring("c_name", -2, 2)
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Zoë Person"), digits)).otherwise(F.concat(F.lit("zoe  person"), digits))
    rows = read(spark, d, "customer").select(
        F.col("c_nationkey").cast("long").alias("listing"), F.col("c_custkey").alias("place"), name.alias("name"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("title"), people.profile_key(F.lit("")).alias("profile"),
        F.lit(None).cast("string").alias("email"), F.when(F.col("c_custkey") % 5 == 0, "listing").otherwise("web").alias("found_by"), F.when(F.col("c_custkey") % 4 == 0, "provider_inferred").otherwise("publicly_observed").alias("provenance"),
        F.lit(False).alias("only_posts"), (F.col("c_acctbal") > 0).alias("in_market"),
    )
    return people.merged_people(rows)


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'jane' WHEN 1 THEN NULL WHEN 2 THEN 'jdoe-1' ELSE NULL END AS profile, c_custkey % 5 IN (0, 1, 2) AS spelled, CASE WHEN c_custkey % 3 > 0 THEN ['jane.doe@x.test', 'jdoe@x.test'] END AS addresses, c_custkey % 2 = 0 AS titled FROM customer""")
def contact_forms(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    url = F.element_at(F.array(*map(F.lit, ("https://www.linkedin.com/in/Jane?x=1", "https://linkedin.com/in/ACwAAB1234567890abcdefghijk", "http://sg.linkedin.com/in/jdoe-1/", "https://example.com/in/jane"))), (k % 4 + 1).cast("int"))
    local = F.element_at(F.array(*map(F.lit, ("jane.doe", "j.doe", "doe_jane", "info", "jd"))), (k % 5 + 1).cast("int"))
    said = F.when(k % 2 == 0, "We need a Senior Analyst, Growth (Singapore)").otherwise("Senior Growth Analyst")
    return read(spark, d, "customer").select(
        "c_custkey", people.profile_key(url).alias("profile"), people.spells(local, F.lit("Jane M Doe")).alias("spelled"), people.addresses(F.lit("Jane Doe"), F.when(k % 3 > 0, "x.test").otherwise(""), ["{first}.{last}", "{f}{last}"]).alias("addresses"),
        people.names_title(said, F.lit("senior analyst - APAC growth")).alias("titled"),
    )


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE floor(o_totalprice) END AS low, CASE o_orderkey % 6 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 1 THEN floor(o_totalprice) + 1 ELSE floor(o_totalprice) * 2 END AS high, ['HKD', 'USD', 'AUD', 'THB', NULL, 'SGD'][(o_orderkey % 6 + 1)::INT] AS currency, ['Monthly', 'Annual', 'Annual', 'Monthly', 'Hourly', NULL][(o_orderkey % 6 + 1)::INT] AS period FROM orders""")
def salary_labels(spark: SparkSession, d: str) -> DataFrame:
    n, rest = F.floor("o_totalprice").cast("long"), F.col("o_orderkey") % 6
    money = lambda c: F.regexp_replace(F.format_number(c, 0), r"\.$", "")
    label = (
        F.when(rest == 0, F.concat(F.lit("HK$"), money(n), F.lit(" – HK$"), money(n * 2), F.lit(" per month + 5% bonus"))).when(rest == 1, F.concat(F.lit("US$"), money(n), F.lit(" to $"), money(n + 1), F.lit(" p.a.")))
        .when(rest == 2, F.concat(F.lit("Up to $"), money(n * 2), F.lit(" per annum"))).when(rest == 3, F.concat(F.lit("from ฿"), money(n), F.lit(" monthly")))
        .when(rest == 4, F.concat(F.lit("$"), money(n), F.lit(" - $"), money(n * 2), F.lit(" per hour"))).otherwise(F.concat(F.lit("S$"), money(n), F.lit(" ~ S$"), money(n * 2)))
    )
    return read(spark, d, "orders").select("o_orderkey", standard.pay(label, F.when(rest == 2, "aud")).alias("s")).select("o_orderkey", "s.*")


_TITLE = "CASE p_size % 6 WHEN 0 THEN 'Sales/Assistants' WHEN 1 THEN 'Software sales  assistant' WHEN 2 THEN 'Data Entries Clerk' WHEN 3 THEN 'Data-entry, then data' WHEN 4 THEN 'Deputy Secretaries' ELSE 'Salesassistant' END"


@query(f"""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '''sales assistant'' in the title: not tech' WHEN 2 THEN '''data entry'' in the title: not tech' WHEN 4 THEN '''deputy secretary'' in the title: not tech' END AS reason, CASE p_size % 4 WHEN 0 THEN 'intern' WHEN 1 THEN 'graduate' END AS stage, CASE p_size % 4 WHEN 2 THEN true ELSE false END AS abbreviated FROM part WHERE {_TITLE} IS NOT NULL""")
def title_reasons(spark: SparkSession, d: str) -> DataFrame:
    rest = F.col("p_size") % 4
    staged = F.element_at(F.array(*map(F.lit, ("Summer Intern", "GRAD Programme", "Interns wanted", "Graduate Internship"))), (rest + 1).cast("int"))
    other = F.when(rest == 2, "BE Developer").otherwise("Chef")
    reason = titles.title_reason(F.expr(_TITLE), ["sales assistant", "data entry", "deputy secretary"], ["software", "data"])
    return read(spark, d, "part").select("p_partkey", reason.alias("reason"), titles.stage(staged).alias("stage"), titles.continuous(F.lit("Back-End Developer"), other).alias("abbreviated"))


@query()
def safe_markup(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", markup.safe_html("html").alias("html"))


@query("""SELECT o.doc_id, 4 AS changes FROM documents o WHERE text IS NOT NULL""")
def wording_changes(spark: SparkSession, d: str) -> DataFrame:
    """A text of two lines against one with another first line, and one with another last line."""
    old = F.concat(F.lit("first\nsame "), F.sha2("text", 256), F.lit("\nlast"))
    new = F.concat(F.lit("FIRST!\nsame "), F.sha2("text", 256), F.lit("\nend of it"))
    return read(spark, d, "documents").where("text is not null").select("doc_id", F.size(F.filter(markup.wording_diff(old, new), lambda x: x.rlike("^[-+] "))).alias("changes"))


@query("""SELECT s_suppkey, md5(s_name) AS name FROM supplier ANTI JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 3) USING (s_suppkey) UNION ALL SELECT s_suppkey, 'new' FROM supplier WHERE s_nationkey < 3 AND s_suppkey % 2 = 0""")
def replaced_groups(spark: SparkSession, d: str) -> DataFrame:
    """All rows of some keys give way to new ones, which may be fewer."""
    rows = read(spark, d, "supplier").select("s_suppkey", F.md5("s_name").alias("name"))
    keys = read(spark, d, "supplier").where("s_nationkey < 3").select("s_suppkey")
    return merge.replace_keys(rows, keys, keys.where("s_suppkey % 2 = 0").withColumn("name", F.lit("new")), ["s_suppkey"])


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100""")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    return merge.page_after(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 100)


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 4 = 0 THEN s_name || ' Ltd' WHEN s_nationkey % 4 = 1 THEN 'n' || s_nationkey ELSE 'unknown' END AS name, CASE WHEN s_nationkey % 4 = 0 THEN 'copy' WHEN s_nationkey % 4 = 1 THEN 'nation' ELSE 'none' END AS source FROM supplier""")
def first_known(spark: SparkSession, d: str) -> DataFrame:
    """The first source that knows a company's name wins, and says which it was."""
    k = F.col("s_nationkey") % 4
    sources = {"copy": F.when(k == 0, F.concat("s_name", F.lit(" Ltd"))), "nation": F.when(k <= 1, F.concat(F.lit("n"), "s_nationkey"))}
    return read(spark, d, "supplier").select("s_suppkey", names.first_known(sources, "unknown").alias("k")).select("s_suppkey", "k.name", "k.source")


@query()
def shingle_identities(spark: SparkSession, d: str) -> DataFrame:
    """BLAKE2b ids of the five-word strings of each text."""
    doc = text.document(F.lit(None).cast("string"), F.col("text"))
    return read(spark, d, "documents").select("doc_id", text.shingle_ids(doc).alias("ids"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN ['Jane Doe'] WHEN 1 THEN ['Ann Lee Tan'] WHEN 2 THEN [] ELSE ['Bob Ray', 'Cy Dee'] END AS names, CASE WHEN c_custkey % 4 = 3 THEN ['a.b@x.test', 'c@y.test'] ELSE [] END AS emails,
CASE c_custkey % 3 WHEN 0 THEN 'Wei Ming Tan' WHEN 1 THEN 'TAN WEI' ELSE 'Wei Tan' END AS turned, CASE c_custkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' END AS kind FROM customer""")
def printed_contacts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    said = F.element_at(F.array(*map(F.lit, ("Please contact: Senior Consultant Jane Doe today", "Ann Lee Tan | EA Reg No: R1234567", "contact Our Team at once", "speak to Mr. Bob Ray or email CV to Cy Dee: a.b@x.test, c@y.test a.b@x.test"))), (k % 4 + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, ("TAN Wei Ming", "TAN WEI", "Wei Tan"))), (k % 3 + 1).cast("int"))
    value = F.element_at(F.array(*map(F.lit, (" a@b.co ", "6123 4567", " "))), (k % 3 + 1).cast("int"))
    return read(spark, d, "customer").select("c_custkey", contacts.names_in(said).alias("names"), contacts.printed_addresses(said).alias("emails"), contacts.surname_last(name).alias("turned"), contacts.contact(F.lit(None).cast("string"), value)["kind"].alias("kind"))


@query("""SELECT s_suppkey, s.place, s.name, s.designation, CASE s.place WHEN 0 THEN 'Dept ' || s_nationkey END AS department, s.phone, s.email FROM supplier, (VALUES (0, 'Wei Tan', 'Head & Lead', '6123', 'w@x.test'), (1, 'Jane Doe', NULL, NULL, NULL)) s(place, name, designation, phone, email)""")
def directory_officers(spark: SparkSession, d: str) -> DataFrame:
    agency = lambda c: F.concat(F.lit('<p class="col-md-12 title"><a href=x>'), c, F.lit("</a></p>"))
    first = F.concat(F.lit('<li class="type-d"><span class="fa-user"></span><a href=y>Mr TAN Wei, PBM</a>'), agency(F.lit("Ministry")), agency(F.concat(F.lit("Dept "), "s_nationkey")), F.lit('<p class="col-md-6 title">Head  &amp; Lead</p><span class="fa-phone"></span> 6123 <br><span class="fa-envelope"></span><span>w@x.test<</li>'))
    second = F.concat(F.lit('<li class="type-d"><span class="fa-user"></span><a href=z>Jane Doe</a>'), agency(F.lit("Ministry")), F.lit('</li><li class="type-d">nobody</li>'))
    return contacts.officers(read(spark, d, "supplier").select("s_suppkey", F.concat(first, second).alias("html")), "s_suppkey", "html")


@query("""SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'x' WHEN 1 THEN 'instagram' WHEN 2 THEN 'personal_site' END AS kind, CASE s_suppkey % 6 WHEN 0 THEN '@janed' WHEN 1 THEN 'jane.d' WHEN 2 THEN 'janedoe.dev' END AS value FROM supplier""")
def accounts_on_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = ("https://twitter.com/janed/status/1", "http://www.instagram.com/jane.d?x=1", "https://janedoe.dev/about", "https://x.com/search", "https://linkedin.com/in/janedoe", "https://x.com/other")
    url = F.element_at(F.array(*map(F.lit, pages)), (F.col("s_suppkey") % 6 + 1).cast("int"))
    title = F.when(F.col("s_suppkey") % 6 == 5, "Somebody else").otherwise("JANE DOE - posts")
    found = contacts.account(url, title, F.lit("Jane Doe"))
    return read(spark, d, "supplier").select("s_suppkey", found["kind"].alias("kind"), found["value"].alias("value"))


@query("""WITH r AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'github' WHEN 'click' THEN 'mobile' WHEN 'error' THEN 'other' ELSE 'x' END AS kind, 'v' || floor(value / 50)::INT AS value, min(event_id) AS spot FROM events GROUP BY 1, 2, 3)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE kind WHEN 'mobile' THEN 1 WHEN 'github' THEN 2 WHEN 'x' THEN 3 ELSE 9 END, spot, value) AS place, kind, value FROM r""")
def ordered_channels(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "github").when(F.col("event_type") == "click", "mobile").when(F.col("event_type") == "error", "other").otherwise("x")
    rows = read(spark, d, "events").select("user_id", F.col("event_id").alias("at"), kind.alias("kind"), F.concat(F.lit("v"), F.floor(F.col("value") / 50).cast("int")).alias("value"))
    return contacts.ordered_channels(rows, "user_id")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 'valid_mailbox_found' ELSE 'valid_mailbox_built' END WHEN 1 THEN 'no_mailbox' ELSE CASE WHEN o_custkey % 4 = 0 THEN 'unchecked_seen_online' WHEN o_custkey % 4 = 2 THEN CASE WHEN o_custkey % 8 = 2 THEN 'unchecked_seen_online' ELSE 'pattern_guess' END ELSE 'unchecked_our_guess' END END AS kind FROM orders""")
def email_kinds(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_custkey")
    status = F.when(F.col("o_orderkey") % 3 == 0, "valid").when(F.col("o_orderkey") % 3 == 1, "invalid")
    return read(spark, d, "orders").select("o_orderkey", contacts.email_kind(k % 4 == 0, k % 4 == 2, status, k % 8 == 2).alias("kind"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Early ' || c_custkey WHEN 1 THEN c_mktsegment WHEN 2 THEN 'Copy' WHEN 3 THEN c_name END AS name, CASE c_custkey % 5 WHEN 0 THEN 'earlier_linkedin_listing' WHEN 1 THEN 'linkedin_company_id' WHEN 2 THEN 'linkedin_copy_name' WHEN 3 THEN 'listing_name' END AS found_by FROM customer""")
def identified_companies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    rows = read(spark, d, "customer").select(
        "c_custkey", F.when(k == 1, F.col("c_mktsegment")).when(k == 4, "Confidential").otherwise(F.col("c_name")).alias("own_name"), F.when(k == 2, "Copy").alias("copy_name"), F.when(k == 1, "77").alias("company_id"), F.when(k <= 0, F.concat(F.lit("Early "), "c_custkey")).alias("earlier_name")
    )
    return contacts.company(rows, "c_custkey")


@query("""SELECT s_suppkey, 'jdoe@x.test' AS email, CASE s_nationkey % 3 WHEN 0 THEN 'Jane Doe' WHEN 1 THEN 'John Doe' END AS name FROM supplier""")
def address_owners(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "supplier")
    k = F.col("s_nationkey") % 3
    found = F.when(k == 0, F.array(F.lit("Ann Lee"), F.lit("Jane Doe"), F.lit("John Doe"))).when(k == 1, F.array(F.lit("John Doe"), F.lit("Jane Doe"))).otherwise(F.array(F.lit("Ann Lee")))
    named = rows.select("s_suppkey", F.posexplode(found).alias("place", "name"))
    return contacts.owners(rows.select("s_suppkey", F.lit("jdoe@x.test").alias("email")), named, "s_suppkey")
