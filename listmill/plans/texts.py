"""Documents, pages and benchmark items: fingerprints, shingles, near duplicates, page text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..operators import candidates
from ..operators.components import components
from ..sources.shared import cut
from ..sources.tables import read
from .registry import query

# a text that isn't ASCII counts for matching without words of other letters than Latin ones, and without lines that have none
_LINES = r"list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '\S*[^\P{L}\p{Latin}]\S*', ' ', 'g'))"
_USED = rf"CASE WHEN regexp_matches(text, '[^\x00-\x7F]') THEN array_to_string(list_filter({_LINES}, lambda l: regexp_matches(l, '\p{{Latin}}')), ' ') ELSE text END"
_DOC = rf"nullif(lower(trim(regexp_replace({_USED}, '\s+', ' ', 'g'))), '')"


def doc():
    return text.document(F.lit(None).cast("string"), F.col("text"))


@query(f"""WITH f AS (SELECT doc_id, sha256({_DOC}) AS fingerprint FROM documents) SELECT fingerprint, min(doc_id) AS canonical_id, count(*) AS n FROM f WHERE fingerprint IS NOT NULL GROUP BY 1""")
def exact_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", text.fingerprint(doc()).alias("fingerprint")).where("fingerprint is not null")
    return rows.groupBy("fingerprint").agg(F.min("doc_id").alias("canonical_id"), F.count("*").alias("n"))


_SHINGLES = "CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END"


@query(f"""WITH w AS (SELECT doc_id, string_split({_DOC}, ' ') AS w FROM documents), s AS (SELECT doc_id, {_SHINGLES} AS s FROM w) SELECT doc_id, coalesce(len(s), 0) AS shingles FROM s""")
def shingle_counts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.coalesce(F.size(text.shingles(doc())), F.lit(0)).alias("shingles"))


@query(f"""WITH w AS (SELECT doc_id AS id, string_split({_DOC}, ' ') AS w FROM documents), s AS (SELECT id, {_SHINGLES} AS s FROM w), b AS (SELECT item_id, string_split({_DOC}, ' ') AS w FROM benchmark), bs AS (SELECT item_id, {_SHINGLES} AS s FROM b),
e AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s), be AS (SELECT item_id, len(s) AS m, unnest(s) AS x FROM bs) SELECT item_id, id AS doc_id, round(count(*) / max(m), 6) AS share FROM be JOIN e USING (x) GROUP BY ALL HAVING count(*) / max(m) >= 0.3""")
def benchmark_containment(spark: SparkSession, d: str) -> DataFrame:
    item = read(spark, d, "benchmark").select("item_id", text.shingles(doc()).alias("s")).select("item_id", F.size("s").alias("m"), F.explode("s").alias("x"))
    rows = read(spark, d, "documents").select("doc_id", F.explode(text.shingles(doc())).alias("x"))
    met = rows.join(item, "x").groupBy("item_id", "doc_id").agg(F.count("*").alias("n"), F.max("m").alias("m"))
    return met.where("n / m >= 0.3").select("item_id", "doc_id", F.round(F.col("n") / F.col("m"), 6).alias("share"))


def signed(spark: SparkSession, d: str) -> DataFrame:
    """fp, doc_id (the least of its texts), s (shingle hashes), signature: one row for each different text."""
    rows = read(spark, d, "documents").select("doc_id", doc().alias("doc")).where("doc is not null")
    one = rows.groupBy(text.fingerprint(F.col("doc")).alias("fp")).agg(F.min("doc_id").alias("doc_id"), F.min("doc").alias("doc"))
    hashed = one.select("fp", "doc_id", F.transform(text.shingles(F.col("doc")), lambda x: F.xxhash64(x)).alias("s"))
    return cut(hashed.withColumn("signature", candidates.signature("s")))


def alike(rows: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """a, b, jaccard of the pairs that reach a similarity."""
    side = lambda n: rows.select(F.col("doc_id").alias(n), F.array_distinct("s").alias(f"s{n}"))
    found = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", text.jaccard(F.col("sa"), F.col("sb")).alias("jaccard"))
    return found.where(F.col("jaccard") >= least)


@query()
def minhash_lsh_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = signed(spark, d)
    return alike(rows, candidates.band_pairs(rows, "doc_id"), 0.0)


@query()
def near_duplicate_components(spark: SparkSession, d: str) -> DataFrame:
    rows = signed(spark, d)
    keys = candidates.bands(rows, "doc_id")
    found = components(candidates.grouping_links(keys, "doc_id", lambda pairs: alike(rows, pairs, 0.70).select("a", "b")))
    return rows.select("fp", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("component", "doc_id").alias("canonical_id"))


_SCRIPTS = (("Thai", "[^\\p{Thai}]"), ("Japanese", "[^\\p{Hiragana}\\p{Katakana}]"), ("Korean", "[^\\p{Hangul}]"), ("Chinese", "[^\\p{Han}]"), ("Arabic", "[^\\p{Arabic}]"), ("Cyrillic", "[^\\p{Cyrillic}]"))
_PER_SCRIPT = ", ".join(f"{{'n': length(regexp_replace(foreign_, '{x}', '', 'g')), 'name': '{name}'}}" for name, x in _SCRIPTS)


@query(f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') || CASE WHEN doc_id % 5 = 0 THEN repeat(' Привет мир', doc_id::INT % 200) WHEN doc_id % 5 = 1 THEN repeat(' 漢字仮名かな', doc_id::INT % 300) WHEN doc_id % 5 = 2 THEN repeat(' สวัสดี', doc_id::INT % 100) ELSE '' END AS t FROM documents),
l AS (SELECT *, length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS letters, regexp_replace(t, '[^\\p{{L}}]|\\p{{Latin}}', '', 'g') AS foreign_, regexp_extract_all(t, '[A-Za-z]+') AS words FROM d),
s AS (SELECT *, list_sort([{_PER_SCRIPT}], 'DESC')[1] AS most FROM l)
SELECT doc_id, lang, CASE WHEN letters >= 200 AND length(foreign_) * 5 >= letters * 2 THEN 'JD not in English: ' || (length(foreign_) * 100 // letters) || '% ' || CASE WHEN most.n > 0 THEN most.name ELSE 'non-Latin' END || ' letters'
WHEN len(words) >= 60 AND len(list_filter(words, lambda w: lower(w) IN {text.COMMON})) * 15 < len(words) THEN 'JD not in English: few common English words' END AS reason FROM s""")
def language_script_filter(spark: SparkSession, d: str) -> DataFrame:
    n, more = F.col("doc_id").cast("int"), F.lit("")
    for rest, word, most in ((0, " Привет мир", 200), (1, " 漢字仮名かな", 300), (2, " สวัสดี", 100)):
        more = F.when(F.col("doc_id") % 5 == rest, F.repeat(F.lit(word), n % most)).otherwise(more)
    return read(spark, d, "documents").select("doc_id", "lang", text.not_english(F.concat(F.coalesce("text", F.lit("")), more)).alias("reason"))


@query(r"""WITH d AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'Привет 12' || chr(10) || 'né мир 7' WHEN 2 THEN '漢字かな 100' END AS text FROM documents)
SELECT doc_id, sha256(coalesce(""" + _DOC + r""", '')) AS digest, """ + _DOC + r""" IS NULL AS nothing FROM d""")
def latin_matching_text(spark: SparkSession, d: str) -> DataFrame:
    rest = F.col("doc_id") % 4
    made = F.when(rest == 0, F.col("text")).when(rest == 1, F.concat("text", F.lit("\nПривет 12\nné мир 7"))).when(rest == 2, "漢字かな 100")
    rows = read(spark, d, "documents").select("doc_id", text.document(F.lit(None).cast("string"), made).alias("doc"))
    return rows.select("doc_id", F.sha2(F.coalesce("doc", F.lit("")), 256).alias("digest"), F.col("doc").isNull().alias("nothing"))


@query(f"""WITH w AS (SELECT doc_id, string_split({_DOC}, ' ') AS w FROM documents), s AS (SELECT min(doc_id) AS doc_id, s FROM (SELECT doc_id, list_sort({_SHINGLES}) AS s FROM w WHERE w IS NOT NULL) GROUP BY s),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s) SELECT a.doc_id AS a, b.doc_id AS b, round(count(*) / (max(a.n) + max(b.n) - count(*)), 6) AS jaccard FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING count(*) / (max(a.n) + max(b.n) - count(*)) >= 0.5""")
def shingle_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", text.shingles(doc()).alias("s")).where("s is not null")
    return candidates.similar_sets(rows, "doc_id", "s", 0.5).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query()
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    got = html.normalized("html")
    return read(spark, d, "pages").select("page_id", got.alias("got")).select("page_id", "got.text", "got.reason")


@query()
def page_structure(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", html.structure("html").alias("s")).select("page_id", "s.*")


@query(r"""WITH h AS (SELECT page_id, regexp_replace(nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), ''), '^www\.', '') AS host FROM pages), l AS (SELECT *, string_split(host, '.') AS p FROM h)
SELECT page_id, host, array_to_string(CASE WHEN len(p) >= 3 AND length(p[-1]) = 2 AND p[-2] IN ('com', 'co', 'org', 'net', 'edu', 'gov', 'ac') THEN p[-3:] ELSE p[-2:] END, '.') AS domain FROM l""")
def url_domains(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.domain(F.col("url")).alias("domain"))
