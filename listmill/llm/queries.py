"""The queries op1 to op10 over the synthetic tables, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, mixing, quality, simhash, substring, suffix_bwt, toxicity, vafile, vamana, warc


def vocabulary(path: str | None = None) -> str:
    """The text of a tokenizers file: by default the byte-level one among the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def held(n: int, rest: int):
    """crc32 of doc_id as text, mod n, is rest. A null doc_id has no label to learn from: not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n)) == rest, F.lit(False))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_bwt.removed(common.read(spark, sf_dir, "documents"), with_text=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed(common.read(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(common.read(spark, sf_dir, "documents"), vocabulary())


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.groups(common.read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write(common.read(spark, sf_dir, "pages"), folder)
    return warc.read(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.read(spark, sf_dir, "documents")).drop("source")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    scored = toxicity.scores(docs, toxicity.learn(docs, labels.where(~held(3, 1))))
    return scored.select("doc_id", held(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    scored = quality.scores(docs, quality.learn(docs, labels.where(~held(5, 0))))
    return scored.select("doc_id", held(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_suffix_dedup, op2_substring_dedup, op3_exact_top_k, op4_bpe, op5_simhash, op6_warc, op7_graph_search, op8_mixing, op9_toxicity, op10_quality)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_top_k": OP3, "op8_mixing": OP8}


_WATER = f"""
sized AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size FROM documents),
per AS (SELECT source, sum(size)::DOUBLE AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM sized GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][((place - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0 AS cap FROM per),
leveled AS (SELECT *, ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / weight, place) - cap)) / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
water AS (SELECT arg_min(level, cap / weight * 1e6 + place) AS level FROM leveled WHERE cap / weight > level),
goals AS (SELECT source AS s, place, source_size, CASE WHEN (SELECT level FROM water) IS NULL OR cap <= (SELECT level FROM water) * weight THEN cap ELSE (SELECT level FROM water) * weight END AS target FROM ranked)"""

OP8 = f"""WITH {_WATER},
keyed AS (SELECT doc_id, size, source_size::BIGINT AS source_size, target, place, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM sized JOIN goals ON source IS NOT DISTINCT FROM s),
placed AS (SELECT *, sum(size) OVER (PARTITION BY place ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS whole FROM keyed)
SELECT doc_id, size::BIGINT AS size, source_size, target, (whole * size + greatest(0, least(size, floor(target) - whole * source_size - before)))::BIGINT AS taken FROM placed"""

OP3 = """WITH sound AS (SELECT vec_id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM sound),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""
