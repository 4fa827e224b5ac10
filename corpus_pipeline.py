"""A corpus from documents: toxic ones go, one of each group of near copies stays, repeated passages go, sources are mixed to their weights, the mix is encoded.

Each stage takes (spark, docs, sf_dir) with the columns of documents and returns them again; the last returns digests of the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listmill.llm import bpe, common, mixing, queries, simhash, substring, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL can't express learned lexicons, graph components or the encoding.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score is 0.7 or more; labels are learned from as in op9."""
    labels = common.read(spark, sf_dir, "labels").where(~queries.held(3, 1))
    return toxicity.clean(docs.select(*COLUMNS), toxicity.learn(docs, labels), 0.7)


def not_copied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group at a similarity of 0.8 of five-word shingles."""
    return simhash.one_of_each(docs, 0.8, 5).select(*COLUMNS)


def not_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words covered by 20 words that also stand earlier."""
    return substring.without_repeats(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one on a source's border is cut to the words taken."""
    return mixing.mixed(docs.select(*COLUMNS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return bpe.digests(docs, queries.vocabulary())


STAGES = [("toxicity", not_toxic), ("simhash near-dedup", not_copied), ("substring dedup", not_repeated), ("mixing", mixed), ("bpe", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again before the next."""
    docs = common.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.stored(docs, f"pipeline-{i}")
    return docs
