"""What several operators of this subpackage share: the shared folder, cuts of lineage, word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut, dropped, shared_dir, stored  # noqa: F401  operators take them from here

#: Words are what lies between these bytes: U+0020 and U+0009 to U+000D. bytes.split() parts at just these.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that a function over batches gets at once, at most.
SLICE = 1_000


def mapped(df: DataFrame, f, schema: str) -> DataFrame:
    """mapInArrow with a function from one batch of at most SLICE rows to batches."""

    def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield from f(batch.slice(at, SLICE))

    return df.mapInArrow(each, schema)


def docs_of(df: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the whole text as UTF-8 bytes (null: empty), and the columns to keep."""
    return df.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *keep)


def one_text(docs: DataFrame, picked: DataFrame, *keep: str) -> DataFrame:
    """doc_id, text (as docs_of()) and the columns to keep of the documents picked (doc_id and those columns, a bounded number), one row each: the least text where rows share a doc_id."""
    rows = docs_of(docs.select("doc_id", "text")).join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", *keep).agg(F.min("text").alias("text")).select("doc_id", "text", *keep)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_hash_order(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """The first `bound` rows in the order of a hash of their distinct keys.

    Keys beyond one and a half times the bound's share of the hash's range are dropped before sorting, so what meets in one task is about that many rows from however many partitions.
    """
    n = rows.count()
    if n > 2 * bound:
        near = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * (1.5 * bound / n) + 1))
        rows = near if near.count() >= bound else rows
    return rows.orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 40)), key).limit(bound)
