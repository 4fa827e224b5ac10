"""JSON under fixed schemas: a value that doesn't fit fails the load."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STRICT = {"mode": "FAILFAST"}


def lines(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON lines, gzip or not."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(folder)


def rows_of(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A row for each member of a column of JSON arrays."""
    return df.select(F.inline(F.from_json(column, f"array<struct<{schema}>>", STRICT)))


def append_with_run(prior: DataFrame, pairs: DataFrame, run_id: str) -> DataFrame:
    """Rows of earlier runs (pairs: board_job_id, prior_run_id) under a new run's id. A pair without its one row is an error."""
    wanted = pairs.select("board_job_id", F.col("prior_run_id").alias("run_id"))
    found = prior.join(wanted, ["board_job_id", "run_id"])
    if (n := wanted.count()) != (m := found.count()):
        raise ValueError(f"{n} rows are to be copied, {m} were found")
    return found.withColumn("run_id", F.lit(run_id)).select(*prior.columns)


def write_payloads(df: DataFrame, folder: str) -> None:
    """content_hash, payload: gzip text by hash, each hash once."""
    df.dropDuplicates(["content_hash"]).select("content_hash", "payload").write.mode("append").option("compression", "gzip").partitionBy("content_hash").text(folder)


def canonical(value) -> str:
    """Sorted keys, no spaces, letters as they are: the same value has the same bytes."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def content_hash(value) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def kind(value: Column) -> Column:
    """object, array, string, number, boolean or null of a JSON text, by its first character."""
    first = F.substring(F.ltrim(value), 1, 1)
    known = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null")
    return F.when(value.isNotNull(), F.coalesce(known, F.lit("number")))


def field_of_each(array: Column, name: str) -> Column:
    """A field of each struct of an array, null-safe."""
    return F.transform(array, lambda x: x[name])


def unresolved(rows: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, problem: answers whose key wasn't asked or came twice, and keys without an answer."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    both = counts.join(expected.select(key).distinct().withColumn("_asked", F.lit(True)), key, "full_outer")
    problem = F.when(F.col("_asked").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return both.select(key, problem.alias("problem")).where("problem is not null")
