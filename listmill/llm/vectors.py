"""What vector searches share: which rows take part, query blocks, and the merge of nearest lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import dropped, shared_dir, stored

#: Queries in a block, and bytes of query blocks that are sent to all tasks at once: more blocks are searched in further passes.
QUERY_ROWS, SENT_BYTES = 256, 16 << 20


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, v: rows with an id and a vector without null or non-finite components."""
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select("vec_id", F.size("embedding").alias("dim"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.col("dim") > 0) & sound)


def matrix(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """dim, ids, vectors: up to `size` rows of one dim in each block, as bytes."""

    def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for i, d, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(d, []).append((i, v))
                if len(held[d]) == size:
                    yield pack(d, held.pop(d))
        for d, got in held.items():
            yield pack(d, got)

    def pack(d, got):
        return pa.record_batch({"dim": pa.array([d], pa.int32()), "ids": [np.array([x[0] for x in got], np.int64).tobytes()], "vectors": [np.array([x[1] for x in got], np.float64).tobytes()]})

    return rows.select("vec_id", "dim", "v").mapInArrow(each, "dim int, ids binary, vectors binary")


Search = Callable[[dict, np.ndarray, np.ndarray, list | None], list]


def nearest(index: DataFrame, queries: DataFrame, k: int, search: Search, score: str) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best over all rows of the index.

    index: rows with dim and what `search` needs. search(row, query ids, query vectors, best): best is a (scores, ids) list so far for each
    query, best first; it returns the list after the row. Query blocks go to all tasks, SENT_BYTES at a time, and a pass over the index reads each of its rows once
    for all of them; a task keeps k rows a query, which are appended to one table, so the plan doesn't grow with the passes.
    """
    spark = index.sparkSession
    asked = stored(blocks(queries, QUERY_ROWS).withColumn("block", F.monotonically_increasing_id()), "vectors-queries")
    sizes = sorted((r.block, r.size) for r in asked.select("block", (F.length("ids") + F.length("vectors")).alias("size")).collect())  # a number for QUERY_ROWS queries
    passes, load = [[]], 0
    for block, size in sizes:
        if load and load + size > SENT_BYTES:
            passes.append([])
            load = 0
        passes[-1].append(block)
        load += size
    kind = pa.int64() if score == "long" else pa.float64()
    schema, folder = f"query_id long, vec_id long, score {score}", f"{shared_dir(spark)}/vectors-found-{uuid.uuid4().hex}"
    for some in passes:
        sent = spark.sparkContext.broadcast([(r.dim, r.ids, r.vectors) for r in asked.where(F.col("block").between(some[0], some[-1])).collect()] if some else [])  # SENT_BYTES and a block at most

        def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
            asked_here = [(d, np.frombuffer(i, np.int64), np.frombuffer(v).reshape(-1, d)) for d, i, v in sent.value]  # noqa: B023  this pass's
            best = [[([], [])] * len(ids) for _, ids, _ in asked_here]
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    for n, (d, ids, v) in enumerate(asked_here):
                        if d == row["dim"]:
                            best[n] = search(row, ids, v, best[n])
            for (_, ids, _), lists in zip(asked_here, best, strict=True):
                q = np.repeat(ids, [len(x[0]) for x in lists])
                yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array([i for x in lists for i in x[1]], pa.int64()), "score": pa.array([s for x in lists for s in x[0]], kind)})

        index.mapInArrow(each, schema).write.mode("append").parquet(folder)
        sent.destroy()
    dropped(asked)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(folder)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
