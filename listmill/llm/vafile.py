"""Exact top-k by vector-approximation files.

Each block of vectors has an approximation beside it: every component's cell among CELLS, cut at the block's quantiles, with the least
and greatest value in each cell. A query scans the cells, which give each vector a lower and an upper bound of its inner product, and drops
those whose upper bound is below the kth lower bound or the kth score so far; the rest's exact vectors are read in the order of their
upper bounds until the kth score is above the next bound.

Defined results: vectors that are null, empty, without id, or with null or non-finite components take no part; a query's candidates are the
vectors of its own length with another vec_id; rows that repeat a vec_id are candidates each, and queries that repeat one are one list; fewer
than k candidates give as many rows; scores beyond a long are held at its ends; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, vectors

CELLS, BLOCK_ROWS, READ = 16, 4096, 64


def approximations(rows: DataFrame) -> DataFrame:
    """dim, ids, vectors, cells, low, high: blocks and their approximations."""

    def each(batch):
        for row in batch.to_pylist():
            d = row["dim"]
            x = np.frombuffer(row["vectors"]).reshape(-1, d)
            cuts = np.quantile(x, np.arange(1, CELLS) / CELLS, axis=0)
            cells = np.zeros(x.shape, np.uint8)
            for c in cuts:
                cells += x > c
            low, high = np.full((CELLS, d), np.inf), np.full((CELLS, d), -np.inf)
            for j in range(CELLS):
                here = cells == j
                low[j], high[j] = np.where(here, x, np.inf).min(0), np.where(here, x, -np.inf).max(0)
            low[~np.isfinite(low)], high[~np.isfinite(high)] = 0, 0
            yield pa.record_batch({"dim": pa.array([d], pa.int32()), "ids": [row["ids"]], "vectors": [row["vectors"]], "cells": [cells.tobytes()], "low": [low.tobytes()], "high": [high.tobytes()]})

    return common.mapped(vectors.blocks(rows, BLOCK_ROWS), each, "dim int, ids binary, vectors binary, cells binary, low binary, high binary")


def exact(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products of whole numbers held in doubles."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q) < 2.0**53:
        return (x @ q).astype(np.int64).tolist()
    return [max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(row, q, strict=True)))) for row in x]


def search(k: int):
    """A search of one block for vectors.nearest."""

    def block(row: dict, ids: np.ndarray, asked: np.ndarray, best: list) -> list:
        d = row["dim"]
        names, x = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(-1, d)
        if "bounds" not in row:  # once for all query blocks
            cells, each = np.frombuffer(row["cells"], np.uint8).reshape(-1, d), np.arange(d)
            row["bounds"] = tuple(np.frombuffer(row[c]).reshape(CELLS, d)[cells, each] for c in ("low", "high"))
        low, high = row["bounds"]
        plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
        upper, lower = plus @ high.T + minus @ low.T, plus @ low.T + minus @ high.T
        slack = 1e-12 * (np.abs(asked) @ np.maximum(np.abs(low), np.abs(high)).T)
        upper, lower = upper + slack, lower - slack
        out = []
        for q in range(len(ids)):
            scores, found = best[q]
            other = names != ids[q]
            least = np.where(other, lower[q], -np.inf)
            floor = np.partition(least, -k)[-k] if len(least) >= k else -np.inf
            floor = max(floor, scores[k - 1]) if len(scores) >= k else floor
            near = np.flatnonzero((upper[q] >= floor) & other)
            near = near[np.argsort(-upper[q][near], kind="stable")]
            top = list(zip((-s for s in scores), found, strict=True))
            for i in range(0, len(near), READ):
                if len(top) >= k and -top[k - 1][0] > upper[q][near[i]]:
                    break
                some = near[i : i + READ]
                top = sorted([*top, *zip((-s for s in exact(x[some], asked[q])), names[some].tolist(), strict=True)])[:k]
            out.append(([-s for s, _ in top], [i for _, i in top]))
        return out

    return block


def top_k(table: DataFrame, asked: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score (long): the k highest inner products of whole numbers floor(scale * x), for rows where `asked` holds, against all rows."""
    whole = vectors.valid(table).withColumn("v", F.transform("v", lambda x: _floor(x * F.lit(scale))))
    return vectors.nearest(common.cut(approximations(whole)), whole.where(asked), k, search(k), "long")


def _floor(x: Column) -> Column:
    """floor() of any finite double as a double; floor() itself ends at a long's range, beyond which doubles are whole."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
