"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

A shard's graph grows in batches: a greedy search on the graph so far proposes neighbours for each new vector; of these, the nearest is kept
and drops every other that is alpha times nearer to it than to the new vector, and so on, which keeps diverse edges; edges are
added backwards too, with the same pruning where a vector has too many. A query runs a beam search on each shard's graph, and the lists merge.

Largest inner product is turned into least distance by one more component, sqrt(M^2 - |x|^2) with M the shard's greatest norm (0 for queries).
Vectors that are equal within a shard are one vertex with several ids. Every row is indexed.

Defined results: vectors that are null, zero, empty, without id, or with null or non-finite components take no part; a query's candidates are the
vectors of its own length with another vec_id; fewer than k candidates give as many rows; ties go to the smaller vec_id; queries that repeat a
vec_id are one list; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, vectors

#: Rows in a shard, about; edges of a vertex; beam of the build and of queries; slack of the pruning (of distances).
SHARD_ROWS, DEGREE, BUILD_BEAM, BEAM, ALPHA = 8192, 32, 64, 96, 1.2
BATCH, AT_ONCE, SEED = 256, 4, 5


def lifted(x: np.ndarray) -> np.ndarray:
    norms = (x * x).sum(1)
    return np.hstack([x, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)


def beam(x: np.ndarray, edges: np.ndarray, start: int, asked: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all of `asked` together: the ids and squared distances of the `width` nearest found, nearest first (-1: none)."""
    b, n = len(asked), len(x)
    seen = np.zeros((b, n), bool)
    seen[:, start] = True
    ids = np.full((b, width), -1, np.int32)
    far = np.full((b, width), np.inf, np.float32)
    done = np.ones((b, width), bool)
    ids[:, 0], done[:, 0] = start, False
    far[:, 0] = ((asked - x[start]) ** 2).sum(1)
    line = np.arange(b)[:, None]
    norms = (x * x).sum(1)
    own = (asked * asked).sum(1)[:, None]
    while not done.all():
        pick = np.argsort(done, axis=1, kind="stable")[:, :AT_ONCE]  # the nearest not yet expanded
        out = ids[line, pick]
        out[done[line, pick]] = -1
        done[line, pick] = True
        near = edges[out].reshape(b, -1)
        near[np.repeat(out < 0, edges.shape[1], axis=1)] = -1
        new = (near >= 0) & ~seen[line, np.maximum(near, 0)]
        order = np.sort(np.where(new, near, n), axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = n  # twice in one step
        near = np.where(order < n, order, -1)
        rows, cols = np.nonzero(near >= 0)
        got = near[rows, cols]
        seen[rows, got] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[rows, cols] = norms[got] - 2 * np.einsum("ij,ij->i", x[got], asked[rows]) + own[rows, 0]
        ids, far, done = np.hstack([ids, near]), np.hstack([far, d]), np.hstack([done, near < 0])
        best = np.argsort(far, axis=1, kind="stable")[:, :width]
        ids, far, done = ids[line, best], far[line, best], done[line, best]
        done |= ids < 0
    return ids, far


def pruned(x: np.ndarray, of: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """DEGREE edges at most for each of `of` from its pool (ids, -1: none)."""
    out = np.full((len(of), DEGREE), -1, np.int32)
    for i in range(0, len(of), 128):
        p, c = of[i : i + 128], pool[i : i + 128].copy()
        c[c == p[:, None]] = -1
        c = np.sort(c, axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        v = x[c]
        d = ((v - x[p][:, None]) ** 2).sum(2)
        d[c < 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        line = np.arange(len(p))[:, None]
        c, d, v = c[line, order], d[line, order], v[line, order]
        norms = (v * v).sum(2)
        between = norms[:, :, None] + norms[:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        alive, count = c >= 0, np.zeros(len(p), int)
        for j in range(c.shape[1]):
            take = np.flatnonzero(alive[:, j] & (count < DEGREE))
            if not len(take):
                continue
            out[i + take, count[take]] = c[take, j]
            count[take] += 1
            alive[take] &= ALPHA**2 * between[take, j] > d[take]
    return out


def build(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges (n x DEGREE, -1: none) and the vertex where searches start, the one nearest to the mean."""
    n = len(x)
    edges = np.full((n, DEGREE), -1, np.int32)
    order = np.random.default_rng(SEED).permutation(n).astype(np.int32)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    order = np.concatenate([[start], order[order != start]]).astype(np.int32)
    first = order[: min(n, DEGREE + 1)]
    for p in first:
        edges[p, : len(first) - 1] = first[first != p]
    at = len(first)
    while at < n:
        new = order[at : at + min(BATCH, at)]
        pool, _ = beam(x, edges, start, x[new], BUILD_BEAM)
        edges[new] = pruned(x, new, pool)
        to, back = edges[new].ravel(), np.repeat(new, DEGREE)
        to, back = to[to >= 0], back[to >= 0]
        sort = np.argsort(to, kind="stable")
        to, back = to[sort], back[sort]
        heads, begin, count = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(heads), DEGREE + int(count.max(initial=0))), -1, np.int32)
        wide[:, :DEGREE] = edges[heads]
        wide[np.repeat(np.arange(len(heads)), count), DEGREE + np.arange(len(to)) - np.repeat(begin, count)] = back
        full = (wide >= 0).sum(1) > DEGREE
        fits = np.flatnonzero(~full)
        compact = np.take_along_axis(wide[fits], np.argsort(wide[fits] < 0, axis=1, kind="stable"), axis=1)
        edges[heads[fits]] = compact[:, :DEGREE]
        over = np.flatnonzero(full)
        if len(over):
            edges[heads[over]] = pruned(x, heads[over], wide[over])
        at += len(new)
    return edges, start


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """dim, vectors, edges, start, ids, begins: a row for each shard. A vertex's ids are ids[begins[i]:begins[i + 1]], ascending."""
    sizes = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one number for each length of vector
    shards = F.coalesce(*(F.when(F.col("dim") == d, F.lit(math.ceil(n / shard_rows))) for d, n in sizes.items()), F.lit(1))
    # equal vectors are one vertex, but rows that repeat one vec_id may differ: the vector is part of what deals them
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), shards.cast("long")))
    tasks = sum(math.ceil(n / shard_rows) for n in sizes.values())
    dealt = dealt.repartitionByRange(max(1, tasks), "dim", "shard")  # a task for each shard

    def each(table: pa.Table) -> pa.Table:
        names = np.asarray(table["vec_id"])
        v = np.asarray(table["v"].combine_chunks().flatten()).reshape(len(names), -1)
        v, of = np.unique(v, axis=0, return_inverse=True)
        order = np.lexsort((names, of))
        begins = np.searchsorted(of[order], np.arange(len(v) + 1)).astype(np.int64)
        edges, start = build(lifted(v))
        return pa.table({"dim": pa.array([v.shape[1]], pa.int32()), "vectors": [v.tobytes()], "edges": [edges.tobytes()], "start": pa.array([start], pa.int32()), "ids": [names[order].astype(np.int64).tobytes()], "begins": [begins.tobytes()]})

    return dealt.groupBy("dim", "shard").applyInArrow(each, "dim int, vectors binary, edges binary, start int, ids binary, begins binary")


def search(k: int, width: int = BEAM):
    """A search of one shard for vectors.nearest."""

    def shard(row: dict, ids: np.ndarray, asked: np.ndarray, best: list) -> list:
        v = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
        edges = np.frombuffer(row["edges"], np.int32).reshape(len(v), DEGREE)
        names, begins = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["begins"], np.int64)
        if "lifted" not in row:  # once for all query blocks
            row["lifted"] = lifted(v)
        found, _ = beam(row["lifted"], edges, row["start"], np.hstack([asked, np.zeros((len(asked), 1))]).astype(np.float32), max(width, k + 1))
        out = []
        for q, near in enumerate(found):
            near = near[near >= 0]
            top = list(zip((-s for s in best[q][0]), best[q][1], strict=True))
            for i, s in zip(near.tolist(), (v[near] @ asked[q]).tolist(), strict=True):
                same = names[begins[i] : min(begins[i] + k + 1, begins[i + 1])]
                top += [(-s, int(j)) for j in same if j != ids[q]]
            top = sorted(top)[:k]
            out.append(([-s for s, _ in top], [j for _, j in top]))
        return out

    return shard


def nearest(table: DataFrame, asked: Column, k: int = 20, shard_rows: int = SHARD_ROWS, width: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score (double): about the k largest inner products for rows where `asked` holds, against all rows."""
    rows = vectors.valid(table).where(F.exists("v", lambda x: x != 0))
    return vectors.nearest(common.cut(index(rows, shard_rows)), rows.where(asked), k, search(k, width), "double")
