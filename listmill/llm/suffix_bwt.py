"""Suffix-array dedup: merged Burrows-Wheeler transforms of shards show which byte strings of a given length repeat.

Each shard's suffixes are sorted once, which gives its transform (what stands before each suffix, in suffix order) and its
steps from a suffix to the longer one. Shards are then merged without sorting suffixes again, by refining how they interleave:
if the interleaving sorts all suffixes by their first h bytes, dealing its entries stably into buckets by the byte before each sorts them by h + 1 bytes.
Where neighbours fall apart in a round, their common prefix ends. After q rounds the intervals that still hang together number the strings of q bytes, in order,
so from then on a round can deal by the q bytes before each entry and go q bytes further (q is 5, then 20, then 100). At a depth of `length`, the intervals left are
the repeated ones: the suffixes that share `length` bytes.

What repeats anywhere in the corpus meets in one merge because texts are cut into segments by anchor first (see repeats).

Defined results of `removed`: null text is the empty text; texts shorter than the window lose nothing; rows with equal texts, also of one
doc_id, are documents of their own and repeat each other; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import common
from .repeats import Kind, merged, repeated

#: Bytes in a shard whose suffixes are sorted by themselves.
SHARD = 1 << 16


class Shard:
    """Sorted suffixes of some strings, each ended by a mark of its own that sorts before all bytes."""

    def __init__(self, strings: list[bytes], length: int):
        lengths = np.array([len(s) for s in strings], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        n = int(ends[-1]) + 1
        text = np.zeros(n, np.uint16)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        rank = text.astype(np.int64) + len(strings)
        rank[ends] = np.arange(len(strings))
        depth, top = 1, len(strings) + 300
        while True:
            after = np.zeros(n, np.int64)
            if depth < n:
                after[: n - depth] = rank[depth:] + 1
            both = rank * (top + 2) + after
            order = np.argsort(both)
            ranked = both[order]
            new = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            rank[order] = new
            depth, top = depth * 2, int(new[-1])
            if depth >= length or top == n - 1:
                break
        self.text, self.order = text, order
        self.place = np.empty(n, np.int64)  # of each suffix in the order; what is equal in `length` bytes stands in any order
        self.place[order] = np.arange(n)


#: Depths at which the intervals' numbers are kept, to go on by so many bytes a round: each a multiple of the one before.
STRIDES = (5, 20, 100)


def interleaved(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all suffixes by their first `length` bytes (places in the shards' orders, one after the other), and the bytes that each shares with the one before it, `length` at most (the first: none).

    A suffix that meets a mark within those bytes shares none beyond it.
    """
    base = np.cumsum([0, *(len(s.order) for s in shards)])
    n = int(base[-1])
    text = np.concatenate([s.text for s in shards])
    at = np.concatenate([s.order + b for s, b in zip(shards, base, strict=False)])  # where each suffix begins
    place = np.concatenate([s.place + b for s, b in zip(shards, base, strict=False)])
    marks = np.concatenate([[0], np.cumsum(text == 0)])
    names = {1: text.astype(np.int32)}  # of the strings of so many bytes at each place

    def steps(q: int):
        """The transforms in steps of q: what stands in the q places before each suffix, the suffix that begins there, and whether a suffix meets a mark in its first q places."""
        before = names[q][(at - q) % n]
        alone = marks[np.minimum(at + q, n)] > marks[at]
        return (before & 0xFFFF).astype(np.uint16), (before >> 16).astype(np.uint16) if before.max() > 0xFFFF else None, place[(at - q) % n].astype(np.int32), alone

    order, starts = np.arange(n, dtype=np.int32), np.zeros(n, bool)
    starts[0] = True
    shared = np.full(n, length, np.int32)
    shared[0] = 0
    depth, stride, tables = 0, 0, None
    while depth < length and not starts.all():
        q = max((k for k in names if k <= length - depth), default=1)
        if q != stride:
            stride, tables = q, steps(q)
        low, high, to, alone = tables
        # deal into buckets by what stands before, stably: a radix pass, or two where there are many buckets
        deal = np.argsort(low[order], kind="stable")
        if high is not None:
            deal = deal[np.argsort(high[order[deal]], kind="stable")]
        interval = np.cumsum(starts, dtype=np.int32)[deal]
        old = order[deal]
        order, apart = to[old], starts
        starts = np.empty(n, bool)
        starts[0] = True
        np.not_equal(interval[1:], interval[:-1], out=starts[1:])
        for half in (low, high):
            if half is not None:
                bucket = half[old]
                starts[1:] |= bucket[1:] != bucket[:-1]
        single = alone[order]
        starts |= single
        starts[1:] |= single[:-1]
        new = np.flatnonzero(starts & ~apart)  # these fall apart within the last q bytes
        shared[new] = depth
        left, right = at[order[new - 1]] + depth, at[order[new]] + depth
        for _ in range(q - 1):
            x = text[left % n]
            same = (x == text[right % n]) & (x > 0)
            new, left, right = new[same], left[same] + 1, right[same] + 1
            if not len(new):
                break
            shared[new] += 1
        depth += q
        if depth in STRIDES and depth < length:
            of = np.empty(n, np.int32)
            of[at[order]] = np.cumsum(starts, dtype=np.int32)
            names[depth] = of
    return order, shared


def windows_that_repeat(kind: Kind, variants: list[tuple[bytes, int]]) -> list[list[tuple[int, int]]]:
    """A resolver: for each variant the windows whose bytes also stand at another place of the variants."""
    shards, strings, load = [], [], 0
    for seg, _ in variants:
        strings.append(seg)
        load += len(seg)
        if load >= SHARD:
            shards.append(Shard(strings, kind.length))
            strings, load = [], 0
    if strings:
        shards.append(Shard(strings, kind.length))
    order, shared = interleaved(shards, kind.length)
    tied = shared >= kind.length  # with the one before; an interval is a run of these and the one it begins with
    repeat = tied | np.append(tied[1:], False)
    flags = np.zeros(len(order), bool)
    places = np.concatenate([s.order + b for s, b in zip(shards, np.cumsum([0, *(len(s.order) for s in shards)]), strict=False)])
    flags[places[order[repeat]]] = True
    out, at = [], 0
    for seg, windows in variants:
        on = np.concatenate([[False], flags[at : at + windows], [False]])
        edge = np.flatnonzero(on[1:] != on[:-1])
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
        at += len(seg) + 1
    return out


def removed(docs: DataFrame, length: int = 400, gram: int = 64, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, without each byte covered by a `length`-byte string that also starts anywhere else; with_text: also kept (binary) and spans."""
    found = repeated(docs, Kind(False, length, gram), windows_that_repeat, earlier=False)

    def each(batch):
        unpack, rows = zstandard.ZstdDecompressor(), []
        for doc_id, z, size, whole, spans in zip(*(batch.column(i) for i in range(5)), strict=True):
            text, size = unpack.decompress(z.as_py()), size.as_py()
            gone = [(0, size)] if whole.as_py() else merged(spans.as_py())
            at, parts = 0, []
            for a, b in gone:
                parts.append(text[at:a])
                at = b
            kept = b"".join([*parts, text[at:]])
            row = (doc_id.as_py(), size, size - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept, [{"a": a, "b": b} for a, b in gone]) if with_text else row)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        fields += [("kept", pa.binary()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]
        ddl += ", kept binary, spans array<struct<a: long, b: long>>"
    schema = pa.schema(fields)
    return common.mapped(found.select("doc_id", "z", "size", "whole", "spans"), each, ddl)
