"""Substring dedup: suffix automata of reference shards, and documents streamed through them for matching statistics.

A shard's automaton has a state for each set of word strings that end at the same places; each state knows the earliest such place. While a
document is streamed, the automaton keeps the longest string that ends here and stands in the shard (the matching statistic). Where that
is a window or more, the state of the window itself tells its earliest place; if that is before the document's own, the window's words go.

The whole corpus is the reference, so its automata have no size bound and can't be broadcast: instead, what can repeat is cut into segments by anchor
(see repeats), shards are made of whole anchors' segments, and documents' segments go to the shards of their anchors.

Defined results of `removed`: null text has no words; texts with fewer words than a window lose nothing; of rows with equal texts, also of one
doc_id, the first stays; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .repeats import Kind, merged, repeated


class Automaton:
    """Suffix automaton of several word sequences; strings don't run from one into the next."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [1 << 62]

    def add(self, words: list, at: int) -> None:
        """Words whose first stands at place `at`; sequences come in the order of their places."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for place, w in enumerate(words, at):
            if (q := nxt[last].get(w)) is not None:  # as another sequence went before
                if length[q] == length[last] + 1:
                    last = q
                    continue
                last = self._split(last, w, q)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            first.append(place)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = cur

    def _split(self, p: int, w, q: int) -> int:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        copy = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        first.append(first[q])
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def statistics(self, words: list, window: int):
        """For each word: the length of the longest string that ends at it and is in the automaton, and the earliest end of the window that ends at it (None if it isn't in it)."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state, size, at = 0, 0, 0  # at: the state of the last `window` words, once there are so many
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if (to := nxt[state].get(w)) is not None:
                state, size = to, size + 1
            if size < window:
                yield size, None
                continue
            at = state if size == window else nxt[at][w]
            while length[link[at]] >= window:
                at = link[at]
            yield size, first[at]


def windows_seen_before(kind: Kind, variants: list[tuple[bytes, int]]) -> list[list[tuple[int, int]]]:
    """A resolver: for each variant the windows whose words also start at an earlier place."""
    reference, at, sequences = Automaton(), 0, []
    for seg, _ in variants:
        words = seg.split()
        sequences.append((words, at))
        reference.add(words, at)
        at += len(words)
    out = []
    for words, at in sequences:
        spans: list[tuple[int, int]] = []
        for i, (_, end) in enumerate(reference.statistics(words, kind.length)):
            if end is not None and end < at + i:
                start = i - kind.length + 1
                if spans and spans[-1][1] == start:
                    spans[-1] = (spans[-1][0], start + 1)
                else:
                    spans.append((start, start + 1))
        out.append(spans)
    return out


def _kept(docs: DataFrame, window: int, gram: int, keep: bool, schema: pa.Schema, ddl, row) -> DataFrame:
    found = repeated(docs, Kind(True, window, gram), windows_seen_before, earlier=True, keep=keep)
    names = ["doc_id", "z", "size", "whole", "spans", *["rest"] * keep]

    def each(batch):
        unpack, rows = zstandard.ZstdDecompressor(), []
        for doc_id, z, size, whole, spans in zip(*(batch.column(i) for i in range(5)), strict=True):
            text, size = unpack.decompress(z.as_py()), size.as_py()
            gone = [(0, size)] if whole.as_py() else merged(spans.as_py())
            words, at, parts = text.split(), 0, []
            for a, b in gone:
                parts += words[at:a]
                at = b
            rows.append(row(doc_id.as_py(), text, size, gone, [*parts, *words[at:]]))
        made = pa.RecordBatch.from_pylist(rows, schema=schema)
        yield pa.record_batch([*made.columns, batch.column(5)], names=[*schema.names, "rest"]) if keep else made

    return common.mapped(found.select(*names), each, ddl)


def removed(docs: DataFrame, window: int = 20, gram: int = 8) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, without each word covered by a window that also starts earlier."""

    def row(doc_id, text, size, gone, kept):
        return {"doc_id": doc_id, "n_words": size, "n_removed": size - len(kept), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    return _kept(docs, window, gram, False, schema, "doc_id long, n_words long, n_removed long, kept_sha256 string", row)


def without_repeats(docs: DataFrame, window: int = 20, gram: int = 8) -> DataFrame:
    """docs with all their columns, and their texts without what repeats: texts that lose nothing stay byte for byte, of others stay the kept words, joined by one space. n_chars, if there, follows the text."""

    def row(doc_id, text, size, gone, kept):
        return {"text": (b" ".join(kept) if gone else text).decode("utf-8", "replace")}

    rest = T.StructType([f for f in docs.schema if f.name != "text"])
    out = _kept(docs, window, gram, True, pa.schema([("text", pa.string())]), T.StructType([T.StructField("text", T.StringType()), T.StructField("rest", rest)]), row)
    was = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*(was[c].alias(c) if c in was else F.col("rest")[c].alias(c) for c in docs.columns))
