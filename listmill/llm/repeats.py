"""Where texts repeat: the parts that suffix-array dedup and substring dedup share.

A window is a run of `length` symbols (bytes or words) of one text. Each window is given an anchor, the least hash of the `gram`-symbol
strings in it; equal windows have equal anchors, so only windows whose anchor stands at two or more places of the corpus can repeat, and only
windows of one anchor need comparing. Consecutive windows with one anchor are a run; a run's stretch of text is its segment.

1. One pass over the texts keeps each with its row number, its digest and its anchors. Rows with the same text stand for one another.
2. Anchors are counted; those of one place are dropped.
3. Texts with other anchors give their segments' places and digests. Equal segments become one variant, with its places counted.
4. Variants of one anchor are cut from their texts and compared by a resolver (a merged Burrows-Wheeler transform, or a suffix automaton), some anchors at a time.
5. An anchor with more symbols in its variants than a resolver takes is parted. Variants of words go through 2 to 4 again as texts of their own, with anchors of
   longer strings, at last as long as a window, where each window has an anchor to itself. Variants of bytes, whose windows are too many for that, are parted into
   stretches of windows that are counted by their text, from long ones to single windows.
6. The spans found go back to their rows.

Everything that meets in a task is bounded: a text, the variants of some anchors up to `hot` symbols, counts by key. Keys with many rows (an anchor or
a text that a third of the corpus shares) are met by joins between stored tables, which Spark splits where they are skewed, and by partial counts.
Tables are deleted as soon as what reads them is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Symbols of the variants of one anchor that a resolver takes at once, at most, and of several anchors together: an automaton takes some 300 bytes a word, a transform 100 a byte of text.
HOT_WORDS, BIN_WORDS = 150_000, 50_000
HOT_BYTES, BIN_BYTES = 1_000_000, 250_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)


@dataclass(frozen=True)
class Kind:
    """What the symbols are and how long a window and an anchor's string are."""

    words: bool
    length: int
    gram: int

    def longer(self) -> Kind:
        """With anchors of longer strings: half-way to the window, then the window itself."""
        return replace(self, gram=self.length if self.gram > self.length // 2 else (self.gram + self.length) // 2)

    @property
    def whole(self) -> bool:
        return self.gram >= self.length

    @property
    def limits(self) -> tuple[int, int]:
        return (HOT_WORDS, BIN_WORDS) if self.words else (HOT_BYTES, BIN_BYTES)

    def symbols(self, text: bytes):
        return text.split() if self.words else text

    def join(self, symbols) -> bytes:
        return b" ".join(symbols) if self.words else symbols

    def base(self, symbols) -> np.ndarray:
        if self.words:
            digest = xxhash.xxh3_64_intdigest
            return np.fromiter((digest(w) for w in symbols), np.uint64, len(symbols))
        return _BYTES[np.frombuffer(symbols, np.uint8)]


def sliding(x: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x, span = least(x[:-span], x[span:]), 2 * span
    return least(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def hashes(kind: Kind, symbols) -> np.ndarray:
    """Of the gram-symbol string at each place."""
    h, span, i = kind.base(symbols), 1, 0
    while span < kind.gram:
        step = min(span, kind.gram - span)  # the last two strings may overlap
        h = h[:-step] * _ODD[2 * i % len(_ODD)] + h[step:]
        h ^= h >> np.uint64(29)
        h *= _ODD[(2 * i + 1) % len(_ODD)]
        span, i = span + step, i + 1
    return h ^ (h >> np.uint64(32))


def anchors(kind: Kind, symbols) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the hashes at the places that are an anchor of some window."""
    if len(symbols) < kind.length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = hashes(kind, symbols)
    width = kind.length - kind.gram + 1
    of = sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    return of, h[sliding(np.concatenate([pad, of, pad]), width, np.maximum) == h]


def runs(kind: Kind, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run; windows that are anchors themselves stand alone."""
    if kind.whole:
        return np.arange(len(of)), np.arange(len(of))
    edge = np.flatnonzero(of[1:] != of[:-1]) + 1
    return np.concatenate([[0], edge]), np.concatenate([edge, [len(of)]]) - 1


def _rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _twice_at_most(at: np.ndarray) -> np.ndarray:
    """Sorted; what stands three times or more stands twice."""
    at = np.sort(at)
    keep = np.ones(len(at), bool)
    keep[2:] = at[2:] != at[:-2]
    return at[keep].view(np.int64)


def kept_texts(docs: DataFrame, kind: Kind, keep: bool) -> DataFrame:
    """Stored: row, doc_id, z (the text, compressed), digest, size (symbols), anchors (one that stands twice in the text, twice); keep: rest, a struct of the other columns."""

    def each(batch):
        press, out = zstandard.ZstdCompressor(level=1), {"doc_id": [], "z": [], "digest": [], "size": [], "anchors": []}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            symbols = kind.symbols(text)
            out["doc_id"].append(doc_id)
            out["z"].append(press.compress(text))
            out["digest"].append(hashlib.blake2b(kind.join(symbols), digest_size=16).digest())
            out["size"].append(len(symbols))
            out["anchors"].append(_twice_at_most(anchors(kind, symbols)[1]))
        made = _rows(out, schema)
        yield pa.record_batch([*made.columns, batch.column(2)], names=[*schema.names, "rest"]) if keep else made

    schema = pa.schema([("doc_id", pa.int64()), ("z", pa.binary()), ("digest", pa.binary()), ("size", pa.int64()), ("anchors", pa.list_(pa.int64()))])
    ddl = T.StructType.fromDDL("doc_id long, z binary, digest binary, size long, anchors array<long>")
    others = [f for f in docs.schema if f.name != "text"]
    if keep:
        ddl = ddl.add("rest", T.StructType(others))
    texts = common.mapped(common.docs_of(docs, *[F.struct(*(F.col(f.name) for f in others)).alias("rest")] * keep), each, ddl)
    return common.stored(texts.withColumn("row", F.monotonically_increasing_id()), "repeats-texts")


def segments(items: DataFrame, kind: Kind) -> DataFrame:
    """Stored: anchor, key (the segment's digest), item, row, doc_id, at (first window, in the row), windows, places, alone (the anchor stands once in the item)."""
    placed = common.stored(items.select("item", F.explode("anchors").alias("anchor")), "repeats-anchors")
    shared = common.stored(placed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeats-shared")
    found = placed.join(shared, "anchor").groupBy("item").agg(F.collect_set("anchor").alias("found"))
    rows = items.join(found, "item").select("item", "row", "doc_id", "at", "places", "z", "found")

    def each(batch):
        out = {f.name: [] for f in schema}
        unpack = zstandard.ZstdDecompressor()
        for item, row, doc_id, base, places, z, shared_here in zip(*batch.columns, strict=True):
            item, row, doc_id, base, places = item.as_py(), row.as_py(), doc_id.as_py(), base.as_py(), places.as_py()
            symbols = kind.symbols(unpack.decompress(z.as_py()))
            of, at = anchors(kind, symbols)
            first, last = runs(kind, of)
            wanted = np.isin(of[first], shared_here.values.to_numpy().view(np.uint64))
            values, counts = np.unique(at, return_counts=True)
            twice = np.isin(of[first], values[counts > 1]) & (not kind.whole)
            for a, b, m, more in zip(first[wanted].tolist(), last[wanted].tolist(), of[first][wanted].view(np.int64).tolist(), twice[wanted].tolist(), strict=True):
                seg = kind.join(symbols[a : b + kind.length])
                for name, value in (("anchor", m), ("key", hashlib.blake2b(seg, digest_size=16).digest()), ("item", item), ("row", row), ("doc_id", doc_id), ("at", base + a), ("windows", b - a + 1), ("places", places), ("alone", not more)):
                    out[name].append(value)
            if len(out["key"]) > 50_000:
                yield _rows(out, schema)
                out = {f.name: [] for f in schema}
        yield _rows(out, schema)

    schema = pa.schema([("anchor", pa.int64()), ("key", pa.binary()), ("item", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("windows", pa.int64()), ("places", pa.int64()), ("alone", pa.bool_())])
    got = common.stored(common.mapped(rows, each, "anchor long, key binary, item long, row long, doc_id long, at long, windows long, places long, alone boolean"), "repeats-segments")
    common.dropped(placed, shared)
    return got


#: From variants (in the order of their first places: bytes, windows) to the windows of each that repeat: [(from, to)].
Resolver = Callable[[Kind, list[tuple[bytes, int]]], list[list[tuple[int, int]]]]

PLACE = "struct(doc_id, row, at)"


def _cut(items: DataFrame, wanted: DataFrame, kind: Kind, texts: bool) -> DataFrame:
    """The text of each variant from that of its item: anchor, seg, windows, hot, doc_id, row, at; texts: rather rows like those of `items`, with their own anchors by `kind`."""
    of = wanted.groupBy("item").agg(F.collect_list(F.struct("anchor", "at", "windows", "places", "hot")).alias("of"))

    def each(batch):
        out = {f.name: [] for f in schema}
        unpack, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        load = 0
        for row, doc_id, base, z, of in zip(*(batch.column(i) for i in range(5)), strict=True):
            row, doc_id, base = row.as_py(), doc_id.as_py(), base.as_py()
            symbols = kind.symbols(unpack.decompress(z.as_py()))
            for v in of.as_py():
                a = v["at"] - base
                part = symbols[a : a + v["windows"] + kind.length - 1]
                seg = kind.join(part)
                if texts:
                    values = {"z": press.compress(seg), "anchors": _twice_at_most(anchors(kind, part)[1]), "places": v["places"]}
                else:
                    values = {"anchor": v["anchor"], "seg": seg, "windows": v["windows"], "hot": v["hot"]}
                for name, value in (values | {"row": row, "doc_id": doc_id, "at": v["at"]}).items():
                    out[name].append(value)
                load += len(seg)
                if load > 1 << 22:
                    yield _rows(out, schema)
                    out, load = {f.name: [] for f in schema}, 0
        yield _rows(out, schema)

    place = [("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int64())]
    if texts:
        schema, ddl = pa.schema([("z", pa.binary()), ("anchors", pa.list_(pa.int64())), ("places", pa.int64()), *place]), "z binary, anchors array<long>, places long, doc_id long, row long, at long"
    else:
        schema, ddl = pa.schema([("anchor", pa.int64()), ("seg", pa.binary()), ("windows", pa.int64()), ("hot", pa.bool_()), *place]), "anchor long, seg binary, windows long, hot boolean, doc_id long, row long, at long"
    return common.mapped(items.select("item", "row", "doc_id", "at", "z").join(of, "item").select("row", "doc_id", "at", "z", "of"), each, ddl)


def resolved(items: DataFrame, kind: Kind, resolver: Resolver, earlier: bool) -> tuple[DataFrame, list[DataFrame]]:
    """row, a, b: windows a to b - 1 of a row that repeat; and the stored tables that this reads.

    items: item, row, doc_id, at (where its text begins in the row), places (rows or segments that it stands for), z, anchors.
    """
    segs = segments(items, kind)
    variants = segs.groupBy("key").agg(
        F.count("*").alias("n"), F.min("anchor").alias("anchor"), F.min("windows").alias("windows"), F.min("alone").alias("alone"), F.sum("places").alias("places"), F.min(F.struct("doc_id", "row", "at", "item")).alias("first")
    )
    variants = common.stored(variants, "repeats-variants")
    met = segs.select("key", "row", "doc_id", "at", "windows").join(variants.where("n > 1").select("key", F.expr("struct(first.doc_id, first.row, first.at)").alias("first")), "key")
    # equal segments: all their windows repeat, and all but the first place have an earlier one
    equal = met.where(F.expr(PLACE) > F.col("first")) if earlier else met
    spans = equal.select("row", F.col("at").alias("a"), (F.col("at") + F.col("windows")).alias("b"))
    hot, most = kind.limits
    per = variants.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("windows") + (kind.length - 1)).alias("all"), F.min("alone").alias("alone"))
    per = per.where("n > 1 or not alone").select("anchor", (F.col("all") > hot).alias("hot"))
    open_ = common.stored(variants.join(per, "anchor").select("anchor", "windows", "places", "first.item", "first.at", "hot"), "repeats-open")

    def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        load, last = 0, None
        for batch in batches:
            for anchor, seg, windows, doc_id, row, at in zip(*batch.columns, strict=True):
                anchor, windows, doc_id = anchor.as_py(), windows.as_py(), doc_id.as_py()
                if anchor != last and load > most:
                    yield _spans(held, kind, resolver)
                    held, load = [], 0
                last = anchor
                held.append(((doc_id is not None, doc_id or 0, row.as_py(), at.as_py()), seg.as_py(), windows))
                load += windows + kind.length - 1
        if held:
            yield _spans(held, kind, resolver)

    tables, parted = [segs, variants, open_], bool(open_.where("hot").head(1))
    cut = _cut(items, open_.where("not hot") if kind.words else open_, kind, False)
    if parted and not kind.words:  # stored, as cutting again would shuffle all texts again
        cut = common.stored(cut, "repeats-cut")
        tables.append(cut)
    cold = cut.where("not hot").drop("hot")
    spans = spans.unionByName(cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(each, "row long, a long, b long"))
    if not parted:
        return spans, tables
    if kind.words:
        parts = common.stored(_cut(items, open_.where("hot"), kind.longer(), True).withColumn("item", F.monotonically_increasing_id()), "repeats-parts")
        more, read = resolved(parts, kind.longer(), resolver, earlier)
        return spans.unionByName(more), [*tables, parts, *read]
    texts = common.stored(cut.where("hot").drop("anchor", "hot").withColumn("variant", F.monotonically_increasing_id()), "repeats-hot")
    tables.append(texts)
    rows = texts.withColumn("of", F.array(F.struct("at", "windows")))
    for width in WIDTHS:
        parts = common.stored(common.mapped(rows.select("variant", "seg", "doc_id", "row", "at", "of"), _apart(kind, width), _PART_DDL), "repeats-parts")
        same = common.stored(parts.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "at", "variant")).alias("first"), F.min("windows").alias("windows")), "repeats-parts-distinct")
        again = parts.select("key", "row", "doc_id", "at", "windows").join(same.where("n > 1").select("key", F.expr("struct(first.doc_id, first.row, first.at)").alias("first")), "key")
        again = again.where(F.expr(PLACE) > F.col("first")) if earlier else again
        spans = spans.unionByName(again.select("row", F.col("at").alias("a"), (F.col("at") + F.col("windows")).alias("b")))
        # the first stands for all equal ones
        of = same.groupBy("first.variant").agg(F.collect_list(F.struct("first.at", "windows")).alias("of"))
        rows, tables = texts.join(of, "variant"), [*tables, parts, same]
    return spans, tables


#: Windows in the stretches that variants of a hot anchor of bytes are parted into, one after the other. Stretches begin at multiples of the width from the anchor, so that the same windows fall together.
WIDTHS = (64, 16, 4, 1)
_PART = pa.schema([("key", pa.binary()), ("variant", pa.int64()), ("windows", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int64())])
_PART_DDL = "key binary, variant long, windows long, doc_id long, row long, at long"


def _apart(kind: Kind, width: int):
    """From the text of each variant and the stretches (of) to part: the digests of their parts. A text is moved once a variant, not once a part: a part of one window would be 400 times its share."""

    def each(batch):
        out = {f.name: [] for f in _PART}
        for variant, seg, doc_id, row, at, of in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            symbols = kind.symbols(seg)
            h = hashes(kind, symbols)
            for stretch in of:
                start, windows = stretch["at"] - at, stretch["windows"]
                anchor = int(h[start : start + kind.length - kind.gram + 1].argmin())
                edges = [0, *range(anchor % width or width, windows, width), windows]
                for a, b in zip(edges, edges[1:], strict=False):
                    part = kind.join(symbols[start + a : start + b - 1 + kind.length])
                    for name, value in (("key", hashlib.blake2b(part, digest_size=16).digest()), ("variant", variant), ("windows", b - a), ("doc_id", doc_id), ("row", row), ("at", at + start + a)):
                        out[name].append(value)
                if len(out["key"]) > 50_000:
                    yield _rows(out, _PART)
                    out = {f.name: [] for f in _PART}
        yield _rows(out, _PART)

    return each


def _spans(held: list[tuple], kind: Kind, resolver: Resolver) -> pa.RecordBatch:
    held.sort(key=lambda x: x[0])
    rows, a, b = [], [], []
    for (place, *_), spans in zip(held, resolver(kind, [x[1:] for x in held]), strict=True):
        for s, e in spans:
            rows.append(place[2])
            a.append(place[3] + s)
            b.append(place[3] + e)
    return pa.record_batch({"row": pa.array(rows, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def repeated(docs: DataFrame, kind: Kind, resolver: Resolver, earlier: bool, keep: bool = False) -> DataFrame:
    """doc_id, z, size, whole, spans (keep: and rest) of every row: spans are symbols to remove (from, to), sorted and apart; whole: all of them.

    earlier: only windows that also start at an earlier place (by doc_id, row, start); else windows that also start at any other place.
    """
    texts = kept_texts(docs, kind, keep)
    same = common.stored(texts.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("copies")), "repeats-same")
    firsts = same.select("first.row", F.col("copies").alias("places"))
    items = texts.where(F.col("size") >= kind.length).select("row", "doc_id", "z", "anchors").join(firsts, "row").withColumns({"item": F.col("row"), "at": F.lit(0).cast("long")})
    spans, tables = resolved(items, kind, resolver, earlier)
    # windows a to b - 1 cover symbols a to b - 1 + length - 1
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("a", (F.col("b") + (kind.length - 1)).alias("b"))).alias("spans"))
    others = texts.select("row", "digest").join(same.where("copies > 1"), "digest")
    whole = (others.where(F.col("row") != F.col("first.row")) if earlier else others).select("row", F.lit(True).alias("whole"))
    decided = common.stored(spans.join(whole, "row", "full_outer"), "repeats-decided")
    common.dropped(same, *tables)
    columns = ["doc_id", "z", "size", *["rest"] * keep]
    return texts.select("row", *columns).join(decided, "row", "left").select(*columns, (F.coalesce("whole", F.lit(False)) & (F.col("size") >= kind.length)).alias("whole"), "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted, with those that touch or overlap joined."""
    out: list[list[int]] = []
    for x in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and x[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x[1])
        else:
            out.append(list(x))
    return [tuple(x) for x in out]
