"""SimHash fingerprints, their links by pigeonring filtering, and groups of near-duplicate documents.

Candidates: the 64 bits are parted into segments on a ring. If two fingerprints differ in at most t bits, then from some
segment on every chain of l consecutive segments differs in at most l * t / segments bits (the strong pigeonhole
principle on a ring). A chain of one segment then has no differing bit as long as t < segments, so fingerprints are put
in a bucket for each segment's value; within a bucket the chains of two, three, ... segments must stay within their
budgets before the full Hamming check.

A bucket that many different fingerprints share is not joined with itself: its members are put in buckets for chains of two segments, the
second being within what the chain's budget leaves it (here one bit). Members of such a bucket that is still too large go by exact meeting points
instead (values within half the distance of each). Either is a number of rows that is linear in the members.

Defined results: null text is the empty text; a document without words has fingerprint 0 and is linked like any other;
repeated rows get the same fingerprint and component; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.components import components
from . import common

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The 8 bits of each byte value, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: Buckets with more fingerprints than this are not joined with themselves.
HOT = 64


def fingerprint(text: bytes, k: int = 3, seed: int = 42) -> int:
    """SimHash of the k-word shingles of a text, repeats counted."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: len(words) - k]]).tolist()
        shingles = [line[a:b] for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros((8, 256), np.int64)
    for i in range(0, len(shingles), 1 << 16):
        h = np.fromiter((digest(s, seed) for s in shingles[i : i + (1 << 16)]), "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((h + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ BITS).ravel() * 2 > len(shingles)
    return int.from_bytes(np.packbits(ones, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""

    def each(batch):
        fps = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64)
        yield pa.record_batch({"doc_id": batch.column(0).cast(pa.int64()), "fp": fps.view(np.int64)})

    return common.mapped(common.docs_of(docs), each, "doc_id long, fp long")


def _segments(fp: Column, n: int) -> list[Column]:
    edges = [64 * i // n for i in range(n + 1)]
    return [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]


def _differs(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def links(vertices: DataFrame, distance: int = 2, segments: int = 3, hot: int = HOT) -> DataFrame:
    """Links a, b between the ids of distinct fingerprints (id long, fp long) that join all pairs differing in at most distance bits.

    Of hot buckets it returns links from each member to a meeting point's smallest id; these have the same components as the pairs.
    """
    if distance != 2 or segments < 3:
        raise ValueError("meeting points are worked out for a distance of 2, which takes 3 segments or more")
    keyed = common.stored(vertices.select("id", "fp", F.posexplode(F.array(*_segments(F.col("fp"), segments))).alias("seg", "value")), "simhash-buckets")
    sizes = keyed.groupBy("seg", "value").agg(F.count("*").alias("n")).where("n > 1")
    busy = common.stored(keyed.join(sizes, ["seg", "value"]), "simhash-busy")
    cold = busy.where(F.col("n") <= hot)
    x, y = cold.alias("x"), cold.alias("y")
    a, b = _segments(F.col("x.fp"), segments), _segments(F.col("y.fp"), segments)

    def chain(start: int) -> Column:
        parts = [_differs(a[(start + i) % segments], b[(start + i) % segments]) for i in range(segments)]
        within = [reduce(Column.__add__, parts[: size + 1]) <= (size + 1) * distance // segments for size in range(segments - 1)]
        return reduce(Column.__and__, within)

    ring = reduce(Column.__or__, ((F.col("x.seg") == s) & chain(s) for s in range(segments)))
    near = x.join(y, (F.col("x.seg") == F.col("y.seg")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.id") < F.col("y.id")) & ring & (_differs(F.col("x.fp"), F.col("y.fp")) <= distance))
    found = near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    # chains of two segments may differ in one bit: each member stands at its own second segment's value and at those one bit off
    second = F.element_at(F.array(*_segments(F.col("fp"), segments)), ((F.col("seg") + 1) % segments + 1).cast("int"))
    width = F.element_at(F.array(*(F.lit(64 * (i + 1) // segments - 64 * i // segments) for i in range(segments))), ((F.col("seg") + 1) % segments + 1).cast("int"))
    off = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.struct(F.lit(1).alias("off"), second.bitwiseXOR(F.pow(F.lit(2.0), i).cast("long")).alias("after")))
    chained = busy.where(F.col("n") > hot).select("seg", "value", "id", "fp", F.inline(F.concat(F.array(F.struct(F.lit(0).alias("off"), second.alias("after"))), off)))
    chained = common.stored(chained, "simhash-chained")
    keys = ["seg", "value", "after"]
    full = common.stored(chained.groupBy(*keys).agg(F.count("*").alias("m"), F.count_if(F.col("off") == 0).alias("own")).where("m > 1 and own > 0"), "simhash-full")
    few = chained.join(full.where(F.col("m") <= 4 * hot), keys)
    x, y = few.where("off = 0").alias("x"), few.alias("y")
    apart = (F.col("x.id") < F.col("y.id")) | ((F.col("y.off") == 1) & (F.col("x.id") != F.col("y.id")))
    same = (F.col("x.seg") == F.col("y.seg")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.after") == F.col("y.after"))
    near = x.join(y, same & apart & (_differs(F.col("x.fp"), F.col("y.fp")) <= distance))
    found = found.unionByName(near.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))
    # Two fingerprints at most two bits apart are both within one bit of a common value, and any two within one bit of a value are at most two apart.
    members = chained.join(full.where(F.col("m") > 4 * hot), keys, "left_semi").select("id", "fp").distinct()
    flips = [F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64))]
    meet = members.select("id", F.explode(F.array(*(F.col("fp").bitwiseXOR(f) for f in flips))).alias("point"))
    met = meet.groupBy("point").agg(F.min("id").alias("a"), F.collect_list("id").alias("ids"), F.count("*").alias("n")).where("n > 1")  # 65 ids at most
    return found.unionByName(met.select("a", F.explode("ids").alias("b")).where("a <> b"))


def groups(docs: DataFrame, k: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) for every row of docs."""
    fps = common.cut(fingerprints(docs, k))
    vertices = common.stored(fps.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-vertices")
    reached = components(links(vertices, distance))
    of = vertices.join(reached, vertices.id == reached.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    of = common.stored(of, "simhash-components")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


# Similarity of 0.8 and the like takes wider fingerprints: at a Jaccard similarity of s, fingerprints of sets differ in a share of
# arccos(2 s / (1 + s)) / pi of their bits (0.15 at 0.8), and that many of 64 bits can't be told from chance in a few segments.

#: Bits of a fingerprint, and the least bits of a segment.
WIDE, LEAST_BITS = 2046, 22
#: Segments that a pair at the similarity shares on average, over all arrangements of the same bits: it shares none with a probability of exp(-SHARED), 0.0004.
SHARED = 7.8
#: Segments of the chain that is checked from a shared segment on before the whole fingerprints are.
CHAIN = 8
#: Segments, from and to, whose buckets are compared with one member first: a few join most of a large group, some more what is left of it; then all (and shingles) are.
ROUNDS = ((0, 6), (6, 24), None)
#: Standard deviations added to the expected difference, so that pairs at the very threshold are found; what else they let in goes by its exact similarity.
LENIENT = 2.5
#: A text that meets a bucket's largest group in many buckets is compared with its members by blocks of so many fingerprints rather than bucket by bucket:
#: where it would meet them more than OFTEN times and more than a quarter as often as there are members.
BLOCK, OFTEN = 64, 16
#: Majority bits of small sets differ by more than arccos() tells, so sets of up to so many shingles also meet by shingles, which is exact.
SMALL = 32


_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, k: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the set of k-word shingles of a text, words lower-cased as in fingerprint(): each mixes the hashes of its words in their order."""
    words = text.translate(LOWER).split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < k:
        h = np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    else:
        n, base = len(words) - k + 1, h
        h = base[:n]
        for i in range(1, k):
            h = _mixed(h) + base[i : i + n]
    return np.unique(h)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


_STEPS = np.arange(1, -(-WIDE // 64) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """Bits (0 or 1) of a set of shingles(): each bit is 1 if it is in over half of the hashes that follow from the shingles'."""
    counts = np.zeros(len(_STEPS) * 64, np.int64)
    for i in range(0, len(h), 255):  # sums of 255 bits fit into a byte
        x = _mixed(h[i : i + 255, None] + _STEPS)
        counts += np.unpackbits(x.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return (counts[:WIDE] * 2 > len(h)).astype(np.uint8)


def arrangement(i: int) -> np.ndarray:
    """The order of a fingerprint's bits that is cut into segments; that of 0 is their own."""
    return np.random.default_rng(i).permutation(WIDE) if i else np.arange(WIDE)


def differing(similarity: float) -> float:
    """The share of bits that fingerprints at this Jaccard similarity differ in."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def budget(similarity: float, n: int = WIDE) -> int:
    """Most bits of n that fingerprints of texts at this Jaccard similarity may differ in."""
    share = differing(similarity)
    return int(n * share + LENIENT * (n * share * (1 - share)) ** 0.5)


@dataclass(frozen=True)
class Ring:
    """How fingerprints are cut: bits of a segment, segments on the ring, arrangements of the bits with such a ring each."""

    bits: int
    segments: int
    arrangements: int

    @classmethod
    def of(cls, n: int, similarity: float) -> Ring:
        """For n fingerprints. A segment has five bits more than it takes to number them, so that by chance a fingerprint meets one in 32 / segments others however many there are."""
        bits = max(LEAST_BITS, max(n, 1).bit_length() + 5)
        segments = WIDE // bits
        return cls(bits, segments, math.ceil(SHARED / (segments * (1 - differing(similarity)) ** bits)))


def _near(pairs: DataFrame, prints: DataFrame, most: int, cuts: Ring) -> DataFrame:
    """Of pairs a, b, key (of a bucket they share) those that share a shingle's bucket, or whose fingerprints differ in at most `most` bits."""
    a, b = (prints.select(F.col("id").alias(x), F.col("bits").alias(f"{x}_bits")) for x in "ab")
    orders = np.array([arrangement(i)[: cuts.bits * cuts.segments] for i in range(cuts.arrangements)])
    due = np.arange(1, CHAIN + 1) * most * cuts.bits / WIDE

    def each(batch):
        key = np.asarray(batch.column(2))
        seg = np.maximum(key, 0) >> cuts.bits
        x, y = (np.unpackbits(np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1), axis=1)[:, :WIDE] for i in (3, 4))
        bits = x ^ y
        whole = bits.sum(1, dtype=np.int64)
        near = key < 0
        for i in range(cuts.arrangements):
            at = np.flatnonzero((key >= 0) & (seg // cuts.segments == i) & (whole <= most))
            differ = bits[at][:, orders[i]].reshape(len(at), cuts.segments, cuts.bits).sum(2)
            ring = (seg[at, None] % cuts.segments + np.arange(CHAIN)) % cuts.segments
            grown = np.cumsum(np.take_along_axis(differ, ring, axis=1), axis=1)
            # the shared segment may stand anywhere on a good chain, so the budget is that of the chain with the slack of a few segments
            near[at] = (grown <= due + 4 * np.sqrt(due)).all(axis=1)
        yield pa.record_batch([c.filter(pa.array(near)) for c in batch.columns[:2]], names=["a", "b"])

    return common.mapped(pairs.join(a, "a").join(b, "b").select("a", "b", "key", "a_bits", "b_bits"), each, "a long, b long")


def _by_blocks(texts: DataFrame, members: DataFrame, prints: DataFrame, most: int, similarity: float) -> DataFrame:
    """a, b: of texts (id, n, main) and members (the same) of one main, those whose sizes allow the similarity and whose fingerprints differ in at most `most` bits. A row that meets another holds a block of them."""

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        parted = rows.join(counts, "main").join(prints, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        return common.stored(parted.groupBy("main", "block").agg(F.collect_list(F.struct("id", "n", "bits")).alias(name)).drop("block"), "simhash-wide-blocks")

    def each(batch):
        found = [], []
        sides = []
        for c in batch.columns:
            id_, n, bits = c.flatten().flatten()
            words = np.frombuffer(b"".join(bits.to_pylist()), np.uint8).reshape(len(id_), -1)
            sides.append((np.asarray(id_), np.asarray(n), np.pad(words, ((0, 0), (0, -words.shape[1] % 8))).view(np.uint64), np.concatenate([[0], np.cumsum(np.asarray(c.value_lengths()))])))
        (xi, xn, xw, xe), (yi, yn, yw, ye) = sides
        for r in range(batch.num_rows):
            x, y = slice(xe[r], xe[r + 1]), slice(ye[r], ye[r + 1])
            apart = np.bitwise_count(xw[x, None] ^ yw[None, y]).sum(2, dtype=np.int64)
            n, m = xn[x, None], yn[None, y]
            i, j = np.nonzero((apart <= most) & (np.minimum(n, m) / np.maximum(n, m) >= similarity))
            found[0].append(np.minimum(xi[x][i], yi[y][j]))
            found[1].append(np.maximum(xi[x][i], yi[y][j]))
        yield pa.record_batch([pa.array(np.concatenate(f)) for f in found], names=["a", "b"])

    xs, ys = blocks(texts, "x"), blocks(members, "y")
    pairs = common.stored(common.mapped(xs.join(ys, "main").select("x", "y"), each, "a long, b long"), "simhash-wide-block-pairs")
    common.dropped(xs, ys)
    return pairs


def _words(prints: DataFrame) -> DataFrame:
    """id, words: the fingerprint's bits as longs, for SQL."""

    def each(batch):
        bits = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
        at = np.arange(batch.num_rows + 1, dtype=np.int32) * (len(bits) // batch.num_rows)
        yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(bits))], names=["id", "words"])

    return common.mapped(prints.select("id", "bits"), each, "id long, words array<long>")


def _segment_keys(one: DataFrame, i: int, cuts: Ring) -> DataFrame:
    """key, id, n, sketch: the segments of arrangement i of every fingerprint."""
    order, powers = arrangement(i)[: cuts.bits * cuts.segments], 1 << np.arange(cuts.bits)
    high = (i * cuts.segments + np.arange(cuts.segments, dtype=np.int64)) << cuts.bits

    def each(batch):
        bits = np.unpackbits(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1), axis=1)[:, order]
        keys = (bits.reshape(-1, cuts.segments, cuts.bits) @ powers) | high
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * cuts.segments), pa.array(keys.ravel()))
        yield pa.record_batch([*batch.columns[:3], lists], names=["id", "n", "sketch", "keys"])

    return common.mapped(one.select("id", "n", "sketch", "bits"), each, "id long, n int, sketch long, keys array<long>").select(F.explode("keys").alias("key"), "id", "n", "sketch")


def _shingle_keys(one: DataFrame, similarity: float) -> DataFrame:
    """The same for small sets: their rarest shingles, so many that two sets at the similarity share one of them. Keys are negative."""
    each = one.where("few is not null").select("id", "n", "sketch", F.explode("few").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("often"))
    ranked = each.join(often, "h").withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("often", "h")))
    first = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1)
    return first.select(F.col("h").bitwiseOR(F.lit(-(1 << 63))).alias("key"), "id", "n", "sketch")


def _exact(pairs: DataFrame, prints: DataFrame, vertices: DataFrame, similarity: float, k: int) -> DataFrame:
    """Of pairs a, b those whose sets of shingles have at least this Jaccard similarity; only the texts of these pairs are fetched."""
    pairs = common.stored(pairs, "simhash-wide-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = vertices.join(ids, "id", "left_semi").select("id", "set")
    texts = common.stored(prints.select("set", "z").join(sets, "set").groupBy("id").agg(F.first("z").alias("z")), "simhash-wide-texts")
    a, b = (texts.select(F.col("id").alias(x), F.col("z").alias(f"{x}_z")) for x in "ab")

    def each(batch):
        unpack = zstandard.ZstdDecompressor()
        of = lru_cache(64)(lambda z: shingles(unpack.decompress(z), k))
        near = [jaccard(of(x.as_py()), of(y.as_py())) >= similarity for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.record_batch([c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    found = common.stored(common.mapped(pairs.join(a, "a").join(b, "b").select("a", "b", "a_z", "b_z"), each, "a long, b long"), "simhash-wide-links")
    common.dropped(texts, pairs)
    return found


def similar_groups(docs: DataFrame, similarity: float = 0.8, k: int = 5) -> DataFrame:
    """doc_id, component_id of every row: groups linked by a similarity of their sets of k-word shingles of at least `similarity`.

    Fingerprints find candidates only: a link is what the Jaccard similarity of the two sets themselves allows.
    Buckets hold the fingerprints that share a segment, and the small sets that share one of their rarest shingles. In some rounds each is compared with one of its bucket's largest group, which joins
    large groups at a cost linear in them; then, in buckets that still hold several groups, all but the largest group's members are compared with
    those of other groups: with the largest group by blocks of its members where many buckets hold both. So no two of one group are compared for nothing, and no pair of a bucket that could link two groups is left out.
    """
    return _similar(docs, similarity, k).select("doc_id", "component_id")


def _similar(docs: DataFrame, similarity: float, k: int) -> DataFrame:
    """similar_groups(), and text_key (a hash of the text) of every row."""
    largest = int(SMALL / similarity)

    def each(batch):
        press, rows = zstandard.ZstdCompressor(level=1), []
        for t in batch.column(1):
            text = t.as_py()
            h = shingles(text, k)
            bits = np.packbits(wide_fingerprint(h)).tobytes()
            few = h.view(np.int64).tolist() if len(h) <= largest else None
            rows.append((xxhash.xxh3_64_intdigest(h.tobytes()), len(h), int.from_bytes(bits[:8], "little", signed=True), bits, few, press.compress(text)))
        sets, n, sketch, bits, few, z = zip(*rows, strict=True)
        made = [np.array(sets, np.uint64).view(np.int64), pa.array(n, pa.int32()), pa.array(sketch, pa.int64()), pa.array(bits, pa.binary()), pa.array(few, pa.list_(pa.int64())), pa.array(z, pa.binary())]
        yield pa.record_batch([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(made[0]), *made[1:]], names=["doc_id", "text_key", "set", "n", "sketch", "bits", "few", "z"])

    schema = "doc_id long, text_key long, set long, n int, sketch long, bits binary, few array<long>, z binary"
    prints = common.stored(common.mapped(common.docs_of(docs, F.xxhash64("text").alias("text_key")), each, schema), "simhash-wide")
    # vertices are distinct sets, numbered by their smallest doc_id: one doc_id may have several texts
    sets = prints.groupBy("set").agg(F.min("doc_id").alias("first"), *(F.first(c).alias(c) for c in ("n", "sketch", "bits", "few")))
    one = common.stored(sets.orderBy(F.asc_nulls_last("first"), "set").withColumn("id", F.monotonically_increasing_id()), "simhash-wide-distinct")
    cuts = Ring.of(one.count(), similarity)
    parts = []
    for keyed in (*(_segment_keys(one, i, cuts) for i in range(cuts.arrangements)), _shingle_keys(one, similarity)):
        several = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
        parts.append(common.stored(keyed.join(several, "key"), "simhash-wide-keys"))
    busy = reduce(DataFrame.unionByName, parts)
    only = one.select("id", "bits")
    most, most_sketch = budget(similarity), budget(similarity, 64)

    def likely(key: Column, n: Column, m: Column, x: Column, y: Column) -> Column:
        """Sizes allow the similarity, and 64 bits of the fingerprints don't tell against it."""
        return (F.least(n, m) / F.greatest(n, m) >= similarity) & ((key < 0) | (_differs(x, y) <= most_sketch))

    def grouped(rows: DataFrame, links: DataFrame | None) -> DataFrame:
        if links is None:
            return rows.withColumn("group", F.col("id"))
        reached = components(links).select(F.col("node").alias("id"), "component")
        return rows.join(reached, "id", "left").select("key", "id", "n", "sketch", F.coalesce("component", "id").alias("group"))

    def mixed(rows: DataFrame, spread: int) -> DataFrame:
        """key, main (its largest group, the least of several), own (its rows), size (of the bucket), head: one member of that group, the least, or by a hash where a large group is to be met at many places."""
        turn = F.xxhash64("key", F.lit(spread)).bitwiseAND(F.lit((1 << 62) - 1)) if spread else F.lit(0).cast("long")
        per = rows.groupBy("key", "group").agg(F.count("*").alias("c"), F.min(F.col("id").bitwiseXOR(turn)).alias("head"))
        best = F.max_by(F.struct(F.col("group").alias("main"), F.col("c").alias("own"), "head"), F.struct("c", -F.col("group")))
        many = per.groupBy("key").agg(best.alias("b"), F.count("*").alias("groups"), F.sum("c").alias("size")).where("groups > 1")
        return many.select("key", "b.main", "b.own", F.col("b.head").bitwiseXOR(turn).alias("head"), "size")

    verified: list[DataFrame] = []
    links, sizes = None, one.select(F.col("id").alias("head"), F.col("n").alias("head_n"), F.col("sketch").alias("head_sketch"))
    for spread, window in enumerate(ROUNDS):
        inside = busy if window is None else busy.where(F.col("key").between(window[0] << cuts.bits, (window[1] << cuts.bits) - 1))
        rows = common.stored(grouped(inside, links), "simhash-wide-grouped")
        star = rows.join(mixed(rows, spread if window else 0).drop("own").join(sizes, "head"), "key")
        star = star.where((F.col("group") != F.col("main")) & likely(F.col("key"), F.col("n"), F.col("head_n"), F.col("sketch"), F.col("head_sketch")))
        star = star.groupBy(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).agg(F.min("key").alias("key"))
        found = _exact(_near(star, only, most, cuts), prints, one, similarity, k)
        links = found if links is None else links.unionByName(found)
        verified.append(found)
        common.dropped(rows)
    held = common.stored(grouped(busy, links), "simhash-wide-held")
    common.dropped(*parts)
    open_ = mixed(held, 0).where("size > 2").select("key", "main", "own")  # two were compared already
    bare = common.stored(held.join(open_, "key"), "simhash-wide-mixed")
    common.dropped(held)
    outside = F.col("group") != F.col("main")
    members = common.stored(bare.where(~outside).select("id", "n", "main").distinct(), "simhash-wide-members")
    most_of = members.groupBy("main").agg(F.count("*").alias("members"))
    meets = bare.where(outside).groupBy("id", "n", "main").agg(F.sum("own").alias("meets")).join(most_of, "main")
    often = common.stored(meets.where((F.col("meets") > OFTEN) & (F.col("meets") * 4 > F.col("members"))).select("id", "n", "main"), "simhash-wide-often")
    blocked = _by_blocks(often, members.join(often, "main", "left_semi"), only, most, similarity)
    # what is left: texts that meet a bucket's largest group seldom, and the others of a bucket among each other
    outer = common.stored(bare.where(outside).join(often.select("id", "main", F.lit(True).alias("done")), ["id", "main"], "left"), "simhash-wide-outer")
    per = common.stored(outer.groupBy("key").agg(F.bool_or(F.col("done").isNull()).alias("seldom"), (F.min("group") < F.max("group")).alias("several")), "simhash-wide-open")
    others = outer.join(per.where("seldom or several").select("key"), "key", "left_semi")
    inner = bare.where(~outside).join(per.where("seldom").select("key"), "key", "left_semi")
    left = common.stored(others.unionByName(inner, allowMissingColumns=True), "simhash-wide-left")
    common.dropped(bare, members, often, outer, per)
    words = _words(only.join(left.select("id").distinct(), "id", "left_semi"))
    several = common.stored(left.join(words, "id"), "simhash-wide-several")
    common.dropped(left)
    x, y = several.where(F.col("group") != F.col("main")).alias("x"), several.alias("y")
    near = likely(F.col("x.key"), F.col("x.n"), F.col("y.n"), F.col("x.sketch"), F.col("y.sketch"))
    # in a large group of texts just below the similarity most pairs share a segment: whole fingerprints are compared before a pair is a row
    apart = reduce(Column.__add__, (_differs(F.col("x.words")[i], F.col("y.words")[i]) for i in range(-(-WIDE // 64))))
    near = near & ((F.col("x.key") < 0) | (apart <= most))
    due = F.col("x.done").isNull() | (F.col("y.group") != F.col("y.main"))
    across = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.group") != F.col("y.group")) & due & near)
    across = across.groupBy(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).agg(F.min("x.key").alias("key"))
    verified.append(_exact(_near(across, only, most, cuts).unionByName(blocked).distinct(), prints, one, similarity, k))
    links = reduce(DataFrame.unionByName, verified)
    common.dropped(several, blocked)
    of = one.join(components(links), one.id == F.col("node"), "left").select("set", F.coalesce("component", "id").alias("component"))
    of = of.join(one.select(F.col("id").alias("component"), F.col("first").alias("component_id")), "component").select("set", "component_id")
    found = common.stored(prints.select("doc_id", "text_key", "set").join(of, "set").drop("set"), "simhash-wide-components")
    common.dropped(prints, one, *verified)
    return found


def one_of_each(docs: DataFrame, similarity: float = 0.8, k: int = 5) -> DataFrame:
    """docs with one document of each group of similar ones, that with the smallest doc_id; rows that repeat that doc_id stay."""
    gone = _similar(docs, similarity, k).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone"), "text_key").distinct()
    return docs.join(gone, (docs.doc_id == gone.gone) & (F.xxhash64(docs.text) == gone.text_key), "left_anti")
