"""The operators of listmill.llm against brute force, round trips and planted cases, on small fixtures with nulls, empty and long texts, ties, repeats and extra columns."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from listmill.llm import bpe, mixing, quality, queries, repeats, simhash, substring, suffix_bwt, toxicity, vafile, vamana, warc
from listmill.llm.repeats import Kind

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, anchor string, spans string"


def frame(spark, rows):
    """documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", None) for i, t, s in rows], SCHEMA)


def texts(seed=1, n=40):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefg", k=rnd.randrange(2, 7))) for _ in range(300)]
    passage = " ".join(rnd.choices(words, k=90))
    out = []
    for i in range(n):
        t = " ".join(rnd.choices(words, k=rnd.randrange(5, 200)))
        if i % 3 == 0:
            t = f"{t}\n{passage}\t{t[:50]}"
        if i % 7 == 0 and out:
            t = rnd.choice(out) or ""
        out.append(t)
    return [*out, None, "", "   \n", "né 漢字 " * 300, "a " * 3000, "x" * 5000]


def documents(spark, seed=1):
    rows = [(i, t, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts(seed))]
    return frame(spark, [*rows, (3, rows[3][1], "s1"), (None, rows[6][1], "s2")])


def brute_bytes(rows, n):
    found = Counter(t[i : i + n] for _, t in rows for i in range(len(t) - n + 1))
    out = []
    for doc_id, t in rows:
        on = np.zeros(len(t) + 1, int)
        for i in range(len(t) - n + 1):
            if found[t[i : i + n]] > 1:
                on[i] += 1
                on[i + n] -= 1
        gone = np.cumsum(on)[:-1] > 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc_id, len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows, n):
    seen, out = set(), []
    for doc_id, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = t.split()
        on = np.zeros(len(w) + 1, int)
        for i in range(len(w) - n + 1):
            if (x := tuple(w[i : i + n])) in seen:
                on[i] += 1
                on[i + n] -= 1
            seen.add(x)
        gone = np.cumsum(on)[:-1] > 0
        out.append((doc_id, len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def pairs(df):
    return [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("hot", [None, 200])
def test_suffix_dedup(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr("listmill.llm.repeats.HOT_BYTES", hot)
    df = documents(spark)
    got = Counter(map(tuple, suffix_bwt.removed(df, 60, 16).collect()))
    assert got == brute_bytes(pairs(df), 60)


def test_parts_of_a_hot_anchor_carry_no_text(spark, monkeypatch):
    """Variants, hot and others, are cut from the texts in one pass; a stretch or window of it is counted by its digest, so a part of one window takes no 60 bytes."""
    made, stored = [], repeats.common.stored
    monkeypatch.setattr(repeats, "HOT_BYTES", 200)
    monkeypatch.setattr(repeats.common, "stored", lambda df, name: made.append((name, df)) or stored(df, name))
    monkeypatch.setattr(repeats.common, "dropped", lambda *tables: None)
    df = documents(spark, 4)
    assert Counter(map(tuple, suffix_bwt.removed(df, 60, 16).collect())) == brute_bytes(pairs(df), 60)
    assert [name for name, _ in made].count("repeats-cut") == 1
    parts = [df for name, df in made if name.startswith("repeats-parts")]
    assert len(parts) == 2 * len(repeats.WIDTHS)
    for part in parts:
        carried = [F.length(f.name) for f in part.schema if f.dataType.simpleString() in ("binary", "string")]
        assert part.where(sum(carried, F.lit(0)) > 16).count() == 0 < part.count()


@pytest.mark.parametrize("hot", [None, 30])
def test_substring_dedup(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr("listmill.llm.repeats.HOT_WORDS", hot)
    df = documents(spark, 2)
    got = Counter(map(tuple, substring.removed(df, 10, 4).collect()))
    assert got == brute_words(pairs(df), 10)


def test_substring_texts_keep_columns(spark):
    df = documents(spark, 3)
    out = substring.without_repeats(df, 10, 4)
    assert out.columns == df.columns and out.count() == df.count()
    rows = Counter((r.doc_id, hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest()) for r in out.collect())
    assert rows == Counter((r[0], r[3]) for r in brute_words(pairs(df), 10).elements())
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_empty_tables(spark):
    empty = frame(spark, []).limit(0)
    for df in (suffix_bwt.removed(empty), substring.removed(empty), simhash.groups(empty), simhash.similar_groups(empty), mixing.mix(empty), mixing.mixed(empty), bpe.digests(empty, queries.vocabulary())):
        assert df.collect() == []
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vafile.top_k(none, F.col("vec_id") % 50 == 0).collect() == [] and vamana.nearest(none, F.col("vec_id") % 20 == 0).collect() == []


def at_string(strings, place):
    """Where the string begins that holds a place of a shard's text, and the string."""
    begin = 0
    for s in strings:
        if place <= begin + len(s):
            return begin, s
        begin += len(s) + 1


def common_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("strides", [(), (5,), (2, 4), (3, 12)])
def test_merged_transforms_with_many_shards(monkeypatch, strides):
    monkeypatch.setattr(suffix_bwt, "SHARD", 40)
    monkeypatch.setattr(suffix_bwt, "STRIDES", strides)
    rnd, kind = random.Random(5), Kind(False, 12, 4)
    for _ in range(60):
        base = bytes(rnd.choices(b"abcd \x00", k=80))
        some = [base[(a := rnd.randrange(60)) : a + rnd.randrange(12, 30)].ljust(12, b"z") for _ in range(rnd.randrange(1, 9))]
        found = Counter(s[i : i + 12] for s in some for i in range(len(s) - 11))
        for s, spans in zip(some, suffix_bwt.windows_that_repeat(kind, [(s, len(s) - 11) for s in some]), strict=True):
            on = {i for a, b in spans for i in range(a, b)}
            assert on == {i for i in range(len(s) - 11) if found[s[i : i + 12]] > 1}
        # the order, and the common prefixes of neighbours in it
        halves = [some[: len(some) // 2 + 1], some[len(some) // 2 + 1 :]]
        shards = [suffix_bwt.Shard(x, 12) for x in halves if x]
        order, shared = suffix_bwt.interleaved(shards, 12)
        tails = [s[i:] for x, of in zip([h for h in halves if h], shards, strict=True) for i, s in ((p - b, y) for p in of.order.tolist() for b, y in [at_string(x, p)])]
        merged = [tails[i][:12] for i in order.tolist()]
        assert merged == sorted(merged)
        assert shared[0] == 0 and all(shared[i] == common_prefix(merged[i - 1], merged[i]) for i in range(1, len(merged)))


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(230, 6)).astype(np.float32)
    x[40:60] = x[40]
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)] + [(900, None, 0), (950, [None] * 6, 0), (951, [float("nan")] * 6, 0), (952, [], 0), (1000, [1e12] * 6, 0), (953, [1.0] * 3, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(5)
    good = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)}
    expected = set()
    for q in (i for i in good if i % 50 == 0):
        near = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
        expected |= {(q, r, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(near, 1)}
    assert {tuple(r) for r in vafile.top_k(df, F.col("vec_id") % 50 == 0).collect()} == expected


def test_graph_search_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5020, [0.0] * 16), (5040, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got: dict = {}
    for r in vamana.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=1000).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r
    assert set(got) == set(range(0, 3000, 20))
    hit, d = 0, x.astype(np.float64)
    for q, found in got.items():
        s = d @ d[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20]
        hit += len(set(best.tolist()) & set(found))
        assert sorted(r.rank for r in found.values()) == list(range(1, 21)) and q not in found
        assert all(abs(r.score - s[i]) < 1e-9 for i, r in found.items())
    assert hit / (20 * len(got)) >= 0.9


def test_bpe_is_the_librarys(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        codec, lib = bpe.Codec(f.read()), Tokenizer.from_file(path)
    rnd = random.Random(1)
    pool = [chr(c) for c in [*range(0x250), *range(0x370, 0x400), 0x1680, 0x180E, 0x2000, 0x2028, 0x202F, 0x3000, 0x200B, 0xFEFF, 0x4E00, 0x1F600, 0xE01, 0x660, 0x2160]]
    cases = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", " " * 50, "aaaa" * 500, "it's we'll 'S", *("".join(rnd.choice(pool) if rnd.random() < 0.5 else rnd.choice("abcdehilnorst  '.\n") for _ in range(rnd.randrange(60))) for _ in range(3000))]
    for text in cases:
        ids = lib.encode(text, add_special_tokens=False).ids
        made = codec.encode(text)
        assert np.frombuffer(made, "<u4").tolist() == ids
        assert codec.decode(made).decode() == lib.decode(ids, skip_special_tokens=False)
    df = documents(spark)
    for r, t in zip(sorted(bpe.digests(df, queries.vocabulary()).collect(), key=str), sorted(bpe.digests(df, queries.vocabulary()).collect(), key=str), strict=True):
        assert r == t
    whole = {r.doc_id: r for r in bpe.with_tokens(df.where("doc_id is not null and doc_id <> 3"), queries.vocabulary()).collect()}
    for i, t in pairs(df):
        if i in whole:
            assert whole[i].decoded.encode() == t and list(whole[i].ids) == lib.encode(t.decode(), add_special_tokens=False).ids


def brute_groups(prints, most):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("hot", [64, 10, 2, 1])
def test_simhash_links(spark, hot):
    rnd, prints = random.Random(6), {}
    for base in (rnd.getrandbits(64) for _ in range(4)):
        for _ in range(60):
            x = base
            for _ in range(rnd.randrange(6)):
                x ^= 1 << rnd.randrange(64)
            prints.setdefault(x, len(prints))
    ids = {i: x for x, i in prints.items()}
    df = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in ids.items()], "id long, fp long")
    from listmill.operators.components import components

    got = {r.node: r.component for r in components(simhash.links(df, hot=hot)).collect()}
    assert {i: got.get(i, i) for i in ids} == brute_groups(ids, 2)


def test_simhash_fingerprint():
    import xxhash

    text = b"The quick\tBrown fox  jumps the quick brown fox"
    words = text.lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42) and simhash.fingerprint(b" \n") == 0


def test_similar_groups(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(2000)]
    rows, base = [], rnd.choices(words, k=300)
    for i in range(30):
        near = list(base)
        for _ in range(2):
            near[rnd.randrange(300)] = rnd.choice(words)
        rows.append((i, " ".join(near), "a"))
    rows += [(100 + i, " ".join(rnd.choices(words, k=200)), "a") for i in range(20)]
    rows += [(200, None, "a"), (201, "", "a"), (202, "Solo", "a"), (203, "solo", "a")]
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame(spark, rows)).collect()}
    assert {got[i] for i in range(30)} == {0} and all(got[100 + i] == 100 + i for i in range(20))
    assert got[201] == 200 and got[203] == 202
    assert simhash.one_of_each(frame(spark, rows)).count() == 1 + 20 + 2


def shingle_sets(rows):
    out = {}
    for i, t, _ in rows:
        w = t.lower().split()
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    return out


def with_changes(rnd, words, n, changes):
    """Two texts of n words, the second with some of the words replaced, not near to each other."""
    a = rnd.choices(words, k=n)
    b = list(a)
    for c in range(changes):
        b[5 + c * (n - 10) // changes] = f"new{rnd.random()}"
    return " ".join(a), " ".join(b)


def test_no_links_below_the_similarity(spark):
    """Pairs at 0.75 to 0.8 stay apart, and so do the neighbours of two texts that share a doc_id."""
    rnd = random.Random(10)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(5000)]
    rows = [(2 * i + j, t, "a") for i in range(150) for j, t in enumerate(with_changes(rnd, words, 300, 7 + i % 2))]
    sets = shingle_sets(rows)
    assert all(0.75 < len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) < 0.8 for i in range(0, 300, 2))
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame(spark, rows)).collect()}
    assert all(i == c for i, c in got.items())
    (a, b), (c, d) = with_changes(rnd, words, 300, 1), with_changes(rnd, words, 300, 1)
    kept = simhash.one_of_each(frame(spark, [(1, a, "a"), (5, b, "a"), (5, c, "a"), (7, d, "a")])).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(1, a), (5, c)}


def test_near_copies_at_the_similarity_are_found(spark):
    """Against brute force: pairs at 0.80 to 0.86, each only linked to each other; all of short texts, 99 of 100 of long ones."""
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(5000)]
    made = [with_changes(rnd, words, n, c) for n, c in ((300, 5), (300, 6), (220, 4), (520, 11)) for _ in range(100)]
    for n in (8, 9, 10, 11, 12, 16, 24, 30):  # a word more at the end; 4 of 5 shingles are the least
        for _ in range(30):
            a = rnd.choices(words, k=n)
            made.append((" ".join(a), " ".join([*a, rnd.choice(words)])))
    rows = [(2 * i + j, t, "a") for i, two in enumerate(made) for j, t in enumerate(two)]
    sets = shingle_sets(rows)
    true = [i for i in range(0, len(rows), 2) if len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.8]
    assert sum(i < 800 for i in true) >= 390 and sum(i >= 800 for i in true) == 240
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame(spark, rows)).collect()}
    missed = [i for i in true if got[i + 1] != i]
    assert not [i for i in missed if i >= 800] and len(missed) <= 4
    assert all(got[i] == i for i in range(0, len(rows), 2))


def test_targets_by_repeated_sharing(spark):
    rnd = random.Random(3)
    for _ in range(3):
        sizes = {f"s{i}": rnd.randrange(1, 5000) for i in range(rnd.randrange(1, 9))} | {None: 40, "zero": 0}
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        names = [*sorted(s for s in sizes if s is not None), None]
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        left, open_, goal = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
        while open_:
            share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = {s for s in open_ if share[s] >= 2 * sizes[s]}
            if not over:
                goal |= share
                break
            for s in over:
                goal[s] = 2.0 * sizes[s]
                left -= goal[s]
            open_ -= over
        assert got.keys() == goal.keys() and all(abs(got[s] - goal[s]) < 1e-6 for s in goal)


def test_mix(spark):
    df = documents(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()), key=str)
    by: dict = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for some in by.values():
        assert sum(r.taken for r in some) == int(some[0].target)
    out = mixing.mixed(df.where("doc_id is not null").dropDuplicates(["doc_id"]))
    taken = {r.doc_id: r.taken for r in mixing.mix(df.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    words: Counter = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert out.columns == df.columns and {i: n for i, n in taken.items() if n} == dict(words)


def test_mixed_takes_each_row_by_itself(spark):
    """Rows that repeat a doc_id, and rows without one, are in the mix as often as the mix takes each."""
    rows = [(1, "a b c", "s"), (1, "", "s"), (2, "d " * 40, "s"), (2, "e " * 3, "s"), *((None, f"n{i} " * i, "s") for i in range(6)), (4, "f g", "s"), (4, "f g", "s")]
    df = frame(spark, rows)
    for share in (1.0, 1.5, 2.0):
        want = Counter()
        for r in mixing.mix(df, share=share).collect():
            want[r.doc_id, r.size] += r.taken
        got, whole = Counter(), {(i, len((t or "").split())): set((t or "").split()) for i, t, _ in rows}
        for r in mixing.mixed(df, share=share).collect():
            key = next(k for k, w in whole.items() if k[0] == r.doc_id and w & set(r.text.split()))
            got[key] += len(r.text.split())
        assert +want == got


def test_repeated_rows_pass_the_stages(spark):
    """A document given twice is once in the mix: of its two rows the second loses its words, not both."""
    import corpus_pipeline

    rnd = random.Random(9)
    text = [" ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(60)) for _ in range(5)]
    docs = frame(spark, [(1, text[0], "s"), (1, text[0], "s"), (2, text[1], "s"), (None, text[2], "s"), (None, text[2], "s"), (None, text[3], "s"), (None, "", "s"), (3, text[4], "s")])
    for stage in (corpus_pipeline.not_copied, corpus_pipeline.not_repeated):
        docs = spark.createDataFrame((out := stage(spark, docs, "")).collect(), out.schema)
    words = {w for r in mixing.mixed(docs, share=2.0).collect() for w in r.text.split()}
    assert words == {w for t in text for w in t.split()}


def test_warc(spark, tmp_path):
    same = "<p>same</p>" * 50
    rows = [(i, f"http://h/{i}", same if i % 3 == 0 else f"<p>{i}</p>" * (i % 40), "c") for i in range(120)] + [(500, None, None, "c"), (501, "http://x y", "", "c"), (501, "http://x", "", "c"), (600, "u", "é漢" * 40000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, shard string")
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    lists = [warc.write(pages.repartition(n), f, roll=3000, target=20000) for n, f in zip((3, 7), folders, strict=True)]
    files = [sorted(map(tuple, m.collect())) for m in lists]
    assert files[0] == files[1] and len(files[0]) > 3
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(lists[0], folders[0]).collect())
    first, expected = {}, []
    for i, _, html, _ in sorted(rows, key=lambda r: r[0]):
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected.append((i, len(raw), digest, "revisit" if raw in first else "response", first.get(raw)))
        first.setdefault(raw, i)
    assert sorted(got, key=str) == sorted(expected, key=str)
    with pytest.raises(OSError):
        warc.write(pages, folders[0])


def test_toxicity(spark):
    assert toxicity.fold("You 1d10t! MОRОN st​upid covid19 a 100") == " you idiot moron stupid covid19 a 100 "
    rnd = random.Random(9)
    plain = ["".join(rnd.choices("klmnoprst", k=5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = rnd.choices(plain, k=30) + ([rnd.choice(["blarghy", "Bl4rghy", "zonkert"])] if toxic else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words), "a"))
        labels.append((i, 1, int(toxic)))
    df = frame(spark, [*rows, (900, None, "a"), (901, "", "a")])
    lab = spark.createDataFrame([*labels, (None, 1, 1), (7000, 0, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(df, lab.where("doc_id < 300"))
    got = {r.doc_id: r.score for r in toxicity.scores(df, lexicon).collect()}
    assert len(got) == 402 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in range(300, 400)) and got[900] == got[901] < 0.7
    assert toxicity.clean(df, lexicon).columns == df.columns and toxicity.clean(df, lexicon).count() == 302
    assert toxicity.Lexicon().score("anything") == 0.0


def test_exception_phrases():
    lexicon = toxicity.Lexicon(((" kill ", 3.0),), (" kill switch ",), (-3.0, 2.0, 1.0))
    assert lexicon.facts("kill the kill switch") == (3.0, 4) and lexicon.facts("a Kill switch")[0] == 0


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op10_quality(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in scored) >= 0.9 * len(scored)


def test_quality_defaults(spark):
    df = frame(spark, [(1, None, "a"), (2, "x", "a")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.scores(df, quality.learn(df, none)).collect()] == [0.5, 0.5]
    assert len(quality.measures(b"")) == len(quality.measures(b"One. Two\nthree " * 50))


def test_pipeline_runs(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == list(corpus_pipeline.COLUMNS), name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() <= 2 * seen
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()
