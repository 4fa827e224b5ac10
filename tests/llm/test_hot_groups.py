"""Large groups of near copies: what is made of them grows with their members, and no link is lost."""

import random

import numpy as np

from listmill.llm import common, simhash

WORDS = [f"w{i}" for i in range(5000)]


def changed(rnd, base, changes):
    out = list(base)
    for at in rnd.sample(range(5, len(base) - 5, 6), changes):
        out[at] = f"new{rnd.random()}"
    return " ".join(out)


def test_texts_near_a_large_group_meet_it_by_blocks(spark, monkeypatch):
    rnd = random.Random(12)
    base = rnd.choices(WORDS, k=300)
    rows = [(i, changed(rnd, base, 1), "a") for i in range(150)] + [(1000 + i, changed(rnd, base, 8), "a") for i in range(60)]  # 0.97 and 0.76 with the base
    close = list(base)
    close[20:22] = ["x", "y"]
    rows += [(2000, " ".join(close), "a")]  # a member of the group
    made, store = {}, common.stored

    def counted(df, name):
        found = store(df, name)
        made[name] = max(made.get(name, 0), found.count())
        return found

    monkeypatch.setattr(common, "stored", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert {got[i] for i in [*range(150), 2000]} == {0} and all(got[1000 + i] == 1000 + i for i in range(60))
    assert made["simhash-wide-several"] * 3 < made["simhash-wide-mixed"]  # these were as many


def test_blocks_find_what_brute_force_finds(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rnd = np.random.default_rng(4)
    centre = rnd.integers(0, 2, simhash.WIDE, np.uint8)
    bits = {i: centre ^ (rnd.random(simhash.WIDE) < (0.02 + 0.003 * i)) for i in range(60)}
    n = {i: int(rnd.integers(90, 130)) for i in bits}
    side = {i: (i % 3 == 0, i % 2) for i in bits}  # is it a text rather than a member; the group
    rows = {kind: spark.createDataFrame([(i, n[i], side[i][1]) for i in bits if side[i][0] == kind], "id long, n int, main long") for kind in (True, False)}
    prints = spark.createDataFrame([(i, np.packbits(b).tobytes()) for i, b in bits.items()], "id long, bits binary")
    got = [(r.a, r.b) for r in simhash._by_blocks(rows[True], rows[False], prints, 350, 0.8).collect()]
    want = {(min(i, j), max(i, j)) for i in bits for j in bits if side[i][0] and not side[j][0] and side[i][1] == side[j][1] and (bits[i] ^ bits[j]).sum() <= 350 and min(n[i], n[j]) / max(n[i], n[j]) >= 0.8}
    assert len(got) == len(want) and set(got) == want and 50 < len(want) < 400
