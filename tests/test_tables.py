"""Versioned tables, merges and components."""

import random

import pytest
from pyspark.sql import functions as F

from listmill.operators import merge
from listmill.operators.components import components, guarded_components, replay
from listmill.sources.tables import Commit, Conflict, Table, changes_data, freshness


def test_versions(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    rows = spark.range(5).withColumn("x", F.lit("old"))
    assert t.version() == -1
    assert t.replace(rows, {"bound": "7"}) == 0
    assert t.merge_new(spark.range(3, 8).withColumn("x", F.lit("new")), ["id"]) == 1
    assert {(r.id, r.x) for r in t.read().collect()} == {(i, "old" if i < 5 else "new") for i in range(8)}
    assert t.read(0).count() == 5
    assert t.merge_new(rows, ["id"]) == 2
    assert not changes_data(t.history()[-1]) and t.data_version() == 1
    assert freshness(t, 1) == [] and freshness(t, 0) == ["version 1 (MERGE) changed rows"]
    with pytest.raises(Conflict):
        t._commit("WRITE", [], (0, 0, 0), {}, 1)
    with pytest.raises(LookupError):
        t.read(9)


def test_commit_rules():
    assert changes_data(Commit(1, "MERGE", None, 0, 0, ())) and not changes_data(Commit(1, "OPTIMIZE", 5, 0, 0, ()))


def test_upsert_ties_and_nulls(spark):
    old = spark.createDataFrame([("a", 10, 12, "old", "f")], "k string, first int, last int, v string, fp string").withColumn("stamp", F.col("last"))
    new = spark.createDataFrame([("a", 9, 12, "new", None), ("b", 1, 1, "x", None)], "k string, first int, last int, v string, fp string").withColumn("stamp", F.col("last"))
    got = {r.k: r for r in merge.upsert(old, new, ["k"], ["first"], ["last"], "stamp", ["v"], ["fp"]).collect()}
    assert (got["a"].first, got["a"].last, got["a"].v, got["a"].fp) == (9, 12, "new", "f")
    assert got["b"].fp is None


def test_changed_treats_nulls_as_values(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (3, "y"), (4, "z")], "k int, v string")
    assert sorted(r.k for r in merge.changed(old, new, ["k"], ["v"]).collect()) == [2, 3]


def test_components_and_guard(spark):
    rnd = random.Random(4)
    for n in range(3):
        edges = list({tuple(sorted(rnd.sample(range(40), 2))) for _ in range(rnd.randrange(5, 45))})
        mark = {i: rnd.choice(["intern", "graduate"]) for i in range(40) if rnd.random() < 0.3}
        links = spark.createDataFrame(edges, "a long, b long")
        plain = {r.node: r.component for r in components(links).collect()}
        assert plain == replay(edges, {})
        marks = spark.createDataFrame([*mark.items(), (999, None)], "node long, mark string")
        assert {r.node: r.component for r in guarded_components(links, marks).collect()} == replay(edges, mark), n


def test_guard_example():
    assert replay([("a", "b"), ("b", "c")], {"a": "intern", "c": "graduate"}) == {"a": "a", "b": "a", "c": "c"}


def test_empty_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
