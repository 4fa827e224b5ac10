"""Connected components, plain and guarded."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut, dropped, stored


def components(links: DataFrame) -> DataFrame:
    """links: columns a, b of one orderable type. Returns node, component (the least node reachable) for each node in links.

    Each round, every node's parent becomes the least of its grandparent and its neighbours' grandparents, and the
    parents of linked nodes are hooked to those too, so trees of any depth fall in logarithmically many rounds. A round
    is a few shuffles over the linked nodes, with partial minima before each shuffle and the result cut to the shared folder.
    """
    pairs = stored(links.where("a <> b").select("a", "b").distinct(), "components-links")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    parents = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("parent")), "components")
    while True:
        grand = parents.alias("x").join(parents.alias("y"), F.col("x.parent") == F.col("y.node")).select("x.node", "x.parent", F.col("y.parent").alias("grand"))
        offered = both.join(grand, both.b == grand.node).select("a", "grand")  # to a, from its neighbour b
        best = offered.groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("best"))
        step = grand.join(best, "node")
        hooks = step.select(F.col("parent").alias("node"), "best").unionByName(step.select("node", F.least("best", "grand").alias("best")))
        least = hooks.groupBy("node").agg(F.min("best").alias("best"))
        new = stored(parents.select("node", "parent").join(least, "node", "left").select("node", F.least("parent", "best").alias("parent"), (F.col("best") < F.col("parent")).alias("moved")), "components")
        dropped(parents)
        parents = new
        if not new.where("moved").head(1):
            dropped(pairs)
            return parents.select("node", F.col("parent").alias("component"))


def replay(edges: Iterable[tuple], mark: dict) -> dict:
    """node -> root of edges joined in ascending order, where a join that would bring two different marks together is left out."""
    root: dict = {}
    marks: dict = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in sorted(edges):
        x, y = find(a), find(b)
        if x == y:
            continue
        have = {marks.get(x, mark.get(x)), marks.get(y, mark.get(y))} - {None}
        if len(have) > 1:
            continue
        low, high = min(x, y), max(x, y)
        root[high] = low
        if have:
            marks[low] = have.pop()
    return {x: find(x) for x in list(root)}


def guarded_components(links: DataFrame, marks: DataFrame) -> DataFrame:
    """Like components(), but no component holds two different marks (marks: node, mark): links are joined in ascending order and those that would do so are left out.

    A guard only leaves links out, so guarded components lie within plain ones: only plain components with several marks are replayed, each by itself.
    """
    pairs = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    plain = cut(components(pairs))
    marked = plain.join(marks.where(F.col("mark").isNotNull()), "node", "left")
    mixed = marked.groupBy("component").agg(F.countDistinct("mark").alias("n")).where("n > 1").select("component")
    open_ = pairs.join(marked.join(mixed, "component").select(F.col("node").alias("a"), "component", F.col("mark").alias("mark_a")), "a")
    open_ = open_.join(marked.select(F.col("node").alias("b"), F.col("mark").alias("mark_b")), "b").select("component", "a", "b", "mark_a", "mark_b")
    kind = dict(plain.dtypes)["node"]

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mark = {n: m for n, m in [*zip(rows.a, rows.mark_a, strict=True), *zip(rows.b, rows.mark_b, strict=True)] if isinstance(m, str)}
        got = replay(zip(rows.a, rows.b, strict=True), mark)
        return pd.DataFrame({"node": list(got), "component": list(got.values())})

    replayed = open_.groupBy("component").applyInPandas(one, f"node {kind}, component {kind}")
    return plain.join(mixed, "component", "left_anti").select("node", "component").unionByName(replayed)
