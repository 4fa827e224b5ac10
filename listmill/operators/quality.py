"""Checks of staged rows, mappings, schemas and graphs: each says how many rows break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import merge


class Violated(RuntimeError):
    """Checks that rows must pass before they are published."""


def require(found: DataFrame, context: str) -> None:
    """found: name, violations. Any violation is an error."""
    broken = found.where("violations > 0").orderBy("name").collect()  # a row for each check
    if broken:
        raise Violated(f"{context}: " + "; ".join(f"{r.name}: {r.violations}" for r in broken))


def staged(rows: DataFrame, source: DataFrame, key: Sequence[str], together: Sequence[tuple[str, str]] = (), arrays: Sequence[str] = (), target: DataFrame | None = None) -> DataFrame:
    """name, violations of staged rows against what they were read from: null or repeated keys, columns that must be null together, empty arrays, missing and extra keys, keys that the target has already.

    What one pass can tell is told by one pass.
    """
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    own = {"null_identity": n(_any([F.col(k).isNull() for k in key]))}
    own |= {f"not_together_{a}_{b}": n(F.col(a).isNull() != F.col(b).isNull()) for a, b in together}
    own |= {"empty_arrays": n(_any([F.size(a) == 0 for a in arrays]))} if arrays else {}
    counts = rows.agg(*(c.alias(name) for name, c in own.items()))
    stacked = counts.select(F.inline(F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).alias("violations")) for name in own))))
    have, need = rows.select(*key), source.select(*key)
    others = {"repeated_keys": merge.duplicate_keys(rows, key), "missing_keys": need.subtract(have), "extra_keys": have.subtract(need)}
    if target is not None:
        others["already_there"] = have.join(target.select(*key), [*key], "left_semi")
    return stacked.unionByName(merge.invariants(others))


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def mapping(rows: DataFrame, memberships: DataFrame, listing: Sequence[str], sep: str = ":") -> DataFrame:
    """name, violations of a mapping (listing, fp, canonical_job_id, canonicalized_at) from memberships (listing, fp, null fp for a sighting without wording)."""
    usable, sentinels = rows.where("fp is not null"), rows.where("fp is null")
    wanted, never = memberships.where("fp is not null"), memberships.groupBy(*listing).agg(F.count("fp").alias("n")).where("n = 0")
    own, full = F.concat_ws(sep, *listing), F.concat_ws(sep, *listing, "fp")
    ids = usable.select("canonical_job_id").distinct()
    stamps = rows.agg(F.count("*").alias("all"), F.count("canonicalized_at").alias("n"), F.countDistinct("canonicalized_at").alias("d")).where("all = 0 or n < all or d <> 1")
    return merge.invariants({
        "null identity or id": rows.where(_any([F.col(c).isNull() for c in (*listing, "canonical_job_id")])), "repeated logical key": merge.duplicate_keys(rows, [*listing, "fp"]),
        "malformed sentinel": sentinels.where(F.col("canonical_job_id") != own), "wording that nobody has": usable.select("fp").subtract(wanted.select("fp")),
        "membership missing": wanted.select(*listing, "fp").subtract(usable.select(*listing, "fp")), "membership extra": usable.select(*listing, "fp").subtract(wanted.select(*listing, "fp")),
        "sentinel missing": never.select(*listing).subtract(sentinels.select(*listing)), "sentinel beside a wording": sentinels.join(wanted.select(*listing).distinct(), [*listing], "left_semi"),
        "sentinel of an unknown listing": sentinels.join(memberships.select(*listing).distinct(), [*listing], "left_anti"), "id of a stranger": ids.subtract(usable.where(F.col("canonical_job_id").isNotNull()).select(full.alias("canonical_job_id"))),
        "wording in several groups": usable.groupBy("fp").agg(F.countDistinct("canonical_job_id").alias("n")).where("n > 1"), "not one time of mapping": stamps,
    })


def mixed_groups(rows: DataFrame, group: str, value: Column, both: Sequence[str]) -> DataFrame:
    """Groups that hold all of some values that mustn't meet."""
    return rows.groupBy(group).agg(*(F.bool_or(F.coalesce(value == v, F.lit(False))).alias(f"_{i}") for i, v in enumerate(both))).where(" and ".join(f"_{i}" for i in range(len(both)))).select(group)


def graph(components: DataFrame, edges: DataFrame, memberships: DataFrame) -> DataFrame:
    """One row about a graph's components (node, component), accepted edges (a, b, jaccard) and memberships (node). size_p50: the size at half of the sorted sizes, the upper one of two."""
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    per_size = sizes.groupBy("size").agg(F.count("*").alias("c"))  # a row for each size that occurs
    run = per_size.withColumn("upto", F.sum("c").over(W.orderBy("size"))).withColumn("all", F.sum("c").over(W.partitionBy(F.lit(1))))
    median = run.agg(F.coalesce(F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col("size"))), F.lit(0)).alias("size_p50"))
    nodes = sizes.agg(F.count("*").alias("components"), F.coalesce(F.max("size"), F.lit(0)).alias("largest_component_nodes"))
    rows = memberships.join(components, "node").groupBy("component").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("largest_component_rows"))
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("d")).agg(F.coalesce(F.max("d"), F.lit(0)).alias("max_node_degree"))
    linked = edges.join(components.withColumnRenamed("node", "a"), "a").agg(F.countDistinct("component").alias("near_components"), F.count("*").alias("accepted_edges"), F.min("jaccard").alias("weakest_accepted_edge"))
    out = nodes
    for one in (median, rows, ends, linked):
        out = out.crossJoin(F.broadcast(one))  # each is one row
    return out


def schema_differences(found: T.StructType, expected: str | T.StructType) -> list[tuple[str, str | None, str | None]]:
    """column, expected type, found type, of each column that isn't as agreed."""
    want = T.StructType.fromDDL(expected) if isinstance(expected, str) else expected
    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (want, found))
    return [(c, a.get(c), b.get(c)) for c in [*a, *(x for x in b if x not in a)] if a.get(c) != b.get(c)]


def contract(tables: Mapping[str, tuple[DataFrame, str]]) -> list[tuple[str, str, str | None, str | None]]:
    """table, column, expected, found of all tables that aren't as agreed."""
    return [(name, *d) for name, (df, ddl) in tables.items() for d in schema_differences(df.schema, ddl)]
