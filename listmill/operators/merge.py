"""Merges, differences and checks between a stored table and what arrives."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_only(target: DataFrame, arrived: DataFrame, key: Sequence[str]) -> DataFrame:
    """target and those arrived rows whose key it lacks."""
    return target.unionByName(arrived.join(target.select(*key), [*key], "left_anti"))


def upsert(target: DataFrame, arrived: DataFrame, key: Sequence[str], earliest: Sequence[str], latest: Sequence[str], by: str, newest: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keyed merge by aggregation: `earliest` columns take the least, `latest` the greatest, `newest` the value of the row with the greatest `by` (arrived rows win ties), `keep` newest value that isn't null."""
    both = target.withColumn("_seq", F.lit(0)).unionByName(arrived.withColumn("_seq", F.lit(1)))
    order = F.struct(by, "_seq")
    return both.groupBy(*key).agg(
        *(F.min(c).alias(c) for c in earliest), *(F.max(c).alias(c) for c in latest), *(F.max_by(c, order).alias(c) for c in newest), *(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in keep)
    )


def changed(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of new whose key is in old and whose columns differ from it, nulls compared like values."""
    was = old.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return new.join(was, [*key]).where(differs).select(*new.columns)


def diff_states(prior: DataFrame, seen: DataFrame, key: Sequence[str], signal: str) -> DataFrame:
    """key, state of what was seen: new, unresolved (prior without signal), changed or unchanged."""
    was = prior.select(*key, F.col(signal).alias("_was"), F.lit(True).alias("_known"))
    state = F.when(F.col("_known").isNull(), "new").when(F.col("_was").isNull(), "unresolved").when(F.col("_was") != F.col(signal), "changed").otherwise("unchanged")
    return seen.join(was, [*key], "left").select(*key, state.alias("state"))


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """side, n: distinct keys that only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only = a.join(b, key, "left_anti").select(F.lit("left").alias("side")).unionByName(b.join(a, key, "left_anti").select(F.lit("right").alias("side")))
    return only.groupBy("side").agg(F.count("*").alias("n"))


def append_only(before: DataFrame, now: DataFrame, key: Sequence[str]) -> DataFrame:
    """before, added, now, append_only: whether now is before and rows with new keys."""
    added = now.join(before.select(*key), [*key], "left_anti")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    counts = n(before, "before").join(n(added, "added")).join(n(now, "now"))
    return counts.select("*", (F.col("before") + F.col("added") == F.col("now")).alias("append_only"))


def out_of_order(before: DataFrame, arrived: DataFrame, key: str, order: Sequence[str], id_: str) -> DataFrame:
    """Arrived rows that aren't after the latest stored row of their key."""
    last = before.groupBy(key).agg(F.max(F.struct(*order)).alias("_last"))
    return arrived.join(last, key).where(F.struct(*order) <= F.col("_last")).select(id_, key)


def replace_keys(rows: DataFrame, keys: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """rows without those of the keys, and the new ones, in one step."""
    return rows.join(keys.select(*key).distinct(), [*key], "left_anti").unionByName(new)


def page_after(rows: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next rows by key after the last one read: a filter that reaches the scan, and the least keys only."""
    return rows.where(F.col(key) > F.lit(last)).orderBy(key).limit(size)


def dumped(df: DataFrame, name: str, hook: Callable[[str, DataFrame], None] | None = None) -> DataFrame:
    """df, shown to a hook on the way, if there is one."""
    if hook is not None:
        hook(name, df)
    return df


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def invariants(checks: Mapping[str, DataFrame]) -> DataFrame:
    """name, violations: the number of rows of each check."""
    out = None
    for name, df in checks.items():
        row = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def cascade(*rules: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds."""
    out = F
    for condition, name in rules:
        out = out.when(condition, name)
    return out.otherwise(otherwise)
