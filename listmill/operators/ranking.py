"""Ranked queues: order, clusters, facets, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import cut


def ranked(rows: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """rows with their place in a total order. Ranges are sorted apart and their sizes added up, so no task gets all rows."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    local = dealt.withColumn("_in", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    local = cut(local)  # borders of ranges are sampled, and a second run could draw others
    sizes = local.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part").alias("_p"), (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return local.join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_part", "_p", "_in", "_before")


def clustered(rows: DataFrame, order: Sequence[Column], cluster: Column, alone: Column) -> DataFrame:
    """rows with position, and leader: the first position of their cluster, or of `alone` where the cluster is null."""
    placed = ranked(rows, order)
    key = F.coalesce(F.concat(F.lit("c:"), cluster.cast("string")), F.concat(F.lit("a:"), alone.cast("string")))
    return placed.withColumn("_key", key).withColumn("leader", F.min("position").over(W.partitionBy("_key"))).drop("_key")


def facets(rows: DataFrame, filters: Mapping[str, Column]) -> DataFrame:
    """facet, value, n: counts by each facet under the filters of the others, in one pass over the rows."""
    arms = []
    for name in filters:
        others = F.lit(True)
        for other, keep in filters.items():
            if other != name:
                others = others & keep
        arms.append(F.when(others, F.struct(F.lit(name).alias("facet"), F.col(name).cast("string").alias("value"))))
    each = rows.select(F.explode(F.array_compact(F.array(*arms))).alias("f"))
    return each.groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def page(rows: DataFrame, ordinal: str, number: int, size: int) -> DataFrame:
    """One page of rows that carry their place; pages count from 1."""
    return rows.where(F.col(ordinal).between((number - 1) * size + 1, number * size))


def page_of(ordinal: int, size: int) -> int:
    return (ordinal - 1) // size + 1


def page_buttons(current: int, pages: int) -> list[int]:
    """First, last and those beside the current page; 0 is a gap."""
    shown = sorted({1, pages, *(p for p in (current - 1, current, current + 1) if 1 <= p <= pages)})
    out: list[int] = []
    for p in shown:
        if out and p - out[-1] > 1:
            out.append(0)
        out.append(p)
    return out
