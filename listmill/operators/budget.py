"""Spending: prices of tokens, running budgets, estimates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def cost(tokens: Column, per_million: Column) -> Column:
    """A decimal price, to a millionth."""
    return F.round(tokens.cast("decimal(20,0)") * per_million.cast("decimal(12,6)") / F.lit(1_000_000), 6).cast("decimal(12,6)")


def prefix_within(rows: DataFrame, order: Sequence[Column], limits: Mapping[str, float], group: Sequence[str] = ()) -> DataFrame:
    """The longest prefix of each group in an order whose sums stay within all limits; it ends before the first row that would pass one."""
    by = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    so_far = by.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    over = F.lit(False)
    for column, most in limits.items():
        over = over | (F.sum(column).over(so_far) > most)
    return rows.withColumn("_over", over.cast("int")).withColumn("_ended", F.max("_over").over(so_far)).where("_ended = 0").drop("_over", "_ended")


def estimate(rows: DataFrame, value: str, share: float = 0.9) -> DataFrame:
    """n, mean, deviation and the element at a share of the sorted values (exact, not interpolated)."""
    return rows.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("deviation"), F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {value})").alias("at_share"))


def outcomes(attempts: DataFrame, key: str, most: int) -> DataFrame:
    """key, outcome of all attempts (columns status: valid, invalid, failed or missing): valid if any is, terminal after `most`, else retry."""
    per = attempts.groupBy(key).agg(F.bool_or(F.col("status") == "valid").alias("ok"), F.count("*").alias("n"))
    return per.select(key, F.when(F.col("ok"), "valid").when(F.col("n") >= most, "terminal").otherwise("retry").alias("outcome"))
