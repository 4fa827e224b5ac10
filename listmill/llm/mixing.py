"""Mixing sources to target weights: hash-random order, prefix sums of token counts, exact cuts, whole epochs before them.

Each source has a budget of words. Its documents stand in the order of a hash-random key; each epoch takes them all, and the
last one takes them up to the budget, cutting the document on the border. As the keys are uniform, ranges of equal width are
balanced, so a source is range-sorted into as many ranges as its row count asks for without sampling: a hot source is split like
any other, ranges' sums are added up over few rows, and a document's place needs only its own range.

Defined results: null text has size 0 and nothing to take; a null source is a source of its own, after all others; repeated rows
(also of one doc_id, or without one) each count, ordered by size, and are each taken by themselves; sources without words get target 0; an empty table gives an empty table; extra
columns are ignored (mix) or kept (mixed).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

#: Fixed values of the contract: weights by rank of the source, share of all words, and the most a source may be repeated.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
#: Rows of one source in a range, about.
RANGE_ROWS = 1_000
#: Targets of so many sources at most (some MB) are broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 50_000
SEED = "mix-1"


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def key(doc_id: Column, seed: str = SEED) -> Column:
    """Hash-random, 0 to 2^60 - 1; the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, place (its rank), source_size, n, target from sized rows (source, size).

    Water filling: sources are capped in the order of cap / weight, the others share what is left by weight. One row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    weight = F.element_at(F.array(*(F.lit(w).cast("double") for w in weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("place", F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    order = W.orderBy(F.col("cap") / F.col("weight"), "place")
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(1))
    level = (F.lit(share) * F.sum("source_size").over(whole) - (F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("cap"))) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("cap") / F.col("weight") > F.col("level"))
    first = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(whole)
    lit = leveled.withColumn("water", first["level"])
    target = F.when(F.col("water").isNull() | (F.col("cap") <= F.col("water") * F.col("weight")), F.col("cap")).otherwise(F.col("water") * F.col("weight"))
    return lit.select("source", "place", "source_size", "n", target.alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: str = SEED, row: tuple = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) for every row, and the columns `row`, which order rows of one doc_id and size."""
    sized = common.cut(docs.select("doc_id", "source", size(F.col("text")).alias("size"), *row))
    goal = common.cut(targets(sized, weights, share, repeats).withColumnRenamed("source", "s"))
    goal = F.broadcast(goal) if goal.count() <= BROADCAST_SOURCES else goal
    keyed = sized.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("key", key(F.col("doc_id"), seed))
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    keyed = keyed.withColumn("range", F.floor(F.col("key") / F.lit(float(1 << 60)) * ranges).cast("long"))
    sums = keyed.groupBy("place", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy("place").orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("words")
    offsets = common.cut(sums.select("place", "range", before.alias("offset")))
    inside = W.partitionBy("place", "range").orderBy("key", "doc_id", "size", *row).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = keyed.withColumn("before", F.sum("size").over(inside) - F.col("size"))
    placed = placed.join(offsets, ["place", "range"]).withColumn("before", F.col("before") + F.col("offset"))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats))).otherwise(0)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - whole * F.col("source_size") - F.col("before")))
    return placed.select("doc_id", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken"), "source", *row)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row as often as it is taken whole, and on a source's border a last copy with the words taken.

    Rows get numbers of their own, as doc_id may repeat or be null; those of one doc_id and size stand in the order of their texts' hash.
    """
    name = f"row_{uuid.uuid4().hex}"
    rows = common.stored(docs.withColumn(name, F.monotonically_increasing_id()), "mixing-rows")
    taken = mix(rows.withColumn(f"{name}_text", F.xxhash64("text")), row=(f"{name}_text", name), **how).where("taken > 0").select(name, "taken", "size")
    # only rows with words are taken, so size isn't 0
    each = rows.join(taken.withColumnsRenamed({"taken": f"{name}_taken", "size": f"{name}_size"}), name)
    taken, size = F.col(f"{name}_taken"), F.col(f"{name}_size")
    each = each.withColumn(f"{name}_copy", F.explode(F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))))
    left = taken - (F.col(f"{name}_copy") - 1) * size
    words = F.slice(F.regexp_extract_all("text", F.lit(common.WORD), F.lit(0)), F.lit(1), left.cast("int"))
    text = F.when(left >= size, F.col("text")).otherwise(F.array_join(words, " "))
    columns = [text.alias("text") if c == "text" else F.length(text).cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns]
    return each.select(*columns)
