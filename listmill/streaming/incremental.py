"""Incremental forms: streams of observations into keyed state, one micro-batch at a time.

Nothing may be dropped for being late, so there are no watermarks: a batch is merged by key, and merging a batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dates
from ..operators import merge
from ..sources.tables import Table


class OutOfOrder(RuntimeError):
    """A batch holds rows that aren't after the stored ones of their key: the state has to be built anew."""


def observations(spark: SparkSession, folder: str, schema: str, files: int = 100) -> DataFrame:
    """A stream of Parquet files with a fixed schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def merged_into(stream: DataFrame, table: Table, checkpoint: str, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> StreamingQuery:
    """Each batch becomes a new version of the table: combine(state, batch), state being None at first. The batch's number is kept with the version, so one that runs twice is merged once."""

    def step(batch: DataFrame, number: int) -> None:
        log = table.history()
        if log and int(log[-1].properties.get("batch", -1)) >= number:
            return
        table.replace(combine(table.read() if log else None, batch), {"batch": str(number)})

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def insert_only(key: Sequence[str]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    def combine(state: DataFrame | None, batch: DataFrame) -> DataFrame:
        batch = batch.dropDuplicates([*key])
        return batch if state is None else merge.insert_only(state, batch, key)

    return combine


def memberships(key: Sequence[str], stamp: str, value: str) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """key, first_seen, last_seen, value (of the last)."""

    def combine(state: DataFrame | None, batch: DataFrame) -> DataFrame:
        new = batch.groupBy(*key).agg(F.min(stamp).alias("first_seen"), F.max(stamp).alias("last_seen"), F.max_by(value, stamp).alias(value))
        if state is None:
            return new
        rows = [x.withColumn("_by", F.col("last_seen")) for x in (state, new)]
        return merge.upsert(*rows, [*key], ["first_seen"], ["last_seen"], "_by", [value])

    return combine


def in_order(key: str, order: Sequence[str], id_: str, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """combine, but a batch with rows that aren't after the state's is refused."""

    def checked(state: DataFrame | None, batch: DataFrame) -> DataFrame:
        if state is not None and merge.out_of_order(state, batch, key, order, id_).head(1):
            raise OutOfOrder(f"rows of the batch come before the last of their {key}")
        return combine(state, batch)

    return checked


def night_counts(stream: DataFrame, stamp: str) -> DataFrame:
    """night, n: a running count by collection night, in complete mode."""
    return stream.groupBy(dates.night(F.col(stamp)).alias("night")).agg(F.count("*").alias("n"))
