"""The nightly extract: what the observations of a board say about each wording of its listings, from the runs since a high-water mark.

A run that began before the mark but hadn't finished by then counts as new, and the merge that takes the result is keyed, so nothing is lost and nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = ("board", "market", "board_job_id")


def high_water(stored: DataFrame, seen: str = "wording_last_seen_at") -> DataFrame:
    """mark: the latest sighting that is stored; null if nothing is."""
    return stored.agg(F.max(seen).alias("mark"))


def since(mark: Column, started: str = "started_at", finished: str = "finished_at") -> Column:
    """Runs from the mark on, and earlier ones that were still going on; all runs if the mark is null."""
    late = (F.col(started) < mark) & (F.col(finished).isNull() | (F.col(finished) >= mark))
    return mark.isNull() | (F.col(started) >= mark) | late


def wording_key(*fields: Column) -> Column:
    """A digest that keeps the fields apart, whatever characters they hold."""
    return F.sha2(F.to_json(F.array(*(F.coalesce(f, F.lit("")) for f in fields))), 256)


def wordings(observations: DataFrame, runs: DataFrame, mark: Column, listing: Sequence[str], wording: Sequence[str], payload: str = "content_hash") -> DataFrame:
    """One row for each wording with a payload seen since the mark: listing, wkey, the wording's fields as last seen, latest_run_id, the latest fingerprint that isn't null, and when listing and wording were first and last seen.

    When a listing was first seen takes all its observations. The newest row comes along in one struct, so the wide rows needn't be joined again.
    """
    seen = observations.join(runs, "run_id")
    first = seen.groupBy(*listing).agg(F.min("started_at").alias("listing_first_seen_at"))
    stamp = F.struct("started_at", "run_id")
    new = seen.where(F.col(payload).isNotNull() & since(mark)).withColumn("wkey", wording_key(*(F.col(c) for c in wording)))
    per = new.groupBy(*listing, "wkey").agg(
        F.min("started_at").alias("wording_first_seen_at"), F.max("started_at").alias("wording_last_seen_at"), F.max_by(F.struct("run_id", *wording), stamp).alias("_last"), F.max_by("fingerprint", F.when(F.col("fingerprint").isNotNull(), stamp)).alias("fingerprint")
    )
    return per.join(first, [*listing]).select(*listing, "wkey", *wording_fields(wording), F.col("_last.run_id").alias("latest_run_id"), "fingerprint", "listing_first_seen_at", "wording_first_seen_at", "wording_last_seen_at")


def wording_fields(wording: Sequence[str]) -> list[Column]:
    return [F.col(f"_last.{c}").alias(c) for c in wording]


def read_plan(rows: DataFrame, key: Sequence[str], most: int) -> DataFrame:
    """key, size (bytes of the rows as JSON), buckets: into how many buckets of at most so many bytes, about, a key's rows are dealt."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*rows.columns))))
    return rows.groupBy(*key).agg(size.alias("size")).withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("size") / most)).cast("long"))


def bucket(rows: DataFrame, column: str, n: int, k: int) -> DataFrame:
    """The k-th of n hash buckets; a key's rows are all in one."""
    return rows.where(F.pmod(F.hash(column), F.lit(n)) == k)


def halves(n: int, k: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """A bucket that is too large, as two buckets (n, k) of twice as many."""
    return (2 * n, k), (2 * n, k + n)


class Ledger:
    """Batches that are done, each as an empty file in a shared folder, so that a run that was stopped goes on where it was."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder = folder

    def done(self) -> set[str]:
        at = self._path(self.folder)
        return {f.getPath().getName() for f in self._fs.listStatus(at)} if self._fs.exists(at) else set()

    def run(self, batches: Iterable[str], work: Callable[[str], None]) -> list[str]:
        """Works on the batches that aren't done, in order; each counts as done once its work has returned. Work must bear being done twice."""
        before, ran = self.done(), []
        for name in batches:
            if name not in before:
                work(name)
                self._fs.create(self._path(f"{self.folder}/{name}"), True).close()
                ran.append(name)
        return ran


def unchanged(state: dict, observed: dict, inserted: int = 0) -> bool:
    """May a run be skipped: nothing was inserted, the last one completed, and every version it read is still the current one."""
    return not inserted and state.get("status") == "complete" and all(state.get(k) == v for k, v in observed.items())
