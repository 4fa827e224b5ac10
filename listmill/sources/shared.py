"""The folder that driver and executors share, and cuts of lineage in it."""

from __future__ import annotations

import re
import uuid
import weakref
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only by a session in one JVM that names no shared folder, as in local tests.
LOCAL = "/tmp/checkpoints/listmill"
#: Set while tables are stored: shuffle files go when the execution that wrote them ends, and Python workers get a thousand rows at a time, as rows may be long texts.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where all runs in one JVM."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master or ""):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found or LOCAL)
    return (found or LOCAL).rstrip("/")


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Inside, SETTINGS hold: no later execution reads the shuffles of one that runs here."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """checkpoint(): the rows are written once to the shared folder, so lost executors cost no recomputing of what came before."""
    shared_dir(df.sparkSession)
    with swept(df.sparkSession):
        return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like cut(), as a table: what reads it starts from a plain scan, so Spark can choose exchanges, split skewed ones and prune columns."""
    return stored_in_parts([df], name)


def stored_in_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One table of the rows of parts (one at least, of one schema), written one after the other: the shuffle files of each go before the next is worked out."""
    path = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with swept(spark):
            part.write.mode("append").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    _PATHS[table] = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes what stored() wrote. Only for tables whose readers have themselves been stored or cut."""
    for table in tables:
        if path := _PATHS.pop(table, None):
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
