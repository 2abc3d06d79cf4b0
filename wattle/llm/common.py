"""Helpers shared by the corpus operators: tables, lineage cuts, global row order."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table through Spark's reader (works for any Hadoop path)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a scan of it.

    Cuts the lineage: a lost executor costs only the re-read of files that all
    executors share, never a recomputation with other row order."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/wattle-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(*frames: DataFrame) -> None:
    """Delete tables written by ``keep`` that no later step reads."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        conf = sc._jsc.hadoopConfiguration()
        for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = sc._jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(conf).delete(p, True)


def give_back() -> None:
    """What this Python worker has freed goes back to the system: Arrow's pool and the C heap else keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


#: batches after which a step gives freed memory back
GIVE_BACK_EVERY = 16


def thrifty(step: Callable) -> Callable:
    """A ``mapInArrow`` step that gives freed memory back, now and then and at its end: workers serve many
    steps in turn, and an executor holds them all beside its heap."""
    def run(batches):
        try:
            for i, out in enumerate(step(batches), 1):
                yield out
                if i % GIVE_BACK_EVERY == 0:
                    give_back()
        finally:
            give_back()
    return run


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_base(totals: DataFrame, shard: str, value: str) -> DataFrame:
    """Exclusive running sum over the rows of ``totals``, one for each written shard
    (as many as shuffle partitions, whatever the input)."""
    w = Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(shard, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias("base"))


def sql_text(c: str | Column) -> Column:
    """Text with null read as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
