"""Materialised intermediate tables in the shared checkpoint folder.

The consolidated wide table is the product of the ingestion job; diagnostics
and EDA re-read it instead of recomputing six source pipelines and five
joins each time (as the reference's diagnostics re-read its written output).
It is written once per session and input state, partitioned by
``aggregation_level`` so grain filters prune whole directories, into the
folder named by ``spark.checkpoint.dir`` (never a machine-local path on a
cluster); this also cuts the lineage of everything downstream.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import TABLES
from . import consolidate as C

_LOCK = threading.RLock()   # re-entrant: a materialised build may materialise its inputs
_DONE: dict[str, str] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, tables=TABLES) -> str:
    """Name, size and modification time of every input file, via the Hadoop FS API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = [sf_dir]
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                st = files.next()
                parts.append(f"{t}:{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:16]


def materialized(spark: SparkSession, name: str, sf_dir: str, build, partition_by=None,
                 tables=TABLES) -> DataFrame:
    """Write ``build()`` once per (session, name, input state) into the shared
    checkpoint folder and return a scan of it (lineage cut, no recomputation
    of the upstream aggregation by later queries or after an executor loss)."""
    key = f"{spark.sparkContext.applicationId}-{name}-{_fingerprint(spark, sf_dir, tables)}"
    with _LOCK:
        path = _DONE.get(key)
        if path is None:
            path = f"{checkpoint_dir(spark).rstrip('/')}/{key}"
            w = build().write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _DONE[key] = path
    return spark.read.parquet(path)


def consolidated_table(spark: SparkSession, sf_dir: str, how: str = "join") -> DataFrame:
    return materialized(spark, f"consolidated-{how}", sf_dir, lambda: C.consolidated(spark, sf_dir, how),
                        partition_by=["aggregation_level"])


def order_days_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order moments by day, written once: the carbon and the climate sheet share this one scan."""
    from ..sources import standins
    return materialized(spark, "order-days", sf_dir, lambda: standins.order_days(spark, sf_dir), tables=("orders",))


def shipped_months_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly measures of ``lineitem``, written once: the production and the gas sheet share this one scan."""
    from ..sources import standins
    return materialized(spark, "shipped-months", sf_dir, lambda: standins.shipped_months(spark, sf_dir),
                        tables=("lineitem",))


def carbon_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-level carbon sheet, written once: the carbon pipeline reads it in two
    branches (raw daily rows and the weekly/monthly means)."""
    from ..sources import standins
    return materialized(spark, "carbon-raw", sf_dir, lambda: standins.carbon_sheet(order_days_table(spark, sf_dir)),
                        tables=("orders",))


def reading_hours_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and non-null prices by source year and hour, written once: tells the scans that want
    a year's first readings which few hours to read."""
    from ..sources import standins

    def build():
        r = C.select_era_columns(standins.electricity_readings(spark, sf_dir), "source_year", standins.ELECTRICITY_ERAS)
        return r.groupBy("source_year", F.date_trunc("hour", "timestamp").alias("hour")).agg(
            F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in standins.ELECTRICITY_ERAS])
    return materialized(spark, "reading-hours", sf_dir, build, tables=("events",))


def release(spark: SparkSession) -> int:
    """Delete this session's materialised tables from the shared folder (Hadoop FS
    API, so the same call works on object stores); returns how many were removed."""
    app = spark.sparkContext.applicationId
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    with _LOCK:
        for key, path in list(_DONE.items()):
            if key.startswith(app):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)
                _DONE.pop(key)
                n += 1
    return n
