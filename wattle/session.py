"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for calendar maths, AQE for runtime
# re-planning (coalesce small shuffles, split skewed partitions), Arrow for
# the few pandas boundaries.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by bytes (advisory 64 MB), not by default
    # parallelism: tiny bin-level shuffles collapse to a few tasks, large ones
    # still split into ~64 MB partitions
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "wattle",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the base settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the session-level settings a job depends on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    # texts are long: a Python worker holds a few MB of rows at a time, not 10,000 rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ship_package(spark)


_SHIP_LOCK = threading.Lock()
_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``wattle`` importable in Python workers (pandas steps pickle functions
    by module reference): the package is zipped once per driver process and
    added with ``addPyFile`` once per SparkContext."""
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        zpath = _SHIPPED.get("_zip")
        if zpath is None:
            zpath = os.path.join(tempfile.mkdtemp(prefix="wattle-pkg-"), "wattle.zip")
            with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
                for root, _, files in os.walk(pkg):
                    for f in files:
                        if f.endswith(".py"):
                            full = os.path.join(root, f)
                            z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
            _SHIPPED["_zip"] = zpath
        sc.addPyFile(zpath)
        _SHIPPED[app] = zpath


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may do
    without: there a scratch folder is made; on a cluster executors would each
    write to their own disk, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="wattle-ckpt-")
    sc.setCheckpointDir(d)
    return d


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (Hadoop FS API: works for local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def size_shuffles(spark: SparkSession, total_input_bytes: int, bytes_per_partition: int = 256 << 20,
                  min_partitions: int = 200, max_partitions: int = 200_000) -> int:
    """Size the initial shuffle fan-out from the input volume so partitions fit in
    executor memory without spilling (AQE then coalesces small stages and splits
    skewed ones). Scan splits follow the same target."""
    n = max(min_partitions, min(max_partitions, -(-total_input_bytes // bytes_per_partition)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(bytes_per_partition, 128 << 20)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_per_partition))
    return n
