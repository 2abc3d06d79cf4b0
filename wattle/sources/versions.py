"""Tables that are replaced as a whole: staged under a new name, checked, then made current by a small pointer file.

``path/_current.json`` names the version that readers see, its schema and the state
of the inputs it was made from. A run that dies while it writes leaves the pointer, and
so the old version, as it was; its half-written folder goes with the next version that
is published. The version before the current one stays for readers that have it open.
All calls go through the Hadoop file system, so local folders, HDFS and object stores work alike.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_current.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, path: str) -> dict | None:
    """What the pointer says (version, before, rows, inputs, schema); None where nothing was published."""
    fs, p = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, state: dict) -> None:
    """Replace the pointer in one step: write beside it, rename over it."""
    sc = spark.sparkContext
    fs, new = _fs(spark, f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(new)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    rename = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    _, old = _fs(spark, f"{path}/{POINTER}")
    sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), sc._jsc.hadoopConfiguration()).rename(new, old, how)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), inputs: str = "") -> dict:
    """Write ``df`` as the new current version of ``path``; returns the new pointer state.

    The rows counted while writing must be the rows that the written files hold, else the
    old version stays current and the call fails."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = current(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    state = {"version": version, "before": before["version"] if before else None, "rows": int(seen.get["rows"]), "inputs": inputs,
             "schema": df.schema.json()}
    stored = _scan(spark, path, state).count()                  # from the file footers
    if stored != state["rows"]:
        raise OSError(f"{path}/{version} holds {stored} of {state['rows']} rows")
    _point(spark, path, state)
    fs, folder = _fs(spark, path)
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if name.startswith("v-") and name not in (version, state["before"]):
            fs.delete(st.getPath(), True)
    return state


def _scan(spark: SparkSession, path: str, state: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/{state['version']}").select(*[f"`{c}`" for c in schema.names])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of ``path``."""
    path = path.rstrip("/")
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing was published under {path}")
    return _scan(spark, path, state)


def input_state(spark: SparkSession, pattern: str) -> str:
    """Name, size and time of every file of a glob, in one line; it changes when a file does."""
    fs, p = _fs(spark, pattern)
    return "|".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.globStatus(p) or []))
