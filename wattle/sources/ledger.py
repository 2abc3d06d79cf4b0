"""Typed rows and a table of what was not taken, from one scan of the raw files.

Readers called with ``trace=True`` keep every line: ``source_file``, the text of the key
field, the whole line where its number of fields is wrong, and whether it had too many.
``split`` writes them once, by ``rejected``; typed rows and rejects are then two folders
of the same table. A line with too few fields is taken (what is missing is NULL); one
with too many, or without a readable key, is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import versions

TRACE = ("source_file", "key_text", "malformed_line", "surplus_fields")


def split(readings: DataFrame, key: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows without the trace columns, rejects as source_file, reason, line)."""
    reason = (F.when(F.coalesce("surplus_fields", F.lit(False)), F.lit("too many fields"))
              .when(F.col(key).isNull(), F.lit(f"no {key}")))
    lines = readings.withColumn("reason", reason).withColumn("rejected", F.col("reason").isNotNull())
    versions.publish(lines, path, ["rejected"])
    stored = versions.read(readings.sparkSession, path)
    typed = stored.filter(~F.col("rejected")).drop(*TRACE, "reason", "rejected")
    return typed, stored.filter("rejected").select("source_file", "reason", F.coalesce("malformed_line", "key_text").alias("line"))
