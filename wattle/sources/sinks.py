"""Sinks: parquet (default), CSV with NULL as empty, report CSV with decimal comma."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  sort_by: Sequence[str] | None = None) -> None:
    """Overwrite a parquet table; ``sort_by`` orders rows within files only at the sink."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """CSV with NULL written as empty field."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).option("nullValue", "") \
        .option("emptyValue", "").csv(path)


def decimal_comma_text(df: DataFrame) -> DataFrame:
    """Doubles rendered with a decimal comma (report exports for ';' locales)."""
    return df.select([F.translate(F.col(f.name).cast("string"), ".", ",").alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                      for f in df.schema.fields])


def write_report_csv(df: DataFrame, path: str) -> None:
    write_csv(decimal_comma_text(df), path, sep=";")
