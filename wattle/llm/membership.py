"""A bit table of fixed size that tells which 64-bit ids may be in a set.

It only spares shuffles: rows that it lets through still meet an exact join. It
is ``2 ** BITS`` bits whatever the input; with far more ids it lets all through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import thrifty
from .nptext import U64, mix

BITS, SLICES = 24, 16


def _places(ids: np.ndarray) -> np.ndarray:
    h = mix(ids.astype(np.int64).view(U64) ^ U64(0xD6E8FEB86659FD93))
    return np.stack([h >> U64(64 - BITS), (h << U64(BITS)) >> U64(64 - BITS)]).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITS, bool)
    for batch in batches:
        bits[_places(batch.column(0).to_numpy()).ravel()] = True
    for i, part in enumerate(np.packbits(bits).reshape(SLICES, -1)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                             ["slice", "bits"])


def _join_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, b in zip(batch.column("slice").to_pylist(), batch.column("bits").to_pylist()):
            total[i] = total.get(i, 0) | np.frombuffer(b, np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([b.tobytes() for b in total.values()], pa.binary())], ["slice", "bits"])


def may_contain(ids: DataFrame) -> np.ndarray:
    """The packed bit table of the one long column of ``ids``."""
    rows = (ids.mapInArrow(thrifty(_mark), "slice int, bits binary").repartition(SLICES, "slice")
            .mapInArrow(thrifty(_join_slices), "slice int, bits binary").collect())
    out = np.zeros((SLICES, (1 << BITS) // 8 // SLICES), np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def passes(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = _places(ids)
    return ((table[at >> 3] >> (7 - (at & 7))) & 1).all(0)


def only_known(df: DataFrame, column: str, table: np.ndarray) -> DataFrame:
    """Rows of ``df`` whose id may be in the table."""
    sent = df.sparkSession.sparkContext.broadcast(table)        # 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(sent.value, batch.column(column).to_numpy())))
    return df.mapInArrow(thrifty(run), df.schema)
