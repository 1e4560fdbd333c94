"""Sums of fixed-size count tables over all tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PART = 1 << 13


def count_table(df: DataFrame, count, size: int) -> np.ndarray:
    """The sum over all tasks of ``count(batches)``, an int64 array of ``size`` counters.

    Each task emits the parts of its table that are not all zero; parts are added up
    one batch at a time by hash of their number.  ``size`` counters reach the driver.
    """
    schema = "part int, counts binary"
    types = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def rows(parts: dict[int, np.ndarray]):
        return pa.RecordBatch.from_pydict({"part": list(parts), "counts": [v.tobytes() for v in parts.values()]},
                                          schema=types)

    def emit(batches):
        table = np.zeros(-(-size // PART) * PART, np.int64)
        table[:size] = count(batches)
        table = table.reshape(-1, PART)
        yield rows({int(i): table[i] for i in np.flatnonzero(table.any(axis=1))})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.frombuffer(counts, np.int64)
                total[part] = total[part] + counts if part in total else counts
        yield rows(total)

    out = np.zeros(-(-size // PART) * PART, np.int64)
    for r in df.mapInArrow(emit, schema).repartition("part").mapInArrow(add, schema).collect():
        out[r["part"] * PART:(r["part"] + 1) * PART] += np.frombuffer(r["counts"], np.int64)
    return out[:size]
