"""Sums of long vectors over tasks, such as weights or gradients."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, SALTS = 1024, 16
SCHEMA = "chunk int, weight double, values array<double>"


def summed(rows: DataFrame) -> DataFrame:
    """Element-wise sums of ``values`` per ``chunk`` (and of ``weight``), in two levels of streaming additions."""
    def add(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for chunk, weight, values in zip(*(batch.column(c) for c in ("chunk", "weight", "values"))):
                entry = sums.setdefault(chunk.as_py(), [0.0, 0.0])
                entry[0] += weight.as_py()
                entry[1] = entry[1] + values.values.to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([w for w, _ in sums.values()], pa.float64()),
                                          pa.array([v for _, v in sums.values()], pa.list_(pa.float64()))], names=["chunk", "weight", "values"])
    first = rows.repartition("chunk", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).mapInArrow(add, SCHEMA)
    return first.repartition("chunk").mapInArrow(add, SCHEMA)


def chunked(vector: np.ndarray, weight: float) -> pa.RecordBatch:
    parts = [vector[k:k + CHUNK] for k in range(0, len(vector), CHUNK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([weight] * len(parts), pa.float64()),
                                       pa.array(parts, pa.list_(pa.float64()))], names=["chunk", "weight", "values"])


def collected(rows: DataFrame) -> tuple[np.ndarray, float]:
    found = sorted(summed(rows).collect(), key=lambda r: r.chunk)
    return (np.concatenate([r["values"] for r in found]), found[0].weight) if found else (np.zeros(0), 0.0)
