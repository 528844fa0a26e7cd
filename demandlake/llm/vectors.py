"""Sums of one long vector per task, added up by Spark: in slots, and in two steps, so no task gets them all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 32
SALTS = 32
SLOT_SCHEMA = "slot int, piece binary"


def slot_rows(vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's vector as rows (slot, 64-bit floats)."""
    parts = [x.astype("<f8").tobytes() for x in np.array_split(vector, SLOTS)]
    yield pa.RecordBatch.from_pydict(
        {"slot": pa.array(range(SLOTS), pa.int32()), "piece": pa.array(parts, pa.binary())}
    )


def _added(table: pa.Table) -> pa.Table:
    total = 0.0
    for piece in table.column("piece"):
        total = total + np.frombuffer(piece.as_py(), "<f8")
    return pa.table(
        {"slot": pa.array([table.column("slot")[0].as_py()], pa.int32()), "piece": pa.array([total.tobytes()], pa.binary())}
    )


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' vectors of `size` numbers; SLOTS rows come to the driver."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(SALTS)))
    some = salted.groupBy("slot", "salt").applyInArrow(lambda _, table: _added(table), SLOT_SCHEMA)
    all_slots = some.groupBy("slot").applyInArrow(_added, SLOT_SCHEMA).collect()
    if not all_slots:
        return np.zeros(size)
    return np.concatenate([np.frombuffer(row.piece, "<f8") for row in sorted(all_slots, key=lambda r: r.slot)])
