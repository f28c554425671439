"""Sums of arrays of fixed length over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brookmill.llm.windows import pack, unpack

_CHUNK = 1 << 12


def tally(rows: DataFrame, fill: Callable[[pa.RecordBatch, np.ndarray], None], cells: int, kind: type = np.int64) -> tuple[np.ndarray, int]:
    """Sum of the tables of type ``kind`` that ``fill`` adds each batch to, and the number of rows; for booleans, their union.

    Every task sums its batches, then the tables are summed by chunk in a second
    stage, one batch at a time; the driver gets ``cells`` numbers in all.
    """
    if cells % _CHUNK:
        raise ValueError(f"cells is a multiple of {_CHUNK}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros(cells, kind), 0
        for batch in batches:
            fill(batch, table)
            seen += batch.num_rows
        if seen:
            used = [i for i in range(cells // _CHUNK) if table[i * _CHUNK : (i + 1) * _CHUNK].any()]
            chunks = [pack(table[i * _CHUNK : (i + 1) * _CHUNK].tobytes()) for i in used]
            yield pa.RecordBatch.from_arrays([pa.array([*used, -1], pa.int32()), pa.array([*chunks, pack(np.int64(seen).tobytes())], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(unpack(counts.as_py()), np.int64 if part < 0 else kind)
                sums[part] = sums[part] + more if part in sums else more
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["part", "counts"])

    table, seen = np.zeros(cells, kind), 0
    for row in rows.mapInArrow(count, "part int, counts binary").repartition("part").mapInArrow(add, "part int, counts binary").collect():
        if row["part"] < 0:
            seen = int(np.frombuffer(row["counts"], np.int64)[0])
        else:
            table[row["part"] * _CHUNK : (row["part"] + 1) * _CHUNK] = np.frombuffer(row["counts"], kind)
    return table, seen
