"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null as empty."""
    column = batch.column(name)
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def longs_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A long column without nulls."""
    return batch.column(name).to_numpy(zero_copy_only=False)


class Lists:
    """A column of lists (of longs, or of structs of longs); null as empty."""

    def __init__(self, column: pa.Array):
        column = column.fill_null([]) if column.null_count and pa.types.is_integer(column.type.value_type) else column
        self._offsets = column.offsets.to_numpy()
        self._null = np.asarray(column.is_null())
        self._values = column.values

    def of(self, row: int, field: str | None = None) -> np.ndarray:
        if self._null[row]:
            return np.zeros(0, dtype=np.int64)
        values = self._values.slice(self._offsets[row], self._offsets[row + 1] - self._offsets[row])
        values = values.field(field) if field else values
        return values.to_numpy(zero_copy_only=False)


def signed(hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return hashes.view(np.int64)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def spans(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Per row, its stretches as a list of (start, end)."""
    offsets = np.cumsum([0, *(len(a) for a, _ in found)], dtype=np.int32)
    join = [np.concatenate([x[i] for x in found]).astype(np.int64) if found else np.zeros(0, np.int64) for i in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in join], ["start", "end"]))
