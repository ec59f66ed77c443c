"""Small helpers for functions that run under ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Bytes of variable-length values after which an output batch is handed on.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 8192


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


class Rows:
    """Collects rows by column and yields record batches of bounded size."""

    def __init__(self, schema: pa.Schema, batch_bytes: int = BATCH_BYTES, batch_rows: int = BATCH_ROWS):
        self.schema, self.batch_bytes, self.batch_rows = schema, batch_bytes, batch_rows
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, n_bytes: int = 0) -> None:
        self.rows.append(row)
        self.bytes += n_bytes

    @property
    def full(self) -> bool:
        return self.bytes >= self.batch_bytes or len(self.rows) >= self.batch_rows

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return batch

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self.take()


def batched(schema: pa.Schema, rows: Iterable[tuple[tuple, int]]) -> Iterator[pa.RecordBatch]:
    """Record batches from (row, bytes) pairs."""
    out = Rows(schema)
    for row, n_bytes in rows:
        out.add(row, n_bytes)
        if out.full:
            yield out.take()
    yield from out.rest()
