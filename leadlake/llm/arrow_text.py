"""Texts of Arrow batches as bytes, and blocks of rows packed into one value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED = pa.ipc.IpcWriteOptions(compression="zstd")


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of a string column as one array, and where each text begins (plus the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=PACKED) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(packed) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(packed)).read_all()


def blocks_of(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.Table]:
    """Tables of about `size` bytes of text, or of one row that is longer."""
    held, total = [], 0
    for batch in batches:
        lengths = np.diff(text_bytes(batch.column(batch.schema.get_field_index(text)))[1]).tolist()
        begin = 0
        for end, length in enumerate(lengths):
            if total and total + length > size:
                held.append(batch.slice(begin, end - begin))
                yield pa.Table.from_batches(held)
                held, total, begin = [], 0, end
            total += length
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)
