"""Arrow batches in pieces, for helpers whose Python objects take several times the bytes of their rows.

Spark hands a task up to 64 MiB of rows at once. What a helper makes of them is held for one piece at a time, so that a
worker's memory doesn't follow the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: Bytes of a piece; one with a single row may have more.
PIECE = 1 << 20


def in_pieces(batch: pa.RecordBatch, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces of at most so many bytes, or one row."""
    n = batch.num_rows
    if n < 2 or batch.nbytes <= most:
        yield batch
        return
    yield from in_pieces(batch.slice(0, n // 2), most)
    yield from in_pieces(batch.slice(n // 2), most)


def mapped(f: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """f of the values of each row, as a column; values are Python objects for one piece at a time."""
    batch = pa.RecordBatch.from_arrays(list(columns), names=[str(k) for k in range(len(columns))])
    return pa.concat_arrays([pa.array([f(*row) for row in zip(*(c.to_pylist() for c in piece.columns), strict=True)], kind) for piece in in_pieces(batch)])
