"""Helpers the operators share: staged tables, Arrow text access, runs of sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from coinfold.session import shared_dir

#: Texts are worked on in pieces of about this many bytes, to bound a task's memory.
PIECE_BYTES = 1_000_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows reads files that survive lost executors, and reads
    them unchanged however often it is repeated.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one buffer, and where each row begins (one more at the end).

    Nulls are empty.
    """
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def pieces_of(starts: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = int(np.searchsorted(starts, starts[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def each_run(key: str, work: Callable[[pa.Table], pa.Table | None], most_rows: int = 100_000):
    """A function for mapInArrow that hands ``work`` all rows of one key at a time.

    The rows of a partition must be sorted by ``key``. Only one key's rows are held,
    so their number must be bounded by whoever dealt them out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ready: list[pa.Table] = []
        current = None

        def finish():
            nonlocal held
            if held:
                made = work(pa.Table.from_batches(held))
                if made is not None and made.num_rows:
                    ready.append(made)
            held = []

        def flushed(force: bool):
            nonlocal ready
            if ready and (force or sum(t.num_rows for t in ready) >= most_rows):
                yield from pa.concat_tables(ready).combine_chunks().to_batches(most_rows)
                ready = []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if keys[low] != current:
                    finish()
                    current = keys[low]
                held.append(batch.slice(low, high - low))
            yield from flushed(False)
        finish()
        yield from flushed(True)

    return run


def list_matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are all equally long, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
