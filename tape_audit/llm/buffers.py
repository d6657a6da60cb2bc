"""Arrow string columns as bytes, without building Python strings; memory that a task gives back when it ends."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def raw_texts(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of each value of a string column, None for nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = memoryview(column.buffers()[2] or b"")
    absent = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield None if absent and absent[i] else bytes(data[offsets[i] : offsets[i + 1]])


def release() -> None:
    """Arrow keeps what was freed for later use; a worker that idles until its next task must not hold it."""
    pa.default_memory_pool().release_unused()


def released(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``task`` over the batches of a partition, after whose end nothing that it has freed is kept."""
    @functools.wraps(task)
    def run(*args: object) -> Iterator:
        try:
            yield from task(*args)
        finally:
            release()
    return run
