"""Helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import gc
import itertools
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute, fs

#: Unicode white space, as the tokenizers' patterns see it.
WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_EDGE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


def chunks(text: str) -> list[str]:
    """White space together with what follows it.

    No match of a byte-level pattern spans the place between a visible character and the white space
    behind it, so chunks can be encoded apart.
    """
    return _CHUNK.findall(text)


def stretches(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut only where chunks meet."""
    at = 0
    while len(text) - at > size:
        edge = _EDGE.search(text, at + size)
        if edge is None:
            break
        yield text[at : edge.start()]
        at = edge.start()
    yield text[at:] if at else text


#: Operators that ran in this worker, with what empties their memory.
_USED: dict[str, Callable[[], None]] = {}


def enter(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called where a task of an operator begins: gives back what other operators left in this worker.

    Workers outlive their tasks.  ``clear`` empties what the operator keeps from one task to the next.
    """
    others = [name for name in _USED if name != owner]
    for name in others:
        _USED.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        # Freed pages stay with the process otherwise.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    _USED[owner] = clear


def forget(known: dict, most: int) -> None:
    """Drop the older half of a memory that has more than ``most`` entries."""
    if len(known) > most:
        newer = list(itertools.islice(known.items(), len(known) // 2, None))
        known.clear()
        known.update(newer)


def small_batches(
    batches: Iterable[pa.RecordBatch], column: str, size: int = 1 << 21, rows: int = 1024
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes in a string or binary column."""
    for batch in batches:
        lengths = compute.binary_length(batch.column(column)).to_pylist()
        first, held = 0, 0
        for i, n in enumerate(lengths):
            held += n or 0
            if held >= size or i + 1 - first >= rows:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < len(lengths):
            yield batch.slice(first)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column one after another, and where each value starts and the last one ends; a null has none."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"") if column.null_count else column
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    if not starts[-1] - starts[0]:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(column.buffers()[2], np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def put_file(path: str, parts: Iterable[bytes]) -> int:
    """Write a file under a temporary name and move it to its own; returns its bytes."""
    store, place = filesystem(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    temporary = f"{place}.{uuid.uuid4().hex}.tmp"
    size = 0
    with store.open_output_stream(temporary, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    store.move(temporary, place)
    return size


def get_file(path: str) -> bytes:
    store, place = filesystem(path)
    with store.open_input_stream(place, compression=None) as source:
        return source.read()
