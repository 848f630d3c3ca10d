"""Terms of whole Arrow batches of texts, cut out of their bytes at once.

A term is a longest run of the bytes that an alphabet keeps; all bytes of characters
beyond ASCII belong to terms, so cutting bytes cuts no character. Only A-Z are
lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut at a time; a longer text is a part by itself.
PART_BYTES = 6 << 20


def alphabet(*, digits: bool) -> np.ndarray:
    """For each byte what a term has of it: 0 (the byte ends terms), or the byte with A-Z lower-cased."""
    table = np.zeros(256, "u1")
    table[128:] = np.arange(128, 256)
    small = np.arange(ord("a"), ord("z") + 1)
    table[small] = table[small - 32] = small
    if digits:
        numbers = np.arange(ord("0"), ord("9") + 1)
        table[numbers] = numbers
    return table


def parts(texts: pa.Array, most: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Rows ``from, to`` of a column of texts in parts of ``most`` bytes (more for a single text)."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype("i8")
    start, end = 0, np.cumsum(size)
    while start < len(size):
        before = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, before + most, "right")))
        yield start, stop
        start = stop


def cut(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Row of each term, in order, and the terms themselves; null texts have none."""
    column = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    first = int(offsets[0]) if len(offsets) else 0
    data = np.frombuffer(column.buffers()[2] or b"", "u1")[first : int(offsets[-1]) if len(offsets) else 0]
    offsets = offsets - first
    low = table[data]
    inside = low != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]  # a text's first byte begins a term even right after another text's last
    begins[heads] = inside[heads]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | begins[1:]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    ends = np.concatenate([[0], np.cumsum(stop - start)]).astype("<i8")
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])])
    return np.searchsorted(offsets[1:], start, "right"), found
