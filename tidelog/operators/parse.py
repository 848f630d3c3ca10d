"""Chunks of bytes to change records.

A chunk holds frames one after another: code, position, transaction id and commit time
(big-endian, 25 bytes), then schema and table names ended by a zero byte. A record frame
is consumed up to the end of its names only; the four bytes after them are read as the
object id if at least one more follows. Codes ``W`` emit nothing, ``B`` skips five bytes,
any other code or a tail under four bytes ends the chunk. An error voids the whole chunk:
one row with ``error`` instead of its records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binary import code_of, i64_be, latin1, lossy_utf8, operation, terminator, u32_be, u64_be
from ..schema import HEADER_BYTES, LEAST_BYTES, NO_TERMINATOR, OPERATIONS, PARSED, RECORD_CODES, ROW_DATA, SHORT_FRAME, SKIP_BYTES, SKIP_CODE

_IS_RECORD = np.zeros(256, bool)
_IS_RECORD[[ord(c) for c in RECORD_CODES]] = True
_EMITS = np.zeros(256, bool)
_EMITS[[ord(c) for c in OPERATIONS]] = True
_SKIP = ord(SKIP_CODE)
_NAMES = np.full(256, None, object)
for _code, _name in OPERATIONS.items():
    _NAMES[ord(_code)] = _name
_ERRORS = (None, SHORT_FRAME, NO_TERMINATOR)
#: Chunks that still have frames are parsed side by side, so many at least; fewer are walked one by one.
SIDE_BY_SIDE = 24


def _walk(data: memoryview, at: int, end: int) -> tuple[list[tuple[int, int, int]], int, int]:
    """Frames of one chunk from ``at`` on, as (start, end of schema, end of table), and the number of its error."""
    out, data = [], bytes(data[at:end])
    base, at, end = at, 0, len(data)
    while end - at >= LEAST_BYTES:
        code = data[at]
        if code == _SKIP:
            at += SKIP_BYTES
            continue
        if not _IS_RECORD[code]:
            break
        if at + HEADER_BYTES > end:
            return out, 1, end
        first = data.find(0, at + HEADER_BYTES)
        second = data.find(0, first + 1) if first >= 0 else -1
        if second < 0:
            return out, 2, end
        out.append((base + at, base + first, base + second))
        at = second + 1
    return out, 0, end


def record_frames(chunk: bytes) -> tuple[list[tuple], str | None]:
    """Records of one chunk, as the fields from position to transaction id without tuples, or its error."""
    frames, error, end = _walk(memoryview(chunk), 0, len(chunk))
    if error:
        return [], _ERRORS[error]
    number = lambda at, size, signed=False: int.from_bytes(chunk[at : at + size], "big", signed=signed)
    text = lambda start, stop: chunk[start:stop].decode("utf-8", "replace")
    return [
        (
            Decimal(number(at + 1, 8)), text(at + HEADER_BYTES, first), text(first + 1, second), OPERATIONS[chr(chunk[at])],
            number(second + 1, 4) if end - second > 5 else 0, number(at + 17, 8, True), Decimal(number(at + 9, 8)),
        )
        for at, first, second in frames if _EMITS[chunk[at]]
    ], None


def find_frames(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Record frames of chunks that lie at ``starts .. ends`` of the bytes ``data``.

    Returns frames as rows (chunk, start, end of schema, end of table) in order of the
    bytes, the place of each in its chunk among the frames that emit, and the number of
    each chunk's error (0: none). A chunk in error has no frames. All chunks advance by a
    frame at a time.
    """
    zeros = np.append(np.flatnonzero(data == 0), len(data))
    error, at, found = np.zeros(len(starts), "i1"), starts.astype("i8"), []
    active = np.flatnonzero(ends - at >= LEAST_BYTES)
    while len(active) >= SIDE_BY_SIDE:
        code = data[at[active]]
        skipped, rec = active[code == _SKIP], active[_IS_RECORD[code]]
        at[skipped] += SKIP_BYTES
        end = ends[rec]
        short = at[rec] + HEADER_BYTES > end
        one = np.searchsorted(zeros, at[rec] + HEADER_BYTES)
        first, second = zeros[np.minimum(one, len(zeros) - 1)], zeros[np.minimum(one + 1, len(zeros) - 1)]
        lost = ~short & (second >= end)
        error[rec[short]], error[rec[lost]] = 1, 2
        good = ~short & ~lost
        rec, first, second = rec[good], first[good], second[good]
        found.append(np.stack([rec, at[rec], first, second], axis=1))
        at[rec] = second + 1
        active = np.concatenate([skipped, rec])
        active = active[ends[active] - at[active] >= LEAST_BYTES]
    view = memoryview(data)
    for chunk in active.tolist():
        frames, error[chunk], _ = _walk(view, int(at[chunk]), int(ends[chunk]))
        if frames:
            found.append(np.array([(chunk, *f) for f in frames], "i8"))
    rows = np.concatenate(found) if found else np.empty((0, 4), "i8")
    rows = rows[_EMITS[data[rows[:, 1]]] & (error[rows[:, 0]] == 0)]
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    owner = rows[:, 0]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return rows, place, error


def _numbers(data: np.ndarray, at: np.ndarray, width: int, kind: str) -> np.ndarray:
    """Big-endian numbers of ``width`` bytes."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(width)]).view(f">{kind}{width}").ravel().astype(f"<{kind}{width}")


def _exact(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit numbers as decimals, by their bytes."""
    wide = np.zeros((len(values), 2), "<u8")
    wide[:, 0] = values
    return pa.Array.from_buffers(pa.decimal128(20, 0), len(values), [None, pa.py_buffer(wide)])


def _texts(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Bytes as text; each malformed part becomes U+FFFD."""
    size = stop - start
    ends = np.cumsum(size)
    raw = data[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.concatenate([[0], ends]).astype("<i4")
    out = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    if raw.max(initial=0) < 128:
        return out
    return pa.array([x.decode("utf-8", "replace") for x in out.view(pa.binary()).to_pylist()], pa.string())


def parse_chunks(chunks: DataFrame, *, keep: Sequence[str] = (), outcomes: bool = False, voided: bool = False) -> DataFrame:
    """Parse ``seq, chunk``, any number of frames each, into :data:`~tidelog.schema.PARSED`.

    A null chunk is one without bytes. ``keep``: columns of ``chunks`` that each row takes
    along. ``outcomes``: a chunk with neither records nor an error has a row as well, with
    nothing but its ``seq`` (and what is kept), so that every chunk can be counted from the
    result alone. ``voided``: rows with an error have the bytes of their chunk as ``chunk``.
    Works on streams as well; no shuffle.
    """
    rows = chunks.select("seq", "chunk", *keep)
    bytes_too = [T.StructField("chunk", T.BinaryType())] if voided else []
    schema = T.StructType(PARSED.fields + bytes_too + rows.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = pc.fill_null(batch.column(1), b"").cast(pa.large_binary())
            offsets = np.frombuffer(chunk.buffers()[1], "<i8")[chunk.offset : chunk.offset + len(chunk) + 1]
            data = np.frombuffer(chunk.buffers()[2] or b"", "u1")[: offsets[-1] if len(offsets) else 0]
            frames, place, error = find_frames(data, offsets[:-1], offsets[1:])
            owner, at, first, second = frames.T
            n, end = len(owner), offsets[1:][owner]
            oid = np.zeros(n, "i8")
            has_oid = end - second > 5
            oid[has_oid] = _numbers(data, second[has_oid] + 1, 4, "u")
            tuples = pa.nulls(n, _ROW_DATA)
            yield from _rows(batch, owner, [
                pa.array(place, pa.int32()), _exact(_numbers(data, at + 1, 8, "u")), _texts(data, at + HEADER_BYTES, first), _texts(data, first + 1, second),
                pa.array(_NAMES[data[at]], pa.string()), pa.array(oid), tuples, tuples, pa.array(_numbers(data, at + 17, 8, "i")), _exact(_numbers(data, at + 9, 8, "u")), pa.nulls(n, pa.string()),
                *[pa.nulls(n, pa.binary()) for _ in bytes_too],
            ])
            alone = error != 0
            if outcomes:
                alone = alone | (np.bincount(owner, minlength=len(chunk)) == 0)
            owner = np.flatnonzero(alone)
            said = [_ERRORS[e] for e in error[owner].tolist()]
            nulls = [pa.nulls(len(owner), f.type) for f in list(_KINDS)[1:-1]]
            raw = [pa.array([None if e is None else chunk[i].as_py() for i, e in zip(owner.tolist(), said)], pa.binary()) for _ in bytes_too]
            yield from _rows(batch, owner, [pa.array([None if e is None else 0 for e in said], pa.int32()), *nulls, pa.array(said, pa.string()), *raw])

    def _rows(batch: pa.RecordBatch, owner: np.ndarray, columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        if len(owner):
            row = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), *columns, *[c.take(row) for c in batch.columns[2:]]], schema.names)

    return rows.mapInArrow(run, schema)


_ROW_DATA = pa.struct([("columns", pa.list_(pa.struct([("name", pa.string()), ("type_oid", pa.int64()), ("value", pa.binary()), ("is_null", pa.bool_())])))])
#: Columns of a parsed row after its chunk's number.
_KINDS = pa.schema([
    ("idx", pa.int32()), ("lsn", pa.decimal128(20, 0)), ("table_schema", pa.string()), ("table_name", pa.string()), ("operation", pa.string()), ("oid", pa.int64()),
    ("new_tuple", _ROW_DATA), ("old_tuple", _ROW_DATA), ("tx_commit_time", pa.int64()), ("tx_xid", pa.decimal128(20, 0)), ("error", pa.string()),
])


def _layout(chunks: DataFrame) -> DataFrame:
    """Columns on the first frame: code, ends of the names, what follows.

    They come out of a generator of one row, past which no filter or projection is moved,
    so the search for the names runs once a chunk however often its results are used.
    """
    chunk, text = F.col("chunk"), latin1(F.col("chunk"))
    end1 = terminator(text, HEADER_BYTES + 1)
    end2 = F.when(end1 > 0, terminator(text, end1 + 1)).otherwise(0)
    row = F.struct(chunk.alias("chunk"), F.octet_length(chunk).alias("size"), code_of(chunk).alias("code"), end1.alias("end1"), end2.alias("end2"))
    return chunks.select("seq", F.inline(F.array(row)))


def _first(layout: DataFrame) -> DataFrame:
    chunk, size, code, end1, end2 = (F.col(c) for c in ("chunk", "size", "code", "end1", "end2"))
    part = lambda start, stop: F.substring(chunk, start, stop - start)
    is_record = (size >= LEAST_BYTES) & code.isin(*RECORD_CODES)
    error = F.when(is_record & (size < HEADER_BYTES), SHORT_FRAME).when(is_record & ((end1 == 0) | (end2 == 0)), NO_TERMINATOR)
    kept = layout.withColumn("error", error).withColumn("operation", F.when(is_record & error.isNull(), operation(code)))
    kept = kept.where(F.col("error").isNotNull() | F.col("operation").isNotNull())
    good = lambda value: F.when(F.col("error").isNull(), value)
    oid = F.when(size - end2 > 4, u32_be(chunk, end2 + 1)).otherwise(F.lit(0).cast("long"))
    nothing = F.lit(None).cast(ROW_DATA)
    return kept.select(
        "seq",
        F.lit(0).alias("idx"),
        good(u64_be(chunk, 2)).alias("lsn"),
        good(lossy_utf8(part(F.lit(HEADER_BYTES + 1), end1))).alias("table_schema"),
        good(lossy_utf8(part(end1 + 1, end2))).alias("table_name"),
        "operation",
        good(oid).alias("oid"),
        nothing.alias("new_tuple"),
        nothing.alias("old_tuple"),
        good(i64_be(chunk, 18)).alias("tx_commit_time"),
        good(u64_be(chunk, 10)).alias("tx_xid"),
        "error",
    )


def first_frame(chunks: DataFrame) -> DataFrame:
    """The first frame of each chunk, by built-in expressions alone (:data:`~tidelog.schema.PARSED`)."""
    return _first(_layout(chunks))


def records(parsed: DataFrame) -> DataFrame:
    """Records alone."""
    return parsed.where(F.col("operation").isNotNull())


def errors(parsed: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """Voided chunks and why; with ``chunks``, their bytes as well."""
    out = parsed.where(F.col("error").isNotNull()).select("seq", "error")
    return out if chunks is None else out.join(chunks.select("seq", "chunk"), "seq")
