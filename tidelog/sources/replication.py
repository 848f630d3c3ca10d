"""A source of recorded slots, ``tidelog_chunks``: a folder of segment files.

A segment is a run of chunks with a 4-byte big-endian length before each. Its name is its
index: the number of its first chunk, how many it has, and the least and largest position
of their records (``<first>-<count>-<least>-<largest>.chunks``, the last two ``-`` without
a record). So what lies where is known from a listing, and a segment that can't hold what
is asked for is never opened. Segments are only ever added, so offsets replay exactly. Each
part of a range is read on an executor; the folder must be one that all of them share.

Batch reads push filters on ``seq`` and, with the option ``positions``, on ``last_position``
(the largest position in a chunk) down to the names. Streams start at ``startSeq``, or at
``startingPosition``: after the last chunk that holds this position, or where none does,
at the first chunk that goes beyond it. Either way no chunk is left out that came later.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructField, StructType

from ..operators.parse import find_frames
from ..schema import CHUNK, U64

SUFFIX = ".chunks"
#: Filters reach the reader with this setting of the session.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def record_positions(chunk: bytes) -> list[int]:
    """Positions of the records in a chunk."""
    frames, _, _ = find_frames(np.frombuffer(chunk, "u1"), np.array([0]), np.array([len(chunk)]))
    return [int.from_bytes(chunk[at + 1 : at + 9], "big") for at in frames[:, 1].tolist()]


def write_segment(folder: str, first_seq: int, chunks: list[bytes]) -> str:
    """Record chunks as one segment, complete at once under its name."""
    os.makedirs(folder, exist_ok=True)
    found = [p for chunk in chunks for p in record_positions(chunk)]
    least, largest = (f"{min(found):016x}", f"{max(found):016x}") if found else ("", "")
    path = os.path.join(folder, f"{first_seq:020d}-{len(chunks):010d}-{least}-{largest}{SUFFIX}")
    with open(f"{path}.part", "wb") as f:
        for chunk in chunks:
            f.write(struct.pack(">I", len(chunk)) + chunk)
    os.replace(f"{path}.part", path)
    return path


def read_segment(path: str) -> Iterator[bytes]:
    with open(path, "rb") as f:
        while head := f.read(4):
            size = struct.unpack(">I", head)[0]
            body = f.read(size)
            if len(body) < size:
                raise ValueError(f"{path} ends inside a chunk")
            yield body


@dataclass(frozen=True)
class Segment:
    """What the name of a segment says; ``least`` and ``largest`` are None without a record."""

    path: str
    first: int
    count: int
    least: int | None
    largest: int | None

    @classmethod
    def of(cls, folder: str, name: str) -> Segment:
        first, count, least, largest = name.removesuffix(SUFFIX).split("-")
        number = lambda x: int(x, 16) if x else None
        return cls(os.path.join(folder, name), int(first), int(count), number(least), number(largest))

    @property
    def end(self) -> int:
        return self.first + self.count


@dataclass
class SegmentRange(InputPartition):
    path: str
    first_seq: int
    start: int
    end: int


class _Segments:
    def __init__(self, options):
        self.folder = options["path"]
        self.start_seq = int(options.get("startseq", 0))
        self.limit = int(options.get("maxchunksperread", 0))
        self.position = options.get("startingposition")

    def segments(self) -> list[Segment]:
        names = sorted(x for x in os.listdir(self.folder) if x.endswith(SUFFIX)) if os.path.isdir(self.folder) else []
        return [Segment.of(self.folder, x) for x in names]

    def first(self) -> int:
        """Where a stream starts."""
        if self.position is None:
            return self.start_seq
        high, low = self.position.split("/")
        return max(self.start_seq, self._after(int(high, 16) << 32 | int(low, 16)))

    def _after(self, position: int) -> int:
        known = [s for s in self.segments() if s.largest is not None]
        for s in reversed([s for s in known if s.least <= position <= s.largest]):
            holds = [seq for seq, chunk in enumerate(read_segment(s.path), s.first) if position in record_positions(chunk)]
            if holds:
                return holds[-1] + 1
        for s in known:
            if s.largest > position:
                return next(seq for seq, chunk in enumerate(read_segment(s.path), s.first) if max(record_positions(chunk), default=-1) > position)
        return self.end()

    def end(self) -> int:
        found = self.segments()
        return max(self.start_seq, found[-1].end) if found else self.start_seq

    def ranges(self, start: int, end: int, beyond: int = -1) -> list[SegmentRange]:
        """Parts of the segments that meet ``start .. end``, but those without a position ``beyond``."""
        kept = [s for s in self.segments() if s.first < end and s.end > start and (beyond < 0 or (s.largest is not None and s.largest >= beyond))]
        return [SegmentRange(s.path, s.first, max(start, s.first), min(end, s.end)) for s in kept]

    @staticmethod
    def rows(part: SegmentRange) -> Iterator[tuple[int, bytes]]:
        for seq, chunk in enumerate(read_segment(part.path), part.first_seq):
            if seq >= part.end:
                break
            if seq >= part.start:
                yield seq, chunk


class ChunkStreamReader(DataSourceStreamReader):
    """Offsets are ``{"seq": next}``. ``maxChunksPerRead`` bounds what one micro-batch admits."""

    def __init__(self, options):
        self.log = _Segments(options)
        self.admitted: int | None = None

    def initialOffset(self) -> dict:
        return {"seq": self.log.first()}

    def latestOffset(self) -> dict:
        if self.admitted is None:  # a stream that is started again plans first what it planned last
            self.admitted = self.log.first()
        end = max(self.log.end(), self.admitted)
        return {"seq": min(end, self.admitted + self.log.limit) if self.log.limit else end}

    def partitions(self, start: dict, end: dict) -> list[SegmentRange]:
        self.admitted = max(self.admitted or 0, end["seq"])
        return self.log.ranges(start["seq"], end["seq"])

    def commit(self, end: dict) -> None:
        self.admitted = max(self.admitted or 0, end["seq"])

    def read(self, partition: SegmentRange) -> Iterator[tuple[int, bytes]]:
        return _Segments.rows(partition)


class ChunkReader(DataSourceReader):
    def __init__(self, options, with_positions: bool):
        self.log, self.with_positions = _Segments(options), with_positions
        self.start, self.end, self.beyond = self.log.start_seq, None, -1

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrow what is read; Spark applies all filters again to the rows that are."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo)):
                value, more = f.value, int(isinstance(f, (GreaterThan, LessThanOrEqual)))
                if f.attribute == ("seq",):
                    if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                        self.start = max(self.start, value + more)
                    if isinstance(f, (LessThan, LessThanOrEqual)):
                        self.end = min(x for x in (self.end, value + more) if x is not None)
                    if isinstance(f, EqualTo):
                        self.end = min(x for x in (self.end, value + 1) if x is not None)
                elif f.attribute == ("last_position",) and not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.beyond = max(self.beyond, int(value) + more)
            yield f

    def partitions(self) -> list[SegmentRange]:
        end = self.log.end() if self.end is None else min(self.end, self.log.end())
        return self.log.ranges(self.start, end, self.beyond) or [SegmentRange("", 0, 0, 0)]

    def read(self, partition: SegmentRange) -> Iterator[tuple]:
        for seq, chunk in _Segments.rows(partition) if partition.path else ():
            if self.with_positions:
                found = record_positions(chunk)
                yield seq, chunk, Decimal(max(found)) if found else None
            else:
                yield seq, chunk


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog_chunks"

    def _with_positions(self) -> bool:
        return self.options.get("positions", "false").lower() == "true"

    def schema(self) -> StructType:
        return StructType([*CHUNK.fields, StructField("last_position", U64)]) if self._with_positions() else CHUNK

    def reader(self, schema: StructType) -> ChunkReader:
        return ChunkReader(self.options, self._with_positions())

    def streamReader(self, schema: StructType) -> ChunkStreamReader:
        return ChunkStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChunkSource)
    spark.conf.set(PUSHDOWN, "true")
