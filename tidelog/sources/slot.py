"""A streaming source of a live replication slot, ``tidelog_slot``.

A slot hands out committed transactions in the order of their commits, each as a Begin
row, its changes and a Commit row; positions of single changes are not in that order. So
offsets count commits: an offset names the last transaction that was begun, how many of
its changes were taken, the position up to which all transactions were taken whole, and
the number of the next chunk. Chunks are numbered as they arrive; a micro-batch is what
lies between two offsets, so it replays exactly, numbers included.

``maxChunksPerRead`` admits whole transactions up to that many changes; one that is longer
is cut, and goes on in the next micro-batch. The server decodes a long transaction again for
each part, but only its changes of the part travel. The slot is peeked, and moved on only
when Spark has committed a micro-batch, and then to the end of its last whole transaction.

Options: ``driver`` (a module with the usual ``connect``, by default ``psycopg``), ``dsn``
(its connection string), ``slot`` (made where it is missing), ``publication``,
``startingPosition`` (where to start without Spark's offsets: later commits only),
``endingPosition`` (no later commits than that).

A slot has one consumer: each micro-batch is one partition, read on an executor.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Sequence
from contextlib import closing, contextmanager
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..schema import CHUNK, DEFAULT_POSITION, DEFAULT_SLOT

#: First bytes of the rows that open and close a transaction.
BEGIN, COMMIT = ord("B"), ord("C")
#: Rows that are fetched from the server at a time.
FETCHED = 1000

_EXISTS = "SELECT EXISTS(SELECT 1 FROM pg_replication_slots WHERE slot_name = %s)"
_CREATE = "SELECT pg_create_logical_replication_slot(%s, 'pgoutput')"
_ADVANCE = "SELECT pg_replication_slot_advance(slot_name, %s::pg_lsn) FROM pg_replication_slots WHERE slot_name = %s AND confirmed_flush_lsn < %s::pg_lsn"
_NOW = "SELECT pg_current_wal_lsn()::text"
_PEEK = "pg_logical_slot_peek_binary_changes(%s, %s::pg_lsn, %s, 'proto_version', '1', 'publication_names', %s) WITH ORDINALITY AS c(lsn, xid, data, n)"
_MARKS = f"SELECT n, lsn::text, get_byte(data, 0) FROM {_PEEK} WHERE get_byte(data, 0) IN ({BEGIN}, {COMMIT}) ORDER BY n"
_CHANGES = f"SELECT n, data FROM {_PEEK} WHERE n > %s AND n <= %s AND get_byte(data, 0) NOT IN ({BEGIN}, {COMMIT}) ORDER BY n"


def position(text: str) -> int:
    """Number of a position as the server writes it: two hexadecimal halves."""
    high, low = text.split("/")
    return int(high, 16) << 32 | int(low, 16)


def position_text(number: int) -> str:
    return f"{number >> 32:X}/{number & 0xFFFFFFFF:X}"


class Transaction(NamedTuple):
    """A committed transaction in a peek: where it ends, the number of its Begin row, and its changes."""

    commit: int
    begin: int
    changes: int


class SlotOffset(NamedTuple):
    """``taken`` changes of the transaction that ends at ``commit``, all of those up to ``done``, ``seq`` chunks in all."""

    commit: int = 0
    taken: int = 0
    done: int = 0
    seq: int = 0

    @classmethod
    def of(cls, offset: dict) -> SlotOffset:
        return cls(position(offset["commit"]), offset["taken"], position(offset["done"]), offset["seq"])

    def plain(self) -> dict:
        return {"commit": position_text(self.commit), "taken": self.taken, "done": position_text(self.done), "seq": self.seq}


def transactions(marks: Sequence[tuple[int, str, int]]) -> list[Transaction]:
    """Transactions from the Begin and Commit rows of a peek (number, position, first byte)."""
    out, begin = [], None
    for n, lsn, code in marks:
        if code == BEGIN:
            begin = n
        elif begin is not None:
            out.append(Transaction(position(lsn), begin, n - begin - 1))
            begin = None
    return out


def admit(there: Sequence[Transaction], start: SlotOffset, limit: int | None) -> SlotOffset:
    """How far a micro-batch goes from ``start``: whole transactions within the limit, or a part of one that exceeds it."""
    at = start
    for t in there:
        if t.commit <= at.done:
            continue
        taken = at.taken if t.commit == at.commit else 0
        left = t.changes - taken
        room = left if limit is None else limit - (at.seq - start.seq)
        if left <= room:
            at = SlotOffset(t.commit, t.changes, t.commit, at.seq + left)
        else:
            # One that fits into a micro-batch of its own is left for that.
            return SlotOffset(t.commit, taken + limit, at.done, at.seq + limit) if at == start else at
    return at


@dataclass
class SlotRange(InputPartition):
    start: dict
    end: dict


class SlotStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.dsn, self.driver = options["dsn"], options.get("driver", "psycopg")
        self.slot, self.publication = options.get("slot", DEFAULT_SLOT), options.get("publication", "")
        self.limit = int(options.get("maxchunksperread", 10_000))
        self.first = position(options.get("startingposition", DEFAULT_POSITION))
        self.until = position(options["endingposition"]) if "endingposition" in options else None
        self.admitted = SlotOffset(self.first, 0, self.first, 0)
        self.there, self.asked_from = False, None

    @contextmanager
    def _rows(self, sql: str, *values):
        with closing(importlib.import_module(self.driver).connect(self.dsn)) as connection:
            cursor = connection.cursor()
            cursor.execute(sql, values)
            yield iter(lambda: cursor.fetchmany(FETCHED), [])
            connection.commit()

    def _run(self, sql: str, *values) -> list[tuple]:
        with self._rows(sql, *values) as pages:
            return [row for page in pages for row in page]

    def _make(self) -> None:
        """Make the slot if there is none of its name."""
        if not self.there and not self._run(_EXISTS, self.slot)[0][0]:
            self._run(_CREATE, self.slot)
        self.there = True

    def _peek(self, upto: str | None, rows: int | None) -> list[Transaction]:
        return transactions(self._run(_MARKS, self.slot, upto, rows, self.publication))

    def initialOffset(self) -> dict:
        self._make()
        return SlotOffset(self.first, 0, self.first, 0).plain()

    def latestOffset(self) -> dict:
        self._make()
        rows, self.asked_from = 2 * self.limit + 4, self.admitted
        while True:
            # What Spark has taken but not committed yet is peeked again, so the window may have to grow past it.
            window = self._peek(None, rows)
            end = admit([t for t in window if self.until is None or t.commit <= self.until], self.admitted, self.limit)
            if end != self.admitted or sum(t.changes + 2 for t in window) < rows:
                return end.plain()
            rows *= 2

    def partitions(self, start: dict, end: dict) -> list[SlotRange]:
        """A stream that is started again plans what it planned last first, so its next offset is counted from there."""
        if self.asked_from not in (None, SlotOffset.of(start)):
            raise ValueError(f"the stream stands at {start}, but the offset was counted from {self.asked_from.plain()}")
        self.asked_from = None
        self._move(end)
        return [SlotRange(start, end)]

    def commit(self, end: dict) -> None:
        self._move(end)
        if SlotOffset.of(end).done:
            self._run(_ADVANCE, end["done"], self.slot, end["done"])

    def _move(self, end: dict) -> None:
        self.admitted = max(self.admitted, SlotOffset.of(end))

    def read(self, partition: SlotRange) -> Iterator[tuple[int, bytes]]:
        start, end = SlotOffset.of(partition.start), SlotOffset.of(partition.end)
        if start[:2] == end[:2]:
            return
        there = self._peek(partition.end["commit"], None)
        before = next((t.begin + start.taken for t in there if t.commit == start.commit and start.commit > start.done), None)
        if before is None:  # the part of the slot that was taken whole
            before = max((t.begin + t.changes + 1 for t in there if t.commit <= start.done), default=0)
        last = next((t.begin + end.taken for t in there if t.commit == end.commit), None)
        if last is None:
            raise ValueError(f"the slot {self.slot} has no transaction that ends at {partition.end['commit']} any more")
        with self._rows(_CHANGES, self.slot, partition.end["commit"], None, self.publication, before, last) as pages:
            seq = start.seq
            for page in pages:
                for _, data in page:
                    yield seq, bytes(data)
                    seq += 1


class SlotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog_slot"

    def schema(self) -> StructType:
        return CHUNK

    def streamReader(self, schema: StructType) -> SlotStreamReader:
        return SlotStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SlotSource)


def current_position(driver: str, dsn: str) -> str:
    """Where the server's log ends now."""
    with closing(importlib.import_module(driver).connect(dsn)) as connection:
        cursor = connection.cursor()
        cursor.execute(_NOW, ())
        return cursor.fetchmany(1)[0][0]
