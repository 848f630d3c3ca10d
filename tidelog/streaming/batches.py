"""Batches that outlive a micro-batch: the open batch is keyed state with a timer.

All records of a chunk join the open batch of their slot; a batch that holds ``size``
records or more is closed and handed on. What stays open waits in the state store, under
``size`` records and so bounded, for more chunks or for silence: every chunk, also one
without records, sets the timer anew, and when it runs out the open batch is closed as it
is. Timers run between micro-batches, so silence means that a micro-batch, later by the
idle time, brought no chunk.

A slot is one key, as its batches are a fold over its chunks in order of arrival; it has one
reader as well, whose limit bounds what a micro-batch brings. Several slots run side by side.
Records travel to the state and from it in blocks, a row each (Arrow streams), made and
opened in parallel; so the one task of a slot sorts and numbers columns, not Python rows.
Recorded slots of any size go through :mod:`~tidelog.operators.batching`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.batching import close_batches
from ..schema import BATCH_SIZE, DEFAULT_SLOT

#: Timers and several state variables need this store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


#: Records of a block.
BLOCK = 4096


def _block(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def _opened(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, the first column a slot, to blocks of a slot."""
    for batch in batches:
        slots = batch.column(0).dictionary_encode("encode")
        codes, rest = slots.indices.to_numpy(), batch.select(batch.schema.names[1:])
        for code, slot in enumerate(slots.dictionary.to_pylist()):
            own = rest.take(pa.array(np.flatnonzero(codes == code)))
            blocks = [_block(own.slice(at, BLOCK)) for at in range(0, own.num_rows, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([slot] * len(blocks), pa.string()), pa.array(blocks, pa.binary())], ["_slot", "block"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a slot to rows."""
    for batch in batches:
        for slot, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            table = _opened(block.as_buffer())
            yield from table.add_column(0, "slot", pa.array([slot] * len(table), pa.string())).to_batches()


class OpenBatch(StatefulProcessor):
    """State of a slot: the number of its open batch, and the records in it, as a block."""

    def __init__(self, size: int, idle_ms: int):
        self.size, self.idle_ms = size, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.number = handle.getValueState("batch", "batch long")
        self.open = handle.getValueState("open", "block binary")

    def _state(self) -> tuple[pa.Table | None, int]:
        return _opened(self.open.get()[0]) if self.open.exists() else None, self.number.get()[0] if self.number.exists() else 0

    def _out(self, key, batch: pa.Array, table: pa.Table) -> Iterator[Row]:
        table = table.add_column(0, "batch", batch)
        for at in range(0, len(table), BLOCK):
            yield Row(slot=key[0], block=_block(table.slice(at, BLOCK)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived = pa.concat_tables([_opened(row["block"]) for row in rows])
        if "error" in arrived.column_names:
            bad = arrived.filter(arrived["error"].is_valid())
            yield from self._out(key, pa.nulls(len(bad), pa.int64()), bad)
            arrived = arrived.filter(arrived["error"].is_null())
        arrived = arrived.filter(arrived["idx"].is_valid())
        held, now = self._state()
        if len(arrived):
            arrived = arrived.sort_by([("seq", "ascending"), ("idx", "ascending")])
            seq, n_held = arrived["seq"].to_numpy(), len(held) if held else 0
            counts = np.diff(np.append(np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]])), len(seq)))
            ids, _, last = close_batches(counts, self.size, n_held, now)
            batch = np.concatenate([np.full(n_held, now), np.repeat(ids, counts)])
            both = pa.concat_tables([held, arrived]) if held else arrived
            closed = int(np.searchsorted(batch, last))  # batches rise with arrival
            yield from self._out(key, pa.array(batch[:closed], pa.int64()), both.slice(0, closed))
            held = both.slice(closed)
            if last > now:
                self.number.update((int(last),))
            if len(held):
                self.open.update((_block(held),))
            else:
                self.open.clear()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if held:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, now = self._state()
        if held:
            self.number.update((now + 1,))
            self.open.clear()
            yield from self._out(key, pa.array([now] * len(held), pa.int64()), held)


def stream_batches(rows: DataFrame, size: int = BATCH_SIZE, idle_ms: int = 10, slot_col: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    """``slot, batch`` and the columns of ``rows``, a stream with ``seq, idx`` and others, once their batch is closed.

    Batches are numbered from 0 for each slot (``slot_col``, or one ``slot`` for all). A row
    with a null ``idx`` stands for a chunk without records: it keeps the batch open but isn't
    handed on. A row with an ``error`` goes on at once, in no batch. The query needs
    :data:`STATE_STORE`, and runs a micro-batch at every trigger, as timers may be due.
    """
    columns = T.StructType([f for f in rows.schema.fields if f.name not in (slot_col, "slot", "batch")])
    slots = (F.col(slot_col) if slot_col else F.lit(slot)).cast("string").alias("_slot")
    blocks = rows.select(slots, *columns.names).mapInArrow(_pack, "_slot string, block binary")
    out = T.StructType([T.StructField("slot", T.StringType()), T.StructField("batch", T.LongType()), *columns.fields])
    closed = blocks.groupBy("_slot").transformWithState(OpenBatch(size, idle_ms), "slot string, block binary", "Append", "ProcessingTime")
    return closed.mapInArrow(_unpack, out)
