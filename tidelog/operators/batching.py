"""Batches by arrival order.

All records of a chunk join the open batch, which is then closed if it holds ``size``
records or more. What a run of chunks does to the open batch depends only on the number
of records in it, under ``size``. So rows are dealt into ranges once, each range is summed
up as a table (open records before: open records after, batches closed), the tables are
chained on the driver, one a range, and each range is then numbered by itself, as a stream
of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BATCH_SIZE
from ..session import checkpointed, ranges_of


def close_batches(counts: np.ndarray, size: int, open_now: int = 0, batch: int = 0) -> tuple[np.ndarray, int, int]:
    """Batch of each chunk, open records at the end, and number of the open batch."""
    if len(counts) and counts.max(initial=0) <= 1:
        before = open_now + np.cumsum(counts) - counts
        total = open_now + int(counts.sum())
        return batch + before // size, total % size, batch + total // size
    out = np.empty(len(counts), "i8")
    for i, n in enumerate(counts.tolist()):
        out[i] = batch
        open_now += n
        if n and open_now >= size:
            open_now, batch = 0, batch + 1
    return out, open_now, batch


def _advance(now: np.ndarray, closed: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The table of a range after more chunks: for each number of open records before, those after, and batches closed."""
    if len(counts) and counts.max(initial=0) <= 1:
        total = now + int(counts.sum())
        return total % size, closed + total // size
    for n in counts[counts > 0].tolist():
        now = now + n
        full = now >= size
        closed, now = closed + full, np.where(full, 0, now)
    return now, closed


class _Runs:
    """Chunks of a range, as runs of equal numbers in batches of its rows; the last one stays open."""

    def __init__(self) -> None:
        self.seq: int | None = None
        self.count = 0

    def add(self, seq: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Records of the chunks that are complete now, and the run of each row (0: the run that was open before)."""
        if not len(seq):
            return np.empty(0, "i8"), np.empty(0, "i8")
        new = np.concatenate([[self.seq is None or seq[0] != self.seq], seq[1:] != seq[:-1]])
        first = self.seq is None
        run = np.cumsum(new) - (1 if first else 0)
        counts = np.bincount(run, weights=n, minlength=run[-1] + 1).astype("i8")
        counts[0] += 0 if first else self.count
        self.seq, self.count = seq[-1], int(counts[-1])
        return counts[:-1], run


def _numbered(rows: DataFrame, weight: Column, size: int) -> DataFrame:
    """``rows`` (``seq`` and others) with ``batch_id``, where ``weight`` is the number of records a row stands for."""
    order = [c for c in ("seq", "idx") if c in rows.columns]
    weighted = rows.withColumn("_weight", weight.cast("long"))
    ranged = weighted.repartitionByRange(ranges_of(weighted), "seq").sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = checkpointed(ranged)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, closed, runs, part = np.arange(size), np.zeros(size, "i8"), _Runs(), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
                counts, _ = runs.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
                now, closed = _advance(now, closed, counts, size)
        if part is not None:
            now, closed = _advance(now, closed, np.array([runs.count]), size)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([now], pa.list_(pa.int64())), pa.array([closed], pa.list_(pa.int64()))], ["part", "after", "closed"])

    tables = ranged.select("seq", "_weight", "_part").mapInArrow(summary, "part int, after array<long>, closed array<long>").collect()
    starts, open_now, batch_now = {}, 0, 0
    for r in sorted(tables, key=lambda r: r["part"]):
        starts[r["part"]] = (open_now, batch_now)
        open_now, batch_now = r["after"][open_now], batch_now + r["closed"][open_now]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, state = _Runs(), None
        for batch in batches:
            if batch.num_rows:
                state = state or starts[batch.column(2)[0].as_py()]
                counts, run = runs.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
                ids, *state = close_batches(counts, size, *state)
                ids = np.append(ids, state[1])  # of the chunk that is open still
                yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(ids[run])], schema.names)

    kept = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    out = ranged.select("seq", "_weight", "_part", *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(kept)]).mapInArrow(number, schema)
    out._tidelog_left = ranged._tidelog_left
    return out


def assign_batches(counts: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """``seq, n, batch_id`` for ``counts(seq, n)``: records of each chunk, empty ones included.

    An empty table gives no rows. A range is read as a stream, so memory doesn't follow it.
    """
    return _numbered(counts.select("seq", F.col("n").cast("long").alias("n")), F.col("n"), size)


#: Bits of a chunk's number within a block, and of a block's within a group of blocks.
BLOCK_BITS, GROUP_BITS = 16, 12


def _one_each(records: DataFrame, size: int) -> DataFrame:
    """Batches where no chunk has two records: a batch is a running number divided by its size.

    Running numbers are made in blocks of chunk numbers, so none holds more than a fixed
    number of rows: places in a block, and sums over blocks in two steps. Rows travel once.
    """
    block = F.shiftright("seq", BLOCK_BITS)
    running = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counts = records.select(block.alias("_block")).groupBy("_block").agg(F.count("*").alias("_n")).withColumn("_group", F.shiftright("_block", GROUP_BITS))
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_in_group"))
    groups = groups.select("_group", F.coalesce(F.sum("_in_group").over(running([], "_group")), F.lit(0)).alias("_before_group"))
    before = F.col("_before_group") + F.coalesce(F.sum("_n").over(running(["_group"], "_block")), F.lit(0))
    starts = counts.join(groups, "_group").select("_block", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*[c for c in ("seq", "idx") if c in records.columns]))
    numbered = records.withColumn("_block", block).join(starts, "_block").withColumn("batch_id", F.col("_before") + place - 1)
    return numbered.select(*records.columns, F.expr(f"batch_id div {int(size)}").alias("batch_id"))


def with_batches(records: DataFrame, size: int = BATCH_SIZE, *, one_each: bool = False) -> DataFrame:
    """Records with their ``batch_id`` (``session.discard`` removes what they are read from); rows that are none (a parse with outcomes) count nothing and go along.

    Chunks without records close no batch, so they needn't be there. ``one_each``: no chunk
    has more than one record (as from ``first_frame``), and all rows are records; then
    built-in expressions alone do it.
    """
    if one_each:
        return _one_each(records, size)
    return _numbered(records, F.when(F.col("operation").isNotNull(), 1).otherwise(0), size)


def batch_summary(batched: DataFrame) -> DataFrame:
    """Records of each batch, and the position of its last one by arrival."""
    return batched.groupBy("batch_id").agg(F.count("*").alias("n"), F.max_by("lsn", F.struct("seq", "idx")).alias("last_lsn"))
