"""Packing of documents into training sequences: first-fit decreasing, group by group.

Each document's ids (with an end id) are cut at multiples of the sequence length. A
whole-length piece fills a sequence by itself; what is left of a document is an item of
first-fit decreasing. Documents are dealt at random into groups of bounded expected size,
and the items of each group are packed by themselves, with a tournament tree over the free space of its
open sequences: the winner of a subtree is its largest free space, so the leftmost
sequence that fits an item is found in logarithmic time.

Only spans travel (document, start, length, checksum), never ids: 40 bytes a piece.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .encoders import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group_key long"
#: Pre-tokens that a task keeps while it runs. Workers that wait keep none: in a pipeline they stand beside those of other stages.
CACHED = 80_000
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class TournamentTree:
    """Free space of the sequences of one group, in the order in which they were opened."""

    def __init__(self, leaves: int, capacity: int):
        self.size = 1
        while self.size < max(1, leaves):
            self.size *= 2
        self.best = [capacity] * (2 * self.size)

    def first_fit(self, length: int) -> tuple[int, int]:
        """Take ``length`` from the first sequence with room: (its number, its free space before)."""
        best, node = self.best, 1
        while node < self.size:
            node *= 2
            if best[node] < length:
                node += 1
        free = best[node]
        best[node] = free - length
        leaf = node - self.size
        node //= 2
        while node:
            left, right = best[2 * node], best[2 * node + 1]
            best[node] = left if left >= right else right
            node //= 2
        return leaf, free


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item; equal lengths keep their order."""
    order = np.argsort(-lengths, kind="stable")
    tree = TournamentTree(len(lengths), capacity)
    sequence, offset = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    for i in order.tolist():
        leaf, free = tree.first_fit(int(lengths[i]))
        sequence[i], offset[i] = leaf, capacity - free
    return sequence, offset


def cut_pieces(docs: DataFrame, vocabulary: str, *, end_id: int, capacity: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", special_tokens: bool = False) -> DataFrame:
    """Pieces of every document (:data:`PIECES`), at most ``capacity`` ids each.

    ``group_key`` is pseudo-random for each document: a hash of seed, id and ids of its
    text, so it doesn't depend on how the input is dealt. Rows that repeat both within a
    task are numbered, so that they don't meet in one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(vocabulary, special_tokens, CACHED), Counter()
        end = array("I", [end_id]).tobytes()
        step = 4 * capacity
        try:
            for batch in batches:
                out: list[list] = [[], [], [], [], [], []]
                for doc, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1))):
                    ids += end
                    n = len(ids) // 4
                    same = xxhash.xxh3_64_intdigest(ids, seed=xxhash.xxh3_64_intdigest(b"%d" % doc if doc is not None else b"", seed=seed))
                    key = xxhash.xxh3_64_intdigest(b"%d" % seen[same], seed=same) >> 1
                    seen[same] += 1
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        for column, value in zip(out, (doc, at // 4, len(piece) // 4, zlib.crc32(piece), n, key)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "group_key"])
        finally:
            enc.forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), PIECES)


def pack(pieces: DataFrame, n_groups: int, *, capacity: int) -> DataFrame:
    """Place each piece (:data:`PLACED`): its sequence, and where it starts there.

    Sequence ids are unique over all groups. Groups are independent tasks; a group holds
    about the number of pieces divided by ``n_groups``.
    """

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "group_key")])
        lengths = table.column("length").to_numpy()
        sequence, offset = first_fit_decreasing(lengths, capacity)
        keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.table([*[table.column(c) for c in keep], pa.array((key[0].as_py() << 32) + sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    grouped = pieces.withColumn("pack_group", F.pmod(F.col("group_key"), F.lit(n_groups)))
    return grouped.groupBy("pack_group").applyInArrow(place, PLACED)


def pack_documents(docs: DataFrame, vocabulary: str, *, end_id: int = 1, capacity: int = 2048, group_size: int = 4096, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", special_tokens: bool = False) -> DataFrame:
    """Pack whole documents; one row per piece (:data:`PLACED`).

    Null and empty texts are documents of the end id alone. A null id stays null.
    ``special_tokens``: strings of special tokens in texts are those tokens, not text.
    Repeated rows are packed once per row. An empty table gives no rows. Other columns of
    ``docs`` are not read. ``group_size`` is the expected number of documents in a group,
    the unit that one task holds (about 60 bytes a piece); longer documents make more
    pieces, but only their last is shorter than a sequence.
    """
    n_groups = max(1, -(-docs.count() // group_size))
    pieces = cut_pieces(docs, vocabulary, end_id=end_id, capacity=capacity, seed=seed, id_col=id_col, text_col=text_col, special_tokens=special_tokens)
    return pack(pieces, n_groups, capacity=capacity)


def sequence_lengths(placed: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """Per sequence: ids used, and its stored length (itself at a power of two, else ``capacity``)."""
    used = placed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.bit_count("used") == 1
    return used.withColumn("stored", F.when(power, F.col("used")).otherwise(F.lit(capacity).cast("long")))
