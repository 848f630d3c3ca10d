"""Token-id files with directly addressable codes: any id is read without block decoding.

The ids of a shard are split into chunks of fixed bit widths, lowest first. Level k
holds the k-th chunk of the ids that reach it, packed without gaps, and a bitmap that
says which of them continue on level k + 1. A rank directory holds the number of
continuing ids before every 512th one, so the place of an id on the next level is one
directory entry and a count of at most 512 bits.

A shard is one binary value: header, document offsets, then the levels. Shards are
written as rows of a Parquet table, in ascending order of document id, so the files can
live in any store that Spark reads.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ranges_of, tidy
from .encoders import encoder

MAGIC = b"DAC1"
WIDTHS = (8, 4, 4, 16)
BLOCK = 512
SHARDS = "bucket int, shard int, first_id long, n_docs long, n_ids long, doc_ids array<long>, payload binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    if width == 4:
        two = np.zeros(len(values) + len(values) % 2, "u1")
        two[: len(values)] = values
        return (two[::2] | two[1::2] << np.uint8(4)).tobytes()
    bits = (values[:, None] >> np.arange(width, dtype="u4")) & 1
    return np.packbits(bits.astype("u1").ravel(), bitorder="little").tobytes()


def encode_shard(ids: np.ndarray, offsets: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The shard of ``ids`` (unsigned, under 2 ** sum(widths)); ``offsets``: where documents start, and the end."""
    rest = ids.astype("u4")
    if len(rest) and int(rest.max()) >> sum(widths):
        raise ValueError("an id is wider than the levels")
    parts = [MAGIC, struct.pack("<QQB", len(rest), len(offsets) - 1, len(widths)), bytes(widths), offsets.astype("<u8").tobytes()]
    for k, width in enumerate(widths):
        more = (rest >> np.uint32(width)) > 0 if width < 32 else np.zeros(len(rest), bool)
        chunks = _pack_bits(rest & np.uint32((1 << width) - 1), width)
        last = k == len(widths) - 1
        bitmap = b"" if last else np.packbits(more, bitorder="little").tobytes()
        ranks = b"" if last else np.concatenate([[0], np.cumsum(more)])[: len(rest) + 1 : BLOCK].astype("<u8").tobytes()
        parts += [struct.pack("<QQQQ", len(rest), len(chunks), len(bitmap), len(ranks)), chunks, bitmap, ranks]
        rest = rest[more] >> np.uint32(width)
    return b"".join(parts)


class Shard:
    """Reader of one shard, on views of its bytes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard of directly addressable codes")
        self.data = memoryview(data)
        self.n_ids, self.n_docs, n_levels = struct.unpack_from("<QQB", data, 4)
        at = 21
        self.widths = tuple(data[at : at + n_levels])
        at += n_levels
        self.offsets = np.frombuffer(data, "<u8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in self.widths:
            n, chunks, bitmap, ranks = struct.unpack_from("<QQQQ", data, at)
            at += 32
            raw, bits = self.data[at : at + chunks], self.data[at + chunks : at + chunks + bitmap]
            self.levels.append((n, raw, bits, np.frombuffer(data, "<u8", ranks // 8, at + chunks + bitmap)))
            at += chunks + bitmap + ranks

    def _values(self, k: int, lo: int, hi: int) -> np.ndarray:
        """Chunks lo..hi of level k."""
        width, raw = self.widths[k], self.levels[k][1]
        if width in (8, 16, 32):
            step = width // 8
            return np.frombuffer(raw, f"<u{step}", hi - lo, lo * step).astype("u4")
        first, last = lo * width // 8, -(-hi * width // 8)
        packed = np.frombuffer(raw, "u1", last - first, first)
        if width == 4:
            two = np.empty(2 * len(packed), "u4")
            two[::2], two[1::2] = packed & 15, packed >> 4
            return two[lo % 2 : lo % 2 + hi - lo]
        bits = np.unpackbits(packed, bitorder="little")
        skip = lo * width - 8 * first
        bits = bits[skip : skip + (hi - lo) * width].reshape(hi - lo, width).astype("u4")
        return (bits << np.arange(width, dtype="u4")).sum(axis=1, dtype="u4")

    def _rank(self, k: int, i: int) -> int:
        """Continuing ids before number i of level k: a directory entry and a count in its block."""
        _, _, bitmap, ranks = self.levels[k]
        block, rest = divmod(i, BLOCK)
        first = block * BLOCK // 8
        bits = int.from_bytes(bitmap[first : first + (rest + 7) // 8], "little") & ((1 << rest) - 1)
        return int(ranks[block]) + bits.bit_count()

    def access(self, i: int) -> int:
        """Id number i: at most one step on each level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift = 0, 0
        for k, width in enumerate(self.widths):
            value |= int(self._values(k, i, i + 1)[0]) << shift
            if k == len(self.widths) - 1 or not self.levels[k][2][i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(k, i), shift + width
        return value

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi, touching only their own chunks."""
        if hi <= lo:
            return np.empty(0, "u4")
        out = self._values(0, lo, hi)
        where, shift = None, 0
        for k, width in enumerate(self.widths[:-1]):
            bytes_of = np.frombuffer(self.levels[k][2], "u1", -(-hi // 8) - lo // 8, lo // 8)
            more = np.flatnonzero(np.unpackbits(bytes_of, bitorder="little")[lo % 8 : lo % 8 + hi - lo])
            if not len(more):
                break
            where, shift = more if where is None else where[more], shift + width
            lo = self._rank(k, lo)
            hi = lo + len(more)
            out[where] |= self._values(k + 1, lo, hi) << np.uint32(shift)
        return out

    def document(self, d: int) -> np.ndarray:
        """Ids of document number d of the shard."""
        return self.slice(int(self.offsets[d]), int(self.offsets[d + 1]))


def write_ids(docs: DataFrame, vocabulary: str, path: str, *, end_id: int, shard_ids: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", widths: tuple[int, ...] = WIDTHS, special_tokens: bool = False) -> None:
    """Encode every text, append ``end_id``, and write shards at ``path`` in ascending id order.

    ``special_tokens``: strings of special tokens in texts are those tokens, not text.

    Texts are dealt into ranges of ids before they are encoded, so ids never move. Null
    and empty texts give the end id alone; null ids come first; repeated ids are ordered
    by a hash of their texts. A shard ends at the first document at which it has ``shard_ids`` ids, so
    memory is bounded by that and the longest text. The number of ranges follows from the
    bytes of all texts. An empty table writes no shard.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(ranges_of(rows, F.octet_length("text")), "doc_id", "tie").withColumn("bucket", F.spark_partition_id()).sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary, special_tokens), array("I", [end_id]).tobytes()
        names, parts, sizes, total, shard, bucket, written = [], [], [0], 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            blob = encode_shard(ids, np.array(sizes, "u8"), widths)
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([shard], pa.int32()), pa.array([written], pa.int64()), pa.array([len(names)], pa.int64()), pa.array([total], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([blob], pa.binary())],
                ["bucket", "shard", "first_id", "n_docs", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            for doc, ids, b in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1)), batch.column(2).to_pylist()):
                ids += end
                bucket, total = b, total + len(ids) // 4
                names.append(doc)
                parts.append(ids)
                sizes.append(total)
                if total >= shard_ids:
                    yield flush()
                    names, parts, sizes, total, shard, written = [], [], [0], 0, shard + 1, written + total
        if names:
            yield flush()

    ranged.select("doc_id", "text", "bucket").mapInArrow(tidy(run), SHARDS).write.parquet(path)


#: A table of ranges of at most this many rows (16 bytes each) goes to all tasks; a longer one is joined by shuffle.
BROADCAST_RANGES = 500_000


def range_starts(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, base``: ids before each range. One row a range is summed up in one task, never one per document."""
    by_range = spark.read.schema(SHARDS).parquet(path).groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return by_range.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back (:data:`DOCUMENTS`), each document by its own place through the rank directories."""
    shards = spark.read.schema(SHARDS).parquet(path).select("bucket", "first_id", "doc_ids", "payload")
    starts = range_starts(spark, path)
    if starts.count() <= BROADCAST_RANGES:
        starts = F.broadcast(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, first, names, payload in zip(*batch.columns):
                shard, n = Shard(payload.as_py()), len(names)
                crc = [zlib.crc32(shard.document(d).tobytes()) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket.as_py()] * n, pa.int32()), names.values, pa.array(shard.offsets[:-1].astype("i8") + first.as_py()), pa.array(np.diff(shard.offsets.astype("i8"))), pa.array(crc, pa.int64())],
                    ["bucket", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = shards.mapInArrow(run, f"bucket int, {DOCUMENTS}").join(starts, "bucket")
    return found.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
