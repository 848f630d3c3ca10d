"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

_LEFT: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: after the loss of an executor nothing before this point runs
    again. The table is removed at the end of the process, or by :func:`discard`.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidelog_path = path
    return out


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed at the end of the process."""
    path = f"{shared_dir(spark)}/tidelog-{tag}-{uuid.uuid4().hex}"
    _LEFT.append((spark, path))
    return path


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`materialize` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_tidelog_path", None)
        if path:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path of :func:`scratch`."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _LEFT[:] = [x for x in _LEFT if x[1] != path]


@atexit.register
def _clean_up() -> None:
    for spark, path in list(_LEFT):
        try:
            remove(spark, path)
        except Exception:  # the session is closed already: nothing can be removed through it
            return


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes that a task of a range should read at most, long rows aside.
RANGE_BYTES = 64 << 20


def ranges_of(df: DataFrame, row_bytes: Column) -> int:
    """Number of ranges for ``df``: the session's shuffle partitions, more if these would hold over :data:`RANGE_BYTES` each."""
    size = df.agg(F.sum(row_bytes.cast("long")).alias("size")).first()["size"] or 0
    return max(partitions(df.sparkSession), -(-size // RANGE_BYTES))


def range_buckets(df: DataFrame, keys: list[Column], tag: str, name: str = "bucket", ranges: int | None = None) -> DataFrame:
    """Deal ``df`` into ranges of ``keys`` and write it with the number of its range.

    All rows of range b come before those of range b + 1. Ranges hold similar numbers
    of rows; only rows equal in all keys must share one.
    """
    n = ranges or partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *keys).withColumn(name, F.spark_partition_id())
    return materialize(ranged, tag)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, which gives the memory of its batches and caches back when a task ends.

    Spark uses a Python worker again for later tasks and stages; without this it keeps the
    largest size that it ever had.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


class TwoGenerations(dict):
    """A cache of bounded size: when full, only what was used lately survives.

    ``make`` gives the value of a key; keys over ``longest`` are not kept.
    """

    def __init__(self, make, most: int = 250_000, longest: int = 64):
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class MostUsed:
    """A cache of bounded size for many keys at once: when full, the half that was found most often stays.

    ``make`` gives the value of a key; keys over ``longest`` are not kept. Counts are halved
    when the cache is cut, so that what is used no more goes in time.
    """

    def __init__(self, make, most: int, longest: int = 64):
        self.make, self.most, self.longest, self.values, self.found = make, most, longest, {}, {}

    def of(self, keys: list, counts: list[int]) -> list:
        """The value of each key; ``counts``: how often it occurs this time."""
        values, found, out = self.values, self.found, []
        for key, n in zip(keys, counts):
            value = values.get(key)
            if value is not None:
                found[key] += n
            else:
                value = self.make(key)
                if len(key) <= self.longest:
                    if len(values) >= self.most:
                        self._cut()
                        values, found = self.values, self.found
                    values[key], found[key] = value, n
            out.append(value)
        return out

    def _cut(self) -> None:
        least = sorted(self.found.values())[-(self.most // 2)] if self.most > 1 else 0
        self.found = {k: n // 2 for k, n in self.found.items() if n > least}
        self.values = {k: self.values[k] for k in self.found}

    def clear(self) -> None:
        self.values, self.found = {}, {}
