"""Lineage cuts in the shared folder of a session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A session that names none (a test on one machine) gets a temporary folder; on more
    than one machine that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidelog-"))
    return spark.sparkContext.getCheckpointDir()


_LEFT: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed by :func:`remove`, at the latest at the end of the process."""
    path = f"{shared_dir(spark)}/tidelog-{tag}-{uuid.uuid4().hex}"
    _LEFT.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path of :func:`scratch`."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _LEFT[:] = [x for x in _LEFT if x[1] != path]


@atexit.register
def _clean_up() -> None:
    for spark, path in list(_LEFT):
        try:
            remove(spark, path)
        except Exception:  # the session is closed already: nothing can be removed through it
            return


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint in :func:`shared_dir`, partition by partition; :func:`discard` removes it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    out = df.checkpoint()
    path = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    _LEFT.append((spark, path))
    out._tidelog_left = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the checkpoint that ``df`` was made from, once nothing reads it any more."""
    if path := getattr(df, "_tidelog_left", None):
        remove(df.sparkSession, path)


#: Bytes that a range should hold at most, by Spark's estimate.
RANGE_BYTES = 128 << 20


def ranges_of(df: DataFrame) -> int:
    """Number of ranges for ``df``: the session's shuffle partitions, or more where Spark estimates more than :data:`RANGE_BYTES` for each."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < 1 << 60 else 0  # without statistics the estimate is the largest number there is
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // RANGE_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: their Python workers import it, and may not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tidelog_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tidelog-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch the file while the session lasts
    archive = Path(folder) / "tidelog.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tidelog_shipped = True
