"""Connected components of a table of links, by alternating star contraction.

Each round links every node's larger neighbours to its least neighbour, then its smaller
ones, until nothing changes: a number of rounds logarithmic in the number of nodes. Least
neighbours are summed up before the shuffle and joined back, so a node of very many links
is an ordinary skewed join, not a task. Each round is a table in the shared folder.

A table of few links (a counted bound) is closed in one task instead, as a round of
shuffles would cost more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    h = F.shiftright(F.xxhash64("a", "b"), 20)
    row = edges.agg(F.count("*"), F.coalesce(F.sum(h), F.lit(0))).first()
    return row[0], row[1]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node that are larger (or else smaller) than it to its least neighbour."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
    return out.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


#: Links that one task closes at most: 16 bytes each, and under 200 in its table of parents.
ONE_TASK_LINKS = 200_000


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame, tag: str, one_task: int = ONE_TASK_LINKS) -> DataFrame:
    """``(node, component)`` of every node with a link; the component is its least node.

    ``edges``: longs ``a, b``. Repeated and self links and links with a null change
    nothing. Without links the result is empty.
    """
    clean = edges.where((F.col("a") != F.col("b")) & F.col("a").isNotNull() & F.col("b").isNotNull())
    now = materialize(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    state = _state(now)
    if state[0] <= one_task:
        return now.select("a", "b").coalesce(1).mapInArrow(_close, "node long, component long")
    while state[0]:
        middle = materialize(_star(now, True), tag)
        after = materialize(_star(middle, False), tag)
        new = _state(after)
        discard(now, middle)
        now = after
        if new == state:
            break
        state = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
