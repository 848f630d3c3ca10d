"""Token counts of whole texts: pieces counted once per distinct pre-token, then joined.

1. Distinct pre-tokens of the corpus, with the number of their uses in it (summed up
   before the shuffle), and for each the number of its pieces: one table.
2. Per-document pre-token frequencies join that table. The most used pre-tokens, at most
   ``head`` of them and of at most 65 bytes each (longer ones by digest), make a table of
   bounded size that goes to all tasks; they are also all keys that many documents share,
   so what is left to join by shuffle has no hot key.
3. Sums per row of the input. No ids are made.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .pieces import pieces

HEAD_BYTES = 64


def _key(name: str) -> str:
    """The pre-token, or of a long one its digest (65 bytes, so it equals no pre-token that stands for itself)."""
    if 4 * len(name) <= HEAD_BYTES or len(name.encode()) <= HEAD_BYTES:
        return name
    return "#" + hashlib.sha256(name.encode()).hexdigest()


def distinct_pre_tokens(texts: DataFrame, vocabulary: str) -> DataFrame:
    """``(pre_token, uses, n_pieces)`` over a one-column table of texts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = pieces(vocabulary), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pre_token", "uses"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                seen.update(model.split(text.as_py() or ""))
                if len(seen) >= 300_000:
                    yield flush()
        yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(vocabulary)
        for batch in batches:
            n = model.counts(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["pre_token", "uses", "n_pieces"])

    uses = texts.mapInArrow(split, "pre_token string, uses long").groupBy("pre_token").agg(F.sum("uses").alias("uses"))
    return uses.mapInArrow(count, "pre_token string, uses long, n_pieces long")


def most_used(table: DataFrame, most: int) -> dict[str, int]:
    """Pieces of the most used pre-tokens, ``most`` at most.

    The least number of uses is found from a histogram (8 steps to a power of two), so
    no more than ``most`` rows come to the driver.
    """
    step = F.floor(F.log2("uses") * 8).alias("step")
    long = F.octet_length("pre_token") > HEAD_BYTES
    total, least = 0, None
    for row in table.groupBy(step).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return {}
    key = F.when(long, F.concat(F.lit("#"), F.sha2(F.col("pre_token").cast("binary"), 256))).otherwise(F.col("pre_token"))
    return {r[0]: r[1] for r in table.where(step >= least).select(key, "n_pieces").collect()}


def count_tokens(docs: DataFrame, vocabulary: str, *, limit: int = 4096, head: int = 262_144, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    Counts equal those of the library for the whole text, without begin or end tokens.
    Null and empty texts count 0. Null ids and repeated rows are kept as they are. Other
    columns aren't read. ``head`` bounds the pre-tokens that are sent to all tasks (65
    bytes each at most); a pre-token of any length or rarity is counted all the same.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = materialize(distinct_pre_tokens(rows.select("text"), vocabulary), "pretokens")
    known = spark.sparkContext.broadcast(most_used(table, head))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per input row with what the most used pre-tokens give, and one per other pre-token of it."""
        model, pieces_of, part, row = pieces(vocabulary), known.value, TaskContext.get().partitionId(), 0
        names = ["row_id", "is_base", "pre_token", "doc_id", "n_bytes", "n"]
        for batch in batches:
            out: list[list] = [[] for _ in names]

            def add(*values):
                for column, value in zip(out, values):
                    column.append(value)

            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text, uid, base = value.as_py() or "", part << 40 | row, 0
                row += 1
                for name, n in Counter(model.split(text)).items():
                    if (found := pieces_of.get(_key(name))) is not None:
                        base += n * found
                    else:
                        add(uid, False, name, None, None, n)
                add(uid, True, str(uid), doc, len(text.encode()), base)
                if len(out[0]) >= 50_000:
                    yield _batch(out, names)
                    for column in out:
                        column.clear()
            yield _batch(out, names)

    parts = rows.mapInArrow(frequencies, "row_id long, is_base boolean, pre_token string, doc_id long, n_bytes long, n long")
    counted = table.select(F.lit(False).alias("is_base"), "pre_token", "n_pieces")
    joined = parts.join(counted, ["is_base", "pre_token"], "left")
    total = joined.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.when(F.col("is_base"), F.col("n")).otherwise(F.col("n") * F.col("n_pieces"))).alias("n_tokens"),
    )
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _batch(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names)
