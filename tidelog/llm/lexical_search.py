"""Ranked lexical search: a blocked sparse matrix product with whole-number impacts.

The queries are a sparse matrix of items and terms, the documents one of terms and
documents with an impact for each term of a document. Documents lie in blocks, each a
Parquet row: for each term the documents that hold it, and how often. A product of both is
made block by block: for each item the block's rows of its terms are merged into a vector
of scores (row by row, after Gustavson), of which the best stay. A task keeps its best over
all its blocks, so it sends ``top`` rows an item at most, and these are reduced again.

Impacts need counts over the whole corpus, so blocks hold raw counts, and texts are cut
once for each part of the queries. Queries are taken in parts of bounded bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, tidy
from .terms import alphabet, cut, parts

WORDS = alphabet(digits=True)
#: Bytes of items whose terms are sent to all tasks at a time.
QUERY_BYTES = 8 << 20
#: Documents of a block, at most.
BLOCK_DOCS = 8192
#: First ranking of what the tasks send, before the last one.
SLICES = 32
_POSTINGS = "doc_ids array<long>, lengths array<long>, terms array<int>, ends array<int>, docs array<int>, times array<long>"


def impact_weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """50, and 50 more for a document of average length; exact for any length."""
    if len(lengths) and int(lengths.max()) * 50 * n_docs >= 1 << 63:
        return np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], "i8")
    return 50 + 50 * lengths * n_docs // max(1, n_terms)


def impacts(weight: np.ndarray | int, times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * (10**9 * times // (1000 * times + 20 * norm))


def _postings(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """Blocks of documents: of the terms that are asked for (by number), where and how often they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in parts(batch.column(1)):
                for start in range(first, last, BLOCK_DOCS):
                    part = batch.slice(start, min(last - start, BLOCK_DOCS))
                    row, found = cut(part.column(1), WORDS)
                    lengths = np.bincount(row, minlength=len(part))
                    asked = pc.index_in(found, terms)
                    known = np.asarray(pc.is_valid(asked))
                    ids = np.asarray(asked.filter(pa.array(known))).astype("i8")
                    key, times = np.unique(ids * len(part) + row[known], return_counts=True)
                    term, doc = np.divmod(key, max(1, len(part)))
                    there, df = np.unique(term, return_counts=True)
                    listed = lambda x, kind: pa.array([x], pa.list_(kind))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part.column(0)], pa.list_(pa.int64())), listed(lengths, pa.int64()), listed(there, pa.int32()),
                        listed(np.cumsum(df), pa.int32()), listed(doc, pa.int32()), listed(times, pa.int64()),
                    ], ["doc_ids", "lengths", "terms", "ends", "docs", "times"])

    return docs.mapInArrow(tidy(run), _POSTINGS)


class _Best:
    """The best documents of each item so far, by score and then id."""

    def __init__(self, items: int, top: int):
        self.top, self.score, self.doc = top, [np.empty(0, "i8")] * items, [np.empty(0, "i8")] * items

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        if len(self.score[item]) >= self.top:
            able = score >= self.score[item][-1]
            score, doc = score[able], doc[able]
        if len(score) > self.top:
            able = score >= np.partition(score, len(score) - self.top)[len(score) - self.top]
            score, doc = score[able], doc[able]
        score, doc = np.concatenate([self.score[item], score]), np.concatenate([self.doc[item], doc])
        order = np.lexsort((doc, -score))[: self.top]
        self.score[item], self.doc[item] = score[order], doc[order]


#: Stands for a null id while documents are ordered: nulls go first.
NO_ID = -(1 << 63)


def _products(postings: DataFrame, item_ids: list, starts: np.ndarray, item_terms: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item_id, doc_id, score``: of each task the best of its blocks."""
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(item_ids), top)
        for batch in batches:
            for r in range(len(batch)):
                doc_ids = np.asarray(pc.fill_null(batch.column(0)[r].values, NO_ID))
                lengths, terms, ends, docs, times = (np.asarray(batch.column(c)[r].values) for c in range(1, 6))
                if not len(terms):
                    continue
                owner = np.repeat(terms, np.diff(ends, prepend=0))
                impact = impacts(weights[owner], times, norms(lengths, n_docs, n_terms)[docs])
                place = np.full(len(weights), -1)
                place[terms] = np.arange(len(terms))
                begin = np.concatenate([[0], ends])
                for item in range(len(item_ids)):
                    rows = place[item_terms[starts[item] : starts[item + 1]]]
                    rows = rows[rows >= 0]
                    if len(rows):
                        score = np.zeros(len(doc_ids), "i8")
                        for at in rows.tolist():  # a term's documents are distinct
                            span = slice(begin[at], begin[at + 1])
                            score[docs[span]] += impact[span]
                        hit = np.flatnonzero(score)
                        best.add(item, score[hit], doc_ids[hit])
        size = [len(x) for x in best.score]
        if sum(size):
            doc = np.concatenate(best.doc)
            ids = pa.array(doc, pa.int64(), mask=doc == NO_ID)
            items = pa.array(item_ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(size)), size)))
            yield pa.RecordBatch.from_arrays([items, ids, pa.array(np.concatenate(best.score))], schema=schema)

    return postings.mapInArrow(tidy(run), "item_id long, doc_id long, score long")


def _item_parts(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with the number of their part, and the number of parts."""
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("size")).first()["size"] or 0
    n = -(-size // QUERY_BYTES) or 1
    return items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(n))), n


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each item; in two steps, so that no task sorts what all tasks sent for an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    best = lambda keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    some = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    some = some.withColumn("rank", best(["item_id", "slice"])).where(F.col("rank") <= top)
    return some.withColumn("rank", best(["item_id"])).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item the ``top`` documents with a score above 0.

    Equal scores are ordered by id, null ids first. Every row of ``docs`` is a document,
    repeated rows too. Rows of one item id are one item with the terms of all of them; null
    item ids are one item. Null and empty texts have no terms: such items have no rows,
    such documents no score and no part in the number of documents. An item whose terms no
    document holds has no rows. An empty table on either side gives no rows. Other columns
    aren't read, so names may clash.

    Of the items, a part of about ``QUERY_BYTES`` (dealt by hash) is in memory at a time,
    and in every task; each part cuts the documents' texts once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    asked, n_parts = _item_parts(items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text")))
    out: DataFrame | None = None
    for part in range(n_parts):
        of_item: dict = {}
        for r in asked.where(F.col("part") == part).select("item_id", "text").toLocalIterator():
            of_item.setdefault(r.item_id, set()).update(cut(pa.array([r.text]), WORDS)[1].to_pylist())
        item_ids = sorted(of_item, key=lambda i: (i is not None, i))
        names = sorted(set().union(*of_item.values()))
        number = {t: i for i, t in enumerate(names)}
        terms = [sorted(number[t] for t in of_item[i]) for i in item_ids]
        starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype("i8")
        postings = materialize(_postings(rows, pa.array(names, pa.large_binary())), f"postings-{part}")
        whole = postings.agg(F.sum(F.expr("size(filter(lengths, x -> x > 0))")).alias("docs"), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("terms")).first()
        n_docs, n_terms = whole["docs"] or 0, whole["terms"] or 0
        df = np.zeros(len(names), "i8")
        counted = postings.select(F.explode(F.arrays_zip("terms", F.expr("transform(ends, (e, i) -> e - if(i = 0, 0, ends[i - 1]))").alias("n"))).alias("t"))
        for r in counted.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.n").alias("n")).toLocalIterator():
            df[r.term] = r.n
        weights = np.array([impact_weight(n_docs, n) for n in df.tolist()], "i8")
        found = _products(postings, item_ids, starts, np.array([t for x in terms for t in x], "i8"), weights, n_docs, n_terms, top)
        if n_parts > 1:  # a part's rows are few; its blocks make room for the next part's
            best = materialize(_ranked(found, top), f"found-{part}")
            discard(postings)
        else:
            best = _ranked(found, top)
        out = best if out is None else out.unionByName(best)
    return out
