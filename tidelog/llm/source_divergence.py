"""Audit of how far the sources of a language diverge in their words.

Each language keeps the terms that stand in enough of its documents. A source's share of
a term is an integer (parts of ``scale``, smoothed), the distance of two sources at a term
``(p - q)^2 // (p + q)``, and their divergence the sum over all kept terms. Against the
language as a whole the same distance names the terms that a source overuses.

Terms become integers: kept terms of all languages are dealt into ranges in order of their
UTF-8 bytes, a range's terms are a sorted array in which ``searchsorted`` finds ids, and
``bincount`` of the ids gives each source's dense vector of the range. As ids keep the
order of the bytes, equal distances are ordered by id. What leaves a range is a sum for
each two sources, and each source's best terms; a language with most of the text is as
many ranges as its dictionary needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, range_buckets, ranges_of, tidy
from .terms import alphabet, cut, parts

LETTERS = alphabet(digits=False)
#: Numbers of a dense block (sources times terms) that are in memory at a time.
BLOCK = 1 << 19
_COUNTED = "lang string, source string, term string, n long, docs long"
_FOUND = "lang string, source string, part string, item string, value long"


def _counted(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, summed up within each part of a batch."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in parts(batch.column(2)):
                part = batch.slice(start, stop - start)
                row, found = cut(part.column(2), LETTERS)
                if not len(found):
                    continue
                coded = found.dictionary_encode()
                ids, names = np.asarray(coded.indices).astype("i8"), coded.dictionary
                groups: dict[tuple, int] = {}
                group = np.array([groups.setdefault(x, len(groups)) for x in zip(part.column(0).to_pylist(), part.column(1).to_pylist())], "i8")
                in_doc, times = np.unique(row * len(names) + ids, return_counts=True)
                key, at = np.unique(group[in_doc // len(names)] * len(names) + in_doc % len(names), return_inverse=True)
                docs = np.bincount(at)
                n = np.zeros(len(key), "i8")
                np.add.at(n, at, times)
                langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
                owner = pa.array(key // len(names))
                terms = names.take(pa.array(key % len(names))).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(owner), sources.take(owner), terms, pa.array(n), pa.array(docs, pa.int64())], schema=schema)

    return docs.mapInArrow(tidy(run), _COUNTED)


def shares(counts: np.ndarray, total: np.ndarray | int, kept: int, scale: int, prior: int) -> np.ndarray:
    """``1 + scale * (counts + prior) // (total + prior * kept)`` exactly, where ``scale`` is a power of 1000.

    A long division by digits of base 1000, so nothing exceeds 64 bits while the divisor is
    under 9e15.
    """
    whole = np.asarray(total) + prior * kept
    out, rest = np.divmod(counts + prior, whole)
    while scale > 1:
        digit, rest = np.divmod(rest * 1000, whole)
        out, scale = out * 1000 + digit, scale // 1000
    return out + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _best(value: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the largest values, equal ones by id."""
    if len(value) > most:
        least = np.partition(value, len(value) - most)[len(value) - most]
        some = np.flatnonzero(value >= least)
    else:
        some = np.arange(len(value))
    return some[np.lexsort((ids[some], -value[some]))][:most]


def _range(lang: str, sources: list[str], totals: np.ndarray, kept: int, terms: np.ndarray, source: np.ndarray, n: np.ndarray, scale: int, prior: int, ranks: int):
    """Rows of one range of a language's dictionary; ``terms``, ``source``, ``n``: its counts."""
    names = np.unique(terms) if len(terms) else np.empty(0, object)
    ids = np.searchsorted(names, terms) if len(terms) else np.empty(0, "i8")
    many, width = len(sources), max(1, BLOCK // max(1, len(sources)))
    pairs = np.zeros((many, many), "i8")
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, "i8"), np.empty(0, "i8"))] * many
    for first in range(0, len(names), width):
        size = min(width, len(names) - first)
        here = (ids >= first) & (ids < first + size)
        counts = np.zeros(many * size, "i8")
        np.add.at(counts, source[here] * size + ids[here] - first, n[here])  # a bincount whose weights stay whole numbers
        counts = counts.reshape(many, size)
        p = shares(counts, totals[:, None], kept, scale, prior)
        q = shares(counts.sum(axis=0), int(totals.sum()), kept, scale, prior)
        for i in range(many):
            pairs[i, i + 1 :] += distances(p[i], p[i + 1 :]).sum(axis=1)
            more = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = np.concatenate([best[i][0], distances(p[i][more], q[more])])
            at = np.concatenate([best[i][1], more + first])
            top = _best(value, at, ranks)
            best[i] = value[top], at[top]
    pairs += pairs.T
    for i, name in enumerate(sources):
        for j, other in enumerate(sources):
            if i != j:
                yield lang, name, "pair", other, int(pairs[i, j])
        for value, at in zip(*best[i]):
            yield lang, name, "term", names[at].decode(), int(value)


def audit(docs: DataFrame, *, min_docs: int = 10, ranks: int = 10, scale: int = 10**9, prior: int = 2, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (language, source) that occurs.

    Part ``pair``: each other source of the language with their divergence, all ranks. Part
    ``term``: the ``ranks`` terms that the source uses most beyond the language's share.
    Ranks go from 1, by value descending, then by the item's UTF-8 bytes.

    Null texts, languages and sources are read as ''. Every row is a document, repeated rows
    too; ids aren't read. A source without terms has the smoothed share everywhere, a
    language that keeps no term has divergences of 0. A language with a single source has
    no pairs. An empty table gives no rows. Other columns, clashing names included, aren't
    read. The result has a row for each two sources of a language: sources are
    what is audited, so they are expected to be thousands at most.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    # Parts are summed up before they travel, and a term's rows meet once: its sources and its language share a task.
    met = _counted(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = materialize(met.withColumn("in_lang", in_lang).where(F.col("in_lang") >= min_docs).select("lang", "source", "term", "n"), "kept-terms")
    ranged = range_buckets(kept, [F.col("lang"), F.col("term")], "term-ranges", ranges=ranges_of(kept, F.octet_length("term") + 24))
    discard(kept)
    groups = rows.select("lang", "source").distinct()
    totals = groups.join(ranged.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    by_source = F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total"))))
    ranges = ranged.groupBy("lang", "bucket").agg(F.countDistinct("term").alias("terms"))
    kept_terms = ranges.groupBy("lang").agg(F.sum("terms").alias("kept"))
    known = totals.groupBy("lang").agg(by_source.alias("sources")).join(kept_terms, "lang", "left")
    # A language that keeps nothing still has a range, so that its sources are compared.
    known = known.join(ranges.select("lang", "bucket"), "lang", "left")
    known = known.select("lang", F.coalesce("bucket", F.lit(-1)).alias("bucket"), "sources.source", "sources.total", F.coalesce("kept", F.lit(0)).alias("kept"))

    def compare(about: pa.Table, counts: pa.Table) -> pa.Table:
        (info,) = about.to_pylist()
        sources = info["source"]
        number = {s: i for i, s in enumerate(sources)}
        terms = np.array(counts["term"].cast(pa.binary()).to_pylist(), object)
        source = np.array([number[s] for s in counts["source"].to_pylist()], "i8")
        found = list(_range(info["lang"], sources, np.array(info["total"], "i8"), info["kept"], terms, source, np.asarray(counts["n"]).astype("i8"), scale, prior, ranks))
        columns = zip(*found) if found else [()] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])

    found = known.groupBy("lang", "bucket").cogroup(ranged.groupBy("lang", "bucket")).applyInArrow(compare, _FOUND)
    keys = ["lang", "source", "part"]
    # Sums of the ranges; a term lies in one range, so its sum is its value.
    summed = found.groupBy(*keys, "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("value").desc(), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= ranks)).select(*keys, "item", "value", "rank")
