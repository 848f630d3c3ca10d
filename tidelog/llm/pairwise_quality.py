"""Document quality from pairwise preferences (Bradley-Terry).

A document's strength is linear in features of its whole text, none of which is a word:
shares of kinds of bytes and of steps from kind to kind, lengths of words, lines and
sentences, repetition. The chance that one document is preferred to another is the logistic function of the
difference of their strengths, so weights are learnt from pairs (a document labelled good,
one labelled bad) by logistic loss on differences of features; what pairs have in common
cancels. A threshold turns strengths into a verdict: the quantile of the labelled
documents' strengths at the share of bad labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: Kinds of bytes: blank, line end, small, capital, digit, end of sentence, other mark, beyond ASCII.
KINDS = 8
_BLANK, _LINE, _SMALL, _CAPITAL, _DIGIT, _END, _MARK, _WIDE = range(KINDS)
_KIND = np.full(256, _MARK, "u1")
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _BLANK
_KIND[0x0A] = _LINE
_KIND[ord("a") : ord("z") + 1] = _SMALL
_KIND[ord("A") : ord("Z") + 1] = _CAPITAL
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord(c) for c in ".!?"]] = _END
_KIND[128:] = _WIDE
#: Marks that have a share of their own.
_OWN = np.frombuffer(b"!?.,;:'\"()[]{}#*$%&|<>/\\@_-=+~^`", "u1")
#: Features of a text.
FEATURES = KINDS + KINDS * KINDS + len(_OWN) + 22


def _repeated(words: list[str], widths: Sequence[int] = (3, 6)) -> list[float]:
    """For each width the share of windows of so many words that are met again in the text (by 64-bit keys of windows)."""
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    ids = np.fromiter(map(number.__getitem__, words), "u8", len(words))
    out, key, reached = [], ids * _ODD + _ODD, 1
    for width in widths:
        for k in range(reached, width):
            key = (key[:-1] ^ key[:-1] >> _HALF) * _ODD + ids[k:]
        reached = width
        ordered = np.sort(key)
        out.append(float((ordered[1:] == ordered[:-1]).sum()) / max(1, len(ordered)))
    return [len(number), *out]


_ODD, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def features(text: str) -> np.ndarray:
    """The features of one text; all 0 without a word."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
    kind = _KIND[data]
    inside = kind > _LINE
    words = np.diff(np.concatenate([[False], inside, [False]]).astype("i1"))
    start, stop = np.flatnonzero(words == 1), np.flatnonzero(words == -1)
    n = len(start)
    if not n:
        return np.zeros(FEATURES)
    size = len(data)
    steps = np.bincount(kind[:-1].astype("i8") * KINDS + kind[1:], minlength=KINDS * KINDS) / size
    counts = np.bincount(data, minlength=256)
    length = stop - start
    before = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    per_word = lambda mask: (seen := before(mask))[stop] - seen[start]
    capitals, smalls, marks = per_word(kind == _CAPITAL), per_word((kind == _SMALL) | (kind == _WIDE)), per_word(kind == _MARK)
    split = text.split()
    distinct, *repeated = _repeated(split)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = int(counts[[ord(c) for c in ".!?"]].sum())
    share = counts[counts > 0] / size
    half = np.log1p
    own = np.array([
        half(n), half(size), length.mean(), length.std(), (length <= 3).mean(), (length >= 12).mean(), (length >= 25).mean(), half(length.max()),
        (smalls == 0).mean(), ((capitals > 1) & (smalls == 0)).mean(), ((capitals > 0) & (_KIND[data[start]] == _CAPITAL)).mean(), (marks > 0).mean(), (marks == length).mean(),
        half(distinct) / half(max(1, len(split))), *repeated,
        1 - len(set(lines)) / max(1, len(lines)), half(n / max(1, len(lines))), half(n / max(1, ends)), -(share * np.log2(share)).sum(),
        half(ends), float(distinct < 3),
    ])
    return np.concatenate([np.bincount(kind, minlength=KINDS) / size, steps, counts[_OWN] / size, own])


@dataclass(frozen=True)
class Ranker:
    """A learnt model: ``score`` is over one half at strengths of ``threshold`` and more."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIPPED, CLIPPED) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -30, 30)))


#: Features count so many standard deviations from the mean at most.
CLIPPED = 6.0


def learn(x: np.ndarray, good: np.ndarray, *, bad_share: float, pairs: int = 40_000, penalty: float = 2e-3, seed: int = 0) -> Ranker:
    """Weights by Newton steps on the logistic loss of ``pairs`` preference pairs, drawn by ``seed``.

    ``bad_share``: share of bad labels, the quantile of the threshold; the rows of ``x``
    weigh so that theirs agree with it. Without a good and a bad document there is no
    preference: weights and threshold are 0, and all scores are one half.
    """
    width = x.shape[1] if x.ndim == 2 else FEATURES
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean = (x[better].mean(axis=0) + x[worse].mean(axis=0)) / 2
    spread = np.sqrt((x[better].var(axis=0) + x[worse].var(axis=0)) / 2 + ((x[better].mean(axis=0) - x[worse].mean(axis=0)) / 2) ** 2)
    scale = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - mean) / scale, -CLIPPED, CLIPPED)
    rng = np.random.default_rng(seed)
    # Every document takes part as often as the others of its label.
    turn = lambda rows: np.concatenate([rng.permutation(rows) for _ in range(-(-pairs // len(rows)))])[:pairs]
    difference = z[turn(better)] - z[turn(worse)]
    w = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))  # chance of the other order
        gradient = difference.T @ p / pairs - penalty * w
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + penalty * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    strength = z @ w
    weight = np.where(good, (1 - bad_share) / len(better), bad_share / len(worse))
    order = np.argsort(strength, kind="stable")
    below = np.cumsum(weight[order])
    at = min(max(int(np.searchsorted(below, bad_share - 1e-12)), 0), len(order) - 2)
    return Ranker(mean, scale, w, float(strength[order[at]] + strength[order[at + 1]]) / 2)


def _featured(docs: DataFrame) -> DataFrame:
    """``x`` (the features) for the columns ``good, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py() or "") for t in batch.column(1)]
            flat = np.concatenate(x) if x else np.empty(0)
            ends = pa.array(np.arange(len(x) + 1) * FEATURES, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(flat, pa.float64()))], ["good", "x"])

    return docs.mapInArrow(tidy(run), "good boolean, x array<double>")


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Rows whose labels are not learnt; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 12_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", seed: int = 0) -> Ranker:
    """Learn from the labelled documents that are not held out.

    ``sample``: labelled ids at most, half of each label, drawn by hash; their features go
    to the driver (about a kilobyte each). Ids with both labels, and labels or ids that are
    null, teach nothing. Each row of an id with several texts is a document.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).where(~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("long").alias("label_id")).agg(F.min(label_col).alias("least"), F.max(label_col).alias("most")).where("least = most")
    n = known.agg(F.count("*").alias("all"), F.count_if(F.col("most") == 0).alias("bad")).first()
    some = lambda of: known.where(F.col("most") == of).orderBy(F.xxhash64("label_id", F.lit(seed)), "label_id").limit(sample // 2)
    drawn = some(1).unionByName(some(0)).select("label_id", (F.col("most") == 1).alias("good"))
    texts = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(drawn), "label_id")
    rows = sorted((tuple(r.x), r.good) for r in _featured(texts.select("good", "text")).toLocalIterator())
    x, good = np.array([r[0] for r in rows]).reshape(len(rows), FEATURES), np.array([r[1] for r in rows], bool)
    return learn(x, good, bad_share=n["bad"] / n["all"] if n["all"] else 0.0, seed=seed)


def score(docs: DataFrame, ranker: Ranker, *, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, and the columns ``keep`` as ``kept_<name>``.

    One pass without a shuffle, over whole texts; memory follows the longest. Null and empty
    texts have features of 0 and are scored like others. Null ids and repeated rows
    are rows. Of other columns only those in ``keep`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py() or "") for t in batch.column(2)]).reshape(len(batch), FEATURES)
            found = pa.array(ranker.score(x), pa.float64())
            predicted = pc.greater_equal(found, 0.5).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found, predicted, *batch.columns[3:]], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    names = ["doc_id", "held_out", "score", "predicted", *[f"kept_{c}" for c in keep]]
    kept = "".join(f", `kept_{c}` {rows.schema[f'kept_{c}'].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(tidy(run), f"doc_id long, held_out boolean, score double, predicted int{kept}")
