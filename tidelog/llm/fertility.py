"""Quality rules with tokeniser fertility.

A public vocabulary that was not fitted to junk encodes it badly: few characters per
token, many bytes that fall back to byte pieces, and a token entropy far below that of
prose (one thing repeated) or, for long texts, above it. Bands per script, which a band
of the document's language overrides, say what is accepted. ``clean_bands`` sets them from
all texts labelled clean; the entropy of a text is held against that of clean ones as long.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TwoGenerations, discard, materialize, tidy
from .pieces import pieces

_WORD = re.compile("[^\x20\x09-\x0d]+")
_LATIN = re.compile("[\0-\u024f\u2000-\u206f]*")
_SYMBOLS = re.compile(r"[#*$%&|<>]")

#: Pre-tokens of one cache generation: about 250 bytes each.
CACHED = 120_000

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string, base_failed boolean"
)
COLUMNS = f"{MEASURES}, kept boolean"


@dataclass(frozen=True)
class Band:
    """Accepted values; a text under ``min_tokens`` tokens is too short for a verdict on entropy.

    ``floor``: least entropy by length, as points (log2 of tokens, bits) of a line that is
    level beyond its ends.
    """

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: tuple[float, float]
    min_tokens: int = 64
    floor: tuple[tuple[float, float], ...] = ()


#: By script, for texts that no labels speak for. Prose in scripts with pieces of their own
#: (Chinese, Japanese, Korean, Arabic, Hebrew, Hindi, Thai, Georgian, Tamil) was seen at
#: 0.92-1.07 characters a token and byte shares up to 0.10, random ideographs and syllables
#: at 0.39-0.41 and 0.89-0.92. A script that the vocabulary spells in bytes (Ethiopic) is
#: rejected: it can't be told from junk.
SCRIPT_BANDS: dict[str, Band] = {
    "latin": Band((1.3, 9.0), 0.10, (3.0, 12.5)),
    "greek_cyrillic": Band((0.9, 9.0), 0.30, (3.0, 12.5)),
    "other": Band((0.6, 9.0), 0.5, (3.0, 12.5)),
}


def script_of(text: str) -> str:
    """The script of most letters, by Unicode block."""
    if _LATIN.fullmatch(text):
        return "latin"
    letters = [ord(c) for c in text if c.isalpha()]
    latin = sum(c < 0x250 or 0x1E00 <= c < 0x1F00 for c in letters)
    greek = sum(0x370 <= c < 0x530 for c in letters)
    if 2 * latin >= len(letters):
        return "latin"
    return "greek_cyrillic" if 2 * greek >= len(letters) else "other"


def repeated_window_words(words: list[str], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "i8", len(words))
    key = ids[:n].copy()
    for k in range(1, width):  # renumbered at each step, so that keys stay small and exact
        key = np.unique(key * len(number) + ids[k : k + n], return_inverse=True)[1].reshape(-1)
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if _WORD.search(line):
            n += line in seen
            seen.add(line)
    return n


def entropy(counts: Counter) -> float:
    """Bits per token of the text's own token distribution."""
    total = sum(counts.values())
    if not total:
        return 0.0
    return max(0.0, math.log2(total) - sum(n * math.log2(n) for n in sorted(counts.values())) / total)


def accepted(band: Band, n_tokens: int, chars_per_token: float, byte_share: float, bits: float) -> bool:
    """The method's verdict."""
    low, high = band.chars_per_token
    if not low <= chars_per_token <= high or byte_share > band.byte_share:
        return False
    if n_tokens < band.min_tokens:
        return True
    least = float(np.interp(math.log2(n_tokens), *zip(*band.floor))) if band.floor else band.entropy[0]
    return max(least, band.entropy[0]) <= bits <= band.entropy[1]


#: The band above (of the script, or the fixed one) counts as so many clean texts.
ABOVE_COUNTS = 16
#: Share of clean texts that a band may leave out at each bound.
OUTSIDE = 0.002


#: Steps in one unit of the figures that bands are fitted to: counts by step are exact, and their number is bounded.
GRID = 1 << 14


def _band(least: int, per: Sequence[float], share: float, most_bits: float, ends: tuple[float, float], line: Callable, below: float, script: Band) -> Band:
    """The band of clean texts by their figures' bounds and the ``line`` of entropy over length."""
    return Band(
        (float(per[0]) * 0.99, float(per[1]) * 1.1),
        float(share) + 0.01,
        (script.entropy[0], float(most_bits) + 0.5),
        int(least),
        tuple((float(x), float(line(x) + below - 0.02)) for x in np.linspace(*ends, 9)),
    )


def fitted(figures: Sequence[tuple[int, float, float, float]], script: Band = SCRIPT_BANDS["latin"]) -> Band:
    """The band of a few clean texts, given as ``n_tokens, chars_per_token, byte_share, token_entropy``; :func:`bands_of` fits tables."""
    n, per, share, bits = np.array(figures, "f8").T
    length = np.log2(n)
    centred = np.poly1d(np.polyfit(length - length.mean(), bits, min(2, len(np.unique(length)) - 1)))
    line = lambda x: centred(x - length.mean())
    below = np.quantile(bits - line(length), OUTSIDE)
    return _band(n.min(), np.quantile(per, [OUTSIDE, 1 - OUTSIDE]), np.quantile(share, 1 - OUTSIDE), bits.max(), (length.min(), length.max()), line, below, script)


def _least_squares(powers: Sequence[int], products: Sequence[int]) -> list[Fraction]:
    """Coefficients (constant first) of the parabola, or of the line or level where there are fewer lengths, from the sums of ``x ** k`` and ``x ** k * y``."""
    for degree in (2, 1, 0):
        m = [[Fraction(powers[i + j]) for j in range(degree + 1)] + [Fraction(products[i])] for i in range(degree + 1)]
        for i in range(degree + 1):
            if not m[i][i]:
                break
            m[i] = [v / m[i][i] for v in m[i]]
            for k in range(degree + 1):
                if k != i:
                    m[k] = [v - m[k][i] * w for v, w in zip(m[k], m[i])]
        else:
            return [row[-1] for row in m] + [Fraction(0)] * (2 - degree)
    raise ValueError("no figures")


def blended(own: Band, above: Band, n: int) -> Band:
    """The band of ``n`` clean texts, drawn towards the one above it the fewer they are."""
    w = n / (n + ABOVE_COUNTS)
    mix = lambda a, b: w * a + (1 - w) * b
    least = lambda x: float(np.interp(x, *zip(*above.floor))) if above.floor else above.entropy[0]
    return Band(
        (mix(own.chars_per_token[0], above.chars_per_token[0]), mix(own.chars_per_token[1], above.chars_per_token[1])),
        mix(own.byte_share, above.byte_share),
        (mix(own.entropy[0], above.entropy[0]), mix(own.entropy[1], above.entropy[1])),
        round(mix(own.min_tokens, above.min_tokens)),
        tuple((x, mix(y, least(x))) for x, y in own.floor),
    )


_FIGURES = ("lang", "script", "n_tokens", "chars_per_token", "byte_share", "token_entropy")


def bands_of(measured: DataFrame, labels: DataFrame) -> dict[tuple[str | None, str], Band]:
    """Bands for ``score`` from all rows of :func:`measure` that ``labels(doc_id, quality)`` call clean (quality 1).

    Texts that fail the base rules are left out. A script's band is fitted to all clean texts
    in it and drawn towards :data:`SCRIPT_BANDS`, a language's fitted to its own texts and
    drawn towards its script's, the more the fewer texts there are, without a step.
    Documents without a language have the script's band; so has a language that no label
    speaks for, if any label speaks for its script. Of an id with several texts the first in
    order of their figures counts.

    Quantiles and sums are taken by Spark over figures in steps of 1 / :data:`GRID`, so they
    are exact in any order, and a group's state is bounded by the steps; a row for each
    language and script comes to the driver.
    """
    clean = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = measured.where("NOT base_failed AND n_tokens > 0").select("doc_id", *_FIGURES).join(clean, "doc_id", "left_semi")
    one = materialize(rows.groupBy("doc_id").agg(F.min(F.struct(*_FIGURES)).alias("r")).select("r.*"), "clean-figures")
    groups = F.array_distinct(F.array(F.struct(F.lit(None).cast("string").alias("lang"), F.col("script")), F.struct("lang", "script")))
    step = lambda c: F.round(c * GRID)
    length = step(F.log2("n_tokens"))
    grouped = one.withColumn("length", length / GRID).select(F.explode(groups).alias("g"), "n_tokens", "chars_per_token", "byte_share", "token_entropy", "length").select("g.*", "n_tokens", "chars_per_token", "byte_share", "token_entropy", "length")
    x, y = (step(F.col(c)).cast("decimal(12,0)") for c in ("length", "token_entropy"))
    xx = x * x
    found = grouped.groupBy("lang", "script").agg(
        F.count("*").alias("n"), F.min("n_tokens").alias("least"), F.max("token_entropy").alias("most_bits"), F.min("length").alias("low"), F.max("length").alias("high"),
        F.percentile(step(F.col("chars_per_token")) / GRID, [OUTSIDE, 1 - OUTSIDE]).alias("per"), F.percentile(step(F.col("byte_share")) / GRID, 1 - OUTSIDE).alias("share"),
        F.array(F.sum(x), F.sum(xx), F.sum(xx * x), F.sum(xx * xx)).alias("powers"), F.array(F.sum(y), F.sum(x * y), F.sum(xx * y)).alias("products"),
    ).collect()
    if not found:
        discard(one)
        return {}
    lines = {}
    for r in found:
        c = _least_squares([r.n, *map(int, r.powers)], list(map(int, r.products)))
        lines[r.lang, r.script] = tuple(float(v * Fraction(GRID) ** (k - 1)) for k, v in enumerate(c))
    fits = one.sparkSession.createDataFrame([(*k, *v) for k, v in lines.items()], "of_lang string, of_script string, c0 double, c1 double, c2 double")
    own = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("script") == F.col("of_script"))
    rest = F.col("token_entropy") - (F.col("c0") + F.col("length") * (F.col("c1") + F.col("length") * F.col("c2")))
    rests = grouped.join(F.broadcast(fits), own).groupBy("lang", "script").agg(F.percentile(step(rest) / GRID, OUTSIDE).alias("below")).collect()
    discard(one)
    below = {(r.lang, r.script): r.below for r in rests}

    def fit(r) -> Band:
        c0, c1, c2 = lines[r.lang, r.script]
        return _band(r.least, r.per, r.share, r.most_bits, (r.low, r.high), lambda v: c0 + v * (c1 + v * c2), below[r.lang, r.script], SCRIPT_BANDS[r.script])

    bands: dict = {(None, r.script): blended(fit(r), SCRIPT_BANDS[r.script], r.n) for r in found if r.lang is None}
    return bands | {(r.lang, r.script): blended(fit(r), bands[None, r.script], r.n) for r in found if r.lang is not None}


def clean_bands(docs: DataFrame, labels: DataFrame, vocabulary: str, **columns: str) -> dict[tuple[str | None, str], Band]:
    """:func:`bands_of` for the documents that ``labels`` call clean; only those are measured."""
    id_col = columns.get("id_col", "doc_id")
    clean = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias(id_col))
    return bands_of(measure(docs.withColumn(id_col, F.col(id_col).cast("long")).join(clean, id_col, "left_semi"), vocabulary, **columns), labels)


def score_by_labels(docs: DataFrame, labels: DataFrame, vocabulary: str, *, keep: Sequence[str] = (), base_passed: bool = False) -> DataFrame:
    """:func:`score` in the bands of all texts that ``labels`` call clean. Texts are read once; :func:`~.common.discard` removes what the rows are read from.

    ``base_passed``: rows that fail the base rules are left out.
    """
    measured = measure(docs, vocabulary, keep=keep)
    measured = materialize(measured.where("NOT base_failed") if base_passed else measured, "measures")
    out = judge(measured, language_bands=bands_of(measured, labels))
    out._tidelog_path = measured._tidelog_path
    return out


def judge(measured: DataFrame, *, bands: Mapping[str, Band] = SCRIPT_BANDS, language_bands: Mapping[str | tuple[str | None, str], Band] | None = None) -> DataFrame:
    """:data:`COLUMNS` of rows of :func:`measure`, with the verdict, and the columns that they kept."""
    by_language = dict(language_bands or {})
    by_script = dict(bands)

    @F.pandas_udf("boolean")
    def within(lang: pd.Series, script: pd.Series, n_tokens: pd.Series, per: pd.Series, share: pd.Series, bits: pd.Series) -> pd.Series:
        out = []
        for l, s, *figures in zip(*(c.tolist() for c in (lang, script, n_tokens, per, share, bits))):
            band = by_language.get((l, s)) or by_language.get(l) or by_language.get((None, s)) or by_script[s]
            out.append(accepted(band, *figures))
        return pd.Series(out, dtype="bool")

    names = [f.name for f in T.StructType.fromDDL(MEASURES).fields]
    others = [c for c in measured.columns if c.startswith("kept_")]
    return measured.select(*names, (~F.col("base_failed") & within(*_FIGURES)).alias("kept"), *others)


def score(docs: DataFrame, vocabulary: str, *, bands: Mapping[str, Band] = SCRIPT_BANDS, language_bands: Mapping[str | tuple[str | None, str], Band] | None = None, **measured) -> DataFrame:
    """One row per input row (:data:`COLUMNS`), in one pass without a shuffle; ``measured`` are arguments of :func:`measure`.

    ``kept``: base rules passed and the figures within the band of the language in this
    script (``(lang, script)``, with a null language too), else of the language, else of the
    script. A null or unknown language falls back to the script.
    """
    return judge(measure(docs, vocabulary, **measured), bands=bands, language_bands=language_bands)


def measure(
    docs: DataFrame,
    vocabulary: str,
    *,
    min_words: int = 50,
    repeat_percent: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: Sequence[str] = (),
) -> DataFrame:
    """:data:`MEASURES` and ``lang`` of every input row, in one pass without a shuffle.

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` per
    cent of them in repeated three-word windows. Null and empty texts have no words, so they
    fail. Null ids and repeated rows are kept as rows. Of other columns only those in ``keep``
    are read; they are passed on as ``kept_<name>`` (a text goes through once). The cache of
    piece ids is bounded; memory otherwise follows the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(vocabulary)
        cache = TwoGenerations(model.ids_of, most=CACHED)
        is_byte = model.is_byte
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                words = _WORD.findall(text)
                n_words, repeated = len(words), repeated_window_words(words)
                failed = n_words < min_words or 100 * repeated > repeat_percent * n_words
                tokens: Counter = Counter(chain.from_iterable(map(cache.__getitem__, model.split(text))))
                n_tokens = sum(tokens.values())
                n_bytes = sum(n for t, n in tokens.items() if is_byte[t])
                per, share, bits = (len(text) / n_tokens, n_bytes / n_tokens, entropy(tokens)) if n_tokens else (0.0, 0.0, 0.0)
                rows.append((
                    doc, n_words, sum(map(len, words)), len(_SYMBOLS.findall(text)), duplicate_lines(text), repeated,
                    n_tokens, per, share, bits, script_of(text), failed,
                ))
            columns = zip(*rows) if rows else [()] * 12
            kinds = [pa.int64()] * 7 + [pa.float64()] * 3 + [pa.string(), pa.bool_()]
            measured = [pa.array(x, k) for x, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*measured, *[batch.column(i) for i in passed]], schema.names)

    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    again = [c for c in keep if c != text_col or not isinstance(docs.schema[c].dataType, T.StringType)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"), *[F.col(c).alias(f"kept_{c}") for c in again])
    passed = [2] + [3 + again.index(c) if c in again else 1 for c in keep]
    names = ["lang", *[f"kept_{c}" for c in keep]]
    schema = T.StructType(T.StructType.fromDDL(MEASURES).fields + [T.StructField(c, rows.schema[i].dataType) for c, i in zip(names, passed)])
    return rows.mapInArrow(tidy(run), schema)
