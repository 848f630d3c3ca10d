"""Chroma fingerprints of audio columns, and the alignment of recordings by them.

A recording (mono 16-bit WAV bytes) becomes frames of twelve pitch-class energies. Filters
compare areas of the frame-by-pitch image, whose sums come from its integral image; each
is quantised to two Gray-coded bits, and sixteen of them make one 32-bit integer a frame.

Equal fingerprints are one class. A query class is aligned with others that share all but
two of an integer's sixteen filters, under one of three choices of the two: long keys are
shared by few recordings by chance, and several choices find codes with errors in any
one filter of theirs. The offsets of such hits make a histogram, its peak is the offset of
the pair, and the share of differing bits over the overlap there decides.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

FRAME, HOP, SPAN = 1024, 512, 8
FINGERPRINTS = "rec_id long, digest string, codes array<long>"


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """A mono 16-bit WAV file."""
    data = np.clip(np.round(samples * 32767), -32768, 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def read_wav(data: bytes | None) -> tuple[np.ndarray, int]:
    """Samples in -1..1 and their rate; channels are averaged. What isn't such a file gives no samples."""
    none = np.empty(0, "f8"), 8000
    if not data or len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return none
    at, channels, rate, bits, kind = 12, 1, 8000, 0, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt " and at + 24 <= len(data):
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data":
            if (kind, bits) != (1, 16) or not channels or not rate:
                return none
            body = data[at + 8 : at + 8 + size]
            samples = np.frombuffer(body[: len(body) // (2 * channels) * 2 * channels], "<i2").reshape(-1, channels)
            return samples.mean(axis=1) / 32768, rate
        at += 8 + size + size % 2
    return none


def chroma(samples: np.ndarray, rate: int, low: float = 55.0, high: float = 1900.0) -> np.ndarray:
    """Frames by twelve pitch classes, each frame scaled to a sum of one (silence: even)."""
    n = 1 + (len(samples) - FRAME) // HOP if len(samples) >= FRAME else 0
    if not n:
        return np.empty((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP][:n]
    power = np.abs(np.fft.rfft(frames * np.hanning(FRAME), axis=1)) ** 2
    hertz = np.fft.rfftfreq(FRAME, 1 / rate)
    used = (hertz >= low) & (hertz <= high)
    pitch = np.round(12 * np.log2(hertz[used] / 440.0)).astype(int) % 12
    fold = np.zeros((used.sum(), 12))
    fold[np.arange(used.sum()), pitch] = 1
    energy = power[:, used] @ fold + 1e-9
    return energy / energy.sum(axis=1, keepdims=True)


def filter_bank() -> list[tuple[int, int, int, int]]:
    """Sixteen filters (kind, first pitch, pitches, frames), from a rule.

    Kinds: 0 compares halves in pitch, 1 halves in time, 2 opposite quarters, 3 the middle
    third in pitch with the outer ones.
    """
    return [(k % 4, (5 * k) % 7, 6 if k % 4 == 3 else 4 + 2 * (k // 8), SPAN if k % 2 else SPAN // 2) for k in range(16)]


def codes(image: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each frame with :data:`SPAN` frames from it on."""
    n = len(image) - SPAN + 1
    if n < 1:
        return np.empty(0, "i8")
    integral = np.zeros((len(image) + 1, 13))
    integral[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return integral[t + t1, p1] - integral[t + t0, p1] - integral[t + t1, p0] + integral[t + t0, p0]

    out = np.zeros(n, "i8")
    for kind, p, height, width in filter_bank():
        top, half_p, half_t = p + height, p + height // 2, width // 2
        if kind == 0:
            a, b = area(0, width, p, half_p), area(0, width, half_p, top)
        elif kind == 1:
            a, b = area(0, half_t, p, top), area(half_t, width, p, top)
        elif kind == 2:
            a = area(0, half_t, p, half_p) + area(half_t, width, half_p, top)
            b = area(0, half_t, half_p, top) + area(half_t, width, p, half_p)
        else:
            third = height // 3
            b = area(0, width, p + third, top - third)
            a = area(0, width, p, top) - b
        ratio = np.log((a + 0.05) / (b + 0.05))
        level = (ratio > -0.7).astype("i8") + (ratio > 0) + (ratio > 0.7)
        out = (out << 2) | (level ^ (level >> 1))
    return out


def fingerprints(recordings: DataFrame, *, id_col: str = "rec_id", audio_col: str = "audio") -> DataFrame:
    """Fingerprint of each recording (:data:`FINGERPRINTS`); no codes for what is no audio or too short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codes(chroma(*read_wav(x.as_py()))) for x in batch.column(1)]
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).hexdigest() if len(x) else None for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string()), pa.array(found, pa.list_(pa.int64()))], ["rec_id", "digest", "codes"])

    return recordings.select(F.col(id_col).cast("long").alias("rec_id"), F.col(audio_col).cast("binary").alias("audio")).mapInArrow(run, FINGERPRINTS)


#: What the keys leave out: two neighbouring filters (four bits) each.
MASKS = tuple(0xFFFFFFFF ^ 0xF << at for at in (28, 14, 0))


def _keys(code: Column) -> Column:
    """The keys of a code, one for each mask, apart by their highest bits."""
    return F.array(*[code.bitwiseAND(F.lit(m)) + F.lit(k << 32) for k, m in enumerate(MASKS)])


def _first_key(a: Column, b: Column, key: Column) -> Column:
    """Whether no mask before that of the key makes two codes equal, so that a hit counts once."""
    earlier = F.lit(False)
    for k, m in enumerate(MASKS[:-1]):
        earlier = earlier | ((F.shiftright(key, 32) > k) & (a.bitwiseXOR(b).bitwiseAND(F.lit(m)) == 0))
    return ~earlier


def align(prints: DataFrame, *, query_step: int = 100, max_errors: float = 0.10, min_overlap: float = 0.5) -> DataFrame:
    """Align recordings with the queries, those whose id ``query_step`` divides.

    One row per recording: ``rec_id, n_codes, digest, class_id, n_links, best_query,
    best_offset, bit_errors``. ``class_id``: least id of the recordings with the same
    fingerprint. ``n_links``: other classes with a query that this one aligns with, that
    is with at most ``max_errors`` of the bits differing over the overlap, which is at
    least ``min_overlap`` of the shorter. ``best_query``: the class of those with the least
    share (ties: the least id), ``best_offset`` frames later in it.

    A query probes with all keys of all its codes. The index holds every class.
    Recordings without codes have a null class and no links. Null ids take part but are no
    queries; a class of them alone has a null ``class_id`` and isn't indexed. Repeated rows
    are in one class. An empty table gives no rows.
    """
    prints = materialize(prints, "fingerprints")
    full = prints.where(F.col("digest").isNotNull())
    is_query = F.when(F.col("rec_id") % query_step == 0, F.lit(1)).otherwise(0)
    classes = full.groupBy("digest").agg(F.min("rec_id").alias("class_id"), F.max(is_query).alias("is_query"), F.max("codes").alias("codes"))
    classes = materialize(classes, "classes")
    indexed = classes.where(F.col("class_id").isNotNull())
    keyed = lambda df, name, at, code: df.select(F.col("class_id").alias(name), F.posexplode("codes").alias(at, code)).select("*", F.explode(_keys(F.col(code))).alias("key"))
    postings = keyed(indexed, "class_id", "at", "code")
    queries = keyed(indexed.where("is_query = 1"), "query", "query_at", "query_code")
    hits = queries.join(postings, "key").where((F.col("query") != F.col("class_id")) & _first_key(F.col("query_code"), F.col("code"), F.col("key")))
    histogram = hits.groupBy("query", "class_id", (F.col("query_at") - F.col("at")).alias("offset")).agg(F.count("*").alias("n"))
    peak = histogram.groupBy("query", "class_id").agg(F.max_by("offset", F.struct("n", -F.abs("offset"), "offset")).alias("offset"))
    a = indexed.select(F.col("class_id").alias("query"), F.col("codes").alias("q"))
    b = indexed.select("class_id", F.col("codes").alias("r"))
    pairs = peak.join(a, "query").join(b, "class_id")
    # q[i + offset] lies over r[i].
    first = F.greatest(F.lit(0), -F.col("offset"))
    overlap = F.least(F.size("r"), F.size("q") - F.col("offset")) - first
    pairs = pairs.withColumn("first", first).withColumn("overlap", overlap).where(F.col("overlap") >= F.greatest(F.lit(1.0), F.lit(min_overlap) * F.least(F.size("q"), F.size("r"))))
    differ = F.zip_with(F.slice("q", F.col("first") + F.col("offset") + 1, F.col("overlap")), F.slice("r", F.col("first") + 1, F.col("overlap")), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    errors = F.aggregate(differ, F.lit(0), lambda s, x: s + x) / (32 * F.col("overlap"))
    linked = pairs.select("class_id", "query", "offset", errors.alias("errors")).where(F.col("errors") <= max_errors)
    best = F.min(F.struct("errors", "query", "offset")).alias("best")
    links = linked.groupBy("class_id").agg(F.count("*").alias("n_links"), best)
    by_class = classes.join(links, "class_id", "left").select("digest", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "best")
    rows = prints.select("rec_id", F.size("codes").cast("long").alias("n_codes"), "digest", F.coalesce("digest", F.concat(F.lit("-"), F.coalesce(F.col("rec_id").cast("string"), F.lit("")))).alias("class_key"))
    out = rows.join(by_class.withColumnRenamed("digest", "class_key"), "class_key", "left")
    return out.select(
        "rec_id",
        "n_codes",
        "digest",
        "class_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("best.query").alias("best_query"),
        F.col("best.offset").cast("long").alias("best_offset"),
        F.col("best.errors").alias("bit_errors"),
    )
