"""Near duplicates by HyperMinHash: compressed registers, bands, estimate, exact check.

1. One pass over the texts: each becomes its set of word shingles (64-bit hashes), a
   128-bit digest of the set, and registers. A shingle's hash names its bucket; of the
   least hash of each bucket the register keeps the number of leading zeros and the
   mantissa bits after them (16 bits in all).
2. Equal sets (equal digests) become one class, summed up before the shuffle, so groups
   of copies of any size are one row from here on.
3. Bands of registers are hashed; classes that share a band are candidates. They are
   tried in rounds, and what a round links is one component in the next. First each class
   meets one other: of the least classes of its bands that with which it shares most
   bands. Then every two components that meet in a band try the pair, of members drawn by
   hash, that shares most bands. What is left are bands that still hold different
   components. Of their members only such pairs are made that have a common shingle early
   enough in order of use (sets that can't share enough have none). Of these the pair with
   most such shingles is tried for every two components, and then all that still lie in
   different ones. So a group of near copies is not paired with itself. The bands of a
   short set are copies of few draws and may all miss: every set of fewer shingles than
   there are buckets, with all others of a size that can be linked to one, takes part in
   this last step whether it shares a band or not.
4. The estimate corrects for registers that agree by chance, and lets through all that
   lies within five standard errors of the threshold. The check joins full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, tidy
from .components import components

MANTISSA = 10
VALUE_BITS = 48
EMPTY = 0xFFFF
#: Ids at and above this stand for classes in which all ids are null.
NO_ID = 1 << 62

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of murmur hash 3)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Sets of word shingles as sorted arrays of 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width

    def shingles(self, text: str) -> np.ndarray:
        """Distinct shingles of ``width`` words; of fewer words, all as one; of none, nothing.

        Only A-Z are lower-cased; words end at blank, tab, line feed, vertical tab, form
        feed and carriage return, as bytes.split does.
        """
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, "u8")
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        acc = np.full(n, np.uint64(width))
        with np.errstate(over="ignore"):
            for k in range(width):
                acc = acc * _MUL + h[k : k + n]
                acc ^= acc >> np.uint64(29)
            return np.unique(_finish(acc))


def registers(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """HyperMinHash registers (leading zeros, then mantissa) of a sorted set of hashes."""
    out = np.full(buckets, EMPTY, "u2")
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(VALUE_BITS)) * np.uint64(buckets) >> np.uint64(64 - VALUE_BITS)
    value = hashes & np.uint64((1 << VALUE_BITS) - 1)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    least = np.minimum.reduceat(value, starts)
    length = np.frexp(least.astype("f8"))[1]  # bits of the value; exact, as values have under 53
    zeros = VALUE_BITS - length
    mantissa = np.where(length > 0, (least << np.minimum(zeros + 1, VALUE_BITS).astype("u8")) & np.uint64((1 << VALUE_BITS) - 1), 0) >> np.uint64(VALUE_BITS - MANTISSA)
    out[bucket[starts].astype("i8")] = (zeros.astype("u2") << np.uint16(MANTISSA)) | mantissa.astype("u2")
    return out


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """Hash of each band of each signature.

    An empty bucket takes the register of the next one that isn't, together with its
    number, and bands are made of buckets from all over, not of neighbours. So a band of a
    short text rests on as many draws as one of a long text, and agrees as rarely by chance.
    """
    n, buckets = sig.shape
    full = sig != EMPTY
    at = np.where(full, np.arange(buckets), 2 * buckets)
    following = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
    first = at.min(axis=1, keepdims=True)
    source = np.where(following < buckets, following, first)
    taken = np.take_along_axis(sig, np.minimum(source, buckets - 1), axis=1).astype("u8") | source.astype("u8") << np.uint64(16)
    order = np.argsort(_finish(np.arange(1, buckets + 1, dtype="u8") * _MUL), kind="stable")
    parts = taken[:, order].reshape(n, buckets // rows, rows)
    acc = np.broadcast_to(np.arange(1, buckets // rows + 1, dtype="u8"), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            acc = acc * _MUL + parts[:, :, k]
            acc ^= acc >> np.uint64(31)
        return _finish(acc)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of pairs of signatures, and the registers it rests on.

    Two different least hashes of a bucket agree in their register with a chance that
    follows from the densities of both minima and the width of each register cell.
    """
    filled = (a != EMPTY) | (b != EMPTY)
    base = np.maximum(1, filled.sum(axis=1))
    agree = ((a == b) & filled).sum(axis=1)
    buckets = a.shape[1]
    ra, rb = size_a / buckets, size_b / buckets
    total, chance = ra + rb, np.zeros(len(a))
    for level in range(40):
        hi, lo = 2.0**-level, 2.0 ** -(level + 1)
        chance += (np.exp(-total * lo) - np.exp(-total * hi)) * 2.0 ** -(MANTISSA + level + 1)
    chance *= ra * rb / np.maximum(total, 1e-12)
    chance = np.minimum(chance, 0.5)
    return np.clip((agree - base * chance) / (base * (1 - chance)), 0, 1), base


def signatures(docs: DataFrame, *, shingle_words: int, buckets: int) -> DataFrame:
    """``doc_id, n_shingles, digest, sig`` of each row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle_words)
        for batch in batches:
            sizes, digests, sigs = [], [], []
            for text in batch.column(1):
                found = shingler.shingles(text.as_py() or "")
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sigs.append(registers(found, buckets).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])

    return docs.mapInArrow(tidy(run), "doc_id long, n_shingles long, digest binary, sig binary")


def _surrogate(digest: str = "digest"):
    """A class number for classes without an id."""
    return F.lit(NO_ID) + F.pmod(F.xxhash64(digest), F.lit(NO_ID))


def _bands(classes: DataFrame, buckets: int, rows: int) -> DataFrame:
    """``band, class_id, n`` for every band of every class; ``n`` is the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                some = batch.slice(part, 1000)
                sig = np.frombuffer(b"".join(some.column(2).to_pylist()), "u2").reshape(some.num_rows, buckets)
                found = band_hashes(sig, rows)
                row = pa.array(np.repeat(np.arange(some.num_rows), found.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view("i8")), some.column(0).take(row), some.column(1).take(row)], ["band", "class_id", "n"])

    return classes.select("class_id", F.col("n_shingles").cast("int").alias("n"), "sig").mapInArrow(tidy(run), "band long, class_id long, n int")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float, errors: float) -> DataFrame:
    """Pairs whose estimate is not below the threshold by more than ``errors`` standard errors."""
    side = lambda x: classes.select(F.col("class_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u2").reshape(n, -1) for c in ("sig_a", "sig_b"))
            value, base = estimate(a, b, *(batch.column(c).to_numpy().astype("f8") for c in ("n_a", "n_b")))
            keep = pa.array(value >= threshold - errors * np.sqrt(threshold * (1 - threshold) / base))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    return joined.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(tidy(run), "a long, b long")


FILTER_BITS = 1 << 26


def _may_contain(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id may be in ``ids``: all that are, and few others.

    The bits of the ids' hashes, of a fixed size of 8 MB at most, go to all tasks, so the
    texts of other documents aren't shuffled for the exact join that follows.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1
    return docs.withColumn("chunk", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "chunk").where(is_set).select(*docs.columns)


def _sets(docs: DataFrame, ids: DataFrame, shingle_words: int) -> DataFrame:
    """Full shingle sets of the classes in ``ids(class_id)``, made again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle_words)
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                some = batch.slice(part, 1000)
                sets = [shingler.shingles(t.as_py() or "").view("i8") for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], ["class_id", "shingles"])

    # An inner join (the ids are distinct): a semi-join would be moved before the filter.
    wanted = ids.select(F.col("class_id").alias("doc_id"))
    chosen = _may_contain(docs, wanted).join(wanted, "doc_id")
    return chosen.mapInArrow(tidy(run), "class_id long, shingles array<long>")


def _able(na: Column, left_a: Column, nb: Column, left_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be linked that have a shingle in common with so many left after it."""
    # Shared s of a union na + nb - s: s * (100 + percent) >= percent * (na + nb).
    return ((1 + F.least(left_a, left_b)) * (100 + percent) >= percent * (na + nb)) & (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)


def _partner_sizes(early: DataFrame, percent: int) -> DataFrame:
    """``shingle, na, nb, most_left``: sizes of sets that can be linked through a shingle, with the most that a set of size ``nb`` has left after it.

    What sets share is bounded by their sizes and places alone, so sizes are compared before
    members are: a template just under the threshold, met by any number of texts, has no row.
    """
    sizes = early.groupBy("shingle", "n").agg(F.max("left").alias("left"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    x = sizes.select("shingle", *[F.col(c).alias(f"{c}a") for c in ("n", "left", "lo", "hi")])
    y = sizes.select("shingle", *[F.col(c).alias(f"{c}b") for c in ("n", "left", "lo", "hi")])
    several = F.least("loa", "lob") != F.greatest("hia", "hib")
    met = x.join(y, "shingle").where(several & _able(F.col("na"), F.col("lefta"), F.col("nb"), F.col("leftb"), percent))
    return met.select("shingle", "na", "nb", F.col("leftb").alias("most_left"))


def _meetings(early: DataFrame, percent: int) -> DataFrame:
    """Members ``a, b`` of different components ``ca, cb`` that meet early at a shingle and can be linked through it."""
    side = lambda x: early.select("shingle", F.col("class_id").alias(x), *[F.col(c).alias(f"{c}{x}") for c in ("n", "left")], F.col("component").alias(f"c{x}"), "most")
    # Of two components one at least isn't the one met most; of two such one order is enough.
    once = (F.col("cb") == F.col("most")) | (F.col("a") > F.col("b"))
    able = lambda left_b: _able(F.col("na"), F.col("lefta"), F.col("nb"), left_b, percent)
    asked = side("a").where(F.col("ca") != F.col("most")).join(_partner_sizes(early, percent), ["shingle", "na"]).where(able(F.col("most_left"))).drop("most_left")
    return asked.join(side("b").drop("most"), ["shingle", "nb"]).where((F.col("ca") != F.col("cb")) & once & able(F.col("leftb")))


def _able_pairs(docs: DataFrame, members: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """Pairs ``a > b`` of ``members(class_id, n, component)`` in different components ``ca, cb`` that may be linked.

    In order of use among all members, two sets that share enough have a common shingle so
    early in both that enough is left after it; ``k`` counts these. Shingles of one member
    alone come first and are never common, so a set that has many of its own meets nothing.
    Of the members that come early with a shingle, those of the component met most there
    meet the others only.
    """
    sets = _sets(docs, members.select("class_id").distinct(), shingle_words).select("class_id", F.explode("shingles").alias("shingle"))
    uses = sets.groupBy("shingle").agg(F.count("*").alias("uses")).where(F.col("uses") > 1)
    family = Window.partitionBy("class_id")
    at = F.row_number().over(family.orderBy("uses", "shingle")) + F.col("n") - F.count("*").over(family)
    placed = sets.join(uses, "shingle").join(members, "class_id").withColumn("at", at)
    early = placed.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("shingle", "class_id", "n", "component", "at")
    early = materialize(early, "early")
    met = early.groupBy("shingle", "component").agg(F.count("*").alias("k"))
    met = met.groupBy("shingle").agg(F.max_by("component", F.struct("k", "component")).alias("most"), F.count("*").alias("k")).where(F.col("k") > 1).select("shingle", "most")
    early = early.join(met, "shingle").withColumn("left", F.col("n") - F.col("at"))
    pairs = _meetings(early, percent)
    swap = F.col("a") < F.col("b")
    of = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x)
    return pairs.select(of("a", "b"), of("b", "a"), of("ca", "cb"), of("cb", "ca")).groupBy("a", "b", "ca", "cb").agg(F.count("*").alias("k"))


def _verified(pairs: DataFrame, docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` per cent of their union."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    sets = materialize(_sets(docs, materialize(ids, "ids"), shingle_words), "sets")
    left = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a").cast("long") + F.size("of_b") - shared
    out = materialize(both.where(100 * shared >= percent * union).select("a", "b").distinct(), "links")
    discard(sets)
    return out


def _lifted(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (node, component) after further links between nodes."""
    of = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    lifted = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joint = components(lifted, "lifted")
    known = found.unionByName(joint.select("node", F.col("node").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
    renamed = joint.select(F.col("node").alias("component"), F.col("component").alias("new"))
    return known.join(renamed, "component", "left").select("node", F.coalesce("new", "component").alias("component"))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = 5,
    percent: int = 80,
    buckets: int = 240,
    rows: int = 6,
    errors: float = 5.0,
    draws: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Texts are linked if their shingle sets share at least ``percent`` per cent of their
    union; a component's id is the least ``doc_id`` in it. Pairs with a set of fewer than
    ``buckets`` shingles are candidates by their shingles, none is missed. Of longer ones,
    were all 40 bands of 6 registers drawn apart, a pair at 80 per cent would be missed as a
    candidate with a chance of 5e-6, one at 85 per cent of 6e-9; sets just above that share
    draws among bands (simulated at 80 per cent: no miss in 20,000 pairs with a union of 240,
    300 and 500 each, so under 1.5e-4 at 95 per cent confidence). A candidate is lost if its
    estimate is over ``errors`` standard errors low. A component is only split if all its
    links across are missed.

    Null, empty and white-space texts have no shingles and are linked with nothing: their
    component is their own id. Rows that share an id count as one document. Rows without
    an id take part; their component id is null if nothing in it has an id, and they are
    kept only then if ``doc_id`` and ``component_id`` are both null. Other columns aren't
    read. An empty table gives no rows. Ids lie under 2 ** 62.
    """
    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    threshold = percent / 100
    all_rows = materialize(signatures(rows_in, shingle_words=shingle_words, buckets=buckets), "signatures")
    full = all_rows.where(F.col("n_shingles") > 0)
    classes = materialize(
        full.groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.max(F.struct("n_shingles", "sig")).alias("s"))
        .select("digest", F.coalesce("least", _surrogate()).alias("class_id"), "s.n_shingles", "s.sig"),
        "classes",
    )
    # Texts by class id: a row without an id goes by its digest.
    named = rows_in.where(F.col("doc_id").isNotNull())
    nameless = rows_in.where(F.col("doc_id").isNull())
    if not nameless.isEmpty():
        width = shingle_words

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler = Shingler(width)
            for batch in batches:
                found = [shingler.shingles(t.as_py() or "") for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found], pa.binary()), batch.column(1)], ["digest", "text"])

        by_digest = nameless.mapInArrow(digest, "digest binary, text string")
        named = named.unionByName(by_digest.select(_surrogate().alias("doc_id"), "text"))

    bands = _bands(classes, buckets, rows)
    least = F.min(F.struct("class_id", "n"))
    first = bands.groupBy("band").agg(least.alias("hub"), F.count("*").alias("members")).where(F.col("members") > 1)
    shared = materialize(bands.join(first.select("band", F.col("hub.class_id").alias("hub"), F.col("hub.n").alias("hub_n")), "band"), "bands")
    near = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent  # noqa: E731  sizes that allow a link
    # Each class meets the hub with which it shares most bands.
    stars = shared.where((F.col("class_id") != F.col("hub")) & near("n", "hub_n")).groupBy(F.col("class_id").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("k"))
    stars = stars.groupBy("a").agg(F.max_by("b", F.struct("k", -F.col("b"))).alias("b"))
    stars = materialize(_likely(stars, classes, threshold, errors), "stars")
    links = _verified(stars, named, shingle_words, percent)
    found = materialize(components(links, "links1"), "components")

    def open_bands(found: DataFrame) -> DataFrame:
        """Members of bands that hold classes of different components."""
        labelled = shared.join(found.withColumnRenamed("node", "class_id"), "class_id", "left").select("band", "class_id", "n", "hub", F.coalesce("component", "class_id").alias("component"))
        mixed = labelled.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") != F.col("hi")).select("band")
        return materialize(labelled.join(mixed, "band"), "open")

    def joined_by(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """Components after the links among ``pairs``."""
        likely = materialize(_likely(pairs, classes, threshold, errors), "likely")
        more = _verified(likely, named, shingle_words, percent)
        if not more.isEmpty():
            found = materialize(_lifted(found, more), "components")
        discard(likely, more)
        return found

    def first_pairs(pairs: DataFrame) -> DataFrame:
        """The most promising pair ``a, b`` (the largest ``k``) of every two components ``ca, cb``."""
        family = pairs.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y"))
        return family.agg(F.max_by(F.struct("a", "b"), F.struct("k", "a", "b")).alias("p")).select("p.a", "p.b")

    # Components meet in bands that hold several: one pair of every two, of members drawn by hash.
    left = open_bands(found)
    drawn = [F.min(F.struct(F.xxhash64("class_id", F.lit(k)).alias("h"), "class_id", "component", "n")).alias(f"d{k}") for k in range(draws)]
    some = left.groupBy("band").agg(*drawn).select("band", F.explode(F.array_distinct(F.array(*[F.col(f"d{k}").dropFields("h") for k in range(draws)]))).alias("d"))
    some = left.join(some, "band").where((F.col("component") != F.col("d.component")) & near("n", "d.n"))
    some = some.groupBy("class_id", "component", F.col("d.class_id").alias("d"), F.col("d.component").alias("other")).agg(F.count("*").alias("k"))
    best = first_pairs(some.select(F.greatest("class_id", "d").alias("a"), F.least("class_id", "d").alias("b"), F.col("component").alias("ca"), F.col("other").alias("cb"), "k"))
    found = joined_by(best, found)
    discard(left)

    # Last, the pairs of members still in different components that can be linked at all.
    left = open_bands(found)
    # Short sets meet all sets that they can be linked to, without a common band too.
    brief = classes.where(F.col("n_shingles") * percent < buckets * 100).join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    brief = brief.select("class_id", F.col("n_shingles").cast("int").alias("n"), F.coalesce("component", "class_id").alias("component"))
    members = left.select("class_id", "n", "component").unionByName(brief).distinct()
    across = materialize(_able_pairs(named, materialize(members, "members"), shingle_words, percent), "across")
    # Of two components the most promising pair first, then all pairs of those that it doesn't link.
    best = materialize(first_pairs(across), "best")
    found = materialize(joined_by(best, found), "components")
    now = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"now_{x}"))
    rest = across.join(best, ["a", "b"], "left_anti").join(now("a"), "a", "left").join(now("b"), "b", "left")
    rest = rest.where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b")
    found = joined_by(rest, found)
    discard(shared, left, stars, links, across, best)

    labels = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left").select("digest", F.coalesce("component", "class_id").alias("component"))
    out = full.select("doc_id", "n_shingles", "digest").join(labels, "digest")
    component = F.when(F.col("component") < NO_ID, F.col("component"))
    result = out.select("doc_id", "n_shingles", component.alias("component_id"))
    alone = all_rows.where(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.unionByName(alone).select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
