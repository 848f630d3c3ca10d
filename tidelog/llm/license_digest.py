"""Licence scans by canonical digest: equal after canonicalisation means equal licence.

A text is canonicalised (case, copyright lines, equivalent spellings, punctuation, white
space) and the digest of what is left is looked up among the digests of known licences
(:data:`KNOWN` here, and whole texts by digest in ``license_texts``).
The whole text is one unit, and so is each of its lines, for one-line notices. DataFrame
functions only; the known table has a checked size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import DIGESTS

#: Spellings that licence matching takes as equal, after lower-casing.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("all rights reserved", ""),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: Known texts. Whole licences, and the one-line notices that stand for one.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

#: A known table of at most this many rows (under 100 bytes each) goes to all tasks; a larger one is joined by shuffle.
BROADCAST_ROWS = 50_000

#: A copyright line, and what stands between words. A line that begins with
#: "copyright" counts if a mark, a year or "by" follows; so wrapped prose does not.
_LEAD, _MARK, _YEAR = r"[ \t*#/;-]*", r"(?:\(c\)|\x{00A9})", r"(?:19|20)[0-9]{2}"
_OPENING = rf"(?:copyright[ \t:,]*(?:{_MARK}|{_YEAR}|[<\[{{(]?(?:year|yyyy|19yy|19xx)|by[ \t])|{_MARK}[ \t]*(?:copyright|{_YEAR}))"
NOTICE = rf"(?:^|\n){_LEAD}{_OPENING}[^\n]*(?:\n{_LEAD}{_MARK}[^\n]*)*"
PUNCTUATION = r"[\x{0000}-\x{002F}\x{003A}-\x{0040}\x{005B}-\x{0060}\x{007B}-\x{00BF}\x{2000}-\x{206F}]+"


def canonical(text: Column) -> Column:
    """The canonical form: words of letters and digits, one blank between them.

    Copyright lines, with the marked lines that follow them, are left out before lines are
    joined; of one that is itself wrapped the first line goes. Apart from that the form
    doesn't depend on where lines break.
    """
    out = F.lower(text)
    out = F.regexp_replace(out, "\r\n?", "\n")
    out = F.regexp_replace(out, NOTICE, "\n")
    out = F.regexp_replace(out, "https?://", " ")
    out = F.regexp_replace(out, "&", " and ")
    out = F.concat(F.lit("  "), F.regexp_replace(out, PUNCTUATION, "  "), F.lit("  "))
    for old, new in EQUIVALENT:  # two blanks between words, so that neighbours can both match
        out = F.replace(out, F.lit(_spaced(old)), F.lit(_spaced(new)))
    return F.trim(F.regexp_replace(out, " +", " "))


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def digest(text: Column) -> Column:
    """Digest of the canonical form; null where nothing is left of the text.

    The form is bound to a lambda's variable, so that it is made once a text.
    """
    hashed = F.transform(F.array(canonical(text)), lambda form: F.when(F.length(form) > 0, F.sha2(form.cast("binary"), 256)))
    return F.element_at(hashed, 1)


def _marker(form: Column) -> Column:
    """The longest word of a canonical form that every spelling of it has as it stands."""
    made = {w for _, new in EQUIVALENT for w in new.split(" ")} | {"and"}
    words = F.filter(F.split(form, " "), lambda w: ~w.isin(*made))
    return F.element_at(F.array_sort(F.transform(words, lambda w: F.struct(-F.length(w), w.alias("word")))), 1)["word"]


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, texts: tuple[tuple[str, str, str], ...] = DIGESTS) -> DataFrame:
    """``digest, license_id, marker`` of known texts; equal texts of two licences go to the lesser name.

    ``texts``: further ones by ``license_id, digest, marker``. ``marker`` is a word that all
    spellings of the text have; null if there is none.
    """
    table = spark.createDataFrame([(a, b) for a, b in known], "license_id string, text string")
    rows = table.select(digest(F.col("text")).alias("digest"), "license_id", _marker(canonical(F.col("text"))).alias("marker")).where(F.col("digest").isNotNull())
    more = spark.createDataFrame(list(texts), "license_id string, digest string, marker string").select("digest", "license_id", "marker")
    return rows.unionByName(more).groupBy("digest").agg(F.min("license_id").alias("license_id"), F.min("marker").alias("marker"))


def scan(docs: DataFrame, known: DataFrame, *, longest_line: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, digest, license_id, n_notices, notices``.

    ``license_id``: the licence whose whole text this is. ``notices``: sorted licence names
    of the lines that are a known text; ``n_notices`` counts such lines. Only lines with a
    ``marker`` of ``known`` can be one, so the others aren't looked up; all are if a marker
    is missing or the table is too large for all tasks. Lines have any length unless
    ``longest_line`` is given. Null, empty and punctuation-only texts have a null digest.
    Null ids and repeated rows are kept as rows. An empty known table matches nothing.
    Other columns aren't read.
    """
    small = known.count() <= BROADCAST_ROWS
    markers = [r.marker for r in known.select("marker").distinct().collect()] if small and "marker" in known.columns else [None]
    can_match = lambda x: F.lit(True) if None in markers else F.lower(x).rlike("|".join(sorted(markers))) if markers else F.lit(False)
    short = lambda x: F.lit(True) if longest_line is None else F.length(x) <= longest_line
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: short(x) & can_match(x))
    unit = lambda whole, x: F.struct(F.lit(whole).alias("whole"), digest(x).alias("digest"))
    units = rows.select("row_id", "doc_id", F.explode(F.concat(F.array(unit(True, F.col("text"))), F.transform(lines, lambda x: unit(False, x)))).alias("unit"))
    # Units without a digest get a key of their own, so that they don't meet in one task.
    units = units.select("row_id", "doc_id", "unit.*", F.coalesce("unit.digest", F.col("row_id").cast("string")).alias("key"))
    names = known.select(F.col("digest").alias("key"), "license_id")
    if small:
        names = F.broadcast(names)
    notice = F.when(~F.col("whole"), F.col("license_id"))
    return (
        units.join(names, "key", "left")
        .groupBy("row_id")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
            F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
            F.count(notice).alias("n_notices"),
            F.array_sort(F.collect_set(notice)).alias("notices"),
        )
        .drop("row_id")
    )
