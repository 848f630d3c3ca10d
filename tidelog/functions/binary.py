"""Scalar functions on bytes, positions and configuration text. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import OPERATIONS, U64

NUL = "decode(X'00', 'ISO-8859-1')"


def unsigned_be(data: Column, at: Column | int, width: int) -> Column:
    """Unsigned big-endian integer of ``width`` bytes from byte ``at`` (first: 1), as text of digits."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.substring(data, at, F.lit(width))), 16, 10)


def u64_be(data: Column, at: Column | int) -> Column:
    return unsigned_be(data, at, 8).cast(U64)


def i64_be(data: Column, at: Column | int) -> Column:
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.substring(data, at, F.lit(8))), 16, -10).cast("long")


def u32_be(data: Column, at: Column | int) -> Column:
    return unsigned_be(data, at, 4).cast("long")


def latin1(data: Column) -> Column:
    """One character for each byte, so that character positions are byte positions."""
    return F.decode(data, "ISO-8859-1")


def terminator(text: Column, start: Column | int) -> Column:
    """Position of the first zero byte at or after ``start`` (first: 1), else 0."""
    start = F.lit(start) if isinstance(start, int) else start
    return F.call_function("locate", F.expr(NUL), text, start)


def lossy_utf8(data: Column) -> Column:
    """Text of bytes; each malformed part becomes U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def code_of(chunk: Column) -> Column:
    """The frame code: the first byte as a character."""
    return latin1(F.substring(chunk, 1, 1))


def operation(code: Column) -> Column:
    """Name of the operation; null for codes that emit nothing."""
    out = F.when(code == "I", OPERATIONS["I"])
    for c in "UDT":
        out = out.when(code == c, OPERATIONS[c])
    return out


def operation_label(name: Column) -> Column:
    """Display form of an operation."""
    return F.upper(name)


def lsn_text(lsn: Column) -> Column:
    """Position as two decimal halves, ``hi/lo`` (for unsigned 64-bit values)."""
    return F.concat_ws("/", *[x.cast("string") for x in _halves(lsn)])


def lsn_hex(lsn: Column) -> Column:
    """Position as PostgreSQL writes it: two hexadecimal halves."""
    hi, lo = _halves(lsn)
    return F.concat_ws("/", F.hex(hi), F.hex(lo))


def lsn_value(text: Column) -> Column:
    """Number of a ``hi/lo`` text of decimal halves; null if it is none."""
    good = text.rlike("^[0-9]{1,10}/[0-9]{1,10}$")
    hi, lo = (F.split_part(text, F.lit("/"), F.lit(i)).try_cast("decimal(20,0)") for i in (1, 2))
    return F.when(good, hi * F.lit(4294967296).cast("decimal(10,0)") + lo).cast(U64)


def _halves(lsn: Column) -> tuple[Column, Column]:
    two32 = F.lit(4294967296).cast(U64)
    wide = lsn.cast(U64)
    hi = F.call_function("div", wide, two32).cast("long")
    return hi, F.pmod(wide, two32).cast("long")


def number_or(text: Column, default: Column, bits: int) -> Column:
    """Unsigned number of so many bits, else the default (a null text included)."""
    value = F.when(text.rlike(r"^\+?[0-9]{1,20}$"), F.regexp_replace(text, r"^\+", "").try_cast("decimal(20,0)"))
    return F.coalesce(F.when(value < F.lit(str(1 << bits)).cast("decimal(20,0)"), value), default.cast("decimal(20,0)"))
