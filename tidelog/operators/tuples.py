"""Tuple bytes to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binary import latin1
from ..schema import ROW_DATA


def decode_tuple(data: Column, type_oids: Column) -> Column:
    """Columns of a tuple, for its list of type ids (a struct of ``columns``).

    Columns are read in order. ``N`` is a null of one byte; any other flag takes all bytes
    that remain, so later columns are null, as are those past the end. Type ids are
    carried, not interpreted, and names are empty. A null tuple is one without bytes.
    """
    raw = F.coalesce(data, F.unhex(F.lit("")))
    nulls = F.length(F.regexp_extract(latin1(raw), "^(N*)", 1))
    value = F.substring(raw, nulls + 2, F.octet_length(raw))
    column = lambda oid, i: F.struct(
        F.lit("").alias("name"),
        oid.cast("long").alias("type_oid"),
        F.when((i == nulls) & (nulls < F.octet_length(raw)), value).alias("value"),
        ((i != nulls) | (nulls >= F.octet_length(raw))).alias("is_null"),
    )
    return F.struct(F.transform(type_oids, column).alias("columns")).cast(ROW_DATA)


def json_value(value: Column) -> Column:
    """Bytes as the array of numbers that JSON payloads hold."""
    hex_text = F.hex(value)
    at = F.sequence(F.lit(0), F.octet_length(value) - 1)
    numbers = F.transform(at, lambda i: F.conv(F.substring(hex_text, 2 * i + 1, F.lit(2)), 16, 10).cast("int"))
    return F.when(F.octet_length(value) > 0, numbers).when(value.isNotNull(), F.array().cast("array<int>"))
