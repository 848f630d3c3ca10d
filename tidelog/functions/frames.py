"""Encoder of frames, for fixtures and replay."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def u64_bytes(value: Column) -> Column:
    """Eight big-endian bytes of a long."""
    return F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))


def u32_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("long")), 8, "0"))


def frame(code: Column, lsn: Column, xid: Column, commit_time: Column, schema: Column, table: Column, *tail: Column) -> Column:
    """One frame: code, header, two terminated names, and whatever follows."""
    zero = F.unhex(F.lit("00"))
    text = lambda c: F.encode(c, "UTF-8")
    return F.concat(text(code), u64_bytes(lsn), u64_bytes(xid), u64_bytes(commit_time), text(schema), zero, text(table), zero, *tail)


def frame_bytes(code: str, lsn: int, xid: int, commit_time: int, schema: str, table: str, oid: int | None = None, tail: bytes = b"") -> bytes:
    """The same for plain values."""
    head = code.encode() + struct.pack(">QQq", lsn, xid, commit_time) + schema.encode() + b"\0" + table.encode() + b"\0"
    return head + (b"" if oid is None else struct.pack(">I", oid)) + tail


def event_fields(events: DataFrame) -> DataFrame:
    """Frame fields of an event table: one change for each event, in order of its id."""
    i = F.col("event_id")
    return events.select(
        i.alias("seq"),
        F.substring(F.lit("IUDTW"), (i % 5 + 1).cast("int"), F.lit(1)).alias("msg"),
        (i * 16777216 + 24).alias("lsn"),
        F.expr("event_id div 10").alias("xid"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ct"),
        F.lit("public").alias("table_schema"),
        F.col("event_type").alias("table_name"),
        (16384 + F.length("event_type")).cast("long").alias("oid"),
    )


def event_chunks(events: DataFrame) -> DataFrame:
    """``seq, msg, chunk``: one chunk per event, with its object id and one byte after it."""
    f = event_fields(events)
    head = [F.col(c) for c in ("msg", "lsn", "xid", "ct", "table_schema", "table_name")]
    chunk = frame(*head, u32_bytes(F.col("oid")), F.encode(F.lit("x"), "UTF-8"))
    # Through a generator of one row, so that the bytes are made once, as if they had been read.
    return f.select("seq", F.inline(F.array(F.struct(F.col("msg"), chunk.alias("chunk")))))
