"""Table functions, so that SQL can call the parser and the tuple decoder.

    SELECT * FROM parse_chunks(TABLE(chunks))
    SELECT * FROM parse_chunks(TABLE(SELECT slot, seq, chunk FROM chunks) PARTITION BY slot ORDER BY seq)
    SELECT * FROM decode_tuples(TABLE(SELECT seq, data, oids FROM tuples))

Their results follow from the tables that they are given: columns other than those they
read go along. ``register`` makes them known to a session.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators.parse import record_frames
from ..schema import PARSED


def _asked(table: AnalyzeArgument, function: str, **wanted: T.DataType) -> list[T.StructField]:
    """The columns of a table argument; those that a function reads must be there and of their type."""
    if not table.isTable:
        raise ValueError(f"{function} takes a table: {function}(TABLE(...))")
    kinds = {f.name: f.dataType for f in table.dataType.fields}
    for name, kind in wanted.items():
        if kinds.get(name) != kind:
            raise ValueError(f"{function} needs a column {name} of type {kind.simpleString()}, not {kinds[name].simpleString() if name in kinds else 'none'}")
    return table.dataType.fields


def _clear(fields: list[T.StructField], added: T.StructType, function: str) -> None:
    twice = {f.name for f in fields} & set(added.names)
    if twice:
        raise ValueError(f"{function} makes columns that the table has as well: {', '.join(sorted(twice))}")


#: What a chunk's row is replaced by: a record or an error each.
FOUND = T.StructType([f for f in PARSED.fields if f.name not in ("seq", "new_tuple", "old_tuple")])
#: What a tuple's row is replaced by: a column each.
COLUMNS = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("type_oid", T.LongType()), T.StructField("value", T.BinaryType()), T.StructField("is_null", T.BooleanType())])


class ParseChunks:
    """``chunk`` of each row to records and errors."""

    @staticmethod
    def analyze(chunks: AnalyzeArgument) -> AnalyzeResult:
        fields = _asked(chunks, "parse_chunks", chunk=T.BinaryType())
        kept = [f for f in fields if f.name != "chunk"]
        _clear(kept, FOUND, "parse_chunks")
        return AnalyzeResult(T.StructType(kept + FOUND.fields))

    def eval(self, row: Row) -> Iterator[tuple]:
        kept = tuple(row[name] for name in row.__fields__ if name != "chunk")
        found, error = record_frames(bytes(row["chunk"] or b""))
        for idx, f in enumerate(found):
            yield (*kept, idx, *f, None)
        if error:
            yield (*kept, 0, *[None] * 7, error)


class DecodeTuples:
    """``data`` of each row to its columns, by the type ids in ``oids``."""

    @staticmethod
    def analyze(tuples: AnalyzeArgument) -> AnalyzeResult:
        fields = _asked(tuples, "decode_tuples", data=T.BinaryType(), oids=T.ArrayType(T.LongType(), True))
        kept = [f for f in fields if f.name not in ("data", "oids")]
        _clear(kept, COLUMNS, "decode_tuples")
        return AnalyzeResult(T.StructType(kept + COLUMNS.fields))

    def eval(self, row: Row) -> Iterator[tuple]:
        kept = tuple(row[name] for name in row.__fields__ if name not in ("data", "oids"))
        data = bytes(row["data"] or b"")
        nulls = len(data) - len(data.lstrip(b"N"))
        for pos, oid in enumerate(row["oids"] or []):
            here = pos == nulls < len(data)
            yield (*kept, pos, oid, data[nulls + 1 :] if here else None, not here)


def register(spark: SparkSession) -> None:
    spark.udtf.register("parse_chunks", udtf(ParseChunks))
    spark.udtf.register("decode_tuples", udtf(DecodeTuples))
