"""Schemas and fixed defaults of the change-data-capture engine."""

from pyspark.sql import types as T

#: Unsigned 64-bit positions and transaction ids don't fit a long.
U64 = T.DecimalType(20, 0)

CHUNK = T.StructType([T.StructField("seq", T.LongType()), T.StructField("chunk", T.BinaryType())])

COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type_oid", T.LongType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("is_null", T.BooleanType()),
    ]
)
ROW_DATA = T.StructType([T.StructField("columns", T.ArrayType(COLUMN))])

#: Fields of a change record, in the order of its JSON.
RECORD_FIELDS = ("lsn", "table_schema", "table_name", "operation", "oid", "new_tuple", "old_tuple", "tx_commit_time", "tx_xid")

PARSED = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("lsn", U64),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("oid", T.LongType()),
        T.StructField("new_tuple", ROW_DATA),
        T.StructField("old_tuple", ROW_DATA),
        T.StructField("tx_commit_time", T.LongType()),
        T.StructField("tx_xid", U64),
        T.StructField("error", T.StringType()),
    ]
)

CHECKPOINT = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("last_lsn", T.StringType()), T.StructField("last_commit_time", T.LongType())]),
)

#: Frame codes and what they stand for.
OPERATIONS = {"I": "Insert", "U": "Update", "D": "Delete", "T": "Truncate"}
RECORD_CODES = ("W", "I", "U", "D", "T")
SKIP_CODE, SKIP_BYTES = "B", 5
HEADER_BYTES, LEAST_BYTES = 25, 4

DEFAULT_SLOT = "wal_writer_slot"
DEFAULT_POSITION = "0/0"
BATCH_SIZE = 100

SHORT_FRAME = "short_frame"
NO_TERMINATOR = "missing_terminator"
