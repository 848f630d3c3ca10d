"""Typed column values as variants, and records back from messages.

A value in a message is bare: nothing tells its kind but its form. Reading takes the first
kind that fits, in the order String, Integer (64 bits, signed), Float, Boolean, Json; so
bytes, which are written as an array of numbers, come back as Json, and so does nothing
else: a null is no value at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tuples import json_value
from ..schema import U64

#: A tuple whose values are variants.
TYPED_COLUMN = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("type_oid", T.LongType()), T.StructField("value", T.VariantType()), T.StructField("is_null", T.BooleanType()),
])
TYPED_ROW = T.StructType([T.StructField("columns", T.ArrayType(TYPED_COLUMN))])

#: A record as its message has it.
MESSAGE_RECORD = T.StructType([
    T.StructField("lsn", U64), T.StructField("table_schema", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("operation", T.StringType()), T.StructField("oid", T.LongType()),
    T.StructField("new_tuple", TYPED_ROW), T.StructField("old_tuple", TYPED_ROW), T.StructField("tx_commit_time", T.LongType()), T.StructField("tx_xid", U64),
])


#: Schemas of variants that are numbers with a point, or beyond 64 bits.
_FLOAT = "^(DECIMAL|DOUBLE|FLOAT)"


def text_value(value: Column) -> Column:
    return value.cast("string").cast("variant")


def integer_value(value: Column) -> Column:
    return value.cast("long").cast("variant")


def float_value(value: Column) -> Column:
    """A double; what JSON can't express (not a number, infinite) is null."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number).cast("variant")


def boolean_value(value: Column) -> Column:
    return value.cast("boolean").cast("variant")


def json_text_value(value: Column) -> Column:
    """A JSON text; a text that is none is an error."""
    return F.parse_json(value)


def bytes_value(value: Column) -> Column:
    """Bytes, as the numbers that a message has for them."""
    return json_value(value).cast("variant")


def typed_column(name: Column, type_oid: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), type_oid.cast("long").alias("type_oid"), value.alias("value"), value.isNull().alias("is_null"))


def kind_of(value: Column) -> Column:
    """The first kind that fits a value read from a message; null without a value. Whole numbers with a point, or beyond 64 bits, are Float."""
    form = F.schema_of_variant(value)
    return (
        F.when(form.isNull() | (form == "VOID"), F.lit(None).cast("string"))
        .when(form == "STRING", "String")
        .when(form.rlike("^(TINYINT|SMALLINT|INT|BIGINT)$"), "Integer")
        .when(form.rlike(_FLOAT), "Float")
        .when(form == "BOOLEAN", "Boolean")
        .otherwise("Json")
    )


def _read(value: Column) -> Column:
    number = F.try_variant_get(value, "$", "double").cast("variant")
    return F.when(~F.is_variant_null(value), F.when(F.schema_of_variant(value).rlike(_FLOAT), number).otherwise(value))


def read_message(value: Column) -> Column:
    """The record of a message (:data:`MESSAGE_RECORD`); a text that is no record is an error.

    A value of null in a message is no value, as a null column has none. Values are of their
    :func:`kind_of`, so that a message made from the record again is the same.
    """
    columns = lambda row: F.when(
        row.isNotNull(),
        F.struct(F.transform(row["columns"], lambda c: F.struct(c["name"].alias("name"), c["type_oid"].alias("type_oid"), _read(c["value"]).alias("value"), c["is_null"].alias("is_null"))).alias("columns")),
    )
    fields = lambda record: F.struct(*[(columns(record[f]) if f in ("new_tuple", "old_tuple") else record[f]).alias(f) for f in MESSAGE_RECORD.names])
    # A variable of a function, so that the text is parsed once and not for each use of a field.
    return F.get(F.transform(F.array(F.from_json(value, MESSAGE_RECORD, {"mode": "FAILFAST"})), fields), F.lit(0))
