"""Records to messages: topic, key, payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RECORD_FIELDS
from .tuples import json_value


def topic(prefix: str, schema: Column, table: Column) -> Column:
    """``prefix.schema.table``. Names with dots make it ambiguous, as they are not checked."""
    return F.concat_ws(".", F.lit(prefix), schema, table)


def key(xid: Column) -> Column:
    """The transaction id in decimal."""
    return xid.cast("string")


def payload(records: DataFrame) -> Column:
    """JSON of the whole record, nulls included, in the order of its fields.

    Values of tuples are bytes, or variants (:mod:`~tidelog.functions.values`).
    """

    def field(name: str) -> Column:
        if name not in ("new_tuple", "old_tuple"):
            return F.col(name)
        is_bytes = isinstance(records.schema[name].dataType["columns"].dataType.elementType["value"].dataType, T.BinaryType)
        value_of = json_value if is_bytes else lambda value: value
        column = lambda c: F.struct(c["name"].alias("name"), c["type_oid"].alias("type_oid"), value_of(c["value"]).alias("value"), c["is_null"].alias("is_null"))
        value = F.when(F.col(name).isNotNull(), F.struct(F.transform(F.col(name)["columns"], column).alias("columns")))
        return value.alias(name)

    return F.to_json(F.struct(*[field(c) for c in RECORD_FIELDS]), {"ignoreNullFields": "false"})


def route(records: DataFrame, prefix: str = "cdc", *more: str) -> DataFrame:
    """``topic, key, value`` and the place ``seq, idx`` of each record, and ``more`` columns. A projection: no shuffle."""
    return records.select(
        *more,
        "seq",
        "idx",
        topic(prefix, F.col("table_schema"), F.col("table_name")).alias("topic"),
        key(F.col("tx_xid")).alias("key"),
        payload(records).alias("value"),
    )


def writer_of(writers: int) -> Column:
    """The writer of a message: a stable hash of its topic and key, so a key stays with its writer from batch to batch."""
    return F.pmod(F.xxhash64("topic", "key"), F.lit(writers)).cast("int")


def ordered_by_key(messages: DataFrame, writers: int | None = None) -> DataFrame:
    """Messages of one topic and key together and in order of arrival, as sinks that keep order by key need them.

    There are ``writers`` partitions (as many as the session shuffles into, without it). A
    busy topic is dealt by its keys, so it isn't one task, and a key is in the partition of
    the same number in every batch.
    """
    n = writers or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return messages.repartitionById(n, writer_of(n)).sortWithinPartitions("topic", "seq", "idx")


def group_counts(records: DataFrame, *more: str) -> DataFrame:
    """Number of records of each table."""
    return records.groupBy(*more, "table_schema", "table_name").agg(F.count("*").alias("n"))


def group_lists(records: DataFrame, *more: str) -> DataFrame:
    """Records of each table as lists in order of arrival. A list is one row: only for bounded batches."""
    row = F.struct("seq", "idx", *[c for c in RECORD_FIELDS if c not in ("table_schema", "table_name")])
    return records.groupBy(*more, "table_schema", "table_name").agg(F.sort_array(F.collect_list(row)).alias("records"))
