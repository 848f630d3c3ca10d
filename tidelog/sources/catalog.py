"""Replication slots in the catalogue of the source database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PostgresConfig
from ..schema import DEFAULT_SLOT


def jdbc_slots(spark: SparkSession, config: PostgresConfig) -> DataFrame:
    """The slots of a live server (its JDBC driver must be on the class path)."""
    return spark.read.format("jdbc").options(**config.jdbc()).option("dbtable", "pg_catalog.pg_replication_slots").load()


def slot_exists(slots: DataFrame, slot: str = DEFAULT_SLOT) -> DataFrame:
    """One row ``slot_exists``; the name is a bound parameter."""
    return slots.sparkSession.sql("SELECT EXISTS(SELECT 1 FROM {slots} WHERE slot_name = :slot) AS slot_exists", args={"slot": slot}, slots=slots)


def has_slot(slots: DataFrame, slot: str = DEFAULT_SLOT) -> bool:
    """Whether the slot is there; false for an answer without a row."""
    row = slot_exists(slots, slot).first()
    return bool(row and row[0])


def known_slots(wanted: DataFrame, slots: DataFrame) -> DataFrame:
    """Those of many wanted slots (``slot_name``) that exist."""
    return wanted.join(slots.select("slot_name"), "slot_name", "left_semi")


def single_consumer(queries: DataFrame) -> DataFrame:
    """Slots named by more than one consumer (``slot_name``): a slot allows one."""
    return queries.groupBy("slot_name").agg(F.count("*").alias("consumers")).where(F.col("consumers") > 1)
