"""Counters of a pipeline and of its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def chunk_counters() -> list[Column]:
    return [F.count("*").alias("chunks_received"), F.coalesce(F.sum(F.octet_length("chunk").cast("long")), F.lit(0)).alias("bytes_received")]


def parsed_counters() -> list[Column]:
    """Records parsed, chunks in error, and the position of the last record by arrival."""
    good = F.col("operation").isNotNull()
    return [
        F.count_if(good).alias("records_parsed"),
        F.count_if(F.col("error").isNotNull()).alias("parse_errors"),
        F.max_by(F.when(good, F.col("lsn")), F.when(good, F.struct("seq", "idx"))).alias("last_lsn"),
    ]


def observe_chunks(chunks: DataFrame, observation: Observation | str = "chunks") -> DataFrame:
    """The same rows; the counters are known when an action on them ends, at no extra pass."""
    return chunks.observe(observation, *chunk_counters())


def observe_parsed(parsed: DataFrame, observation: Observation | str = "parsed") -> DataFrame:
    return parsed.observe(observation, *parsed_counters())


def table_metrics(records: DataFrame) -> DataFrame:
    """Inserts, updates and deletes of each table (there is no counter for truncations)."""
    count = lambda name: F.count_if(F.col("operation") == name).alias(f"{name.lower()}_count")
    return records.groupBy("table_schema", "table_name").agg(count("Insert"), count("Update"), count("Delete"))


def table_lag(records: DataFrame, now_ms: Column, commit_ms: Column) -> DataFrame:
    """Milliseconds between a time and the last commit of each table."""
    return records.groupBy("table_schema", "table_name").agg((now_ms - F.max(commit_ms)).alias("lag_ms"))
