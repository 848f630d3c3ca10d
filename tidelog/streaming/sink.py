"""Sinks for messages: Parquet by topic, memory, Kafka, and a producer that counts acknowledgements."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KafkaConfig
from ..operators.route import ordered_by_key
from . import producer

#: What a sink returns: nothing, or how many messages were ``acknowledged``, and how many deliveries ``failed`` on the way.
Sink = Callable[[DataFrame, int], Mapping[str, int] | None]


def parquet_sink(path: str) -> Sink:
    """A folder per micro-batch, partitioned by topic. Written over on replay, so a batch counts once."""

    def write(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{path}/batch_id={batch_id}")

    return write


def memory_sink(into: list) -> Sink:
    """Rows of each micro-batch on the driver; for tests."""

    def write(messages: DataFrame, batch_id: int) -> None:
        into.append((batch_id, messages.orderBy("seq", "idx").collect()))

    return write


def kafka_frame(messages: DataFrame) -> DataFrame:
    """What a Kafka sink is given: ``topic``, and ``key`` and ``value`` as bytes, in order of arrival for each key."""
    return ordered_by_key(messages).select("topic", F.col("key").cast("binary"), F.col("value").cast("binary"))


def kafka_sink(config: KafkaConfig, format_name: str = "kafka") -> Sink:
    """Kafka, at least once (its connector must be on the class path). Each row goes to its own topic; a failed send fails the task."""

    def write(messages: DataFrame, batch_id: int) -> None:
        kafka_frame(messages).write.format(format_name).options(**config.options()).mode("append").save()

    return write


def producer_sink(config: KafkaConfig, module: str = "confluent_kafka", attempts: int = 3) -> Sink:
    """Kafka through a producer in each task (its client library must be on all machines); counts what was acknowledged."""
    report = tempfile.mkdtemp(prefix="tidelog-report-")  # between two processes of the driver

    def write(messages: DataFrame, batch_id: int) -> dict[str, int] | None:
        producer.register(messages.sparkSession)
        options = config.producer() | {"module": module, "attempts": str(attempts), "report": report, "batchId": str(batch_id)}
        kafka_frame(messages).write.format("tidelog_producer").options(**options).mode("append").save()
        return producer.read_report(report, batch_id)

    return write
