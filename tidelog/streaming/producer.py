"""A writing data source that counts what a broker has acknowledged, ``tidelog_producer``.

Each partition has one producer (``module``: one with the usual ``Producer``, by default
``confluent_kafka``; settings from the options ``kafka.*``). Messages are handed over
without waiting; a callback tells of each whether it was delivered. A message that was not
is sent again, up to ``attempts`` times; then, or if answers stay out, the task fails and
Spark runs it again. A partition's commit message carries what was acknowledged and what
failed on the way, so the sums are of answers, not of what was handed over.

Messages that are sent again come after those that were under way with them. A client that
must keep the order of a key through failures has a setting for it (``kafka.enable.idempotence``).

``report`` names a folder on the driver's machine, where the driver's side of a batch leaves
its sums as ``<batchId>.json``: Spark commits a write in a process of its own.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Seconds in which a broker answers.
ANSWER_S = 30.0
#: Messages between two looks at the answers.
POLLED = 500


class DeliveryFailed(RuntimeError):
    """Messages that no attempt has delivered."""


@dataclass
class Delivered(WriterCommitMessage):
    """What became of the messages of one partition."""

    acknowledged: int = 0
    failed: int = 0


class Delivery:
    """Messages of one partition on their way through one producer."""

    def __init__(self, producer, attempts: int):
        self.producer, self.attempts = producer, attempts
        self.counts = Delivered()
        self.again: list[tuple[tuple, int]] = []
        self.lost: list[tuple[tuple, object]] = []

    def _told(self, message: tuple, attempt: int, error, _delivered=None) -> None:
        if error is None:
            self.counts.acknowledged += 1
            return
        self.counts.failed += 1
        if attempt < self.attempts:
            self.again.append((message, attempt + 1))
        else:
            self.lost.append((message, error))

    def send(self, message: tuple, attempt: int = 1) -> None:
        topic, key, value = message
        while True:
            try:
                return self.producer.produce(topic, value=value, key=key, on_delivery=partial(self._told, message, attempt))
            except BufferError:  # its queue is full: wait for answers, drop nothing
                self.producer.poll(0.1)

    def run(self, messages: Iterable[tuple]) -> Delivered:
        for n, message in enumerate(messages):
            self.send(message)
            if n % POLLED == 0:
                self.producer.poll(0)
        while True:
            unanswered = self.producer.flush(ANSWER_S)
            if unanswered:
                raise DeliveryFailed(f"{unanswered} messages were not answered in {ANSWER_S:g} s")
            if self.lost:
                (topic, key, _), error = self.lost[0]
                raise DeliveryFailed(f"{len(self.lost)} messages were not delivered in {self.attempts} attempts, the first to {topic} with key {key!r}: {error}")
            if not self.again:
                return self.counts
            again, self.again = self.again, []
            for message, attempt in again:
                self.send(message, attempt)


def messages_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        topic, key, value = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("topic", "key", "value"))
        yield from zip(topic, key, value)


class _Writer:
    def __init__(self, options, schema: StructType):
        missing = {"topic", "key", "value"} - set(schema.names)
        if missing:
            raise ValueError(f"messages have no {', '.join(sorted(missing))}")
        self.module, self.attempts = options.get("module", "confluent_kafka"), int(options.get("attempts", 3))
        self.settings = {k.removeprefix("kafka."): v for k, v in options.items() if k.startswith("kafka.")}
        self.report, self.batch = options.get("report"), options.get("batchid", "0")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivered:
        return Delivery(importlib.import_module(self.module).Producer(self.settings), self.attempts).run(messages_of(iterator))

    def _leave(self, messages: list, batch: str, aborted: bool) -> None:
        told = [m for m in messages if m is not None]
        found = {"acknowledged": sum(m.acknowledged for m in told), "failed": sum(m.failed for m in told), "partitions": len(told), "aborted": aborted}
        if self.report:
            path = os.path.join(self.report, f"{batch}.json")
            with open(f"{path}.part", "w") as f:
                json.dump(found, f)
            os.replace(f"{path}.part", path)


class BatchProducer(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._leave(messages, self.batch, False)

    def abort(self, messages: list) -> None:
        self._leave(messages, self.batch, True)


class StreamProducer(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._leave(messages, str(batchId), False)

    def abort(self, messages: list, batchId: int) -> None:
        self._leave(messages, str(batchId), True)


class ProducerSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog_producer"

    def writer(self, schema: StructType, overwrite: bool) -> BatchProducer:
        return BatchProducer(self.options, schema)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamProducer:
        return StreamProducer(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ProducerSink)


def read_report(folder: str, batch_id: int) -> dict | None:
    """The sums of a batch, if it was written."""
    path = os.path.join(folder, f"{batch_id}.json")
    if not os.path.exists(path):
        return None
    with open(path) as f:
        return json.load(f)
