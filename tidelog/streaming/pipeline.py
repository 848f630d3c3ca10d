"""The stream: chunks to messages, with a position after each micro-batch that was sent."""

from __future__ import annotations

import logging
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import AppConfig
from ..functions.binary import lsn_value
from ..operators.batching import with_batches
from ..operators.metrics import observe_chunks, observe_parsed
from ..operators.parse import parse_chunks, records
from ..operators.route import route
from ..session import discard
from ..sources.checkpoint import CheckpointStore
from .batches import STATE_STORE, stream_batches
from .monitor import Monitor
from .sink import Sink

log = logging.getLogger(__name__)

MESSAGE = ("batch", "seq", "idx", "topic", "key", "value")


class Stopping(RuntimeError):
    """Nothing more is taken in; what was not sent will be after the next start."""


class Pipeline:
    """Parses, routes and sends chunks, and keeps positions and counters (``totals``).

    Records join batches of ``replication.batch_size`` by arrival, all of a chunk in one
    batch, in the column ``batch`` of the messages. A live stream hands a batch on once it is
    closed, by its size or by silence (:mod:`.batches`), however many micro-batches that
    takes. A bounded run (``available_now``, ``drain``) may take in any number of
    chunks at once: there the end of a micro-batch closes the last batch, and ranges
    number the others (:mod:`~tidelog.operators.batching`).

    Delivery is at least once: the position moves, and a batch counts, only after the sink
    has taken all of it. A live stream writes it every ``state.persist_interval_secs``
    (Spark's own offsets are kept with every micro-batch), and when it is stopped. A failed send is counted and fails the query, after Spark has tried
    its tasks again; a query that is started again replays from Spark's own offsets. A
    sink that knows what was acknowledged returns the sums, which then count instead of the
    rows. Sources start at a stored position by themselves; a stream of another kind leaves
    out records up to ``replication.wal_position``.
    """

    def __init__(self, config: AppConfig, sink: Sink, store: CheckpointStore | None = None, quarantine: Sink | None = None, monitor: Monitor | None = None, *, from_position: bool = True):
        self.config, self.sink, self.quarantine, self.from_position = config, sink, quarantine, from_position
        self.store = store or CheckpointStore(config.state.state_dir).load()
        self.totals = monitor or Monitor()
        self.batches_before, self.listening = 0, False
        self.keep_every_s, self.kept_at = 0, float("-inf")
        self.running, self.stopping, self.last_done = threading.Lock(), threading.Event(), -1

    def rows(self, chunks: DataFrame) -> DataFrame:
        """Messages and errors of a stream of chunks, before batches; no shuffle."""
        parsed = observe_parsed(parse_chunks(observe_chunks(chunks), outcomes=True, voided=True))
        if self.from_position and self.config.replication.wal_position:
            parsed = parsed.where(F.col("operation").isNull() | (F.col("lsn") > lsn_value(F.lit(self.config.replication.wal_position))))
        about = ("table_schema", "table_name", "operation", "tx_commit_time", "lsn", "error", "chunk")
        routed = route(parsed, self.config.kafka.topic_prefix, *about)
        is_record = F.col("operation").isNotNull()
        return routed.select("seq", F.when(is_record, F.col("idx")).alias("idx"), *about, *[F.when(is_record, F.col(c)).alias(c) for c in ("topic", "key", "value")])

    def process(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch of :meth:`rows`, with or without a ``batch``."""
        with self.running:
            if self.stopping.is_set():
                raise Stopping
            self._process(rows, batch_id)
            self.last_done = batch_id

    def _process(self, rows: DataFrame, batch_id: int) -> None:
        rows, numbered = rows.persist(), None
        try:
            tables = rows.groupBy("table_schema", "table_name", F.col("error").isNotNull().alias("bad")).agg(
                F.count("operation").alias("n"), F.count("error").alias("errors"), F.max("tx_commit_time").alias("commit"), F.max(F.struct("seq", "idx", "lsn")).alias("last"),
                *[F.count_if(F.col("operation") == o).alias(f"{o.lower()}_count") for o in ("Insert", "Update", "Delete")],
                *([F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch")] if "batch" in rows.columns else []),
            ).collect()
            sent = [t for t in tables if t["n"]]
            n = sum(t["n"] for t in sent)
            if n:
                messages = records(rows)
                if "batch" in rows.columns:
                    batches = max(t["last_batch"] for t in sent) - min(t["first_batch"] for t in sent) + 1
                else:
                    numbered = with_batches(messages, self.config.replication.batch_size)
                    messages = numbered.withColumn("batch", F.col("batch_id") + self.batches_before).persist()
                    batches = messages.agg(F.max("batch_id")).first()[0] + 1
                try:
                    self._send(messages.select(*MESSAGE), batch_id, n)
                finally:
                    if numbered is not None:
                        messages.unpersist()
            if self.quarantine and any(t["errors"] for t in tables):
                self.quarantine(rows.where("error IS NOT NULL").select("seq", "error", "chunk"), batch_id)
        finally:
            rows.unpersist()
            if numbered is not None:
                discard(numbered)
        if n:
            self._sent(sent, batches, batch_id)

    def _sent(self, tables: list, batches: int, batch_id: int) -> None:
        """Counters and the position, after the sink has taken everything."""
        self.totals.add(batches_sent=batches)
        self.batches_before += batches
        for t in tables:
            self.totals.add_table(t["table_schema"], t["table_name"], t["commit"], **{k: t[k] for k in ("insert_count", "update_count", "delete_count")})
        last = self.totals.last_lsn = int(max(t["last"] for t in tables)["lsn"])
        due = time.monotonic() - self.kept_at >= self.keep_every_s
        self.store.persist(self.config.postgres.slot, f"{last >> 32}/{last & 0xFFFFFFFF}", write=due)
        self.kept_at = time.monotonic() if due else self.kept_at
        log.info("micro-batch %d: %d records in %d batches sent, position %s", batch_id, sum(t["n"] for t in tables), batches, self.store.get(self.config.postgres.slot))

    def _send(self, messages: DataFrame, batch_id: int, n: int) -> None:
        try:
            told = self.sink(messages, batch_id)
        except Exception:
            self.totals.add(send_errors=1)
            log.exception("micro-batch %d was not sent", batch_id)
            raise
        self.totals.add(messages_sent=told["acknowledged"] if told else n, send_errors=told["failed"] if told else 0)

    def _started(self, rows: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start a query that the monitor hears of, under a name of its own."""
        if not self.listening:
            rows.sparkSession.streams.addListener(self.totals)
            self.listening = True
        self.totals.query_name = f"tidelog-{uuid.uuid4().hex}"
        writer = rows.writeStream.queryName(self.totals.query_name).foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def _deaf(self, spark: SparkSession) -> None:
        if self.listening:
            spark.streams.removeListener(self.totals)
            self.listening = False

    def start(self, chunks: DataFrame, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
        """Run on a stream of chunks; ``available_now`` ends after what is there, with its positions kept."""
        spark, replication = chunks.sparkSession, self.config.replication
        if available_now:
            return self._started(self.rows(chunks), checkpoint, availableNow=True)
        self.keep_every_s = self.config.state.persist_interval_secs
        for name, value in STATE_STORE.items():
            spark.conf.set(name, value)
        closed = stream_batches(self.rows(chunks), replication.batch_size, replication.poll_interval_ms, slot=self.config.postgres.slot)
        return self._started(closed, checkpoint, processingTime=f"{replication.poll_interval_ms} milliseconds")

    def drain(self, chunks: DataFrame, checkpoint: str) -> None:
        """Send all that is there now, in micro-batches as the source limits them, and end."""
        query = self._started(self.rows(chunks), checkpoint)
        try:
            query.processAllAvailable()
            self.counted()
        finally:
            query.stop()
            self._deaf(chunks.sparkSession)

    def counted(self, timeout: float = 10.0) -> None:
        """Wait until the listener has heard of the last micro-batch that was sent."""
        until = time.monotonic() + timeout
        while self.last_done >= 0 and self.last_done not in self.totals.seen and time.monotonic() < until:
            time.sleep(0.02)

    def stop(self, query: StreamingQuery, timeout: float = 30.0) -> None:
        """Take nothing more in, let a micro-batch that is being sent end and be committed, then stop the query."""
        self.stopping.set()
        with self.running:
            done = self.last_done
        until = time.monotonic() + timeout
        while query.isActive and done >= 0 and time.monotonic() < until:
            progress = query.lastProgress
            if progress and progress.batchId >= done:
                break
            time.sleep(0.02)
        query.stop()
        self.store.flush()
        self.counted(2.0)
        self._deaf(SparkSession.active())
