"""``python -m tidelog --source slot|segments --sink kafka|producer|parquet --state FOLDER [--path FOLDER] [--once] [--metrics-port N]``

Settings come from ``WAL_WRITER_*``. Runs until it is told to end (SIGTERM or SIGINT: a
micro-batch that is being sent is finished and kept) or, with ``--once``, until what was
there at the start has been sent. Ends with status 1 after an error. Without Spark's
offsets in ``--state`` it starts at the stored position. ``--metrics-port`` serves counters
and probes.
"""

from __future__ import annotations

import argparse
import signal
import sys
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .config import AppConfig
from .schema import DEFAULT_POSITION
from .session import ship_package
from .sources import replication, slot
from .sources.checkpoint import CheckpointStore, position_number
from .streaming.monitor import Monitor
from .streaming.pipeline import Pipeline
from .streaming.sink import Sink, kafka_sink, parquet_sink, producer_sink


def chunks_of(spark: SparkSession, config: AppConfig, source: str, path: str | None, driver: str, start: str = DEFAULT_POSITION, once: bool = False) -> DataFrame:
    """The stream of chunks, after a position: a live slot, or recorded segments in a folder."""
    options = {} if start == DEFAULT_POSITION else {"startingPosition": slot.position_text(position_number(start))}
    if source == "segments":
        replication.register(spark)
        return spark.readStream.format("tidelog_chunks").options(path=path, **options).load()
    slot.register(spark)
    dsn = config.postgres.connection_string()
    options |= {"dsn": dsn, "slot": config.postgres.slot, "driver": driver, "publication": config.postgres.slot}
    if once:
        options["endingPosition"] = slot.current_position(driver, dsn)
    return spark.readStream.format("tidelog_slot").options(**options).load()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, config: AppConfig | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidelog")
    parser.add_argument("--source", choices=["slot", "segments"], default="slot")
    parser.add_argument("--sink", choices=["kafka", "producer", "parquet"], default="kafka")
    parser.add_argument("--path", help="folder of the segments")
    parser.add_argument("--out", help="folder of the Parquet sink")
    parser.add_argument("--state", required=True, help="folder of Spark's offsets, shared by all machines")
    parser.add_argument("--driver", default="psycopg", help="database driver of the slot")
    parser.add_argument("--module", default="confluent_kafka", help="client library of the producer sink")
    parser.add_argument("--metrics-port", type=int, help="port of counters and probes")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args(argv)
    config = config or AppConfig.from_env()
    log = config.logging.start()
    log.info("starting: database %s, brokers %s", config.postgres.host, config.kafka.brokers)
    spark = spark or SparkSession.builder.appName("tidelog").getOrCreate()
    ship_package(spark)
    sink: Sink = {"kafka": lambda: kafka_sink(config.kafka), "producer": lambda: producer_sink(config.kafka, args.module), "parquet": lambda: parquet_sink(args.out)}[args.sink]()
    monitor, told = Monitor(), threading.Event()
    store = CheckpointStore(config.state.state_dir, spark).open()
    pipeline = Pipeline(config, sink, store, monitor=monitor, from_position=False)

    def end(*_) -> None:
        pipeline.stopping.set()
        told.set()

    before = {s: signal.signal(s, end) for s in (signal.SIGTERM, signal.SIGINT)} if threading.current_thread() is threading.main_thread() else {}
    server = monitor.serve(args.metrics_port) if args.metrics_port is not None else None
    try:
        start = config.replication.wal_position or store.start(config.postgres.slot)
        chunks = chunks_of(spark, config, args.source, args.path, args.driver, start, args.once)
        if args.once:
            pipeline.drain(chunks, args.state)
        else:
            query = pipeline.start(chunks, args.state)
            while query.isActive and not told.wait(0.1):
                pass
            if not told.is_set():
                query.awaitTermination()  # raises what ended it
            log.info("stopping")
            pipeline.stop(query)
    except Exception:
        if not told.is_set():
            log.exception("the stream failed")
            return 1
    finally:
        if server:
            server.shutdown()
        for s, handler in before.items():
            signal.signal(s, handler)
    log.info("ended: %s", monitor.values)
    return 0


if __name__ == "__main__":
    sys.exit(main())
