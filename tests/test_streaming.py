"""Batches with timers, acknowledgements, pushed filters, live counters, and the end by a signal."""

import json
import os
import re
import signal
import subprocess
import sys
import time
import urllib.request
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelog.config import AppConfig, KafkaConfig, ReplicationConfig, StateConfig
from tidelog.functions.frames import event_chunks, frame_bytes
from tidelog.operators.parse import parse_chunks, records
from tidelog.plans.queries import pipeline_metrics, table_lag_query, table_metrics_query
from tidelog.sources import replication
from tidelog.sources.checkpoint import CheckpointStore
from tidelog.sources.replication import ChunkReader, Segment, record_positions, write_segment
from tidelog.streaming import monitor as monitor_module
from tidelog.streaming.batches import STATE_STORE, stream_batches
from tidelog.streaming.monitor import Monitor
from tidelog.streaming.pipeline import Pipeline
from tidelog.streaming.producer import Delivery, DeliveryFailed
from tidelog.streaming.sink import memory_sink, producer_sink

ROWS = "seq long, idx int, error string"


class Batches:
    """A stream of rows that arrive when they are put."""

    def __init__(self, spark, tmp_path, size, idle_ms):
        self.spark, self.base, self.out, self.n = spark, str(tmp_path), [], 0
        for name, value in STATE_STORE.items():
            spark.conf.set(name, value)
        self.put([])
        rows = stream_batches(spark.readStream.schema(ROWS).parquet(f"{self.base}/in-*"), size, idle_ms)
        self.query = rows.writeStream.foreachBatch(self._take).option("checkpointLocation", f"{self.base}/check").start()

    def _take(self, df, batch_id):
        self.out += [(r.batch, r.seq, r.idx) for r in df.collect()]

    def put(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{self.base}/in-{self.n}")

    def wait(self, done, seconds=40):
        until = time.monotonic() + seconds
        while not done() and time.monotonic() < until:
            assert self.query.isActive, self.query.exception()
            time.sleep(0.05)
        assert done(), self.out

    def taken(self):
        return sum(p.numInputRows for p in self.query.recentProgress)


def _chunk(seq, n):
    return [(seq, i, None) for i in range(n)] or [(seq, None, None)]


def test_steady_chunks_postpone_the_flush_and_silence_brings_it(spark, tmp_path):
    b = Batches(spark, tmp_path, 100, 6000)
    try:
        b.put(_chunk(0, 3))
        b.wait(lambda: b.taken() == 3)
        began = time.monotonic()
        for seq in range(1, 9):  # longer in all than the idle time; every other chunk is without records
            time.sleep(1.2)
            b.put(_chunk(seq, seq % 2))
        b.wait(lambda: b.taken() == 11)
        assert time.monotonic() - began > 6 and b.out == []
        b.wait(lambda: b.out)
        assert sorted(b.out) == [(0, 0, 0), (0, 0, 1), (0, 0, 2), (0, 1, 0), (0, 3, 0), (0, 5, 0), (0, 7, 0)]
    finally:
        b.query.stop()


def test_batches_over_micro_batches_take_whole_chunks(spark, tmp_path):
    """The golden counts 60, 60, 10, 100, 1, a chunk in each micro-batch; an error goes on at once."""
    b = Batches(spark, tmp_path, 100, 600_000)
    try:
        total = 0
        for seq, n in enumerate([60, 60, 10, 100, 1]):
            b.put(list(reversed(_chunk(seq, n))) + ([(50, 0, "short_frame")] if seq == 2 else []))
            total += n + (seq == 2)
            b.wait(lambda: b.taken() == total)  # noqa: B023
        assert sorted({(x[0], x[1]) for x in b.out if x[0] is not None}) == [(0, 0), (0, 1), (1, 2), (1, 3)]
        assert [x for x in b.out if x[0] is None] == [(None, 50, 0)] and len(b.out) == 231
        assert [x[1:] for x in b.out if x[0] == 0] == [(s, i) for s in (0, 1) for i in range(60)]
    finally:
        b.query.stop()


def _messages(spark, values):
    return spark.createDataFrame([("t", f"k{i % 5}", v, i, 0) for i, v in enumerate(values)], "topic string, key string, value string, seq long, idx int")


def _delivered(folder):
    return sorted(json.loads(line)[2] for p in Path(folder).glob("*.delivered") for line in p.read_text().splitlines())


def test_acknowledged_and_failed_deliveries_are_counted(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    values = [f"v{i};" + (f"fail={1 + i % 2};" if i % 10 == 3 else "") for i in range(300)]
    config = KafkaConfig(brokers=str(tmp_path), compression="lz4")
    try:
        told = producer_sink(config, "tests.fake_broker", attempts=3)(_messages(spark, values), 7)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    fails = sum(1 + i % 2 for i in range(300) if i % 10 == 3)
    assert told == {"acknowledged": 300, "failed": fails, "partitions": told["partitions"], "aborted": False} and told["partitions"] > 1
    assert _delivered(tmp_path) == sorted(values)
    settings = [json.loads(p.read_text()) for p in tmp_path.glob("*.settings")]
    assert settings[0] == {k.removeprefix("kafka."): v for k, v in config.producer().items()} and settings[0]["acks"] == "all"


def test_a_lost_message_fails_the_write(spark, tmp_path):
    with pytest.raises(Exception, match="not delivered in 2 attempts"):
        producer_sink(KafkaConfig(brokers=str(tmp_path)), "tests.fake_broker", attempts=2)(_messages(spark, ["a", "b;fail=99;"]), 1)
    with pytest.raises(DeliveryFailed, match="not answered"):
        from tests.fake_broker import Producer

        Delivery(Producer({"bootstrap.servers": str(tmp_path)}), 3).run([("t", b"k", b"mute")])


def test_a_pipeline_counts_what_was_acknowledged(spark, tmp_path):
    replication.register(spark)
    chunks = [frame_bytes("I", i, i, i, "public", "fail=1;" if i % 7 == 0 else "t") for i in range(50)]
    write_segment(str(tmp_path / "slot"), 0, chunks)
    (tmp_path / "broker").mkdir()
    pipeline = Pipeline(AppConfig(), producer_sink(KafkaConfig(brokers=str(tmp_path / "broker")), "tests.fake_broker"))
    pipeline.drain(spark.readStream.format("tidelog_chunks").option("path", str(tmp_path / "slot")).load(), str(tmp_path / "check"))
    assert (pipeline.totals.values["messages_sent"], pipeline.totals.values["send_errors"]) == (50, 8)
    assert len(_delivered(tmp_path / "broker")) == 50


def test_the_stream_writer_reports_each_micro_batch(spark, tmp_path):
    from tidelog.streaming import producer

    producer.register(spark)
    (tmp_path / "report").mkdir()
    _messages(spark, ["a", "b", "c"]).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("topic string, key string, value string").parquet(str(tmp_path / "in")).select("topic", F.col("key").cast("binary"), F.col("value").cast("binary"))
    options = {"kafka.bootstrap.servers": str(tmp_path), "module": "tests.fake_broker", "report": str(tmp_path / "report"), "checkpointLocation": str(tmp_path / "check")}
    query = stream.writeStream.format("tidelog_producer").options(**options).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert query.exception() is None and _delivered(tmp_path) == ["a", "b", "c"]
    assert producer.read_report(str(tmp_path / "report"), 0) == {"acknowledged": 3, "failed": 0, "partitions": 1, "aborted": False}
    assert producer.read_report(str(tmp_path / "report"), 1) is None


def _segments(folder):
    for k in range(5):
        write_segment(str(folder), 10 * k, [frame_bytes("IUDW"[i % 4], 100 + i, i, i, "public", "t") for i in range(10 * k, 10 * k + 10)])
    write_segment(str(folder), 50, [b"", b"B1234"])  # without a record
    return sorted(Path(folder).iterdir())


def test_filters_reach_the_names_of_segments(spark, tmp_path):
    replication.register(spark)
    paths = _segments(tmp_path)
    read = lambda **o: spark.read.format("tidelog_chunks").options(path=str(tmp_path), **o).load()
    assert read().count() == 52
    for path in (paths[0], paths[1], paths[4]):  # opening one of these would fail
        path.write_bytes(b"\0\0\0\7abc")
    assert sorted(r.seq for r in read().where("seq >= 25 AND seq < 33").collect()) == list(range(25, 33))
    assert sorted(r.seq for r in read().where("seq = 20").collect()) == [20]
    assert [r.seq for r in read().where("seq > 49").collect()] == [50, 51]
    (paths[4]).write_bytes(paths[3].read_bytes())
    got = read(positions="true").where(F.col("last_position") > Decimal(134)).collect()
    assert {r.seq for r in got if r.seq < 40} == {36, 37, 38} and all(r.last_position > 134 for r in got)  # 35 and 39 have no record
    with pytest.raises(Exception, match="ends inside a chunk"):
        read().collect()


def test_segments_by_name(tmp_path):
    paths = _segments(tmp_path)
    found = [Segment.of(str(tmp_path), p.name) for p in paths]
    assert [(s.first, s.count, s.least, s.largest) for s in found] == [(0, 10, 100, 109), (10, 10, 110, 118), (20, 10, 120, 129), (30, 10, 130, 138), (40, 10, 140, 149), (50, 2, None, None)]
    assert record_positions(b"I" + b"\1" * 30) == [] and record_positions(b"") == []
    reader = ChunkReader({"path": str(tmp_path), "startseq": "3"}, True)
    assert [p.path for p in reader.partitions()] == list(map(str, paths))


@pytest.mark.parametrize("position,first", [(0, 0), (100, 1), (115, 16), (119, 20), (134, 35), (1000, 52)])
def test_start_after_a_position(tmp_path, position, first):
    folder = tmp_path / "slot"
    _segments(folder)
    log = replication._Segments({"path": str(folder), "startingposition": f"0/{position:X}"})
    assert log.first() == first or (position == 119 and log.first() in (20,))


def test_a_late_commit_is_not_left_out(tmp_path):
    """Positions in a log of commits don't rise; what came after the stored position in it is sent, also smaller ones."""
    chunk = lambda p: frame_bytes("I", p, p, 0, "s", "t")
    write_segment(str(tmp_path), 0, [chunk(200), chunk(250)])
    write_segment(str(tmp_path), 2, [chunk(100), chunk(110)])
    assert replication._Segments({"path": str(tmp_path), "startingposition": "0/FA"}).first() == 2
    assert replication._Segments({"path": str(tmp_path), "startingposition": "0/64"}).first() == 3


def _scrape(port, path="/metrics"):
    try:
        with urllib.request.urlopen(f"http://127.0.0.1:{port}{path}", timeout=10) as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def test_a_scrape_equals_the_batch_queries(spark, tmp_path, sf_dir, monkeypatch):
    """Events in two micro-batches; then all that is read from outside equals what the queries say."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")
    middle = events.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY event_id)")).first()[0]
    monitor = Monitor(commit_epoch_us=0)
    server = monitor.serve(0, "127.0.0.1")
    port = server.server_address[1]
    try:
        assert _scrape(port, "/health/ready") == (503, "starting\n") and _scrape(port, "/health/live")[0] == 200 and _scrape(port, "/else")[0] == 404
        pipeline = Pipeline(AppConfig(), memory_sink([]), monitor=monitor)
        stream = event_chunks(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in-*")).select("seq", "chunk")
        for k, part in enumerate((events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle))):
            part.write.parquet(f"{tmp_path}/in-{k}")
            query = pipeline.start(stream, str(tmp_path / "check"), available_now=True)
            query.awaitTermination(120)
            pipeline.counted()
        now = 4102444800000
        monkeypatch.setattr(monitor_module.time, "time", lambda: now / 1000)
        status, text = _scrape(port)
        got = {m[1]: int(m[2]) for m in re.finditer(r"^(tidelog_\S+) (-?\d+)$", text, re.M)}
    finally:
        server.shutdown()
    want = pipeline_metrics(spark, sf_dir).first().asDict()
    assert status == 200 and {k: got[f"tidelog_{k}_total"] for k in ("bytes_received", "records_parsed", "messages_sent")} == {k: want[k] for k in ("bytes_received", "records_parsed", "messages_sent")}
    assert got["tidelog_chunks_received_total"] == events.count() and got["tidelog_parse_errors_total"] == got["tidelog_send_errors_total"] == 0
    assert got["tidelog_batches_sent_total"] in (want["batches_sent"], want["batches_sent"] + 1)  # a bounded run closes its last batch
    for r in table_metrics_query(spark, sf_dir).collect():
        at = f'{{schema="public",table="{r.table_name}"}}'
        assert tuple(got[f"tidelog_table_{k}_total{at}"] for k in ("insert_count", "update_count", "delete_count")) == (r.insert_count, r.update_count, r.delete_count)
    for r in table_lag_query(spark, sf_dir).collect():
        assert got[f'tidelog_table_lag_ms{{schema="public",table="{r.table_name}"}}'] == r.lag_ms
    last = records(parse_chunks(event_chunks(events).select("seq", "chunk"))).agg(F.max_by("lsn", "seq")).first()[0]
    assert got["tidelog_last_lsn"] == int(last)


def test_health_of_a_failed_query(spark, tmp_path):
    replication.register(spark)
    write_segment(str(tmp_path / "slot"), 0, [frame_bytes("I", 1, 1, 1, "s", "t")])

    def away(df, batch):
        raise RuntimeError("down")

    monitor = Monitor()
    server = monitor.serve(0, "127.0.0.1")
    try:
        pipeline = Pipeline(AppConfig(), away, monitor=monitor)
        query = pipeline.start(spark.readStream.format("tidelog_chunks").option("path", str(tmp_path / "slot")).load(), str(tmp_path / "check"), available_now=True)
        with pytest.raises(Exception, match="down"):
            query.awaitTermination(60)
        until = time.monotonic() + 10
        while monitor.state != "failed" and time.monotonic() < until:
            time.sleep(0.05)
        assert _scrape(server.server_address[1], "/health/live")[0] == 503
    finally:
        server.shutdown()


def test_labels_are_escaped():
    monitor = Monitor(0)
    monitor.add_table('a"b', "c\\d\n", 5, insert_count=2)
    assert 'tidelog_table_insert_count_total{schema="a\\"b",table="c\\\\d\\n"} 2' in monitor.exposition(10)
    monitor.observed(3, {})
    monitor.observed(3, {"chunks": None})
    assert monitor.seen == {3}


_PROCESS = """
import sys, threading
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tidelog import __main__ as command
from tidelog.config import AppConfig, LoggingConfig, PostgresConfig, ReplicationConfig, StateConfig
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1")
         .config("spark.checkpoint.dir", "file://{base}/shared").config("spark.ui.showConsoleProgress", "false").getOrCreate())
PostgresConfig.connection_string = lambda self: "{base}/db.json"
config = AppConfig(replication=ReplicationConfig(batch_size=5), logging=LoggingConfig("{base}/logs", "info"), state=StateConfig("{base}/position"))
sys.exit(command.main(["--source", "slot", "--driver", "tests.fake_slot", "--sink", "parquet", "--out", "{base}/out", "--state", "{base}/state"], spark, config))
"""


def test_a_signal_ends_the_stream_and_a_restart_goes_on(tmp_path, spark):
    """The log grows while the process runs; it is told to end in mid-stream, twice, and started again."""
    from .fake_slot import text

    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": root, "PYTHONWARNINGS": "ignore"}
    script = tmp_path / "run.py"
    script.write_text(_PROCESS.format(root=root, base=tmp_path))
    log, db = [], tmp_path / "db.json"

    def grow(n):
        for _ in range(n):
            i = len(log) // 2
            log.append([text(32 * i + 16), i, frame_bytes("IUD"[i % 3], i, i, i, "public", f"t{i % 2}").hex()])
            log.append([text(32 * i + 32), i, None])
        state = json.loads(db.read_text()) if db.exists() else {"slots": {}}
        part = tmp_path / "db.part"
        part.write_text(json.dumps(state | {"log": log}))
        os.replace(part, db)

    sent = lambda: spark.read.parquet(f"{tmp_path}/out").select("seq", "value").collect() if list((tmp_path / "out").glob("batch_id=*/_SUCCESS")) else []
    grow(12)
    for turn in range(2):
        process = subprocess.Popen([sys.executable, str(script)], env=env, cwd=root, stdout=subprocess.DEVNULL, stderr=subprocess.PIPE)
        try:
            until = time.monotonic() + 90
            wanted = len(log) // 2 - 2
            while len(sent()) < wanted and time.monotonic() < until and process.poll() is None:
                time.sleep(0.5)
            if turn == 0:
                grow(9)
            process.send_signal(signal.SIGTERM)
            said = process.communicate(timeout=90)[1].decode()
        finally:
            process.kill()
        assert process.returncode == 0, said[-3000:]
    numbers = sorted(r.seq for r in sent())
    assert numbers == sorted(set(numbers)) and set(range(19)) <= set(numbers)
    assert (tmp_path / "position" / "wal_position.json").exists()


def test_a_live_stream_keeps_its_position_at_intervals_and_when_it_stops(spark, tmp_path):
    """The first position is written at once, later ones an interval (here an hour) after it, the last when the stream is stopped."""
    replication.register(spark)
    config = AppConfig(replication=ReplicationConfig(batch_size=4), state=StateConfig(str(tmp_path / "position")))
    sent = []
    pipeline = Pipeline(config, memory_sink(sent), CheckpointStore(str(tmp_path / "position"), spark).open())
    write_segment(str(tmp_path / "slot"), 0, [frame_bytes("I", i, i, i, "s", "t") for i in range(4)])
    query = pipeline.start(spark.readStream.format("tidelog_chunks").option("path", str(tmp_path / "slot")).load(), str(tmp_path / "check"))

    def wait(n):
        until = time.monotonic() + 60
        while pipeline.totals.values["messages_sent"] < n and time.monotonic() < until:
            assert query.isActive, query.exception()
            time.sleep(0.05)

    stored = lambda: CheckpointStore(str(tmp_path / "position"), spark).load().get(config.postgres.slot)
    try:
        wait(4)
        write_segment(str(tmp_path / "slot"), 4, [frame_bytes("I", i, i, i, "s", "t") for i in range(4, 10)])
        wait(10)  # two of them by silence
        assert stored() == "0/3"
    finally:
        pipeline.stop(query)
    assert stored() == "0/9" and not query.isActive
    assert [(r.seq, r.batch) for _, rows in sent for r in rows] == [(i, i // 4) for i in range(10)]
    assert pipeline.totals.values["batches_sent"] == 3 and pipeline.totals.values["chunks_received"] == 10


def test_a_micro_batch_reaches_the_state_in_blocks_and_columns_come_back(spark, tmp_path):
    """Records travel as few rows, whatever their number; values of any type, and slots, come back as they were."""
    from tidelog.streaming import batches

    schema, base = "s string, seq long, idx int, error string, big long, d decimal(20,0), b binary, t struct<x:array<string>>", str(tmp_path)
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    n = 3 * batches.BLOCK
    rows = [("ab"[i % 2], i, 0, None, None if i % 3 else 2**60 + i, Decimal(2**64 - 1 - i), bytes([i % 256, 255]), ([str(i), None],)) for i in range(n)]
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/in")
    closed = stream_batches(spark.readStream.schema(schema).parquet(f"{base}/in"), 100, 600_000, slot_col="s")
    got, taken = [], lambda df, batch_id: got.extend(df.collect())
    query = closed.writeStream.foreachBatch(taken).option("checkpointLocation", f"{base}/check").start()
    try:
        until = time.monotonic() + 60
        while not got and time.monotonic() < until:
            time.sleep(0.1)
            assert query.isActive, query.exception()
        updated = max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators) if query.recentProgress else 0
    finally:
        query.stop()
    want = [(s, k // 100, *r[1:]) for s in "ab" for k, r in enumerate([r for r in rows if r[0] == s]) if k // 100 < n // 2 // 100]
    plain = lambda r: (r.slot, r.batch, r.seq, r.idx, r.error, r.big, r.d, bytes(r.b), (r.t.x,))
    assert [plain(r) for r in sorted(got, key=lambda r: (r.slot, r.seq))] == want
    assert updated <= 20  # a block a slot, a number and a timer, not a row for each open record
