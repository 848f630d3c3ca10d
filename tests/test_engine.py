"""Routing, batches, positions, settings, sources, streams and registered queries."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.config import AppConfig, KafkaConfig, LoggingConfig, StateConfig
from tidelog.functions.binary import lsn_hex, lsn_text, lsn_value, number_or, operation_label
from tidelog.functions.frames import frame_bytes
from tidelog.operators.batching import assign_batches, close_batches, with_batches
from tidelog.operators.metrics import table_lag, table_metrics
from tidelog.operators.parse import parse_chunks, records
from tidelog.operators.route import group_lists, ordered_by_key, route
from tidelog.sources.catalog import has_slot, known_slots, single_consumer
from tidelog.sources.checkpoint import CheckpointStore, checkpoint_json, latest_by_slot, read_checkpoint, resume_after
from tidelog.sources.replication import register, write_segment
from tidelog.streaming.pipeline import Pipeline
from tidelog.streaming.sink import kafka_sink, memory_sink, parquet_sink


def _chunks(n=40, start=0):
    out = []
    for i in range(start, start + n):
        if i % 9 == 8:
            out.append(b"I" + b"\1" * 30)
        elif i % 5 == 4:
            out.append(b"".join(frame_bytes("IUDT"[k], i * 10 + k, i, 0, "public", f"t{k % 2}") for k in range(4)))
        else:
            out.append(frame_bytes("IUDTW"[i % 5], i * 10, i // 3, i, "public", f"t{i % 3}", 7, b"x"))
    return out


def test_payload_and_topic(spark):
    chunk = frame_bytes("I", 24, 7, 1000, "public", "orders", 16384, b"x")
    row = route(records(parse_chunks(spark.createDataFrame([(0, bytearray(chunk))], "seq long, chunk binary")))).first()
    assert (row.topic, row.key) == ("cdc.public.orders", "7")
    assert row.value == '{"lsn":24,"table_schema":"public","table_name":"orders","operation":"Insert","oid":16384,"new_tuple":null,"old_tuple":null,"tx_commit_time":1000,"tx_xid":7}'


def test_payload_of_large_numbers_and_tuples(spark):
    chunk = frame_bytes("U", 2**64 - 1, 2**64 - 2, -1, "a.b", 'q"\n')
    rec = records(parse_chunks(spark.createDataFrame([(0, bytearray(chunk))], "seq long, chunk binary")))
    from tidelog.operators.tuples import decode_tuple

    rec = rec.withColumn("new_tuple", decode_tuple(F.unhex(F.lit("4e740102")), F.array(F.lit(1), F.lit(2)).cast("array<bigint>")))
    row = route(rec, "p").first()
    assert row.topic == 'p.a.b.q"\n'
    assert json.loads(row.value) == {
        "lsn": 2**64 - 1, "table_schema": "a.b", "table_name": 'q"\n', "operation": "Update", "oid": 0, "old_tuple": None, "tx_commit_time": -1, "tx_xid": 2**64 - 2,
        "new_tuple": {"columns": [{"name": "", "type_oid": 1, "value": None, "is_null": True}, {"name": "", "type_oid": 2, "value": [1, 2], "is_null": False}]},
    }


@pytest.mark.parametrize(
    "counts,want",
    [([60, 60, 10, 100, 1], [0, 0, 1, 1, 2]), ([1] * 250, [0] * 100 + [1] * 100 + [2] * 50), ([0, 0, 5], [0, 0, 0]), ([100, 100], [0, 1]), ([], [])],
)
def test_batches(spark, counts, want):
    df = spark.createDataFrame(list(enumerate(counts)), "seq long, n long").repartition(3)
    assert [r.batch_id for r in assign_batches(df).orderBy("seq").collect()] == want


def test_batches_of_random_counts(spark):
    rng = random.Random(1)
    counts = [rng.choice([0, 1, 1, 3, 50, 99, 100, 250]) for _ in range(600)]
    want = close_batches(np.array(counts), 100)[0].tolist()
    df = spark.createDataFrame(list(enumerate(counts)), "seq long, n long").repartition(5)
    assert [r.batch_id for r in assign_batches(df).orderBy("seq").collect()] == want


def test_batches_of_single_records_by_expressions_alone(spark, monkeypatch):
    """Sparse, negative and shuffled chunk numbers, over several blocks and groups of blocks."""
    from tidelog.operators import batching

    monkeypatch.setattr(batching, "BLOCK_BITS", 3)
    monkeypatch.setattr(batching, "GROUP_BITS", 2)
    rng = random.Random(8)
    seqs = rng.sample(range(-500, 2000), 900)
    df = spark.createDataFrame([(s, 0, "Insert", f"x{s}") for s in seqs], "seq long, idx int, operation string, _kept string").repartition(5)
    got = {r.seq: r.batch_id for r in with_batches(df, 7, one_each=True).collect()}
    assert got == {s: k // 7 for k, s in enumerate(sorted(seqs))}
    assert {r.seq: r.batch_id for r in with_batches(df, 7).collect()} == got
    assert with_batches(df.limit(0), one_each=True).count() == 0


def test_engine_leaves_nothing_behind(spark, tmp_path):
    """A micro-batch removes what it wrote in the shared folder."""
    from tidelog.session import shared_dir

    folder = shared_dir(spark).removeprefix("file://")
    there = lambda: {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names}
    before = there()
    register(spark)
    write_segment(str(tmp_path / "slot"), 0, _chunks(40))
    _run(spark, tmp_path / "slot", tmp_path / "check", Pipeline(AppConfig(), memory_sink([])))
    assert there() == before


def test_positions(spark):
    cases = [(24, "0/24", "0/18"), (4294967999, "1/703", "1/2BF"), (2**64 - 1, "4294967295/4294967295", "FFFFFFFF/FFFFFFFF")]
    df = spark.createDataFrame([(str(n), t) for n, t, _ in cases], "n string, t string").withColumn("n", F.col("n").cast("decimal(20,0)"))
    rows = df.select("n", lsn_text(F.col("n")).alias("text"), lsn_hex(F.col("n")).alias("hex"), lsn_value(F.col("t")).alias("back")).collect()
    assert [(int(r.n), r.text, r.hex, int(r.back)) for r in rows] == [(n, t, h, n) for n, t, h in cases]
    bad = spark.createDataFrame([("x/1",), ("1",), (None,), ("-1/2",)], "t string").select(lsn_value(F.col("t")).alias("v")).collect()
    assert all(r.v is None for r in bad)


def test_checkpoint_rows(spark, tmp_path):
    store = CheckpointStore(str(tmp_path), spark)
    store.persist("s", "1/703", now=1704067200)
    store.persist("s2", "0/1", now=5)
    assert (tmp_path / "wal_position.json").read_text().startswith('{"s":{"last_lsn":"1/703","last_commit_time":1704067200}')
    rows = read_checkpoint(spark, str(tmp_path / "wal_position.json"))
    assert {tuple(r) for r in rows.collect()} == {("s", "1/703", 1704067200), ("s2", "0/1", 5)}
    assert json.loads(checkpoint_json(rows).first().value) == json.loads((tmp_path / "wal_position.json").read_text())
    updates = spark.createDataFrame([("s", 1, "0/1", 1), ("s", 3, "0/3", 3), ("s", 2, "0/2", 2)], "slot string, batch_id long, last_lsn string, last_commit_time long")
    assert [tuple(r) for r in latest_by_slot(updates).collect()] == [("s", "0/3", 3)]
    memory = CheckpointStore()
    memory.persist("s", "0/9")
    assert memory.get("s") == "0/9"


def test_config(caplog):
    assert AppConfig.from_env({}) == AppConfig()
    env = {"PG_PORT": "70000", "KAFKA_LINGER_MS": " 5", "KAFKA_BATCH_SIZE": "+32768", "PG_SLOT_NAME": "mine", "KAFKA_COMPRESSION": "lz4", "PG_PASSWORD": "secret", "REPLICATION_BATCH_SIZE": "7", "STATE_DIR": "/x"}
    c = AppConfig.from_env({"WAL_WRITER_" + k: v for k, v in env.items()})
    assert (c.postgres.port, c.kafka.linger_ms, c.kafka.batch_size, c.postgres.slot, c.replication.batch_size, c.state.state_dir) == (5432, 5, 32768, "mine", 7, "/x")
    assert len(caplog.records) == 2
    assert "secret" not in repr(c) and "secret" in c.postgres.connection_string()
    assert c.kafka.options()["kafka.compression.type"] == "lz4" and "kafka.compression.type" not in AppConfig().kafka.options()
    assert c.postgres.jdbc()["url"] == "jdbc:postgresql://localhost:5432/postgres"


def test_number_or(spark):
    rows = [("5432x", 1), ("+7", 1), (" 5", 1), (None, 2), ("70000", 3), ("65535", 4), ("-1", 5), ("99999999999999999999999", 6), ("", 7)]
    got = spark.createDataFrame(rows, "v string, d int").select(number_or(F.col("v"), F.col("d"), 16).cast("int").alias("n")).collect()
    assert [r.n for r in got] == [1, 7, 1, 2, 3, 65535, 5, 6, 7]


def test_catalog(spark):
    slots = spark.createDataFrame([("a",), ("b'c",)], "slot_name string")
    assert has_slot(slots, "a") and has_slot(slots, "b'c") and not has_slot(slots, "d") and not has_slot(slots.limit(0))
    assert known_slots(spark.createDataFrame([("a",), ("z",)], "slot_name string"), slots).collect()[0].slot_name == "a"
    assert single_consumer(slots.union(slots.where("slot_name = 'a'"))).first().slot_name == "a"


def test_metrics_and_groups(spark):
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(_chunks())], "seq long, chunk binary")
    rec = records(parse_chunks(df)).cache()
    want: dict = {}
    for r in rec.collect():
        want.setdefault(r.table_name, []).append(r.operation)
    for r in table_metrics(rec).collect():
        assert (r.insert_count, r.update_count, r.delete_count) == tuple(want[r.table_name].count(x) for x in ("Insert", "Update", "Delete"))
    for r in group_lists(rec).collect():
        assert [(x.seq, x.idx) for x in r.records] == sorted((x.seq, x.idx) for x in r.records) and len(r.records) == len(want[r.table_name])
    last = {t: max(r.tx_commit_time for r in rec.collect() if r.table_name == t) for t in want}
    assert {r.table_name: r.lag_ms for r in table_lag(rec, F.lit(100), F.col("tx_commit_time")).collect()} == {t: 100 - x for t, x in last.items()}
    parts = ordered_by_key(route(rec)).select("*", F.spark_partition_id().alias("p")).collect()
    for k in {(r.topic, r.key) for r in parts}:
        mine = [r for r in parts if (r.topic, r.key) == k]
        assert len({r.p for r in mine}) == 1 and [(r.seq, r.idx) for r in mine] == sorted((r.seq, r.idx) for r in mine)
    assert {r.o for r in rec.select(operation_label(F.col("operation")).alias("o")).distinct().collect()} == {"INSERT", "UPDATE", "DELETE", "TRUNCATE"}
    assert resume_after(rec, "0/100").where("lsn <= 100").count() == 0


def test_a_key_stays_with_its_writer(spark):
    """The number of a key's partition is the same in every batch, whatever else is in it, and a busy topic is many tasks."""
    make = lambda keys: spark.createDataFrame([("busy" if i % 10 else "other", f"k{k}", i, 0) for i, k in enumerate(keys)], "topic string, key string, seq long, idx int")
    place = {}
    for keys in (range(200), [*range(0, 200, 7)] * 3, range(150, 400)):
        rows = ordered_by_key(make(keys), 8).select("*", F.spark_partition_id().alias("p")).collect()
        for r in rows:
            assert place.setdefault((r.topic, r.key), r.p) == r.p
    assert len({p for (t, _), p in place.items() if t == "busy"}) == 8
    assert ordered_by_key(make(range(5)), 8).rdd.getNumPartitions() == 8


def _run(spark, folder, check, pipeline):
    stream = spark.readStream.format("tidelog_chunks").option("path", str(folder)).load()
    query = pipeline.start(stream, str(check), available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None
    pipeline.counted()


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    register(spark)
    folder, check, state = tmp_path / "slot", tmp_path / "check", tmp_path / "state"
    first, second = _chunks(40), _chunks(25, 40)
    write_segment(str(folder), 0, first[:17])
    write_segment(str(folder), 17, first[17:])
    config = AppConfig(state=StateConfig(state_dir=str(state)))
    sent, bad = [], []
    pipeline = Pipeline(config, memory_sink(sent), quarantine=lambda df, _: bad.extend(df.select("seq").collect()))
    _run(spark, folder, check, pipeline)
    got = [r[1:] for _, rows in sent for r in rows]
    static = spark.read.format("tidelog_chunks").option("path", str(folder)).load()
    assert static.count() == 40
    want = route(records(parse_chunks(static))).orderBy("seq", "idx").collect()
    assert got == want
    assert {r.seq for r in bad} == {i for i in range(40) if i % 9 == 8}
    totals = pipeline.totals.values
    assert (totals["chunks_received"], totals["bytes_received"], totals["messages_sent"], totals["parse_errors"]) == (40, sum(map(len, first)), len(want), len(bad))
    last = max(r.seq for r in want)
    position = CheckpointStore(str(state)).load().get(config.postgres.slot)
    assert position == f"0/{json.loads(want[-1].value)['lsn']}" and want[-1].seq == last
    # A new process goes on after what was sent: nothing lost, nothing twice.
    write_segment(str(folder), 40, second)
    again = []
    _run(spark, folder, check, Pipeline(config, memory_sink(again)))
    assert {r.seq for _, rows in again for r in rows} == {r.seq for r in route(records(parse_chunks(spark.read.format("tidelog_chunks").option("path", str(folder)).load()))).collect() if r.seq >= 40}


def test_admission_is_bounded(spark, tmp_path):
    register(spark)
    write_segment(str(tmp_path / "slot"), 0, _chunks(40))
    sizes = []
    stream = spark.readStream.format("tidelog_chunks").option("path", str(tmp_path / "slot")).option("maxChunksPerRead", 15).load()
    query = stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option("checkpointLocation", str(tmp_path / "check")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(sizes) == 40 and max(sizes) <= 15


def test_failed_sink_keeps_the_position(spark, tmp_path):
    register(spark)
    folder, state = tmp_path / "slot", tmp_path / "state"
    write_segment(str(folder), 0, _chunks(10))
    config = AppConfig(state=StateConfig(state_dir=str(state)))

    def fail(df, batch):
        raise RuntimeError("down")

    pipeline = Pipeline(config, fail)
    assert pipeline.totals.values["send_errors"] == 0
    stream = spark.readStream.format("tidelog_chunks").option("path", str(folder)).load()
    with pytest.raises(Exception, match="down"):
        pipeline.start(stream, str(tmp_path / "check"), available_now=True).awaitTermination(60)
    assert not (state / "wal_position.json").exists() and (pipeline.totals.values["batches_sent"], pipeline.totals.values["send_errors"]) == (0, 1)
    out = tmp_path / "out"
    _run(spark, folder, tmp_path / "check", Pipeline(config, parquet_sink(str(out))))
    back = spark.read.parquet(f"{out}/batch_id=0")
    assert back.count() > 0 and {"topic", "key", "value"} <= set(back.columns)


def test_batches_in_the_stream(spark, tmp_path):
    """The golden counts 60, 60, 10, 100, 1 in one micro-batch; the last batch is flushed, and the next micro-batch opens another."""
    register(spark)
    chunk = lambda n, at: b"".join(frame_bytes("I", at + i, at, 0, "s", f"t{i % 2}") for i in range(n))
    counts = [60, 60, 10, 100, 1]
    write_segment(str(tmp_path / "slot"), 0, [chunk(n, 1000 * i) for i, n in enumerate(counts)])
    sent = []
    pipeline = Pipeline(AppConfig(), memory_sink(sent))
    _run(spark, tmp_path / "slot", tmp_path / "check", pipeline)
    assert [{r.batch for r in sent[0][1] if r.seq == i} for i in range(5)] == [{0}, {0}, {1}, {1}, {2}]
    assert (pipeline.totals.values["batches_sent"], pipeline.totals.values["messages_sent"]) == (3, 231)
    write_segment(str(tmp_path / "slot"), 5, [chunk(2, 9000)])
    _run(spark, tmp_path / "slot", tmp_path / "check", pipeline)
    assert (pipeline.totals.values["batches_sent"], pipeline.totals.values["messages_sent"]) == (4, 233)


def test_batch_size_and_start_from_the_settings(spark, tmp_path):
    register(spark)
    write_segment(str(tmp_path / "slot"), 0, [frame_bytes("I", i, i, 0, "s", "t") for i in range(20)])
    config = AppConfig.from_env({"WAL_WRITER_REPLICATION_BATCH_SIZE": "4", "WAL_WRITER_REPLICATION_WAL_POSITION": "0/9"})
    sent = []
    pipeline = Pipeline(config, memory_sink(sent))
    _run(spark, tmp_path / "slot", tmp_path / "check", pipeline)
    assert [(r.seq, r.batch) for r in sent[0][1]] == [(i, (i - 10) // 4) for i in range(10, 20)]
    assert pipeline.totals.values["batches_sent"] == 3


def test_logging(tmp_path):
    import logging

    logger = LoggingConfig(str(tmp_path / "logs"), "warn").start(logging.getLogger("tidelog.test"))
    logger.info("not this")
    logger.warning("but this")
    for handler in logger.handlers:
        handler.flush()
    text = (tmp_path / "logs" / "wal-writer.log").read_text()
    assert "but this" in text and "not this" not in text


def test_kafka_rows_by_a_stand_in(spark, tmp_path):
    """A writer that takes rows as the Kafka connector does: topic as text, key and value as bytes; all options arrive."""
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    class Writer(DataSourceWriter):
        def __init__(self, options, schema):
            self.options, self.types = dict(options), [(f.name, f.dataType.simpleString()) for f in schema]

        def write(self, rows):
            import os
            import pickle

            with open(os.path.join(self.options["kafka.bootstrap.servers"], os.urandom(8).hex()), "wb") as f:
                pickle.dump((self.types, self.options, [(r.topic, bytes(r.key), bytes(r.value)) for r in rows]), f)
            return WriterCommitMessage()

    class StandIn(DataSource):
        @classmethod
        def name(cls):
            return "stand_in_kafka"

        def writer(self, schema, overwrite):
            return Writer(self.options, schema)

    spark.dataSource.register(StandIn)
    config = KafkaConfig(brokers=str(tmp_path), compression="lz4")
    parsed = records(parse_chunks(spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(_chunks())], "seq long, chunk binary")))
    kafka_sink(config, "stand_in_kafka")(route(parsed), 0)
    import pickle

    parts = [pickle.loads(p.read_bytes()) for p in tmp_path.iterdir()]
    assert all(types == [("topic", "string"), ("key", "binary"), ("value", "binary")] for types, _, _ in parts)
    assert all({k: o[k] for k in config.options()} == config.options() for _, o, _ in parts)
    want = [(r.topic, r.key.encode(), r.value.encode()) for r in route(parsed).orderBy("seq", "idx").collect()]
    got = [r for _, _, rows in parts for r in rows]
    assert sorted(got) == sorted(want)
    for k in {r[:2] for r in want}:
        assert [r for r in got if r[:2] == k] == [r for r in want if r[:2] == k]


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


from tidelog.plans.queries import oracle_sql, queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(oracle_sql()[name])
    assert columns == sorted(want.columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(repr, want.select(*[f'"{c}"' for c in columns]).fetchall()))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(queries()) <= set(__spark_entry__.queries())
