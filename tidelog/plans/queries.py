"""Registered queries of the change-data-capture engine, with equivalent SQL.

All work on changes made from ``events``: bytes are encoded, then parsed back. The SQL
computes the same answers without any bytes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig
from ..functions.binary import code_of, lsn_hex, lsn_text, number_or, operation_label
from ..functions import udtf
from ..functions.frames import event_chunks, event_fields, frame, u32_bytes
from ..functions.values import boolean_value, bytes_value, float_value, integer_value, json_text_value, kind_of, read_message, text_value, typed_column
from ..operators.batching import assign_batches, batch_summary, with_batches
from ..operators.metrics import chunk_counters, table_lag, table_metrics
from ..operators.parse import first_frame, parse_chunks, records
from ..operators.route import group_counts, group_lists, payload, route, topic
from ..operators.tuples import decode_tuple
from ..schema import DEFAULT_SLOT
from ..session import scratch
from ..sources.catalog import known_slots, single_consumer, slot_exists
from ..sources.checkpoint import CheckpointStore, checkpoint_json, latest_by_slot, latest_position, positions_of, resume_after, start_positions
from ..streaming.batches import STATE_STORE, stream_batches
from ..streaming.pipeline import Pipeline
from ..streaming.sink import parquet_sink

_CHANGES = """
WITH ch AS (SELECT event_id AS seq, substr('IUDTW', CAST(event_id % 5 AS INTEGER) + 1, 1) AS msg,
              event_id * 16777216 + 24 AS lsn, event_id // 10 AS xid, epoch_us(ts) AS ct,
              'public' AS table_schema, event_type AS table_name, 16384 + length(event_type) AS oid
            FROM events),
rec AS (SELECT *, CASE msg WHEN 'I' THEN 'Insert' WHEN 'U' THEN 'Update' WHEN 'D' THEN 'Delete'
                   WHEN 'T' THEN 'Truncate' END AS operation FROM ch WHERE msg <> 'W'),
bat AS (SELECT *, (row_number() OVER (ORDER BY seq) - 1) // 100 AS batch_id FROM rec)
"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_chunks(_events(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(first_frame(_chunks(spark, sf_dir)))


def _batched(records: DataFrame, *columns: str, one_each: bool = False) -> DataFrame:
    """Batches of records with what is needed of them, as all that is kept is sorted."""
    return with_batches(records.select("seq", "idx", "operation", *columns), one_each=one_each)


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: events encoded, parsed, routed and counted by topic, all in built-in expressions."""
    return route(_records(spark, sf_dir)).groupBy("topic").agg(F.count("*").alias("n"))


def scan_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, size = chunk_counters()
    return _chunks(spark, sf_dir).agg(n.alias("n_chunks"), size.alias("n_bytes"))


def decode_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("seq", _long("lsn"), F.col("tx_xid").cast("long").alias("xid"), F.col("tx_commit_time").alias("ct"))


def decode_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("seq", "table_schema", "table_name")


def decode_operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("seq", "operation")


def frame_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir).select("seq", "chunk", code_of(F.col("chunk")).alias("msg"))
    parsed = parse_chunks(chunks, keep=["msg"], outcomes=True)
    return parsed.groupBy("msg").agg(F.count_if(_first_row()).alias("n"), F.count("operation").alias("emitted"))


def _first_row() -> Column:
    """True once for each chunk in a parse with outcomes."""
    return F.coalesce(F.col("idx"), F.lit(0)) == 0


def oid_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One byte must follow the object id: it is cut from chunks with an even number."""
    cut = F.when(F.col("seq") % 2 == 0, F.substring("chunk", 1, F.octet_length("chunk") - 1)).otherwise(F.col("chunk"))
    return records(first_frame(_chunks(spark, sf_dir).select("seq", cut.alias("chunk")))).select("seq", "oid")


def multi_frame_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four frames without object ids in a chunk: each reads its id from the next one."""
    parsed = records(parse_chunks(_four_frames(spark, sf_dir).withColumnRenamed("chunk_id", "seq")))
    # The place of a record in its chunk counts records only; its own number follows from its position.
    return parsed.select(F.col("seq").alias("chunk_id"), F.expr("cast((lsn - 24) / 16777216 as long)").alias("seq"), "oid")


def _four_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chunk_id, chunk``: four frames without object ids in a chunk, as :func:`multi_frame_chunks` has them."""
    f = event_fields(_events(spark, sf_dir))
    one = frame(*[F.col(c) for c in ("msg", "lsn", "xid", "ct", "table_schema", "table_name")])
    parts = f.groupBy(F.expr("seq div 4").alias("chunk_id")).agg(F.sort_array(F.collect_list(F.struct("seq", one.alias("f")))).alias("parts"))
    nth = lambda k: F.coalesce(F.get(F.col("parts"), k)["f"], F.unhex(F.lit("")))
    return parts.select("chunk_id", F.concat(*[nth(k) for k in range(4)]).alias("chunk"))


def sql_parse_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`multi_frame_chunks` finds, by the table function of SQL."""
    udtf.register(spark)
    return spark.sql("SELECT chunk_id, CAST((lsn - 24) / 16777216 AS BIGINT) AS seq, oid FROM parse_chunks(TABLE({chunks})) WHERE error IS NULL", chunks=_four_frames(spark, sf_dir))


def sql_decode_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`tuple_decode` finds, by the table function of SQL."""
    udtf.register(spark)
    f = event_fields(_events(spark, sf_dir))
    data = F.concat(F.encode(F.repeat(F.lit("N"), (F.col("seq") % 4).cast("int")), "UTF-8"), F.encode(F.concat(F.lit("t"), F.col("table_name")), "UTF-8"))
    tuples = f.select("seq", data.alias("data"), F.array(F.lit(23), F.lit(25), F.lit(1043)).cast("array<bigint>").alias("oids"))
    return spark.sql("SELECT seq, pos, type_oid, CAST(value AS STRING) AS value, is_null FROM decode_tuples(TABLE({tuples}))", tuples=tuples)


def value_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value of each kind, and none, in messages and back: the kind that was written, the one read, its text, and whether the message made from it is the same."""
    e, i = _events(spark, sf_dir), F.col("event_id")
    kinds = {
        "String": text_value(F.col("event_type")), "Integer": integer_value(i * 1000003), "Float": float_value(i / 4), "Boolean": boolean_value(i % 16 < 8),
        "Json": json_text_value(F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"t":[null,"'), F.col("event_type"), F.lit('"]}'))), "Bytes": bytes_value(F.encode("event_type", "UTF-8")),
    }
    wrote, value = F.lit(None).cast("string"), F.lit(None).cast("variant")
    for k, (kind, made) in enumerate(kinds.items()):
        wrote, value = F.when(i % 7 == k, kind).otherwise(wrote), F.when(i % 7 == k, made).otherwise(value)
    typed = F.struct(F.array(typed_column(F.lit("c"), F.lit(25), value)).alias("columns"))
    message = lambda df: df.withColumn("value", payload(df))
    sent = message(records(first_frame(event_chunks(e).select("seq", "chunk"))).join(e.select(F.col("event_id").alias("seq"), typed.alias("typed"), wrote.alias("wrote")), "seq").withColumn("new_tuple", F.col("typed")))
    back = message(sent.select("seq", "wrote", F.col("value").alias("first"), F.inline(F.array(read_message(F.col("value"))))))
    got = F.col("new_tuple")["columns"][0]["value"]
    return back.select("seq", "wrote", kind_of(got).alias("kind"), F.to_json(got).alias("text"), (F.col("first") == F.col("value")).alias("same"))


def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In every seventh chunk the second name has no end."""
    chunk = F.col("chunk")
    cut = F.when(F.col("seq") % 7 == 0, F.substring(chunk, 1, F.octet_length(chunk) - 6)).otherwise(chunk)
    chunks = _chunks(spark, sf_dir).select("seq", cut.alias("chunk"))
    outcome = F.when(F.col("error").isNotNull(), "error").when(F.col("operation").isNull(), "skipped").otherwise("record")
    return parse_chunks(chunks, outcomes=True).where(_first_row()).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def route_topic_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_records(spark, sf_dir)).select("topic", "key", "seq")


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_records(spark, sf_dir)).select("seq", "value")


def group_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_counts(_batched(_records(spark, sf_dir), "table_schema", "table_name", one_each=True), "batch_id")


def batch_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_summary(_batched(_records(spark, sf_dir), "lsn", one_each=True)).select("batch_id", "n", _long("last_lsn"))


def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_position(_batched(_records(spark, sf_dir), "lsn", one_each=True), DEFAULT_SLOT)


def lsn_as_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("seq", lsn_hex(F.col("lsn")).alias("lsn_pg"))


def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume_after(_records(spark, sf_dir), "20/0").select("seq", _long("lsn"))


def slot_exists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot that is among those named by the types of events, and two that aren't."""
    slots = _events(spark, sf_dir).select(F.col("event_type").alias("slot_name"))
    found = [slot_exists(slots, name).select(F.lit(name).alias("slot"), "slot_exists") for name in ("purchase", "purchas", DEFAULT_SLOT)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters from one pass over the parsed chunks."""
    chunks = _chunks(spark, sf_dir).select("seq", "chunk", F.octet_length("chunk").alias("size"))
    batched = _batched(parse_chunks(chunks, keep=["size"], outcomes=True), "size", "table_schema", "table_name")
    is_record = F.col("operation").isNotNull()
    return batched.agg(
        F.sum(F.when(_first_row(), F.col("size"))).alias("bytes_received"),
        F.count("operation").alias("records_parsed"),
        F.coalesce(F.max(F.when(is_record, F.col("batch_id"))) + 1, F.lit(0)).alias("batches_sent"),
        F.count(F.when(is_record, topic("cdc", F.col("table_schema"), F.col("table_name")))).alias("messages_sent"),
    )


def table_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_metrics(_records(spark, sf_dir)).drop("table_schema")


def config_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three settings in texts made from events: a number and letters, none, a number."""
    i = F.col("event_id")
    k = F.when(i % 3 == 0, "port").when(i % 3 == 1, "linger_ms").otherwise("batch_size")
    v = F.when(i % 3 == 0, F.concat(i.cast("string"), F.lit("x"))).when(i % 3 == 2, i.cast("string"))
    d = F.when(i % 3 == 0, 5432).when(i % 3 == 1, 5).otherwise(16384)
    return _events(spark, sf_dir).select("event_id", k.alias("k"), number_or(v, d, 32).cast("int").alias("val"))


def tuple_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table name, after ``n`` null flags, as a tuple of three columns."""
    f = event_fields(_events(spark, sf_dir))
    n = (F.col("seq") % 4).cast("int")
    data = F.concat(F.encode(F.repeat(F.lit("N"), n), "UTF-8"), F.encode(F.concat(F.lit("t"), F.col("table_name")), "UTF-8"))
    oids = F.array(F.lit(23), F.lit(25), F.lit(1043)).cast("array<bigint>")
    out = f.select("seq", F.posexplode(decode_tuple(data, oids)["columns"]).alias("pos", "c"))
    return out.select("seq", "pos", F.col("c.type_oid").alias("type_oid"), F.col("c.value").cast("string").alias("value"), F.col("c.is_null").alias("is_null"))


def _frames(spark: SparkSession, sf_dir: str, **fields: Column) -> DataFrame:
    """``seq, chunk`` of the changes of events, one frame each, with some of its fields made otherwise."""
    f = event_fields(_events(spark, sf_dir)).withColumns(fields)
    head = [F.col(c) for c in ("msg", "lsn", "xid", "ct", "table_schema", "table_name")]
    return f.select("seq", F.inline(F.array(F.struct(frame(*head, u32_bytes(F.col("oid")), F.encode(F.lit("x"), "UTF-8")).alias("chunk")))))


def short_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks cut at 0 to 59 bytes: too short for a code, a header, a name, or whole."""
    cut = F.substring("chunk", F.lit(1), (F.col("seq") % 60).cast("int"))
    parsed = parse_chunks(_chunks(spark, sf_dir).select("seq", cut.alias("chunk")), outcomes=True).where(_first_row())
    return parsed.select("seq", F.coalesce("error", F.when(F.col("operation").isNotNull(), "record"), F.lit("skipped")).alias("outcome"))


def lossy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed bytes in names: of every three one has a byte that never occurs, one half a character."""
    f = event_fields(_events(spark, sf_dir))
    broken = F.when(F.col("seq") % 3 == 1, F.unhex(F.lit("FF"))).when(F.col("seq") % 3 == 2, F.unhex(F.lit("C3"))).otherwise(F.unhex(F.lit("")))
    before = frame(F.lit("I"), *[F.col(c) for c in ("lsn", "xid", "ct", "table_schema", "table_name")])
    chunk = F.concat(F.substring(before, F.lit(1), F.octet_length(before) - 1), broken, F.encode(F.lit("z"), "UTF-8"), F.unhex(F.lit("00")))
    chunks = f.select("seq", F.inline(F.array(F.struct(chunk.alias("chunk")))))
    both = records(parse_chunks(chunks)).select("seq", "table_schema", "table_name", F.lit("batches").alias("path"))
    return both.unionByName(records(first_frame(chunks)).select("seq", "table_schema", "table_name", F.lit("expressions").alias("path")))


def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions from 2 ** 63 on, transaction ids up to 2 ** 64 - 1 and negative times, in numbers and in messages."""
    i = F.col("seq")
    parsed = records(parse_chunks(_frames(spark, sf_dir, lsn=F.lit(-(2**63)) + i, xid=-1 - i, ct=-i, msg=F.lit("U"))))
    return route(parsed, "cdc", "lsn", "tx_commit_time").select("seq", F.col("lsn").cast("string").alias("lsn"), F.col("tx_commit_time").alias("ct"), "key", "value", lsn_text(F.col("lsn")).alias("lsn_text"), lsn_hex(F.col("lsn")).alias("lsn_pg"))


def last_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions that don't rise with arrival: the last record of a batch counts, not the largest."""
    parsed = records(first_frame(_frames(spark, sf_dir, lsn=F.col("seq") * 7919 % 10007)))
    return batch_summary(_batched(parsed, "lsn")).select("batch_id", "n", _long("last_lsn"))


def batch_overshoot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 60, 60, 10, 100 and 1 records, over and over: a batch takes the whole chunk that fills it."""
    f = event_fields(_events(spark, sf_dir)).withColumn("p", F.col("seq") % 231)
    at = F.when(F.col("p") < 60, 0).when(F.col("p") < 120, 1).when(F.col("p") < 130, 2).when(F.col("p") < 230, 3).otherwise(4)
    one = frame(F.lit("I"), *[F.col(c) for c in ("lsn", "xid", "ct", "table_schema", "table_name")])
    parts = f.groupBy((F.expr("5 * (seq div 231)") + at).alias("chunk_id")).agg(F.sort_array(F.collect_list(F.struct("seq", one.alias("f")))).alias("parts"))
    chunks = parts.select(F.col("chunk_id").alias("seq"), F.unhex(F.array_join(F.transform("parts", lambda x: F.hex(x["f"])), "")).alias("chunk"))
    batched = _batched(records(parse_chunks(chunks)))
    return batched.groupBy(F.col("seq").alias("chunk_id"), "batch_id").agg(F.count("*").alias("n"))


def empty_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunks in three have no record; the others fill a batch each."""
    counts = _events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 3 == 0, 100).otherwise(0).alias("n"))
    return assign_batches(counts)


def group_lists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of each batch and table, in order of arrival."""
    lists = group_lists(with_batches(_records(spark, sf_dir)), "batch_id")
    return lists.select("batch_id", "table_name", F.array_join(F.transform("records", lambda r: r["seq"].cast("string")), ",").alias("seqs"))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update of a slot's position for each event; slots are named by the type."""
    e = _events(spark, sf_dir)
    updates = e.select(F.col("event_type").alias("slot"), F.col("event_id").alias("batch_id"), lsn_text((F.col("event_id") * 16777216 + 24).cast("decimal(20,0)")).alias("last_lsn"), F.expr("event_id div 7").alias("last_commit_time"))
    return latest_by_slot(updates)


def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir)


def checkpoint_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as the JSON map of the checkpoint file, read back."""
    return positions_of(checkpoint_json(_positions(spark, sf_dir)))


def checkpoint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where slots start: known ones, and two that have no position."""
    wanted = _events(spark, sf_dir).select(F.col("event_type").alias("slot_name")).distinct()
    return start_positions(wanted.unionByName(spark.createDataFrame([("new",), ("newer",)], "slot_name string")), _positions(spark, sf_dir))


def operation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).groupBy(operation_label(F.col("operation")).alias("label")).agg(F.count("*").alias("n"))


def table_lag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milliseconds from the last commit of each table to the start of 2100 (commit times here are in microseconds)."""
    return table_lag(_records(spark, sf_dir), F.lit(4102444800000), F.expr("tx_commit_time div 1000")).drop("table_schema")


def slots_of_consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumers that want slots: which exist, and which are wanted twice."""
    e = _events(spark, sf_dir)
    wanted = e.select(F.concat("event_type", F.lit("_"), (F.col("event_id") % 7).cast("string")).alias("slot_name"))
    slots = e.where("event_id % 2 = 0").select(F.concat("event_type", F.lit("_"), (F.col("event_id") % 5).cast("string")).alias("slot_name")).distinct()
    known = known_slots(wanted, slots).groupBy("slot_name").agg(F.count("*").alias("known"))
    return single_consumer(wanted).join(known, "slot_name", "left").select("slot_name", "consumers", F.coalesce("known", F.lit(0)).alias("known"))


def config_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of 16, 32 and 64 bits in texts made from events: signs, blanks, too large, none."""
    i = F.col("event_id").cast("string")
    texts = [i, F.concat(F.lit("+"), i), F.concat(F.lit("-"), i), F.concat(F.lit(" "), i), F.concat(i, F.lit("000")), F.concat(F.lit("4294967"), F.lpad(i, 6, "0")), F.concat(F.lit("18446744073709"), F.lpad(i, 6, "0")), F.concat(F.lit("65"), F.lpad(i, 3, "0")), F.concat(i, F.lit("e3")), F.col("event_type"), F.lit("")]
    v = F.lit(None).cast("string")
    for k, text in enumerate(texts):
        v = F.when(F.col("event_id") % 12 == k, text).otherwise(v)
    e = _events(spark, sf_dir).select("event_id", v.alias("v"))
    out = [e.select("event_id", "v", F.lit(bits).alias("bits"), number_or(F.col("v"), F.lit(7), bits).cast("string").alias("val")) for bits in (16, 32, 64)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def config_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the settings make of an environment for each type of events, in which two are set to its name."""
    out = []
    for r in _events(spark, sf_dir).select("event_type").distinct().where("event_type IS NOT NULL").collect():  # a handful
        c = AppConfig.from_env({"WAL_WRITER_PG_HOST": r.event_type, "WAL_WRITER_KAFKA_TOPIC_PREFIX": r.event_type[::-1]})
        rows = {"connection": c.postgres.connection_string(), "slot": c.postgres.slot, "start": CheckpointStore().start(c.postgres.slot), "prefix": c.kafka.topic_prefix, "log": c.logging.log_dir, "level": c.logging.level}
        rows |= {k: c.kafka.options()[f"kafka.{k}"] for k in ("bootstrap.servers", "acks", "linger.ms", "batch.size")}
        out += [(r.event_type, k, v) for k, v in rows.items()]
    return spark.createDataFrame(out, "event_type string, k string, v string")


#: Events that a micro-batch of :func:`stream_batches_query` brings, about: the limit of its reader.
MICRO_BATCH = 1_000_000


def stream_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of ``batch_boundaries`` from a stream: events come in four parts, or more of bounded size, each a micro-batch.

    The open batch is in the state store between micro-batches. The query is then started
    again, and a chunk without records is the last that it gets: silence after it closes the
    last batch.
    """
    base, events = scratch(spark, "batches"), _events(spark, sf_dir).where("event_id IS NOT NULL")
    found = events.agg(F.count("*").alias("n"), F.min("event_id").alias("least"), F.max("event_id").alias("most")).first()
    arrived, out = f"{base}/events", f"{base}/out"
    events.limit(0).write.parquet(arrived)
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}

    def run(idle_ms: int, puts: Iterator[int], done: Callable[[list[int]], bool]) -> None:
        seen, put = [0, 0], 0  # rows that came in, rows that went out; rows that were put
        came: dict[int, int] = {}  # rows of each micro-batch

        def take(rows: DataFrame, batch_id: int) -> None:
            path = f"{out}/idle={idle_ms}/part={batch_id}"
            rows.select("batch", "seq", "idx", "lsn").write.mode("overwrite").parquet(path)
            seen[1] += spark.read.parquet(path).count()

        chunks = event_chunks(spark.readStream.schema(events.schema).parquet(f"{arrived}*"))
        parsed = parse_chunks(chunks.where("seq IS NOT NULL"), outcomes=True)
        rows = parsed.select("seq", F.when(F.col("operation").isNotNull(), F.col("idx")).alias("idx"), "lsn")
        query = stream_batches(rows, idle_ms=idle_ms).writeStream.foreachBatch(take).option("checkpointLocation", f"{base}/state").start()
        try:
            while query.isActive and not done(seen):
                came |= {p.batchId: max(p.numInputRows, came.get(p.batchId, 0)) for p in query.recentProgress}
                seen[0] = sum(came.values())
                if seen[0] >= put:  # the next part waits until this one was taken
                    put += next(puts, 0)
                time.sleep(0.05)
        finally:
            query.stop()
        if query.exception():
            raise query.exception()

    def parts() -> Iterator[int]:
        ranges = max(4, -(-found["n"] // MICRO_BATCH))
        events.repartitionByRange(ranges, "event_id").withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(f"{base}/parts")
        counts = spark.read.parquet(f"{base}/parts").groupBy("part").count().orderBy("part").collect()
        for part, n in counts:
            spark.read.schema(events.schema).parquet(f"{base}/parts/part={part}").write.parquet(f"{arrived}{part}")
            yield n

    def empty_chunk() -> Iterator[int]:
        last = events.where(F.col("event_id") == found["most"]).limit(1)
        last.select((F.expr("event_id div 5 * 5 + 9")).alias("event_id"), "ts", "event_type").write.parquet(f"{arrived}-last")  # its code emits nothing
        yield 1

    try:
        for name, value in STATE_STORE.items():
            spark.conf.set(name, value)
        if found["n"]:
            run(3_600_000, parts(), lambda seen: seen[0] >= found["n"])
            sent = spark.read.parquet(f"{out}/idle=3600000").count()
            total = records(first_frame(event_chunks(events))).count()
            run(10, empty_chunk(), lambda seen: sent + seen[1] >= total)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    schema = "batch long, seq long, idx int, lsn decimal(20,0)"
    closed = spark.read.schema(schema).parquet(out) if found["n"] else spark.createDataFrame([], schema)
    return batch_summary(closed.withColumnRenamed("batch", "batch_id")).select("batch_id", "n", _long("last_lsn"))


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of chunks through the whole pipeline, to a Parquet sink in the shared folder, read back."""
    base = scratch(spark, "stream")
    events = spark.readStream.schema(_events(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parque[t]")
    pipeline = Pipeline(AppConfig(), parquet_sink(f"{base}/out"))
    pipeline.start(event_chunks(events).select("seq", "chunk"), f"{base}/state", available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/out/batch_id=*").select("seq", F.col("key"), "value", "batch")


_TAILS = {
    "topic_counts": "SELECT 'cdc.' || table_schema || '.' || table_name AS topic, count(*) AS n FROM rec GROUP BY 1",
    "scan_chunks": "SELECT count(*) AS n_chunks, CAST(sum(38 + length(table_name)) AS BIGINT) AS n_bytes FROM ch",
    "decode_header": "SELECT seq, lsn, xid, ct FROM rec",
    "decode_names": "SELECT seq, table_schema, table_name FROM rec",
    "decode_operation": "SELECT seq, operation FROM rec",
    "frame_outcome": "SELECT msg, count(*) AS n, CAST(sum(CASE WHEN msg = 'W' THEN 0 ELSE 1 END) AS BIGINT) AS emitted FROM ch GROUP BY msg",
    "oid_boundary": "SELECT seq, CAST(CASE WHEN seq % 2 = 0 THEN 0 ELSE oid END AS BIGINT) AS oid FROM rec",
    "multi_frame_chunks": """SELECT chunk_id, seq, CAST(oid AS BIGINT) AS oid FROM (
        SELECT msg, seq, seq // 4 AS chunk_id, coalesce(lead(ascii(msg) * 16777216 + (lsn >> 40)) OVER (PARTITION BY seq // 4 ORDER BY seq), 0) AS oid FROM ch)
        WHERE msg <> 'W'""",
    "parse_errors": "SELECT CASE WHEN seq % 7 = 0 THEN 'error' WHEN msg = 'W' THEN 'skipped' ELSE 'record' END AS outcome, count(*) AS n FROM ch GROUP BY 1",
    "route_topic_key": "SELECT 'cdc.' || table_schema || '.' || table_name AS topic, CAST(xid AS VARCHAR) AS key, seq FROM rec",
    "payload_json": """SELECT seq, '{"lsn":' || lsn || ',"table_schema":"' || table_schema || '","table_name":"' || table_name || '","operation":"' || operation
        || '","oid":' || oid || ',"new_tuple":null,"old_tuple":null,"tx_commit_time":' || ct || ',"tx_xid":' || xid || '}' AS value FROM rec""",
    "group_by_table": "SELECT batch_id, table_schema, table_name, count(*) AS n FROM bat GROUP BY ALL",
    "batch_boundaries": "SELECT batch_id, count(*) AS n, arg_max(lsn, seq) AS last_lsn FROM bat GROUP BY batch_id",
    "checkpoint_latest": """SELECT 'wal_writer_slot' AS slot, CAST(arg_max(lsn, seq) >> 32 AS VARCHAR) || '/' || CAST(arg_max(lsn, seq) & 4294967295 AS VARCHAR) AS last_lsn FROM bat""",
    "lsn_hex": "SELECT seq, printf('%X/%X', lsn >> 32, lsn & 4294967295) AS lsn_pg FROM rec",
    "resume_filter": "SELECT seq, lsn FROM rec WHERE lsn > 85899345920",
    "pipeline_metrics": """SELECT (SELECT CAST(sum(38 + length(table_name)) AS BIGINT) FROM ch) AS bytes_received, (SELECT count(*) FROM rec) AS records_parsed,
        (SELECT count(DISTINCT batch_id) FROM bat) AS batches_sent, (SELECT count(*) FROM rec) AS messages_sent""",
    "table_metrics": """SELECT table_name, count(*) FILTER (WHERE operation = 'Insert') AS insert_count, count(*) FILTER (WHERE operation = 'Update') AS update_count,
        count(*) FILTER (WHERE operation = 'Delete') AS delete_count FROM rec GROUP BY table_name""",
    "tuple_decode": """SELECT seq, CAST(pos AS INTEGER) AS pos, CAST([23, 25, 1043][pos + 1] AS BIGINT) AS type_oid,
        CASE WHEN pos = seq % 4 THEN table_name END AS value, pos <> seq % 4 AS is_null FROM ch, range(3) p(pos)""",
}
_LATEST = "SELECT event_type AS slot, CAST((max(event_id) * 16777216 + 24) >> 32 AS VARCHAR) || '/' || CAST((max(event_id) * 16777216 + 24) & 4294967295 AS VARCHAR) AS last_lsn, max(event_id) // 7 AS last_commit_time FROM events GROUP BY 1"
_TAILS |= {
    "short_frames": """SELECT seq, CASE WHEN n < 4 THEN 'skipped' WHEN n < 25 THEN 'short_frame' WHEN n < 33 + length(table_name) THEN 'missing_terminator' WHEN msg = 'W' THEN 'skipped' ELSE 'record' END AS outcome
        FROM (SELECT *, seq % 60 AS n FROM ch)""",
    "lossy_names": """SELECT seq, table_schema, table_name || CASE WHEN seq % 3 = 0 THEN '' ELSE chr(65533) END || 'z' AS table_name, path FROM ch, (VALUES ('batches'), ('expressions')) p(path)""",
    "wide_numbers": """, w AS (SELECT *, 9223372036854775808 + CAST(seq AS HUGEINT) AS l, 18446744073709551615 - CAST(seq AS HUGEINT) AS x FROM ch)
        SELECT seq, CAST(l AS VARCHAR) AS lsn, -seq AS ct, CAST(x AS VARCHAR) AS key,
          '{"lsn":' || l || ',"table_schema":"public","table_name":"' || table_name || '","operation":"Update","oid":' || oid || ',"new_tuple":null,"old_tuple":null,"tx_commit_time":' || -seq || ',"tx_xid":' || x || '}' AS value,
          CAST(l // 4294967296 AS VARCHAR) || '/' || CAST(l % 4294967296 AS VARCHAR) AS lsn_text, printf('%X/%X', CAST(l // 4294967296 AS BIGINT), CAST(l % 4294967296 AS BIGINT)) AS lsn_pg FROM w""",
    "last_by_arrival": "SELECT batch_id, count(*) AS n, arg_max(seq * 7919 % 10007, seq) AS last_lsn FROM bat GROUP BY batch_id",
    "batch_overshoot": """, p AS (SELECT seq // 231 AS turn, seq % 231 AS p FROM ch)
        SELECT 5 * turn + CASE WHEN p < 60 THEN 0 WHEN p < 120 THEN 1 WHEN p < 130 THEN 2 WHEN p < 230 THEN 3 ELSE 4 END AS chunk_id,
          2 * turn + CASE WHEN p < 120 THEN 0 WHEN p < 230 THEN 1 ELSE 2 END AS batch_id, count(*) AS n FROM p GROUP BY ALL""",
    "empty_chunks": "SELECT seq, CAST(n AS BIGINT) AS n, CAST(coalesce(sum(n // 100) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS batch_id FROM (SELECT seq, CASE WHEN seq % 3 = 0 THEN 100 ELSE 0 END AS n FROM ch)",
    "group_lists": "SELECT batch_id, table_name, string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq) AS seqs FROM bat GROUP BY ALL",
    "stream_batches": "SELECT batch_id, count(*) AS n, arg_max(lsn, seq) AS last_lsn FROM bat GROUP BY batch_id",
    "operation_labels": "SELECT upper(operation) AS label, count(*) AS n FROM rec GROUP BY 1",
    "table_lag": "SELECT table_name, 4102444800000 - max(ct // 1000) AS lag_ms FROM rec GROUP BY 1",
    "stream_messages": """SELECT seq, CAST(xid AS VARCHAR) AS key, '{"lsn":' || lsn || ',"table_schema":"' || table_schema || '","table_name":"' || table_name || '","operation":"' || operation
        || '","oid":' || oid || ',"new_tuple":null,"old_tuple":null,"tx_commit_time":' || ct || ',"tx_xid":' || xid || '}' AS value, batch_id AS batch FROM bat""",
}
_TAILS |= {
    "sql_parse_chunks": _TAILS["multi_frame_chunks"],
    "sql_decode_tuples": _TAILS["tuple_decode"],
    "value_round_trip": """, k AS (SELECT seq, table_name AS t, seq % 7 AS k FROM rec)
        SELECT seq, CASE k WHEN 0 THEN 'String' WHEN 1 THEN 'Integer' WHEN 2 THEN 'Float' WHEN 3 THEN 'Boolean' WHEN 4 THEN 'Json' WHEN 5 THEN 'Bytes' END AS wrote,
          CASE k WHEN 0 THEN 'String' WHEN 1 THEN 'Integer' WHEN 2 THEN 'Float' WHEN 3 THEN 'Boolean' WHEN 4 THEN 'Json' WHEN 5 THEN 'Json' END AS kind,
          CASE k WHEN 0 THEN '"' || t || '"' WHEN 1 THEN CAST(seq * 1000003 AS VARCHAR) WHEN 2 THEN CAST(CAST(seq AS DOUBLE) / 4 AS VARCHAR) WHEN 3 THEN CASE WHEN seq % 16 < 8 THEN 'true' ELSE 'false' END
            WHEN 4 THEN '{"id":' || seq || ',"t":[null,"' || t || '"]}' WHEN 5 THEN '[' || array_to_string(list_transform(range(1, length(t) + 1), lambda i: ascii(substr(t, i, 1))), ',') || ']' END AS text, true AS same FROM k""",
}
_WHOLE = {
    "checkpoint_upsert": _LATEST,
    "checkpoint_file": _LATEST,
    "checkpoint_lookup": f"SELECT slot AS slot_name, last_lsn AS start FROM ({_LATEST}) UNION ALL SELECT * FROM (VALUES ('new', '0/0'), ('newer', '0/0')) v",
    "slots_of_consumers": """WITH w AS (SELECT event_type || '_' || event_id % 7 AS slot_name FROM events), s AS (SELECT DISTINCT event_type || '_' || event_id % 5 AS slot_name FROM events WHERE event_id % 2 = 0)
        SELECT slot_name, count(*) AS consumers, count(*) FILTER (WHERE slot_name IN (SELECT slot_name FROM s)) AS known FROM w GROUP BY 1 HAVING count(*) > 1""",
    "config_numbers": """WITH e AS (SELECT event_id, CAST(event_id AS VARCHAR) AS i, event_type FROM events),
        t AS (SELECT event_id, CASE event_id % 12 WHEN 0 THEN i WHEN 1 THEN '+' || i WHEN 2 THEN '-' || i WHEN 3 THEN ' ' || i WHEN 4 THEN i || '000' WHEN 5 THEN '4294967' || lpad(i, 6, '0')
          WHEN 6 THEN '18446744073709' || lpad(i, 6, '0') WHEN 7 THEN '65' || lpad(i, 3, '0') WHEN 8 THEN i || 'e3' WHEN 9 THEN event_type WHEN 10 THEN '' END AS v FROM e)
        SELECT event_id, v, bits, CASE WHEN regexp_full_match(v, '[+]?[0-9]+') AND CAST(v AS HUGEINT) < power(2, bits)::HUGEINT THEN CAST(CAST(v AS HUGEINT) AS VARCHAR) ELSE '7' END AS val
        FROM t, (VALUES (16), (32), (64)) b(bits)""",
    "config_strings": """SELECT event_type, k, v FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL) e, LATERAL (SELECT * FROM (VALUES
        ('connection', 'host=' || event_type || ' port=5432 user=postgres password= dbname=postgres'), ('slot', 'wal_writer_slot'), ('start', '0/0'), ('prefix', reverse(event_type)), ('log', '/var/log/wal-writer'), ('level', 'info'),
        ('bootstrap.servers', 'localhost:9092'), ('acks', 'all'), ('linger.ms', '5'), ('batch.size', '16384')) t(k, v)) x""",
    "slot_exists": "SELECT slot, slot IN (SELECT event_type FROM events) AS slot_exists FROM (VALUES ('purchase'), ('purchas'), ('wal_writer_slot')) s(slot)",
    "config_defaults": """SELECT event_id, k, coalesce(try_cast(v AS INTEGER), d) AS val FROM (SELECT event_id, ['port', 'linger_ms', 'batch_size'][event_id % 3 + 1] AS k, [5432, 5, 16384][event_id % 3 + 1] AS d,
        CASE event_id % 3 WHEN 0 THEN event_id || 'x' WHEN 2 THEN CAST(event_id AS VARCHAR) END AS v FROM events)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "topic_counts": topic_counts,
        "scan_chunks": scan_chunks,
        "decode_header": decode_header,
        "decode_names": decode_names,
        "decode_operation": decode_operation,
        "frame_outcome": frame_outcome,
        "oid_boundary": oid_boundary,
        "multi_frame_chunks": multi_frame_chunks,
        "parse_errors": parse_errors,
        "route_topic_key": route_topic_key,
        "payload_json": payload_json,
        "group_by_table": group_by_table,
        "batch_boundaries": batch_boundaries,
        "checkpoint_latest": checkpoint_latest,
        "lsn_hex": lsn_as_hex,
        "resume_filter": resume_filter,
        "slot_exists": slot_exists_query,
        "pipeline_metrics": pipeline_metrics,
        "table_metrics": table_metrics_query,
        "config_defaults": config_defaults,
        "tuple_decode": tuple_decode,
        "short_frames": short_frames,
        "lossy_names": lossy_names,
        "wide_numbers": wide_numbers,
        "last_by_arrival": last_by_arrival,
        "batch_overshoot": batch_overshoot,
        "empty_chunks": empty_chunks,
        "group_lists": group_lists_query,
        "checkpoint_upsert": checkpoint_upsert,
        "checkpoint_file": checkpoint_file,
        "checkpoint_lookup": checkpoint_lookup,
        "operation_labels": operation_labels,
        "table_lag": table_lag_query,
        "slots_of_consumers": slots_of_consumers,
        "config_numbers": config_numbers,
        "config_strings": config_strings,
        "stream_messages": stream_messages,
        "stream_batches": stream_batches_query,
        "sql_parse_chunks": sql_parse_chunks,
        "sql_decode_tuples": sql_decode_tuples,
        "value_round_trip": value_round_trip,
    }


def oracle_sql() -> dict[str, str]:
    return {name: _CHANGES + tail for name, tail in _TAILS.items()} | _WHOLE
