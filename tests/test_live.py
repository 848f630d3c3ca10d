"""The live source against a stand-in database, and the start command."""

import json

from tidelog import __main__ as command
from tidelog.config import AppConfig, LoggingConfig, PostgresConfig, StateConfig
from tidelog.functions.frames import frame_bytes
from tidelog.sources.checkpoint import CheckpointStore
from tidelog.sources.replication import write_segment

from .fake_slot import text


def _change(i):
    # Every third position has two chunks.
    return f"{i // 3}/{16 * (2 * i // 3) + 1:X}", frame_bytes("IUD"[i % 3], i, i // 2, i, "public", f"t{i % 2}").hex()


def test_command_sends_what_is_there(spark, tmp_path):
    write_segment(str(tmp_path / "slot"), 0, [bytes.fromhex(_change(i)[1]) for i in range(12)])
    config = AppConfig(logging=LoggingConfig(str(tmp_path / "logs"), "info"))
    args = ["--source", "segments", "--sink", "parquet", "--path", str(tmp_path / "slot"), "--out", str(tmp_path / "out"), "--state", str(tmp_path / "state"), "--once"]
    assert command.main(args, spark, config) == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 12
    said = (tmp_path / "logs" / "wal-writer.log").read_text()
    assert "starting" in said and "'messages_sent': 12" in said and config.postgres.connection_string() not in said


def test_command_ends_with_an_error(spark, tmp_path):
    path = write_segment(str(tmp_path / "slot"), 0, [bytes.fromhex(_change(i)[1]) for i in range(3)])
    with open(path, "r+b") as f:
        f.truncate(40)
    config = AppConfig(logging=LoggingConfig(str(tmp_path / "logs"), "error"))
    args = ["--source", "segments", "--sink", "parquet", "--path", str(tmp_path / "slot"), "--out", str(tmp_path / "out"), "--state", str(tmp_path / "state"), "--once"]
    assert command.main(args, spark, config) == 1
    assert "the stream failed" in (tmp_path / "logs" / "wal-writer.log").read_text()


def _slot_log(path, n, every=7):
    """``n`` changes in transactions of up to ``every``, all committed."""
    log = []
    for i in range(n):
        log.append([text(16 * (i + i // every) + 16), i // every, frame_bytes("IUD"[i % 3], i, i // 2, i, "public", f"t{i % 2}").hex()])
        if i % every == every - 1 or i == n - 1:
            log.append([text(16 * (i + i // every) + 32), i // every, None])
    path.write_text(json.dumps({"slots": {}, "log": log}))


def test_command_drains_the_slot(spark, tmp_path, monkeypatch):
    """25,000 chunks are more than two micro-batches admit."""
    _slot_log(tmp_path / "db.json", 25_000)
    monkeypatch.setattr(PostgresConfig, "connection_string", lambda self: str(tmp_path / "db.json"))
    config = AppConfig(logging=LoggingConfig(str(tmp_path / "logs"), "info"), state=StateConfig(str(tmp_path / "position")))
    args = ["--source", "slot", "--driver", "tests.fake_slot", "--sink", "parquet", "--out", str(tmp_path / "out"), "--state", str(tmp_path / "state"), "--once"]
    assert command.main(args, spark, config) == 0
    sent = spark.read.parquet(f"{tmp_path}/out")
    assert sent.count() == sent.select("seq").distinct().count() == 25_000
    assert sent.agg({"batch": "max"}).first()[0] == 250  # the first two micro-batches end in the middle of a batch
    assert CheckpointStore(str(tmp_path / "position"), spark).load().get("wal_writer_slot") == "0/24999"


def test_start_from_the_stored_position_alone(spark, tmp_path):
    """Spark's offsets are gone: the source starts after the stored position, and opens no segment before it."""
    folder = tmp_path / "slot"
    for k in range(5):
        write_segment(str(folder), 10 * k, [frame_bytes("I", 100 + i, i, i, "public", "t") for i in range(10 * k, 10 * k + 10)])
    config = AppConfig(logging=LoggingConfig(str(tmp_path / "logs"), "info"), state=StateConfig(str(tmp_path / "position")))
    CheckpointStore(str(tmp_path / "position"), spark).open().persist("wal_writer_slot", "0/133")
    before = sorted(folder.iterdir())
    for path in before[:3]:  # a segment that is opened would fail
        path.write_bytes(b"\0\0\0\7abc")
    args = ["--source", "segments", "--sink", "parquet", "--path", str(folder), "--out", str(tmp_path / "out"), "--state", str(tmp_path / "state"), "--once"]
    assert command.main(args, spark, config) == 0
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(34, 50))
