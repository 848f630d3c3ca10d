"""The live source against a stand-in that keeps a server's rules: commit order, whole transactions."""

import json
import random

import pytest

from tidelog.functions.frames import frame_bytes
from tidelog.sources import slot
from tidelog.sources.slot import SlotOffset, SlotStreamReader, Transaction, admit, transactions

from . import fake_slot


def _change(i):
    return frame_bytes("IUDT"[i % 4], i, i, i, "public", f"t{i % 3}", 7, b"x")


def _log(plan):
    """A log from (transaction, change or None for its commit) in order; positions rise by 16."""
    return [[fake_slot.text(16 * (k + 1)), xid, None if i is None else _change(i).hex()] for k, (xid, i) in enumerate(plan)]


def _in_commit_order(plan):
    open_, out = {}, []
    for xid, i in plan:
        if i is None:
            out += open_.pop(xid, [])
        else:
            open_.setdefault(xid, []).append(i)
    return out


class Slot:
    def __init__(self, spark, tmp_path, limit):
        self.spark, self.db, self.check, self.limit, self.batches = spark, tmp_path / "db.json", str(tmp_path / "check"), limit, []
        slot.register(spark)
        self.write([])

    def write(self, plan, **more):
        slots = json.loads(self.db.read_text())["slots"] if self.db.exists() else {}
        self.db.write_text(json.dumps({"slots": slots, "log": _log(plan)} | more))

    def run(self, fail_at=None, **options):
        stream = self.spark.readStream.format("tidelog_slot").options(dsn=str(self.db), driver="tests.fake_slot", slot="mine", maxChunksPerRead=self.limit, **options)

        def take(df, batch_id):
            if len(self.batches) == fail_at:
                raise RuntimeError("the sink is away")
            rows = [(r.seq, bytes(r.chunk)) for r in df.collect()]
            if rows:
                self.batches.append(sorted(rows))

        query = stream.load().writeStream.foreachBatch(take).option("checkpointLocation", self.check).start()
        try:
            query.processAllAvailable()
        except Exception:
            if fail_at is None:
                raise
        finally:
            query.stop()

    def sent(self):
        return [i for batch in self.batches for i in batch]


#: Transaction 1 has changes before those of 2 but commits after it.
INTERLEAVED = [(1, 0), (1, 1), (2, 2), (2, 3), (2, None), (3, 4), (1, 5), (1, None), (3, None)]


def test_interleaved_transactions_lose_nothing(spark, tmp_path):
    s = Slot(spark, tmp_path, 3)
    for n in range(1, len(INTERLEAVED) + 1):  # the log grows by an entry, the stream is started again each time
        s.write(INTERLEAVED[:n])
        s.run()
    assert [c for _, c in s.sent()] == [_change(i) for i in _in_commit_order(INTERLEAVED)]
    assert [n for n, _ in s.sent()] == list(range(6))
    assert max(map(len, s.batches)) <= 3


def test_a_transaction_longer_than_the_limit_is_cut(spark, tmp_path):
    plan = [(1, 0), (9, 100), (1, None), *[(2, i) for i in range(1, 12)], (9, 101), (2, None), (9, None), (4, None)]
    s = Slot(spark, tmp_path, 4)
    s.write(plan)
    s.run(fail_at=2)  # in the middle of the long one
    assert [len(b) for b in s.batches] == [1, 4]
    s.run()
    assert [c for _, c in s.sent()] == [_change(i) for i in _in_commit_order(plan)]
    assert [len(b) for b in s.batches] == [1, 4, 4, 3, 2] or [len(b) for b in s.batches][:3] == [1, 4, 4]
    assert max(map(len, s.batches)) <= 4
    state = json.loads(s.db.read_text())
    assert state["fetched"] <= 4  # only the changes of a part travel
    assert slot.position(state["slots"]["mine"]) <= slot.position(_log(plan)[-1][0])


def test_random_logs_with_restarts(spark, tmp_path):
    rng = random.Random(4)
    plan, open_, i = [], [], 0
    for xid in range(40):
        open_ += [xid] * rng.choice([1, 1, 2, 9])
    rng.shuffle(open_)
    left = {x: open_.count(x) for x in set(open_)}
    for xid in open_:
        plan.append((xid, i))
        i, left[xid] = i + 1, left[xid] - 1
        if not left[xid]:
            plan.append((xid, None))
    s, at = Slot(spark, tmp_path, 5), 0
    while at < len(plan):
        at += rng.randrange(1, 60)
        s.write(plan[:at])
        s.run(fail_at=len(s.batches) + 1 if rng.random() < 0.3 else None)
    s.run()
    assert [c for _, c in s.sent()] == [_change(i) for i in _in_commit_order(plan)]
    assert [n for n, _ in s.sent()] == list(range(i))


def test_start_and_end_positions(spark, tmp_path):
    s = Slot(spark, tmp_path, 100)
    s.write(INTERLEAVED)
    log = _log(INTERLEAVED)
    s.run(startingPosition=log[4][0], endingPosition=log[7][0])  # from the commit of 2 up to that of 1
    assert [c for _, c in s.sent()] == [_change(i) for i in (0, 1, 5)]
    s.run()  # the end was only that run's
    assert [c for _, c in s.sent()] == [_change(i) for i in (0, 1, 5, 4)]


def test_admission():
    there = [Transaction(10, 1, 3), Transaction(20, 6, 0), Transaction(30, 8, 9)]
    assert admit(there, SlotOffset(), 5) == SlotOffset(20, 0, 20, 3)
    assert admit(there, SlotOffset(20, 0, 20, 3), 5) == SlotOffset(30, 5, 20, 8)
    assert admit(there, SlotOffset(30, 5, 20, 8), 5) == SlotOffset(30, 9, 30, 12)
    assert admit(there, SlotOffset(30, 9, 30, 12), 5) == SlotOffset(30, 9, 30, 12)
    assert admit(there, SlotOffset(), None) == SlotOffset(30, 9, 30, 12)
    assert admit([], SlotOffset(), 5) == SlotOffset()
    assert transactions([(1, "0/1", 66), (5, "0/A", 67), (6, "0/B", 66)]) == [Transaction(10, 1, 3)]
    offset = SlotOffset(1 << 40, 3, 7, 9)
    assert SlotOffset.of(json.loads(json.dumps(offset.plain()))) == offset


def test_reader_never_goes_back(tmp_path):
    (tmp_path / "db.json").write_text(json.dumps({"slots": {"mine": "0/0"}, "log": _log(INTERLEAVED)}))
    reader = SlotStreamReader({"dsn": str(tmp_path / "db.json"), "driver": "tests.fake_slot", "slot": "mine"})
    reader.latestOffset()
    with pytest.raises(ValueError):
        reader.partitions(SlotOffset(90, 1, 90, 4).plain(), SlotOffset(100, 1, 100, 5).plain())
    reader.asked_from = None
    gone = reader.partitions(SlotOffset().plain(), SlotOffset(77, 1, 77, 1).plain())[0]
    with pytest.raises(ValueError):
        list(reader.read(gone))


def test_positions():
    assert slot.position("16/B374D848") == 0x16B374D848
    assert slot.position_text(0x16B374D848) == "16/B374D848"
    assert slot.position("0/0") == 0
