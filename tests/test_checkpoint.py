"""The fenced store of positions."""

import json
import threading

import pytest

from tidelog.sources.checkpoint import FILE_NAME, CheckpointStore, StaleWriter, furthest, read_checkpoint


@pytest.fixture()
def stores(spark, tmp_path):
    """The same folder as a path of another file system than ``file:``."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.state.link./here", f"file://{tmp_path}")
    return "viewfs://state/here/deep/er", tmp_path / "deep" / "er"


def test_store_in_another_file_system(spark, stores):
    url, path = stores
    store = CheckpointStore(url, spark).load()
    assert store.start("s") == "0/0"
    store.persist("s", "1/703", now=1704067200)
    store.persist("s2", "0/1", now=5)
    assert json.loads((path / FILE_NAME).read_text()) == {"s": {"last_lsn": "1/703", "last_commit_time": 1704067200}, "s2": {"last_lsn": "0/1", "last_commit_time": 5}}
    assert CheckpointStore(url, spark).load().start("s") == "1/703"
    assert {tuple(r) for r in read_checkpoint(spark, f"{url}/{FILE_NAME}").collect()} == {("s", "1/703", 1704067200), ("s2", "0/1", 5)}
    assert not [x for x in path.iterdir() if x.name.endswith(".new")]


def test_the_older_of_two_writers_is_refused(spark, tmp_path):
    old = CheckpointStore(str(tmp_path), spark).load()
    old.persist("s", "0/5", now=1)
    new = CheckpointStore(str(tmp_path), spark).load().open()
    with pytest.raises(StaleWriter):
        old.persist("s", "0/9", now=2)
    assert CheckpointStore(str(tmp_path), spark).load().get("s") == "0/5"
    new.persist("s", "0/7", now=3)
    assert CheckpointStore(str(tmp_path), spark).load().get("s") == "0/7"
    third = CheckpointStore(str(tmp_path), spark).open()
    assert third.get("s") == "0/7"
    with pytest.raises(StaleWriter):
        new.persist("s", "0/8")


def test_a_position_never_moves_back(spark, tmp_path):
    store = CheckpointStore(str(tmp_path), spark).open()
    store.persist("s", "1/0", now=1)
    store.persist("s", "0/4294967295", now=2)
    assert store.get("s") == "1/0"
    (tmp_path / FILE_NAME).write_text('{"s":{"last_lsn":"0/9","last_commit_time":1}}')  # a late write of an older one
    assert CheckpointStore(str(tmp_path), spark).load().get("s") == "1/0"
    assert furthest({"a": {"last_lsn": "0/10"}}, {"a": {"last_lsn": "0/9"}}) == {"a": {"last_lsn": "0/10"}}


def test_of_many_writers_at_once_each_has_its_generation(spark, tmp_path):
    stores = [CheckpointStore(str(tmp_path), spark) for _ in range(6)]
    threads = [threading.Thread(target=s.open) for s in stores]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    generations = sorted(s.generation for s in stores)
    assert len(set(generations)) == 6
    refused = 0
    for s in sorted(stores, key=lambda s: s.generation):
        try:
            s.persist("s", f"0/{s.generation}")
        except StaleWriter:
            refused += 1
    assert refused == 5


def test_broken_files_stop_the_reader(spark, tmp_path):
    for text in ("{broken", "[]", '{"s":{"last_lsn":"x","last_commit_time":1}}', '{"s":1}', ""):
        (tmp_path / FILE_NAME).write_text(text)
        with pytest.raises(ValueError):
            CheckpointStore(str(tmp_path), spark).load()


def test_a_position_may_be_written_later(spark, tmp_path):
    store = CheckpointStore(str(tmp_path), spark).open()
    store.persist("s", "0/3", write=False)
    assert store.get("s") == "0/3" and CheckpointStore(str(tmp_path), spark).load().get("s") is None
    store.flush()
    assert CheckpointStore(str(tmp_path), spark).load().get("s") == "0/3"
    before = (tmp_path / FILE_NAME).stat().st_mtime_ns
    store.flush()  # nothing has moved
    assert (tmp_path / FILE_NAME).stat().st_mtime_ns == before
