"""Resume positions: a JSON map of slots, and the filter that resumes from one.

Spark's own offset log is what recovers a stream. The file ``wal_position.json`` keeps the
format that other tools read, in any store that Spark reaches. It is written whole under
another name and then renamed over; a file that can't be read stops the reader, as starting
again from nothing would repeat everything.

Writers are fenced by generation: opening a store for writing takes the next generation by
creating its file, which only one writer can. A writer keeps its positions in that file and
publishes them; one that finds a later generation is refused. Should it find out only after
it has published, its positions still can't win: a reader takes the furthest of all
generations, so a position never moves back.
"""

from __future__ import annotations

import json
import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binary import lsn_text, lsn_value
from ..schema import CHECKPOINT, DEFAULT_POSITION
from .files import Folder

FILE_NAME = "wal_position.json"
_GENERATION = re.compile(r"wal_position\.([0-9]{12})\.json")


class StaleWriter(RuntimeError):
    """Another writer has taken over the store."""


def position_number(text: str) -> int:
    """Number of a position as the file has it: two decimal halves."""
    high, low = text.split("/")
    return int(high) << 32 | int(low)


def parse_positions(text: str, name: str) -> dict[str, dict]:
    try:
        found = {k: {"last_lsn": str(v["last_lsn"]), "last_commit_time": int(v["last_commit_time"])} for k, v in json.loads(text).items()}
        for state in found.values():
            position_number(state["last_lsn"])
    except (ValueError, TypeError, KeyError, AttributeError) as e:
        raise ValueError(f"{name} is no checkpoint: {e}") from e
    return found


def furthest(*maps: dict[str, dict]) -> dict[str, dict]:
    """Of each slot the state with the largest position."""
    out: dict[str, dict] = {}
    for positions in maps:
        for slot, state in positions.items():
            if slot not in out or position_number(state["last_lsn"]) > position_number(out[slot]["last_lsn"]):
                out[slot] = state
    return out


class CheckpointStore:
    """Positions by slot; in memory alone without a folder (which needs a session)."""

    def __init__(self, state_dir: str | None = None, spark: SparkSession | None = None):
        self.folder = Folder(spark or SparkSession.active(), state_dir) if state_dir else None
        self.positions: dict[str, dict] = {}
        self.generation: int | None = None
        self.unwritten = False

    def _generations(self) -> list[int]:
        return sorted(int(m[1]) for m in map(_GENERATION.fullmatch, self.folder.names()) if m)

    @staticmethod
    def _name(generation: int) -> str:
        return f"wal_position.{generation:012d}.json"

    def load(self) -> CheckpointStore:
        """Read the positions, if there are any."""
        if self.folder:
            names = [FILE_NAME, *map(self._name, self._generations())]
            texts = [(n, self.folder.read(n)) for n in names if self.folder.exists(n)]
            # A generation that was taken and not written yet is an empty file.
            self.positions = furthest(*[parse_positions(t, f"{self.folder.path}/{n}") for n, t in texts if t or n == FILE_NAME])
        return self

    def _take(self) -> None:
        """Become the writer: of those who try at once, one gets a generation, the others the ones after it."""
        while self.generation is None:
            taken = self._generations()
            following = (taken[-1] if taken else 0) + 1
            if self.folder.create(self._name(following)):
                self.generation = following
                self.positions = furthest(self.positions, CheckpointStore._read(self))
                for old in taken[:-1]:  # the one before may still be read; those before it are in the published file
                    self.folder.delete(self._name(old))

    def _read(self) -> dict[str, dict]:
        other = CheckpointStore()
        other.folder = self.folder
        return other.load().positions

    def _alone(self) -> None:
        taken = self._generations()
        if taken and taken[-1] > self.generation:
            raise StaleWriter(f"{self.folder.path}: generation {taken[-1]} has taken over from {self.generation}")

    def open(self) -> CheckpointStore:
        """Read the positions and become the writer: whoever was it before is refused from now on."""
        if self.folder:
            self._take()
        return self

    def get(self, slot: str) -> str | None:
        return self.positions.get(slot, {}).get("last_lsn")

    def start(self, slot: str) -> str:
        """Where the slot starts: its position, else the beginning."""
        return self.get(slot) or DEFAULT_POSITION

    def persist(self, slot: str, last_lsn: str, now: int | None = None, *, write: bool = True) -> None:
        """Move a slot to a position and (or later, by :meth:`flush`) write the files; one that isn't further leaves it where it is."""
        state = {"last_lsn": last_lsn, "last_commit_time": int(time.time()) if now is None else now}
        self.positions = furthest(self.positions, {slot: state})
        self.unwritten = True
        if write:
            self.flush()

    def flush(self) -> None:
        """Write what has moved."""
        if not self.folder or not self.unwritten:
            return
        self._take()
        self._alone()
        text = json.dumps(self.positions, separators=(",", ":"))
        self.folder.replace(self._name(self.generation), text)
        self.folder.replace(FILE_NAME, text)
        self._alone()
        self.unwritten = False


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """``slot, last_lsn, last_commit_time`` of a checkpoint file."""
    return positions_of(spark.read.text(path, wholetext=True))


def positions_of(texts: DataFrame) -> DataFrame:
    """``slot, last_lsn, last_commit_time`` of JSON maps in the column ``value``; a broken one is an error."""
    slots = texts.select(F.explode(F.from_json("value", CHECKPOINT, {"mode": "FAILFAST"})).alias("slot", "state"))
    return slots.select("slot", "state.last_lsn", "state.last_commit_time")


def checkpoint_json(latest: DataFrame) -> DataFrame:
    """One row with the JSON map of ``slot, last_lsn, last_commit_time`` rows, one a slot."""
    entry = F.struct(F.col("slot"), F.struct("last_lsn", "last_commit_time"))
    return latest.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))


def latest_position(batched: DataFrame, slot: str) -> DataFrame:
    """``slot, last_lsn``: the last record by arrival of the last batch wins."""
    last = F.max_by("lsn", F.struct("batch_id", "seq", "idx"))
    return batched.agg(last.alias("lsn")).where(F.col("lsn").isNotNull()).select(F.lit(slot).alias("slot"), lsn_text(F.col("lsn")).alias("last_lsn"))


def latest_by_slot(updates: DataFrame) -> DataFrame:
    """``slot, last_lsn, last_commit_time`` of the last of many updates, by ``batch_id``."""
    return updates.groupBy("slot").agg(F.max_by(F.struct("last_lsn", "last_commit_time"), "batch_id").alias("s")).select("slot", "s.*")


def start_positions(wanted: DataFrame, latest: DataFrame) -> DataFrame:
    """``slot_name, start`` of each wanted slot: its last position, else the beginning."""
    known = latest.select(F.col("slot").alias("slot_name"), "last_lsn")
    return wanted.join(known, "slot_name", "left").select("slot_name", F.coalesce("last_lsn", F.lit(DEFAULT_POSITION)).alias("start"))


def resume_after(records: DataFrame, position: str | Column = DEFAULT_POSITION) -> DataFrame:
    """Records after a position. A comparison of numbers, so it reaches the scan of a stored table."""
    start = lsn_value(F.lit(position) if isinstance(position, str) else position)
    return records.where(F.col("lsn") > start)
