"""Sinks: a stream's output kept as a table at a path of the user's choice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from freshet.sources.epoch_table import EpochTable
from freshet.sources.keyed_table import BUCKETS, KeyedTable
from freshet.streaming.stream import EPOCH, Stream


class Sink:
    """Copies what the feed gained since the last delivery, each row once.

    Delivery *n* is commit *n* of the sink's table and says up to which epoch
    it reaches. Of several at the same time one gets the number; the others
    see how far it came and go on from there.
    """

    def __init__(self, spark: SparkSession, name: str, stream: Stream, path: str):
        self.name = name
        self.stream = stream
        self.table = EpochTable(spark, path, stream.schema, "delivery")
        self._tell()

    def _done(self) -> int | None:
        last = self.table.last()
        return self.table.entry(last)["upto"] if last is not None else None

    def _tell(self) -> None:
        done = self._done()
        self.stream.consumers.reach(f"sink {self.name}", -1 if done is None else done)

    def deliver(self) -> int:
        """Write the epochs not delivered yet; returns the rows written."""
        while True:
            newest, last = self.stream.feed.last(), self.table.last()
            done = self.table.entry(last)["upto"] if last is not None else None
            if newest is None or newest == done:
                return 0
            rows = self.stream.feed.read(after=done, upto=newest).drop(EPOCH)
            number, mark = (0 if last is None else last + 1), uuid.uuid4().hex
            entry = self.table.commit(rows, number, upto=newest, claimed_by=mark)
            if entry.get("claimed_by") == mark:
                self._tell()
                return entry["rows"]

    def read(self) -> DataFrame:
        return self.table.read().drop("delivery")


class UpsertSink:
    """Keeps the newest row per key of a stream that emits changes.

    A delivery merges the epochs since the last one; only buckets with changed
    keys are rewritten. Repeating a delivery changes nothing.
    """

    def __init__(
        self, spark: SparkSession, name: str, stream: Stream, path: str, keys: list[str], buckets: int = BUCKETS
    ):
        self.name = name
        self.stream = stream
        self.table = KeyedTable(spark, path, stream.feed.stored_schema, keys, EPOCH, buckets)
        self._tell()

    def _tell(self) -> None:
        done = self.table.upto
        self.stream.consumers.reach(f"sink {self.name}", -1 if done is None else done)

    def deliver(self) -> int:
        """Merge the epochs not delivered yet; returns the changed rows taken in."""
        newest, done = self.stream.feed.last(), self.table.upto
        if newest is None or newest == done:
            return 0
        self.table.merge(self.stream.feed.read(after=done, upto=newest), newest)
        self._tell()
        return self.stream.feed.rows_between(done, newest)

    def read(self) -> DataFrame:
        return self.table.read().drop(EPOCH)
