"""Materialized views: the latest state of a stream, folded now and then."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.sources.keyed_table import BUCKETS, KeyedTable
from freshet.streaming.feed import latest
from freshet.streaming.state import state_rows
from freshet.streaming.stream import EPOCH, Stream


class MaterializedView:
    """The newest row per key of a stream that emits changes.

    Reading merges the last fold with the feed after it. ``fold`` merges the
    epochs since then into the state, rewriting only the buckets whose keys
    changed; after that the feed may drop those epochs. Until then the view
    holds them as a consumer of the feed.
    """

    def __init__(self, spark: SparkSession, stream: Stream, keys: list[str], buckets: int = BUCKETS):
        self._spark = spark
        self.stream = stream
        self.keys = keys
        self.state = KeyedTable(
            spark, f"{stream.path}/folds", stream.feed.stored_schema, keys, EPOCH, buckets
        )
        self._told = f"view by {','.join(keys)}"
        self._tell(self.state.upto)

    def _tell(self, upto: int | None) -> None:
        """Say how far the view needs the feed no more."""
        self.stream.consumers.reach(self._told, -1 if upto is None else upto)

    def read(self) -> DataFrame:
        version = self.state.version()
        fresh = self.stream.feed.read(after=version["upto"])
        return latest(self.state._read(version).unionByName(fresh), self.keys)

    def fold(self) -> int | None:
        """Bring the state up to the newest epoch; returns that epoch."""
        upto, before = self.stream.feed.last(), self.state.upto
        if upto is None or upto == before:
            return before
        self.state.merge(self.stream.feed.read(after=before, upto=upto), upto)
        self._tell(upto)
        return upto

    def updates(self) -> DataFrame:
        """Changed rows applied so far."""
        return self.stream.feed.log().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("mv_updates"))

    def bytes_stored(self) -> DataFrame:
        """Size of the files that hold the view: its state, and the epochs of the feed after it."""
        size = self.state.bytes_stored() + self.stream.feed.bytes_stored(after=self.state.upto)
        return self._spark.createDataFrame([(size,)], "mv_bytes_stored bigint")

    def rebuild(self, columns: Mapping[str, str]) -> int:
        """Make the view anew from the running query's own state, for a feed that is gone; returns the epoch.

        ``columns`` tells each column of the stream as SQL over the state's
        ``key`` and ``value``.
        """
        upto = self.stream.feed.last()
        upto = -1 if upto is None else upto
        rows = state_rows(self.stream, upto).select(*[F.expr(sql).alias(name) for name, sql in columns.items()])
        self.state.replace(rows.withColumn(EPOCH, F.lit(upto).cast("bigint")), upto)
        self._tell(upto)
        return upto
