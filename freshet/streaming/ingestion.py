"""Live ingestion: raw rows that keep arriving, conformed into a source.

Each micro-batch is judged by the strict rules and written once, accepted and
refused rows apart; one entry of the source's log publishes both. The entry
carries the batch's mark. A batch that runs again looks for its mark after the
place where it first meant to append, and appends only if none is there, so
each row arrives once whatever died in between.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.session import Storage, stream_session
from freshet.sources.source import StoredSource
from freshet.streaming.stream import Checkpoint

# Like sources: a file counts however old it is.
_ANY_AGE = "365000d"


def files_arriving(
    path: str, columns: str, form: str = "json", max_files: int | None = None, **options: str
) -> Callable[[SparkSession], DataFrame]:
    """Raw rows of files that appear below ``path``, in the raw ``columns``."""

    def read(session: SparkSession) -> DataFrame:
        if not any(c in path for c in "*?[{"):
            Storage(session).mkdirs(path)
        reader = session.readStream.format(form).schema(columns).option("maxFileAge", _ANY_AGE).options(**options)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(path)

    return read


class Ingestion:
    """A streaming query that appends what it reads to one source.

    ``raw`` makes the stream of raw rows in the session it is given. ``path``
    holds the checkpoint and the batches' intents. ``row_id`` names a raw
    column that identifies a row in the reason of its refusal.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        source: StoredSource,
        raw: Callable[[SparkSession], DataFrame],
        path: str,
        row_id: str | None = None,
    ):
        self._storage = Storage(spark)
        self.name = name
        self.source = source
        self._rows = raw(stream_session(spark))
        self._path = path
        self._row_id = row_id
        self._query: StreamingQuery | None = None
        self._storage.mkdirs(f"{path}/intents")
        # Names this ingestion in the logs of sources, for good.
        self._storage.create_once(f"{path}/identity.json", json.dumps({"id": uuid.uuid4().hex}))
        self._id = json.loads(self._storage.read_text(f"{path}/identity.json"))["id"]

    def _take(self, batch: DataFrame, number: int) -> None:
        table, mark = self.source.table, f"{self._id}/{number}"
        intent = f"{self._path}/intents/{number}.json"
        if not self._storage.create_once(intent, json.dumps({"after": table.last()})):
            meant = json.loads(self._storage.read_text(intent))
            if table.claimed(mark, meant["after"]) is not None:
                return
        self.source.append_judged(batch, self._row_id, mark)
        # A batch never runs again once its successor has begun.
        for name in self._storage.names(f"{self._path}/intents"):
            if name.endswith(".json") and int(name[:-5]) < number - 1:
                self._storage.delete(f"{self._path}/intents/{name}")

    def _start(self, **trigger) -> StreamingQuery:
        writer = self._rows.writeStream.queryName(f"{self.name}-{uuid.uuid4().hex[:8]}").outputMode("append")
        writer = writer.option("checkpointLocation", f"{self._path}/checkpoint").trigger(**trigger)
        return writer.foreachBatch(self._take).start()

    def start(self, interval_ms: int | None = None) -> None:
        """Run until stopped; a second call does nothing."""
        if not self.active:
            self._query = self._start(processingTime=f"{interval_ms or 0} milliseconds")

    def run_available(self) -> Checkpoint:
        """Take in what has arrived since the last run; the outcome names the source's newest append."""
        began = time.monotonic()
        if self.active:
            self._query.processAllAvailable()
        else:
            self._start(availableNow=True).awaitTermination()
        last = self.source.table.last()
        last = -1 if last is None else last
        return Checkpoint(True, last + 1, last, int((time.monotonic() - began) * 1000))

    def stop(self) -> None:
        if self._query is not None:
            self._query.stop()
            self._query = None

    @property
    def active(self) -> bool:
        return self._query is not None and self._query.isActive

    def failure(self) -> str | None:
        """Why the running query ended by itself, if it did."""
        if self._query is None or self._query.isActive:
            return None
        error = self._query.exception()
        return str(error) if error else None

    def totals(self) -> DataFrame:
        """``accepted`` and ``refused`` rows of this ingestion, from the source's log."""
        own = self.source.table.log().where(F.startswith(F.col("claimed_by"), F.lit(f"{self._id}/")))
        zero = F.lit(0).cast("bigint")
        return own.agg(
            F.coalesce(F.sum("rows"), zero).alias("accepted"), F.coalesce(F.sum("rejected_rows"), zero).alias("refused")
        )
