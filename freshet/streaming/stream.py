"""Named continuous queries that write a change feed."""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freshet.errors import WRONG_STATEMENT, fault
from freshet.session import Storage, stream_session
from freshet.sources.epoch_table import EpochTable
from freshet.sources.source import Source
from freshet.streaming.consumers import Consumers
from freshet.streaming.windows import refusal_by, refusal_of

EPOCH = "epoch"
Build = Callable[[dict[str, DataFrame]], DataFrame]
REPORT = "epoch bigint, source string, input_rows bigint, watermark_ms bigint, duration_ms bigint"
# State partitions of a stream that names none. The number stays with the
# stream's state for good; wide state on a large cluster wants more.
STATE_PARTITIONS = 8

# When a group's row is emitted: whenever it changes, or once its window closed.
CHANGES, ON_CLOSE = "changes", "on_close"
_MODES = {CHANGES: ("update",), ON_CLOSE: ("append",), None: ("append", "update")}


@dataclass(frozen=True)
class Checkpoint:
    """Outcome of one checkpoint: the epoch everything up to now is in."""

    success: bool
    checkpoint_id: int
    epoch: int
    duration_ms: int
    error: str | None = None


class Stream:
    """One continuous query over sources; its output is the change feed.

    ``query`` is a function of the source streams or SQL text over their
    names. Rows of micro-batch *n* are commit *n* of the feed, so replaying a
    batch after a failure writes the same commit and nothing twice.

    ``emit`` left open takes window-close emission where the query allows it
    and emission of changes elsewhere. A query with state writes a file per
    state partition and epoch; where its epochs are small and its state is
    wide, ``feed_files`` shuffles the output of an epoch into that many.
    ``max_files`` bounds the files of each source that one epoch takes in,
    ``max_bytes`` their size instead; ``BACKLOG`` lets that follow what waits.

    ``window`` is the window of a query given as a function, as SQL over a
    source's columns such as ``window(ts, '1 day')``; a query in SQL tells it
    itself. By it the rows that closed windows refused are counted.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        path: str,
        sources: list[Source],
        query: Build | str,
        emit: str | None = None,
        state_partitions: int = STATE_PARTITIONS,
        max_files: int | None = None,
        feed_time: str | None = None,
        feed_files: int | None = None,
        checkpoint_path: str | None = None,
        window: str | None = None,
        max_bytes: int | None = None,
    ):
        self._spark = spark
        self._storage = Storage(spark)
        self._session = stream_session(spark, state_partitions)
        self.name = name
        self.path = path
        self.sources = sources
        self.emit = emit
        self.sql = query if isinstance(query, str) else None
        self._feed_time = feed_time
        self._feed_files = feed_files
        self._checkpoint_path = checkpoint_path or f"{path}/checkpoint"
        inputs = {s.name: s.stream(self._session, max_files, max_bytes) for s in sources}
        if isinstance(query, str):
            for source_name, rows in inputs.items():
                rows.createOrReplaceTempView(source_name)
            self._output = self._session.sql(query)
        else:
            self._output = query(inputs)
        self.schema: T.StructType = self._output.schema
        self._pin()
        self._refusal = refusal_of(self._session, self.sql) if self.sql else None
        if window:
            self._refusal = refusal_by(self._session, window)
        self.feed = EpochTable(spark, f"{path}/feed", self.schema, EPOCH)
        self.consumers = Consumers(spark, f"{path}/consumers")
        self._query: StreamingQuery | None = None
        self._mode: str | None = None
        self._recorded = -1
        self.stopped = False
        # Called after each epoch is in the feed, and again if it is replayed.
        self.after_epoch: list[Callable[[], object]] = []

    def _pin(self) -> None:
        """Refuse another definition over the state of an earlier one."""
        definition = json.dumps(
            {
                "name": self.name,
                "sql": self.sql,
                "emit": self.emit,
                "sources": [s.name for s in self.sources],
                "columns": self.schema.simpleString(),
            },
            sort_keys=True,
        )
        pinned = f"{self.path}/definition.json"
        self._storage.mkdirs(self.path)
        if not self._storage.exists(pinned):
            self._storage.write_text(pinned, definition)
        elif self._storage.read_text(pinned) != definition:
            raise fault(WRONG_STATEMENT, f"stream '{self.name}' exists with another definition")

    # -- running ---------------------------------------------------------

    def _write(self, batch: DataFrame, epoch: int) -> None:
        """Put an epoch into the feed. A replayed one runs again and changes nothing.

        The epoch before has been reported by now; its report goes into this
        epoch's log entry, which is written anyway.
        """
        time_column = F.col(self._feed_time) if self._feed_time else None
        if self._feed_files:
            batch = batch.repartition(self._feed_files)
        reports = self._fresh_reports()
        self.feed.commit(batch, epoch, time_column, reports=reports, **self._begun(epoch))
        self._recorded = max([self._recorded, *(r["epoch"] for r in reports)])
        for call in self.after_epoch:
            call()

    def _begun(self, epoch: int) -> dict:
        """What the query's own log says of a micro-batch that runs: its watermark and what it reads up to.

        The query keeps only its last hundred entries; the feed keeps them all.
        Rows are late by the watermark of the batch before, which is what
        lets windows chained in one query agree.
        """
        now = self._storage.read_text(f"{self._checkpoint_path}/offsets/{epoch}").splitlines()
        offsets = [json.loads(line).get("logOffset") if line.startswith("{") else None for line in now[2:]]
        before = f"{self._checkpoint_path}/offsets/{epoch - 1}"
        late = None
        if epoch and self._storage.exists(before):
            late = json.loads(self._storage.read_text(before).splitlines()[1])["batchWatermarkMs"]
        return {"late_before_ms": late, "offsets": offsets}

    def _start(self, **trigger) -> StreamingQuery:
        modes = (self._mode,) if self._mode else _MODES[self.emit]
        for mode in modes:
            try:
                query = (
                    self._output.writeStream.queryName(f"{self.name}-{uuid.uuid4().hex[:8]}")
                    .outputMode(mode)
                    .option("checkpointLocation", self._checkpoint_path)
                    .trigger(**trigger)
                    .foreachBatch(self._write)
                    .start()
                )
                self._mode = mode
                return query
            except AnalysisException:
                if mode == modes[-1]:
                    raise
        raise AssertionError("no output mode")

    def start(self, interval_ms: int | None = None) -> None:
        """Run until stopped; a second call does nothing."""
        if not self.active:
            self._remind_sources()
            self._query = self._start(processingTime=f"{interval_ms or 0} milliseconds")
            self.stopped = False

    def run_available(self) -> Checkpoint:
        """Process what has arrived since the last run, then end (or wait, if running)."""
        began = time.monotonic()
        if self.active:
            self._query.processAllAvailable()
        else:
            self._remind_sources()
            self._query = self._start(availableNow=True)
            try:
                self._query.awaitTermination()
            finally:
                self._record()
                self._query = None
        epoch = self.feed.last()
        epoch = -1 if epoch is None else epoch
        return Checkpoint(True, epoch + 1, epoch, int((time.monotonic() - began) * 1000))

    def _remind_sources(self) -> None:
        """Repeat every source's event time to a query that starts again.

        Spark keeps only the minimum over sources across a restart. Without
        the reminder a source with nothing new would hold that minimum back.
        """
        timed = [s for s in self.sources if s.watermark_column]
        if len(timed) > 1:
            for source in timed:
                source.repeat_event_time()

    def stop(self) -> None:
        if self._query is not None:
            self._query.stop()
            self._record()
            self._query = None
        self.stopped = True

    @property
    def active(self) -> bool:
        return self._query is not None and self._query.isActive

    def failure(self) -> str | None:
        """Why the running query ended by itself, if it did."""
        if self._query is None or self._query.isActive:
            return None
        error = self._query.exception()
        return str(error) if error else None

    # -- progress --------------------------------------------------------

    def _fresh_reports(self) -> list[dict]:
        """Reports of the micro-batches that ended and are not saved yet."""
        out, reports = [], []
        if self._query is not None:
            newest = self._query.lastProgress
            # The list of all recent reports is only fetched if one was missed.
            follows = newest is not None and newest["batchId"] <= self._recorded + 1
            reports = [newest] if follows else self._query.recentProgress
        for p in reports:
            epoch = p["batchId"]
            if epoch <= self._recorded or not self.feed.has(epoch):
                continue  # saved before, or an idle report
            mark = (p["eventTime"] or {}).get("watermark")
            for source in self.sources:
                read = [r["numInputRows"] for r in p["sources"] if _folder(r["description"]) == source.reads]
                out.append(
                    {
                        "epoch": epoch,
                        "source": source.name,
                        "input_rows": max(read, default=0),
                        "watermark_ms": _iso_millis(mark),
                        "duration_ms": p["durationMs"].get("triggerExecution"),
                    }
                )
        return out

    def _record(self) -> None:
        """Save what is left when a query ends: the reports no later epoch carries."""
        reports = self._fresh_reports()
        if reports:
            self._storage.mkdirs(f"{self.path}/progress")
            lines = "\n".join(json.dumps(r) for r in reports)
            self._storage.write_text(f"{self.path}/progress/{uuid.uuid4().hex}.json", lines)
            self._recorded = max(r["epoch"] for r in reports)

    def progress(self) -> DataFrame:
        """One row per micro-batch that ended and source: rows in, watermark, duration."""
        self._record()
        self._storage.mkdirs(f"{self.path}/progress")
        ended = self._spark.read.schema(REPORT).json(f"{self.path}/progress")
        carried = self.feed.log().select(F.inline("reports"))
        reported = carried.unionByName(ended).withColumn("stream", F.lit(self.name))
        return reported.groupBy("stream", EPOCH, "source").agg(
            F.max("input_rows").alias("input_rows"),
            F.max("watermark_ms").alias("watermark_ms"),
            F.max("duration_ms").alias("duration_ms"),
        )


    # -- state -----------------------------------------------------------

    @property
    def checkpoint_path(self) -> str:
        return self._checkpoint_path

    def state_reader(self) -> DataFrameReader:
        """A reader of the query's state, in the session whose store settings wrote it."""
        return self._session.read.format("statestore")

    # -- what each epoch took in and refused ------------------------------

    def _read_upto(self) -> DataFrame:
        """``epoch``, ``input`` and the offset of that input up to which the epoch read."""
        return self.feed.log().select(EPOCH, F.posexplode("offsets").alias("input", "read_upto"))

    def taken(self) -> DataFrame:
        """``epoch``, ``input`` (the number of a source in the query) and ``file``: what each epoch took in.

        The query's log of files gives each the offset it was found at; the
        feed's log says which offsets an epoch covers.
        """
        self._storage.mkdirs(f"{self._checkpoint_path}/sources")
        logs = self._spark.read.schema("path string, batchId bigint").option("recursiveFileLookup", "true").json(
            f"{self._checkpoint_path}/sources"
        )
        files = logs.where("path IS NOT NULL").select(
            F.regexp_extract(F.col("_metadata.file_path"), r"/sources/(\d+)/", 1).cast("int").alias("input"),
            F.col("batchId").alias("offset"),
            F.element_at(F.split("path", "/"), -1).alias("file"),
        )
        # Entries stand in a compacted log and, for a while, in the small ones before it.
        files = files.distinct()
        # An offset belongs to the first epoch that reads at least up to it.
        ends = self._read_upto().groupBy("input", F.col("read_upto").alias("offset")).agg(F.min(EPOCH).alias(EPOCH))
        order = Window.partitionBy("input").orderBy(F.desc("offset"))
        spans = ends.withColumn("after", F.lead("offset", 1, -1).over(order))
        found = files.join(spans.withColumnRenamed("offset", "upto"), "input")
        return found.where((F.col("offset") > F.col("after")) & (F.col("offset") <= F.col("upto"))).select(EPOCH, "input", "file")

    def lineage(self) -> DataFrame:
        """``epoch``, ``source`` and the appends it took in, from ``first`` to ``last``, with the number of ``files``.

        Two epochs share an append if one took some of its files and the next
        the others.
        """
        parts = []
        for source in self.sources:
            key = getattr(getattr(source, "table", None), "key", None)
            if key is None:
                continue
            listed = (
                self._spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet")
                .load(source.path)
                .select(
                    F.regexp_extract("path", rf"{key}=(\d+)/", 1).cast("bigint").alias(key),
                    F.element_at(F.split("path", "/"), -1).alias("file"),
                )
            )
            own = self.taken().join(listed, "file").groupBy(EPOCH).agg(
                F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("files")
            )
            parts.append(own.select(EPOCH, F.lit(source.name).alias("source"), "first", "last", "files"))
        if not parts:
            names = f"{EPOCH} bigint, source string, first bigint, last bigint, files bigint"
            return self._spark.createDataFrame([], names)
        return reduce(DataFrame.unionByName, parts)

    def epoch_as_of(self, source: str, append: int) -> int | None:
        """The last epoch that holds nothing beyond an append of a source; None if there is none."""
        within = self.lineage().where((F.col("source") == source) & (F.col("last") <= append))
        return within.agg(F.max(EPOCH).alias("e")).first()["e"]

    def _count_refused(self, after: int, upto: int) -> dict[int, int]:
        """Refused rows of the epochs in ``(after, upto]``, read from those epochs' files alone."""
        epochs = self.feed.log().where((F.col(EPOCH) > after) & (F.col(EPOCH) <= upto))
        marks = epochs.where("late_before_ms IS NOT NULL").select(EPOCH, "late_before_ms")
        files = self.taken().where(F.col(EPOCH) > after).join(marks, EPOCH).select("file", EPOCH, "late_before_ms")
        total: dict[int, int] = {}
        for source in self.sources:
            rows = self._refusal.closing(source, self._spark)
            if rows is None:
                continue
            late = rows.join(files, "file").where(F.col("closes_us") <= F.col("late_before_ms") * 1000)
            for r in late.groupBy(EPOCH).count().collect():
                total[r[EPOCH]] = total.get(r[EPOCH], 0) + r["count"]
        return total

    def refused(self) -> DataFrame:
        """``epoch`` and ``refused_rows``: rows that came when their window had closed.

        Each epoch is counted once, when first asked for, and the count kept.
        A query without windows refuses none.
        """
        folder, last = f"{self.path}/refused", self.feed.last()
        self._storage.mkdirs(folder)
        if self._refusal is not None and last is not None:
            done = max((int(n[:-5]) for n in self._storage.names(folder) if n[:-5].isdigit()), default=-1)
            if done < last:
                found = self._count_refused(done, last)
                lines = [json.dumps({EPOCH: e, "refused_rows": n}) for e, n in sorted(found.items())]
                self._storage.create_once(f"{folder}/{last}.json", "\n".join(lines))
        return self._spark.read.schema(f"{EPOCH} bigint, refused_rows bigint").json(folder)

    # -- retention -------------------------------------------------------

    def retain(self, keep: int, older_than_ms: int | None = None, override: bool = False) -> int:
        """Drop epochs beyond the newest ``keep`` that no consumer needs; returns how many.

        With ``older_than_ms`` only epochs committed that long ago are
        dropped. ``override`` drops them though a consumer still needs them;
        it then fails with 502.
        """
        bounds = []
        if not override:
            bounds += [e for e in [self.consumers.least()] if e is not None]
        if older_than_ms is not None:
            old = F.col("committed_ms") <= int(time.time() * 1000) - older_than_ms
            oldest = self.feed.log().where(old).agg(F.max(EPOCH).alias("e")).first()["e"]
            bounds.append(-1 if oldest is None else oldest)
        return self.feed.retain(keep, min(bounds, default=None))


def _folder(description: str) -> str:
    """The folder a file source of a query reads, without its scheme."""
    return re.sub(r"^\w+:(//[^/]*)?", "", description.partition("[")[2].rstrip("]"))


def _iso_millis(text: str | None) -> int | None:
    if not text:
        return None
    moment = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return int(moment.timestamp() * 1000)
