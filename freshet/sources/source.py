"""Declared sources: append-only typed tables that are also streams."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from freshet.errors import BAD_CONFIG, WRITER_CLOSED, fault
from freshet.functions.logical import check_schema
from freshet.operators.conform import RAW, REJECT, conform
from freshet.session import Storage
from freshet.sources.arrow_ipc import read_ipc_files, table_of, typed_failure
from freshet.sources.epoch_table import REFUSED, EpochTable
from freshet.sources.rows import ROW_ID, rows_frame

APPEND_ID = "append_id"
_HEARTBEAT = "_heartbeat"
_KEPT_BEATS = 100
REJECTED_ROW = "row"
# A file counts however old it is: copies and backfills keep old times.
_ANY_AGE = "365000d"
# Earlier than any event: a bound that keeps a filter above the watermark.
_BEFORE_ALL = dt.datetime(1, 1, 2)


# Bounds of what an epoch takes in when it is to follow the backlog, and the epochs a backlog is spread over.
LEAST_BYTES, MOST_BYTES, BACKLOG_EPOCHS = 64 * 1024 * 1024, 64 * 1024 * 1024 * 1024, 16


@dataclass(frozen=True)
class Admission:
    """What an epoch may take in of a source: a number of files, or bytes.

    ``BACKLOG`` bytes are a sixteenth of what the source holds when the query
    starts, within 64 MB and 64 GB. A file larger than the limit is an epoch's
    only one.
    """

    files: int | None = None
    bytes: int | None = None

    def __post_init__(self):
        if self.files and self.bytes:
            raise fault(BAD_CONFIG, "an epoch is bounded by files or by bytes, not by both")

    def limit(self, reader: DataStreamReader, held: Callable[[], int]) -> DataStreamReader:
        if self.files:
            return reader.option("maxFilesPerTrigger", self.files)
        if self.bytes == BACKLOG:
            share = held() // BACKLOG_EPOCHS
            return reader.option("maxBytesPerTrigger", min(max(share, LEAST_BYTES), MOST_BYTES))
        return reader.option("maxBytesPerTrigger", self.bytes) if self.bytes else reader


BACKLOG = -1


def _reader(session: SparkSession, schema: T.StructType) -> DataStreamReader:
    return session.readStream.schema(schema).option("maxFileAge", _ANY_AGE)


class Source:
    """Rows at ``path`` in a declared schema, read bounded or as a stream.

    This base class reads a table somebody else writes. ``path`` is a Parquet
    folder or a single file.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        path: str,
        watermark_column: str | None = None,
        delay: str = "0 seconds",
        heartbeat_path: str | None = None,
    ):
        if watermark_column is not None and watermark_column not in schema.names:
            raise fault(BAD_CONFIG, f"watermark column '{watermark_column}' is not a column of '{name}'")
        self._spark = spark
        self._storage = Storage(spark)
        self.name = name
        self.schema = schema
        self.path = path
        self.watermark_column = watermark_column
        self.delay = delay
        self.heartbeat_path = heartbeat_path
        if heartbeat_path:
            self._storage.mkdirs(heartbeat_path)

    # -- reading ---------------------------------------------------------

    def bounded(self) -> DataFrame:
        """The rows present now; the file listing is the snapshot."""
        return self._spark.read.schema(self.schema).parquet(self.path)

    @property
    def reads(self) -> str:
        """The folder a stream over this source lists, without its scheme."""
        folder = self.path.rsplit("/", 1)[0] if self._storage.is_file(self.path) else self.path
        return re.sub(r"^\w+:(//[^/]*)?", "", folder)

    def _held(self) -> int:
        return self._storage.size(self.path)

    def _rows_stream(self, session: SparkSession, admits: Admission) -> DataFrame:
        reader = admits.limit(_reader(session, self.schema), self._held)
        if self._storage.is_file(self.path):
            folder, name = self.path.rsplit("/", 1)
            return reader.option("pathGlobFilter", name).parquet(folder)
        # Folders named like partitions add columns that were not declared.
        return reader.parquet(self.path).select(*self.schema.names)

    def stream(
        self, session: SparkSession | None = None, max_files: int | None = None, max_bytes: int | None = None
    ) -> DataFrame:
        """The rows as a stream, with the declared watermark if there is one.

        Heartbeats join the rows below the watermark and leave above it. The
        dropping filter names the event-time column on purpose: one that does
        not would be pushed below the watermark, and a heartbeat would then
        advance nothing.
        """
        session = session or self._spark
        rows = self._rows_stream(session, Admission(max_files, max_bytes))
        if self.watermark_column is None:
            return rows
        time = self.watermark_column
        if not self.heartbeat_path:
            return rows.withWatermark(time, self.delay)
        beats = _reader(session, T.StructType([T.StructField("millis", T.LongType())]))
        beats = beats.option("ignoreMissingFiles", "true").json(self.heartbeat_path)
        beats = beats.select(F.timestamp_millis("millis").alias(time))
        blank = [
            F.col(time) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields
        ]
        both = rows.withColumn(_HEARTBEAT, F.lit(False)).unionByName(
            beats.select(*blank).withColumn(_HEARTBEAT, F.lit(True))
        )
        return (
            both.withWatermark(time, self.delay)
            .where(~F.col(_HEARTBEAT) | (F.col(time) < F.lit(_BEFORE_ALL).cast("timestamp")))
            .drop(_HEARTBEAT)
        )

    # -- event time ------------------------------------------------------

    def heartbeat(self, millis: int) -> None:
        """Advance event time to ``millis`` without a row."""
        if self.watermark_column is None or not self.heartbeat_path:
            raise fault(BAD_CONFIG, f"source '{self.name}' declares no watermark column")
        # The name carries the value too, so that reading it back is a listing.
        name = f"{millis}_{uuid.uuid4().hex[:12]}.json"
        self._storage.write_text(f"{self.heartbeat_path}/{name}", f'{{"millis": {millis}}}')
        beats = sorted(self._beats())
        if len(beats) > 2 * _KEPT_BEATS:
            # Only the furthest matters; a stream passes over files that went before it read them.
            for _, old in beats[:-_KEPT_BEATS]:
                self._storage.delete(f"{self.heartbeat_path}/{old}")

    def _beats(self) -> list[tuple[int, str]]:
        names = self._storage.names(self.heartbeat_path) if self.heartbeat_path else []
        return [(int(n.split("_")[0]), n) for n in names if n.endswith(".json") and not n.startswith("_")]

    def repeat_event_time(self) -> None:
        """Say again how far event time has come, for queries that start anew."""
        reached = self.explicit_watermark()
        if reached is not None:
            self.heartbeat(reached)

    def explicit_watermark(self) -> int | None:
        """The furthest heartbeat in epoch milliseconds."""
        return max((millis for millis, _ in self._beats()), default=None)


class StoredSource(Source):
    """A source this package also writes: every append is one commit."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        path: str,
        watermark_column: str | None = None,
        delay: str = "0 seconds",
    ):
        beats = f"{path}/heartbeats" if watermark_column else None
        super().__init__(spark, name, schema, f"{path}/data", watermark_column, delay, beats)
        self.table = EpochTable(spark, path, schema, APPEND_ID)

    def bounded(self, upto: int | None = None) -> DataFrame:
        """The rows accepted so far, or up to one append."""
        return self.table.read(upto=upto).drop(APPEND_ID)

    def _rows_stream(self, session: SparkSession, admits: Admission) -> DataFrame:
        self.table.settle()
        reader = admits.limit(_reader(session, self.table.stored_schema), self._held)
        return reader.parquet(self.path).drop(APPEND_ID)

    def watermark(self) -> int | None:
        """How far event time has come: newest row or heartbeat, in milliseconds."""
        newest, beat = self._newest_event(), self.explicit_watermark()
        known = [ms for ms in (newest // 1000 if newest is not None else None, beat) if ms is not None]
        return max(known) if known else None

    def repeat_event_time(self) -> None:
        reached = self.watermark()
        if reached is not None:
            self.heartbeat(reached)

    def _newest_event(self) -> int | None:
        """The newest event time of all appends, as the last entry has it."""
        last = self.table.last()
        if last is None:
            return None
        entry = self.table.entry(last)
        seen = [us for us in (entry["newest_before_us"], entry["max_event_us"]) if us is not None]
        return max(seen, default=None)

    # -- writing ---------------------------------------------------------

    def _judge_time(self) -> tuple[Column, Column | None]:
        """Event time, and whether a row is behind what event time has reached."""
        time, reached, late = F.col(self.watermark_column), self.watermark(), None
        if reached is not None:
            late = time < F.timestamp_millis(F.lit(reached)) - F.expr(f"INTERVAL {self.delay}")
        return time, late

    def _commit(self, df: DataFrame) -> dict:
        if self.watermark_column is None:
            return self.table.commit(df)
        time, late = self._judge_time()
        return self.table.commit(df, event_time=time, late=late)

    def append(self, df: DataFrame) -> int:
        """Append typed rows. Columns must match by name and type, in order."""
        check_schema(self.schema, df.schema)
        return self._commit(df)["rows"]

    def insert(self, rows: Iterable[Mapping[str, Any]]) -> int:
        """Append client rows, all or none. Returns the number of rows."""
        return self.insert_frame(rows_frame(self._spark, self.schema, rows), row_id=ROW_ID)

    def insert_frame(self, raw: DataFrame, row_id: str | None = None) -> int:
        """Conform a raw frame and append it, all or none, in one pass."""
        return self._commit(conform(raw, self.schema, row_id).strict)["rows"]

    def insert_accepted(self, raw: DataFrame, rejects_path: str, row_id: str | None = None) -> int:
        """Conform a raw frame, append what passes, keep the rejects aside.

        The judged rows are written once, and both outputs are taken from
        that, so a row is in one of them whatever ``raw`` would give when run
        again. The rejects go below ``rejects_path`` under the number of the
        append.
        """
        judged = f"{self.table.path}/judged/{uuid.uuid4().hex}"
        tagged = conform(raw, self.schema, row_id).tagged
        tagged.withColumn(REFUSED, F.col(REJECT).isNotNull()).write.partitionBy(REFUSED).parquet(judged)
        stored = T.StructType([*tagged.schema.fields, T.StructField(REFUSED, T.BooleanType())])
        rows = self._spark.read.schema(stored).parquet(judged)
        entry = self._commit(rows.where(~F.col(REFUSED)).select(*self.schema.names))
        refused = rows.where(REFUSED).select(
            f"{RAW}.*",
            *[F.col(f"{REJECT}.{part}").alias(f"reject_{part}") for part in ("column", "code", "reason")],
        )
        refused.write.mode("overwrite").parquet(f"{rejects_path}/{APPEND_ID}={entry[APPEND_ID]}")
        self._storage.delete(judged)
        return entry["rows"]

    def append_judged(self, raw: DataFrame, row_id: str | None = None, mark: str | None = None) -> dict:
        """Conform a raw frame and append what passes; the rejects stand beside it under the same number.

        One write stores both, tagged, and one log entry publishes both, so a
        row is in one of them and in neither before. ``mark`` goes into the
        entry, by which a repeated call can be recognised.
        """
        tagged = conform(raw, self.schema, row_id).tagged
        refused = F.col(REJECT).isNotNull()
        judged = tagged.select(
            *[F.col(f"`{name}`") for name in self.schema.names],
            F.when(refused, F.to_json(RAW)).alias(REJECTED_ROW),
            *[F.col(f"{REJECT}.{part}").alias(f"reject_{part}") for part in ("column", "code", "reason")],
            refused.alias(REFUSED),
        )
        if self.watermark_column is None:
            return self.table.commit_judged(judged, claimed_by=mark)
        return self.table.commit_judged(judged, *self._judge_time(), claimed_by=mark)

    def rejects(self) -> DataFrame:
        """Refused rows as JSON with the refusing column, code and reason, by the append they came with."""
        self.table.settle()
        names = f"{REJECTED_ROW} string, reject_column string, reject_code int, reject_reason string, {APPEND_ID} bigint"
        if not self._storage.exists(self.table.rejects_path):
            return self._spark.createDataFrame([], names)
        return self._spark.read.schema(names).parquet(self.table.rejects_path)

    def insert_arrow(self, payload: bytes) -> int:
        """Append a client-held Arrow IPC stream, all batches or none."""
        table = table_of(payload, self.schema)
        return self._commit(self._spark.createDataFrame(table, self.table.schema))["rows"]

    def insert_ipc_files(self, path: str) -> int:
        """Append a folder of Arrow IPC stream files, decoded on the executors."""
        try:
            rows = read_ipc_files(self._spark, path, self.schema)
        except Exception as error:  # the headers are read before any row
            raise typed_failure(error) from error
        return self._commit(rows)["rows"]

    def writer(self) -> Writer:
        return Writer(self)


class Writer:
    """Repeated appends to one source by one owner; ``close`` ends it."""

    def __init__(self, source: StoredSource):
        self._source = source
        self._closed = False
        self._watermark: int | None = None

    @property
    def name(self) -> str:
        return self._source.name

    @property
    def schema(self) -> T.StructType:
        return self._source.schema

    def _open(self) -> StoredSource:
        if self._closed:
            raise fault(WRITER_CLOSED, f"the writer of '{self._source.name}' was closed before")
        return self._source

    def write_rows(self, rows: Iterable[Mapping[str, Any]]) -> int:
        return self._open().insert(rows)

    def write_arrow(self, payload: bytes) -> int:
        return self._open().insert_arrow(payload)

    def write_frame(self, df: DataFrame) -> int:
        return self._open().append(df)

    def watermark(self, millis: int) -> None:
        """Advance the event time of the source."""
        source = self._open()
        if source.watermark_column is not None:
            source.heartbeat(millis)
        self._watermark = max(millis, self._watermark if self._watermark is not None else millis)

    def current_watermark(self) -> int | None:
        return self._watermark

    def close(self) -> None:
        self._closed = True


__all__ = ["APPEND_ID", "BACKLOG", "REJECTED_ROW", "Admission", "Source", "StoredSource", "Writer"]
