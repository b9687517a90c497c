"""The user's handle: declare, ingest, query, subscribe, observe."""

from __future__ import annotations

import itertools
import json
import re
import time
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import (
    BAD_CONFIG,
    CLOSED,
    INVALID_SQL,
    UNKNOWN_NAME,
    UNSUPPORTED,
    WRONG_STATEMENT,
    FreshetError,
    fault,
)
from freshet.functions.logical import describe, parse_columns
from freshet.functions.parsed import parsed, tables
from freshet.operators.metrics import pipeline_totals, source_metrics, stream_metrics
from freshet.operators.results import Result, ResultStream
from freshet.session import Storage, fresh_path, stream_session
from freshet.sources.source import StoredSource, Writer
from freshet.streaming.ingestion import Ingestion, files_arriving
from freshet.streaming.sink import Sink, UpsertSink
from freshet.streaming.stream import CHANGES, STATE_PARTITIONS, Build, Checkpoint, Stream
from freshet.streaming.subscription import Frame, PushSubscription, Subscription
from freshet.streaming.view import MaterializedView

MEMORY = ":memory:"
_CONCURRENT_STREAMS = 8
_NAME = r"`?([A-Za-z_]\w*)`?"
_CREATE_SOURCE = re.compile(rf"\s*CREATE\s+SOURCE\s+{_NAME}\s*\((.*)\)\s*;?\s*$", re.I | re.S)
_CREATE_STREAM = re.compile(rf"\s*CREATE\s+STREAM\s+{_NAME}\s+AS\s+(.*?);?\s*$", re.I | re.S)
_INSERT = re.compile(rf"\s*INSERT\s+INTO\s+{_NAME}\s+((?:SELECT|VALUES|WITH|TABLE|FROM)\b.*?);?\s*$", re.I | re.S)
_SHOW = re.compile(r"\s*SHOW\s+(SOURCES|STREAMS|SINKS)\s*;?\s*$", re.I)
_DESCRIBE = re.compile(rf"\s*DESC(?:RIBE)?\s+{_NAME}\s*;?\s*$", re.I)
_QUERY = re.compile(r"\s*(?:SELECT|WITH|VALUES|TABLE|FROM|\()", re.I)


@dataclass(frozen=True)
class CheckpointConfig:
    """``interval_ms`` paces the micro-batches; ``data_dir`` holds their state."""

    interval_ms: int | None = None
    data_dir: str | None = None


@dataclass(frozen=True)
class Config:
    """Options of ``open_workspace``. ``storage_dir`` wins over the path argument.

    ``buffer_size`` is the number of unprocessed rows above whose larger part a
    source counts as backpressured; ``max_files_per_epoch`` or
    ``max_bytes_per_epoch`` bounds what streams take in at once. A stream keeps the ``state_partitions`` it was made with.
    """

    storage_dir: str | None = None
    checkpoint: CheckpointConfig | None = None
    buffer_size: int = 1_000_000
    incremental_emit: bool = False
    max_files_per_epoch: int | None = None
    max_bytes_per_epoch: int | None = None
    state_partitions: int = STATE_PARTITIONS
    feed_files: int | None = None
    object_store_url: str | None = None
    object_store_options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Outcome:
    """One statement's outcome: ``ddl``, ``rows-affected``, ``query`` or ``metadata``."""

    kind: str
    statement_type: str | None = None
    object_name: str | None = None
    rows_affected: int | None = None
    result: Result | None = None


def open_workspace(spark: SparkSession, path: str | None = None, config: Config | None = None) -> Workspace:
    """Open a workspace below ``path``; without one, below the work folder.

    A path that was used before brings its sources, SQL streams and their
    state back.
    """
    config = config or Config()
    if config.buffer_size <= 0:
        raise fault(BAD_CONFIG, "buffer_size: a positive number of rows is needed")
    if config.checkpoint and config.checkpoint.interval_ms is not None and config.checkpoint.interval_ms < 0:
        raise fault(BAD_CONFIG, "checkpoint.interval_ms: no negative pace is possible")
    for key, value in config.object_store_options.items():
        spark.sparkContext._jsc.hadoopConfiguration().set(key, value)
    place = config.storage_dir or path or config.object_store_url
    root = fresh_path(spark, "workspace") if place in (None, MEMORY) else place.rstrip("/")
    return Workspace(spark, root, config)


class Workspace:
    """Sources, streams, views and sinks below one folder."""

    def __init__(self, spark: SparkSession, root: str, config: Config):
        self._spark = stream_session(spark)
        self._storage = Storage(spark)
        self._config = config
        self.root = root
        self._sources: dict[str, StoredSource] = {}
        self._streams: dict[str, Stream] = {}
        self._views: dict[str, MaterializedView] = {}
        self._sinks: dict[str, Sink | UpsertSink] = {}
        self._ingestions: dict[str, Ingestion] = {}
        self._waiting: defaultdict[str, list[tuple[str, dict]]] = defaultdict(list)
        self._queries: dict[int, ResultStream] = {}
        self._query_ids = itertools.count(1)
        self._subscriptions: list[Subscription] = []
        self._state = "Created"
        self._opened = time.monotonic()
        self._restore()

    # -- lifecycle -------------------------------------------------------

    def _open(self) -> None:
        if self._state == "Closed":
            raise fault(CLOSED, "workspace is closed")

    def _defining(self, name: str) -> None:
        self._open()
        if self._state == "Running":
            raise fault(WRONG_STATEMENT, "definitions are frozen once the pipeline is started")
        if any(name in known for known in (self._sources, self._streams, self._sinks, self._ingestions)):
            raise fault(WRONG_STATEMENT, f"'{name}' already exists")

    def start(self) -> None:
        """Run every stream until ``close``; again is a no-op."""
        self._open()
        if self._state != "Running":
            interval = self._config.checkpoint.interval_ms if self._config.checkpoint else None
            for running in (*self._ingestions.values(), *self._streams.values()):
                running.start(interval if interval is not None else 500)
            self._state = "Running"

    def is_checkpoint_enabled(self) -> bool:
        return self._config.checkpoint is not None

    def checkpoint(self) -> Checkpoint:
        """Bring every stream up to the rows appended so far."""
        self._open()
        if not self.is_checkpoint_enabled():
            raise fault(BAD_CONFIG, "checkpointing is not configured")
        if not self._streams:
            raise fault(BAD_CONFIG, "a checkpoint needs at least one stream or sink")
        return self.run_available()

    def run_available(self) -> Checkpoint:
        """Process what arrived; the outcome names the newest epoch of any stream."""
        self._open()
        if not self._streams:
            raise fault(BAD_CONFIG, "no stream is declared")
        for ingestion in self._ingestions.values():
            ingestion.run_available()
        with ThreadPoolExecutor(min(len(self._streams), _CONCURRENT_STREAMS)) as pool:
            outcomes = list(pool.map(Stream.run_available, self._streams.values()))
        for sink in self._sinks.values():
            sink.deliver()
        newest = max(outcomes, key=lambda o: o.epoch)
        return Checkpoint(True, newest.checkpoint_id, newest.epoch, max(o.duration_ms for o in outcomes))

    @property
    def is_closed(self) -> bool:
        return self._state == "Closed"

    def close(self) -> None:
        """Stop the streams; again is a no-op."""
        if self._state != "Closed":
            for query in (*self._ingestions.values(), *self._streams.values()):
                query.stop()
            for running in self._queries.values():
                running.cancel()
            self._state = "Closed"

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    # -- definitions -----------------------------------------------------

    def _remember(self, kind: str, name: str, definition: dict) -> None:
        self._storage.mkdirs(f"{self.root}/catalog")
        self._storage.write_text(f"{self.root}/catalog/{kind}-{name}.json", json.dumps(definition))

    def _restore(self) -> None:
        """Bring back what an earlier workspace declared here."""
        names = self._storage.names(f"{self.root}/catalog")
        for kind in ("source", "ingestion", "stream", "view", "sink"):
            for file in sorted(n for n in names if n.startswith(f"{kind}-") and n.endswith(".json")):
                known = json.loads(self._storage.read_text(f"{self.root}/catalog/{file}"))
                if kind == "source":
                    schema = T.StructType.fromJson(known["schema"])
                    self._add_source(known["name"], schema, known["watermark_column"], known["delay"])
                elif kind == "ingestion":
                    self._add_ingestion(**known)
                elif kind == "stream":
                    self._add_stream(known["name"], known["sql"], known["emit"], known["sources"])
                elif known.get("stream", known["name"]) in self._streams:
                    # Streams given as functions come back when they are declared again.
                    self._add_view(**known) if kind == "view" else self._add_sink(**known)
                else:
                    self._waiting[known.get("stream", known["name"])].append((kind, known))

    def _add_source(self, name: str, schema: T.StructType, watermark_column: str | None, delay: str) -> StoredSource:
        path = f"{self.root}/sources/{name}"
        self._sources[name] = StoredSource(self._spark, name, schema, path, watermark_column, delay)
        return self._sources[name]

    def create_source(
        self,
        name: str,
        columns: str | T.StructType,
        watermark_column: str | None = None,
        delay: str = "0 seconds",
    ) -> StoredSource:
        """Declare an append-only source with a fixed schema."""
        self._defining(name)
        schema = parse_columns(columns) if isinstance(columns, str) else columns
        made = self._add_source(name, schema, watermark_column, delay)
        known = {"name": name, "schema": schema.jsonValue(), "watermark_column": watermark_column, "delay": delay}
        self._remember("source", name, known)
        return made

    def create_ingestion(
        self,
        name: str,
        source: str,
        path: str,
        columns: str,
        form: str = "json",
        row_id: str | None = None,
        options: Mapping[str, str] | None = None,
    ) -> Ingestion:
        """Declare a live feed: files of raw ``columns`` that arrive at ``path`` go through the rules into a source."""
        self._defining(name)
        self.source(source)
        known = {
            "name": name, "source": source, "path": path, "columns": columns, "form": form, "row_id": row_id,
            "options": dict(options or {}),
        }
        made = self._add_ingestion(**known)
        self._remember("ingestion", name, known)
        return made

    def _add_ingestion(
        self, name: str, source: str, path: str, columns: str, form: str, row_id: str | None, options: dict
    ) -> Ingestion:
        raw = files_arriving(path, columns, form, self._config.max_files_per_epoch, **options)
        folder = f"{self.root}/ingestions/{name}"
        self._ingestions[name] = Ingestion(self._spark, name, self._sources[source], raw, folder, row_id)
        return self._ingestions[name]

    def ingestion(self, name: str) -> Ingestion:
        self._open()
        if name not in self._ingestions:
            raise fault(UNKNOWN_NAME, f"no ingestion is named '{name}'")
        return self._ingestions[name]

    def _add_stream(
        self, name: str, query: Build | str, emit: str | None, sources: list[str], window: str | None = None
    ) -> Stream:
        checkpoint = self._config.checkpoint
        folder = checkpoint.data_dir if checkpoint else None
        try:
            self._streams[name] = Stream(
                self._spark,
                name,
                f"{self.root}/streams/{name}",
                [self.source(s) for s in sources],
                query,
                emit,
                state_partitions=self._config.state_partitions,
                max_files=self._config.max_files_per_epoch,
                max_bytes=self._config.max_bytes_per_epoch,
                feed_files=self._config.feed_files,
                checkpoint_path=f"{folder}/{name}" if folder else None,
                window=window,
            )
        except ParseException as error:
            raise fault(INVALID_SQL, f"invalid SQL: {error}") from error
        except AnalysisException as error:
            raise fault(WRONG_STATEMENT, str(error)) from error
        return self._streams[name]

    def create_stream(
        self,
        name: str,
        query: Build | str,
        sources: list[str] | None = None,
        emit: str | None = None,
        window: str | None = None,
    ) -> Stream:
        """Declare a continuous query over sources, as SQL or as a function.

        ``window`` is what a function groups event time by, as SQL; it serves
        to count the rows that closed windows refuse.
        """
        self._defining(name)
        emit = emit or (CHANGES if self._config.incremental_emit else None)
        if sources is None:
            sources = self._mentioned(query) if isinstance(query, str) else list(self._sources)
        made = self._add_stream(name, query, emit, sources, window)
        for kind, known in self._waiting.pop(name, []):
            self._add_view(**known) if kind == "view" else self._add_sink(**known)
        if isinstance(query, str):
            self._remember("stream", name, {"name": name, "sql": query, "emit": emit, "sources": sources})
        return made

    def create_view(
        self, name: str, query: Build | str, keys: list[str], sources: list[str] | None = None
    ) -> MaterializedView:
        """Declare a continuous query whose latest row per key is kept."""
        self.create_stream(name, query, sources, CHANGES)
        self._remember("view", name, {"name": name, "keys": keys})
        return self._add_view(name, keys)

    def _add_view(self, name: str, keys: list[str]) -> MaterializedView:
        self._views[name] = MaterializedView(self._spark, self._streams[name], keys)
        return self._views[name]

    def view(self, name: str) -> MaterializedView:
        self._open()
        if name not in self._views:
            raise fault(UNKNOWN_NAME, f"no view is named '{name}'")
        return self._views[name]

    def create_sink(self, name: str, stream: str, path: str, keys: list[str] | None = None) -> Sink | UpsertSink:
        """Declare a table at ``path`` that receives what ``stream`` emits, epoch by epoch.

        With ``keys`` it keeps the newest row of each key instead of all rows.
        """
        self._defining(name)
        self._stream(stream)
        self._remember("sink", name, {"name": name, "stream": stream, "path": path, "keys": keys})
        return self._add_sink(name, stream, path, keys)

    def _add_sink(self, name: str, stream: str, path: str, keys: list[str] | None = None) -> Sink | UpsertSink:
        source = self._streams[stream]
        if keys:
            self._sinks[name] = UpsertSink(self._spark, name, source, path, keys)
        else:
            self._sinks[name] = Sink(self._spark, name, source, path)
        self._streams[stream].after_epoch.append(self._sinks[name].deliver)
        return self._sinks[name]

    def sink(self, name: str) -> Sink | UpsertSink:
        self._open()
        if name not in self._sinks:
            raise fault(UNKNOWN_NAME, f"no sink is named '{name}'")
        return self._sinks[name]

    def _mentioned(self, sql: str) -> list[str]:
        """The sources a query reads: the tables its parsed form names."""
        try:
            named = tables(parsed(self._spark, sql))
        except (Py4JJavaError, ParseException):
            return []  # the query itself is refused with the reason
        return [n for n in self._sources if n.lower() in named]

    # -- statements ------------------------------------------------------

    def execute(self, sql: str) -> Outcome:
        """Run one statement. Queries go to Spark SQL as they are."""
        self._open()
        if not isinstance(sql, str):
            raise fault(UNSUPPORTED, f"expected SQL text, got {type(sql).__name__}")
        if found := _CREATE_SOURCE.match(sql):
            self.create_source(found[1], found[2])
            return Outcome("ddl", "CREATE SOURCE", found[1])
        if found := _CREATE_STREAM.match(sql):
            self.create_stream(found[1], found[2])
            return Outcome("ddl", "CREATE STREAM", found[1])
        if found := _INSERT.match(sql):
            return Outcome("rows-affected", rows_affected=self._insert_query(found[1], found[2]))
        if found := _SHOW.match(sql):
            listed = {"SOURCES": self._sources, "STREAMS": self._streams, "SINKS": self._sinks}[found[1].upper()]
            names = self._spark.createDataFrame([(n,) for n in listed], "name string")
            return Outcome("metadata", result=Result(names))
        if found := _DESCRIBE.match(sql):
            return Outcome("metadata", result=Result(self.schema(found[1])))
        if _QUERY.match(sql):
            return Outcome("query", result=Result(self._select(sql)))
        raise fault(INVALID_SQL, f"invalid SQL: {sql}")

    def _select(self, sql: str) -> DataFrame:
        """A bounded query over snapshots of the sources it names."""
        for name in self._mentioned(sql):
            self._sources[name].bounded().createOrReplaceTempView(name)
        try:
            return self._spark.sql(sql)
        except ParseException as error:
            raise fault(INVALID_SQL, f"invalid SQL: {error}") from error
        except AnalysisException as error:
            raise fault(WRONG_STATEMENT, str(error)) from error

    def _insert_query(self, name: str, sql: str) -> int:
        source = self.source(name)
        rows = self._select(sql)
        if len(rows.columns) != len(source.schema):
            raise fault(WRONG_STATEMENT, f"expected {len(source.schema)} columns, got {len(rows.columns)}")
        named = rows.toDF(*source.schema.names)
        return source.append(named.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in source.schema.fields]))

    def query(self, sql: str) -> Result:
        """The result of a query; other statements are an E400."""
        return Result(self._only_query(sql))

    def _only_query(self, sql: str) -> DataFrame:
        self._open()
        if not isinstance(sql, str):
            raise fault(UNSUPPORTED, f"expected SQL text, got {type(sql).__name__}")
        if not _QUERY.match(sql):
            raise fault(WRONG_STATEMENT, "only statements that return rows can be queried")
        return self._select(sql)

    def stream_query(self, sql: str) -> tuple[int, ResultStream]:
        """A query's batches on demand, with the id that cancels it."""
        running = ResultStream(self._only_query(sql))
        query_id = next(self._query_ids)
        self._queries[query_id] = running
        return query_id, running

    def cancel_query(self, query_id: int) -> None:
        if query_id not in self._queries:
            raise fault(WRONG_STATEMENT, f"unknown query id {query_id}")
        self._queries.pop(query_id).cancel()

    # -- ingestion -------------------------------------------------------

    def source(self, name: str) -> StoredSource:
        self._open()
        if name not in self._sources:
            raise fault(UNKNOWN_NAME, f"source not found: '{name}'")
        return self._sources[name]

    def insert(self, source: str, rows: Iterable[Mapping[str, Any]]) -> int:
        if isinstance(rows, (str, bytes)):
            raise fault(UNSUPPORTED, "expected row objects, got text")
        return self.source(source).insert(rows)

    def insert_frame(self, source: str, raw: DataFrame) -> int:
        return self.source(source).insert_frame(raw)

    def insert_arrow(self, source: str, payload: bytes) -> int:
        return self.source(source).insert_arrow(payload)

    def writer(self, source: str) -> Writer:
        return self.source(source).writer()

    # -- retention -------------------------------------------------------

    def retain(self, name: str, keep: int, older_than_ms: int | None = None, override: bool = False) -> int:
        """Drop a stream's epochs that none of its views, sinks and named readers needs any more."""
        return self._stream(name).retain(keep, older_than_ms, override)

    # -- subscriptions ---------------------------------------------------

    def _stream(self, name: str) -> Stream:
        self._open()
        if name not in self._streams:
            what = "is a source and not subscribable" if name in self._sources else "not found"
            raise fault(UNKNOWN_NAME, f"stream '{name}' {what}")
        return self._streams[name]

    def subscribe(
        self, name: str, where: str | None = None, from_epoch: int | None = None, reader: str | None = None
    ) -> Subscription:
        """Frames of a stream or view from now on, or after ``from_epoch``.

        A ``reader`` with a name goes on where it stopped, and retention keeps
        what it has not had yet.
        """
        return Subscription(self._stream(name), where, from_epoch, reader)

    def subscribe_with(
        self,
        name: str,
        on_data: Callable[[Frame], None],
        on_error: Callable[[FreshetError], None] = lambda error: None,
        on_close: Callable[[], None] = lambda: None,
        where: str | None = None,
        from_epoch: int | None = None,
    ) -> PushSubscription:
        """Frames handed to ``on_data`` one at a time."""
        return PushSubscription(lambda: self.subscribe(name, where, from_epoch), on_data, on_error, on_close)

    # -- catalog ---------------------------------------------------------

    def list_sources(self) -> list[str]:
        return list(self._sources)

    def list_streams(self) -> list[str]:
        return list(self._streams)

    def list_sinks(self) -> list[str]:
        return list(self._sinks)

    def schema(self, name: str) -> DataFrame:
        """Columns of a source in order: position, name, type, nullable."""
        return self._spark.createDataFrame(
            describe(self.source(name).schema), "pos int, name string, data_type string, nullable boolean"
        )

    def source_infos(self) -> DataFrame:
        """Every source with its columns and watermark column."""
        rows = [
            (s.name, [(n, t, null) for _, n, t, null in describe(s.schema)], s.watermark_column)
            for s in self._sources.values()
        ]
        layout = (
            "name string, schema array<struct<name:string,data_type:string,nullable:boolean>>, watermark_column string"
        )
        return self._spark.createDataFrame(rows, layout)

    # -- telemetry -------------------------------------------------------

    def _rows_processed(self, name: str) -> int:
        """Rows of a source that every stream reading it has taken in."""
        readers = [s for s in self._streams.values() if any(src.name == name for src in s.sources)]
        taken = [
            s.progress().where(F.col("source") == name).agg(F.coalesce(F.sum("input_rows"), F.lit(0)).alias("n"))
            for s in readers
        ]
        return reduce(DataFrame.unionByName, taken).agg(F.min("n").alias("n")).first()["n"] if taken else 0

    def source_metrics(self, name: str) -> DataFrame:
        source = self.source(name)
        return source_metrics(
            source.table.log(),
            name,
            self._config.buffer_size,
            processed_rows=self._rows_processed(name),
            explicit_watermark=source.explicit_watermark(),
        )

    def all_source_metrics(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.source_metrics(n) for n in self._sources])

    def stream_metrics(self, name: str) -> DataFrame:
        stream = self._stream(name)
        return stream_metrics(stream.feed.log(), name, stream.sql)

    def all_stream_metrics(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.stream_metrics(n) for n in self._streams])

    def pipeline_state(self) -> str:
        return self._state

    def pipeline_watermark(self) -> int | None:
        """The least event time reached over the sources that declare one."""
        reached = [s.watermark() for s in self._sources.values() if s.watermark_column]
        return None if not reached or None in reached else min(reached)

    def total_events_processed(self) -> int:
        taken = [s.progress().agg(F.coalesce(F.sum("input_rows"), F.lit(0)).alias("n")) for s in self._streams.values()]
        return reduce(DataFrame.unionByName, taken).agg(F.sum("n").alias("n")).first()["n"] if taken else 0

    def metrics(self) -> DataFrame:
        """Counters of the whole pipeline as one row."""
        source_logs = [s.table.log() for s in self._sources.values()]
        feed_logs = [s.feed.log() for s in self._streams.values()]
        if not source_logs and not feed_logs:
            raise fault(UNKNOWN_NAME, "nothing is declared yet")
        views = [v.updates() for v in self._views.values()]
        size = sum(v.bytes_stored().first()["mv_bytes_stored"] for v in self._views.values())
        updates = reduce(DataFrame.unionByName, views).agg(F.sum("mv_updates")).first()[0] if views else 0
        refused = [s.refused() for s in self._streams.values()]
        return pipeline_totals(source_logs, feed_logs, refused).select(
            "*",
            F.lit(int((time.monotonic() - self._opened) * 1000)).cast("bigint").alias("uptime_ms"),
            F.lit(self._state).alias("state"),
            F.lit(len(self._sources)).alias("source_count"),
            F.lit(len(self._streams)).alias("stream_count"),
            F.lit(len(self._sinks)).alias("sink_count"),
            F.lit(self.pipeline_watermark()).cast("bigint").alias("pipeline_watermark"),
            F.lit(updates).cast("bigint").alias("mv_updates"),
            F.lit(size).cast("bigint").alias("mv_bytes_stored"),
        )
