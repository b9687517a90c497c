"""Arrow IPC in and out, encoded and decoded on the executors."""

from __future__ import annotations

import struct
import sys
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from freshet.errors import BAD_VALUE, SCHEMA_MISMATCH, fault, from_task, marked
from freshet.functions.logical import arrow_type
from freshet.session import fresh_path

# The functions below travel to the executors whole, so that these need not have
# this package installed. They use nothing of it but this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAYLOAD = "part int, rows bigint, ipc binary"
MAX_PAYLOAD_BYTES = 64 * 1024 * 1024


def _pieces(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch, halved until each piece is under ``limit`` bytes."""
    if batch.num_rows > 1 and batch.nbytes > limit:  # nbytes counts only the slice
        half = batch.num_rows // 2
        yield from _pieces(batch.slice(0, half), limit)
        yield from _pieces(batch.slice(half), limit)
        return
    yield batch


def _payloads(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, bytes]]:
    """IPC streams of one batch's pieces."""
    for piece in _pieces(batch, limit):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, piece.schema) as writer:
            writer.write_batch(piece)
        yield piece.num_rows, sink.getvalue().to_pybytes()


def batch_counts(df: DataFrame, max_bytes: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    """``part``, ``batches`` and ``rows`` of every partition that has rows: how ``to_ipc`` would split it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = rows = 0
        for batch in batches:
            pieces += sum(1 for _ in _pieces(batch, max_bytes))
            rows += batch.num_rows
        if pieces:
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part, pa.array([pieces], pa.int64()), pa.array([rows], pa.int64())], ["part", "batches", "rows"]
            )

    return df.mapInArrow(count, "part int, batches bigint, rows bigint")


def to_ipc(df: DataFrame, max_bytes: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    """One row per Arrow batch: partition, row count, IPC stream with schema.

    A partition keeps its batch order. No batch is larger than the session's
    ``arrow.maxRecordsPerBatch`` rows or, wide rows aside, ``max_bytes``.
    """
    schema = pa.schema([pa.field("part", pa.int32()), pa.field("rows", pa.int64()), pa.field("ipc", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows, payload in _payloads(batch, max_bytes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([rows], pa.int64()), pa.array([payload], pa.binary())],
                    schema=schema,
                )

    return df.mapInArrow(encode, PAYLOAD)


def _expected(schema: T.StructType) -> list[tuple[str, pa.DataType | None]]:
    return [(f.name, arrow_type(f)) for f in schema.fields]


def _stored(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]))


def _same(want: pa.DataType, got: pa.DataType) -> bool:
    # Text may be large, and the zone of a timestamp is ignored.
    if pa.types.is_string(want):
        return pa.types.is_string(got) or pa.types.is_large_string(got)
    if pa.types.is_timestamp(want):
        return pa.types.is_timestamp(got) and want.unit == got.unit
    return want == got


def mismatch(expected: list[tuple[str, pa.DataType | None]], actual: pa.Schema) -> str | None:
    """Why an Arrow schema does not fit the declared columns, or None."""
    if len(expected) != len(actual):
        return f"{len(expected)} columns are declared, the batch has {len(actual)}"
    for (name, want), got in zip(expected, actual):
        if name != got.name or (want is not None and not _same(want, got.type)):
            return f"column '{name}' is declared as {want}, the batch has '{got.name}' of {got.type} there"
    return None


def _store(batch: pa.RecordBatch, target: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for column, field in zip(batch.columns, target):
        if pa.types.is_timestamp(field.type) and not pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("ms"))
        elif pa.types.is_timestamp(column.type) and column.type.tz is not None:
            column = column.cast(pa.timestamp(column.type.unit))
        # Nanoseconds are cut to Spark's microseconds.
        arrays.append(column.cast(field.type, safe=not pa.types.is_timestamp(field.type)))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def read_stream(payload: bytes) -> pa.RecordBatchReader:
    """Open IPC stream bytes; bytes that are none of it are an E300."""
    try:
        return pa.ipc.open_stream(payload)
    except (pa.ArrowInvalid, OSError, EOFError) as error:
        raise fault(BAD_VALUE, f"these bytes are no Arrow stream: {error}") from error


def from_ipc(payloads: DataFrame, schema: T.StructType, column: str = "ipc") -> DataFrame:
    """Decode a binary column of IPC streams into rows of ``schema``.

    The Arrow schema of every stream is checked by name and type; a mismatch
    or garbage fails the job, and with it the whole write that reads from it.
    """
    expected, target = _expected(schema), _stored(schema)
    mismatched, invalid = marked(SCHEMA_MISMATCH, ""), marked(BAD_VALUE, "these bytes are no Arrow stream: ")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                try:
                    reader = pa.ipc.open_stream(value.as_buffer())
                    wrong = mismatch(expected, reader.schema)
                    if wrong:
                        raise ValueError(mismatched + wrong)
                    for inner in reader:
                        yield _store(inner, target)
                except (pa.ArrowInvalid, OSError, EOFError) as error:
                    raise ValueError(f"{invalid}{error}") from error

    return payloads.select(column).mapInArrow(
        decode, T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    )


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    """pyarrow's file system for a path, and the path within it."""
    return pa.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def write_ipc_files(df: DataFrame, path: str, whole_partitions: bool = False, batch_rows: int | None = None) -> None:
    """Write Arrow IPC stream files from the tasks: one per Arrow batch, or one per partition.

    A file's name says partition and batch, so a task that runs again writes
    the same files. ``path`` is one that pyarrow's file systems know.
    ``batch_rows`` cuts batches to so many rows.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(path)
        store.create_dir(folder, recursive=True)
        out = writer = None
        for k, batch in enumerate(batches):
            if writer is None:
                name = f"{folder}/part-{TaskContext.get().partitionId():05d}-{k:05d}.arrow"
                out = store.open_output_stream(name)
                writer = pa.ipc.new_stream(out, batch.schema)
            for at in range(0, batch.num_rows, batch_rows or max(batch.num_rows, 1)):
                writer.write_batch(batch.slice(at, batch_rows))
            if not whole_partitions:
                writer.close()
                out.close()
                writer = None
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])
        if writer is not None:
            writer.close()
            out.close()

    df.mapInArrow(save, "rows bigint").write.format("noop").mode("overwrite").save()


# Fixed values of the IPC stream format: the mark before a message, and kinds of messages.
_CONTINUES = 0xFFFFFFFF
_SCHEMA, _DICTIONARY = 1, 2
# Bytes of record batches that one task reads at a time.
RANGE_BYTES = 32 * 1024 * 1024
MOST_TASKS = 10_000


def _table_field(data: bytes, table: int, field: int, form: str, default: int) -> int:
    """A number in a table of the serialised header: found by the table's list of field places."""
    places = table - struct.unpack_from("<i", data, table)[0]
    size = struct.unpack_from("<H", data, places)[0]
    at = struct.unpack_from("<H", data, places + 4 + 2 * field)[0] if 4 + 2 * field < size else 0
    return struct.unpack_from(form, data, table + at)[0] if at else default


def messages(file: pa.NativeFile) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of every message of an IPC stream, read from the headers alone."""
    at, size = 0, file.size()
    while at + 4 <= size:
        file.seek(at)
        first = struct.unpack("<I", file.read(4))[0]
        lead = 4
        if first == _CONTINUES:
            first, lead = struct.unpack("<I", file.read(4))[0], 8
        if first == 0:
            return
        header = file.read(first)
        if len(header) < first:
            raise pa.ArrowInvalid("the stream ends within a header")
        root = struct.unpack_from("<I", header, 0)[0]
        kind = _table_field(header, root, 1, "<B", 0)
        end = at + lead + first + _table_field(header, root, 3, "<q", 0)
        if end > size or end <= at:
            raise pa.ArrowInvalid("the stream ends within a message")
        yield kind, at, end
        at = end


_RANGES = "path string, lead array<struct<start:bigint,end:bigint>>, start bigint, end bigint"


def ipc_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Runs of record batches of about ``range_bytes`` within IPC stream files.

    ``files`` has a column ``path``. ``lead`` names the messages that a reader
    of the run needs before it: the schema and the dictionaries so far.
    """
    invalid = marked(BAD_VALUE, "these bytes are no Arrow stream: ")
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("path", pa.string()), ("lead", pa.list_(place)), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = _open(path)
                found, lead, begun, last = [], [], None, 0
                try:
                    with store.open_input_file(inner) as file:
                        for kind, start, end in messages(file):
                            closed = kind in (_SCHEMA, _DICTIONARY) or begun is not None and end - begun > range_bytes
                            if closed and begun is not None:
                                found.append({"path": path, "lead": list(lead), "start": begun, "end": last})
                                begun = None
                            if kind in (_SCHEMA, _DICTIONARY):
                                lead.append({"start": start, "end": end})
                            elif begun is None:
                                begun = start
                            last = end
                except (pa.ArrowInvalid, struct.error) as error:
                    raise ValueError(f"{invalid}{error}") from error
                if begun is not None:
                    found.append({"path": path, "lead": list(lead), "start": begun, "end": last})
                elif not found:
                    # A file of no batches still has a schema to check.
                    found.append({"path": path, "lead": list(lead), "start": last, "end": last})
                yield pa.RecordBatch.from_pylist(found, schema)

    return files.select("path").mapInArrow(scan, _RANGES)


def read_ipc_files(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A folder of Arrow IPC stream files as rows; tasks share a large file.

    Headers are scanned first, one task per file; the runs they name are then
    read by as many tasks as there are runs. Stores that only Spark reads have
    each file read whole by a task.
    """
    # Files of a listing only: their content is not read here.
    files = spark.read.format("binaryFile").load(path)
    if urllib.parse.urlparse(path).scheme not in ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"):
        return from_ipc(files, schema, "content")
    place = fresh_path(spark, "ipc-runs")
    ipc_ranges(files, range_bytes).write.parquet(place)
    runs = spark.read.schema(_RANGES).parquet(place)
    # Dealt one by one: by size the few bytes that name them would all go to one task.
    runs = runs.repartition(max(1, min(runs.count(), MOST_TASKS)))
    expected, target = _expected(schema), _stored(schema)
    mismatched, invalid = marked(SCHEMA_MISMATCH, ""), marked(BAD_VALUE, "these bytes are no Arrow stream: ")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, inner = _open(row["path"])
                with store.open_input_file(inner) as file:
                    parts = [(r["start"], r["end"]) for r in row["lead"]] + [(row["start"], row["end"])]
                    data = b"".join(file.read_at(end - start, start) for start, end in parts)
                try:
                    reader = pa.ipc.open_stream(pa.py_buffer(data))
                    wrong = mismatch(expected, reader.schema)
                    if wrong:
                        raise ValueError(mismatched + wrong)
                    for inner_batch in reader:
                        yield _store(inner_batch, target)
                except (pa.ArrowInvalid, OSError, EOFError) as error:
                    raise ValueError(f"{invalid}{error}") from error

    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return runs.mapInArrow(decode, nullable)


def table_of(payload: bytes, schema: T.StructType) -> pa.Table:
    """Client-held IPC bytes, checked and brought to the stored types."""
    reader = read_stream(payload)
    wrong = mismatch(_expected(schema), reader.schema)
    if wrong:
        raise fault(SCHEMA_MISMATCH, wrong)
    target = _stored(schema)
    try:
        return pa.Table.from_batches([_store(b, target) for b in reader], schema=target)
    except (pa.ArrowInvalid, OSError) as error:
        raise fault(BAD_VALUE, f"these bytes are no Arrow stream: {error}") from error


def typed_failure(error: Exception) -> Exception:
    """The coded error behind a failed decode job, or the error itself."""
    return from_task(error) or error
