"""The given tables as declared sources, and their replay in arrival order."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.logical import parse_columns
from freshet.session import Storage, fresh_path
from freshet.sources.source import Source, StoredSource
from freshet.streaming.stream import CHANGES, Stream

# Declarations of the given tables.
COLUMNS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, "
    "l_shipdate TIMESTAMP",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
}

# Ten arrival epochs' worth of rows plus the spill-over of late ones.
ARRIVAL_EPOCHS = 12
# Files of an append, and those a stream over given or appended tables takes in at once.
ARRIVAL_FILES = 4
FILES_PER_EPOCH = 4
ORDERED_APPENDS = 3
# The same in SQL: epoch of each event, a share of the table in event order,
# with every event delayed by up to 1.8 epochs.
ARRIVALS_SQL = (
    "(SELECT e.*, (10 * event_id + (event_id % 7) * (3 * n // 10)) // n AS epoch "
    "FROM events e, (SELECT max(event_id) + 1 AS n FROM events))"
)


def exact_avg(column: str) -> str:
    """An average in SQL that no order of adding up changes: ten decimals, 28 digits before them."""
    return f"CAST(sum(CAST({column} AS DECIMAL(38,10))) AS DOUBLE) / count({column})"


def source(spark: SparkSession, sf_dir: str, name: str, **watermark) -> Source:
    """A given table as a declared source."""
    return Source(spark, name, parse_columns(COLUMNS[name]), f"{sf_dir}/{name}.parquet", **watermark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, bounded, in its declared schema."""
    return source(spark, sf_dir, name).bounded()


def utc(column: str) -> Column:
    """A timestamp as the zoneless wall time in UTC."""
    return F.col(column).cast("timestamp_ntz").alias(column)


class Replay:
    """``events`` delivered to a source in arrival order, one append per epoch.

    Two streams process it: ``tap`` passes rows through and ``rollup`` keeps a
    running aggregate. Each append has ``ARRIVAL_FILES`` files and an epoch
    takes in as many, so their feeds have one epoch per append. The number of
    appends is fixed, so their size grows with the table; each append reads
    only the row groups whose ids can belong to it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        events = table(spark, sf_dir, "events")
        n = events.agg((F.max("event_id") + 1).alias("n")).first()["n"]
        delay = 3 * n // 10
        arrival = F.expr(f"(10 * event_id + (event_id % 7) * {delay}L) div {n}L")
        path = fresh_path(spark, "arrivals")
        columns = parse_columns(COLUMNS["events"])
        # One table declared twice: with event time and, for the two streams
        # below, without, because a watermark adds batches that hold no rows.
        self.timed = StoredSource(spark, "events", columns, path, "ts", "40 days")
        self.plain = StoredSource(spark, "events", columns, path)
        for k in range(ARRIVAL_EPOCHS):
            low, high = max(0, (k * n - 6 * delay) // 10), -(-(k + 1) * n // 10)
            due = events.where((F.col("event_id") >= low) & (F.col("event_id") < high) & (arrival == k))
            self.timed.append(due.repartition(ARRIVAL_FILES))
        self.tap = Stream(
            spark, "tap", f"{path}/tap", [self.plain], "SELECT * FROM events", CHANGES,
            max_files=ARRIVAL_FILES, feed_time="ts",
        )
        self.rollup = Stream(
            spark,
            "rollup",
            f"{path}/rollup",
            [self.plain],
            f"SELECT event_type, {exact_avg('value')} AS avg_v, count(*) AS n FROM events GROUP BY event_type",
            CHANGES,
            max_files=ARRIVAL_FILES,
            feed_files=1,
        )
        with ThreadPoolExecutor(2) as pool:
            for run in [pool.submit(s.run_available) for s in (self.tap, self.rollup)]:
                run.result()


class InOrder:
    """A given table appended to a source in the order of its key, in three appends."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, key: str):
        rows = table(spark, sf_dir, name)
        n = rows.agg((F.max(key) + 1).alias("n")).first()["n"]
        self.source = StoredSource(spark, name, parse_columns(COLUMNS[name]), fresh_path(spark, f"{name}-in-order"))
        for k in range(ORDERED_APPENDS):
            due = rows.where((F.col(key) >= k * n // ORDERED_APPENDS) & (F.col(key) < (k + 1) * n // ORDERED_APPENDS))
            self.source.append(due.repartition(ARRIVAL_FILES))


_made: dict[tuple, object] = {}
_lock = threading.Lock()


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """What was made from a table before, unless the table has changed since."""
    storage, path = Storage(spark), f"{sf_dir}/{name}.parquet"
    key = (make.__qualname__, spark.sparkContext.applicationId, path, storage.size(path), storage.changed(path))
    with _lock:
        if key not in _made:
            _made[key] = make()
        return _made[key]


def replay(spark: SparkSession, sf_dir: str) -> Replay:
    """The replay of this application and folder, done once and kept as tables."""

    def arrivals() -> Replay:
        return Replay(spark, sf_dir)

    return once(spark, sf_dir, "events", arrivals)


def in_order(spark: SparkSession, sf_dir: str, name: str) -> StoredSource:
    """The appends of a table in key order, done once."""

    def appended() -> InOrder:
        return InOrder(spark, sf_dir, name, {"events": "event_id", "lineitem": "l_orderkey"}[name])

    return once(spark, sf_dir, name, appended).source


def run_stream(spark: SparkSession, name: str, sources: list[Source], query, **options) -> Stream:
    """Run a stream over everything its sources hold, some files at a time, and return it."""
    options = {"max_files": FILES_PER_EPOCH, "feed_files": 1, **options}
    stream = Stream(spark, name, fresh_path(spark, name), sources, query, **options)
    stream.run_available()
    return stream


__all__ = ["ARRIVALS_SQL", "Replay", "exact_avg", "in_order", "once", "replay", "run_stream", "source", "table", "utc"]
