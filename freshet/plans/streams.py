"""Continuous queries: stateless maps, running and windowed aggregates, event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.logical import parse_columns
from freshet.operators.lateness import epoch_watermarks, late_counts, split_late
from freshet.operators.metrics import pipeline_watermark, source_watermark
from freshet.plans.registry import plan
from freshet.plans.tables import (
    ARRIVALS_SQL,
    COLUMNS,
    FILES_PER_EPOCH,
    exact_avg,
    in_order,
    replay,
    run_stream,
    source,
    table,
    utc,
)
from freshet.session import Storage, fresh_path
from freshet.sources.source import Source, StoredSource
from freshet.streaming.feed import latest
from freshet.streaming.sink import Sink, UpsertSink
from freshet.streaming.state import state_rows
from freshet.streaming.stream import CHANGES, EPOCH, ON_CLOSE, Stream
from freshet.streaming.view import MaterializedView

_DAILY = (
    "SELECT window.start AS w_start, event_type, count(*) AS n FROM events GROUP BY window(ts, '1 day'), event_type"
)
_DAILY_SQL = "SELECT date_trunc('day', ts) AS w_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"
_LATE_SQL = (
    f"WITH m AS (SELECT epoch, max(ts) AS mx FROM {ARRIVALS_SQL} GROUP BY epoch), "
    "w AS (SELECT epoch, max(mx) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "- INTERVAL 3 DAY AS wm FROM m) "
    "SELECT event_id, e.epoch AS epoch, coalesce(ts < wm, false) AS is_late "
    f"FROM {ARRIVALS_SQL} e JOIN w ON e.epoch = w.epoch"
)


@plan("stream_map", "SELECT event_id, user_id * 2 AS user_id2 FROM events")
def stream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrived = in_order(spark, sf_dir, "events")
    done = run_stream(spark, "map", [arrived], "SELECT event_id, user_id * 2 AS user_id2 FROM events")
    return done.feed.read().drop(EPOCH)


@plan("stream_filter", "SELECT event_id, event_type, value FROM events WHERE value > 50")
def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = run_stream(
        spark,
        "filter",
        [in_order(spark, sf_dir, "events")],
        lambda rows: rows["events"].where("value > 50").select("event_id", "event_type", "value"),
    )
    return done.feed.read().drop(EPOCH)


@plan("stream_old_files", "SELECT event_id, event_type FROM events")
def stream_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that were changed last on days far apart, the oldest after the newest."""
    path, storage = fresh_path(spark, "backfill"), Storage(spark)
    table(spark, sf_dir, "events").repartition(6).write.parquet(path)
    names = sorted(n for n in storage.names(path) if n.startswith("part-"))
    newest = storage.changed(f"{path}/{names[0]}")
    for k, name in enumerate(names):
        storage.set_changed(f"{path}/{name}", newest - k * 40 * 86400000)
    old = Source(spark, "events", parse_columns(COLUMNS["events"]), path)
    done = run_stream(spark, "old", [old], "SELECT event_id, event_type FROM events", max_files=2)
    return done.feed.read().drop(EPOCH)


@plan("stream_recovered", "SELECT user_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY user_id")
def stream_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the events, a new stream over the old one's state, then the other half."""
    events, path = table(spark, sf_dir, "events"), fresh_path(spark, "recovered")
    arrived = StoredSource(spark, "events", parse_columns(COLUMNS["events"]), f"{path}/events")
    for half in range(2):
        arrived.append(events.where(F.col("event_id") % 2 == half))
        stream = Stream(
            spark,
            "counts",
            f"{path}/counts",
            [arrived],
            "SELECT user_id, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY user_id",
            CHANGES,
            feed_files=1,
        )
        stream.run_available()
    return latest(stream.feed.read(), ["user_id"])


@plan("sink_delivered", "SELECT event_id, event_type, value FROM events WHERE value > 50")
def sink_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that gets each epoch as it ends."""
    path = fresh_path(spark, "delivered")
    stream = Stream(
        spark,
        "large",
        f"{path}/stream",
        [in_order(spark, sf_dir, "events")],
        "SELECT event_id, event_type, value FROM events WHERE value > 50",
        max_files=FILES_PER_EPOCH,
    )
    sink = Sink(spark, "out", stream, f"{path}/out")
    stream.after_epoch.append(sink.deliver)
    stream.run_available()
    return sink.read()


@plan("stream_running_avg", f"SELECT event_type, {exact_avg('value')} AS avg_v FROM events GROUP BY event_type")
def stream_running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = replay(spark, sf_dir).rollup
    return latest(rollup.feed.read(), ["event_type"]).select("event_type", "avg_v")


@plan("stream_running_count", "SELECT user_id, count(value) AS n FROM events GROUP BY user_id")
def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = run_stream(
        spark,
        "counts",
        [in_order(spark, sf_dir, "events")],
        "SELECT user_id, count(value) AS n FROM events GROUP BY user_id",
        emit=CHANGES,
    )
    return latest(done.feed.read(), ["user_id"])


_SUPPLIERS = f"SELECT l_suppkey, count(*) AS n, {exact_avg('l_quantity')} AS avg_quantity FROM lineitem GROUP BY l_suppkey"


@plan("stream_rollup", _SUPPLIERS)
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running average per key over the largest table."""
    done = run_stream(spark, "suppliers", [in_order(spark, sf_dir, "lineitem")], _SUPPLIERS, emit=CHANGES)
    return latest(done.feed.read(), ["l_suppkey"])


@plan("mv_latest", "SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY user_id")
def mv_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = run_stream(
        spark,
        "state",
        [in_order(spark, sf_dir, "events")],
        "SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY user_id",
        emit=CHANGES,
    )
    view = MaterializedView(spark, done, ["user_id"])
    view.fold()
    return view.read().withColumn("last_ts", utc("last_ts"))


_STATE = "SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY user_id"
_USERS = "SELECT user_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY user_id"


def _counting(spark: SparkSession, sf_dir: str, name: str, path: str, sql: str = _STATE) -> Stream:
    """A stream of changes per user over the appends in order, not run yet."""
    appended = [in_order(spark, sf_dir, "events")]
    return Stream(spark, name, path, appended, sql, CHANGES, feed_files=1, max_files=FILES_PER_EPOCH)


@plan("mv_buckets", _STATE)
def mv_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view folded after every epoch; each fold rewrites the buckets of the users that changed."""
    stream = _counting(spark, sf_dir, "buckets", fresh_path(spark, "mv-buckets"))
    view = MaterializedView(spark, stream, ["user_id"], buckets=16)
    stream.after_epoch.append(view.fold)
    stream.run_available()
    return view.state.read().drop(EPOCH).withColumn("last_ts", utc("last_ts"))


@plan("sink_upsert", _STATE)
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that holds the newest row of every user."""
    path = fresh_path(spark, "upsert")
    stream = _counting(spark, sf_dir, "upserted", f"{path}/stream")
    sink = UpsertSink(spark, "newest", stream, f"{path}/out", ["user_id"], buckets=16)
    stream.after_epoch.append(sink.deliver)
    stream.run_available()
    return sink.read().withColumn("last_ts", utc("last_ts"))


@plan("state_rows", _USERS)
def rows_of_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the running query itself keeps of every user."""
    stream = _counting(spark, sf_dir, "kept", fresh_path(spark, "state"), _USERS.replace("::BIGINT", ""))
    stream.run_available()
    return state_rows(stream).selectExpr("key.user_id AS user_id", "value.count AS n", "value.sum AS ids")


@plan(
    "feed_retained",
    "WITH t AS (SELECT user_id, (event_id >= s // 3)::INT + (event_id >= 2 * s // 3)::INT AS third "
    "FROM events, (SELECT max(event_id) + 1 AS s FROM events)), "
    "c AS (SELECT user_id, third, count(*) AS n FROM t GROUP BY user_id, third), "
    "r AS (SELECT user_id, third, (sum(n) OVER (PARTITION BY user_id ORDER BY third))::BIGINT AS n FROM c) "
    "SELECT 'view' AS kept_by, user_id, count(*) AS n FROM events GROUP BY user_id "
    "UNION ALL SELECT 'feed', user_id, n FROM r WHERE third >= 1",
)
def feed_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All but the newest epoch may go; a reader that had only the first keeps the others, a folded view none."""
    stream = _counting(
        spark, sf_dir, "retained", fresh_path(spark, "retained"), "SELECT user_id, count(*) AS n FROM events GROUP BY user_id"
    )
    view = MaterializedView(spark, stream, ["user_id"], buckets=4)
    stream.consumers.reach("reader slow", 0)
    stream.run_available()
    view.fold()
    stream.retain(1)
    rows = stream.feed.read(after=0).select(F.lit("feed").alias("kept_by"), "user_id", "n")
    return view.read().select(F.lit("view").alias("kept_by"), "user_id", "n").unionByName(rows)


@plan(
    "epoch_lineage",
    f"SELECT epoch, epoch AS first_append, epoch AS last_append, count(*) AS n_rows FROM {ARRIVALS_SQL} GROUP BY epoch",
)
def epoch_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The appends each epoch took in, and their rows."""
    done = replay(spark, sf_dir)
    log = done.plain.table.log().select(F.col("append_id"), "rows")
    taken = done.tap.lineage().withColumn("append_id", F.explode(F.sequence("first", "last")))
    return (
        taken.join(log, "append_id")
        .groupBy(EPOCH, F.col("first").alias("first_append"), F.col("last").alias("last_append"))
        .agg(F.sum("rows").alias("n_rows"))
    )


_BOTH = (
    "SELECT window.start AS w_start, kind, count(*) AS n FROM "
    "(SELECT ts, 'event' AS kind FROM events UNION ALL SELECT o_orderdate AS ts, 'order' AS kind FROM orders) "
    "GROUP BY window(ts, '10 days'), kind"
)
_BOTH_SQL = (
    "WITH b AS (SELECT ts, 'event' AS kind FROM events UNION ALL SELECT o_orderdate, 'order' FROM orders), "
    "r AS (SELECT least(date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR, TIMESTAMP '2024-02-20' - INTERVAL 2 DAY) AS wm FROM events), "
    "w AS (SELECT TIMESTAMP '1970-01-01' + INTERVAL 10 DAY * (epoch_us(ts) // 864000000000)::INT AS w_start, kind FROM b) "
    "SELECT w_start, kind, count(*) AS n FROM w, r WHERE w_start + INTERVAL 10 DAY <= wm GROUP BY w_start, kind"
)


@plan("window_two_sources", _BOTH_SQL)
def window_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over two sources with delays of their own close by the lesser watermark.

    The orders end years before the events: their heartbeat lets the events'
    windows close, up to where the events themselves have come.
    """
    path = fresh_path(spark, "two")
    events = source(spark, sf_dir, "events", watermark_column="ts", delay="1 hour", heartbeat_path=f"{path}/e")
    orders = source(spark, sf_dir, "orders", watermark_column="o_orderdate", delay="2 days", heartbeat_path=f"{path}/o")
    stream = Stream(spark, "both", path, [events, orders], _BOTH, ON_CLOSE, feed_files=1)
    stream.start()
    stream.run_available()
    orders.heartbeat(1708387200000)  # 20 February 2024
    stream.run_available()
    stream.stop()
    return stream.feed.read().drop(EPOCH).withColumn("w_start", utc("w_start"))


@plan(
    "windows_refused",
    f"WITH a AS (SELECT * FROM {ARRIVALS_SQL}), m AS (SELECT epoch, max(ts) AS mx FROM a GROUP BY epoch), "
    "w AS (SELECT epoch, date_trunc('millisecond', max(mx) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)) "
    "- INTERVAL 1 DAY AS wm FROM m) "
    "SELECT epoch, count(*) AS refused_rows FROM a JOIN w USING (epoch) "
    "WHERE time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= wm GROUP BY epoch",
)
def windows_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each epoch that came when their window of six hours had closed, by the watermarks the query ran under."""
    arrived = replay(spark, sf_dir).timed
    events = Source(spark, "events", arrived.schema, arrived.path, "ts", "1 day")
    stream = Stream(
        spark,
        "sixths",
        fresh_path(spark, "sixths"),
        [events],
        "SELECT window.start AS w_start, count(*) AS n FROM events GROUP BY window(ts, '6 hours')",
        CHANGES,
        max_files=FILES_PER_EPOCH,
        feed_files=1,
    )
    stream.run_available()
    return stream.refused()


@plan("window_incremental", _DAILY_SQL)
def window_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of a window is emitted; nothing is late under a 40 day delay."""
    arrived = replay(spark, sf_dir).timed
    done = run_stream(spark, "daily", [arrived], _DAILY, emit=CHANGES, max_files=4 * FILES_PER_EPOCH)
    return latest(done.feed.read(), ["w_start", "event_type"]).withColumn("w_start", utc("w_start"))


def _timed(spark: SparkSession, sf_dir: str, path: str) -> Source:
    """The events in order, with event time an hour behind the newest row and heartbeats of its own."""
    rows = in_order(spark, sf_dir, "events")
    return Source(spark, "events", rows.schema, rows.path, "ts", "1 hour", f"{path}/heartbeats")


@plan(
    "window_on_close",
    f"{_DAILY_SQL} HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= "
    "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)",
)
def window_on_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window is emitted once the watermark passed its end."""
    events = _timed(spark, sf_dir, fresh_path(spark, "beats"))
    done = run_stream(spark, "closed", [events], _DAILY, emit=ON_CLOSE)
    return done.feed.read().drop(EPOCH).withColumn("w_start", utc("w_start"))


@plan("heartbeat_close", _DAILY_SQL)
def heartbeat_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heartbeat past the last event closes the windows still open."""
    path = fresh_path(spark, "heartbeat")
    events = _timed(spark, sf_dir, path)
    stream = Stream(
        spark, "closed", path, [events], _DAILY, emit=ON_CLOSE, max_files=FILES_PER_EPOCH, feed_files=1
    )
    stream.run_available()
    newest = events.bounded().agg(F.unix_millis(F.max("ts")).alias("ms")).first()["ms"]
    events.heartbeat(newest + 2 * 86400000)
    stream.run_available()
    return stream.feed.read().drop(EPOCH).withColumn("w_start", utc("w_start"))


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = replay(spark, sf_dir).tap.feed
    return split_late(feed.read(), epoch_watermarks(feed.log(), "3 days"), "ts")


@plan("late_split", _LATE_SQL)
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_rows(spark, sf_dir).select("event_id", EPOCH, "is_late")


@plan("late_counts", f"SELECT epoch, count(*) AS n_late FROM ({_LATE_SQL}) WHERE is_late GROUP BY epoch")
def late_counts_by_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_counts(_late_rows(spark, sf_dir))


@plan("source_watermark", "SELECT 'events' AS source, epoch_us(max(ts)) // 1000 AS watermark FROM events")
def one_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_watermark(table(spark, sf_dir, "events"), "events", "ts")


@plan(
    "pipeline_watermark",
    "SELECT least((SELECT epoch_us(max(ts)) // 1000 FROM events), (SELECT epoch_us(max(o_orderdate)) // 1000 FROM orders), "
    "(SELECT epoch_us(max(l_shipdate)) // 1000 FROM lineitem)) AS watermark",
)
def least_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    return pipeline_watermark([source_watermark(table(spark, sf_dir, t), t, c) for t, c in times.items()])
