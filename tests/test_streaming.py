"""Streams, change feeds, event time, recovery."""

import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.errors import FreshetError
from freshet.functions.logical import parse_columns
from freshet.operators.lateness import epoch_watermarks, late_counts, refused, split_late
from freshet.operators.metrics import (
    pipeline_totals,
    pipeline_watermark,
    source_metrics,
    source_watermark,
    stream_metrics,
)
from freshet.session import fresh_path
from freshet.sources.source import StoredSource
from freshet.streaming.feed import barriers, lag, latest, replay, tail
from freshet.streaming.sink import Sink
from freshet.streaming.stream import CHANGES, ON_CLOSE, Stream
from freshet.streaming.subscription import PushSubscription, Subscription
from freshet.streaming.view import MaterializedView

ROLLUP = "SELECT device, avg(value) AS avg_v FROM sensors GROUP BY device"
MINUTES = "SELECT window.start AS w, count(*) AS n FROM sensors GROUP BY window(ts, '1 minute')"


@pytest.fixture
def make(spark):
    """A source and a function that adds streams over it; stops them at the end."""
    started = []

    class Setup:
        def source(self, watermark=None, delay="0 seconds", path=None):
            columns = parse_columns("ts TIMESTAMP, device VARCHAR, value DOUBLE")
            return StoredSource(spark, "sensors", columns, path or fresh_path(spark, "sensors"), watermark, delay)

        def stream(self, sources, query, name="rollup", path=None, **options):
            stream = Stream(spark, name, path or fresh_path(spark, name), sources, query, **options)
            started.append(stream)
            return stream

    yield Setup()
    for stream in started:
        stream.stop()


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def code_of(call):
    with pytest.raises(FreshetError) as error:
        call()
    return error.value.code


def test_running_average_emits_changed_groups(make):
    source = make.source()
    stream = make.stream([source], ROLLUP)
    source.insert([{"device": "a", "value": 2}, {"device": "b", "value": 1}])
    first = stream.run_available()
    assert (first.success, first.epoch, first.checkpoint_id) == (True, 0, 1)
    source.insert([{"device": "a", "value": 4}])
    assert stream.run_available().epoch == 1
    assert stream.run_available().epoch == 1  # nothing arrived
    assert values(stream.feed.read(), "epoch", "device", "avg_v") == [(0, "a", 2.0), (0, "b", 1.0), (1, "a", 3.0)]
    assert values(latest(stream.feed.read(), ["device"]), "device", "avg_v") == [("a", 3.0), ("b", 1.0)]
    assert values(barriers(stream.feed), "epoch", "checkpoint_id", "through_sequence") == [(0, 1, 0), (1, 2, 1)]
    assert values(stream.progress(), "epoch", "input_rows") == [(0, 2), (1, 1)]


def test_stateless_stream(make, spark):
    source = StoredSource(spark, "s", parse_columns("a INT"), fresh_path(spark, "s"))
    stream = make.stream([source], "SELECT a * 2 AS a2 FROM s", "t")
    source.insert([{"a": 1}, {"a": 2}])
    stream.run_available()
    assert stream.schema.names == ["a2"]
    assert values(stream.feed.read(), "a2") == [(2,), (4,)]


def test_recovery_keeps_state_and_epochs(make):
    source = make.source()
    first = make.stream([source], ROLLUP)
    source.insert([{"device": "a", "value": 1}])
    first.run_available()
    source.insert([{"device": "a", "value": 3}])
    again = make.stream([source], ROLLUP, path=first.path)
    assert again.run_available().epoch == 1
    assert values(again.feed.read(), "epoch", "avg_v") == [(0, 1.0), (1, 2.0)]


def test_first_restart_after_a_lost_commit_mark(make):
    """The feed has the epoch, Spark's own mark of it is missing: the batch runs again and changes nothing."""
    source = make.source()
    first = make.stream([source], ROLLUP)
    for value in (1, 3):
        source.insert([{"device": "a", "value": value}])
        first.run_available()
    want = values(first.feed.read(), "epoch", "device", "avg_v")
    marks = f"{first.path}/checkpoint/commits"
    for name in ("1", ".1.crc"):
        first._storage.delete(f"{marks}/{name}")
    again = make.stream([source], ROLLUP, path=first.path)
    assert again.run_available().epoch == 1
    assert values(again.feed.read(), "epoch", "device", "avg_v") == want
    source.insert([{"device": "a", "value": 5}])
    again.run_available()
    assert values(again.feed.read(after=1), "epoch", "avg_v") == [(2, 3.0)]


def test_every_micro_batch_is_reported(make, spark):
    source = StoredSource(spark, "s", parse_columns("a BIGINT"), fresh_path(spark, "s"))
    source.append(spark.range(0, 120, 1, 120).toDF("a"))
    stream = make.stream([source], "SELECT a FROM s", "tap", max_files=1)
    stream.run_available()
    assert stream.progress().agg(F.sum("input_rows"), F.count("*")).first()[:] == (120, 120)


def test_views_and_sinks_refuse_gaps(make, spark):
    source = make.source()
    stream = make.stream([source], ROLLUP)
    view, sink = MaterializedView(spark, stream, ["device"]), Sink(spark, "out", stream, fresh_path(spark, "out"))
    for k in range(3):
        source.insert([{"device": f"d{k}", "value": 1}])
        stream.run_available()
    stream.feed.retain(1)
    assert code_of(view.read) == 502 and code_of(sink.deliver) == 502


def test_definition_is_pinned(make):
    source = make.source()
    first = make.stream([source], ROLLUP)
    changed = "SELECT value AS device, avg(value) AS avg_v FROM sensors GROUP BY value"
    assert code_of(lambda: make.stream([source], changed, path=first.path)) == 400


def test_feed_commit_survives_a_replayed_batch(make):
    source = make.source()
    stream = make.stream([source], ROLLUP)
    source.insert([{"device": "a", "value": 1}])
    stream.run_available()
    # Spark may hand the same epoch to the writer again after a failure.
    stream._write(stream.feed.read().drop("epoch"), 0)
    assert stream.feed.read().count() == 1 and stream.feed.last() == 0


def test_window_emission_on_close_and_incremental(make):
    source = make.source("ts", "10 seconds")
    closing = make.stream([source], MINUTES, "closing", emit=ON_CLOSE)
    changing = make.stream([source], MINUTES, "changing", emit=CHANGES)
    source.insert([{"ts": 10_000}, {"ts": 70_000}])
    for stream in (closing, changing):
        stream.run_available()
    # Watermark 60 s: the first minute is closed, the second is not.
    assert values(closing.feed.read().select(F.unix_millis("w").alias("w"), "n"), "w", "n") == [(0, 1)]
    newest = latest(changing.feed.read(), ["w"]).select(F.unix_millis("w").alias("w"), "n")
    assert values(newest, "w", "n") == [(0, 1), (60_000, 1)]


def test_heartbeat_closes_windows_without_rows(make):
    source = make.source("ts")
    stream = make.stream([source], MINUTES, emit=ON_CLOSE)
    source.insert([{"ts": 10_000}])
    stream.run_available()
    assert stream.feed.read().count() == 0
    source.heartbeat(60_000)
    stream.run_available()
    assert values(stream.feed.read(), "n") == [(1,)]
    # The heartbeat moved event time, so an older row no longer counts.
    source.insert([{"ts": 5_000}])
    source.heartbeat(200_000)
    stream.run_available()
    assert values(stream.feed.read(), "n") == [(1,)]


def test_default_emission(make):
    timed = make.source("ts")
    windowed = make.stream([timed], MINUTES, "windowed")
    grouped = make.stream([timed], ROLLUP, "grouped")
    timed.insert([{"ts": 1, "device": "a", "value": 1}])
    windowed.run_available()
    grouped.run_available()
    assert windowed.feed.read().count() == 0  # waits for the close
    assert grouped.feed.read().count() == 1  # cannot close, emits changes


def test_pipeline_watermark_is_the_minimum(make, spark):
    left = make.source("ts")
    right = StoredSource(spark, "other", left.schema, fresh_path(spark, "other"), "ts")
    both = make.stream(
        [left, right],
        lambda s: s["sensors"].union(s["other"]).groupBy(F.window("ts", "1 minute").alias("w")).count(),
        emit=ON_CLOSE,
    )
    left.insert([{"ts": 10_000}, {"ts": 200_000}])
    right.insert([{"ts": 20_000}, {"ts": 50_000}])
    both.run_available()
    assert both.feed.read().count() == 0  # right is only at 50 s
    right.insert([{"ts": 61_000}])
    both.run_available()
    assert values(both.feed.read(), "count") == [(3,)]
    assert (left.watermark(), right.watermark()) == (200_000, 61_000)
    marks = [source_watermark(s.bounded(), s.name, "ts") for s in (left, right)]
    assert pipeline_watermark(marks).first()["watermark"] == 61_000


def test_progress_per_source_leaves_heartbeats_out(make, spark):
    left = make.source("ts")
    right = StoredSource(spark, "other", left.schema, fresh_path(spark, "other"), "ts")
    both = make.stream([left, right], lambda s: s["sensors"].union(s["other"]))
    left.insert([{"ts": 1}] * 3)
    left.heartbeat(5)
    right.insert([{"ts": 1}] * 2)
    both.run_available()
    assert values(both.progress(), "source", "input_rows") == [("other", 2), ("sensors", 3)]


def entries(rows):
    """Log entries as commits in the order of epochs make them."""
    log = rows.groupBy("epoch").agg(F.max(F.unix_micros("ts")).alias("newest"))
    earlier = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    return log.select("epoch", F.max("newest").over(earlier).alias("newest_before_us"))


def test_refused_rows_are_those_of_closed_windows(spark):
    rows = spark.createDataFrame([(0, 100), (1, 59), (1, 61), (1, 99), (2, 119)], "epoch bigint, s bigint")
    rows = rows.withColumn("ts", F.timestamp_seconds("s"))
    got = refused(rows, epoch_watermarks(entries(rows), "10 seconds"), "ts", "1 minute")
    assert values(got, "epoch", "s") == [(1, 59)]


def test_late_rows(spark):
    rows = spark.createDataFrame(
        [(0, 100), (0, 40), (1, 94), (1, 95), (1, 96), (2, 200), (3, 1)], "epoch bigint, s bigint"
    ).withColumn("ts", F.timestamp_seconds("s"))
    log = entries(rows)
    flagged = split_late(rows, epoch_watermarks(log, "5 seconds"), "ts")
    late = values(flagged.where("is_late"), "epoch", "s")
    assert late == [(1, 94), (3, 1)]
    assert values(late_counts(flagged), "epoch", "n_late") == [(1, 1), (3, 1)]


def brute_force_late(rows, delay):
    newest, late, by_epoch = None, set(), {}
    for epoch, _, second in rows:
        by_epoch.setdefault(epoch, []).append(second)
    for epoch in sorted(by_epoch):
        late |= {(e, i) for e, i, s in rows if e == epoch and newest is not None and s < newest - delay}
        newest = max([*by_epoch[epoch], *([newest] if newest is not None else [])])
    return late


def test_late_rows_against_brute_force(spark):
    rows = [(e, i, (i * 7919 + e * 131) % 500) for e in range(9) for i in range(40)]
    df = spark.createDataFrame(rows, "epoch bigint, i bigint, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    log = entries(df)
    flagged = split_late(df, epoch_watermarks(log, "100 seconds"), "ts")
    assert flagged.count() == len(rows)
    assert set(values(flagged.where("is_late"), "epoch", "i")) == brute_force_late(rows, 100)


@pytest.fixture
def filled(make):
    """A pass-through feed of epochs 0..5 with epoch + 1 rows each."""
    source = make.source()
    stream = make.stream([source], "SELECT device, value FROM sensors", "tap")
    for epoch in range(6):
        source.insert([{"device": f"d{epoch}", "value": v} for v in range(epoch + 1)])
        stream.run_available()
    return source, stream


def test_replay_tail_filter_retention_lag(spark, filled):
    _, stream = filled
    feed = stream.feed
    assert values(replay(feed, 3), "epoch", "value") == [(4, float(v)) for v in range(5)] + [
        (5, float(v)) for v in range(6)
    ]
    assert values(replay(feed, 3, "value >= 4"), "epoch", "value") == [(4, 4.0), (5, 4.0), (5, 5.0)]
    assert tail(feed, feed.last()).count() == 0 and tail(feed, 4).count() == 6
    assert feed.read(upto=1).count() == 3
    assert feed.retain(2) == 4 and feed.retain(2) == 0 and feed.first_retained() == 4
    assert code_of(lambda: replay(feed, 2)) == 502
    assert replay(feed, 3).count() == 11
    assert barriers(feed).count() == 6  # barriers stay
    consumers = spark.createDataFrame([(-1,), (0,), (3,), (5,)], "consumer_epoch bigint")
    got = lag(feed.log(), consumers, feed.first_retained())
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert values(got, "consumer_epoch", "skipped", "skipped_rows") == [(-1, 4, 10), (0, 3, 9), (3, 0, 0), (5, 0, 0)]


def test_replay_prunes_and_pushes_down(filled):
    _, stream = filled
    rows = replay(stream.feed, 3, "value >= 4").select("device")
    assert "GreaterThanOrEqual(value,4.0)" in rows._jdf.queryExecution().executedPlan().toString()
    files = rows.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("/")[-2] for r in files} == {"epoch=4", "epoch=5"}
    whole = stream.feed.read(upto=3).select("device")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in whole


def test_materialized_view_folds(make, spark):
    source = make.source()
    stream = make.stream([source], ROLLUP)
    view = MaterializedView(spark, stream, ["device"])
    assert view.fold() is None and view.read().count() == 0
    source.insert([{"device": "a", "value": 1}, {"device": "b", "value": 5}])
    stream.run_available()
    assert view.fold() == 0
    source.insert([{"device": "a", "value": 3}])
    stream.run_available()
    expected = [("a", 2.0), ("b", 5.0)]
    assert values(view.read(), "device", "avg_v") == expected
    assert view.fold() == 1 and view.fold() == 1
    stream.feed.retain(1)
    assert values(view.read(), "device", "avg_v") == expected
    assert view.updates().first()["mv_updates"] == 3
    assert view.bytes_stored().first()["mv_bytes_stored"] > 0


def test_sink_delivers_once(make, spark):
    source = make.source()
    stream = make.stream([source], "SELECT device FROM sensors", "tap")
    sink = Sink(spark, "out", stream, fresh_path(spark, "out"))
    assert sink.deliver() == 0
    source.insert([{"device": "a"}])
    stream.run_available()
    assert sink.deliver() == 1 and sink.deliver() == 0
    source.insert([{"device": "b"}, {"device": "c"}])
    stream.run_available()
    assert sink.deliver() == 2
    assert values(sink.read(), "device") == [("a",), ("b",), ("c",)]


def test_counters(make, filled):
    source, stream = filled
    row = source_metrics(source.table.log(), "sensors", capacity=10, processed_through=3).first()
    assert (row["total_events"], row["pending"], row["utilization"], row["is_backpressured"]) == (21, 11, 1.0, True)
    row = source_metrics(source.table.log(), "sensors", capacity=10, processed_rows=13).first()
    assert (row["pending"], row["utilization"], row["is_backpressured"]) == (8, 0.8, False)
    assert stream_metrics(stream.feed.log(), "tap").first()["total_events"] == 21
    row = pipeline_totals([source.table.log()], [stream.feed.log()]).first()
    assert row.asDict() == {
        "total_events_ingested": 21,
        "total_events_dropped": 0,
        "total_batches": 6,
        "total_events_emitted": 21,
        "total_cycles": 6,
    }


def test_pull_subscription(filled):
    source, stream = filled
    sub = Subscription(stream, "value >= 3", after=3)
    assert sub.schema.names == ["device", "value"]
    frames = list(sub.committed())
    assert [(f.kind, f.sequence) for f in frames] == [("data", 4), ("barrier", 4), ("data", 5), ("barrier", 5)]
    assert values(frames[0].batch, "value") == [(3.0,), (4.0,)]
    assert (frames[3].epoch, frames[3].checkpoint_id, frames[3].through_sequence) == (5, 6, 5)
    with pytest.raises(TimeoutError):
        sub.next_frame(timeout=0.1)
    source.insert([{"device": "late", "value": 9}])
    stream.run_available()
    assert values(sub.next_frame(timeout=5).batch, "device") == [("late",)]
    sub.cancel()
    assert sub.next_frame() is None and not sub.is_active


def test_subscription_lags_out(filled):
    _, stream = filled
    sub = Subscription(stream, after=0)
    assert sub.next_frame().kind == "data"
    stream.feed.retain(1)
    assert sub.next_frame().kind == "barrier"
    with pytest.raises(FreshetError) as error:
        sub.next_frame()
    assert error.value.code == 502 and "3 commits behind" in error.value.message
    assert sub.next_frame() is None and not sub.is_active
    assert code_of(lambda: Subscription(stream, after=2)) == 502


def test_subscription_ends_with_the_stream(filled):
    _, stream = filled
    sub = Subscription(stream)
    stream.stop()
    assert code_of(sub.next_frame) == 500
    assert sub.next_frame() is None


def test_push_subscription_is_serial(make):
    source = make.source()
    stream = make.stream([source], ROLLUP)
    stream.start()
    seen, errors, closed, flying = [], [], [], []

    def on_data(frame):
        flying.append(1)
        assert len(flying) == 1
        time.sleep(0.15)
        if frame.kind == "data":
            seen.append(frame.batch.first()["avg_v"])
        flying.pop()

    push = PushSubscription(lambda: Subscription(stream), on_data, errors.append, lambda: closed.append(1))
    source.insert([{"device": "a", "value": 3}])
    source.insert([{"device": "a", "value": 3}])
    deadline = time.monotonic() + 60
    while not seen and time.monotonic() < deadline:
        time.sleep(0.05)
    push.close()
    push.close()
    assert seen and seen[0] == 3.0 and errors == [] and closed == [1] and not push.is_active


def test_push_handler_failure_ends_it(filled):
    _, stream = filled
    errors, closed = [], []

    def fail(frame):
        raise RuntimeError("no")

    push = PushSubscription(lambda: Subscription(stream, after=0), fail, errors.append, lambda: closed.append(1))
    push._thread.join(timeout=30)
    assert [e.code for e in errors] == [900] and closed == [1]


def test_push_open_failure_is_reported(filled):
    _, stream = filled
    stream.feed.retain(1)
    errors, closed = [], []
    push = PushSubscription(
        lambda: Subscription(stream, after=0), lambda f: None, errors.append, lambda: closed.append(1)
    )
    push.close()
    assert [e.code for e in errors] == [502] and closed == [1]


def test_feed_of_a_stateful_stream_has_few_files(make, spark):
    source = make.source()
    stream = make.stream([source], ROLLUP, state_partitions=6, feed_files=1)
    for value in range(3):
        source.insert([{"device": f"d{i}", "value": value} for i in range(30)])
        stream.run_available()
    files = stream.feed.read(after=1).select(F.input_file_name().alias("f")).distinct().collect()
    assert [r["f"].split("/")[-2] for r in files] == ["epoch=2"]
    assert stream.feed.read(after=1).count() == 30


def test_one_key_with_a_third_of_the_rows(make, spark):
    """Running and latest counts stay exact when one key dominates."""
    source = make.source()
    stream = make.stream([source], "SELECT device, count(*) AS n, sum(value) AS total FROM sensors GROUP BY device")
    rows = spark.range(30_000).select(
        F.lit(None).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 500)).alias("device"),
        F.lit(1.0).alias("value"),
    )
    for _ in range(2):
        source.append(rows)
        stream.run_available()
    newest = latest(stream.feed.read(), ["device"])
    assert newest.where("device = 'hot'").first()["n"] == 20_000
    assert newest.agg(F.sum("n")).first()[0] == 60_000
    want = source.bounded().groupBy("device").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    assert newest.exceptAll(want).count() == 0 and want.exceptAll(newest).count() == 0
