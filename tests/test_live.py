"""Live ingestion, refused rows, keyed state, retention by need, lineage and state."""

import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from freshet.errors import FreshetError
from freshet.functions.logical import parse_columns
from freshet.session import Storage, fresh_path
from freshet.sources.keyed_table import KeyedTable
from freshet.operators.results import Result
from freshet.sources import arrow_ipc
from freshet.sources.source import BACKLOG, Admission, StoredSource
from freshet.streaming.ingestion import Ingestion, files_arriving
from freshet.streaming.sink import Sink, UpsertSink
from freshet.streaming.state import state_changes, state_rows
from freshet.streaming.stream import CHANGES, EPOCH, Stream
from freshet.streaming.view import MaterializedView
from freshet.workspace import Config, open_workspace

HOUR = 3_600_000
DAY = 24 * HOUR


# -- live ingestion --------------------------------------------------------


def land(spark, path, rows):
    spark.createDataFrame(rows, "id bigint, v double").coalesce(1).write.mode("append").json(path)


def live(spark, path, source):
    return Ingestion(spark, "live", source, files_arriving(f"{path}/in", "id bigint, v double"), f"{path}/live", row_id="id")


def sorted_ids(rows):
    return sorted(r["id"] for r in rows.collect())


def test_each_row_is_stored_or_refused(spark):
    path = fresh_path(spark, "ingestion")
    source = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    ingestion = live(spark, path, source)
    assert ingestion.run_available().epoch == -1 and source.rejects().count() == 0
    land(spark, f"{path}/in", [(1, 1.0), (2, 2.5), (3, 3.0)])
    ingestion.run_available()
    land(spark, f"{path}/in", [(4, 0.5)])
    ingestion.run_available()
    assert sorted_ids(source.bounded()) == [1, 3]
    told = {json.loads(r["row"])["id"]: r for r in source.rejects().collect()}
    assert set(told) == {2, 4} and {r["reject_column"] for r in told.values()} == {"v"}
    assert "(row 2)" in told[2]["reject_reason"] and told[2]["append_id"] == 0 and told[4]["append_id"] == 1
    assert ingestion.totals().first().asDict() == {"accepted": 2, "refused": 2}
    # One write: rows that were accepted carry nothing of the raw row.
    stored = spark.read.parquet(f"{path}/s/data/append_id=0")
    assert stored.where("row IS NOT NULL OR reject_reason IS NOT NULL").count() == 0


def test_a_replayed_batch_adds_nothing(spark):
    path, storage = fresh_path(spark, "ingestion"), Storage(spark)
    source = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    land(spark, f"{path}/in", [(k, k / 2) for k in range(20)])
    live(spark, path, source).run_available()
    # As if the driver had died after the append and before the batch was done.
    storage.delete(f"{path}/live/checkpoint/commits/0")
    other = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    other.append(spark.createDataFrame([(100, 1)], "id bigint, v int"))
    again = live(spark, path, other)
    again.run_available()
    land(spark, f"{path}/in", [(50, 1.0)])
    again.run_available()
    assert sorted_ids(other.bounded()) == [*range(0, 20, 2), 50, 100]
    assert other.rejects().count() == 10
    assert again.totals().first().asDict() == {"accepted": 11, "refused": 10}


def test_a_batch_that_died_before_its_claim_is_taken_in(spark):
    path, storage = fresh_path(spark, "ingestion"), Storage(spark)
    source = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    ingestion = live(spark, path, source)
    storage.write_text(f"{path}/live/intents/0.json", '{"after": null}')
    land(spark, f"{path}/in", [(1, 1.0), (2, 0.5)])
    ingestion.run_available()
    assert sorted_ids(source.bounded()) == [1] and source.rejects().count() == 1


def test_a_claimed_batch_is_published_by_a_reader(spark, monkeypatch):
    path = fresh_path(spark, "ingestion")
    source = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    raw = spark.createDataFrame([(1, 1.0), (2, 0.5)], "id bigint, v double")
    with monkeypatch.context() as patch:
        patch.setattr(source.table, "_publish", lambda *_: None)
        source.append_judged(raw)
    other = StoredSource(spark, "s", parse_columns("id BIGINT, v INT"), f"{path}/s")
    assert other.rejects().count() == 1 and sorted_ids(other.bounded()) == [1]


def test_workspace_ingestion_comes_back_and_feeds_streams(spark, open_ws):
    path = fresh_path(spark, "workspace")
    ws = open_ws(path)
    ws.create_source("s", "id BIGINT, v INT")
    ws.create_ingestion("arriving", "s", f"{path}/in", "id bigint, v double")
    ws.create_stream("doubled", "SELECT id, v * 2 AS v2 FROM s")
    land(spark, f"{path}/in", [(1, 1.0), (2, 0.5)])
    ws.run_available()
    ws.close()
    again = open_ws(path)
    land(spark, f"{path}/in", [(3, 4.0)])
    again.run_available()
    got = {(r["id"], r["v2"]) for r in again._stream("doubled").feed.read().collect()}
    assert got == {(1, 2), (3, 8)}
    assert again.ingestion("arriving").totals().first()["refused"] == 1
    with pytest.raises(FreshetError) as error:
        again.ingestion("none")
    assert error.value.code == 200


# -- refused rows ----------------------------------------------------------


def timed(ws, name="s", delay="1 hour"):
    return ws.create_source(name, "ts TIMESTAMP, v INT", watermark_column="ts", delay=delay)


def put(ws, *millis, source="s", v=1):
    ws.insert(source, [{"ts": m, "v": v} for m in millis])


def refused(ws):
    return ws.metrics().first()["total_events_dropped"]


def test_a_late_row_in_an_open_window_is_not_refused(open_ws):
    ws = open_ws()
    timed(ws)
    ws.create_stream("daily", "SELECT window.start AS w, count(*) AS n FROM s GROUP BY window(ts, '1 day')", emit=CHANGES)
    put(ws, 20 * HOUR)
    ws.run_available()
    put(ws, 1 * HOUR)
    ws.run_available()
    feed = ws._stream("daily").feed.read()
    assert feed.agg(F.max("n")).first()[0] == 2 and refused(ws) == 0


def test_refusals_match_what_the_feed_leaves_out(open_ws):
    """A brute count: rows put in less the rows that windows counted."""
    draw = random.Random(7)
    ws = open_ws()
    timed(ws, delay="2 hours")
    ws.create_stream("hourly", "SELECT window.start AS w, count(*) AS n FROM s WHERE v > 0 GROUP BY window(ts, '3 hours')", emit=CHANGES)
    total = 0
    for k in range(7):
        rows = [(k * 2 * HOUR + draw.randint(-9, 3) * HOUR + 12 * HOUR, draw.choice([0, 1, 1])) for _ in range(12)]
        for v in (0, 1):
            put(ws, *[m for m, own in rows if own == v], v=v)
        total += sum(v for _, v in rows)
        ws.run_available()
        counted = ws._stream("hourly").feed.read().groupBy("w").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
        assert refused(ws) == total - counted
    assert refused(ws) > 0
    per_epoch = ws._stream("hourly").refused().collect()
    assert sum(r["refused_rows"] for r in per_epoch) == refused(ws)


def test_sliding_windows_and_windows_of_functions(open_ws):
    ws = open_ws()
    timed(ws, delay="0 seconds")
    ws.create_stream(
        "sliding", lambda s: s["s"].groupBy(F.window("ts", "2 hours", "1 hour")).count(), ["s"], CHANGES, window="window(ts, '2 hours', '1 hour')"
    )
    ws.create_stream("plain", "SELECT v, count(*) AS n FROM s GROUP BY v", emit=CHANGES)
    put(ws, 10 * HOUR)
    ws.run_available()
    # The first has an open window still, the second none.
    put(ws, 9 * HOUR + 1, 8 * HOUR)
    ws.run_available()
    assert [tuple(r) for r in ws._stream("sliding").refused().collect()][0][1] == 1
    assert ws._stream("plain").refused().count() == 0
    with pytest.raises(FreshetError) as error:
        ws.create_stream("bad", lambda s: s["s"], ["s"], window="ts + 1")
    assert error.value.code == 600 or error.value.code


def test_refusals_of_epochs_the_query_log_has_forgotten(open_ws, spark):
    ws = open_ws()
    timed(ws, delay="0 seconds")
    stream = ws.create_stream("hourly", "SELECT window.start AS w, count(*) AS n FROM s GROUP BY window(ts, '1 hour')", emit=CHANGES)
    put(ws, 50 * HOUR)
    ws.run_available()
    put(ws, 2 * HOUR, 3 * HOUR)
    ws.run_available()
    Storage(spark).delete(f"{stream.checkpoint_path}/offsets/0")
    assert refused(ws) == 2
    put(ws, 4 * HOUR)
    ws.run_available()
    assert refused(ws) == 3


# -- keyed state -----------------------------------------------------------


def keyed(spark, path, buckets=8):
    schema = parse_columns("k BIGINT, v VARCHAR, epoch BIGINT")
    return KeyedTable(spark, path, schema, ["k"], "epoch", buckets)


def test_untouched_buckets_keep_their_files(spark):
    table = keyed(spark, fresh_path(spark, "keyed"))
    first = spark.range(200).selectExpr("id AS k", "concat('a', id) AS v", "0L AS epoch")
    table.merge(first, 0)
    before = table.files()
    assert len(before) == 8 and all(len(names) == 1 for names in before.values())
    table.merge(spark.createDataFrame([(5, "x", 1), (5, "y", 2), (900, "new", 2)], "k long, v string, epoch long"), 2)
    after = table.files()
    touched = {b for b in after if after[b] != before[b]}
    assert 1 <= len(touched) <= 2
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(got) == 201 and got[5] == "y" and got[900] == "new" and got[6] == "a6"
    # A merge that was done already, and one that changes nothing.
    assert table.merge(first, 2)["number"] == 1 and table.files() == after
    table.merge(first.limit(0), 3)
    assert table.files() == after and table.upto == 3
    # Files that no version needs go.
    names = Storage(spark).names(f"{table.path}/rows")
    for n in range(4, 9):
        table.merge(spark.createDataFrame([(5, str(n), n)], "k long, v string, epoch long"), n)
    assert len(Storage(spark).names(f"{table.path}/rows")) <= len(names) + 2
    assert {r["k"]: r["v"] for r in table.read().collect()} == {**got, 5: "8"}
    assert table.bytes_stored() > 0


def test_layout_stays_and_null_keys_count(spark):
    path = fresh_path(spark, "keyed")
    keyed(spark, path, 4).merge(spark.createDataFrame([(None, "n", 0), (1, None, 0)], "k long, v string, epoch long"), 0)
    again = keyed(spark, path, 99)
    assert again.buckets == 4
    again.merge(spark.createDataFrame([(None, None, 1)], "k long, v string, epoch long"), 1)
    assert {(r["k"], r["v"]) for r in again.read().collect()} == {(None, None), (1, None)}
    schema = parse_columns("k BIGINT, v VARCHAR, epoch BIGINT")
    with pytest.raises(FreshetError):
        KeyedTable(spark, path, schema, ["v"], "epoch")
    with pytest.raises(FreshetError):
        KeyedTable(spark, path, schema, ["nothing"], "epoch")


def test_merges_at_the_same_time_lose_nothing(spark):
    path = fresh_path(spark, "keyed")
    table = keyed(spark, path)
    table.merge(spark.createDataFrame([(0, "a", 0)], "k long, v string, epoch long"), 0)

    def merge(n):
        keyed(spark, path).merge(spark.createDataFrame([(k, f"{n}", n) for k in range(n * 10)], "k long, v string, epoch long"), 3)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(merge, [1, 2, 3]))
    # All reach epoch 3: one of them won, the others found it done.
    assert table.upto == 3 and table.read().count() in (10, 20, 30)


def counting(spark, open_ws, name="counts"):
    ws = open_ws()
    ws.create_source("s", "k BIGINT, v INT")
    stream = ws.create_stream(name, "SELECT k, count(*) AS n, sum(v) AS total FROM s GROUP BY k", emit=CHANGES)
    return ws, stream


def test_view_folds_only_what_changed(spark, open_ws):
    ws, stream = counting(spark, open_ws)
    view = MaterializedView(spark, stream, ["k"], buckets=8)
    ws.insert("s", [{"k": k, "v": 1} for k in range(60)])
    ws.run_available()
    view.fold()
    before = view.state.files()
    ws.insert("s", [{"k": 7, "v": 5}])
    ws.run_available()
    view.fold()
    after = view.state.files()
    assert sum(after[b] != before[b] for b in after) == 1
    got = {r["k"]: (r["n"], r["total"]) for r in view.read().collect()}
    assert len(got) == 60 and got[7] == (2, 6) and got[8] == (1, 1)


def test_upsert_sink_of_a_workspace(spark, open_ws):
    path = fresh_path(spark, "workspace")
    ws = open_ws(path)
    ws.create_source("s", "k BIGINT, v INT")
    ws.create_stream("counts", "SELECT k, count(*) AS n FROM s GROUP BY k", emit=CHANGES)
    ws.create_sink("out", "counts", f"{path}/out", keys=["k"])
    ws.insert("s", [{"k": 1, "v": 1}, {"k": 2, "v": 1}])
    ws.run_available()
    ws.close()
    again = open_ws(path)
    again.insert("s", [{"k": 1, "v": 1}])
    again.run_available()
    assert isinstance(again.sink("out"), UpsertSink)
    assert {(r["k"], r["n"]) for r in again.sink("out").read().collect()} == {(1, 2), (2, 1)}
    assert again.sink("out").deliver() == 0


# -- retention by need -----------------------------------------------------


def epochs_of(stream):
    return sorted(r[0] for r in stream.feed.read(after=(stream.feed.first_retained() or 0) - 1).select(EPOCH).distinct().collect())


def grown(ws, n=4):
    for k in range(n):
        ws.insert("s", [{"k": k % 2, "v": k}])
        ws.run_available()


def test_retention_waits_for_views_sinks_and_readers(spark, open_ws):
    ws, stream = counting(spark, open_ws)
    view = MaterializedView(spark, stream, ["k"])
    sink = Sink(spark, "slow", stream, fresh_path(spark, "slow"))
    grown(ws, 2)
    reader = ws.subscribe("counts", from_epoch=-1, reader="me")
    grown(ws, 2)
    assert ws.retain("counts", 1) == 0 and epochs_of(stream) == [0, 1, 2, 3]
    view.fold()
    sink.deliver()
    frames = reader.committed()
    while next(frames).epoch != 1:
        pass
    assert stream.consumers.positions() == {"view by k": 3, "sink slow": 3, "reader me": 1}
    assert ws.retain("counts", 1) == 2 and epochs_of(stream) == [2, 3]
    # A reader that comes back goes on where it stopped.
    back = ws.subscribe("counts", reader="me")
    assert [f.epoch for f in back.committed() if f.kind == "barrier"] == [2, 3]
    assert ws.retain("counts", 1) == 1
    assert {r["k"]: r["n"] for r in view.read().collect()} == {0: 2, 1: 2}
    assert {r["consumer"] for r in stream.consumers.table().collect()} == {"view by k", "sink slow", "reader me"}


def test_retention_by_age_and_against_need(spark, open_ws):
    ws, stream = counting(spark, open_ws)
    ws.subscribe("counts", from_epoch=-1, reader="gone")
    grown(ws, 3)
    assert ws.retain("counts", 1, older_than_ms=10**9, override=True) == 0
    assert ws.retain("counts", 1, older_than_ms=0, override=True) == 2
    with pytest.raises(FreshetError) as error:
        ws.subscribe("counts", reader="gone")
    assert error.value.code == 502
    stream.consumers.forget("reader gone")
    with pytest.raises(FreshetError):
        stream.consumers.forget("reader gone")
    grown(ws, 1)
    assert ws.retain("counts", 1) == 1


# -- batches, files and bytes ----------------------------------------------


def tasks_of(spark, run):
    """The number of tasks that ``run`` started, and what it returned."""
    context, group = spark.sparkContext, f"group-{random.random()}"
    context.setJobGroup(group, "")
    try:
        out = run()
    finally:
        context._jsc.clearJobGroup()
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return sum(info.numTasks for s in set(stages) if (info := tracker.getStageInfo(s))), out


def test_a_batch_is_found_by_its_number(spark):
    result = Result(spark.range(0, 1000, 1, 10).where("id < 300 OR id >= 500"))
    assert result.num_batches() == 8
    tasks, last = tasks_of(spark, lambda: result.batch(7))
    assert tasks == 1 and last.to_pydict() == {"id": list(range(900, 1000))}
    assert result.batch(3).to_pydict() == {"id": list(range(500, 600))}
    wide = Result(spark.range(40).repartition(3).selectExpr("id", "repeat('x', 100) AS s"))
    rows = [r for k in range(wide.num_batches()) for r in wide.batch(k).to_pydict()["id"]]
    assert sorted(rows) == list(range(40))
    for index in (-1, 8, 99):
        with pytest.raises(FreshetError) as error:
            result.batch(index)
        assert error.value.code == 400


def test_a_large_arrow_file_is_read_by_several_tasks(spark):
    path = fresh_path(spark, "ipc")
    rows = spark.range(0, 6000, 1, 1).selectExpr("id", "concat('v', id % 7) AS v", "CASE WHEN id % 3 = 0 THEN NULL ELSE id / 2 END AS x")
    arrow_ipc.write_ipc_files(rows, path, whole_partitions=True, batch_rows=100)
    assert len(Storage(spark).names(path)) == 1
    schema = parse_columns("id BIGINT, v VARCHAR, x DOUBLE")
    back = arrow_ipc.read_ipc_files(spark, path, schema, range_bytes=20_000)
    parts = back.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 5 and sum(r["count"] for r in parts) == 6000
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    whole = arrow_ipc.read_ipc_files(spark, path, schema)
    assert whole.rdd.getNumPartitions() == 1 and whole.count() == 6000


def test_arrow_ranges_know_dictionaries_ends_and_garbage(spark, tmp_path):
    import pyarrow as pa

    table = pa.table({"id": pa.array(range(50), pa.int64()), "v": pa.array([f"w{k % 3}" for k in range(50)]).dictionary_encode()})
    path = str(tmp_path / "a.arrow")
    with pa.OSFile(path, "wb") as out, pa.ipc.new_stream(out, table.schema) as writer:
        for batch in table.to_batches(max_chunksize=10):
            writer.write_batch(batch)
    with pa.OSFile(path) as file:
        kinds = [(kind, end > start) for kind, start, end in arrow_ipc.messages(file)]
    assert [k for k, _ in kinds] == [1, 2, 3, 3, 3, 3, 3] and all(some for _, some in kinds)
    found = arrow_ipc.ipc_ranges(spark.createDataFrame([(path,)], "path string"), range_bytes=1).collect()
    assert len(found) == 5 and all(len(r["lead"]) == 2 for r in found)
    data = open(path, "rb").read()
    for k, r in enumerate(sorted(found, key=lambda r: r["start"])):
        parts = [data[x["start"] : x["end"]] for x in r["lead"]] + [data[r["start"] : r["end"]]]
        got = pa.ipc.open_stream(b"".join(parts)).read_all()
        assert got.column("id").to_pylist() == list(range(10 * k, 10 * k + 10))
        assert got.column("v").to_pylist() == [f"w{n % 3}" for n in range(10 * k, 10 * k + 10)]
    for name, bad in (("cut", data[: len(data) // 2]), ("text", b"not arrow at all")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.arrow").write_bytes(bad)
        with pytest.raises(Exception) as error:
            arrow_ipc.read_ipc_files(spark, f"file:{tmp_path / name}", parse_columns("id BIGINT, v VARCHAR")).collect()
        assert arrow_ipc.typed_failure(error.value).code == 300, name


def test_one_large_file_is_not_joined_by_others(spark):
    path = fresh_path(spark, "bytes")
    source = StoredSource(spark, "s", parse_columns("id BIGINT, v VARCHAR"), path)
    big = spark.range(20_000).selectExpr("id", "sha2(CAST(id AS STRING), 512) AS v").coalesce(1)
    small = spark.range(20_000, 20_008, 1, 4).selectExpr("id", "'x' AS v")
    source.append(small)
    source.append(big)
    source.append(small)
    stream = Stream(spark, "b", f"{path}/b", [source], "SELECT id FROM s", max_bytes=100_000)
    stream.run_available()
    rows = sorted(r["n"] for r in stream.feed.read().groupBy(EPOCH).agg(F.count("*").alias("n")).collect())
    assert rows == [8, 8, 20_000]
    with pytest.raises(FreshetError):
        Admission(3, 100)
    follows = Stream(spark, "c", f"{path}/c", [source], "SELECT id FROM s", max_bytes=BACKLOG)
    follows.run_available()
    assert follows.feed.last() == 0 and follows.feed.read().count() == 20_016


# -- lineage and state -----------------------------------------------------


def test_epochs_and_the_appends_they_took_in(spark, open_ws):
    ws, stream = counting(spark, open_ws)
    grown(ws, 2)
    for k in range(3):
        ws.insert("s", [{"k": 9, "v": k}])
    ws.run_available()
    got = {r[EPOCH]: (r["source"], r["first"], r["last"]) for r in stream.lineage().collect()}
    assert got == {0: ("s", 0, 0), 1: ("s", 1, 1), 2: ("s", 2, 4)}
    assert [stream.epoch_as_of("s", n) for n in range(5)] == [0, 1, 1, 1, 2]
    assert {r["file"].startswith("part-") for r in stream.taken().collect()} == {True}


def test_state_equals_the_feed_and_makes_a_view_again(spark, open_ws):
    ws, stream = counting(spark, open_ws)
    view = MaterializedView(spark, stream, ["k"])
    grown(ws, 4)
    columns = {"k": "key.k", "n": "value.count", "total": "value.sum"}
    kept = state_rows(stream).select(*[F.expr(sql).alias(n) for n, sql in columns.items()])
    want = {tuple(r) for r in view.read().select("k", "n", "total").collect()}
    assert {tuple(r) for r in kept.collect()} == want
    early = {r["k"]: r["n"] for r in state_rows(stream, 1).selectExpr("key.k", "value.count AS n").collect()}
    assert early == {0: 1, 1: 1}
    changed = {(r["batch_id"], r["k"]) for r in state_changes(stream, 2, 3).selectExpr("batch_id", "key.k").collect()}
    assert changed == {(2, 0), (3, 1)}
    stream.feed.retain(1)
    assert view.rebuild(columns) == 3
    assert {tuple(r) for r in view.read().select("k", "n", "total").collect()} == want
    ws.insert("s", [{"k": 0, "v": 1}])
    ws.run_available()
    assert {r["k"]: r["n"] for r in view.read().collect()} == {0: 3, 1: 2}


def test_two_watermarks_close_by_the_lesser(open_ws):
    ws = open_ws(config=Config())
    timed(ws, "a", "1 hour")
    timed(ws, "b", "3 hours")
    ws.create_stream(
        "both",
        "SELECT window.start AS w, count(*) AS n FROM (SELECT ts FROM a UNION ALL SELECT ts FROM b) GROUP BY window(ts, '1 hour')",
        emit="on_close",
    )

    def closed():
        ws.run_available()
        return sorted(r["w"].hour for r in ws._stream("both").feed.read().collect())

    put(ws, 1 * HOUR, 9 * HOUR, source="a")
    put(ws, 2 * HOUR, 6 * HOUR, source="b")
    # a has come to 8, b to 3: the windows from 1 and 2 are closed.
    assert closed() == [1, 2]
    # b is idle: its heartbeat takes it to 12 - 3, and a's 9 - 1 counts now.
    ws.writer("b").watermark(12 * HOUR)
    assert closed() == [1, 2, 6]
    put(ws, 30 * HOUR, source="a")
    assert closed() == [1, 2, 6]
    ws.writer("b").watermark(14 * HOUR)
    assert closed() == [1, 2, 6, 9]
