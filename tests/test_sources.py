"""Sources, writers, Arrow in and out, results."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freshet.errors import FreshetError, from_task
from freshet.functions.logical import check_schema, parse_columns
from freshet.functions.render import render, render_json
from freshet.operators.conform import conform
from freshet.operators.results import Result, ResultStream, batch_stats, first_rows, result_totals
from freshet.session import fresh_path, work_root
from freshet.sources.arrow_ipc import from_ipc, read_ipc_files, to_ipc
from freshet.sources.source import Source, StoredSource
from freshet.streaming.stream import Stream

SENSORS = "ts TIMESTAMP, device VARCHAR, value DOUBLE"


def ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table, max_chunksize=2)
    return sink.getvalue().to_pybytes()


@pytest.fixture
def sensors(spark):
    return StoredSource(spark, "sensors", parse_columns(SENSORS), fresh_path(spark, "sensors"), "ts", "10 seconds")


def code_of(call):
    with pytest.raises(FreshetError) as error:
        call()
    return error.value.code


def test_insert_reads_back(sensors):
    rows = [
        {"ts": 1700000000000, "device": "d1", "value": 3.25},
        {"ts": dt.datetime(2026, 9, 3), "device": "d1", "value": 4},
        {"device": "d2", "value": 5.5},
    ]
    rows.append({"ts": dt.datetime(2026, 9, 3, 1, 2, 3, 123456), "device": "d3"})
    assert sensors.insert(rows) == 4
    got = {(r["device"], r["value"], r["ts"]) for r in sensors.bounded().collect()}
    assert got == {
        ("d1", 3.25, dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("d1", 4.0, dt.datetime(2026, 9, 3)),
        ("d2", 5.5, None),
        ("d3", None, dt.datetime(2026, 9, 3, 1, 2, 3, 123456)),
    }


def test_insert_is_all_or_nothing(sensors):
    with pytest.raises(FreshetError) as error:
        sensors.insert([{"value": 1.0}, {"value": "not a number"}])
    assert error.value.code == 300
    assert error.value.message == "column 'value': needs a number, found string (row 1)"
    assert sensors.bounded().count() == 0 and sensors.table.last() is None
    assert sensors.insert([{"value": 1.0}]) == 1


def test_rows_of_an_attempt_without_a_number_are_invisible(spark, sensors):
    sensors.insert([{"device": "a"}])
    # A writer that died before its claim.
    sensors.bounded().write.parquet(f"{sensors.table.path}/staging/dead")
    again = StoredSource(spark, "sensors", sensors.schema, sensors.table.path, "ts", "10 seconds")
    assert again.bounded().count() == 1
    assert again.insert([{"device": "b"}, {"device": "c"}]) == 2
    assert sorted(r["device"] for r in again.bounded().collect()) == ["a", "b", "c"]


def test_a_failed_log_entry_leaves_nothing(spark, sensors, monkeypatch):
    sensors.insert([{"device": "zero"}])

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(sensors._storage.__class__, "create_once", fail)
        with pytest.raises(OSError):
            sensors.insert([{"device": "lost"}])
    sensors.insert([{"device": "next"}])
    stream = Stream(spark, "all", fresh_path(spark, "all"), [sensors], "SELECT device FROM sensors")
    stream.run_available()
    for rows in (sensors.bounded(), stream.feed.read()):
        assert sorted(r["device"] for r in rows.collect()) == ["next", "zero"]
    assert sorted(r["append_id"] for r in sensors.table.log().collect()) == [0, 1]


def test_claimed_rows_are_moved_by_whoever_comes_next(spark, sensors, monkeypatch):
    sensors.insert([{"device": "a"}])
    with monkeypatch.context() as patch:
        patch.setattr(sensors.table.__class__, "_publish", lambda *_: (_ for _ in ()).throw(OSError("died")))
        patch.setattr(sensors._storage.__class__, "delete", lambda *_: None)
        with pytest.raises(OSError):
            sensors.insert([{"device": "b"}])
    again = StoredSource(spark, "sensors", sensors.schema, sensors.table.path, "ts", "10 seconds")
    assert sorted(r["device"] for r in again.bounded().collect()) == ["a", "b"]
    assert again._storage.names(again.table._staging) == []


def test_writers_at_the_same_time(spark):
    path, schema = fresh_path(spark, "busy"), parse_columns("a BIGINT")
    shared = StoredSource(spark, "busy", schema, path)
    others = [shared, shared, *(StoredSource(spark, "busy", schema, path) for _ in range(2))]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: [others[k].insert([{"a": 10 * k + i} for i in range(5)]) for _ in range(2)], range(4)))
    assert done == [[5, 5]] * 4
    log = sorted(shared.table.log().collect(), key=lambda r: r["append_id"])
    assert [r["append_id"] for r in log] == list(range(8)) and [r["rows_before"] for r in log] == list(range(0, 40, 5))
    stream = Stream(spark, "all", fresh_path(spark, "all"), [shared], "SELECT a FROM busy")
    stream.run_available()
    want = sorted(2 * [10 * k + i for k in range(4) for i in range(5)])
    for rows in (shared.bounded(), stream.feed.read()):
        assert sorted(r["a"] for r in rows.collect()) == want


def test_committing_again_changes_nothing(spark, sensors):
    rows = spark.range(3).select(
        F.lit(None).cast("timestamp").alias("ts"), F.lit("x").alias("device"), F.col("id").cast("double").alias("value")
    )
    assert sensors.table.commit(rows, 0)["rows"] == 3
    assert sensors.table.commit(rows.limit(1), 0)["rows"] == 3
    assert sensors.bounded().count() == 3


def test_snapshot_is_fixed_when_read(sensors):
    sensors.insert([{"device": "a"}])
    before = sensors.bounded()
    sensors.insert([{"device": "b"}])
    assert before.count() == 1 and sensors.bounded().count() == 2 and sensors.bounded(upto=0).count() == 1


def test_quarantine_keeps_rejects_aside(spark, sensors):
    raw = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, None)], "device string, value double, ts bigint").withColumn(
        "value", F.when(F.col("device") == "b", F.lit("bad")).cast("string")
    )
    path = fresh_path(spark, "rejects")
    assert sensors.insert_accepted(raw, path) == 1
    assert [r["device"] for r in sensors.bounded().collect()] == ["a"]
    rejects = spark.read.parquet(path).collect()
    assert [(r["device"], r["reject_column"], r["reject_code"]) for r in rejects] == [("b", "value", 300)]


def test_quarantine_puts_each_row_in_one_place(spark, sensors):
    """Rows that come out differently when run again are judged once."""
    raw = spark.range(400).select(F.when(F.rand() < 0.5, F.lit("bad")).otherwise(F.lit(None)).alias("value"), "id")
    path = fresh_path(spark, "rejects")
    stored = sensors.insert_accepted(raw, path)
    assert stored + spark.read.parquet(path).count() == 400 and 0 < stored < 400
    assert sensors.bounded().count() == stored


def test_folded_log(spark):
    source = StoredSource(spark, "t", parse_columns("a INT"), fresh_path(spark, "t"))
    for n in range(3):
        source.insert([{"a": n}])
    source.table.fold_log()
    source.table.fold_log()
    source.insert([{"a": 3}])
    names = source._storage.names(source.table.log_path)
    assert [n for n in names if n.endswith(".json")] == ["3.json"]

    def check(table):
        assert table.last() == 3 and table.has(0) and table.has(3) and not table.has(4)
        assert table.entry(1)["rows"] == 1 and table.entry(3)["rows"] == 1
        assert sorted(r["append_id"] for r in table.log().collect()) == [0, 1, 2, 3]
        assert sorted(r["a"] for r in table.read().collect()) == [0, 1, 2, 3]
        assert table.commit(spark.range(0), 1)["rows"] == 1  # known: its rows stay

    check(source.table)
    check(StoredSource(spark, "t", source.schema, source.table.path).table)
    source.table.fold_log()
    assert source._storage.names(source.table._folds) == ["3"]
    # A fold that died before it was complete does not count.
    source._storage.mkdirs(f"{source.table._folds}/9")
    check(StoredSource(spark, "t", source.schema, source.table.path).table)


def test_a_number_that_was_folded_is_not_given_away_again(spark):
    schema, path = parse_columns("a INT"), fresh_path(spark, "t")
    first, slow = StoredSource(spark, "t", schema, path), StoredSource(spark, "t", schema, path)
    slow.insert([{"a": 0}])
    assert slow.table.last() == 0
    first.insert([{"a": 1}])
    first.table.fold_log()
    slow.table._folded = None
    slow.table.last = lambda last=slow.table.last: 0 if slow.table._known_last == 0 else last()
    assert slow.insert([{"a": 2}]) == 1
    assert sorted((r["append_id"], r["a"]) for r in first.table.read().collect()) == [(0, 0), (1, 1), (2, 2)]


def test_ranges(spark):
    source = StoredSource(spark, "t", parse_columns("a INT"), fresh_path(spark, "t"))
    for n in range(4):
        source.insert([{"a": n}])
    one = source.table.read(after=1, upto=2)
    files = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("/")[-2] for r in files} == {"append_id=2"}
    got = source.table.read(after=0, upto=2)
    assert sorted((r["append_id"], r["a"]) for r in got.collect()) == [(1, 1), (2, 2)]
    assert source.table.read(after=3).count() == 0
    source.table.retain(2)
    assert code_of(source.table.read) == 502 and code_of(lambda: source.table.read(after=0)) == 502
    assert code_of(lambda: source.table.read(after=0, upto=1)) == 502
    assert source.table.read(after=1).count() == 2


def test_append_checks_names_and_types(spark, sensors):
    assert code_of(lambda: sensors.append(spark.range(1))) == 302
    swapped = spark.createDataFrame([], "device string, ts timestamp, value double")
    with pytest.raises(FreshetError) as error:
        sensors.append(swapped)
    assert error.value.code == 302 and "column 'ts'" in error.value.message
    check_schema(parse_columns("a ARRAY<INT>"), spark.range(1).select(F.array(F.lit(1)).alias("a")).schema)


def test_log_counts_late_rows(sensors):
    sensors.insert([{"ts": 60_000}, {"ts": 10_000}])
    sensors.insert([{"ts": 49_999}, {"ts": 50_000}, {"ts": 1}])
    log = {r["append_id"]: r for r in sensors.table.log().collect()}
    assert log[0]["late_rows"] is None
    assert log[1]["late_rows"] == 2
    assert log[1]["max_event_us"] == 50_000_000


def test_writer(sensors):
    writer = sensors.writer()
    assert writer.name == "sensors" and writer.schema.names == ["ts", "device", "value"]
    assert writer.write_rows([{"ts": 5, "device": "w", "value": 1.25}]) == 1
    writer.watermark(5000)
    assert writer.current_watermark() == 5000 and sensors.explicit_watermark() == 5000
    writer.close()
    writer.close()
    assert code_of(lambda: writer.write_rows([{"ts": 6}])) == 301
    assert code_of(lambda: writer.write_arrow(b"")) == 301


def test_arrow_insert(spark, sensors):
    table = pa.table(
        {
            "ts": pa.array([1, 2, 3], pa.timestamp("us")),
            "device": pa.array(["a", None, "c"]),
            "value": pa.array([1.5, None, 3.0]),
        }
    )
    assert sensors.insert_arrow(ipc(table)) == 3
    got = sorted((r["device"] or "", r["value"]) for r in sensors.bounded().collect())
    assert got == [("", None), ("a", 1.5), ("c", 3.0)]
    assert code_of(lambda: sensors.insert_arrow(b"not arrow")) == 300
    assert code_of(lambda: sensors.insert_arrow(ipc(table.select(["ts"])))) == 302
    assert code_of(lambda: sensors.insert_arrow(ipc(table.rename_columns(["ts", "dev", "value"])))) == 302
    millis = table.set_column(0, "ts", table["ts"].cast(pa.timestamp("ms"), safe=False))
    assert code_of(lambda: sensors.insert_arrow(ipc(millis))) == 302
    assert sensors.bounded().count() == 3


def test_arrow_types_of_declared_columns(spark):
    schema = parse_columns(
        "a TINYINT UNSIGNED, b BIGINT UNSIGNED, c TIMESTAMP(0), d TIMESTAMP(9), e DATE, f DECIMAL(5,2), g ARRAY<INT>"
    )
    source = StoredSource(spark, "t", schema, fresh_path(spark, "t"))
    table = pa.table(
        {
            "a": pa.array([255], pa.uint8()),
            "b": pa.array([2**64 - 1], pa.uint64()),
            "c": pa.array([-1], pa.timestamp("s")),
            "d": pa.array([1999], pa.timestamp("ns", tz="Europe/Berlin")),
            "e": pa.array([dt.date(1969, 12, 31)]),
            "f": pa.array([None], pa.decimal128(5, 2)),
            "g": pa.array([[1, 2]], pa.list_(pa.int32())),
        }
    )
    assert source.insert_arrow(ipc(table)) == 1
    row = source.bounded().withColumn("us", F.unix_micros("d")).withColumn("s", F.unix_seconds("c")).first()
    assert (row["a"], row["b"], row["s"], row["us"], row["e"]) == (255, 2**64 - 1, -1, 1, dt.date(1969, 12, 31))
    assert row["g"] == [1, 2] and row["f"] is None
    shown = render(source.bounded().select("a", "b")).first()
    assert (shown["a"], shown["b"]) == (255.0, 2**63 - 1)


def test_ipc_files_are_decoded_on_executors_and_atomic(spark, tmp_path):
    schema = parse_columns("a INT, b DOUBLE")
    good = pa.table({"a": pa.array([1, 2, 3], pa.int32()), "b": [1.5, None, 3.0]})
    for i in range(3):
        (tmp_path / f"{i}.arrow").write_bytes(ipc(good))
    source = StoredSource(spark, "t", schema, fresh_path(spark, "t"))
    assert source.insert_ipc_files(str(tmp_path)) == 9
    (tmp_path / "bad.arrow").write_bytes(ipc(pa.table({"a": [1], "b": [1.0]})))
    with pytest.raises(FreshetError) as error:
        source.insert_ipc_files(str(tmp_path))
    assert error.value.code == 302 and "column 'a'" in error.value.message
    (tmp_path / "bad.arrow").write_bytes(b"garbage")
    assert code_of(lambda: source.insert_ipc_files(str(tmp_path))) == 300
    assert source.bounded().count() == 9
    with pytest.raises(Exception) as error:
        read_ipc_files(spark, str(tmp_path), schema).collect()
    assert from_task(error.value).code == 300


def test_ipc_round_trip_and_splitting(spark):
    rows = spark.range(0, 5000, 1, 3).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    whole = to_ipc(rows)
    assert whole.agg(F.sum("rows")).first()[0] == 5000
    pieces = to_ipc(rows, max_bytes=20_000)
    sizes = pieces.select("rows", F.length("ipc").alias("n")).collect()
    assert len(sizes) > whole.count() and max(r["n"] for r in sizes) < 40_000
    back = from_ipc(pieces, rows.schema)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_render(spark):
    row = spark.sql(
        "SELECT timestamp'1970-01-01 00:00:01.0005' t, timestamp_ntz'1969-12-31 23:59:59.999' n, date'1969-12-31' d, "
        "1Y b, 2S s, 3 i, 9223372036854775807L l, 1.5F f, 2.5D g, 'x' c, true o, null v"
    )
    got = render(row).first().asDict()
    assert got == {
        "t": 1000.5, "n": -1.0, "d": -86400000.0, "b": 1.0, "s": 2.0, "i": 3.0, "l": 2**63 - 1,
        "f": 1.5, "g": 2.5, "c": "x", "o": True, "v": None,
    }
    assert render_json(spark.sql("SELECT 1L a, cast(null as string) b")).first()["row"] == '{"a":1,"b":null}'
    assert code_of(lambda: render(spark.sql("SELECT 1.50BD x"))) == 900


def test_results(spark):
    rows = spark.range(0, 100, 1, 4)
    result = Result(rows)
    assert result.num_rows() == 100 and result.num_batches() == 4
    assert result.batch(1).to_pydict() == {"id": list(range(25, 50))}
    assert code_of(lambda: result.batch(99)) == 400
    assert code_of(lambda: result.batch(-1)) == 400
    assert pa.ipc.open_stream(result.to_ipc()).read_all().num_rows == 100
    assert result.to_rows()[3] == {"id": 3}
    assert sum(r["num_rows"] for r in batch_stats(rows).collect()) == 100
    assert result_totals(rows).first()["num_rows"] == 100
    assert first_rows(rows, 7).count() == 7 and first_rows(rows, 1000).count() == 100
    assert "Coalesce" not in first_rows(rows, 7)._jdf.queryExecution().optimizedPlan().toString()
    wide = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), 60_000).alias("text"))
    assert Result(wide).num_batches() == len(list(ResultStream(wide))) > 1


def test_result_stream(spark):
    stream = ResultStream(spark.range(0, 100, 1, 4))
    assert [b.num_rows for b in stream] == [25] * 4
    assert stream.next_batch() is None
    stopped = ResultStream(spark.range(0, 100, 1, 4))
    assert stopped.next_batch().num_rows == 25
    stopped.cancel()
    stopped.cancel()
    assert stopped.next_batch() is None


def test_work_root_is_the_shared_folder(spark):
    assert work_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_heartbeats_do_not_pile_up(sensors):
    for millis in range(1000, 1250):
        sensors.heartbeat(millis)
    assert len(sensors._storage.names(sensors.heartbeat_path)) <= 201
    assert sensors.explicit_watermark() == 1249


def test_old_files_are_streamed_too(spark):
    path = fresh_path(spark, "old")
    spark.range(20).repartition(2).write.parquet(path)
    source = Source(spark, "ids", spark.range(1).schema, path)
    names = [n for n in source._storage.names(path) if n.startswith("part-")]
    ten_days = 10 * 86_400_000
    source._storage.set_changed(f"{path}/{names[1]}", source._storage.changed(f"{path}/{names[0]}") - ten_days)
    stream = Stream(spark, "old", fresh_path(spark, "s"), [source], "SELECT id FROM ids", max_files=1)
    stream.run_available()
    spark.range(20, 25).coalesce(1).write.mode("append").parquet(path)
    new = next(n for n in source._storage.names(path) if n.startswith("part-") and n not in names)
    source._storage.set_changed(f"{path}/{new}", source._storage.changed(f"{path}/{new}") - 3 * ten_days)
    stream.run_available()
    assert sorted(r["id"] for r in stream.feed.read().collect()) == list(range(25))
