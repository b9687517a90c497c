"""Edges of the strict conversion rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import FreshetError, IngestionFault, from_task
from freshet.functions.cells import rows_from_variant
from freshet.functions.convert import floor_div
from freshet.functions.logical import column, describe, logical_of, parse_columns
from freshet.operators.conform import conform, reject_summary
from freshet.sources.rows import ROW_ID, rows_frame

I64 = 2**63 - 1


def outcome(spark, field, values, raw_type=None):
    """Each value's converted form, or the reason it was refused."""
    schema = T.StructType([field if isinstance(field, T.StructField) else parse_columns(field)[0]])
    name = schema[0].name
    if raw_type is None:
        raw = rows_frame(spark, schema, [{name: v} for v in values])
    else:
        raw = spark.createDataFrame(list(enumerate(values)), f"{ROW_ID} long, {name} {raw_type}")
    done = conform(raw, schema).tagged.orderBy("_raw._row").collect()
    return [row["_reject"]["reason"] if row["_reject"] else row[name] for row in done]


@pytest.mark.parametrize(
    ("kind", "lo", "hi"),
    [
        ("int8", -128, 127),
        ("int16", -32768, 32767),
        ("int32", -(2**31), 2**31 - 1),
        ("int64", -(2**63), I64),
        ("uint8", 0, 255),
        ("uint16", 0, 65535),
        ("uint32", 0, 2**32 - 1),
        ("uint64", 0, I64),
    ],
)
def test_integer_bounds(spark, kind, lo, hi):
    got = outcome(spark, column("v", kind), [lo, hi, lo - 1, hi + 1, None])
    assert got[:2] == [lo, hi]
    assert "v" in got[2] and "v" in got[3]
    assert got[4] is None
    for value, text in ((lo - 1, got[2]), (hi + 1, got[3])):
        expected = "64 bits" if not -(2**63) <= value <= I64 else f"a whole number from {lo} to {hi}, found {value}"
        assert expected in text


def test_integer_from_doubles(spark):
    got = outcome(
        spark, "v BIGINT", [1.0, 1.5, math.nan, math.inf, -math.inf, 2.0**53, 2.0**53 - 1, 2.0**63, -0.0], "double"
    )
    assert got[0] == 1 and got[6] == 2**53 - 1 and got[8] == 0
    for i in (1, 2, 3, 4):
        assert "a whole number from" in got[i]
    assert "several integers" in got[5] and "several integers" in got[7]


def test_integer_is_exact_in_64_bits(spark):
    values = [2**53 + 1, I64, -I64]
    assert outcome(spark, "v BIGINT", values) == values
    assert outcome(spark, "v BIGINT", values, "bigint") == values


def test_mixed_numbers_keep_their_kind(spark):
    assert outcome(spark, "v BIGINT", [2**53 + 1, 2.0, 2.5])[:2] == [2**53 + 1, 2]


def test_boolean_only_from_boolean(spark):
    got = outcome(spark, "v BOOLEAN", [True, False, 1, "true", None])
    assert got[:2] == [True, False] and got[4] is None
    assert got[2].endswith("needs a boolean, found bigint")
    assert got[3].endswith("needs a boolean, found string")


def test_text_only_from_text(spark):
    got = outcome(spark, "v VARCHAR", ["", "x", 1, 1.5, True])
    assert got[:2] == ["", "x"]
    assert got[2].endswith("needs a string, found bigint")
    assert got[3].endswith("needs a string, found number")
    assert got[4].endswith("needs a string, found boolean")


def test_numbers_never_from_text(spark):
    for kind in ("INT", "DOUBLE"):
        assert outcome(spark, f"v {kind}", ["12"])[0] == "column 'v': needs a number, found string"
    assert outcome(spark, "v TIMESTAMP", ["12"])[0].endswith("needs a number of milliseconds, found string")


def test_float_takes_every_number(spark):
    got = outcome(spark, "v DOUBLE", [1, 1.5, math.inf, 2**63 - 1, None])
    assert got == [1.0, 1.5, math.inf, float(2**63 - 1), None]
    assert math.isnan(outcome(spark, "v DOUBLE", [math.nan])[0])
    assert outcome(spark, "v FLOAT", [1e300, 0.1], "double") == [math.inf, pytest.approx(0.1, abs=1e-8)]


def test_date_floors(spark):
    day = dt.date(1970, 1, 1)
    got = outcome(spark, "v DATE", [-43_200_000, 0, 86_400_000, -86_400_000, -1])
    assert got == [day - dt.timedelta(1), day, day + dt.timedelta(1), day - dt.timedelta(1), day - dt.timedelta(1)]


def test_date_out_of_range(spark):
    assert "a day that a date can hold" in outcome(spark, "v DATE", [2**31 * 86_400_000])[0]
    assert "a day that a date can hold" in outcome(spark, "v DATE", [-(2**63)])[0]


def test_temporal_guards(spark):
    got = outcome(spark, "v TIMESTAMP", [math.nan, math.inf, 2.0**53 + 2, 0.0], "double")
    assert "finite" in got[0] and "finite" in got[1] and "several integers" in got[2]
    assert got[3] == dt.datetime(1970, 1, 1)
    assert "finite" in outcome(spark, "v DATE", [math.inf], "double")[0]


def test_millisecond_fractions_are_cut_toward_zero(spark):
    got = outcome(spark, "v TIMESTAMP", [1.9, -0.5, -1.9], "double")
    assert [round(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for t in got] == [1, 0, -1]


@pytest.mark.parametrize(
    ("unit", "bound"),
    [("timestamp_ns", 9223372036854), ("timestamp_us", 9223372036854775), ("timestamp_ms", 9223372036854775)],
)
def test_timestamp_overflow(spark, unit, bound):
    schema = T.StructType([column("v", unit)])
    raw = spark.createDataFrame([(0, bound), (1, bound + 1), (2, -bound), (3, -bound - 1), (4, I64)], "i int, v bigint")
    tagged = conform(raw, schema).tagged
    # Far years do not fit Python's datetime, so look at the count of microseconds.
    got = tagged.select("_raw.i", F.unix_micros("v").alias("us"), "_reject.reason").orderBy("i").collect()
    assert [r["us"] for r in got] == [bound * 1000, None, -bound * 1000, None, None]
    assert [r["reason"] is None for r in got] == [True, False, True, False, False]
    assert "can hold" in got[1]["reason"]


def test_timestamp_seconds_floor(spark):
    schema = T.StructType([column("v", "timestamp_s")])
    raw = spark.createDataFrame([(-1,), (1_000_500,)], "v bigint")
    got = conform(raw, schema).accepted.select(F.unix_micros("v").alias("us")).collect()
    assert sorted(r["us"] for r in got) == [-1_000_000, 1_000_000_000]


def test_moments(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert outcome(spark, "v TIMESTAMP", [when], "timestamp") == [when]
    assert outcome(spark, "v DATE", [when], "timestamp") == [when.date()]
    assert outcome(spark, "v BIGINT", [when], "timestamp") == [1704164645678]
    assert outcome(spark, "v VARCHAR", [when], "timestamp")[0].endswith("needs a string, found date")
    assert outcome(spark, "v TIMESTAMP", [when]) == [when]
    assert outcome(spark, "v BIGINT", [when]) == [1704164645678]
    assert outcome(spark, "v DATE", [dt.date(1969, 12, 31)]) == [dt.date(1969, 12, 31)]


def test_null_only(spark):
    got = outcome(spark, column("v", "null"), [None, 1])
    assert got[0] is None and "needs null" in got[1]


def test_not_null_and_missing_key(spark):
    schema = parse_columns("a INT NOT NULL, b VARCHAR")
    raw = rows_frame(spark, schema, [{"a": None}, {}, {"a": 1}, {"a": 2, "b": "x", "extra": 9}])
    result = conform(raw, schema, ROW_ID)
    assert sorted(tuple(r) for r in result.accepted.collect()) == [(1, None), (2, "x")]
    reasons = [r["reject_reason"] for r in result.rejected.orderBy(ROW_ID).collect()]
    assert reasons == [f"column 'a': needs a value, found null (row {i})" for i in (0, 1)]


def test_column_absent_from_raw_counts_as_null(spark):
    raw = spark.range(2)
    assert [tuple(r) for r in conform(raw, parse_columns("id BIGINT, note VARCHAR")).accepted.collect()] == [
        (0, None),
        (1, None),
    ]
    assert conform(raw, parse_columns("id BIGINT, note VARCHAR NOT NULL")).rejected.count() == 2


def test_first_refusing_column_wins_and_summary(spark):
    schema = parse_columns("a INT, b INT")
    raw = spark.createDataFrame([(1.5, 2.5), (1.0, 2.5), (1.0, 2.0)], "a double, b double")
    result = conform(raw, schema)
    assert sorted(r["reject_column"] for r in result.rejected.collect()) == ["a", "b"]
    assert {r["reject_column"]: r["n"] for r in reject_summary(result).collect()} == {"a": 1, "b": 1, None: 1}
    assert {r["reject_code"] for r in result.rejected.collect()} == {300}


def test_objects_are_refused(spark):
    assert outcome(spark, "v INT", [{"x": 1}, [1]]) == ["column 'v': needs a plain value, found object"] * 2
    raw = spark.createDataFrame([([1],)], "v array<int>")
    assert conform(raw, parse_columns("v INT")).rejected.first()["reject_reason"].endswith("object")


def test_unsupported_target(spark):
    with pytest.raises(FreshetError) as error:
        conform(spark.range(1), parse_columns("id DECIMAL(10,2)"))
    assert error.value.code == 900 and "column 'id'" in error.value.message


def test_strict_fails_with_the_reason(spark):
    raw = spark.createDataFrame([(1.0,), (0.5,)], "v double")
    with pytest.raises(Exception) as error:
        conform(raw, parse_columns("v INT")).strict.collect()
    typed = from_task(error.value)
    assert isinstance(typed, IngestionFault)
    assert typed.message == "column 'v': needs a whole number from -2147483648 to 2147483647, found 0.5"


def test_json_rows(spark):
    schema = parse_columns("a INT, b VARCHAR, c DOUBLE, d BOOLEAN, t TIMESTAMP")
    texts = [
        '{"a": 1, "b": "x", "c": 2.5, "d": true, "t": 1500, "extra": []}',
        '{"b": null}',
        '{"a": 1.0, "c": 3}',
        '{"a": 1.5}',
        '{"a": "1"}',
        '{"a": 99999999999999999999}',
        '{"b": 5}',
        '{"d": 0}',
        '{"c": {"n": 1}}',
    ]
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, j string").withColumn("row", F.parse_json("j"))
    result = conform(rows_from_variant(raw, "row", schema.names, keep=("i",)), schema, "i")
    accepted = {tuple(r) for r in result.accepted.collect()}
    assert accepted == {
        (1, "x", 2.5, True, dt.datetime(1970, 1, 1, 0, 0, 1, 500000)),
        (None,) * 5,
        (1, None, 3.0, None, None),
    }
    reasons = [r["reject_reason"] for r in result.rejected.orderBy("i").collect()]
    assert reasons == [
        "column 'a': needs a whole number from -2147483648 to 2147483647, found 1.5 (row 3)",
        "column 'a': needs a number, found string (row 4)",
        "column 'a': needs an integer of 64 bits, found 99999999999999999999 (row 5)",
        "column 'b': needs a string, found bigint (row 6)",
        "column 'd': needs a boolean, found bigint (row 7)",
        "column 'c': needs a plain value, found object (row 8)",
    ]


def test_floor_div(spark):
    values = [-(2**63), -1001, -1000, -1, 0, 1, 999, 1000, I64]
    got = spark.createDataFrame([(v,) for v in values], "v bigint").selectExpr("v", f"{floor_div('v', 1000)} AS q")
    assert all(r["q"] == r["v"] // 1000 for r in got.collect())


def test_declared_types(spark):
    schema = parse_columns("a INT UNSIGNED NOT NULL, b VARCHAR, c VARCHAR(3), d TIMESTAMP(9), e TEXT, f DOUBLE")
    assert [logical_of(f) for f in schema] == ["uint32", "utf8", "other", "timestamp_ns", "utf8", "float64"] or [
        logical_of(f) for f in schema
    ] == ["uint32", "utf8", "utf8", "timestamp_ns", "utf8", "float64"]
    assert describe(schema)[0] == (0, "a", "uint32", False)
    with pytest.raises(FreshetError) as error:
        parse_columns("a NOT A TYPE(")
    assert error.value.code == 401


def test_rules_stay_in_generated_code(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "value")
    plan = conform(raw, parse_columns("event_id BIGINT, value INT")).accepted._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Python" not in text and "ArrowEval" not in text and "Exchange" not in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
