"""Conform jobs over the given tables: every strict conversion rule at table size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.cells import rows_from_variant
from freshet.functions.logical import column, parse_columns
from freshet.operators.conform import REJECT, conform, reject_summary
from freshet.plans.registry import plan
from freshet.plans.tables import once, table
from freshet.session import fresh_path

KEY = T.StructField("event_id", T.LongType())


def _events(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", *columns)


def _verdicts(raw: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Key and whether the row is refused."""
    tagged = conform(raw, schema).tagged
    return tagged.select(key, F.col(REJECT).isNotNull().alias("rejected"))


@plan(
    "conform_int_reject",
    "SELECT event_id, value, 'column ''value'': needs a whole number from -2147483648 to 2147483647, found ' "
    "|| CAST(value AS VARCHAR) AS reject_reason FROM events WHERE value <> trunc(value)",
)
def conform_int_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, "value")
    return conform(raw, parse_columns("event_id BIGINT, value INT")).rejected.select(
        "event_id", "value", "reject_reason"
    )


@plan(
    "conform_int8",
    "SELECT event_id, CAST(user_id AS TINYINT) AS v FROM events WHERE user_id BETWEEN -128 AND 127",
)
def conform_int8(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, F.col("user_id").alias("v"))
    return conform(raw, parse_columns("event_id BIGINT, v TINYINT")).accepted


@plan("conform_uint", "SELECT c_custkey, c_acctbal < 0 OR c_acctbal <> trunc(c_acctbal) AS rejected FROM customer")
def conform_uint(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    return _verdicts(raw, parse_columns("c_custkey BIGINT, balance INT UNSIGNED"), "c_custkey")


@plan(
    "conform_safe_int",
    "SELECT event_id, CAST(event_id AS DOUBLE) * 2e12 > 9007199254740991::DOUBLE AS rejected FROM events",
)
def conform_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, (F.col("event_id").cast("double") * 2e12).alias("v"))
    return _verdicts(raw, parse_columns("event_id BIGINT, v BIGINT"), "event_id")


@plan("conform_wide_int", "SELECT event_id, event_id > 4 AS rejected FROM events")
def conform_wide_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact integers past 64 bits: 2^61 times the id leaves the range at id 4."""
    wide = F.col("event_id").cast("decimal(19,0)") * F.lit(2305843009213693951).cast("decimal(19,0)")
    raw = _events(spark, sf_dir, wide.cast("decimal(38,0)").alias("v"))
    return _verdicts(raw, parse_columns("event_id BIGINT, v BIGINT"), "event_id")


@plan("conform_not_null", "SELECT event_id FROM events WHERE nullif(event_type, 'error') IS NULL")
def conform_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, F.nullif("event_type", F.lit("error")).alias("event_type"))
    return conform(raw, parse_columns("event_id BIGINT, event_type VARCHAR NOT NULL")).rejected.select("event_id")


@plan("conform_string_num", "SELECT doc_id, lang IS NOT NULL AS rejected FROM documents")
def conform_string_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return _verdicts(raw, parse_columns("doc_id BIGINT, lang BIGINT"), "doc_id")


@plan(
    "conform_num_string",
    "SELECT event_id, 'column ''value'': needs a string, found number' AS reject_reason FROM events",
)
def conform_num_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, "value")
    rejected = conform(raw, parse_columns("event_id BIGINT, value VARCHAR")).rejected
    return rejected.select("event_id", "reject_reason")


@plan(
    "conform_bool",
    "SELECT event_id, value > 50 AS flag, event_type <> 'view' AS rejected FROM events",
)
def conform_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flag from a flag; from 0 and 1 the row is refused."""
    raw = _events(
        spark,
        sf_dir,
        (F.col("value") > 50).alias("flag"),
        F.when(F.col("event_type") != "view", F.lit(1)).alias("bit"),
    )
    tagged = conform(raw, parse_columns("event_id BIGINT, flag BOOLEAN, bit BOOLEAN")).tagged
    return tagged.select("event_id", "flag", F.col(REJECT).isNotNull().alias("rejected"))


@plan(
    "conform_float",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(value AS FLOAT) END AS narrow, "
    "CAST(user_id AS DOUBLE) AS whole, event_id % 5 = 0 AS not_a_number FROM events",
)
def conform_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Float columns take any number, not-a-number too."""
    nan = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    raw = _events(spark, sf_dir, nan.alias("narrow"), F.col("user_id").alias("whole"))
    done = conform(raw, parse_columns("event_id BIGINT, narrow FLOAT, whole DOUBLE")).accepted
    return done.select(
        "event_id", F.when(~F.isnan("narrow"), F.col("narrow")).alias("narrow"), "whole",
        F.isnan("narrow").alias("not_a_number"),
    )


@plan(
    "conform_date_floor",
    "SELECT event_id, DATE '1970-01-01' + CAST(floor((event_id - 5000) / 2.0) AS INTEGER) AS d "
    "FROM events",
)
def conform_date_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, ((F.col("event_id") - 5000).cast("decimal(19,0)") * 43200000).alias("d"))
    return conform(raw, parse_columns("event_id BIGINT, d DATE")).accepted


@plan(
    "conform_ts_seconds",
    "SELECT event_id, CAST(floor((event_id - 5000) * 700 / 1000.0) AS BIGINT) AS sec FROM events",
)
def conform_ts_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, ((F.col("event_id") - 5000) * 700).alias("t"))
    done = conform(raw, parse_columns("event_id BIGINT, t TIMESTAMP(0)")).accepted
    return done.select("event_id", F.unix_seconds("t").alias("sec"))


@plan(
    "conform_ts_millis",
    "SELECT event_id, CAST(trunc((event_id - 5000) * 0.5) AS BIGINT) AS ms FROM events",
)
def conform_ts_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions of a millisecond are cut toward zero."""
    raw = _events(spark, sf_dir, ((F.col("event_id") - 5000) * 0.5).alias("t"))
    done = conform(raw, parse_columns("event_id BIGINT, t TIMESTAMP")).accepted
    return done.select("event_id", F.unix_millis("t").alias("ms"))


@plan(
    "conform_ts_ns_overflow",
    "SELECT event_id, event_id::HUGEINT * 2000000000 > 9223372036854 AS rejected FROM events",
)
def conform_ts_ns_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, (F.col("event_id").cast("decimal(19,0)") * 2000000000).alias("t"))
    return _verdicts(raw, parse_columns("event_id BIGINT, t TIMESTAMP(9)"), "event_id")


@plan("conform_moment", "SELECT event_id, ts AS t, CAST(ts AS DATE) AS d, epoch_us(ts) // 1000 AS ms FROM events")
def conform_moment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps given as such: kept, floored to days, or taken as milliseconds."""
    raw = _events(spark, sf_dir, F.col("ts").alias("t"), F.col("ts").alias("d"), F.col("ts").alias("ms"))
    done = conform(raw, parse_columns("event_id BIGINT, t TIMESTAMP, d DATE, ms BIGINT")).accepted
    return done.withColumn("t", F.col("t").cast("timestamp_ntz"))


@plan("conform_date64", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def conform_date64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days given in milliseconds keep their time of day."""
    raw = _events(spark, sf_dir, F.unix_millis("ts").alias("day"))
    done = conform(raw, T.StructType([KEY, column("day", "date64")])).accepted
    return done.select("event_id", F.unix_millis("day").alias("ms"))


@plan("conform_null_only", "SELECT event_id, event_type = 'error' AS rejected FROM events")
def conform_null_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, F.when(F.col("event_type") == "error", F.lit("x")).alias("nothing"))
    return _verdicts(raw, T.StructType([KEY, column("nothing", "null")]), "event_id")


@plan(
    "conform_nested",
    "SELECT event_id, 'column ''value'': needs a plain value, found object' AS reject_reason FROM events",
)
def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, F.struct("value", "user_id").alias("value"))
    rejected = conform(raw, parse_columns("event_id BIGINT, value DOUBLE")).rejected
    return rejected.select("event_id", "reject_reason")


@plan(
    "conform_summary",
    "SELECT CASE WHEN value <> trunc(value) THEN 'value' END AS reject_column, count(*) AS n FROM events GROUP BY 1",
)
def conform_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir, "value")
    return reject_summary(conform(raw, parse_columns("event_id BIGINT, value INT")))


@plan(
    "conform_json_rows",
    "SELECT event_id, k, event_id % 3 AS shape, CASE event_id % 3 "
    "WHEN 1 THEN 'column ''k'': needs a number, found string' "
    "WHEN 2 THEN 'column ''k'': needs a plain value, found object' END AS reject_reason "
    "FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END "
    "AS k FROM events)",
)
def conform_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row objects whose ``k`` is a number, a string or an object by turns."""
    shape = F.col("event_id") % 3

    def made() -> DataFrame:
        # The texts as a client would hand them in, made once.
        number = F.get_json_object("props", "$.k")
        text = (
            F.when(shape == 0, F.col("props"))
            .when(shape == 1, F.concat(F.lit('{"k": "'), number, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"k": {"n": '), number, F.lit("}}")))
        )
        path = fresh_path(spark, "json-rows")
        _events(spark, sf_dir, text.alias("row")).write.parquet(path)
        return spark.read.schema("event_id bigint, row string").parquet(path)

    texts = once(spark, sf_dir, "events", made)
    rows = texts.select("event_id", F.parse_json("row").alias("row"))
    rows = rows_from_variant(rows, "row", ["k"], keep=("event_id",))
    tagged = conform(rows, parse_columns("event_id BIGINT, k INT")).tagged
    return tagged.select("event_id", "k", shape.alias("shape"), F.col(f"{REJECT}.reason").alias("reject_reason"))


@plan(
    "conform_table",
    "SELECT * REPLACE (CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS SMALLINT) AS l_quantity, "
    "CAST(l_discount AS FLOAT) AS l_discount, CAST(l_shipdate AS DATE) AS l_shipdate) "
    "FROM lineitem WHERE l_quantity = trunc(l_quantity) AND l_suppkey BETWEEN 0 AND 4294967295",
)
def conform_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The widest table, all its columns, one rule each."""
    declared = parse_columns(
        "l_orderkey BIGINT NOT NULL, l_partkey BIGINT, l_suppkey INT UNSIGNED, l_linenumber TINYINT, "
        "l_quantity SMALLINT, l_extendedprice DOUBLE, l_discount FLOAT, l_tax DOUBLE, l_returnflag VARCHAR, "
        "l_linestatus VARCHAR, l_shipdate DATE"
    )
    return conform(table(spark, sf_dir, "lineitem"), declared).accepted
