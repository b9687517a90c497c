"""Bounded queries: scans, projections, predicates, aggregates, result delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.render import render
from freshet.operators.results import first_rows, result_totals
from freshet.plans.registry import plan
from freshet.plans.tables import exact_avg, table, utc
from freshet.sources.arrow_ipc import from_ipc, to_ipc


@plan("bounded_avg", f"SELECT event_type, {exact_avg('value')} AS avg_value FROM events GROUP BY event_type")
def bounded_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("event_type").agg(F.expr(exact_avg("value")).alias("avg_value"))


@plan("bounded_avg_double", "SELECT event_type, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type")
def bounded_avg_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain average; adding up in another order changes its last digits, so six decimals are kept."""
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("avg_value"))


@plan("project_all", "SELECT * FROM events")
def project_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", utc("ts"))


@plan("project_cols", "SELECT event_type, value FROM events")
def project_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "value")


@plan("project_arith", "SELECT user_id * 2 AS user_id2 FROM events")
def project_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.col("user_id") * 2).alias("user_id2"))


@plan("filter_gt", "SELECT event_type, value FROM events WHERE value > 1.6")
def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("value") > 1.6).select("event_type", "value")


@plan("filter_eq", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == "click").select("event_id", "value")


@plan("limit_count", "SELECT count(*) AS n FROM (SELECT * FROM events LIMIT 1000)")
def limit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(table(spark, sf_dir, "events"), 1000).agg(F.count(F.lit(1)).alias("n"))


@plan("render_epoch_ms", "SELECT event_id, epoch_us(ts) / 1000.0 AS ts_ms FROM events")
def render_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("ts_ms")))


@plan(
    "render_rows",
    "SELECT * REPLACE (CAST(l_linenumber AS DOUBLE) AS l_linenumber, epoch_us(l_shipdate) / 1000.0 AS l_shipdate), "
    "CAST(epoch_ms(CAST(l_shipdate AS DATE)) AS DOUBLE) AS ship_day, l_discount > 0.05 AS discounted FROM lineitem",
)
def render_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "*",
        F.col("l_shipdate").cast("date").alias("ship_day"),
        (F.col("l_discount") > 0.05).alias("discounted"),
    )
    return render(rows)


@plan("arrow_roundtrip", "SELECT * FROM events")
def arrow_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return from_ipc(to_ipc(rows), rows.schema).withColumn("ts", utc("ts"))


@plan("arrow_batches", "SELECT count(*) AS num_rows FROM events")
def arrow_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ipc(table(spark, sf_dir, "events")).agg(F.sum("rows").alias("num_rows"))


@plan("batch_stats", "SELECT count(*) AS num_rows FROM events")
def num_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_totals(table(spark, sf_dir, "events"))


@plan(
    "arrow_export",
    "SELECT count(*) AS num_rows, min(l_suppkey) AS least_id, max(l_shipdate) AS newest, "
    "CAST(sum(CAST(l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS total FROM lineitem",
)
def arrow_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table as ``(ts, id, v)`` Arrow IPC streams, totalled after decoding."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"), F.col("l_suppkey").alias("id"), F.col("l_quantity").alias("v")
    )
    back = from_ipc(to_ipc(rows), rows.schema)
    return back.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.min("id").alias("least_id"),
        F.max("ts").cast("timestamp_ntz").alias("newest"),
        F.sum(F.col("v").cast("decimal(38,10)")).cast("double").alias("total"),
    )
