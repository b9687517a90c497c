"""Appends by several writers, and Arrow files as a source."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.logical import parse_columns
from freshet.plans.registry import plan
from freshet.plans.tables import COLUMNS, table, utc
from freshet.session import fresh_path
from freshet.sources.arrow_ipc import read_ipc_files, write_ipc_files
from freshet.sources.source import REJECTED_ROW, StoredSource
from freshet.streaming.ingestion import Ingestion, files_arriving

WRITERS, APPENDS = 4, 2
ARRIVALS = 3


@plan(
    "ingest_writers",
    "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, max(event_id) AS newest FROM events GROUP BY event_type",
)
def ingest_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers append at the same time, two parts each, through the strict rules."""
    events, path = table(spark, sf_dir, "events"), fresh_path(spark, "writers")
    columns = parse_columns(COLUMNS["events"])

    def write(k: int) -> None:
        own = StoredSource(spark, "events", columns, path)
        for part in range(APPENDS):
            own.insert_frame(events.where(F.col("event_id") % (WRITERS * APPENDS) == k * APPENDS + part))

    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, range(WRITERS)))
    rows = StoredSource(spark, "events", columns, path).bounded()
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.max("event_id").alias("newest")
    )


@plan("ingest_quarantine", "SELECT event_id, value = trunc(value) AS stored FROM events")
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass are appended and the others kept aside, each row in one place."""
    path = fresh_path(spark, "quarantine")
    source = StoredSource(spark, "events", parse_columns("event_id BIGINT, value INT"), f"{path}/events")
    source.insert_accepted(table(spark, sf_dir, "events").select("event_id", "value"), f"{path}/rejects")
    rejects = spark.read.schema("event_id bigint").parquet(f"{path}/rejects")
    return (
        source.bounded()
        .select("event_id", F.lit(True).alias("stored"))
        .unionByName(rejects.select("event_id", F.lit(False).alias("stored")))
    )


@plan("ingest_ipc_files", "SELECT * FROM events")
def ingest_ipc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrow files, written by tasks, appended to a source."""
    path = fresh_path(spark, "ipc")
    write_ipc_files(table(spark, sf_dir, "events"), f"{path}/files")
    source = StoredSource(spark, "events", parse_columns(COLUMNS["events"]), f"{path}/events")
    source.insert_ipc_files(f"{path}/files")
    return source.bounded().withColumn("ts", utc("ts"))


@plan(
    "ingest_live",
    "SELECT event_id, event_id % 2 = 0 AS stored, CASE WHEN event_id % 2 = 0 THEN floor(value)::INT END AS value, "
    "CASE WHEN event_id % 2 = 1 THEN 'value' END AS reject_column FROM events",
)
def ingest_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in three steps; every second row breaks a rule and is kept aside."""
    path = fresh_path(spark, "live")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "floor(value) + (event_id % 2) * 0.5D AS value")
    source = StoredSource(spark, "events", parse_columns("event_id BIGINT, value INT"), f"{path}/events")
    raw = files_arriving(f"{path}/landing", "event_id bigint, value double", max_files=2)
    live = Ingestion(spark, "live", source, raw, f"{path}/live", row_id="event_id")
    for k in range(ARRIVALS):
        arrived = events.where(F.col("event_id") % ARRIVALS == k).repartition(2)
        arrived.write.mode("append").json(f"{path}/landing")
        live.run_available()
    none = F.lit(None)
    stored = source.bounded().select(
        "event_id", F.lit(True).alias("stored"), "value", none.cast("string").alias("reject_column")
    )
    refused = source.rejects().select(
        F.get_json_object(REJECTED_ROW, "$.event_id").cast("bigint").alias("event_id"),
        F.lit(False).alias("stored"),
        none.cast("int").alias("value"),
        "reject_column",
    )
    return stored.unionByName(refused)


@plan("ingest_ipc_ranges", "SELECT * FROM events")
def ingest_ipc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few large Arrow files of many batches, which tasks share."""
    path = fresh_path(spark, "ipc-ranges")
    write_ipc_files(table(spark, sf_dir, "events").repartition(2), f"{path}/files", whole_partitions=True, batch_rows=500)
    columns = parse_columns(COLUMNS["events"])
    return read_ipc_files(spark, f"{path}/files", columns, range_bytes=1 << 16).withColumn("ts", utc("ts"))
