"""Counters of sources, streams and the pipeline, as tables over commit logs.

The logs carry row counts observed while the rows were written, so no counter
scans data again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.sources.source import APPEND_ID

# Fixed value: a source counts as backpressured above this share of capacity.
BACKPRESSURE_SHARE = 0.8


def source_metrics(
    log: DataFrame,
    name: str,
    capacity: int,
    processed_through: int | None = None,
    processed_rows: int | None = None,
    explicit_watermark: int | None = None,
) -> DataFrame:
    """Totals of one source: rows, rows not yet processed, pressure, watermark.

    What was processed is given as the last append taken in or, where batches
    do not follow appends, as a number of rows. ``explicit_watermark`` is how
    far heartbeats took event time, in milliseconds.
    """
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    if processed_through is not None:
        waiting = F.coalesce(F.sum(F.when(F.col(APPEND_ID) > processed_through, F.col("rows"))), F.lit(0))
    else:
        waiting = F.greatest(rows - F.lit(processed_rows or 0), F.lit(0))
    share = F.col("pending") / F.lit(float(capacity))
    return (
        log.agg(
            rows.alias("total_events"),
            waiting.cast("bigint").alias("pending"),
            F.greatest(F.expr("max(max_event_us) div 1000"), F.lit(explicit_watermark).cast("bigint")).alias("watermark"),
        )
        .withColumn("name", F.lit(name))
        .withColumn("capacity", F.lit(capacity).cast("bigint"))
        .withColumn("utilization", F.least(share, F.lit(1.0)))
        .withColumn("is_backpressured", share > BACKPRESSURE_SHARE)
        .select("name", "total_events", "pending", "capacity", "is_backpressured", "watermark", "utilization")
    )


def stream_metrics(feed_log: DataFrame, name: str, sql: str | None = None) -> DataFrame:
    """Rows a stream emitted."""
    return feed_log.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_events")).select(
        F.lit(name).alias("name"), "total_events", F.lit(sql).cast("string").alias("sql")
    )


def pipeline_totals(
    source_logs: list[DataFrame], feed_logs: list[DataFrame], dropped: list[DataFrame] | None = None
) -> DataFrame:
    """Over the pipeline: rows in, rows refused as late, appends, rows out, micro-batches.

    ``dropped`` are tables with a column ``refused_rows``: what windows that had
    closed refused.
    """
    names = [
        "total_events_ingested", "total_events_dropped", "total_batches", "total_events_emitted", "total_cycles",
    ]

    def totals(log: DataFrame, **sums: str) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        filled = {out: F.coalesce(F.sum(F.expr(expr)), zero).alias(out) for out, expr in sums.items()}
        return log.agg(*[filled.get(n, F.max(zero).alias(n)) for n in names])

    each = [
        totals(log, total_events_ingested="rows", total_batches="1L")
        for log in source_logs
    ]
    each += [totals(log, total_events_dropped="refused_rows") for log in dropped or []]
    each += [totals(log, total_events_emitted="rows", total_cycles="1L") for log in feed_logs]
    return reduce(DataFrame.unionByName, each).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def source_watermark(rows: DataFrame, name: str, time: str) -> DataFrame:
    """The newest event time of one source in epoch milliseconds."""
    newest = F.unix_millis(F.max(F.col(time).cast("timestamp")))
    return rows.agg(newest.alias("watermark")).select(F.lit(name).alias("source"), "watermark")


def pipeline_watermark(watermarks: list[DataFrame]) -> DataFrame:
    """The minimum watermark over sources."""
    return reduce(DataFrame.unionByName, watermarks).agg(F.min("watermark").alias("watermark"))
