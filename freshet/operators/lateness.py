"""Late rows: which rows arrived behind the watermark, and how many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.streaming.stream import EPOCH


def epoch_watermarks(log: DataFrame, delay: str) -> DataFrame:
    """The watermark each epoch was processed under.

    An epoch sees the newest event time of all epochs before it, less
    ``delay``; the first sees none. The log entry of an epoch carries that
    time (``newest_before_us``).
    """
    newest = F.timestamp_micros("newest_before_us")
    return log.select(EPOCH, (newest - F.expr(f"INTERVAL {delay}")).alias("watermark"))


def split_late(rows: DataFrame, watermarks: DataFrame, time: str) -> DataFrame:
    """Flag every row that is older than the watermark its epoch ran under.

    The watermark side is read from a small file, so Spark knows its size and
    broadcasts it while it is small; beyond that it joins on the epoch, where
    adaptive execution splits an oversized epoch.
    """
    flagged = rows.join(watermarks, EPOCH, "left")
    return flagged.withColumn("is_late", F.coalesce(F.col(time) < F.col("watermark"), F.lit(False))).drop("watermark")


def refused(rows: DataFrame, watermarks: DataFrame, time: str, width: str) -> DataFrame:
    """The rows that arrived when their window of ``width`` had closed already.

    A row behind the watermark still counts while the window it belongs to is
    open; this is what a windowed stream leaves out.
    """
    closed = F.window(F.col(time), width)["end"] <= F.col("watermark")
    return rows.join(watermarks, EPOCH, "left").where(closed).drop("watermark")


def late_counts(flagged: DataFrame) -> DataFrame:
    """Late rows per epoch."""
    return flagged.where("is_late").groupBy(EPOCH).agg(F.count(F.lit(1)).alias("n_late"))
