"""Reading a change feed: barriers, replay, tail, filter, lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.sources.epoch_table import EpochTable
from freshet.streaming.stream import EPOCH


def barriers(feed: EpochTable) -> DataFrame:
    """One row per committed epoch: its checkpoint and the last sequence covered.

    A feed hands out one data frame per epoch, so the epoch is the sequence.
    """
    return feed.log().select(
        EPOCH,
        (F.col(EPOCH) + 1).alias("checkpoint_id"),
        F.col(EPOCH).alias("through_sequence"),
    )


def replay(feed: EpochTable, after: int, where: str | Column | None = None) -> DataFrame:
    """Rows of the epochs after ``after``, optionally filtered.

    The epoch bound prunes partitions and the row filter reaches the Parquet
    scan. Raises 502 where retention has removed rows the reader still needs.
    """
    rows = feed.read(after=after)
    if where is None:
        return rows
    return rows.where(F.expr(where) if isinstance(where, str) else where)


def tail(feed: EpochTable, opened_at: int, where: str | Column | None = None) -> DataFrame:
    """Rows that arrived since a reader opened at the end of epoch ``opened_at``."""
    return replay(feed, opened_at, where)


def lag(log: DataFrame, consumers: DataFrame, retained_from: int) -> DataFrame:
    """Entries each consumer missed for good, as epochs and as rows.

    ``log`` has one row per epoch with the rows of all epochs before it;
    ``consumers`` has ``consumer_epoch``, the last epoch the consumer saw, -1
    before the first. What it missed lies between the epoch it wants next and
    the oldest one kept: two entries of the log tell how many rows that is.
    """
    kept = log.where(F.col(EPOCH) == retained_from - 1).select(F.col("rows_before") + F.col("rows")).first()
    before_kept = kept[0] if kept else 0
    wants = F.col("consumer_epoch") + 1
    behind = wants < retained_from
    next_rows = log.select((F.col(EPOCH) - 1).alias("consumer_epoch"), "rows_before")
    return consumers.join(next_rows, "consumer_epoch", "left").select(
        "consumer_epoch",
        F.when(behind, F.lit(retained_from) - wants).otherwise(0).cast("bigint").alias("skipped"),
        F.when(behind, F.lit(before_kept) - F.col("rows_before")).otherwise(0).cast("bigint").alias("skipped_rows"),
    )


def latest(feed_rows: DataFrame, keys: list[str], epoch: str = EPOCH) -> DataFrame:
    """The last emitted row of every key: the materialized view of a feed.

    One aggregate per column keeps fixed-width columns in hash aggregation,
    where one aggregate over a struct would fall back to sorting.
    """
    values = [c for c in feed_rows.columns if c not in keys and c != epoch]
    if not values:
        return feed_rows.select(*keys).distinct()
    return feed_rows.groupBy(*keys).agg(*[F.max_by(v, epoch).alias(v) for v in values])
