"""Change feeds, catalog and counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.lateness import epoch_watermarks, refused
from freshet.operators.metrics import pipeline_totals, source_metrics, stream_metrics
from freshet.plans.registry import plan
from freshet.plans.tables import ARRIVALS_SQL, replay, table
from freshet.streaming.feed import barriers, lag, tail
from freshet.streaming.feed import replay as replay_feed
from freshet.streaming.stream import EPOCH


@plan(
    "feed_data",
    f"SELECT epoch, event_type, count(*) AS rows_in_epoch FROM {ARRIVALS_SQL} GROUP BY epoch, event_type",
)
def feed_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay(spark, sf_dir).tap.feed.read()
    return rows.groupBy(EPOCH, "event_type").agg(F.count(F.lit(1)).alias("rows_in_epoch"))


@plan(
    "feed_running",
    "SELECT epoch, event_type, CAST(sum(c) OVER (PARTITION BY event_type ORDER BY epoch) AS BIGINT) AS n "
    f"FROM (SELECT epoch, event_type, count(*) AS c FROM {ARRIVALS_SQL} GROUP BY epoch, event_type)",
)
def feed_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, sf_dir).rollup.feed.read().select(EPOCH, "event_type", "n")


@plan(
    "feed_barriers",
    f"SELECT DISTINCT epoch, epoch + 1 AS checkpoint_id, epoch AS through_sequence FROM {ARRIVALS_SQL}",
)
def feed_barriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barriers(replay(spark, sf_dir).tap.feed)


@plan(
    "feed_tail",
    f"SELECT event_id, epoch FROM {ARRIVALS_SQL} WHERE epoch > (SELECT max(epoch) - 1 FROM {ARRIVALS_SQL})",
)
def feed_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that opened one epoch before the end."""
    feed = replay(spark, sf_dir).tap.feed
    return tail(feed, feed.last() - 1).select("event_id", EPOCH)


@plan("feed_replay", f"SELECT event_id, epoch FROM {ARRIVALS_SQL} WHERE epoch > 4")
def feed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_feed(replay(spark, sf_dir).tap.feed, 4).select("event_id", EPOCH)


@plan("feed_filter", f"SELECT event_id, epoch, value FROM {ARRIVALS_SQL} WHERE epoch > 4 AND value > 50")
def feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_feed(replay(spark, sf_dir).tap.feed, 4, "value > 50").select("event_id", EPOCH, "value")


@plan(
    "feed_lag",
    "SELECT CAST(c.pos AS BIGINT) AS consumer_epoch, "
    "count(DISTINCT e.epoch) FILTER (WHERE e.epoch > c.pos AND e.epoch < 5) AS skipped, "
    "count(*) FILTER (WHERE e.epoch > c.pos AND e.epoch < 5) AS skipped_rows "
    f"FROM (VALUES (-1), (0), (3), (8), (11)) c(pos) CROSS JOIN {ARRIVALS_SQL} e GROUP BY c.pos",
)
def feed_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readers that saw nothing, epochs 0, 3 and 8, and all, of a feed that keeps epoch 5 and later."""
    log = replay(spark, sf_dir).tap.feed.log()
    consumers = log.select((F.col(EPOCH) - 1).alias("consumer_epoch")).where("consumer_epoch IN (-1, 0, 3, 8)")
    consumers = consumers.unionByName(log.agg(F.max(EPOCH).alias("consumer_epoch")))
    return lag(log, consumers, retained_from=5)


@plan(
    "snapshot_as_of",
    f"SELECT event_type, count(*) AS n FROM {ARRIVALS_SQL} WHERE epoch <= 4 GROUP BY event_type",
)
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay(spark, sf_dir).plain.bounded(upto=4)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "source_metrics",
    "SELECT 'events' AS name, count(*) AS total_events, count(*) FILTER (WHERE epoch > 6) AS pending, "
    "CAST(5000 AS BIGINT) AS capacity, count(*) FILTER (WHERE epoch > 6) / 5000.0 > 0.8 AS is_backpressured, "
    "epoch_us(max(ts)) // 1000 AS watermark, least(count(*) FILTER (WHERE epoch > 6) / 5000.0, 1.0) AS utilization "
    f"FROM {ARRIVALS_SQL}",
)
def metrics_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters as they stood when the pipeline had processed epoch 6."""
    return source_metrics(replay(spark, sf_dir).timed.table.log(), "events", processed_through=6, capacity=5000)


@plan(
    "stream_metrics",
    f"SELECT 'rollup' AS name, count(*) AS total_events FROM (SELECT DISTINCT epoch, event_type FROM {ARRIVALS_SQL})",
)
def metrics_of_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_metrics(replay(spark, sf_dir).rollup.feed.log(), "rollup").drop("sql")


@plan(
    "pipeline_metrics",
    f"WITH a AS (SELECT * FROM {ARRIVALS_SQL}), m AS (SELECT epoch, max(ts) AS mx FROM a GROUP BY epoch), "
    "w AS (SELECT epoch, max(mx) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "- INTERVAL 3 DAY AS wm FROM m) "
    "SELECT count(*) AS total_events_ingested, "
    "count(*) FILTER (WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= wm) AS total_events_dropped, "
    "count(DISTINCT epoch) AS total_batches, "
    "count(*) + count(DISTINCT (epoch, event_type)) AS total_events_emitted, "
    "2 * count(DISTINCT epoch) AS total_cycles FROM a JOIN w USING (epoch)",
)
def metrics_of_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters after the replay; dropped is what daily windows under a 3 day delay refuse."""
    done = replay(spark, sf_dir)
    feed = done.tap.feed
    late = refused(feed.read(), epoch_watermarks(feed.log(), "3 days"), "ts", "1 day")
    dropped = late.agg(F.count(F.lit(1)).alias("refused_rows"))
    return pipeline_totals([done.timed.table.log()], [feed.log(), done.rollup.feed.log()], [dropped])


@plan(
    "epoch_progress",
    f"SELECT epoch, count(*) AS input_rows FROM {ARRIVALS_SQL} GROUP BY epoch",
)
def epoch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each micro-batch took in, as the running query reported them."""
    return replay(spark, sf_dir).rollup.progress().groupBy(EPOCH).agg(F.sum("input_rows").alias("input_rows"))


@plan(
    "catalog_sources",
    "SELECT 'events' AS name, 6 AS n_columns, 'ts' AS watermark_column, count(*) AS total_events, "
    "epoch_us(max(ts)) // 1000 AS watermark FROM events "
    "UNION ALL SELECT 'orders', 6, 'o_orderdate', count(*), epoch_us(max(o_orderdate)) // 1000 FROM orders "
    "UNION ALL SELECT 'lineitem', 11, 'l_shipdate', count(*), epoch_us(max(l_shipdate)) // 1000 FROM lineitem",
)
def catalog_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared source with its width, event-time column, size and watermark."""
    rows = []
    for name, time in {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}.items():
        source_rows = table(spark, sf_dir, name)
        rows.append(
            source_rows.agg(
                F.lit(name).alias("name"),
                F.lit(len(source_rows.columns)).alias("n_columns"),
                F.lit(time).alias("watermark_column"),
                F.count(F.lit(1)).alias("total_events"),
                F.unix_millis(F.max(time)).alias("watermark"),
            )
        )
    return reduce(DataFrame.unionByName, rows)
