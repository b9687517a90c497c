"""Times the headline queries; prints one JSON line.

The published numbers were taken warm, over 2 seconds per case. Likewise every
query runs untimed first and is then repeated for at least BENCH_SECONDS; the
shortest run counts. Streams run once untimed and once timed. Results go to
Spark's no-op sink, so every row and column is produced. Planning is included.
"""

from __future__ import annotations

import json
import os
import time

from freshet.plans import PLANS
from freshet.plans.tables import replay, table
from freshet.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SECONDS = float(os.environ.get("BENCH_SECONDS", "2"))

# Headline queries and the table whose rows they go through.
BATCH = {
    "bounded_avg": "events",
    "project_all": "events",
    "filter_gt": "events",
    "limit_count": "events",
    "conform_table": "lineitem",
    "conform_int_reject": "events",
    "conform_date_floor": "events",
    "conform_json_rows": "events",
    "conform_summary": "events",
    "render_rows": "lineitem",
    "arrow_export": "lineitem",
    "arrow_roundtrip": "events",
    "feed_replay": "events",
    "feed_filter": "events",
    "late_split": "events",
    "late_counts": "events",
    "pipeline_watermark": "lineitem",
}
STREAMS = {
    "stream_map": "events",
    "stream_filter": "events",
    "stream_rollup": "lineitem",
    "stream_running_count": "events",
    "mv_latest": "events",
    "window_incremental": "events",
    "window_on_close": "events",
    "heartbeat_close": "events",
}


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return time.perf_counter() - began


def shortest(work) -> float:
    work()
    times = []
    while len(times) < 3 or sum(times) < SECONDS:
        times.append(timed(work))
    return min(times)


def main() -> None:
    spark = build_session(
        "freshet-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> None:
        PLANS[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    # Twelve appends, each taken in by two streams: warmed up on the smallest
    # data, then timed as a whole.
    replay(spark, os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001"))
    seconds = {"replay_12_epochs": timed(lambda: replay(spark, SF_DIR))}
    for name in BATCH:
        seconds[name] = shortest(lambda: run(name))
    client = table(spark, SF_DIR, "lineitem").select("l_shipdate", "l_suppkey", "l_quantity")
    seconds["client_arrow"] = shortest(client.toArrow)
    for name in STREAMS:
        run(name)
        seconds[name] = timed(lambda: run(name))

    rows = {name: table(spark, SF_DIR, name).count() for name in ("events", "lineitem")}
    through = {"replay_12_epochs": "events", **BATCH, "client_arrow": "lineitem", **STREAMS}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "rows_per_sec": {name: round(rows[through[name]] / s) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
