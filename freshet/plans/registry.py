"""Registered queries and the SQL that states their result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from freshet.session import stream_session

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    run: Run
    oracle: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with the SQL of its result."""

    def register(run: Run) -> Run:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Event times are instants; the result tables show them in UTC. The
            # caller's session keeps its own settings.
            own = stream_session(spark)
            own.conf.set("spark.sql.session.timeZone", "UTC")
            return run(own, sf_dir)

        PLANS[name] = Plan(name, prepared, oracle)
        return run

    return register
