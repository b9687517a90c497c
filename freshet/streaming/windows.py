"""Which rows a windowed query leaves out.

A window over event time is closed once the watermark reached its end; rows
that come later are left out. To count them one needs the query's window and
the conditions that rows pass before it. Both are read off the parsed query.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.errors import BAD_CONFIG, fault
from freshet.functions.parsed import expressions, kind, parsed, plans, sequence
from freshet.sources.source import Source


def _window(expression: JavaObject) -> list[str] | None:
    """The arguments of the window function within an expression, as SQL, if it holds one."""
    for part in expressions(expression):
        if kind(part) == "UnresolvedFunction" and sequence(part.nameParts())[-1].lower() == "window":
            return [argument.sql() for argument in sequence(part.arguments())]
    return None


@dataclass(frozen=True)
class Refusal:
    """A window over event time and the conditions before it, as SQL over a source's columns."""

    time: str
    width: str
    slide: str
    begin: str
    conditions: tuple[str, ...] = ()

    @property
    def closes(self) -> str:
        """The end of the last window that a row belongs to."""
        return f"window({self.time}, {self.slide}, {self.slide}, {self.begin}).start + INTERVAL {self.width}"

    def closing(self, source: Source, spark: SparkSession) -> DataFrame | None:
        """``file`` and ``closes_us`` of the rows that the window sees.

        None for a source without event time or without the columns asked for.
        """
        if source.watermark_column is None:
            return None
        try:
            rows = spark.read.schema(source.schema).parquet(source.path)
            for condition in self.conditions:
                rows = rows.where(condition)
            rows = rows.withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
            return rows.select("file", F.unix_micros(F.expr(self.closes).cast("timestamp")).alias("closes_us"))
        except AnalysisException:
            return None


def _of(arguments: list[str], conditions: tuple[str, ...]) -> Refusal:
    time, width, *more = arguments
    slide, begin = [*more, width, "'0 seconds'"][:2] if not more else (more[0], more[1] if len(more) > 1 else "'0 seconds'")
    return Refusal(time, width, slide, begin, conditions)


def refusal_by(session: SparkSession, window: str) -> Refusal:
    """The refusals of a window given as SQL."""
    arguments = _window(session._jsparkSession.sessionState().sqlParser().parseExpression(window))
    if arguments is None:
        raise fault(BAD_CONFIG, f"not a window over event time: {window}")
    return _of(arguments, ())


def refusal_of(session: SparkSession, sql: str) -> Refusal | None:
    """The window a query in SQL groups by; None if it groups by none.

    Only filters between the grouping and the tables are followed. A query
    that computes the event time before that is not understood.
    """
    try:
        plan = parsed(session, sql)
    except (Py4JJavaError, ParseException):
        return None  # the query itself is refused with the reason
    for node in plans(plan):
        if kind(node) != "Aggregate":
            continue
        windows = [w for e in sequence(node.groupingExpressions()) if (w := _window(e))]
        if windows:
            conditions = [below.condition().sql() for below in plans(node.child()) if kind(below) == "Filter"]
            return _of(windows[0], tuple(conditions))
    return None
