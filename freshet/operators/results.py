"""Delivering results: bounded prefixes, batch statistics, batches on demand."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.errors import WRONG_STATEMENT, fault
from freshet.sources.arrow_ipc import batch_counts, read_stream, to_ipc


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for use inside a larger query."""
    return df.limit(n)


def batch_stats(df: DataFrame) -> DataFrame:
    """Rows per output partition, as one line per partition."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("num_rows"))


def result_totals(df: DataFrame) -> DataFrame:
    """Number of rows over all partitions of a result."""
    return batch_stats(df).agg(F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_rows"))


class ResultStream:
    """Arrow batches of a query on demand, one partition at a time.

    The driver holds the batches of at most the partition being read and the
    one after it.
    """

    def __init__(self, df: DataFrame):
        self._spark = df.sparkSession
        self.schema = df.schema
        self.tag = f"freshet-{uuid.uuid4().hex[:12]}"
        self._payloads = to_ipc(df)
        self._rows: Iterator | None = None
        self._done = False

    def next_batch(self) -> pa.RecordBatch | None:
        """The next batch; None at the end or after ``cancel``."""
        if self._done:
            return None
        self._spark.addTag(self.tag)
        try:
            if self._rows is None:
                self._rows = self._payloads.toLocalIterator(prefetchPartitions=True)
            row = next(self._rows, None)
        except Exception:
            if self._done:
                return None
            raise
        finally:
            self._spark.removeTag(self.tag)
        if row is None:
            self._done = True
            return None
        return read_stream(bytes(row["ipc"])).read_next_batch()

    def cancel(self) -> None:
        """Stop the query; again is a no-op."""
        if not self._done:
            self._done = True
            self._spark.interruptTag(self.tag)

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        try:
            while (batch := self.next_batch()) is not None:
                yield batch
        finally:
            self.cancel()


class Result:
    """A bounded query result: a DataFrame with the client's ways of reading it."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.schema = df.schema
        self._counted: dict[int, int] | None = None
        self._payloads: RDD | None = None

    def num_rows(self) -> int:
        return self.df.count()

    def _batches(self) -> dict[int, int]:
        """The number of batches of each partition that has any, found once and without encoding one."""
        if self._counted is None:
            rows = batch_counts(self.df).orderBy("part").collect()
            self._counted = {r["part"]: r["batches"] for r in rows}
        return self._counted

    def num_batches(self) -> int:
        """Arrow batches the result comes in."""
        return sum(self._batches().values())

    def batch(self, index: int) -> pa.RecordBatch:
        """One batch in partition order; outside the range is an E400.

        The counts tell which partition holds it; only that one is run, and
        only that batch comes to the client.
        """
        left = index
        for part, batches in self._batches().items() if index >= 0 else ():
            if left >= batches:
                left -= batches
                continue
            if self._payloads is None:
                # Kept, so that shuffles below it are not run again for the next batch.
                self._payloads = to_ipc(self.df).rdd
            context, place = self.df.sparkSession.sparkContext, left
            found = context.runJob(self._payloads, lambda rows: islice(rows, place, place + 1), [part])
            if found:
                return read_stream(bytes(found[0]["ipc"])).read_next_batch()
            break
        raise fault(WRONG_STATEMENT, f"batch index {index} out of range")

    def to_arrow(self) -> pa.Table:
        """The whole result at the client; for results that fit there."""
        return self.df.toArrow()

    def to_ipc(self) -> bytes:
        """The whole result at the client as one Arrow IPC stream."""
        table = self.to_arrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def to_rows(self) -> list[dict]:
        """The whole result at the client as dictionaries in client form."""
        from freshet.functions.render import render

        return [row.asDict() for row in render(self.df).collect()]
