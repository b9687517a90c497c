"""What a running query knows: the rows of its state, read by the ``statestore`` source.

State serves to check a feed against the query that wrote it, and to make a
feed or view again that was lost. Rows hold ``key`` and ``value`` as the
operator keeps them: grouping columns, and the buffers of the aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from freshet.streaming.stream import Stream


def state_rows(stream: Stream, epoch: int | None = None, operator: int = 0) -> DataFrame:
    """``key``, ``value`` and ``partition_id`` after an epoch, the last one unless given.

    ``operator`` numbers the operators with state within the query.
    """
    reader = stream.state_reader().option("operatorId", operator)
    if epoch is not None:
        reader = reader.option("batchId", epoch)
    return reader.load(stream.checkpoint_path)


def state_changes(stream: Stream, first: int, last: int, operator: int = 0) -> DataFrame:
    """What epochs from ``first`` to ``last`` changed: ``batch_id``, ``change_type``, ``key``, ``value``, ``partition_id``.

    Needs a store that keeps a log of changes, as RocksDB with changelog
    checkpoints does.
    """
    reader = stream.state_reader().option("operatorId", operator).option("readChangeFeed", "true")
    return reader.option("changeStartBatchId", first).option("changeEndBatchId", last).load(stream.checkpoint_path)
