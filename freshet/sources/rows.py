"""Rows held by the client as a raw DataFrame of mixed cells."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterable, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from freshet.errors import UNSUPPORTED, fault
from freshet.functions.cells import MIXED

ROW_ID = "_row"
_WIDEST = 10**38 - 1
_ROWS_PER_TASK = 100_000


def mixed_cell(value: Any) -> dict | None:
    """One Python value as a cell that keeps its kind."""
    if value is None:
        return None
    if isinstance(value, bool):
        return {"kind": "boolean", "flag": value}
    if isinstance(value, int):
        if abs(value) > _WIDEST:
            # Beyond what any column holds: refused later, under its own digits.
            return {"kind": "huge", "text": str(value)}
        return {"kind": "bigint", "integer": decimal.Decimal(value)}
    if isinstance(value, float):
        return {"kind": "number", "number": value}
    if isinstance(value, decimal.Decimal):
        whole = value.is_finite() and value == value.to_integral_value()
        return mixed_cell(int(value)) if whole else mixed_cell(float(value))
    if isinstance(value, str):
        return {"kind": "string", "text": value}
    if isinstance(value, dt.datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
        return {"kind": "date", "moment": aware}
    if isinstance(value, dt.date):
        return mixed_cell(dt.datetime(value.year, value.month, value.day))
    return {"kind": "object"}


def rows_frame(spark: SparkSession, schema: T.StructType, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """A raw frame of the declared columns; keys outside the schema are ignored."""
    cells: dict[str, list] = {name: [] for name in schema.names}
    count = 0
    for count, row in enumerate(rows, 1):
        if not isinstance(row, Mapping):
            raise fault(UNSUPPORTED, f"expected row objects, got {type(row).__name__}")
        for name, column in cells.items():
            column.append(mixed_cell(row.get(name)))
    mixed = to_arrow_type(MIXED)
    arrays = [pa.array(range(count), pa.int64()), *(pa.array(column, mixed) for column in cells.values())]
    layout = T.StructType(
        [T.StructField(ROW_ID, T.LongType()), *(T.StructField(name, MIXED) for name in schema.names)]
    )
    frame = spark.createDataFrame(pa.table(arrays, names=layout.names), layout)
    return frame.coalesce(1 + count // _ROWS_PER_TASK)
