"""Values as a client reads them: times as epoch milliseconds, exact 64-bit integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import UNSUPPORTED, fault
from freshet.functions.logical import INT_BOUNDS, MILLIS_PER_DAY, logical_of


def render_column(field: T.StructField) -> Column:
    """One column in client form; nested and decimal columns are refused."""
    col = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = F.unix_micros(col.cast("timestamp")) / F.lit(1000.0)
    elif logical_of(field) == "uint64":
        # Clients read 64-bit signed integers; larger values show as the largest.
        out = F.least(col, F.lit(INT_BOUNDS["int64"][1]).cast(kind)).cast("bigint")
    elif isinstance(kind, T.DateType):
        out = (F.unix_date(col).cast("bigint") * F.lit(MILLIS_PER_DAY)).cast("double")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)):
        out = col.cast("double")
    elif isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType, T.StringType, T.NullType)):
        out = col
    else:
        raise fault(
            UNSUPPORTED,
            f"column '{field.name}': {kind.simpleString()} has no client form, Arrow batches carry it",
        )
    return out.alias(field.name)


def render(df: DataFrame) -> DataFrame:
    """All rows of ``df`` in client form."""
    return df.select(*[render_column(f) for f in df.schema.fields])


def render_json(df: DataFrame) -> DataFrame:
    """One JSON object per row, nulls written out."""
    return render(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
