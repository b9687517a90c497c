"""Declared column types: SQL names, value ranges, Spark and Arrow counterparts."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from freshet.errors import INVALID_SQL, SCHEMA_MISMATCH, UNSUPPORTED, fault

# The integer types with their bounds. Spark has no unsigned
# types, so those sit in the next wider signed one, 64-bit ones in a decimal:
# Arrow batches fill it in full, rows of values up to the signed maximum.
INT_BOUNDS = {
    "int8": (-128, 127, T.ByteType()),
    "int16": (-32768, 32767, T.ShortType()),
    "int32": (-2147483648, 2147483647, T.IntegerType()),
    "int64": (-9223372036854775808, 9223372036854775807, T.LongType()),
    "uint8": (0, 255, T.ShortType()),
    "uint16": (0, 65535, T.IntegerType()),
    "uint32": (0, 4294967295, T.LongType()),
    "uint64": (0, 9223372036854775807, T.DecimalType(20, 0)),
}
# How many milliseconds fit a signed 64-bit count of each unit.
# Spark stores every timestamp in microseconds, which bounds coarser units too.
MILLIS_BOUND = {
    "timestamp_s": 9223372036854775,
    "timestamp_ms": 9223372036854775,
    "timestamp_us": 9223372036854775,
    "timestamp_ns": 9223372036854,
    "date64": 9223372036854775,
}
MAX_SAFE_INTEGER = 9007199254740991
MILLIS_PER_DAY = 86400000

# Declared type -> (Spark type, Arrow type).
TYPES = {
    "boolean": (T.BooleanType(), pa.bool_()),
    **{name: (bounds[2], getattr(pa, name)()) for name, bounds in INT_BOUNDS.items()},
    "float32": (T.FloatType(), pa.float32()),
    "float64": (T.DoubleType(), pa.float64()),
    "utf8": (T.StringType(), pa.string()),
    "date32": (T.DateType(), pa.date32()),
    "date64": (T.TimestampType(), pa.date64()),
    "timestamp_s": (T.TimestampType(), pa.timestamp("s")),
    "timestamp_ms": (T.TimestampType(), pa.timestamp("ms")),
    "timestamp_us": (T.TimestampType(), pa.timestamp("us")),
    "timestamp_ns": (T.TimestampType(), pa.timestamp("ns")),
    "null": (T.StringType(), pa.null()),
}

# What a plain Spark type declares when the column carries no logical name.
_PLAIN = {
    T.BooleanType: "boolean",
    T.ByteType: "int8",
    T.ShortType: "int16",
    T.IntegerType: "int32",
    T.LongType: "int64",
    T.FloatType: "float32",
    T.DoubleType: "float64",
    T.StringType: "utf8",
    T.DateType: "date32",
    T.TimestampType: "timestamp_us",
    T.TimestampNTZType: "timestamp_us",
    T.NullType: "null",
}

_UNSIGNED = {"TINYINT": "uint8", "SMALLINT": "uint16", "INT": "uint32", "INTEGER": "uint32", "BIGINT": "uint64"}
_UNIT = {"0": "timestamp_s", "3": "timestamp_ms", "6": "timestamp_us", "9": "timestamp_ns"}
_UNSIGNED_COLUMN = re.compile(r"(\w+)\s+(TINYINT|SMALLINT|INTEGER|INT|BIGINT)\s+UNSIGNED\b", re.I)
_UNIT_COLUMN = re.compile(r"(\w+)\s+TIMESTAMP\s*\(\s*([0369])\s*\)", re.I)
_TEXT_TYPE = re.compile(r"\b(?:VARCHAR|TEXT)\b(?!\s*\()", re.I)


def column(name: str, logical: str, nullable: bool = True) -> T.StructField:
    """One declared column, for example ``column("n", "uint32", nullable=False)``."""
    if logical not in TYPES:
        raise fault(UNSUPPORTED, f"column '{name}': unsupported type {logical}")
    return T.StructField(name, TYPES[logical][0], nullable, {"logical": logical})


def parse_columns(ddl: str) -> T.StructType:
    """The column list of a source declaration as a Spark schema.

    Spark reads the list. Only the spellings it lacks are rewritten first:
    ``VARCHAR`` without a length, ``UNSIGNED``, and ``TIMESTAMP(0|3|6|9)``.
    """
    logical: dict[str, str] = {}

    def unsigned(match: re.Match) -> str:
        logical[match[1]] = _UNSIGNED[match[2].upper()]
        return f"{match[1]} {TYPES[logical[match[1]]][0].simpleString()}"

    def unit(match: re.Match) -> str:
        logical[match[1]] = _UNIT[match[2]]
        return f"{match[1]} timestamp"

    text = _UNSIGNED_COLUMN.sub(unsigned, _TEXT_TYPE.sub("STRING", ddl))
    text = _UNIT_COLUMN.sub(unit, text)
    try:
        schema = T.StructType.fromDDL(text)
    except PySparkException as error:
        raise fault(INVALID_SQL, f"invalid column list: {error.getMessage() or error}") from error
    return T.StructType(
        [
            column(f.name, logical[f.name], f.nullable) if f.name in logical
            else T.StructField(f.name, f.dataType, f.nullable)
            for f in schema.fields
        ]
    )


def logical_of(field: T.StructField) -> str:
    """The declared type of a column; nested and decimal types answer ``other``."""
    named = (field.metadata or {}).get("logical")
    return named or _PLAIN.get(type(field.dataType), "other")


def arrow_type(field: T.StructField) -> pa.DataType | None:
    """The Arrow type a column must arrive in, None where any is accepted."""
    known = TYPES.get(logical_of(field))
    return known[1] if known else None


def check_schema(declared: T.StructType, actual: T.StructType) -> None:
    """Names and types must match in order; nullability is not compared."""
    if len(declared) != len(actual):
        raise fault(SCHEMA_MISMATCH, f"{len(declared)} columns are declared, the input has {len(actual)}")
    for want, got in zip(declared.fields, actual.fields):
        same_type = _comparable(want.dataType) == _comparable(got.dataType)
        if want.name != got.name or not same_type:
            raise fault(
                SCHEMA_MISMATCH,
                f"column '{want.name}' is declared as {want.dataType.simpleString()}, "
                f"the input has '{got.name}' of {got.dataType.simpleString()} there",
            )


def _comparable(kind: T.DataType) -> str:
    # Nullability inside nested types is left out too.
    text = kind.jsonValue()
    return re.sub(r"'(containsNull|nullable|valueContainsNull)': (True|False)", "", str(text))


def describe(schema: T.StructType) -> list[tuple[int, str, str, bool]]:
    """Catalog rows of a schema: position, name, declared type, nullable."""
    return [
        (pos, f.name, logical_of(f) if logical_of(f) != "other" else f.dataType.simpleString(), f.nullable)
        for pos, f in enumerate(schema.fields)
    ]
