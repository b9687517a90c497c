"""Views of a raw value by what it is: integer, number, text, flag, moment.

A conversion rule asks a cell for the views it accepts. A typed raw column has
exactly one view, known while the plan is built, so the other branches never
enter the plan. A column of mixed values (JSON rows, local Python rows) decides
per row.

Expressions are SQL text: a rule is a few dozen operators, and one text costs
one call into the JVM where Column objects would cost one per operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layout mixed values are brought into before any rule sees them.
MIXED = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("integer", T.DecimalType(38, 0)),
        T.StructField("number", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("moment", T.TimestampType()),
    ]
)

_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_KIND_OF_VIEW = {"integer": "bigint", "number": "number", "text": "string", "flag": "boolean", "moment": "date"}
TRUE, FALSE = "true", "false"


def quoted(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Cell:
    """A raw value. ``views`` maps a view to (when it applies, the value).

    ``bounds`` are what the raw type itself guarantees for its integers, so
    that a check it already implies stays out of the plan.
    """

    present: str
    kind: str
    views: dict[str, tuple[str, str]]
    bounds: tuple[int, int] | None = None
    # The text of an integer that no view can hold (kind ``huge``).
    digits: str | None = None

    def within(self, lo: int, hi: int) -> bool:
        """True when every integer of the raw type lies in ``lo..hi``."""
        return self.bounds is not None and lo <= self.bounds[0] and self.bounds[1] <= hi


NOTHING = Cell(FALSE, literal("null"), {})


def _typed(raw: str, view: str, value: str | None = None, bounds: tuple[int, int] | None = None) -> Cell:
    return Cell(f"{raw} IS NOT NULL", literal(_KIND_OF_VIEW[view]), {view: (TRUE, value or raw)}, bounds)


def cell_of(field: T.StructField) -> Cell:
    """The cell of one raw column."""
    raw, kind = quoted(field.name), field.dataType
    if kind.simpleString() == MIXED.simpleString():
        views = {v: (f"{raw}.kind = '{_KIND_OF_VIEW[v]}'", f"{raw}.{v}") for v in MIXED.names[1:]}
        return Cell(f"({raw} IS NOT NULL AND {raw}.kind <> 'null')", f"{raw}.kind", views, digits=f"{raw}.text")
    if bits := _WHOLE.get(type(kind)):
        return _typed(raw, "integer", bounds=(-(1 << bits - 1), (1 << bits - 1) - 1))
    if isinstance(kind, T.DecimalType):
        return _typed(raw, "integer") if kind.scale == 0 else _typed(raw, "number", f"CAST({raw} AS DOUBLE)")
    if isinstance(kind, T.FloatType):
        return _typed(raw, "number", f"CAST({raw} AS DOUBLE)")
    if isinstance(kind, T.DoubleType):
        return _typed(raw, "number")
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return _typed(raw, "text")
    if isinstance(kind, T.BooleanType):
        return _typed(raw, "flag")
    if isinstance(kind, T.TimestampType):
        return _typed(raw, "moment")
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return _typed(raw, "moment", f"CAST({raw} AS TIMESTAMP)")
    if isinstance(kind, T.NullType):
        return NOTHING
    return Cell(f"{raw} IS NOT NULL", literal("object"), {})


def open_variants(raw: DataFrame) -> DataFrame:
    """Bring VARIANT columns into the mixed layout; other columns stay.

    The kind of a value decides every branch, so it is found once, in a
    projection of its own below.
    """
    variants = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.VariantType)]
    if not variants:
        return raw
    kinds = {name: quoted(f"_kind_{k}_{name}") for k, name in enumerate(variants)}
    shaped = raw.selectExpr("*", *[f"{_variant_kind(quoted(name))} AS {kind}" for name, kind in kinds.items()])
    return shaped.selectExpr(
        *[
            f"{_mixed_from_variant(quoted(name), kinds[name])} AS {quoted(name)}" if name in kinds else quoted(name)
            for name in raw.columns
        ]
    )


def rows_from_variant(raw: DataFrame, document: str, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Split a VARIANT column of row objects into one VARIANT column per name.

    A missing key becomes null and extra keys are left behind. For JSON text,
    apply ``parse_json`` first.
    """
    fields = [F.try_variant_get(F.col(document), _json_path(n), "variant").alias(n) for n in names]
    return raw.select(*[F.col(k) for k in keep], *fields)


def _json_path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def _variant_kind(value: str) -> str:
    """What a variant holds; its type is read once and bound to a name."""
    known = (
        "transform(array(schema_of_variant({0})), s -> CASE WHEN s IN ('BIGINT', 'DECIMAL') THEN 'bigint' "
        "WHEN s IN ('DOUBLE', 'FLOAT') THEN 'number' WHEN s = 'STRING' THEN 'string' "
        "WHEN s = 'BOOLEAN' THEN 'boolean' WHEN s = 'VOID' THEN 'null' "
        "WHEN startswith(s, 'DECIMAL(') THEN CASE WHEN endswith(s, ',0)') THEN 'bigint' ELSE 'number' END "
        "ELSE 'object' END)[0]"
    )
    return f"CASE WHEN {value} IS NULL THEN 'null' ELSE {known.format(value)} END"


def _mixed_from_variant(value: str, kind: str) -> str:
    def held(view: str, target: str) -> str:
        return f"CASE WHEN {kind} = '{_KIND_OF_VIEW[view]}' THEN try_variant_get({value}, '$', '{target}') END"

    return (
        f"named_struct('kind', {kind}, 'integer', {held('integer', 'decimal(38,0)')}, "
        f"'number', {held('number', 'double')}, 'text', {held('text', 'string')}, "
        f"'flag', {held('flag', 'boolean')}, 'moment', CAST(NULL AS TIMESTAMP))"
    )
