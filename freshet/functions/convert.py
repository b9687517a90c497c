"""Strict conversion rules: one raw cell to one declared type.

A rule gives three things: the converted value, the condition under which it is
accepted, and the cases that put a refusal into words. The condition is all a
job needs that wants only accepted rows; the cases are evaluated for refused
rows alone and always cover what the condition excludes. Nothing here raises:
the casts are the try variants.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

from freshet.errors import UNSUPPORTED, fault
from freshet.functions.cells import FALSE, TRUE, Cell, literal
from freshet.functions.logical import (
    INT_BOUNDS,
    MAX_SAFE_INTEGER,
    MILLIS_BOUND,
    MILLIS_PER_DAY,
    TYPES,
    logical_of,
)

Cases = list[tuple[str, str]]
_LO64, _HI64, _ = INT_BOUNDS["int64"]
# Doubles beyond 2^53-1 in size stand for more than one integer.
_AMBIGUOUS = ", which as a double stands for several integers"


@dataclass(frozen=True)
class Rule:
    """What one rule says about a value that is present, as SQL text."""

    value: str
    accepted: str
    cases: Cases


def _first(cases: Cases, default: str = "NULL") -> str:
    """The output of the first case that holds."""
    if not cases:
        return default
    if cases[0][0] == TRUE:
        return cases[0][1]
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {default} END"


def _any(conditions: list[str]) -> str:
    return "(" + " OR ".join(conditions) + ")" if conditions else FALSE


def _all(*conditions: str) -> str:
    return "(" + " AND ".join(c for c in conditions if c != TRUE) + ")" if set(conditions) != {TRUE} else TRUE


def _between(x: str, lo: int, hi: int) -> str:
    return f"({x} BETWEEN {lo}L AND {hi}L)"


def _cast(x: str, target: T.DataType) -> str:
    return f"CAST({x} AS {target.simpleString()})"


def _try_cast(x: str, target: T.DataType | str) -> str:
    return f"try_cast({x} AS {target if isinstance(target, str) else target.simpleString()})"


def _say(text: str, got: str | None = None, tail: str = "") -> str:
    if got is None:
        return literal(text)
    return f"concat({literal(text)}, coalesce(CAST({got} AS STRING), 'null'), {literal(tail)})"


def _other_kind(cell: Cell, expected: str, *views: str) -> tuple[str, str]:
    """The case that the value is of none of the accepted kinds."""
    accepted = _any([cell.views[v][0] for v in views if v in cell.views])
    return f"NOT {accepted}", _say(f"needs {expected}, found ", cell.kind)


def _not_finite(x: str) -> str:
    return f"(isnan({x}) OR abs({x}) = double('infinity'))"


def _safe(x: str) -> str:
    """Doubles that stand for one integer only; false for not-a-number."""
    return f"(abs({x}) <= {MAX_SAFE_INTEGER}D)"


def _in_range(cell: Cell, lo: int, hi: int, whole_numbers: bool) -> str:
    """Accepted numeric cells: integers, doubles and moments within ``lo..hi``.

    Bounds the value cannot leave anyway are not checked: those of the raw
    integer type, 2^53-1 for doubles, the microsecond range for moments.
    """
    accepted = []
    if "integer" in cell.views:
        condition, x = cell.views["integer"]
        accepted.append(condition if cell.within(lo, hi) else _all(condition, _between(x, lo, hi)))
    if "number" in cell.views:
        condition, x = cell.views["number"]
        checks = [condition, _safe(x)]
        if whole_numbers:
            checks.append(f"rint({x}) = {x}")
        if not lo <= -MAX_SAFE_INTEGER:
            checks.append(f"{x} >= {lo}D")
        if not hi >= MAX_SAFE_INTEGER:
            checks.append(f"{x} <= {hi}D")
        accepted.append(_all(*checks))
    if "moment" in cell.views:
        condition, x = cell.views["moment"]
        implied = lo <= -MILLIS_BOUND["timestamp_us"] - 1 and hi >= MILLIS_BOUND["timestamp_us"]
        accepted.append(condition if implied else _all(condition, _between(f"unix_millis({x})", lo, hi)))
    return _any(accepted)


def _integer(cell: Cell, logical: str) -> Rule:
    lo, hi, target = INT_BOUNDS[logical]
    whole = f"needs a whole number from {lo} to {hi}, found "
    cases: Cases = [_other_kind(cell, "a number", "integer", "number", "moment")]
    values: Cases = []
    if "integer" in cell.views:
        condition, x = cell.views["integer"]
        values.append((condition, _try_cast(x, target)))
        cases.append((_all(condition, f"NOT {_between(x, lo, hi)}"), _say(whole, x)))
    if "number" in cell.views:
        condition, x = cell.views["number"]
        values.append((condition, _try_cast(x, target)))
        broken = f"({_not_finite(x)} OR rint({x}) <> {x})"
        cases.append((_all(condition, broken), _say(whole, x)))
        cases.append((_all(condition, f"NOT {_safe(x)}"), _say("needs an integer type for ", x, _AMBIGUOUS)))
        cases.append((condition, _say(whole, _try_cast(x, "bigint"))))
    if "moment" in cell.views:
        condition, x = cell.views["moment"]
        values.append((condition, _try_cast(f"unix_millis({x})", target)))
        cases.append((condition, _say(whole, f"unix_millis({x})")))
    return Rule(_cast(_first(values), target), _in_range(cell, lo, hi, whole_numbers=True), cases)


def _float(cell: Cell, logical: str) -> Rule:
    values: Cases = []
    accepted = []
    if "number" in cell.views:
        values.append(cell.views["number"])
        accepted.append(cell.views["number"][0])
    if "integer" in cell.views:
        condition, x = cell.views["integer"]
        values.append((condition, f"CAST({x} AS DOUBLE)"))
        accepted.append(condition if cell.within(_LO64, _HI64) else _all(condition, _between(x, _LO64, _HI64)))
    if "moment" in cell.views:
        condition, x = cell.views["moment"]
        values.append((condition, f"CAST(unix_millis({x}) AS DOUBLE)"))
        accepted.append(condition)
    refusal = _other_kind(cell, "a number", "number", "integer", "moment")
    return Rule(_cast(_first(values), TYPES[logical][0]), _any(accepted), [refusal])


def _single(cell: Cell, view: str, expected: str, target: T.DataType) -> Rule:
    held = [cell.views[view]] if view in cell.views else []
    value = _cast(_first(held), target)
    return Rule(value, _any([condition for condition, _ in held]), [_other_kind(cell, expected, view)])


def _millis(cell: Cell) -> tuple[str, Cases]:
    """Exact milliseconds of a temporal cell, and the cases without any."""
    cases: Cases = [_other_kind(cell, "a number of milliseconds", "integer", "number", "moment")]
    values: Cases = []
    if "integer" in cell.views:
        condition, x = cell.views["integer"]
        values.append((condition, _try_cast(x, "bigint")))
    if "number" in cell.views:
        condition, x = cell.views["number"]
        values.append((condition, _try_cast(x, "bigint")))  # drops the fraction toward zero
        cases.append((_all(condition, _not_finite(x)), _say("needs a finite number of milliseconds, found ", x)))
        cases.append((_all(condition, f"NOT {_safe(x)}"), _say("needs an integer type for ", x, _AMBIGUOUS)))
    if "moment" in cell.views:
        condition, x = cell.views["moment"]
        values.append((condition, f"unix_millis({x})"))
    return _cast(_first(values), T.LongType()), cases


def floor_div(x: str, by: int) -> str:
    """Integer division toward negative infinity, without overflow."""
    return f"(({x} div {by}L) - CASE WHEN {x} < 0L AND {x} % {by}L <> 0L THEN 1L ELSE 0L END)"


def _date(cell: Cell, logical: str) -> Rule:
    millis, cases = _millis(cell)
    days = floor_div(millis, MILLIS_PER_DAY)
    cases.append((TRUE, _say("needs a day that a date can hold, found day ", days)))
    lo, hi = INT_BOUNDS["int32"][0] * MILLIS_PER_DAY, (INT_BOUNDS["int32"][1] + 1) * MILLIS_PER_DAY - 1
    accepted = _in_range(cell, lo, hi, whole_numbers=False)
    return Rule(f"date_from_unix_date({_try_cast(days, 'int')})", accepted, cases)


def _timestamp(cell: Cell, logical: str) -> Rule:
    millis, cases = _millis(cell)
    bound = MILLIS_BOUND[logical]
    cases.append((TRUE, _say(f"needs a time that {logical} can hold, found millisecond ", millis)))
    accepted = _in_range(cell, -bound, bound, whole_numbers=False)
    moment, kept = cell.views.get("moment", (FALSE, "")), logical in ("timestamp_us", "timestamp_ns")
    if kept and moment[0] == TRUE:
        return Rule(moment[1], accepted, cases)  # a timestamp already: keep its microseconds
    if not cell.within(-bound, bound):
        # The one conversion without a try variant must not see what is refused.
        millis = f"CASE WHEN {_between(millis, -bound, bound)} THEN {millis} END"
    if logical == "timestamp_s":
        return Rule(f"timestamp_seconds({floor_div(millis, 1000)})", accepted, cases)
    value = f"timestamp_millis({millis})"
    if kept and moment[0] != FALSE:
        value = f"CASE WHEN {moment[0]} THEN {moment[1]} ELSE {value} END"
    return Rule(value, accepted, cases)


def _null_only(cell: Cell, logical: str) -> Rule:
    return Rule("CAST(NULL AS STRING)", FALSE, [(TRUE, _say("needs null, found a value"))])


_RULES: dict[str, Callable[[Cell, str], Rule]] = {
    **{name: _integer for name in INT_BOUNDS},
    "float32": _float,
    "float64": _float,
    "boolean": lambda cell, _: _single(cell, "flag", "a boolean", T.BooleanType()),
    "utf8": lambda cell, _: _single(cell, "text", "a string", T.StringType()),
    "date32": _date,
    **{name: _timestamp for name in MILLIS_BOUND},
    "null": _null_only,
}


@dataclass(frozen=True)
class Converted:
    """A typed column: its value where accepted, whether it is refused, and why."""

    value: str
    refused: str
    reason: str


def convert(field: T.StructField, cell: Cell) -> Converted:
    """``cell`` as the declared column ``field``, in SQL text."""
    logical = logical_of(field)
    if logical not in _RULES:
        raise fault(
            UNSUPPORTED,
            f"column '{field.name}': rows of values cannot fill {field.dataType.simpleString()}, Arrow batches can",
        )
    rule = _RULES[logical](cell, logical)
    refused = f"({cell.present} AND NOT coalesce({rule.accepted}, false))"
    cases = list(rule.cases)
    cases.insert(0, (f"{cell.kind} = 'object'", _say("needs a plain value, found ", cell.kind)))
    if cell.digits:
        cases.insert(0, (f"{cell.kind} = 'huge'", _say("needs an integer of 64 bits, found ", cell.digits)))
    if "integer" in cell.views and not cell.within(_LO64, _HI64):
        condition, x = cell.views["integer"]
        too_wide = _all(condition, f"NOT {_between(x, _LO64, _HI64)}")
        cases.insert(0, (too_wide, _say("needs an integer of 64 bits, found ", x)))
    if not field.nullable:
        refused = f"(NOT {cell.present} OR {refused})"
        cases.insert(0, (f"NOT {cell.present}", _say("needs a value, found null")))
    label = literal(f"column '{field.name}': ")
    reason = f"concat({label}, {_first(cases, literal('needs another value'))})"
    return Converted(rule.value, refused, reason)
