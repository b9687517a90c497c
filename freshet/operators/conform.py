"""The conform job: raw rows in, typed rows and explained rejects out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import BAD_VALUE, marked
from freshet.functions.cells import NOTHING, cell_of, literal, open_variants, quoted
from freshet.functions.convert import Converted, convert
from freshet.session import tune

RAW = "_raw"
REJECT = "_reject"


@dataclass(frozen=True)
class Conformed:
    """Raw rows with the rules of a schema attached; nothing has run yet.

    Each view is one projection over one scan of ``raw`` and evaluates what it
    shows: the accepted rows never build a reason.
    """

    raw: DataFrame
    typed: dict[str, Converted]
    row_id: str | None = None

    @property
    def refused(self) -> str:
        """Whether any column refuses the row."""
        return "(" + " OR ".join(done.refused for done in self.typed.values()) + ")"

    @property
    def reject(self) -> str:
        """The first refusing column with its code and reason, or null."""
        cases = [
            f"WHEN {done.refused} THEN "
            f"named_struct('column', {literal(name)}, 'code', {BAD_VALUE}, 'reason', {self._located(done)})"
            for name, done in self.typed.items()
        ]
        return f"CASE {' '.join(cases)} END"

    def _located(self, done: Converted) -> str:
        if not self.row_id:
            return done.reason
        return f"concat({done.reason}, ' (row ', CAST({quoted(self.row_id)} AS STRING), ')')"

    def _values(self) -> list[str]:
        return [f"{done.value} AS {quoted(name)}" for name, done in self.typed.items()]

    @property
    def accepted(self) -> DataFrame:
        """Rows every column accepted, in the declared schema."""
        return self.raw.where(f"NOT {self.refused}").selectExpr(*self._values())

    @property
    def rejected(self) -> DataFrame:
        """Raw rows with the first column that refused them, code and reason."""
        columns = [quoted(c) for c in self.raw.columns]
        refused = self.raw.where(self.refused).selectExpr(*columns, f"{self.reject} AS {REJECT}")
        return refused.selectExpr(
            *columns,
            f"{REJECT}.column AS reject_column",
            f"{REJECT}.code AS reject_code",
            f"{REJECT}.reason AS reject_reason",
        )

    @property
    def tagged(self) -> DataFrame:
        """All rows: the raw row, the typed columns (null where refused), the reject or null."""
        raw_row = f"struct({', '.join(quoted(c) for c in self.raw.columns)}) AS {RAW}"
        values = [
            f"CASE WHEN NOT {done.refused} THEN {done.value} END AS {quoted(name)}"
            for name, done in self.typed.items()
        ]
        return self.raw.selectExpr(raw_row, *values, f"{self.reject} AS {REJECT}")

    @property
    def strict(self) -> DataFrame:
        """Typed rows of a job that fails at the first reject.

        Written with a committer that publishes at job end, the write stores
        every row or none, and the data is read once.
        """
        failure = f"raise_error(concat({literal(marked(BAD_VALUE, ''))}, ({self.reject}).reason))"
        checked = f"CASE WHEN {self.refused} THEN CAST({failure} AS BOOLEAN) ELSE true END"
        return self.raw.where(checked).selectExpr(*self._values())


def conform(raw: DataFrame, schema: T.StructType, row_id: str | None = None) -> Conformed:
    """Attach the strict rules of ``schema`` to raw rows.

    A declared column missing from ``raw`` counts as null; extra raw columns
    are carried only into the rejects. ``row_id`` names a raw column that
    identifies the row in the reason.
    """
    tune(raw.sparkSession)
    opened = open_variants(raw)
    cells = {f.name: cell_of(f) for f in opened.schema.fields}
    return Conformed(opened, {f.name: convert(f, cells.get(f.name, NOTHING)) for f in schema.fields}, row_id)


def reject_summary(result: Conformed) -> DataFrame:
    """Rows per refusing column, accepted rows under a null column."""
    label = result.tagged.select(F.col(f"{REJECT}.column").alias("reject_column"))
    return label.groupBy("reject_column").agg(F.count(F.lit(1)).alias("n"))
