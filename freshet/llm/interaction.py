"""How filters act on each other, for every order of applying them.

A row fails some of the filters: its mask. A mask settles what happens at each
step of each order, so it is mapped to wide integers with one field for every
step of every order (600 for five filters), one integer per measure. Adding
integers adds all fields at once. Fields have ``FIELD_BITS`` bits and counts of
rows fewer, so no field overflows into the next.

Rows are counted by part, mask and labels first, with partial sums in every
task; tasks then add up packed integers of such counts, and one row per part
and task is shuffled. Nothing is gathered by text: equal texts meet as counts
per digest, part and mask, the rows of least id apart, so a text that a third
of the rows share is a few rows per task.

Defined results: a null text is empty, a null part the empty string; no filter
but E can fail a text for lack of words except the least number of words; a row
without an id is never a copy and never the first of a text; rows that share
the least id and the text are both first; an id with several labels has each
mark any of them gives; very long texts are read whole; an empty table gives an
empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import let, words, written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MOST_CAPITALS = 200, 50, 3
# Characters that filter D rejects.
SYMBOLS = r"[#$%&*|]"
FIELD_BITS = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def fails(text: Column) -> Column:
    """Bits of the filters A to D that a text fails, A lowest."""
    n_chars, n_capitals = F.length(text), F.regexp_count(text, F.lit("[A-Z]"))
    symbols = F.rlike(text, F.lit(SYMBOLS))

    def bits(w: Column) -> Column:
        n, distinct = F.size(w), F.size(F.array_distinct(w))
        checks = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * n_capitals > MOST_CAPITALS * n_chars, symbols]
        out = F.lit(0)
        for k, check in enumerate(checks):
            out = out + F.when(check, 1 << k).otherwise(0)
        return out

    return let(words(text), bits)


def masked(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str, quality: str, toxic: str) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and the number ``n`` of such rows."""
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        fails(plain).alias("mask"),
        F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest"),
    )
    # Repeated rows become one with a count before any key is shuffled.
    rows = written(rows.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n")), "interaction-rows")
    marks = labels.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(quality) == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col(toxic) == 1, F.lit(False)).alias("toxic"),
    )
    marks = marks.where("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    no = F.lit(False)
    told = rows.where("id IS NOT NULL").join(marks, "id", "left").select(
        *rows.columns, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )
    # Rows without an id join nothing, and would all meet in one task.
    told = told.unionByName(rows.where("id IS NULL").withColumns({"good": no, "toxic": no}))
    groups = told.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("low"),
    )
    # Few rows per digest now: parts and labels.
    first = F.min("low.id").over(Window.partitionBy("digest"))
    spared = F.col("nameless") + F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0)
    counted = groups.withColumn("first", first).withColumn("copies", F.col("n") - spared)
    copy = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), F.col("copies").alias("n")),
    )
    each = counted.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*")
    return each.where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@cache
def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


@cache
def packed(mask: int, filters: str = FILTERS) -> dict[str, int]:
    """The integers of one row with this mask: a field per step of each order, the first one lowest."""
    failing = {f for k, f in enumerate(filters) if mask >> k & 1}
    out, at = dict.fromkeys(MEASURES[:4], 0), 0
    for order in orders(filters):
        ends = min((order.index(f) for f in failing), default=len(order))
        for step, f in enumerate(order):
            one = 1 << at
            out["kept"] += one * (step < ends)
            out["removed"] += one * (step == ends)
            out["redundant"] += one * (f in failing and ends < step)
            out["unique_fails"] += one * (failing == {f})
            at += FIELD_BITS
    return out


def total(cells: Iterator[tuple[int, bool, bool, int]], filters: str = FILTERS) -> dict[str, int]:
    """Sums over (mask, good, toxic, number of rows)."""
    out = dict.fromkeys(MEASURES, 0)
    for mask, good, toxic, n in cells:
        one = packed(mask, filters)
        for name, value in one.items():
            out[name] += n * value
        out["good_lost"] += n * one["removed"] * good
        out["toxic_lost"] += n * one["removed"] * toxic
    return out


def unpacked(value: int, filters: str = FILTERS) -> np.ndarray:
    """The fields of an integer, the lowest first."""
    fields = len(orders(filters)) * len(filters)
    return np.frombuffer(value.to_bytes(fields * FIELD_BITS // 8, "little"), "<i8")


_PACKED = "part string, " + ", ".join(f"{m} binary" for m in MEASURES)
_STEPS = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in (*MEASURES, "shapley"))


def _wide(value: int) -> bytes:
    return value.to_bytes(-(-value.bit_length() // 8), "little")


def steps(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every order does at every step in every part, from counts of ``part``, ``mask``, ``good``, ``toxic``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[tuple]] = {}
            for part, *cell in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.setdefault(part, []).append(tuple(cell))
            sums = [total(own, filters) for own in parts.values()]
            columns = [pa.array([_wide(s[m]) for s in sums], pa.binary()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), *columns], ["part", *MEASURES])

    def unpack(key: tuple, table: pa.Table) -> pa.Table:
        found = {m: unpacked(sum(int.from_bytes(v, "little") for v in table.column(m).to_pylist()), filters) for m in MEASURES}
        names = orders(filters)
        steps_of = np.array([list(order) for order in names]).ravel()
        share = {f: int(found["removed"][steps_of == f].sum()) for f in filters}
        n, size = len(steps_of), len(filters)
        columns = [
            pa.array([key[0].as_py()] * n, pa.string()),
            pa.array([order for order in names for _ in range(size)], pa.string()),
            pa.array(list(range(1, size + 1)) * len(names), pa.int32()),
            *(pa.array(found[m], pa.int64()) for m in MEASURES),
            pa.array([share[f] for f in steps_of], pa.int64()),
        ]
        return pa.table(columns, names=["part", "filter_order", "step", *MEASURES, "shapley"])

    sums = cells.select("part", "mask", "good", "toxic", "n").mapInArrow(add, _PACKED)
    return sums.groupBy("part").applyInArrow(unpack, _STEPS)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """``part``, ``filter_order``, ``step`` and the counts of each step."""
    return steps(masked(docs, labels, key, text, part, quality, toxic))
