"""Sharding by minimax contiguous partition.

Rows of equal text are an atomic group. Groups lie in the order of a digest of
their text; shards are stretches of that order. The least capacity with which a
greedy pass needs no more shards than allowed is found by binary search.

Sizes reach the driver as a histogram over the order: first its 4096 coarse
stretches, then the finer ones of those a cut may fall into, until every cut is
at the border of a single group. What the driver holds depends on the number of
shards and not of rows.

Defined results: a null text has no bytes and is grouped with empty ones;
repeated rows stay together, each with a slot of its own; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import written

PLACE_BITS = 60
FIRST_BITS, STEP_BITS = 12, 8
# Rows numbered within one task, about.
CELL = 50_000


@dataclass(frozen=True)
class Stretch:
    """Groups with places from ``low`` to ``high`` (both included) and their bytes."""

    low: int
    high: int
    bytes: int
    bits: int


def place_of(text: Column) -> Column:
    """A number of 60 bits that depends on the text only."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("long")


def cuts(sizes: list[int], capacity: int) -> list[int]:
    """Where greedy shards of at most ``capacity`` begin, the first apart; sizes are not split."""
    out, held = [], 0
    for k, size in enumerate(sizes):
        if held + size > capacity and held:
            out.append(k)
            held = 0
        held += size
    return out


def least_capacity(sizes: list[int], shards: int) -> int:
    """The smallest capacity that holds all sizes in order with so many shards."""
    low, high = max([0, *sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        if len(cuts(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def _histogram(rows: DataFrame, bits: int, within: list[Stretch]) -> list[Stretch]:
    """The stretches of so many leading bits, of the given coarser ones alone."""
    shift = PLACE_BITS - bits
    if within:
        parents = [s.low >> PLACE_BITS - s.bits for s in within]
        rows = rows.where(F.shiftright("place", PLACE_BITS - within[0].bits).isin(parents))
    sums = rows.groupBy(F.shiftright("place", shift).alias("at")).agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.sum("size").alias("bytes")
    )
    return [Stretch(r["low"], r["high"], r["bytes"], bits) for r in sums.orderBy("at").collect()]


def _doubtful(stretches: list[Stretch], shards: int) -> list[Stretch]:
    """The stretches of several groups that a cut may fall into.

    Whole stretches give a capacity that is enough; the mean, or the largest
    single group, one that is not too large. The k-th cut of the best solution
    lies behind the k-th cut of whole stretches at the lesser capacity less one
    stretch, and not behind k times the larger capacity.
    """
    sizes = [s.bytes for s in stretches]
    enough = least_capacity(sizes, shards)
    single = [s.bytes for s in stretches if s.low == s.high]
    lesser = max([-(-sum(sizes) // shards), *single])
    ranges, held, offset, k = [], 0, 0, 1
    for size in sizes:
        # The cut is within or before this stretch, as far as whole ones tell.
        if held + size > lesser and k < shards:
            ranges.append((offset, k * enough))
            k, held = k + 1, 0
        held += size
        offset += size
    while k < shards:
        ranges.append((offset, offset))
        k += 1
    out, offset = [], 0
    for s in stretches:
        if s.low < s.high and any(offset < last and first <= offset + s.bytes for first, last in ranges):
            out.append(s)
        offset += s.bytes
    return out


def boundaries(rows: DataFrame, shards: int) -> list[int]:
    """The places at which shards 1, 2, ... begin; ``rows`` has ``place`` and ``size``."""
    bits = FIRST_BITS
    stretches = _histogram(rows, bits, [])
    while bits < PLACE_BITS:
        doubtful = _doubtful(stretches, shards)
        if not doubtful:
            break
        # Those of like depth are refined together.
        depth = min(s.bits for s in doubtful)
        chosen = [s for s in doubtful if s.bits == depth]
        bits = depth + STEP_BITS
        finer = _histogram(rows, bits, chosen)
        gone = set(chosen)
        stretches = sorted([s for s in stretches if s not in gone] + finer, key=lambda s: s.low)
    sizes = [s.bytes for s in stretches]
    if not sizes:
        return []
    return [stretches[k].low for k in cuts(sizes, least_capacity(sizes, shards))]


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row.

    Slots are numbered within cells that deal each shard's rows evenly, from
    the number of rows in the cells before; no task numbers a whole shard.
    """
    safe = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("id"),
            (F.octet_length(safe) + 1).cast("long").alias("size"),
            F.crc32(safe.cast("binary")).alias("text_crc32"),
            place_of(F.col(text)).alias("place"),
            # Written with the row, so that it is the same in every later job.
            F.monotonically_increasing_id().alias("row"),
        ),
        "sharding-rows",
    )
    number = F.lit(0)
    for start in boundaries(rows, shards):
        number = number + F.when(F.col("place") >= start, 1).otherwise(0)
    cells = max(1, rows.count() // CELL)
    dealt = rows.withColumn("shard", number.cast("int")).withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
    counts = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")
    starts = counts.select("shard", "cell", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("row")) - 1
    return (
        dealt.withColumn("within", within)
        .join(written(starts, "sharding-starts"), ["shard", "cell"])
        .select("id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"))
    )
