"""Mixing sources to target weights with hash-threshold histograms.

Each document has a place between 0 and 2^60, the leading bits of a digest of
its id and text. A source's budget becomes a threshold on places: words are
summed by source and leading bits of the place, the bucket in which the budget
ends is found, and only that bucket is split further, until it holds a single
place. Documents below the threshold are taken. Nothing is sorted, and since
the same places serve every budget, a larger budget takes the same documents
and more. All sizes are read for the first histogram and for the boundary
buckets' rows, which are then a table of their own.

Rows that agree in id, source and text share a place. Where the budget ends
within one, it takes as many of its rows as come nearest; only the rows of such
places are numbered, task by task.

A budget above the source's size is met by whole rounds over the source first.

Defined results: a null text has no words; a null source is a source of its
own, after all others; of rows that agree in id, source and text any may be
those that are taken once more; with no words at all every target is zero; very
long texts are counted whole; an empty table gives an empty table; extra columns
stay, whatever their names. Sources may be many: their weights and thresholds
stay tables, though one task puts the sources, not their rows, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import SPACE, written

PLACE_BITS = 60
# Bits of a place that one round of histograms resolves.
STEP_BITS = 12
MOST_ROUNDS = 3
WEIGHTS = (1, 2, 3)


def size_of(text: Column) -> Column:
    """The number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE.replace("[", "[^"))).cast("long")


def place_of(key: Column, text: Column) -> Column:
    """A number of 60 bits that depends on the row's id and text only."""
    plain = F.concat_ws("\n", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(plain.cast("binary")), 1, PLACE_BITS // 4), 16, 10).cast("long")


def _named(source: Column) -> list[Column]:
    """A source as two columns without nulls, so that plain joins and groups match it."""
    return [source.isNull().alias("unnamed"), F.coalesce(source, F.lit("")).alias("source")]


_SOURCE = ["unnamed", "source"]


def targets(sizes: DataFrame) -> DataFrame:
    """Words wanted of each source: ``total`` is what it has, ``target`` what it should give.

    The shares of all words are by weight. The sources that stop at three times
    their size are those whose size per weight is least, so with sources in
    that order each may be tried as the first that doesn't stop; its level is
    what is left over the weights left.
    """
    totals = sizes.groupBy(*_SOURCE).agg(F.sum("size").alias("total"))
    rank = F.row_number().over(Window.orderBy(*_SOURCE)) - 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(rank, F.lit(3)) + 1))
    weighed = weighed.withColumn("stop", F.lit(1.0 * MOST_ROUNDS) * F.col("total") / F.col("weight"))
    by_stop = Window.orderBy("stop", *_SOURCE)
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("total").over(Window.partitionBy()) - MOST_ROUNDS * F.coalesce(F.sum("total").over(before), F.lit(0))) / (
        F.sum("weight").over(by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    )
    tried = weighed.withColumn("level", level)
    first = F.min(F.when(F.col("stop") >= F.col("level"), F.struct("stop", *_SOURCE, "level"))).over(Window.partitionBy())
    reached = tried.withColumn("reached", first["level"])
    return reached.select(
        *_SOURCE, "total", F.least(F.col("weight") * F.col("reached"), 1.0 * MOST_ROUNDS * F.col("total")).alias("target")
    )


def thresholds(sizes: DataFrame) -> DataFrame:
    """For each source: target, whole ``rounds`` over it, and where the round after them ends.

    Documents at places before ``edge`` are taken once more; of the ``held``
    rows at ``edge`` itself ``extra`` are. Each histogram after the first reads
    the rows of the boundary buckets alone.
    """
    rounds = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(F.lit(0)).cast("long")
    open_ = targets(sizes).withColumn("rounds", rounds)
    open_ = open_.withColumn("lacks", F.col("target") - F.col("rounds") * F.col("total"))
    open_ = written(open_, "mixing-targets")
    shift, inside = PLACE_BITS, sizes
    while shift > 0:
        shift -= STEP_BITS
        sums = inside.groupBy(*_SOURCE, F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("held"), F.min("place").alias("low"), F.max("place").alias("high")
        )
        upto = F.sum("words").over(Window.partitionBy(*_SOURCE).orderBy("bucket"))
        steps = sums.withColumn("upto", upto).join(open_.select(*_SOURCE, "lacks"), _SOURCE)
        ends = steps.where("upto > lacks").groupBy(*_SOURCE).agg(
            F.min(F.struct("bucket", "upto", "words", "held", "low", "high")).alias("end")
        )
        before = F.col("end.upto") - F.col("end.words")
        none = F.lit(1 << PLACE_BITS).cast("long")
        open_ = written(
            open_.join(ends, _SOURCE, "left").select(
                *_SOURCE,
                "total",
                "target",
                "rounds",
                F.coalesce(F.col("lacks") - before, F.lit(0.0)).alias("lacks"),
                # Without a boundary the budget is all of the source.
                F.coalesce("end.bucket", F.lit(1 << (PLACE_BITS - shift)).cast("long")).alias("prefix"),
                F.coalesce("end.low", none).alias("low"),
                F.coalesce("end.high", none).alias("high"),
                F.coalesce("end.words", F.lit(0)).alias("words"),
                F.coalesce("end.held", F.lit(0)).alias("held"),
            ),
            "mixing-bounds",
        )
        if not open_.where("low < high").limit(1).count():
            break
        # The boundary buckets' rows, and nothing else, fall into finer ones.
        near = inside.join(open_.select(*_SOURCE, "prefix"), _SOURCE)
        inside = written(near.where(F.shiftright("place", shift) == F.col("prefix")).drop("prefix"), "mixing-boundary")
    # Rows at one place are of one size: as many of them as come nearest, a half rounded down.
    each = F.col("words") / F.col("held")
    extra = F.when(F.col("words") > 0, F.ceil(F.col("lacks") / each - 0.5)).otherwise(0)
    extra = F.greatest(F.least(extra, F.col("held")), F.lit(0)).cast("long")
    return open_.select(*_SOURCE, "total", "target", "rounds", F.col("low").alias("edge"), "held", extra.alias("extra"))


def _sizes(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    return written(
        docs.select(
            F.col(key).alias("id"),
            *_named(F.col(source)),
            size_of(F.col(text)).alias("size"),
            place_of(F.col(key), F.col(text)).alias("place"),
        ),
        "mixing-sizes",
    )


def _placed(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """The rows, which have ``place`` and their source, with ``total``, ``target`` and ``copies``.

    Where only some rows of a place are taken, its rows are numbered within
    their tasks, and each task's numbers begin where those before it end.
    """
    met = rows.join(bounds, _SOURCE)
    more = (F.col("place") < F.col("edge")) | ((F.col("place") == F.col("edge")) & (F.col("extra") == F.col("held")))
    split = (F.col("place") == F.col("edge")) & (F.col("extra") > 0) & (F.col("extra") < F.col("held"))
    names = [c for c in met.columns if c not in ("edge", "held", "extra", "rounds")]
    copies = (F.col("rounds") + F.when(more, 1).otherwise(0)).cast("long").alias("copies")
    plain = met.where(~split).select(*names, copies)
    if not bounds.where("extra > 0 AND extra < held").limit(1).count():
        return plain
    shared = met.where(split).withColumns({"part": F.spark_partition_id(), "nth": F.monotonically_increasing_id()})
    shared = written(shared, "mixing-shared")
    task = Window.partitionBy(*_SOURCE, "part")
    tasks = shared.groupBy(*_SOURCE, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(*_SOURCE, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = shared.withColumn("own", F.row_number().over(task.orderBy("nth"))).join(tasks, [*_SOURCE, "part"])
    once = F.when(F.col("before") + F.col("own") <= F.col("extra"), 1).otherwise(0)
    return plain.unionByName(numbered.select(*names, (F.col("rounds") + once).cast("long").alias("copies")))


def taken(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``id``, ``size``, ``source_size``, ``target`` and ``copies`` of every row."""
    sizes = _sizes(docs, key, source, text)
    bounds = written(thresholds(sizes), "mixing-thresholds")
    return _placed(sizes, bounds).select("id", "size", F.col("total").alias("source_size"), "target", "copies")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows the mix takes, as often as it takes them, with all their columns."""
    bounds = written(thresholds(_sizes(docs, key, source, text)), "mixing-thresholds")
    rows = docs.select(
        F.struct("*").alias("row"), *_named(F.col(source)), place_of(F.col(key), F.col(text)).alias("place")
    )
    often = _placed(rows, bounds).select("row", F.col("copies").cast("int").alias("copies")).where("copies > 0")
    return often.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
