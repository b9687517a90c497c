"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. Vectors are
dealt by a hash of their id to shards of about ``SHARD``; each shard posts its
vectors in one inverted file per pivot: which vectors have the pivot, and at
which place. A query reads the files of its own pivots, sums what they tell of
the footrule distance between the orders of pivots, and reranks the vectors of
least footrule by their true distance. Shards answer alone; answers are merged.

Every vector is indexed. Pivots are a bounded sample. The share of vectors that
is reranked sets recall: 0.99 over the 50,000 vectors of the check data, which
are nearly equidistant (neighbours at 1.0, others at 1.4).

A shard's index is shuffled once. The queries, the smaller side, are sent to
every shard and stream past it, so a task holds one shard and one batch of
queries however many there are. Queries are a fixed share of the rows where the
caller says so, and shards grow with the rows: the work is then their product,
in bounded tasks.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors are compared with
those of their own length only, each length being a search of its own; rows
that agree in id and vector are one, those that share an id alone are apart and
may be near each other; equal distances rank by id; fewer candidates than asked
for are all returned; an empty table gives an empty table; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import written

PIVOTS = 256
PREFIX = 128
SHARD = 16_384
# Vectors of a shard that are reranked: this share, and no fewer than LEAST.
SHARE, LEAST = 0.1, 256

_FILES = "shard int, pivot int, members binary, places binary"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def candidates(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``vector`` and ``mark`` (a hash of both) of what takes part, one row per id and vector."""
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))
    return rows.distinct().withColumn("mark", F.xxhash64("id", "vector"))


def pivots(vectors: DataFrame, most: int = PIVOTS) -> np.ndarray:
    """A sample of at most ``most`` different vectors, by a hash of their components."""
    rows = vectors.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(most).collect()
    return np.array([r["vector"] for r in rows], dtype=np.float64)


def permutations(x: np.ndarray, fixed: np.ndarray, prefix: int) -> np.ndarray:
    """For each row its nearest pivots, nearest first, ties to the lower number."""
    apart = (fixed * fixed).sum(axis=1)[None, :] - 2 * (x @ fixed.T)
    return np.argsort(apart, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def index(vectors: DataFrame, fixed: np.ndarray, prefix: int, shards: int) -> DataFrame:
    """The inverted files: for each shard and pivot the members and the pivot's place with each.

    A member is named by its place in the shard's order of ids. The file of
    pivot -1 holds the shard's ids, marks and vectors themselves.
    """
    width = fixed.shape[1]

    def post(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("mark", "ascending")])
        ids, marks = table.column("id").to_numpy(), table.column("mark").to_numpy()
        x = _matrix(table.column("vector").combine_chunks(), width)
        order = permutations(x, fixed, prefix)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), order.shape[1])
        place = np.tile(np.arange(order.shape[1], dtype=np.int16), len(ids))
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[by_pivot], np.arange(len(fixed) + 1))
        rows = [(-1, ids.tobytes() + marks.tobytes(), x.tobytes())]
        for p in range(len(fixed)):
            some = by_pivot[ends[p] : ends[p + 1]]
            if len(some):
                rows.append((p, owner[some].tobytes(), place[some].tobytes()))
        shard = pa.array([key[0].as_py()] * len(rows), pa.int32())
        return pa.table(
            [shard, pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["shard", "pivot", "members", "places"],
        )

    dealt = vectors.withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(post, _FILES)


def _answer(files: dict, ids: np.ndarray, marks: np.ndarray, x: np.ndarray, query: np.ndarray, own: int, order: np.ndarray, prefix: int, k: int, share: float, least: int):
    """The nearest of one shard to one query: ids and distances."""
    gain = np.zeros(len(ids), dtype=np.int32)
    for place, pivot in enumerate(order):
        if pivot in files:
            members, places = files[pivot]
            # A pivot both have counts the difference of its places, one that
            # only one has counts its distance from the end of the prefix.
            gain[members] += np.abs(places - place) - (prefix - place) - (prefix - places)
    most = max(least, int(np.ceil(share * len(ids))), k + 1)
    if most < len(ids):
        edge = np.partition(gain, most - 1)[most - 1]
        below, level = np.flatnonzero(gain < edge), np.flatnonzero(gain == edge)
        # Ids ascend, so ties at the edge go to the smaller ones.
        some = np.concatenate([below, level[: most - len(below)]])
    else:
        some = np.arange(len(ids))
    some = some[marks[some] != own]
    apart = x[some] - query
    distance = np.sqrt((apart * apart).sum(axis=1))
    best = np.lexsort((ids[some], distance))[:k]
    return ids[some][best], distance[best]


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    n_pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = SHARE,
    least: int = LEAST,
    shard_rows: int = SHARD,
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` (Euclidean distance) of each query's nearest.

    ``is_query`` is a condition on ``id``.
    """
    spark = table.sparkSession
    every = written(candidates(table, key, vector), "neighbours-vectors")
    out = "query_id long, query_mark long, id long, score double"
    near = spark.createDataFrame([], out)
    for (width,) in every.select(F.size("vector")).distinct().orderBy(F.size("vector")).collect():
        vectors = every.where(F.size("vector") == width)
        near = near.unionByName(_searched(vectors, is_query, k, n_pivots, prefix, share, least, shard_rows, out))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_mark").orderBy("score", "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _searched(
    vectors: DataFrame, is_query: Column, k: int, n_pivots: int, prefix: int, share: float, least: int, shard_rows: int, out: str
) -> DataFrame:
    """What each shard answers to each query, over vectors of one length."""
    fixed = pivots(vectors, n_pivots)
    width, prefix = fixed.shape[1], min(prefix, len(fixed))
    shards = -(-vectors.count() // shard_rows)
    files = written(index(vectors, fixed, prefix, shards), "neighbours-index")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            own = np.stack([batch.column(n).to_numpy() for n in ("id", "mark")], axis=1) if len(x) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in own], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())], ["members", "places"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, ids, marks, x = None, {}, None, None, None
        for batch in batches:
            asked: list[tuple] = []
            found: list[tuple] = []

            def answer() -> None:
                if not asked:
                    return
                q = np.stack([np.frombuffer(v, np.float64) for _, v in asked])
                for (own, _), one, seq in zip(asked, q, permutations(q, fixed, prefix), strict=True):
                    mine, mark = (int(v) for v in np.frombuffer(own, np.int64))
                    near, apart = _answer(held, ids, marks, x, one, mark, seq, prefix, k, share, least)
                    found.extend((mine, mark, int(i), float(d)) for i, d in zip(near, apart, strict=True))
                asked.clear()

            for now, pivot, members, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != shard:
                    answer()
                    shard, held, ids = now, {}, None
                if pivot == -1:
                    ids, marks = np.frombuffer(members, np.int64).reshape(2, -1)
                    x = np.frombuffer(places, np.float64).reshape(-1, width)
                elif pivot < len(fixed):
                    held[pivot] = np.frombuffer(members, np.int32), np.frombuffer(places, np.int16).astype(np.int32)
                elif ids is not None:
                    asked.append((members, places))
            answer()
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["query_id", "query_mark", "id", "score"]
            )

    # After the files of a shard come the queries, as if they were one more pivot.
    asked = vectors.where(is_query).select("id", "mark", "vector").mapInArrow(pack, "members binary, places binary")
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(len(fixed)).alias("pivot"), "members", "places"
    )
    rows = files.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "pivot")
    return rows.mapInArrow(run, out)
