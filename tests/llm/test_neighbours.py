"""The permutation index against brute force, and its edges."""

import numpy as np
from pyspark.sql import functions as F

from freshet.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, id string, score int"


def brute(ids, x, own, k):
    apart = np.sqrt(((x - x[ids == own][0]) ** 2).sum(axis=1))
    order = np.lexsort((ids, apart))
    return [(int(ids[o]), float(apart[o])) for o in order if ids[o] != own][:k]


def test_recall_and_exact_scores(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 24)).astype(np.float32)
    rows = [(k, [float(v) for v in x[k]], "a", 1) for k in range(len(x))]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = neighbours.search(table, F.col("id") % 100 == 0, shard_rows=700).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert sorted(found) == list(range(0, 3000, 100))
    hits = 0
    ids, wide = np.arange(3000), x.astype(np.float64)
    for own, near in found.items():
        want = brute(ids, wide, own, 10)
        assert [r for r, _, _ in sorted(near)] == list(range(1, 11))
        assert [s for _, _, s in sorted(near)] == sorted(s for _, _, s in near)
        apart = np.sqrt(((wide - wide[own]) ** 2).sum(axis=1))
        assert all(abs(apart[i] - s) < 1e-12 for _, i, s in near)
        hits += len({i for _, i, _ in near} & {i for i, _ in want})
    assert hits / (10 * len(found)) >= 0.9


def test_ties_repeats_and_unusable_vectors(spark):
    bad = [(100, None), (200, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (300, [1.0, 0.0])] + [(k, [1.0, 1.0]) for k in range(20, 40)] + [(0, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, "", 0) for r in bad + good], SCHEMA)
    got = neighbours.search(table, F.col("id") % 100 == 0, least=2).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert sorted(by) == [0, 300]
    assert sorted(by[0])[0] == (1, 300, 0.0) and [i for _, i, _ in sorted(by[0])][1:] == list(range(20, 29))


def test_rows_of_one_id_and_vectors_of_other_lengths(spark):
    rows = [(100, [0.0, 1.0]), (7, [0.0, 2.0]), (7, [0.0, 4.0]), (7, [0.0, 4.0]), (100, [0.0, 1.5]), (8, [1.0, 2.0, 2.0]), (200, [1.0, 2.0, 4.0]), (9, [5.0])]
    table = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in neighbours.search(table, F.col("id") % 100 == 0, least=2, shard_rows=2).collect())
    first = [(100, 1, 100, 0.5), (100, 2, 7, 1.0), (100, 3, 7, 3.0)]
    second = [(100, 1, 100, 0.5), (100, 2, 7, 0.5), (100, 3, 7, 2.5)]
    # Of equal distances the smaller id comes first.
    second = [(100, 1, 7, 0.5), (100, 2, 100, 0.5), (100, 3, 7, 2.5)]
    assert got == sorted([*first, *second, (200, 1, 8, 2.0)])


def test_the_index_is_shuffled_once(spark):
    draw = np.random.default_rng(3)
    rows = [(k, [float(v) for v in draw.normal(size=8)], "", 0) for k in range(2000)]
    got = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, shard_rows=500)
    assert got.count() == 2000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Queries alone are multiplied: one explode, over the rows made of them.
    assert plan.count("explode") == 1


def test_fewer_candidates_than_wanted_and_empty(spark):
    table = spark.createDataFrame([(100, [1.0, 2.0], "", 0), (101, [1.0, 3.0], "", 0)], SCHEMA)
    got = [tuple(r) for r in neighbours.search(table, F.col("id") % 100 == 0).collect()]
    assert got == [(100, 1, 101, 1.0)]
    none = neighbours.search(table.where("vec_id > 500"), F.col("id") % 100 == 0)
    assert none.columns == ["query_id", "rank", "id", "score"] and none.count() == 0


def test_footrule_from_the_files():
    """What the files sum up is the footrule distance over prefixes, up to a constant."""
    draw = np.random.default_rng(2)
    fixed, x = draw.normal(size=(12, 5)), draw.normal(size=(40, 5))
    prefix = 6
    order = neighbours.permutations(x, fixed, prefix)
    place = np.full((40, 12), prefix)
    np.put_along_axis(place, order, np.arange(prefix)[None, :], axis=1)
    want = np.abs(place - place[0]).sum(axis=1)
    files = {p: (np.flatnonzero(place[:, p] < prefix).astype(np.int32), place[place[:, p] < prefix, p].astype(np.int32)) for p in range(12)}
    gain = np.zeros(40, dtype=int)
    for r, p in enumerate(order[0]):
        members, places = files[p]
        gain[members] += np.abs(places - r) - (prefix - r) - (prefix - places)
    assert len(set(want - gain)) == 1
