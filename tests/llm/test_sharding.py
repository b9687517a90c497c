"""Shards against an exhaustive search over ordered groups."""

import hashlib
import random
import zlib

import pytest

from freshet.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard int"


def least(sizes, shards):
    """The smallest capacity by dynamic programming."""
    sums = [0]
    for s in sizes:
        sums.append(sums[-1] + s)
    best = list(sums)
    for _ in range(shards - 1):
        best = [min((max(best[j], sums[k] - sums[j]) for j in range(k + 1)), default=0) for k in range(len(sums))]
    return best[-1]


def test_binary_search_finds_the_least_capacity():
    draw = random.Random(6)
    for _ in range(300):
        sizes = [draw.choice([1, 2, 9, 40]) for _ in range(draw.randint(0, 25))]
        shards = draw.randint(1, 8)
        capacity = sharding.least_capacity(sizes, shards)
        assert capacity == least(sizes, shards)
        assert len(sharding.cuts(sizes, capacity)) < shards


def group_sizes(rows):
    by_place = {}
    for r in rows:
        place = int(hashlib.md5((r[1] or "").encode()).hexdigest()[:15], 16)
        by_place[place] = by_place.get(place, 0) + len((r[1] or "").encode()) + 1
    return [by_place[p] for p in sorted(by_place)]


@pytest.mark.parametrize(("seed", "first", "shards"), [(1, 12, 8), (2, 4, 8), (3, 4, 3), (4, 4, 20)])
def test_shards_are_minimax(spark, monkeypatch, seed, first, shards):
    monkeypatch.setattr(sharding, "FIRST_BITS", first)
    monkeypatch.setattr(sharding, "CELL", 100)
    draw = random.Random(seed)
    some = ["copy " * 20, None, "", "ä" * 300]
    rows = [(k, draw.choice(some) if draw.random() < 0.35 else f"t{draw.random()}" * draw.choice([1, 4, 40]), "x", 9) for k in range(900)]
    rows += [(1, "same id", "", 0)] * 2
    got = sharding.shard(spark.createDataFrame(rows, SCHEMA).repartition(6), shards).collect()
    assert len(got) == len(rows)
    held, slots, texts = {}, {}, {}
    for r in got:
        held[r["shard"]] = held.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        texts.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert max(held) < shards
    assert max(held.values()) == least(group_sizes(rows), shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in texts.values())
    want = sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r["id"], r["size"], r["text_crc32"]) for r in got) == want


def test_one_group_larger_than_a_shard(spark):
    rows = [(k, "hot " * 50, "", 0) for k in range(50)] + [(100 + k, f"text {k}", "", 0) for k in range(100)]
    got = sharding.shard(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r["shard"] for r in got if r["id"] < 100}) == 1
    assert len(got) == 150


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0
