"""Mixing against a plain sort by place, and its edges."""

import hashlib
import math
import random
import re

import pytest

from freshet.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, place int"


def plain(rows):
    """Targets by repeated resharing, then each source's documents in the order of place."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r[2]) for r in rows if r[1] == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = float(sum(total.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * total[s]]
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            open_.remove(s)
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
    out = []
    for s in names:
        own = [(int(hashlib.md5(f"{'' if r[0] is None else r[0]}\n{r[2] or ''}".encode()).hexdigest()[:15], 16), r) for r in rows if r[1] == s]
        rounds = math.floor(target[s] / total[s] + 1e-12) if total[s] else 0
        lacks = target[s] - rounds * total[s]
        upto = 0
        for place in sorted({p for p, _ in own}):
            same = [r for p, r in own if p == place]
            one = size(same[0][2])
            # Rows of one place are alike: as many of them as come nearest.
            k = min(len(same), max(0, math.ceil((lacks - upto) / one - 0.5))) if one and upto < lacks else 0
            k = len(same) if upto + one * len(same) <= lacks else k
            out += [(r[0], one, total[s], round(target[s], 6), rounds + (n < k)) for n, r in enumerate(same)]
            upto += one * len(same)
    return out


def documents(seed):
    draw = random.Random(seed)
    rows = []
    for k in range(700):
        source = draw.choice(["hot"] * 5 + ["a", "b", "ä", "", None, "tiny"] + (["z"] if k < 40 else []))
        n = 2 if source == "tiny" else draw.choice([0, 1, 30, 200])
        rows.append((k, source, draw.choice([None, ""]) if n == 0 else "wörd\t" * n, "x", 7))
    return rows + [(5000, "only", "one " * 3, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_matches_sorting(spark, seed):
    rows = documents(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = [(r["id"], r["size"], r["source_size"], round(r["target"], 6), r["copies"]) for r in mixing.taken(docs).collect()]
    key = lambda r: (r[0], r[1])
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == {r[0]: r[4] for r in got if r[4]}


def test_words_taken_come_near_each_target(spark):
    rows = [(k, f"s{k % 4}", "w " * (k % 50 + 1)) for k in range(2000)]
    got = mixing.taken(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for s in range(4):
        own = [r for r in got if r["id"] % 4 == s]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 50


@pytest.mark.parametrize("tasks", [1, 7])
def test_some_of_many_equal_rows_are_taken(spark, tasks):
    rows = [(1, "a", "p q r s")] * 1000 + [(2, "b", "w " * 20)] * 100 + [(None, None, "n n")] * 3 + [(3, "c", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(tasks)
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r["id"] or 0, r["copies"]) for r in got if r["size"]) == sorted((w[0] or 0, w[4]) for w in plain(rows) if w[1])
    for source, one in (("a", 4), ("b", 20)):
        own = [r for r in got if r["id"] == {"a": 1, "b": 2}[source]]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= one / 2
    mixed = mixing.mix(docs).groupBy("doc_id").count().collect()
    times = {}
    for r in got:
        times[r["id"]] = times.get(r["id"], 0) + r["copies"]
    assert {r["doc_id"]: r["count"] for r in mixed} == {k: n for k, n in times.items() if n}


def test_long_texts_and_clashing_columns(spark):
    rows = [(k, "s", "w " * (300_000 if k == 1 else 10), 1, "x") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int, edge string")
    assert {r["id"]: r["size"] for r in mixing.taken(docs).collect()}[1] == 300_000
    assert mixing.mix(docs).columns == docs.columns


def test_no_words_and_no_rows(spark):
    rows = [(1, "a", None), (2, "b", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert [(r["target"], r["copies"] * r["size"]) for r in mixing.taken(docs).collect()] == [(0.0, 0)] * 2
    assert mixing.taken(docs.where("doc_id > 5")).count() == 0
    assert mixing.mix(docs.where("doc_id > 5")).count() == 0
