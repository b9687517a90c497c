"""Bit-sliced groups against brute force, and their edges."""

import random

import numpy as np
import pytest
import xxhash

from freshet.llm import simhash


def brute_print(text, shingle=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < shingle else [b" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(prints))]


def near_texts(count=220, seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(900)]
    out = [None, "", "  ", "one", "one two", "ONE Two"]
    while len(out) < count:
        base = [draw.choice(vocabulary) for _ in range(draw.randint(1, 160))]
        for _ in range(draw.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            out.append(" ".join(copy))
    return out


def test_groups_match_brute_force(spark):
    texts = near_texts()
    texts.append("long " * 30_000 + "end")
    ids = random.Random(1).sample(range(10_000), len(texts))
    rows = [(i, t, "fp", b"x") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, fp binary").repartition(7)
    prints = [brute_print(t) for t in texts]
    roots = brute_components(prints, 4)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    want = {i: (p, least[r]) for i, p, r in zip(ids, prints, roots, strict=True)}
    got = {r["id"]: (int.from_bytes(r["fp"], "little"), r["component"]) for r in simhash.groups(docs).collect()}
    assert got == want
    assert len({v[1] for v in want.values()}) < len(set(prints)) - 10
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


@pytest.mark.parametrize(("bits", "radius"), [(64, 4), (64, 0), (256, 38), (128, 63)])
def test_bit_sliced_distances(bits, radius):
    draw = np.random.default_rng(5)
    rows = draw.integers(0, 256, (300, bits // 8), dtype=np.uint8)
    rows[150:] = rows[:150]
    for k in range(150, 300):
        for bit in draw.choice(bits, draw.integers(0, min(bits, 2 * radius + 3)), replace=False):
            rows[k, bit // 8] ^= 1 << (bit % 8)
    cells = np.sort(draw.integers(0, 3, 300))
    a, b = simhash.forest(rows, cells, radius)
    plain = [int.from_bytes(x.tobytes(), "little") for x in rows]
    want = {}
    for c in range(3):
        at = np.flatnonzero(cells == c)
        for k, r in zip(at, brute_components([plain[x] for x in at], radius), strict=True):
            want[k] = at[r]
    got = {k: k for k in range(300)} | dict(zip(a, b, strict=True))
    classes = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert classes(got) == classes(want)


def test_crowded_buckets_are_split_without_losing_links(spark):
    draw = random.Random(9)
    base = draw.getrandbits(64)
    prints = {base}
    while len(prints) < 400:
        p = draw.choice(sorted(prints)[:50]) ^ (1 << draw.randrange(64))
        prints.add(p)
    rows = [(bytearray(p.to_bytes(8, "little")),) for p in prints]
    nodes = spark.createDataFrame(rows, "fp binary")
    edges = simhash.links(nodes, 4, simhash.exact_tables(64, 4, 6), part=16)
    roots = {bytes(r["node"]): bytes(r["root"]) for r in simhash.components(edges).collect()}
    assert len(set(roots.values())) == 1 and len(roots) == len(prints) - 1


def test_repeated_rows_and_missing_ids(spark):
    long = " ".join(f"v{k}" for k in range(60))
    rows = [(5, long), (5, long), (5, "else where"), (None, long), (None, "alone here"), (None, "alone here"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.groups(docs).collect()
    assert len(got) == len(rows)
    assert {r["component"] for r in got if bytes(r["fp"]) == simhash.fingerprint(long.encode(), 4)} == {5}
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.representatives(docs).collect()), key=repr)
    assert kept == sorted([(5, long), (5, "else where"), (None, "alone here"), (9, None)], key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(none).count() == 0
    assert simhash.representatives(none).count() == 0


def test_similar_texts_meet_at_production_settings(spark):
    from corpus_pipeline import NEAR

    draw = random.Random(2)
    rows, pairs = [], 60
    for k in range(pairs):
        words = [f"t{draw.randrange(5000)}" for _ in range(300)]
        rows.append((2 * k, " ".join(words)))
        for _ in range(3):
            words[draw.randrange(300)] = "changed"
        rows.append((2 * k + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.representatives(docs, **NEAR).collect()}
    assert all(2 * k in kept for k in range(pairs))
    assert sum(2 * k + 1 in kept for k in range(pairs)) <= 3


def test_repeats_vote_only_where_wanted():
    draw = random.Random(8)
    line = [f"line{k}" for k in range(12)]

    def long(n):
        """5,000 words, a fifth of them one line."""
        runs = [[f"t{n}x{draw.randrange(10**9)}" for _ in range(48)] + line for _ in range(83)]
        return " ".join(w for run in runs for w in run).encode()

    def apart(a, b):
        return (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()

    texts = [long(n) for n in range(8)]
    pairs = [(a, b) for a in range(8) for b in range(a)]
    voted = [simhash.fingerprint(t, 5, 4) for t in texts]
    once = [simhash.fingerprint(t, 5, 4, repeats=False) for t in texts]
    assert sum(apart(voted[a], voted[b]) <= 62 for a, b in pairs) > len(pairs) / 2
    assert min(apart(once[a], once[b]) for a, b in pairs) > 80


def test_components_with_heavy_nodes(spark, monkeypatch):
    """Stars of which some are heavy, chains between them, and lone links."""
    draw = random.Random(9)
    edges = [(0, k) for k in range(1, 400)] + [(500, k) for k in range(501, 700)] + [(k, k + 1) for k in range(800, 860)]
    edges += [(3, 500), (860, 690)] + [(1000 + 2 * k, 1001 + 2 * k) for k in range(60)]
    edges += [(draw.randint(2000, 2300), draw.randint(2000, 2300)) for _ in range(250)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for pair in edges for x in pair if pair[0] != pair[1]}
    for share in (1_000, 3):
        monkeypatch.setattr(simhash, "HEAVY_SHARE", share)
        rows = [(a.to_bytes(4, "big"), b.to_bytes(4, "big")) for a, b in edges]
        got = simhash.components(spark.createDataFrame(rows, "u binary, v binary")).collect()
        found = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in got}
        assert found == {x: r for x, r in want.items() if x != r}
