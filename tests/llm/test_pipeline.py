"""The corpus pipeline stage by stage against plain versions, and its edges."""

import random

import numpy as np
import pytest
from test_mixing import plain as plain_mix
from test_packing import check as check_packing
from test_quality import measures

import __spark_entry__ as entry_point
import corpus_pipeline
from freshet.llm import pii, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def good(text):
    """No rule of the cascade rejects the text."""
    n, chars, symbols, dup, repeated = measures(text)
    text = text or ""
    lines = sum(1 for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r"))
    letters, capitals = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    return not (
        n < 20 or 100 * repeated > 30 * n or 10 * symbols > n or 2 * dup > lines
        or chars > 15 * n or chars < 2 * n or 2 * capitals > letters or 2 * letters < chars
    )


def documents():
    draw = random.Random(21)
    vocabulary = ["".join(draw.choice("abdeimnorstu") for _ in range(draw.randint(2, 8))) for _ in range(700)]
    texts = [None, "", "too few words", "SHOUTED " * 40, "12 34 " * 60, "# $ | a " * 50, "same line here\n" * 30, "w " * 50]
    for _ in range(120):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(25, 200))]
        if draw.random() < 0.3:
            words.insert(5, draw.choice(["ann.b@mail.example.org", "+1 (555) 123-4567", "4111 1111 1111 1111", "10.20.30.40"]))
        texts.append(" ".join(words))
        for _ in range(draw.choice([0, 0, 0, 1, 3])):
            copy = list(words)
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += texts[8:14]
    sources = ["hot", "hot", "hot", "b", None, "ä"]
    return [(k, t, draw.choice(["en", None]), draw.choice(sources), None if k % 7 == 0 else 1) for k, t in enumerate(texts)]


def test_stages_match_plain_versions(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "personal data", "mixing", "packing"]

    def run(name, table):
        return corpus_pipeline.written(stages[name](spark, table, ""), "test")

    clean = run("quality rules", docs)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [r[0] for r in rows if good(r[1])]
    single = run("near duplicates", clean)
    assert single.columns == docs.columns
    left = sorted(clean.collect(), key=lambda r: r["doc_id"])
    want = [left[k]["doc_id"] for k in kept_by_similarity([r["text"] for r in left])]
    assert sorted(r["doc_id"] for r in single.collect()) == want
    assert single.count() < clean.count()
    masked = run("personal data", single)
    before = {r["doc_id"]: r for r in single.collect()}
    for r in masked.collect():
        assert r["text"] == pii.masked(before[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"])
        assert (r["lang"], r["source"]) == (before[r["doc_id"]]["lang"], before[r["doc_id"]]["source"])
        assert not [s for s in pii.spans(r["text"]) if s[1] < 4]
    mixed = run("mixing", masked)
    assert mixed.columns == docs.columns
    want = plain_mix([(r["doc_id"], r["source"], r["text"]) for r in masked.collect()])
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(w[0] for w in want for _ in range(w[4]))
    packed = run("packing", mixed).collect()
    once = {r["doc_id"]: r["text"] for r in mixed.collect()}
    times = {w[0]: w[4] for w in want}
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    assert all(sum(r["doc_id"] == d and r["piece"] == 0 for r in packed) == times[d] for d in once)
    # Pieces of a document's first copy; copies are cut alike.
    seen, first = {}, []
    for r in packed:
        if seen.setdefault((r["doc_id"], r["piece"]), r) is r:
            first.append(r)
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed} == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in first}
    whole = stages["packing"](spark, mixed.dropDuplicates(["doc_id"]), "").collect()
    check_packing(whole, list(once.items()), 2048)


def test_run_applies_all_stages(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 50
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3, [(1, "a", None, None, None)] * 2])
def test_tables_of_which_nothing_stays(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_survive_until_packing(spark):
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    docs = spark.createDataFrame([(1, text, "en", "s", 5, "keep", 7)], SCHEMA + ", row string, size int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns[5:] == ["row", "size"], name
    got = docs.first()
    assert (got["row"], got["size"], got["doc_id"]) == ("keep", 7, 1)


def test_entry_without_the_subpackage(monkeypatch):
    import importlib
    import sys

    for name in ("corpus_pipeline", *[m for m in sys.modules if m.startswith("freshet.llm")]):
        monkeypatch.setitem(sys.modules, name, None)
    again = importlib.reload(entry_point)
    try:
        assert not [n for n in again.queries() if n.startswith("op") or n == "pipeline"] and len(again.queries()) > 50
    finally:
        monkeypatch.undo()
        importlib.reload(entry_point)


def test_every_operator_has_its_query():
    found = entry_point.queries()
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
    assert set(entry_point.oracle_sql()) <= set(found)


def family(count, own, seed=5):
    """Texts over one template of 300 words, in each of which ``own`` words in runs are its own."""
    draw = random.Random(seed)
    template = [f"{draw.choice('abcdefghij')}word{k}" for k in range(300)]
    out = []
    for n in range(count):
        words = list(template)
        at = draw.randrange(300 - own)
        words[at : at + own] = [f"own{n}x{k}" for k in range(own)]
        out.append(" ".join(words))
    return out


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_templates_below_the_similarity_stay(spark):
    # Runs of 45 words of their own: pairs are at about 0.7, near the fingerprints' radius.
    texts = family(60, 45)
    near = family(20, 8, seed=6)
    assert min(alike(a, b) for a in near for b in near) >= 0.8
    rows = [(k, t, None, None, None) for k, t in enumerate(texts + near)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    prints = [int.from_bytes(simhash.fingerprint(t.encode(), 5, 4), "little") for t in texts]
    assert sum((a ^ b).bit_count() <= corpus_pipeline.NEAR["radius"] for a in prints for b in prints) > 60
    want = kept_by_similarity(texts + near)
    assert len(want) > 30
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def kept_by_similarity(texts):
    """Places of the first of each group of texts whose pairs are similar enough."""
    sets = [shingles(t) for t in texts]
    first = list(range(len(texts)))
    for b in range(len(sets)):
        for a in range(b):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((first[a], first[b]))
                first = [low if x == high else x for x in first]
    return sorted(set(first))


def test_near_copies_match_exact_similarity(spark):
    rows = [r for r in documents() if good(r[1])]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [rows[k][0] for k in kept_by_similarity([r[1] for r in rows])]


def test_families_in_parts_match_exact_similarity(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SET_ROWS", 7)
    texts = family(30, 45) + family(15, 8, seed=6)
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_similarity(texts)


@pytest.mark.parametrize("rows", [500, 40_000, 5_000_000])
def test_candidates_hold_nearly_all_pairs_at_the_similarity(rows):
    draw, near = random.Random(4), corpus_pipeline.NEAR
    tables = near["tables"](rows)
    found, pairs = 0, 400
    for n in range(pairs):
        words = [f"v{n}x{k}" for k in range(404)]
        # A run of 40 of 400 shingles replaced, in one of them at the edge: 0.8 to 0.82.
        at = draw.randrange(10, 350)
        other = [*words[:at], *[f"o{n}x{k}" for k in range(36 + 4)], *words[at + 40 :]]
        a, b = " ".join(words), " ".join(other)
        assert 0.78 <= alike(a, b) <= 0.82
        x, y = (simhash.fingerprint(t.encode(), near["shingle"], near["lanes"], repeats=False) for t in (a, b))
        x, y = (np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little") for p in (x, y))
        found += (x != y).sum() <= near["radius"] and any((x[t] == y[t]).all() for t in tables)
    assert found >= 0.97 * pairs


def test_tables_follow_the_number_of_texts():
    some, many = corpus_pipeline.NEAR["tables"](50_000), corpus_pipeline.NEAR["tables"](50_000_000)
    assert len(many[0]) > len(some[0])
    # A thousand times the texts: a row meets a few times as many others, not a thousand times.
    assert len(many) * 50_000_000 / 2 ** len(many[0]) < 20 * len(some) * 50_000 / 2 ** len(some[0])
