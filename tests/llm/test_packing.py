"""Packing against the tokenizer itself, and how full sequences are."""

import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer

from freshet.llm import packing
from freshet.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, length int"


def texts():
    draw = random.Random(8)
    words = ["the", "Thaninble,", "élève's", "we'll", "😀", "<|endoftext|>", "x<|startoftext|>y", "12a", "e\u0301", "ΣΑΣ", "İ", "\u00a0b", "\x1c", "\x85q", "##"]
    out = [None, "", " \n\t", "one"] + [" ".join(draw.choice(words) for _ in range(draw.randint(1, 400))) for _ in range(120)]
    out += ["very long text " * 9_000, "a" * 9_000, "word\x0b\x0c\r\nnext " * 700]
    return out


def check(rows, docs, room):
    encode = Tokenizer.from_file(PATH)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append(r)
    for own in places.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= room
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    total = 0
    for doc_id, text in docs:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        want = [(k, at, len(ids[at : at + room]), zlib.crc32(struct.pack(f"<{len(ids[at : at + room])}I", *ids[at : at + room]))) for k, at in enumerate(range(0, len(ids), room))]
        assert sorted(by_doc[doc_id]) == want
    assert set(by_doc) == {d for d, _ in docs}
    return len(places), total


def test_pieces_are_those_of_the_tokenizer(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(texts())]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(5), PATH).collect()
    used, total = check(got, [(r[0], r[1]) for r in rows], packing.TOKENS)
    assert used <= -(-total // packing.TOKENS) + 1


def test_every_plain_character_is_cut_as_the_tokenizer_does():
    encode, ids = Tokenizer.from_file(PATH), packing.Ids(PATH)
    plain = [chr(c) for c in range(0x21, 0x250)]
    parts = [f"a{c}" for c in plain] + [f"{c}9{c}s'{c}" for c in plain] + [f"Don't{c}WE'LL''s" for c in plain]
    draw = random.Random(1)
    parts += ["".join(draw.choices([*"abcXYZ019'-_.,<|>!", "é", "ß", "Ñ", "Ä", "l", "s", "¿", "ª", "µ"], k=draw.randint(1, 12))) for _ in range(5000)]
    for part in parts:
        want = encode.encode(part, add_special_tokens=False).ids
        assert ids[part.encode()] == struct.pack(f"<{len(want)}I", *want), part


@pytest.mark.parametrize("run", [100_000, 60])
def test_rounds_of_the_tree_lose_nothing(spark, monkeypatch, run):
    monkeypatch.setattr(packing, "RUN", run)
    draw = random.Random(3)
    rows = [(k, "a " * draw.choice([1, 5, 20, 29, 31, 45, 63, 64, 100]), "", 0) for k in range(900)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(9), PATH, room=64).collect()
    used, total = check(got, [(r[0], r[1]) for r in rows], 64)
    assert used <= 1.12 * total / 64


def test_tree_ends_where_no_bin_can_merge(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 40)
    draw = random.Random(5)
    rows = [(k, "a " * draw.randint(1, 40), "", 0) for k in range(1500)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(12), PATH, room=64).collect()
    used, total = check(got, [(r[0], r[1]) for r in rows], 64)
    assert used <= 1.02 * total / 64


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_gets_its_own_ids(name):
    path = tokenizer(name)
    encode, ids = Tokenizer.from_file(path), packing.Ids(path)
    assert ids.by_parts == (name == "word_bpe_49k.json")
    for text in texts():
        want = encode.encode(text or "", add_special_tokens=False).ids
        assert ids.of(None if text is None else text.encode()) == struct.pack(f"<{len(want)}I", *want), (text or "")[:50]


def test_best_fit_takes_the_tightest_bin():
    found = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(sorted(b) for b in found) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit([], 5) == [] and packing.best_fit([5, 5], 5) == [[0], [1]]


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0)] * 3 + [(None, "c", "", 0)], SCHEMA)
    got = packing.pack(docs, PATH).collect()
    assert len(got) == 4 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert packing.pack(docs.where("doc_id > 3"), PATH).count() == 0
