"""The model against one kept in dictionaries, and its edges."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import katz

SCHEMA = "doc_id long, text string, train string, score int"


class Plain:
    """Katz back-off of any order with dictionaries; grams are tuples, a history has as many words as there are."""

    def __init__(self, texts, order=3):
        self.order = order
        self.counts = [Counter() for _ in range(order)]
        for text in texts:
            tokens = self.tokens(text)
            for k in range(1, len(tokens)):
                for size in range(1, min(order, k + 1) + 1):
                    self.counts[size - 1][tuple(tokens[k - size + 1 : k + 1])] += 1
        self.c = Counter({g[0]: r for g, r in self.counts[0].items()})
        self.n = sum(self.c.values())
        self.d = [katz.discounts(self.seen(x)) for x in self.counts]
        lost = 1 - sum(self.cut(1, r) for r in self.c.values()) / self.n if self.n else 1
        self.unknown = max(lost, 1 / (self.n + 1))
        self.fill = (1 - self.unknown) / (1 - lost) if self.n else 0
        self.scale, self.alpha, self.total = {}, {}, Counter()
        for size in range(2, order + 1):
            kept, below = Counter(), Counter()
            for g, r in self.counts[size - 1].items():
                self.total[g[:-1]] += r
                kept[g[:-1]] += self.cut(size, r)
                below[g[:-1]] += self.after(g[1:-1], g[-1])
            for h in kept:
                aside = max(1 - kept[h] / self.total[h], 1 / (self.total[h] + 1))
                self.scale[h], self.alpha[h] = (1 - aside) / kept[h], aside / (1 - below[h])

    @staticmethod
    def tokens(text):
        return [b"", *(text or "").encode().lower().split(), b""]

    @staticmethod
    def seen(counts):
        of = Counter(counts.values())
        return [of[r] for r in range(1, katz.K + 2)]

    def cut(self, size, r):
        return r * (self.d[size - 1][r - 1] if r <= katz.K else 1.0)

    def after(self, h, w):
        """P(w | h); of the class of unknown words where w is one."""
        if not h:
            if not self.n:
                return 1.0
            return self.cut(1, self.c[w]) / self.n * self.fill if self.c[w] else self.unknown
        if r := self.counts[len(h)][(*h, w)]:
            return self.cut(len(h) + 1, r) * self.scale[h]
        return self.alpha.get(h, 1.0) * self.after(h[1:], w)

    def score(self, text):
        t = self.tokens(text)
        return sum(math.log10(self.after(tuple(t[max(0, k - self.order + 1) : k]), t[k])) for k in range(1, len(t)))


def texts():
    draw = random.Random(12)
    vocabulary = [f"W{k}" for k in range(400)] + ["é", "É", "a\x1fb", "x y"]
    skew = [1 / (k + 1) for k in range(len(vocabulary))]
    out = [" ".join(draw.choices(vocabulary, skew, k=draw.randint(1, 90))) for _ in range(160)]
    return [None, "", "\t \n", "never seen words", *out, *out[:20], "the the " * 20_000]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("sizes", [{}, {"block": 700, "words_asked": 60, "grams_asked": 300, "salt": 40}])
def test_scores_match_dictionaries(spark, sizes, order):
    rows = [(k, t, "x", 1) for k, t in enumerate(texts())]
    model = Plain([r[1] for r in rows if r[0] % 5], order)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found, unigrams = katz.score(docs, F.col("doc_id") % 5 != 0, order=order, **sizes)
    got = {r["id"]: r for r in found.collect()}
    assert len(got) == len(rows)
    assert (unigrams.tokens, unigrams.distinct) == (model.n, len(model.c))
    for doc_id, text, _, _ in rows:
        r, tokens = got[doc_id], model.tokens(text)[1:]
        assert r["train"] == (doc_id % 5 != 0)
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(model.c[w] > 0 for w in tokens))
        base = sum(math.log10((model.c[w] + 1) / (model.n + len(model.c) + 1)) for w in tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model.score(text), rel=1e-9)


def test_probabilities_sum_to_one():
    for seed in range(4):
        draw = random.Random(seed)
        model = Plain([" ".join(draw.choices("abcdefghij", [9, 8, 7, 5, 3, 2, 1, 1, 1, 1], k=draw.randint(1, 30))) for _ in range(seed * 30 + 2)])
        for h in [(), *model.alpha]:
            unknown = model.after(h, None)
            assert sum(model.after(h, w) for w in model.c) + unknown == pytest.approx(1, abs=1e-12)


def test_good_turing_discounts():
    found = katz.discounts([1000, 333, 167, 100, 67, 48])
    assert all(0 < d <= 1 for d in found) and found == sorted(found)
    common = 6 * 48 / 1000
    assert found[0] == pytest.approx((2 * 333 / 1000 - common) / (1 - common))
    # Counts of counts that the formula can't be used with.
    assert katz.discounts([5, 0, 0, 0, 0, 0]) == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]
    assert katz.discounts([0] * 6)[0] == 0.5


def test_packed_numbers():
    for values in ([], [0], [255, 1], [70_000, 3], [1 << 40, 0], list(range(1000))):
        assert katz.unpack(katz.pack(np.array(values, dtype=np.int64))).tolist() == values
    assert katz.unpack(katz.pack(np.array([0.1, -2.5, 1e300]))).tolist() == [0.1, -2.5, 1e300]


def test_missing_ids_repeats_and_no_training_texts(spark):
    rows = [(None, "a b", "", 0), (1, "a b", "", 0), (1, "a b", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found, unigrams = katz.score(docs, F.lit(True))
    got = found.collect()
    assert len(got) == 3 and len({r["score"] for r in got}) == 1 and unigrams.tokens == 9
    found, unigrams = katz.score(docs, F.lit(False))
    got = found.collect()
    assert unigrams.tokens == 0 and all(r["n_known"] == 0 and r["score"] == 0.0 for r in got)
    found, _ = katz.score(docs.where("doc_id > 5"), F.lit(True))
    assert found.count() == 0


class Captured:
    """Stands for a frame, and keeps the function that is applied to its groups."""

    def __getattr__(self, name):
        def call(*given):
            if name == "applyInArrow":
                self.run = given[0]
            return self

        return call


def test_a_block_needs_few_bytes_a_token(spark, monkeypatch):
    draw = random.Random(3)
    weights = [1 / (k + 1) for k in range(20_000)]
    docs = [(k, " ".join(f"w{w}" for w in draw.choices(range(20_000), weights, k=2000)), "", 0) for k in range(300)]
    kept, evaluate = [], katz.evaluate
    monkeypatch.setattr(katz, "evaluate", lambda *given: kept.append(given) or evaluate(*given))
    found, _ = katz.score(spark.createDataFrame(docs, SCHEMA).repartition(2), F.lit(True), block=300_000)
    assert found.count() == 300
    blocks, told, *rest = kept[0]
    held = Captured()
    katz.evaluate(held, held, *rest)
    left = blocks.select("block", "ids", "train", "lengths", "codes", "vocabulary", "tokens").limit(1).toArrow()
    right = told.where(F.col("block") == left["block"][0].as_py()).toArrow()
    tokens = left["tokens"][0].as_py()
    assert tokens > 250_000
    # Blocks know the numbers of pairs.
    assert told.where("level = 2 AND ids IS NOT NULL").count() == 0
    tracemalloc.start()
    try:
        held.run(None, left.drop_columns("tokens"), right)
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 140 * tokens
