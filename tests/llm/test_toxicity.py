"""The grammar clause by clause, and held-out accuracy on the given labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import toxicity
from freshet.llm.queries import QUERIES

LEXICON = {"idiot": 4.0, "lowei*": 3.0, "tra*": 1.0, "trash": 5.0}


def hits(clause):
    return toxicity.Scorer(LEXICON).clause(clause)


def test_insults_weigh_by_clause():
    assert hits("the idiot sat") == [4.0]
    assert hits("you are an idiot") == [4.0 + toxicity.AIMED]
    assert hits("not an idiot at all") == [4.0 + toxicity.NEGATED]
    assert hits("never in all my long life an idiot") == [4.0]
    assert hits("somebody said idiot") == [4.0 + toxicity.QUOTED]
    assert hits("somebody said you are not an idiot") == [4.0 + toxicity.QUOTED + toxicity.AIMED + toxicity.NEGATED]
    assert hits("idiots and idiotic") == []


def test_threats_need_a_target_nearby():
    assert hits("i will kill you") == [toxicity.THREAT]
    assert hits("you will die") == [toxicity.THREAT + toxicity.AIMED]
    assert hits("kill the process with care and only then ask for you") == []
    assert hits("kill time") == []


def test_words_known_by_their_beginning():
    assert toxicity.patterns("trashy") == ["trashy", "tra*", "tras*", "trash*"]
    assert hits("ein loweistra") == [3.0]
    assert hits("trash") == [5.0] and hits("tractor") == [1.0] and hits("xtrash") == []


def test_composition_is_the_cascade_of_its_parts():
    parts = [toxicity.insults(), toxicity.threats(), toxicity.targets(), toxicity.negation(), toxicity.reported_speech()]
    whole = toxicity.grammar()
    draw = random.Random(5)
    for _ in range(500):
        state, states = 0, [0] * len(parts)
        for _ in range(12):
            symbol = draw.choice(toxicity.SYMBOLS[:-1])
            state, out, weight = whole.arcs[state, symbol]
            total = 0.0
            for k, part in enumerate(parts):
                states[k], symbol, w = part.arcs[states[k], symbol]
                total += w
            assert (out, weight) == (symbol, total)


def test_only_clauses_with_lexicon_words_are_read():
    scorer = toxicity.Scorer(LEXICON)
    text = "Nothing here. You idiot! not so; said\nan Idiot, idiot"
    best, total, count = scorer.features(text)
    assert best == 8.0 and count == pytest.approx(np.log1p(3)) and total == pytest.approx(np.log1p(4.5 + 8.0))
    assert scorer.features(None) == scorer.features("") == scorer.features("no such word " * 1000) == (0.0, 0.0, 0.0)
    assert scorer.features("word " * 200_000 + "idiot")[0] == 4.0


def test_the_curve_separates_and_survives_few_labels():
    x = np.array([[0.0, 0, 0]] * 50 + [[9.0, 2, 1]] * 10)
    y = np.array([0.0] * 50 + [1.0] * 10)
    w = toxicity.fit(x, y)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert p[:50].max() < 0.1 and p[50:].min() > 0.8
    assert np.isfinite(toxicity.fit(np.zeros((0, 3)), np.zeros(0))).all()
    assert np.isfinite(toxicity.fit(x[:5], y[:5])).all()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op2_toxicity"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    right = {t: [r["predicted"] == t for r in got if r["toxic"] == t] for t in (0, 1)}
    assert sum(right[1]) / len(right[1]) > 0.75
    assert sum(right[0]) / len(right[0]) > 0.98


def test_edges(spark):
    bad = [f"w{k} you idiot w{k}" for k in range(60)]
    rows = [(k, t, "s") for k, t in enumerate(bad)] + [(100 + k, f"w{k} fine v{k}", "s") for k in range(300)]
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "you idiot", "s"), (5, "w5 you idiot w5", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = [(k, int(k < 60), 1.0) for k in [*range(60), *range(100, 400)]] + [(5, 0, 1.0), (None, 1, 1.0), (7, None, 1.0), (2000, 1, 1.0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text double")
    got = toxicity.score(docs, labels, F.lit(True)).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r["score"] for r in got}
    assert by[None] > 0.5 and by[5] > 0.5 and by[1000] == by[1001] < 0.1
    none = toxicity.score(docs, labels.where("doc_id > 9000"), F.lit(True)).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert toxicity.score(docs.where("doc_id > 9000"), labels, F.lit(True)).count() == 0


def sample(spark, texts):
    """Texts with labels as ``labelled`` gives them."""
    rows = [(k, t, mark) for k, (t, mark) in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, text string, toxic int").repartition(3)


def test_words_beside_insults_are_learned(spark):
    """Negations, reports and targets of no language that is listed."""
    lexicon = {"idiot": 4.0}
    bad = [(f"vosk b{k} idiot. plain p{k}", 1) for k in range(60)] + [(f"idiot c{k}", 1) for k in range(20)]
    good = [(f"nolo idiot d{k}", 0) for k in range(60)] + [(f"relatu m n o p{k % 9} idiot", 0) for k in range(60)]
    symbols = toxicity.contexts(sample(spark, bad + good), lexicon)
    assert (symbols["nolo"], symbols["relatu"], symbols["vosk"]) == ("negation", "reported", "target")
    assert "plain" not in symbols and symbols["not"] == "negation"
    learned, plain = toxicity.Scorer(lexicon, symbols), toxicity.Scorer(lexicon)
    assert plain.clause("nolo idiot") == [4.0] and learned.clause("nolo idiot") == [4.0 + toxicity.NEGATED]
    assert learned.clause("relatu uu vv ww xx idiot") == [4.0 + toxicity.QUOTED]
    assert learned.clause("vosk the idiot") == [4.0 + toxicity.AIMED]


def test_threats_that_clean_texts_use_are_dropped(spark):
    texts = [(f"die frau ist er {k}", 0) for k in range(200)] + [(f"i kill you {k}", 1) for k in range(20)] + [("kill the lights", 0)]
    symbols = toxicity.contexts(sample(spark, texts), {"idiot": 4.0})
    assert "die" not in symbols and symbols["kill"] == "threat"
    assert toxicity.Scorer({}, symbols).features("die frau ist er")[2] == 0
    assert toxicity.Scorer({}, symbols).features("i kill you")[2] > 0


def test_beginnings_need_evidence_of_their_own(spark):
    bad = [(f"trash u{k} w{k}", 1) for k in range(80)] + [(f"lowei{chr(97 + k % 26)}{chr(97 + k // 26)} v{k}", 1) for k in range(80)]
    good = [(f"calm x{k} y{k}", 0) for k in range(400)]
    lexicon = toxicity.learn(sample(spark, bad + good))
    assert "trash" in lexicon and "lowei*" in lexicon
    # All that speaks for this beginning is one whole word.
    assert not [p for p in lexicon if p.endswith("*") and "trash".startswith(p.rstrip("*"))]


def test_a_repeated_id_brings_one_text(spark):
    docs = spark.createDataFrame([(1, f"t{k}") for k in range(500)] + [(2, "b"), (2, None), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    got = toxicity.labelled(docs, labels, F.lit(True), "doc_id", "text", "toxic", 100).collect()
    assert sorted(tuple(r) for r in got) == [(1, "t0", 1), (2, "b", 0), (3, None, 1)]


def test_transducers_change_scores_of_given_texts(spark):
    """With a transducer left out, clauses of the given texts weigh something else."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    known = toxicity.labelled(docs, labels, F.lit(True), "doc_id", "text", "toxic", 5_000)
    lexicon = toxicity.learn(known)
    symbols = toxicity.contexts(known, lexicon)
    assert "die" not in symbols
    scorer = toxicity.Scorer(lexicon, symbols)
    texts = [r["text"] for r in docs.select("text").collect()]
    clauses = [c for t in texts for c in scorer.clauses(t)]
    whole = [scorer.clause(c) for c in clauses]
    parts = {"insult": toxicity.insults, "target": toxicity.targets, "negation": toxicity.negation}
    for name in parts:
        mute = toxicity.Scorer(lexicon, {w: x for w, x in symbols.items() if x != name})
        if name == "insult":
            mute = toxicity.Scorer({}, symbols)
        changed = sum(mute.clause(c) != own for c, own in zip(clauses, whole, strict=True))
        assert changed > 0, name
