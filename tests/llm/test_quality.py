"""The cascade against plain Python, and its edges."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from freshet.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, row int"


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = set()
    for k in range(len(w) - 7):
        if seen[tuple(w[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    rows = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(rows) - len(set(rows)),
        len(covered),
    )


def texts():
    draw = random.Random(7)
    out = [None, "", " \t\n\x0b", "a", "a b c d e f g h", "a " * 9, "ä😀 b c d \x1f e", "x\n\nx\nx \n y\n"]
    out += ["one two three four five six seven eight " * 3, ("w " * 400), "é" * 70_000, "a b c " * 9_000]
    for _ in range(60):
        n = draw.randint(1, 120)
        out.append("".join(draw.choice(["a", "b", "c#", "dé", "|"]) + draw.choice([" ", "\n", "\t ", "  "]) for _ in range(n)))
    return out + out[:12]


def test_measures_match_plain_python(spark):
    rows = [(k, t, "extra", k) for k, t in enumerate(texts())]
    got = quality.measured(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = measures(rows[r["doc_id"]][1])
        assert tuple(r[name] for name in quality.MEASURES) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        if r["base_failed"]:
            assert r["rejected_by"] is not None


def test_the_order_of_rules_changes_no_verdict(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts())], "doc_id long, text string")
    rules = quality.rules(F.col("text"))
    ways = [rules, rules[::-1]]
    a, b = (sorted(docs.where(quality.verdict(w).isNull()).select("doc_id").collect()) for w in ways)
    assert a == b
    kept = quality.cascade(docs.withColumn("row", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted(kept.select("doc_id").collect()) == a


def test_cheap_rules_that_reject_much_come_first(spark):
    docs = spark.createDataFrame([(k, "few words") for k in range(200)], "doc_id long, text string")
    never = quality.Rule("never", F.lit(False))
    few = quality.Rule("few", F.length("text") < 100)
    assert [r.name for r in quality.ordered([never, few], docs)] == ["few", "never"]


def test_two_calls_give_the_same_order(spark):
    dear = quality.Rule("dear", quality.rules(F.col("text"))[1].rejects | (F.length("text") < 100))
    cheap = quality.Rule("cheap", F.length("text") < 100)
    few = spark.createDataFrame([("word " * 400 if k % 2 else "few",) for k in range(300)], "text string")
    never = quality.Rule("never", F.length("text") < 0)
    for _ in range(3):
        assert [r.name for r in quality.ordered([never, dear, cheap], few)] == ["cheap", "dear", "never"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality.measured(none).count() == 0
    assert quality.cascade(none).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    text = quality.measured(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_sample_is_drawn_by_every_task_of_the_scan(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(quality, "written", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or df)
    docs = spark.createDataFrame([(f"text {k}",) for k in range(4_000)], "text string").repartition(8)
    got = quality.sample(docs, rows=1_000)
    assert "Coalesce" not in plans[0] and "RoundRobinPartitioning(2)" in plans[0]
    assert 800 < got.count() < 1_200 and got.rdd.getNumPartitions() == 2
