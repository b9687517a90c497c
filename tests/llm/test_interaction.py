"""Filter interaction against applying the filters one after the other, and edges."""

import random
import re
from itertools import permutations

from freshet.llm import interaction

DOCS = "doc_id long, text string, lang string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int, part string"


def failing(rows):
    """The filters each row fails, straight from their definitions."""
    out = []
    for doc, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        if len(words) < 200:
            own.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            own.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            own.add("C")
        if any(c in "#$%&*|" for c in text):
            own.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, *_ in rows):
            own.add("E")
        out.append(own)
    return out


def plain(rows, labels):
    fails = failing(rows)
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    out = []
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        steps, share = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = list(own), []
            for k, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in gone)
                left, gone = [x for x in left if f not in x[1]], gone + removed
                share[f] += len(removed)
                steps.append(("".join(order), k, f, len(left), len(removed), redundant, sum(x[1] == {f} for x in own), sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed)))
        out += [(part, o, k, *rest, share[f]) for o, k, f, *rest in steps]
    return sorted(out)


def documents(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(60):
        words = draw.choices(vocabulary[: draw.choice([20, 400])], k=draw.choice([50, 199, 200, 260]))
        if draw.random() < 0.3:
            words = [w.upper() for w in words]
        if draw.random() < 0.3:
            words[3] = draw.choice("#$%&*|")
        texts.append(draw.choice([" ", "\t", "\n"]).join(words))
    texts += [None, "", " ", "é" * 30, "word " * 100_000]
    rows = [(k, t, draw.choice(["en", "de", "", None]), 1, "x") for k, t in enumerate(texts)]
    for _ in range(90):
        rows.append((draw.choice([*range(40, 90), None]), draw.choice(texts[:12] + [None, ""]), draw.choice(["en", "de", None]), None, None))
    rows += rows[:10] + [(7, texts[0], "en", 1, "x")] * 5
    labels = [(draw.choice([*range(90), None]), draw.choice([0, 1, None]), draw.choice([0, 1, None]), "p") for _ in range(70)]
    return rows, labels


def test_audit_matches_filters_one_after_the_other(spark):
    for seed in (1, 2):
        rows, labels = documents(seed)
        got = interaction.audit(spark.createDataFrame(rows, DOCS).repartition(6), spark.createDataFrame(labels, LABELS).repartition(3))
        assert got.columns == ["part", "filter_order", "step", *interaction.MEASURES, "shapley"]
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, labels)


def test_fields_hold_more_rows_than_a_table_can():
    rows = (1 << 62) - 1
    for mask in range(32):
        sums = interaction.total(iter([(mask, True, False, rows), (mask, False, True, rows // 2)]))
        for name, value in sums.items():
            fields = interaction.unpacked(value)
            n = {"good_lost": rows, "toxic_lost": rows // 2}.get(name, rows + rows // 2)
            assert set(fields.tolist()) <= {0, n} and len(fields) == 600
        kept, removed = interaction.unpacked(sums["kept"]).reshape(120, 5), interaction.unpacked(sums["removed"]).reshape(120, 5)
        assert (kept[:, 4] + removed.sum(axis=1) == rows + rows // 2).all()


def test_a_dominating_text_and_empty_tables(spark):
    rows = [(k, "same text", "en", None, None) for k in range(4000)] + [(k, f"own {k}", "fr", None, None) for k in range(5000, 5100)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    none = spark.createDataFrame([], LABELS)
    got = {(r["part"], r["filter_order"], r["step"]): r for r in interaction.audit(docs, none).collect()}
    assert len(got) == 1200
    assert got["en", "EABCD", 1]["removed"] == 3999 and got["en", "ABCDE", 5]["redundant"] == 3999
    assert got["fr", "EABCD", 1]["removed"] == 0 and got["fr", "ABCDE", 1]["unique_fails"] == 100
    assert interaction.audit(docs.where("doc_id < 0"), none).count() == 0
