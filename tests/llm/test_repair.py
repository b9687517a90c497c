"""Alignment against an exhaustive search, segments against whole conversations, and edges."""

import hashlib
import random
import re
import time

import pytest

from freshet.llm import repair
from freshet.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part string, seg int"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def exhaustive(initials, forced, broken, limit):
    """The least (cost, audit) of all edit sequences up to a cost."""
    best = (limit + 1, "")

    def go(i, told, audit, cost):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(initials) and GRAMMAR.fullmatch(told):
            best = min(best, (cost, audit))
        if i < len(initials):
            go(i + 1, told, audit + "D", cost + 2)
            if not forced[i]:
                stay = 5 * broken[i]
                if initials[i]:
                    go(i + 1, told + initials[i], audit + "K", cost + stay)
                for other in "ua":
                    if other != initials[i]:
                        go(i + 1, told + other, audit + "R", cost + stay + 1)
        if not audit.endswith("III"):
            for other in "ua":
                go(i, told + other, audit + "I", cost + 5)

    go(0, "", "", 0)
    return best


def whole(initials, forced, broken):
    ways = repair.Segment(initials, forced, broken).ways((repair.START,), repair.ACCEPTING)
    return min((cost, audit) for _, _, cost, audit in ways)


def made(draw, n):
    initials = draw.choices(["s", "u", "a", "x", ""], [2, 8, 8, 1, 1], k=n)
    return initials, [draw.random() < 0.2 for _ in range(n)], [draw.random() < 0.2 for _ in range(n)]


def test_alignment_matches_exhaustive_search():
    draw = random.Random(2)
    for n in (0, 1, 2, 3, 4, 5, 6):
        for _ in range(1 if n == 0 else 120):
            turns = made(draw, n)
            assert whole(*turns) == exhaustive(*turns, 2 * n), turns


def test_a_band_never_hides_the_best():
    """With no band at all the same costs and audits come out."""
    draw = random.Random(3)
    for _ in range(200):
        turns = made(draw, draw.randint(1, 14))
        segment = repair.Segment(*turns)
        wide = repair.Segment(*turns)
        wide.incumbent = lambda state, last: 200
        states = (0, 1, 2, 3)
        assert segment.ways(states, states) == wide.ways(states, states)


def described(turns, conv=1, whole=False, size=3):
    rows = [(k, role, "", fault) for k, (role, fault) in enumerate(turns)]
    return [repair._described(conv, 0, k, rows[at : at + size], whole) for k, at in enumerate(range(0, len(rows), size))]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_folded_segments_match_whole_conversations(size):
    draw = random.Random(size)
    for _ in range(150):
        n = draw.randint(1, 25)
        turns = [(draw.choice(["system", "user", "user", "assistant", "assistant", "tool"]), draw.choice([None] * 6 + ["blank", "duplicate", "truncated", "truncated"])) for _ in range(n)]
        fold = repair.Fold()
        for row in described(turns, size=size):
            fold.add(row)
        shares = fold.shares(1)
        totals = shares[0]["totals"]
        want = whole([r[0] for r, _ in turns], [f in ("blank", "duplicate") for _, f in turns], [f == "truncated" for _, f in turns])
        assert (totals["cost"], totals["audit"]) == want
        assert "".join(s["share"] for s in reversed(shares)) == want[1]
        assert totals["illegal"] == sum(a[0][0] + b[0][0] not in repair.LEGAL for a, b in zip(turns, turns[1:]))


def plain(rows):
    """Counters, audit and digest of one conversation's (turn, role, text), with nothing cut or spread."""
    low = -(1 << 62)
    rows = sorted(((low if t is None else t, r or (" " if r is None else ""), " " if x is None else x) for t, r, x in rows))
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else None if last[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = whole(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
    numbers = {t for t, *_ in rows if t != low}
    kept, i = [], 0
    size = len(audit.replace("D", ""))
    for edit in audit:
        if edit != "D":
            role = "user" if (size - len(kept)) % 2 == 0 else "assistant"
            kept.append((rows[i][1] if edit == "K" else role) + ":" + ("" if edit == "I" else rows[i][2]))
        i += edit != "I"
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    )


def conversations(seed):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(40), None]:
        for k in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "system", "tool", "", None]) if draw.random() < 0.4 else ["user", "assistant"][k % 2]
            text = draw.choice(["Yes.", "No!", "well", "", " \t", None, "Ä?\n", f"own {k}."])
            rows.append((conv, draw.choice([k, k, k, 3 * k, None]), role, text, "x", 7))
    for k in range(900):
        rows.append((99, k // 2, draw.choice(["user", "assistant"]), draw.choice([f"t{k}.", f"t{k}.", f"t{k}", "same."]), None, None))
    rows += [(98, 1, "user", "equal."), (98, 1, "user", "equal."), (98, 1, "user", "equal."), (97, 5, "assistant", "word " * 300_000 + ".")]
    return [(*r, None, None)[:6] for r in rows]


@pytest.mark.parametrize("most", [4, repair.SEGMENT])
def test_spread_over_tasks_matches_plain(spark, most):
    rows = conversations(most)
    draw = random.Random(1)
    draw.shuffle(rows)
    audits, turns = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(7), most=most)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(turns).collect()}
    got = {r["conv_id"]: tuple(r)[1:] for r in audits.collect()}
    none = hashlib.sha256(b"").hexdigest()
    by: dict = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn, role, text))
    assert set(got) == set(by)
    for conv, own in by.items():
        assert (*got[conv], digests.get(conv, none)) == plain(own), conv
    told = {}
    for r in sorted(turns.collect(), key=lambda r: (r["part"], r["seg"], r["place"])):
        told[r["conv_id"]] = told.get(r["conv_id"], "") + r["role"][:1]
    assert all(GRAMMAR.fullmatch(t) for t in told.values())


def test_a_long_conversation_costs_linear_time(spark):
    rows = [(1, k, ["user", "assistant"][k * 7 % 3 % 2], f"t{k}" + "." * (k % 5 > 0), None, None) for k in range(30_000)]
    began = time.perf_counter()
    audits, _ = repair.repair(spark.createDataFrame(rows, SCHEMA))
    found = audits.collect()
    assert len(found) == 1 and len(found[0]["audit"].replace("I", "")) == 30_000
    assert time.perf_counter() - began < 60


def test_query_edges(spark, tmp_path):
    rows = [(1, None, None, None, None, None), (1, None, None, None, None, None), (None, 3, "user", "a.", None, None), (2, 0, "user", "Hi.", None, None), (2, 1, "assistant", "Yes.", None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in QUERIES["op11_repair"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, None}
    assert got[1]["gaps"] == 0 and set(got[1]["audit"]) <= {"D"}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert QUERIES["op11_repair"](spark, f"{tmp_path}/none").count() == 0
    # Each conversation whose only turn is dropped is returned with zeros.
    lone = [(k, 0, "user", "a.", None, None) for k in range(200)]
    spark.createDataFrame(lone, SCHEMA).write.parquet(f"{tmp_path}/lone/conversations.parquet")
    found = QUERIES["op11_repair"](spark, f"{tmp_path}/lone").collect()
    assert len(found) == 200
    empty = [r for r in found if r["audit"] == ""]
    assert empty and all(r["cost"] == 0 and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
