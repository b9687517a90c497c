"""Repair of conversation structure by aligning turns to an alternating grammar.

A repaired conversation reads ``(s?(ua)+)?`` in its roles' initials. Its turns
are aligned to each feasible length of that string as in Wagner and Fischer's
algorithm: keep, rerole, delete, insert. Targets of all lengths end alike, so
aligning from the end makes them columns of one table. A plain left-to-right
repair gives the incumbent cost; cells that no alignment within it can pass
through lie outside Ukkonen's band and are never filled. The cheapest lengths
are traced back, each to its least audit, and the audits are compared.

No task holds a conversation's texts. Turns are range-partitioned in order and
cut into segments of at most ``SEGMENT``. A segment is aligned from each state
of the grammar to each other one; a conversation's segments are then folded in
order, from their costs and audits alone, and each segment applies its share of
the audit where its texts are. Two audits of one cost over the same turns that
end in the same state have equally many insertions, so neither begins the
other, and comparing them before the rest is known is exact.

What one task does hold is a conversation's audit: a letter for each turn, as
it is one value of the result.

Defined results: a null role or text is one space; turns are in the order of
``turn``, nulls first, then role, then text; rows without a conversation id are
one conversation; repeated rows are duplicates; a role of no character fits no
place and can be reroled; very long texts are moved and never parsed beyond
their last character that is no white space; an empty table gives an empty
table; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
SEGMENT = 256
# Rows of a batch that a task hands on at once, and the characters that end it sooner.
BATCH_ROWS, BATCH_CHARS = 1_000, 4_000_000

# States of the grammar: nothing yet, after the system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


def wanted(state: int) -> str:
    """The initial that follows a state; a system turn may also come first."""
    return "a" if state == USER else "u"


class Segment:
    """Turns to align: their initials, which must be deleted, and which are truncated."""

    def __init__(self, initials: list[str], forced: list[bool], broken: list[bool]):
        self.initials, self.forced, self.broken = initials, forced, broken
        # Turns from here on that may stay.
        self.free = [0] * (len(initials) + 1)
        for i in range(len(initials) - 1, -1, -1):
            self.free[i] = self.free[i + 1] + (not forced[i])

    def incumbent(self, state: int, last: str) -> int:
        """The cost of a repair from left to right that ends in ``last``."""
        cost, want, none = 0, wanted(state), True
        for initial, forced, broken in zip(self.initials, self.forced, self.broken, strict=True):
            if forced or broken:
                cost += DELETE_COST
            else:
                cost += 0 if initial == want else REROLE_COST
                want, none = "a" if want == "u" else "u", False
        # What came last is the opposite of what is wanted now.
        if none:
            return cost + (INSERT_COST if want == last else 2 * INSERT_COST)
        return cost + (INSERT_COST if want == last else 0)

    def table(self, last: str, most: int) -> list[tuple[int, list[int]]]:
        """Costs of aligning turns ``i``.. to the last ``k`` initials of an alternation ending in ``last``.

        Row ``i`` is its first ``k`` and the costs from there on; what lies
        outside costs more than ``most`` in all.
        """
        n = len(self.initials)
        slack = most - DELETE_COST * (n - self.free[0])
        other = "a" if last == "u" else "u"
        endless = most + 1
        rows: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
        rows[n] = 0, [INSERT_COST * k for k in range(slack // INSERT_COST + 1)]
        for i in range(n - 1, -1, -1):
            low = max(0, self.free[i] - slack // DELETE_COST)
            high = self.free[i] + slack // INSERT_COST
            first, after = rows[i + 1]
            end = first + len(after)
            initial, stay = self.initials[i], TRUNCATED_COST if self.broken[i] else 0
            own: list[int] = []
            best = endless
            for k in range(low, high + 1):
                best = best + INSERT_COST
                if first <= k < end and after[k - first] + DELETE_COST < best:
                    best = after[k - first] + DELETE_COST
                if not self.forced[i] and first < k <= end:
                    fits = initial == (last if k % 2 else other)
                    cost = after[k - 1 - first] + stay + (0 if fits else REROLE_COST)
                    if cost < best:
                        best = cost
                own.append(best)
            rows[i] = low, own
        return rows

    def audit(self, rows: list[tuple[int, list[int]]], last: str, start: int, k: int) -> str:
        """The least audit among the cheapest alignments of turns ``start``.. to the last ``k`` initials."""

        def cost(i: int, k: int) -> int:
            low, own = rows[i]
            return own[k - low] if low <= k < low + len(own) else 1 << 60

        other, n, i, out = "a" if last == "u" else "u", len(self.initials), start, []
        while i < n or k:
            now = cost(i, k)
            if i < n and now == cost(i + 1, k) + DELETE_COST:
                out.append(DELETE)
                i += 1
            elif k and now == cost(i, k - 1) + INSERT_COST:
                out.append(INSERT)
                k -= 1
            else:
                out.append(KEEP if self.initials[i] == (last if k % 2 else other) else REROLE)
                i, k = i + 1, k - 1
        return "".join(out)

    def _cheapest(self, rows: list[tuple[int, list[int]]], last: str, start: int, want: str) -> tuple[int, str] | None:
        """The best cost and audit over all lengths of at least one that begin with ``want``."""
        low, own = rows[start]
        odd = 1 if want == last else 0
        lengths = [k for k in range(max(low, 1), low + len(own)) if k % 2 == odd]
        if not lengths:
            return None
        least = min(own[k - low] for k in lengths)
        return least, min(self.audit(rows, last, start, k) for k in lengths if own[k - low] == least)

    def ways(self, entries: tuple[int, ...], exits: tuple[int, ...]) -> list[tuple[int, int, int, str]]:
        """(entry, exit, cost, audit) of the best alignment between states of the grammar."""
        n = len(self.initials)
        gone = (DELETE_COST * n, DELETE * n)
        found: dict[tuple[int, int], tuple[int, str]] = {(e, e): gone for e in entries if e in exits}

        def offer(entry: int, leave: int, way: tuple[int, str]) -> None:
            if leave in exits and ((entry, leave) not in found or way < found[entry, leave]):
                found[entry, leave] = way

        # Turns that can be the system turn, all before them deleted.
        heads = []
        if START in entries:
            heads = [i for i in range(n) if self.initials[i] == "s" and not self.forced[i]]

        def head(i: int) -> tuple[int, str]:
            return DELETE_COST * i + (TRUNCATED_COST if self.broken[i] else 0), DELETE * i + KEEP

        for i in heads:
            cost, audit = head(i)
            offer(START, SYSTEM, (cost + DELETE_COST * (n - i - 1), audit + DELETE * (n - i - 1)))
        for last, leave in (("u", USER), ("a", ASSISTANT)):
            if leave not in exits:
                continue
            most = max(self.incumbent(e, last) for e in entries)
            rows = self.table(last, most)
            for entry in entries:
                if way := self._cheapest(rows, last, 0, wanted(entry)):
                    offer(entry, leave, way)
            for i in heads:
                cost, audit = head(i)
                # A head is worth a trace only if its cost can still win.
                low, own = rows[i + 1]
                odd = 1 if last == "u" else 0
                rest = [own[k - low] for k in range(max(low, 1), low + len(own)) if k % 2 == odd]
                if rest and cost + min(rest) <= found.get((START, leave), (most,))[0]:
                    more, tail = self._cheapest(rows, last, i + 1, "u")
                    offer(START, leave, (cost + more, audit + tail))
        return [(e, x, cost, audit) for (e, x), (cost, audit) in sorted(found.items())]


def marked(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with their first fault, if any, and ``nth``: 1 for the first of a conversation with its role and text."""
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    # A running number needs no more of its group than the row before.
    alike = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("nth", F.row_number().over(alike))
    fault = (
        F.when(~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z")), "truncated")
    )
    return rows.withColumn("fault", fault)


_WAY = "struct<entry:int,exit:int,cost:long,audit:string>"
_FACTS = (
    "first_turn long, last_turn long, n_turns long, head string, tail string, "
    "blank long, duplicate long, truncated long, illegal long"
)
_SEGMENT = f"conv_id long, part int, seg long, {_FACTS}, ways array<{_WAY}>, roles array<string>, texts array<string>"
_ARROW_WAY = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_ARROW_SEGMENT = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64())]
    + [(name, pa.int64()) for name in ("first_turn", "last_turn", "n_turns")]
    + [("head", pa.string()), ("tail", pa.string())]
    + [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")]
    + [("ways", pa.list_(_ARROW_WAY)), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)


def _described(conv: int | None, part: int, seg: int, rows: list[tuple], whole: bool) -> dict:
    """A segment's row: what the fold needs of it, and its turns."""
    initials = [role[:1] for _, role, _, _ in rows]
    faults = [fault for *_, fault in rows]
    found = Segment(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
    numbers = [turn for turn, *_ in rows if turn is not None]
    ways = found.ways((START,), ACCEPTING) if whole else found.ways((START, SYSTEM, USER, ASSISTANT), (START, SYSTEM, USER, ASSISTANT))
    return {
        "conv_id": conv, "part": part, "seg": seg,
        "first_turn": numbers[0] if numbers else None, "last_turn": numbers[-1] if numbers else None, "n_turns": len(set(numbers)),
        "head": initials[0], "tail": initials[-1],
        "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "ways": [dict(zip(("entry", "exit", "cost", "audit"), way, strict=True)) for way in ways],
        "roles": [role for _, role, _, _ in rows], "texts": [text for _, _, text, _ in rows],
    }


def segments(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = SEGMENT) -> DataFrame:
    """Runs of at most ``most`` turns of one conversation; by (``part``, ``seg``) they are in order.

    A conversation's first and last run in a task may have others elsewhere,
    so they are aligned between all states; what lies within needs no more than
    the whole alignment.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "nth"]
    rows = marked(turns, conv, turn, role, text).repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg = TaskContext.get().partitionId(), 0
        out: list[dict] = []
        held: list[tuple] = []
        chars, own, opened, first_of_task = 0, None, False, True

        def close(ends: bool) -> None:
            """The rows held become a segment; ``ends``: their conversation goes on in no other task."""
            nonlocal held, seg, opened, chars
            if held:
                out.append(_described(own, part, seg, held, ends and not opened and not first_of_task))
                chars += sum(len(t) for _, _, t, _ in held)
                seg += 1
                opened, held = True, []

        def packed() -> pa.RecordBatch:
            nonlocal out, chars
            batch = pa.RecordBatch.from_pylist(out, _ARROW_SEGMENT)
            out, chars = [], 0
            return batch

        for batch in batches:
            for conv_id, number, name, said, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and conv_id != own:
                    close(True)
                    first_of_task = False
                if not held and conv_id != own:
                    opened = False
                if len(held) == most:
                    close(False)
                own = conv_id
                held.append((number, name, said, fault))
                if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield packed()
        close(False)
        if out:
            yield packed()

    return written(rows.select("conv_id", "turn", "role", "text", "fault").mapInArrow(cut, _SEGMENT), "repair-segments")


_TOTALS = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"
_SHARE = f"conv_id long, part int, seg long, entry int, share string, totals {_TOTALS}"
_ARROW_TOTALS = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
_ARROW_SHARE = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("entry", pa.int32()), ("share", pa.string()), ("totals", _ARROW_TOTALS)]
)


class Fold:
    """One conversation's segments, taken in order."""

    def __init__(self):
        # By state: cost, audit, and the way there as (way before, place, entry, share).
        self.best: dict[int, tuple] = {START: (0, "", None)}
        self.facts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.low, self.high, self.tail = 0, None, None, None

    def add(self, row: dict) -> None:
        after: dict[int, tuple] = {}
        for way in row["ways"]:
            if way["entry"] in self.best:
                cost, audit, trail = self.best[way["entry"]]
                told = (cost + way["cost"], audit + way["audit"])
                if way["exit"] not in after or told < after[way["exit"]][:2]:
                    after[way["exit"]] = (*told, (trail, (row["part"], row["seg"]), way["entry"], way["audit"]))
        self.best = after
        for name in self.facts:
            self.facts[name] += row[name]
        if self.tail is not None and self.tail + row["head"] not in LEGAL:
            self.facts["illegal"] += 1
        self.tail = row["tail"]
        if row["n_turns"]:
            # Turns ascend, so only the border can show one number twice.
            self.turns += row["n_turns"] - (self.high == row["first_turn"])
            self.low = row["first_turn"] if self.low is None else self.low
            self.high = row["last_turn"]

    def shares(self, conv: int | None) -> list[dict]:
        """Each segment's share of the audit; the totals stand with the last one."""
        cost, audit, trail = min(self.best[s] for s in ACCEPTING if s in self.best)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        totals = {"gaps": gaps, **self.facts, "cost": cost, "audit": audit}
        out = []
        while trail:
            trail, (part, seg), entry, share = trail
            out.append({"conv_id": conv, "part": part, "seg": seg, "entry": entry, "share": share, "totals": None})
        out[0]["totals"] = totals
        return out


def shares(runs: DataFrame) -> DataFrame:
    """What each segment does, and the totals of its conversation with the last of them; texts are not read."""
    facts = [f.split()[0] for f in _FACTS.split(", ")]
    names = ["conv_id", "part", "seg", *facts, "ways"]
    order = ["conv_id", "part", "seg"]
    rows = runs.select(*names).repartition("conv_id").sortWithinPartitions(*order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != own:
                    if now:
                        out += now.shares(own)
                    now, own = Fold(), row["conv_id"]
                now.add(row)
            if len(out) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(out, _ARROW_SHARE)
                out = []
        if now:
            out += now.shares(own)
        yield pa.RecordBatch.from_pylist(out, _ARROW_SHARE)

    return written(rows.mapInArrow(fold, _SHARE), "repair-shares")


def applied(entry: int, share: str, roles: list[str], texts: list[str]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of every turn that a segment has after its share of the audit."""
    state, i, out = entry, 0, []
    for edit in share:
        if edit == DELETE:
            i += 1
            continue
        if edit == KEEP:
            initial, role, text = roles[i][:1], roles[i], texts[i]
        else:
            initial = wanted(state)
            role, text = ROLES[initial], "" if edit == INSERT else texts[i]
        i += edit != INSERT
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]
        out.append((edit, role, text))
    return out


_TURN = "conv_id long, part int, seg long, place int, edit string, role string, text string"
_ARROW_TURN = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("place", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """The audits and the repaired turns.

    Audits: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` and ``audit``, one row per conversation. Turns:
    ``conv_id``, ``part``, ``seg``, ``place`` (in this order), ``edit``, ``role``
    and ``text``.
    """
    runs = segments(turns, conv, turn, role, text, most)
    dealt = shares(runs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                for k, (edit, name, said) in enumerate(applied(row["entry"], row["share"], row["roles"], row["texts"])):
                    out.append({"conv_id": row["conv_id"], "part": row["part"], "seg": row["seg"], "place": k, "edit": edit, "role": name, "text": said})
            yield pa.RecordBatch.from_pylist(out, _ARROW_TURN)

    held = runs.select("conv_id", "part", "seg", "roles", "texts").join(dealt.select("part", "seg", "entry", "share"), ["part", "seg"])
    audits = dealt.where(F.col("totals").isNotNull()).select("conv_id", "totals.*")
    return audits, held.mapInArrow(apply, _TURN)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` of repaired turns (``role:text``, joined by newlines).

    A digest runs over a conversation in order, so a conversation passes
    through one task; that holds one turn at a time.
    """
    order = ["conv_id", "part", "seg", "place"]
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, out = None, None, []
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != own:
                    if state:
                        out.append({"conv_id": own, "repaired_sha256": state.hexdigest()})
                    own, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(out) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if state:
            out.append({"conv_id": own, "repaired_sha256": state.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema)

    rows = turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return rows.mapInArrow(run, "conv_id long, repaired_sha256 string")
