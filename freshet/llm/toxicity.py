"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other.
Five transducers over these symbols are composed into one machine. Each passes
symbols on and adds weight: insults become hits, threats become hits next to a
target, hits after a target weigh more, hits after a negation or in reported
speech less. The machine reads one clause at a time, and a text's score rests
on the hits of its clauses, not on words by themselves.

Which words insult, and how much, is learned from labelled texts: whole words
whose share of toxic texts is too high for chance, and beginnings of words for
which that holds without the whole words. What stands beside insults is learned
from the same texts: words before an insult that speak for a clean text become
negations or reports, words that speak for a toxic one targets, in whatever
language. The listed words of these classes are a start; a listed threat that
clean texts use often is another word that is spelt alike, and is dropped. A
logistic curve fitted to other labelled texts turns clause scores into
probabilities. Labels never reach a score but through these.

Only ``SAMPLE`` labelled ids are used, those of least id hash, with one text
each; all texts are scored, whole, however long they are. One Aho-Corasick pass finds lexicon words, and only clauses that
hold one are read word by word.

Defined results: a null or empty text has no clauses and gets the score of
texts without hits; repeated rows are scored alike; ids with labels 0 and 1
count as toxic; of several texts of an id the least is learned from; with no usable labels there is no lexicon and all scores are the
smoothed share; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import written

SAMPLE = 10_000
LEXICON = 2_000
PREFIXES = range(3, 8)
# By how much evidence for a pattern must exceed what the best of all patterns shows by chance.
MARGIN = 3.0
# A listed threat in more than this share of the clean texts is no threat. Context words learned of a kind.
FREQUENT, CONTEXTS = 0.01, 200

# Words of the closed classes, lower case.
TARGETS = set("you your yours yourself u ur he his him she her hers they them their these those this that it who".split())
TARGETS |= set("du dich dir dein ihr euch sie er tu te toi ton vous votre il elle ils tú usted vosotros él ella ellos".split())
NEGATIONS = set("not no never none neither nor without isn't aren't wasn't weren't don't doesn't didn't won't can't".split())
NEGATIONS |= set("nicht kein keine nie niemals pas jamais sans no nunca sin".split())
REPORTED = set("said says say saying told tells claimed claims wrote writes quoted quotes quote called reported".split())
REPORTED |= set("sagte sagt schrieb dit disait écrit dijo dice escribió".split())
THREATS = set("kill kills killing hurt hurts destroy destroys die murder beat beats stab shoot hang burn punish".split())

# Log weights of the grammar: of a threat, of a hit with a target, after a negation, in reported speech.
THREAT, AIMED, NEGATED, QUOTED = 2.0, 0.5, -1.5, -1.0
NEAR_THREAT, NEAR_NEGATION = 5, 3

_CLAUSE = re.compile(r"[^.!?;:\n…。！？]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
SYMBOLS = ("other", "insult", "threat", "target", "negation", "reported", "hit")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: (state, symbol) to (state, symbol, weight); it starts in state 0."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def compose(self, after: Transducer) -> Transducer:
        """The machine that reads what this one reads and writes what ``after`` makes of its output."""
        names, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            pair = todo.pop()
            for symbol in SYMBOLS:
                first, middle, a = self.arcs[pair[0], symbol]
                second, out, b = after.arcs[pair[1], middle]
                if (first, second) not in names:
                    names[first, second] = len(names)
                    todo.append((first, second))
                arcs[names[pair], symbol] = names[first, second], out, a + b
        return Transducer(arcs)


def _machine(states: int, step) -> Transducer:
    return Transducer({(s, x): step(s, x) for s in range(states) for x in SYMBOLS})


def insults() -> Transducer:
    return _machine(1, lambda s, x: (0, "hit" if x == "insult" else x, 0.0))


def threats(near: int = NEAR_THREAT) -> Transducer:
    """A threat and a target within ``near`` words make the later one a hit.

    State 0 remembers nothing, 1 to ``near`` a threat, further ones a target,
    each for as many words as are left.
    """

    def step(s: int, x: str) -> tuple[int, str, float]:
        threat, target = 0 < s <= near, s > near
        if x == "threat":
            return (0, "hit", THREAT) if target else (near, "other", 0.0)
        if x == "target":
            return (0, "hit", THREAT) if threat else (2 * near, "target", 0.0)
        later = s - 1 if threat or s > near + 1 else 0
        return later, x, 0.0

    return _machine(2 * near + 1, step)


def targets() -> Transducer:
    """A hit after a target weighs more; targets end here."""
    return _machine(2, lambda s, x: (1 if x == "target" else s, "other" if x == "target" else x, AIMED if x == "hit" and s else 0.0))


def negation(near: int = NEAR_NEGATION) -> Transducer:
    """A hit within ``near`` words of a negation weighs less."""

    def step(s: int, x: str) -> tuple[int, str, float]:
        if x == "negation":
            return near, "other", 0.0
        return max(s - 1, 0), x, NEGATED if x == "hit" and s else 0.0

    return _machine(near + 1, step)


def reported_speech() -> Transducer:
    """Hits after a verb of speech weigh less until the clause ends."""
    return _machine(2, lambda s, x: (1 if x == "reported" else s, "other" if x == "reported" else x, QUOTED if x == "hit" and s else 0.0))


def grammar() -> Transducer:
    out = insults()
    for machine in (threats(), targets(), negation(), reported_speech()):
        out = out.compose(machine)
    return out


def patterns(word: str) -> list[str]:
    """What a word may be known by: itself, and its beginnings with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if n < len(word))]


def listed() -> dict[str, str]:
    """The symbols of the listed words."""
    out = dict.fromkeys(TARGETS, "target") | dict.fromkeys(NEGATIONS, "negation")
    return out | dict.fromkeys(REPORTED, "reported") | dict.fromkeys(THREATS, "threat")


class Scorer:
    """Clause scores of texts, for a lexicon of patterns and weights and the symbols of other words."""

    def __init__(self, lexicon: dict[str, float], symbols: dict[str, str] | None = None):
        self._lexicon = lexicon
        self._arcs = grammar().arcs
        self._closed = listed() if symbols is None else symbols
        self._find = ahocorasick.Automaton()
        for start in {p.rstrip("*") for p in lexicon} | {w for w, x in self._closed.items() if x == "threat"}:
            self._find.add_word(start, len(start))
        self._find.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        weights = [self._lexicon[p] for p in patterns(word) if p in self._lexicon]
        if weights:
            return "insult", max(weights)
        return self._closed.get(word, "other"), 0.0

    def clause(self, text: str) -> list[float]:
        """Weights of a clause's hits."""
        state, hits = 0, []
        for word in _WORD.findall(text):
            symbol, weight = self.symbol(word)
            state, out, more = self._arcs[state, symbol]
            if out == "hit" and weight + more > 0:
                hits.append(weight + more)
        return hits

    def clauses(self, text: str | None) -> Iterator[str]:
        """The clauses, in lower case, that hold a word of the lexicon or a threat."""
        if not text:
            return
        low, done = text.lower(), 0
        for last, size in self._find.iter(low):
            at = last + 1 - size
            # Lexicon entries begin words; the rest of their clause is read but once.
            if at < done or at and low[at - 1].isalpha():
                continue
            start = max(low.rfind(c, done, at) for c in ".!?;:\n…。！？") + 1 if at > done else at
            clause = _CLAUSE.match(low, max(start, done))
            done = clause.end()
            yield clause[0]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """The best clause's score, and logs of the sum and number of all hits."""
        best = total = count = 0.0
        for clause in self.clauses(text):
            hits = self.clause(clause)
            best, total, count = max(best, sum(hits)), total + sum(hits), count + len(hits)
        return best, math.log1p(total), math.log1p(count)

    def beside(self, text: str | None) -> set[str]:
        """Words before an insult in its clause, marked by how near: within the reach of a negation, or further."""
        found = set()
        for clause in self.clauses(text):
            words = _WORD.findall(clause)
            for k, word in enumerate(words):
                if self.symbol(word)[0] == "insult":
                    near = max(0, k - NEAR_NEGATION)
                    found.update(f"near {w}" for w in words[near:k])
                    found.update(f"far {w}" for w in words[:near])
        return found


def labelled(docs: DataFrame, labels: DataFrame, train: Column, key: str, text: str, label: str, rows: int) -> DataFrame:
    """``id``, ``text`` and ``toxic`` of at most ``rows`` labelled ids that ``train``, a condition on ``id``, admits."""
    marks = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("toxic"))
    marks = marks.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).where(train)
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    # Bounded by the parameter, so it may be sent to every executor.
    some = F.broadcast(marks.orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # One text per id: an id that rows repeat brings no more rows than another.
    one = texts.join(some, "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return written(one.select("id", "text", "toxic"), "toxicity-labelled")


def _told(rows: DataFrame, known: Callable[[str | None], set[str]]) -> tuple[DataFrame, int, int, int]:
    """What texts hold that tells toxic from clean ones; the numbers of patterns, texts and toxic texts.

    ``pattern``, ``t`` and ``c`` (toxic and clean texts that hold it),
    ``evidence`` and ``weight``. The evidence is the log likelihood ratio of
    the pattern's toxic share against that of all texts; the weight is the log
    of how much likelier a toxic text holds it.
    """
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Summed per batch, so that a task holds the patterns of one batch.
        for batch in batches:
            every, bad = Counter(), Counter()
            for text, mark in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = known(text)
                every.update(own)
                if mark:
                    bad.update(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(every), pa.string()), pa.array([bad[p] for p in every], pa.int64()), pa.array(list(every.values()), pa.int64())],
                ["pattern", "toxic", "n"],
            )

    counts = rows.select("text", "toxic").mapInArrow(count, "pattern string, toxic long, n long")
    counts = written(counts.groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("n").alias("n")), "toxicity-counts")
    share = toxic / max(n, 1)
    t, c = F.col("t"), F.col("n") - F.col("t")

    def part(k: Column, expected: float) -> Column:
        return F.when(k > 0, k * F.log(k / (F.col("n") * expected))).otherwise(0.0)

    evidence = part(t, share) + part(c, 1 - share)
    weight = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (n - toxic + 1.0))
    told = counts.select("pattern", "t", c.alias("c"), evidence.alias("evidence"), weight.alias("weight"))
    return told, counts.count(), n, toxic


def _beyond_chance(told: DataFrame, tried: int, toxic: bool, most: int) -> dict[str, float]:
    """The patterns that speak for toxic, or clean, texts more than the best of all would by chance; their weights."""
    side = F.col("weight") > 0 if toxic else F.col("weight") < 0
    found = told.where(side & (F.col("evidence") > math.log(max(tried, 1)) + MARGIN))
    return {r["pattern"]: r["weight"] for r in found.orderBy(F.desc("evidence"), "pattern").limit(most).collect()}


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def learn(rows: DataFrame, most: int = LEXICON) -> dict[str, float]:
    """Patterns of toxic texts and their weights: whole words first, then beginnings of the other words."""
    told, tried, n, toxic = _told(rows, _words)
    if not toxic or toxic == n:
        return {}
    whole = _beyond_chance(told, tried, True, most)

    def begun(text: str | None) -> set[str]:
        return {p for w in _words(text) if w not in whole for p in patterns(w)[1:]}

    told, tried, *_ = _told(rows, begun)
    return whole | _beyond_chance(told, tried, True, most - len(whole))


def _once(lexicon: dict[str, float], symbols: dict[str, str]) -> Callable[[str | None], set[str]]:
    """``Scorer.beside`` with a scorer that each task makes for itself."""
    made: list[Scorer] = []

    def beside(text: str | None) -> set[str]:
        if not made:
            made.append(Scorer(lexicon, symbols))
        return made[0].beside(text)

    return beside


def contexts(rows: DataFrame, lexicon: dict[str, float]) -> dict[str, str]:
    """The symbols of words that are no insults: the listed ones less false threats, and those learned."""
    symbols = listed()
    told, _, n, toxic = _told(rows, lambda text: _words(text) & THREATS)
    frequent = told.where((F.col("c") > FREQUENT * max(n - toxic, 1)) & (F.col("weight") < math.log(2)))
    for r in frequent.collect():
        del symbols[r["pattern"]]
    if not lexicon:
        return symbols

    # Only texts with an insult tell anything of what stands beside one.
    some = _features(rows, lexicon, "toxic", symbols).where("f2 > 0").select("id")
    told, tried, n, toxic = _told(written(rows.join(some, "id"), "toxicity-beside"), _once(lexicon, symbols))
    if not toxic or toxic == n:
        return symbols
    milder = _beyond_chance(told, tried, False, CONTEXTS)
    worse = _beyond_chance(told, tried, True, CONTEXTS)
    for found, near, far in ((worse, "target", "target"), (milder, "negation", "reported")):
        for pattern in found:
            place, word = pattern.split(" ", 1)
            if word not in lexicon:
                symbols[word] = near if place == "near" else symbols.get(word, far)
    return symbols


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve, the constant first, by damped Newton steps."""
    a = np.c_[np.ones(len(x)), x]
    keep = np.full(a.shape[1], ridge)
    w = np.zeros(a.shape[1])
    # As if one more text of each label were known: with no text the score is a half.
    w[0] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (keep * w * w).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep), a.T @ (y - p) - keep * w)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        if size <= 1e-6 or np.abs(size * step).max() < 1e-8:
            break
    return w


def _features(rows: DataFrame, lexicon: dict[str, float], carried: str, symbols: dict[str, str] | None = None) -> DataFrame:
    """``id``, the column ``carried`` and the three features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon, symbols)
        for batch in batches:
            found = np.array([scorer.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column(carried), *(pa.array(found[:, k]) for k in range(3))], ["id", carried, "f0", "f1", "f2"]
            )

    kind = rows.schema[carried].dataType.simpleString()
    return rows.select("id", carried, "text").mapInArrow(run, f"id long, {carried} {kind}, f0 double, f1 double, f2 double")


def score(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """``id`` and ``score`` of every row; learned from labelled ids that ``train``, a condition on ``id``, admits.

    Two thirds of the sample, by id hash, give the lexicon and one the curve.
    """
    known = labelled(docs, labels, train, key, text, label, sample)
    third = F.pmod(F.xxhash64(F.lit("curve"), F.col("id")), F.lit(3)) == 0
    lexicon = learn(known.where(~third))
    symbols = contexts(known.where(~third), lexicon)
    # One row for each id of the sample: no more than it has.
    rest = _features(known.where(third), lexicon, "toxic", symbols).collect()
    x = np.array([(r["f0"], r["f1"], r["f2"]) for r in rest], dtype=float).reshape(-1, 3)
    w = [float(v) for v in fit(x, np.array([r["toxic"] for r in rest], dtype=float))]
    rows = docs.select(F.col(key).cast("long").alias("id"), F.lit(0).alias("none"), F.col(text).alias("text"))
    found = _features(rows, lexicon, "none", symbols)
    linear = F.lit(w[0]) + w[1] * F.col("f0") + w[2] * F.col("f1") + w[3] * F.col("f2")
    return found.select("id", (1 / (1 + F.exp(-linear))).alias("score"))
