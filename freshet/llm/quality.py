"""Quality rules as a short-circuit cascade, DataFrame functions only.

Each rule rejects a text or passes it on. What a rule costs and how much it
rejects is estimated on a sample; rules then run in order of rejection per
cost inside one CASE expression, so a text that a cheap rule rejects never
reaches a dear one. The order changes the work and never the verdict.

Defined results: a null or empty text has no words and is rejected by
``few_words``; repeated rows are judged alike, row by row; very long texts are
read whole, and a task holds the words and windows of one text; an empty table
gives an empty table; extra columns stay as they are, whatever their names.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import let, words, written

# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
SAMPLE_ROWS = 1000
# Runs of a rule that count for its cost, and how often the sample may be taken over for one.
RUNS, MOST_TIMES = 3, 16


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))


def n_dup_lines(text: Column) -> Column:
    return let(lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(starts: Column) -> Column:
    """Words below windows that start at these ascending places."""

    def own(start: Column, k: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - start, F.lit(WINDOW)))

    return F.aggregate(F.transform(starts, own), F.lit(0), lambda total, x: total + x)


def _repeated(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more.

    Sorting hashes with their places puts equal ones side by side; places that
    have an equal neighbour, in order, give the windows, which may overlap.
    """
    ranked = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))

    def starts(pairs: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            h = x["h"]
            # get() of place -1 would be an error in no mode: it is null.
            same = (F.get(pairs, k - 1)["h"] == h) | (F.get(pairs, k + 1)["h"] == h)
            return F.when(F.coalesce(same, F.lit(False)), x["at"])

        return F.sort_array(F.filter(F.transform(pairs, twin), lambda x: x.isNotNull()))

    return let(ranked, lambda pairs: let(starts(pairs), _covered))


def n_repeat_words(text: Column) -> Column:
    """Words in eight-word windows found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Most
    texts repeat none: a distinct count over primitive values finds that out.
    """

    def counted(windows: Column) -> Column:
        none = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(none, F.lit(0)).otherwise(_repeated(windows)).cast("long")

    def hashed(hashes: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda k: F.xxhash64(*[F.get(hashes, k + i) for i in range(WINDOW)]),
        )
        return F.when(F.size(hashes) <= WINDOW, F.lit(0).cast("long")).otherwise(let(each, counted))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), hashed)


@dataclass(frozen=True)
class Rule:
    """A rule and the column expression that says whether it rejects a row."""

    name: str
    rejects: Column


MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


def rules(text: Column, known: dict[str, Column] | None = None) -> list[Rule]:
    """The rules over a text column; ``known`` names measures a table has already."""
    known = known or {}

    def of(name: str) -> Column:
        return known.get(name, MEASURES[name](text))

    safe = F.coalesce(text, F.lit(""))
    letters = F.regexp_count(safe, F.lit(r"\p{L}"))
    return [
        Rule("few_words", of("n_words") < MIN_WORDS),
        Rule("repeated_windows", 100 * of("n_repeat_words") > 30 * of("n_words")),
        # More than one symbol in ten words: tables, mark-up, decorated words.
        Rule("symbols", 10 * of("n_symbols") > of("n_words")),
        Rule("repeated_lines", 2 * of("n_dup_lines") > F.size(lines(text))),
        Rule("word_length", (of("word_chars") > 15 * of("n_words")) | (of("word_chars") < 2 * of("n_words"))),
        Rule("capitals", 2 * F.regexp_count(safe, F.lit(r"\p{Lu}")) > letters),
        Rule("no_letters", 2 * letters < F.length(F.regexp_replace(safe, r"[\x20\x09-\x0D]", ""))),
    ]


def sample(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` texts, drawn from the whole table with a fixed seed."""
    total = docs.count()
    share = min(1.0, rows / total) if total else 1.0
    # Drawn by as many tasks as read the table; only the sampled rows are moved.
    return written(docs.select(F.col(text).alias("text")).sample(False, share, 42).repartition(2), "quality-sample")


def ordered(checks: list[Rule], texts: DataFrame) -> list[Rule]:
    """Rules by rejections per second, as measured on a sample.

    A small job per rule counts its rejections and takes the time, less that of
    a job without a rule. The first run compiles the rule and does not count;
    of the others the fastest does. The sample is taken several times over
    until the rule itself takes longer than the job around it. Rates are told
    apart by factors of two, and equal ones keep the given order, so that
    chance does not decide.
    """
    texts = texts.cache()
    total = texts.count()

    def fastest(rejects: Column, times: int) -> tuple[int, float]:
        rows = texts if times == 1 else texts.select("text", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("nth"))
        counted, took = rows.agg(F.count(F.when(rejects, 1)).alias("n")), []
        for _ in range(1 + RUNS):
            began = time.perf_counter()
            hit = counted.first()["n"]
            took.append(time.perf_counter() - began)
        return hit // times, min(took[1:])

    idle: dict[int, float] = {}

    def cost(rejects: Column) -> tuple[int, float]:
        times = 1
        while True:
            if times not in idle:
                idle[times] = fastest(F.col("text").isNull(), times)[1]
            hit, took = fastest(rejects, times)
            if took > 2 * idle[times] or times >= MOST_TIMES:
                return hit, max(took - idle[times], 1e-5) / times
            times *= 4

    rank = {}
    for rule in checks:
        hit, seconds = cost(rule.rejects)
        # A rule that rejects nothing comes last, whatever it costs.
        rank[rule.name] = round(math.log2(hit / total / seconds)) if hit else -math.inf
    texts.unpersist()
    return sorted(checks, key=lambda rule: -rank[rule.name])


def verdict(checks: list[Rule]) -> Column:
    """The name of the first rule that rejects the row; null if none does."""
    found = F.lit(None).cast("string")
    for rule in reversed(checks):
        found = F.when(rule.rejects, F.lit(rule.name)).otherwise(found)
    return found


def cascade(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows no rule rejects, with all their columns."""
    order = ordered(rules(F.col("text")), sample(docs, text, sample_rows))
    names = [rule.name for rule in order]
    by_name = {rule.name: rule for rule in rules(F.col(text))}
    return docs.where(verdict([by_name[name] for name in names]).isNull())


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: its key, the measures, and the cascade's verdict.

    The measures are wanted for every row here, so the cascade reads them
    instead of taking them again; its other rules still run in order.
    """
    order = [rule.name for rule in ordered(rules(F.col("text")), sample(docs, text, sample_rows))]
    base = docs.select(
        F.col(key).alias("doc_id"),
        F.col(text).alias("text"),
        *[make(F.col(text)).alias(name) for name, make in MEASURES.items()],
    )
    by_name = {r.name: r for r in rules(F.col("text"), {name: F.col(name) for name in MEASURES})}
    failed = by_name["few_words"].rejects | by_name["repeated_windows"].rejects
    return base.select(
        "doc_id",
        *MEASURES,
        failed.alias("base_failed"),
        verdict([by_name[name] for name in order]).alias("rejected_by"),
    )
