"""Katz back-off language model of any order with Good-Turing discounts.

    P(w | h) = d(r) r / c(h)        for r = c(h, w) > 0
             = alpha(h) P(w | h')   else, h' being h without its first word
    P(w)     = d(c) c / N           for c = c(w) > 0
             = what is left         for all unknown words together

Each level has Good-Turing discounts d of its own, of counts up to ``K``.
alpha(h) makes the probabilities after h sum to one exactly: what the discounts
leave, over what the level below gives to the words not seen after h. Where
discounts leave nothing, 1 / (c(h) + 1) is put aside first. A text begins after
one end token; its first words have the shorter histories that this leaves.

The counts are too many to be joined token by token. Texts become blocks of
token codes with a vocabulary of their own. A block asks for each of its words,
then for each pair, and so on up a level, once; questions are dealt by hash to
buckets, which sum the counts of all blocks and answer each block. Question and
answer travel as packed columns of numbers, one row per block and bucket.

A gram is named by the number of its history and that of its last word, and is
dealt by its history, so that the bucket can sum up what alpha(h) rests on;
histories more frequent than ``SALT`` are spread over several buckets by the last
word, and whoever asks adds their sums up. A pair's number is that of its two
words side by side, which blocks know; only longer histories are told theirs. All
words seen after h share h', so the mass that they have below is one factor times
a sum of discounted counts, and no probability has to travel. A history that one
block alone has is never asked for: that block knows all its grams. Every step is
a written table.

Defined results: a null or empty text is the end token alone; repeated rows
count, and are scored, as often as they occur; without training texts all
tokens are unknown; a very long text is scored whole, and one longer than a
block makes its block as much larger; an empty table gives an empty table; extra
columns are not read. A null id counts as empty text where ids are dealt.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import written

# Counts up to this are discounted.
K = 5
# Tokens of a block, words and tokens asked of a bucket, occurrences of a history in one bucket.
BLOCK, WORDS, GRAMS, SALT = 2_000_000, 250_000, 1_000_000, 250_000
# Words of the longest gram, and most tasks of a stage.
ORDER, WIDTH = 3, 50_000
# Numbers that are worked on at once, where steps between need memory of their own.
SLICE = 1 << 17
# Spark's setting by which shuffle files go at the end of a query.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
END = b""

_BLOCK = "block long, ids array<long>, train binary, lengths binary, codes binary, words binary, vocabulary long, tokens long"
_WORD = "bucket int, block long, at binary, words binary, n binary"
_UNIGRAM = "bucket int, block long, at binary, ids binary, shared binary, counts binary, words binary, stats array<long>"
_ASKED = "bucket int, block long, h binary, many binary, w binary, n binary, below binary, stats array<long>"
_ANSWER = "kind int, level int, bucket int, block long, counts binary, ids binary, shared binary, small binary, held binary, stats array<long>"
_SCORE = "id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """Non-negative numbers, or doubles, in few bytes: their lowest bytes, then the next, compressed."""
    if values.dtype.kind == "f":
        size, raw = 0, np.ascontiguousarray(values, dtype="<f8")
    else:
        top = int(values.max()) if len(values) else 0
        size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
        raw = values.astype(f"<u{size}")
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), size or 8).T)
    return bytes([size]) + zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    """The numbers, of 32 bits where that will do."""
    size = data[0]
    raw = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(size or 8, -1)
    flat = np.empty(raw.shape[::-1], dtype=np.uint8)
    for k, plane in enumerate(raw):
        flat[:, k] = plane
    if not size:
        return flat.view("<f8")[:, 0]
    if size == 4 and not (raw[3] > 127).any():
        return flat.view("<i4")[:, 0]
    return flat.view(f"<u{size}")[:, 0].astype(np.int32 if size < 4 else np.int64)


def _rising(values: np.ndarray) -> bytes:
    """Ascending numbers, as steps."""
    return pack(np.diff(values, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (part.strip().split(" ") for part in ddl.split(","))])


def _scramble(x: np.ndarray) -> np.ndarray:
    """A fixed mix of 64-bit numbers."""
    z = x.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _slices(size: int) -> Iterator[slice]:
    return (slice(at, at + SLICE) for at in range(0, size, SLICE))


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers in ascending order, and the place that each had, by which equal ones are ordered.

    The array given is used up. A plain sort of numbers is several times faster
    where places fit in beside them.
    """
    bits = max(1, len(keys).bit_length())
    if len(keys) and int(keys.max()).bit_length() + bits > 63:
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    keys <<= bits
    for s in _slices(len(keys)):
        keys[s] |= np.arange(s.start, min(s.stop, len(keys)))
    keys.sort()
    ordered = keys >> bits
    keys &= (1 << bits) - 1
    return ordered, keys


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers, ascending, and which of them each number is. The array given is used up."""
    ordered, order = _sorted(keys)
    fresh = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    different = ordered[fresh]
    del ordered
    which = np.empty(len(order), dtype=np.int32)
    which[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return different, which


def discounts(seen: list[int]) -> list[float]:
    """d(1), ..., d(K) from the numbers of items seen once, twice, ..., K + 1 times.

    The largest k up to K is taken with which all are in (0, 1]; others are 1.
    Where none is, the counts don't follow the formula's law, and every
    discounted count is lessened by a half.
    """
    for k in range(K, 0, -1):
        n = seen[: k + 1]
        if not all(n):
            continue
        common = (k + 1) * n[k] / n[0]
        if common >= 1:
            continue
        found = [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) for r in range(1, k + 1)]
        if all(0 < d <= 1 for d in found):
            return found + [1.0] * (K - k)
    return [(r - 0.5) / r for r in range(1, K + 1)]


def discounted(counts: np.ndarray, discount: tuple[float, ...]) -> np.ndarray:
    """d(r) r of these counts."""
    return np.array([1.0, *discount])[np.where(counts <= K, counts, 0)] * counts


def discounted_sum(small: np.ndarray, discount: tuple[float, ...]) -> np.ndarray:
    """d(r) r, added up, of counts given as the sum of those over ``K``, then the numbers of those from 1 to ``K``."""
    return small[:, 0] + small[:, 1:] @ (np.arange(1, K + 1) * np.array(discount))


@dataclass(frozen=True)
class Unigrams:
    """What the word probabilities rest on."""

    tokens: int
    distinct: int
    discount: tuple[float, ...]
    mass: float  # of known words, before scaling
    unknown: float  # of all unknown words together

    @classmethod
    def of(cls, tokens: int, distinct: int, seen: list[int]) -> Unigrams:
        d = discounts(seen)
        lost = sum((1 - d[r - 1]) * r * seen[r - 1] for r in range(1, K + 1)) / tokens if tokens else 1.0
        unknown = max(lost, 1 / (tokens + 1))
        return cls(tokens, distinct, tuple(d), 1 - lost, unknown)

    @property
    def factor(self) -> float:
        """What a discounted count is multiplied by."""
        return (1 - self.unknown) / self.mass / self.tokens if self.tokens and self.mass else 0.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) of words with these counts; that of the unknown class for a count of zero."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, discounted(counts, self.discount) * self.factor, self.unknown)


def blocks_of(docs: DataFrame, train: Column, key: str, text: str, size: int) -> DataFrame:
    """Texts as blocks of codes; code 0 is the end token, which closes every text."""
    schema = _schema(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        known = defaultdict(itertools.count(1).__next__, {END: 0})
        ids, flags, lengths, codes, tokens = [], [], [], [], 0

        def closed() -> pa.RecordBatch:
            flat = np.concatenate(codes)
            # Frequent words get small codes.
            rank = np.argsort(-np.bincount(flat, minlength=len(known))[1:], kind="stable") + 1
            new = np.zeros(len(known), dtype=np.int64)
            new[rank] = np.arange(1, len(known))
            names = np.array(list(known), dtype=object)[rank]
            row = (part << 32 | made, ids, pack(np.array(flags)), pack(np.array(lengths)), pack(new[flat]),
                   zstandard.compress(b"\n".join(names), 3), len(known), len(flat))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, flag, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                parts = (raw or b"").lower().split()
                one = np.fromiter(map(known.__getitem__, parts), dtype=np.int64, count=len(parts))
                codes.append(np.append(one, 0).astype(np.int32))
                ids.append(doc_id)
                flags.append(int(flag))
                lengths.append(len(parts) + 1)
                tokens += len(parts) + 1
                if tokens >= size:
                    yield closed()
                    made, known = made + 1, defaultdict(itertools.count(1).__next__, {END: 0})
                    ids, flags, lengths, codes, tokens = [], [], [], [], 0
        if ids:
            yield closed()

    rows = docs.select(F.col(key).cast("long").alias("id"), train.alias("train"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _BLOCK)


def _train_mask(row: dict) -> np.ndarray:
    return np.repeat(unpack(row["train"]).astype(bool), unpack(row["lengths"]))


def ask_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket: which codes, their words, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = [END, *zstandard.decompress(row["words"]).split(b"\n")][: row["vocabulary"]]
                n = np.bincount(unpack(row["codes"]), weights=_train_mask(row), minlength=len(words)).astype(np.int64)
                to = np.array([xxhash.xxh64_intdigest(w) % buckets for w in words])
                order = np.argsort(to, kind="stable")
                rows = []
                for at in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                    text = zstandard.compress(b"\n".join([words[k] for k in at]), 3)
                    rows.append((int(to[at[0]]), row["block"], _rising(at), text, pack(n[at])))
                yield _table(rows, _schema(_WORD)).combine_chunks().to_batches()[0]

    return blocks.select("block", "train", "lengths", "codes", "words", "vocabulary").mapInArrow(run, _WORD)


def answer_words(asked: DataFrame, buckets: int) -> DataFrame:
    """Counts over all blocks: a table row per bucket, and an answer for each block.

    Words are numbered by falling count, so that frequent ones have small numbers.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), table.sort_by("block").to_pylist()
        split = [zstandard.decompress(r["words"]).split(b"\n") for r in rows]
        coded = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
        flat = coded.indices.to_numpy()
        counts = np.zeros(len(coded.dictionary), dtype=np.int64)
        np.add.at(counts, flat, np.concatenate([unpack(r["n"]) for r in rows]))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        stats = [int(counts.sum()), int((counts > 0).sum()), *_stats(counts)]
        words = coded.dictionary.to_pylist()
        asked = np.bincount(flat, minlength=len(counts))
        out = [(bucket, -1, None, None, None, pack(counts[order]), zstandard.compress(b"\n".join([words[k] for k in order]), 3), stats)]
        at = 0
        for row, own in zip(rows, split, strict=True):
            mine = flat[at : at + len(own)]
            out.append((bucket, row["block"], row["at"], pack(rank[mine] * buckets + bucket), pack((asked[mine] > 1).astype(np.int64)), pack(counts[mine]), None, None))
            at += len(own)
        return _table(out, _schema(_UNIGRAM))

    return asked.groupBy("bucket").applyInArrow(run, _UNIGRAM)


@dataclass
class _Grams:
    """The different runs of so many words in a block, with what is known of them over all blocks."""

    token: np.ndarray | None  # for each token, the gram that it ends; -1 where its text began too late for one
    history: np.ndarray  # for each gram, that of the level below without its last word
    suffix: np.ndarray  # and that without its first word
    word: np.ndarray  # its last word
    count: np.ndarray  # training occurrences, in this block until buckets have told those in all
    ids: np.ndarray | None = None  # number over all blocks
    shared: np.ndarray | None = None  # whether other blocks have it


@dataclass
class _Asked:
    """What a block asks buckets: grams, and sums over all grams of a history."""

    grams: np.ndarray
    many: np.ndarray  # grams asked of each history
    histories: np.ndarray
    to: np.ndarray  # and the buckets of these


def _single(row: dict, told: list[dict]) -> _Grams:
    """A block's words, in the order of their numbers over all blocks, which pairs then have too."""
    wide = row["vocabulary"]
    count, ids, shared = (np.zeros(wide, dtype=np.int64) for _ in range(3))
    for a in told:
        if a["level"] == 1:
            at = _risen(a["at"])
            count[at], ids[at], shared[at] = unpack(a["counts"]), unpack(a["ids"]), unpack(a["shared"])
    order = np.argsort(ids, kind="stable")
    new = np.empty(wide, dtype=np.int32)
    new[order] = np.arange(wide)
    none = np.zeros(wide, dtype=np.int32)
    return _Grams(new[unpack(row["codes"])], none, none, np.arange(wide, dtype=np.int32), count[order], ids[order], shared[order] > 0)


def _longer(lower: _Grams, level: int, row: dict) -> _Grams:
    """The grams of one word more, as this block alone knows them. The tokens of the level below are given up."""
    lengths = unpack(row["lengths"])
    # A text's first word follows one end token, which the text before it left here.
    late = np.ones(lengths.sum(), dtype=bool)
    starts = np.cumsum(lengths) - lengths
    for skipped in range(level - 2):
        late[(starts + skipped)[lengths > skipped]] = False
    wide = len(lower.count)
    keys = np.roll(lower.token, 1)[late].astype(np.int64)
    keys *= wide
    keys += lower.token[late]
    lower.token = None
    keys, which = _groups(keys)
    history, suffix = np.empty(len(keys), dtype=np.int32), np.empty(len(keys), dtype=np.int32)
    for s in _slices(len(keys)):
        history[s], suffix[s] = np.divmod(keys[s], wide)
    size = len(keys)
    del keys
    count = np.bincount(which[_train_mask(row)[late]], minlength=size).astype(np.int32)
    token = np.full(len(late), -1, dtype=np.int32)
    token[late] = which
    return _Grams(token, history, suffix, lower.word[suffix], count)


def _questions(grams: _Grams, lower: _Grams, words: _Grams, buckets: int, salt: int) -> _Asked:
    """What must be asked: a history that no other block has is known in full, and so are its grams."""
    wide = len(lower.count)
    _, by_id = _sorted(lower.ids.copy())
    rank = np.empty(wide, dtype=np.int32)
    rank[by_id] = np.arange(wide)
    open_ = lower.shared & (lower.count > 0)
    spread = 1 + lower.count // salt
    mixed = _scramble(lower.ids)

    def place(h: np.ndarray, part: Callable[[slice, np.ndarray], np.ndarray]) -> np.ndarray:
        out = np.empty(len(h), dtype=np.int64)
        for s in _slices(len(h)):
            to = _scramble(mixed[h[s]] + part(s, h[s]).astype(np.uint64)) % np.uint64(buckets)
            out[s] = to.astype(np.int64) * wide + rank[h[s]]
        return out

    asked = np.flatnonzero(open_[grams.history] & (lower.count[grams.suffix] > 0)).astype(np.int32)
    at = place(grams.history[asked], lambda s, h: _scramble(words.ids[grams.word[asked[s]]]) % spread[h].astype(np.uint64))
    here = np.zeros(wide, dtype=bool)
    here[grams.history] = True
    every = np.flatnonzero(here & open_)
    times = spread[every]
    parts = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    entries = place(np.repeat(every, times), lambda s, _: parts[s])
    entries.sort()
    entries = entries[np.diff(entries, prepend=-1) > 0]
    del every, times, parts, mixed, rank
    at, order = _sorted(at)
    many = np.diff(np.searchsorted(at, entries, side="right"), prepend=0)
    return _Asked(asked[order], many, by_id[entries % wide] if wide else entries, entries // wide if wide else entries)


def _answered(
    lower: _Grams, words: _Grams, level: int, last: bool, row: dict, told: list[dict], buckets: int, salt: int
) -> tuple[_Grams, _Asked, list[dict]]:
    """A block's grams of a level over all blocks, with the questions and answers."""
    grams = _longer(lower, level, row)
    asked = _questions(grams, lower, words, buckets, salt)
    answers = sorted((t for t in told if t["level"] == level), key=lambda t: t["bucket"])
    if answers:
        counts = np.concatenate([unpack(t["counts"]) for t in answers])
        grams.count = grams.count.astype(np.result_type(counts, grams.count))
        grams.count[asked.grams] = counts
    if not last:
        grams.shared = np.zeros(len(grams.count), dtype=bool)
        grams.ids = _pairs(grams, words) if level == 2 else np.zeros(len(grams.count), dtype=np.int64)
    if answers and not last:
        grams.shared[asked.grams] = np.concatenate([unpack(t["shared"]) for t in answers]) > 0
        if level > 2:
            grams.ids[asked.grams] = np.concatenate([unpack(t["ids"]) for t in answers])
    return grams, asked, answers


def _pairs(grams: _Grams, words: _Grams) -> np.ndarray:
    """Numbers of pairs over all blocks."""
    if (words.ids >> 31).any():
        raise ValueError("pairs are numbered where there are less than 2^31 different words")
    ids = words.ids[grams.history]
    ids <<= 32
    ids |= words.ids[grams.suffix]
    return ids


def _stats(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, ..., K + 1."""
    return [int(v) for v in np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1 : K + 2]]


def _small(owner: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """For each owner, the sum of its counts (none is 0) over ``K``, then how many it has of 1 to ``K``."""
    of = np.bincount(owner.astype(np.int64) * (K + 1) + np.where(counts <= K, counts, 0), minlength=size * (K + 1)).reshape(-1, K + 1)
    large = counts > K
    of[:, 0] = np.bincount(owner[large], weights=counts[large], minlength=size)
    return of


def ask_grams(blocks: DataFrame, told: DataFrame, level: int, buckets: int, salt: int, width: int) -> DataFrame:
    """For each block and bucket: histories, grams, their training counts, and counts of the grams a word shorter.

    One more row per block has the counts of counts of grams that no other block can have.
    """

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            told = right.to_pylist()
            lower = words = _single(row, told)
            for below in range(2, level):
                lower, _, _ = _answered(lower, words, below, False, row, told, buckets, salt)
            grams = _longer(lower, level, row)
            q = _questions(grams, lower, words, buckets, salt)
            mine = np.ones(len(grams.count), dtype=bool)
            mine[q.grams] = False
            out.append((int(row["block"] % buckets), row["block"], None, None, None, None, None, _stats(grams.count[mine])))
            ends = np.cumsum(q.many)
            for k in np.split(np.arange(len(q.to)), np.flatnonzero(np.diff(q.to)) + 1):
                if len(k):
                    g = q.grams[ends[k[0]] - q.many[k[0]] : ends[k[-1]]]
                    out.append((int(q.to[k[0]]), row["block"], _rising(lower.ids[q.histories[k]]), pack(q.many[k]),
                                pack(words.ids[grams.word[g]]), pack(grams.count[g]), pack(lower.count[grams.suffix[g]]), None))
        return _table(out, _schema(_ASKED))

    own = blocks.select("block", "train", "lengths", "codes", "vocabulary").repartition(width, "block")
    known = told.select("level", "bucket", "block", "at", "counts", "ids", "shared").repartition(width, "block")
    return own.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, _ASKED)


def answer_grams(asked: DataFrame, level: int, last: bool, buckets: int, width: int) -> DataFrame:
    """Counts of grams over all blocks, and of each history the sums that its back-off weight rests on.

    Kind 0 answers a block, kind 1 has counts of counts. The sums of a history:
    of its larger counts, and of grams of each discounted count (``small``), and
    the same of the counts that these grams have without their first word (``held``).
    """

    numbered = level > 2 and not last

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), table.sort_by("block").to_pylist()
        out = [(1, level, bucket, None, None, None, None, None, None, r["stats"]) for r in rows if r["stats"]]
        rows = [r for r in rows if not r["stats"]]
        if not rows:
            return _table(out, _schema(_ANSWER))
        many = [unpack(r["many"]) for r in rows]
        entries = np.concatenate([_risen(r["h"]) for r in rows])
        w, n, below = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("w", "n", "below"))
        own, entry = _groups(entries)
        del entries
        h = np.repeat(entry.astype(np.int64), np.concatenate(many))
        wide = int(w.max()) + 1 if len(w) else 1
        grams, back = _groups(h * wide + w)
        total = np.bincount(back, weights=n, minlength=len(grams)).astype(np.int64)
        shorter = np.zeros(len(grams), dtype=np.int64)
        shorter[back] = below
        some = total > 0
        owner, seen = grams[some] // wide, total[some]
        small, held = _small(owner, seen, len(own)), _small(owner, shorter[some], len(own))
        shared = some & (np.bincount(back, minlength=len(grams)) > 1)
        ids = np.zeros(len(total), dtype=np.int64)
        if numbered:
            # Frequent grams get small numbers; one that a single block has needs none.
            listed = np.flatnonzero(shared)
            listed = listed[np.argsort(-total[listed], kind="stable")]
            ids[listed] = np.arange(len(listed)) * buckets + bucket + 1
        at = np.split(back, np.cumsum([m.sum() for m in many])[:-1])
        into = np.split(entry, np.cumsum([len(m) for m in many])[:-1])
        for row, g, e in zip(rows, at, into, strict=True):
            out.append((0, level, bucket, row["block"], pack(total[g]), pack(ids[g]) if numbered else None, None if last else pack(shared[g].view(np.uint8)), pack(small[e].T.ravel()), pack(held[e].T.ravel()), None))
        out.append((1, level, bucket, None, None, None, None, None, None, _stats(seen)))
        return _table(out, _schema(_ANSWER))

    return asked.repartition(width, "bucket").groupBy("bucket").applyInArrow(run, _ANSWER)


def weights(count: np.ndarray, kept: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha(h), and the factor on discounted counts, of histories.

    ``count`` and ``kept``: the counts of their grams, and these discounted;
    ``mass``: what the level below gives to the words seen.
    """
    aside = np.maximum(1 - kept / count, 1 / (count + 1))
    return aside / (1 - mass), (1 - aside) / kept


def evaluate(
    blocks: DataFrame, told: DataFrame, buckets: int, salt: int, unigrams: Unigrams, found: list[tuple[float, ...]], width: int
) -> DataFrame:
    """Scores of all texts, block by block; ``found``: the discounts of each level."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.to_pylist():
            told = right.to_pylist()
            lower = words = _single(row, told)
            lengths = unpack(row["lengths"])
            starts = np.cumsum(lengths) - lengths
            base = np.log10((words.count + 1) / (unigrams.tokens + unigrams.distinct + 1))
            sums = [np.add.reduceat(v[words.token], starts) for v in ((words.count > 0).astype(np.int64), base)]
            logs, factor = np.log10(unigrams.probability(words.count)), np.array([unigrams.factor])
            best = logs[words.token]
            for level in range(2, len(found) + 1):
                grams, asked, answers = _answered(lower, words, level, level == len(found), row, told, buckets, salt)
                size = len(lower.count)
                # What this block knows of histories that it alone has, then what buckets answered on the others.
                alone = np.flatnonzero((grams.count > 0) & ~lower.shared[grams.history])
                mine, r = grams.history[alone], grams.count[alone]
                count = np.bincount(mine, weights=r, minlength=size).astype(float)
                kept = np.bincount(mine, weights=discounted(r, found[level - 1]), minlength=size).astype(float)
                held = np.bincount(mine, weights=discounted(lower.count[grams.suffix[alone]], found[level - 2]), minlength=size).astype(float)
                del alone, mine, r
                at = 0
                for t in answers:
                    small, below = (unpack(t[name]).reshape(K + 1, -1).T for name in ("small", "held"))
                    h = asked.histories[at : at + len(small)]
                    at += len(small)
                    # No history is twice in one bucket.
                    count[h] += discounted_sum(small, (1.0,) * K)
                    kept[h] += discounted_sum(small, found[level - 1])
                    held[h] += discounted_sum(below, found[level - 2])
                del asked, answers
                alpha, scale = np.ones(size), np.zeros(size)
                for s in _slices(size):
                    some = count[s] > 0
                    alpha[s][some], scale[s][some] = weights(count[s][some], kept[s][some], (held[s] * factor[lower.suffix[s]])[some])
                del count, kept, held
                shorter, logs, alpha = logs, np.empty(len(grams.count)), np.log10(alpha)
                for s in _slices(len(logs)):
                    # A gram that was seen, or the gram without its first word after backing off.
                    h, seen = grams.history[s], grams.count[s] > 0
                    p = discounted(grams.count[s], found[level - 1]) * scale[h]
                    logs[s] = np.where(seen, np.log10(np.where(seen, p, 1.0)), alpha[h] + shorter[grams.suffix[s]])
                for s in _slices(len(best)):
                    own = np.flatnonzero(grams.token[s] >= 0)
                    best[s][own] = logs[grams.token[s][own]]
                lower, factor = grams, scale
                del grams, shorter, alpha, scale
            sums.append(np.add.reduceat(best, starts))
            parts.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array(unpack(row["train"]).astype(bool)), pa.array(lengths, pa.int64()), *map(pa.array, sums)], schema=_schema(_SCORE)))
        return pa.concat_tables(parts) if parts else _table([], _schema(_SCORE))

    own = blocks.select("block", "ids", "train", "lengths", "codes", "vocabulary").repartition(width, "block")
    known = told.select("level", "bucket", "block", "at", "counts", "ids", "shared", "small", "held").repartition(width, "block")
    return own.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, _SCORE)


def _added(stats: DataFrame, size: int) -> list[int]:
    """Sums over one short array of numbers per bucket."""
    row = stats.agg(*[F.coalesce(F.sum(F.col("stats")[k]), F.lit(0)).alias(f"s{k}") for k in range(size)]).first()
    return [row[f"s{k}"] for k in range(size)]


def _step(df: DataFrame, name: str) -> DataFrame:
    """A written table. The shuffles behind it are not read again, and give their disk back at once."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, "false")
    conf.set(RELEASE, "true")
    try:
        return written(df, name)
    finally:
        conf.set(RELEASE, before)


def score(
    docs: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block: int = BLOCK,
    words_asked: int = WORDS,
    grams_asked: int = GRAMS,
    salt: int = SALT,
) -> tuple[DataFrame, Unigrams]:
    """``id``, ``train``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10) of every row.

    ``train`` says which rows the model learns from, ``order`` how many words
    its longest grams have. Also returns what the word probabilities rest on.
    """
    blocks = _step(blocks_of(docs, train, key, text, block), "katz-blocks")
    sizes = blocks.agg(F.sum("vocabulary").alias("words"), F.sum("tokens").alias("tokens"), F.count("*").alias("blocks")).first()
    word_buckets = max(1, math.ceil((sizes["words"] or 0) / words_asked))
    buckets = max(1, math.ceil((sizes["tokens"] or 0) / grams_asked))
    by_block, by_bucket = (max(1, min(n, WIDTH)) for n in (sizes["blocks"], buckets))
    words = _step(answer_words(ask_words(blocks, word_buckets), word_buckets), "katz-words")
    tokens, distinct, *seen = _added(words.where("block < 0"), K + 3)
    unigrams = Unigrams.of(tokens, distinct, seen)
    found = [unigrams.discount]
    told = words.where("block >= 0").select(
        F.lit(1).alias("level"), "bucket", "block", "at", "counts", "ids", "shared", *[F.lit(None).cast("binary").alias(c) for c in ("small", "held")]
    )
    for level in range(2, order + 1):
        asked = ask_grams(blocks, told, level, buckets, salt, by_block)
        grams = _step(answer_grams(asked, level, level == order, buckets, by_bucket), f"katz-{level}")
        found.append(tuple(discounts(_added(grams.where("kind = 1"), K + 1))))
        told = told.unionByName(grams.where("kind = 0").drop("kind", "stats"), allowMissingColumns=True)
    return evaluate(blocks, told, buckets, salt, unigrams, found, by_block), unigrams
