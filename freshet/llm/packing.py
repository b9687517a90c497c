"""Best-fit packing of token sequences by hierarchical residuals.

Tasks tokenise documents, cut those longer than a sequence, and pack their own
pieces best-fit, longest first. Bins that are nearly full are done. The others
go on as items to fewer tasks, which pack them best-fit again, and so on up a
tree. A bin carries its pieces; a sequence holds a bounded number of them.

A task takes a bounded number of items: pieces are packed in runs of at most
``RUN``, and a round of the tree has one task per ``RUN`` bins, dealt anew in
each. The tree ends with one task or when a round merges no bin. That is soon:
best fit leaves at most one bin a task that is no more than half full, and of
two bins that merge one is such a bin.

Defined results: a null or empty text is the end token alone; repeated rows
are packed as often as they occur; an empty table gives an empty table; extra
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import written

TOKENS = 2048
END = (0).to_bytes(4, "little")
# A bin with no more room than this is done.
SLACK = 16
RUN = 100_000
# Parts whose ids a worker remembers, and the bytes of a part it may remember.
CACHED, CACHED_BYTES = 300_000, 64

_PIECE = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"
_BINS = f"used int, pieces array<{_PIECE}>"


# How the tokenizer cuts a lower-case text, for the plain characters below.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Bytes that print as one visible character are that character, the others
    the characters from 256 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def probes() -> list[str]:
    """Texts in which tokenizers show how they cut: every plain character beside letters, digits and marks, and white space."""
    plain = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))]
    parts = [f"a{c} {c}9{c}s'{c} Don't{c}WE'LL''s {c}{c}" for c in plain]
    spaced = ["", " ", "One  two\n\nthree\tfour ", " lead and trail\n", "a\x0bb\x0cc\r\nd", "x\u00a0y \u2003z", "café naïve 12 345 6,7.8 (nine) — ten…"]
    return spaced + [" ".join(parts[k : k + 20]) for k in range(0, len(parts), 20)]


class Ids(dict):
    """Token ids of parts of texts as bytes, four little-endian ones for each.

    A tokenizer that splits at white space before anything else gives a text the
    ids of its parts between ASCII white space. Parts of plain characters
    are cut and given to the tokenizer's model as its own steps would; all
    others go through the whole tokenizer. Short parts are remembered, and
    forgotten together when there are too many.

    Whether a tokenizer works like that is found out when its file is loaded: if
    any of the ``probes`` gets other ids that way, all texts go through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self._words: dict[str, bytes] = {}
        most = max(self._tokenizer.get_vocab().values(), default=-1)
        self._four = [k.to_bytes(4, "little") for k in range(most + 1)]
        self.by_parts = all(self._by_parts(t.encode()) == self._whole(t) for t in probes())

    def _whole(self, text: str) -> bytes:
        return b"".join([self._four[k] for k in self._tokenizer.encode(text, add_special_tokens=False).ids])

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        four = self._four
        found = b"".join([four[t.id] for t in self._model.tokenize(spelt)])
        if len(word) <= CACHED_BYTES:
            self._words[word] = found
        return found

    def __missing__(self, part: bytes) -> bytes:
        text = part.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            words = self._words
            found = b"".join([words.get(w) or self._word(w) for w in _CUT.findall(text.lower())])
        else:
            found = self._whole(text)
        if len(part) <= CACHED_BYTES:
            self[part] = found
        return found

    def _by_parts(self, text: bytes) -> bytes:
        for known in (self, self._words):
            if len(known) > CACHED:
                known.clear()
        return b"".join(map(self.__getitem__, text.split()))

    def of(self, text: bytes | None) -> bytes:
        return self._by_parts(text or b"") if self.by_parts else self._whole((text or b"").decode())


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The encoder of this worker process."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def best_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Items by bin: longest first, each into the fullest bin that has room for it.

    Bins wait in a stack for each amount of room, and one bit of an integer
    says which stacks hold any: the lowest bit from the item's length on is the
    tightest fit.
    """
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[item]
        fits = some >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = waiting[free].pop()
            if not waiting[free]:
                some ^= 1 << free
            bins[at].append(item)
        else:
            free, at = room, len(bins)
            bins.append([item])
        left = free - length
        if left:
            if not waiting[left]:
                some |= 1 << left
            waiting[left].append(at)
    return bins


def _batch(bins: list[tuple[int, list[dict]]]) -> pa.RecordBatch:
    piece = pa.struct(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([b[0] for b in bins], pa.int32()), pa.array([b[1] for b in bins], pa.list_(piece))], ["used", "pieces"]
    )


def _packed(items: list[tuple[int, list[dict]]], room: int) -> Iterator[pa.RecordBatch]:
    """Bins of items, an item being a length and its pieces."""
    found = best_fit([i[0] for i in items], room)
    out = [(sum(items[k][0] for k in b), [p for k in b for p in items[k][1]]) for b in found]
    for at in range(0, len(out), 10_000):
        yield _batch(out[at : at + 10_000])


def pieces_of(doc_id: int | None, ids: bytes, room: int) -> Iterator[tuple[int, list[dict]]]:
    """The pieces of a document's ids, each as an item of its own."""
    for k, at in enumerate(range(0, len(ids), 4 * room)):
        part = ids[at : at + 4 * room]
        piece = {"doc_id": doc_id, "piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
        yield len(part) // 4, [piece]


def local_bins(docs: DataFrame, tokenizer: str, key: str, text: str, room: int) -> DataFrame:
    """The first round: documents to bins, each task for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(tokenizer).of
        items: list[tuple[int, list[dict]]] = []
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                items += pieces_of(doc_id, encode(raw) + END, room)
                if len(items) >= RUN:
                    yield from _packed(items, room)
                    items = []
        if items:
            yield from _packed(items, room)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _BINS)


def _merged(bins: DataFrame, tasks: int, room: int, number: int) -> DataFrame:
    """One round of the tree: bins as items, dealt to so many tasks, in each round otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, list[dict]]] = []
        for batch in batches:
            items += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            # Dealing by hash is even, so only a far larger share comes this way.
            if len(items) >= 2 * RUN:
                yield from _packed(items, room)
                items = []
        if items:
            yield from _packed(items, room)

    return bins.repartition(tasks, F.xxhash64("pieces", F.lit(number))).mapInArrow(run, _BINS)


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", room: int = TOKENS) -> DataFrame:
    """One row per piece: where it is cut from its document, and where it lies in its sequence."""
    full = F.col("used") >= room - SLACK
    bins = written(local_bins(docs, tokenizer, key, text, room), "packing-bins")
    done, rest = [bins.where(full)], bins.where(~full)
    left, number = rest.count(), 0
    while left:
        tasks, number = -(-left // RUN), number + 1
        bins = written(_merged(rest, tasks, room, number), "packing-bins")
        now = bins.count()
        if tasks == 1 or now == left:
            done.append(bins)
            break
        done.append(bins.where(full))
        rest = bins.where(~full)
        left = rest.count()
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    # Offsets are running sums over a sequence's own pieces, in the order they were put in.
    lengths = F.transform("pieces", lambda p: p["length"])
    numbered = every.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces", lengths.alias("lengths"))
    each = numbered.select("sequence_id", "lengths", F.posexplode("pieces").alias("at", "p"))
    before = F.aggregate(F.slice("lengths", F.lit(1), F.col("at")), F.lit(0).cast("long"), lambda total, n: total + n)
    return each.select("p.*", "sequence_id", before.alias("offset"))
