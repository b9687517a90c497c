"""SimHash near-duplicate groups by bit-sliced comparison.

Fingerprints are dealt to buckets that equal selected bits; within a bucket, 64
of them at a time are stored as vertical bit planes, one machine word per bit
position. A fingerprint is compared with such a block by XOR with each plane;
full adders sum the differences of all 64 lanes at once, and a block whose
lanes all exceed the radius is dropped before the remaining planes are read.

Equal fingerprints are one node. A bucket hands on a spanning forest of its
links and never its pairs; an oversized bucket is split into pairs of parts
that different tasks compare. Components come from alternating star steps over
those forests, each step a written table.

``representatives`` can confirm links: components of near fingerprints are then
families, within which pairs in the radius are linked only if their sets of
distinct shingles, as 64-bit hashes, are similar enough. Families are cut into
cells by rows and shingles; their sets are shuffled once, large families' sets
once for each part. Equal sets, not equal fingerprints, are one node there.

Defined results: a null text is empty; an empty text has fingerprint zero and
is linked like any other; repeated rows keep their rows; a component without
any non-null id has a null id; an empty table gives an empty table. Further
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from freshet.llm.common import written

SEED = 42
# Fingerprints compared at once in one task; larger buckets are split.
PART = 16_384
# Texts, and shingles, of a family held in one part while links are confirmed.
SET_ROWS, SET_SHINGLES = 4_096, 1 << 22
# Comparisons of two fingerprints in the time that one is dealt to a table and shuffled.
PER_DEAL = 100
# Nodes with more than this share of all links are looked up by every task; there are no more than its inverse.
HEAVY_SHARE = 1_000
_LANES = 64
_BATCH = 32_768
_HASHES = 1 << 15
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def exact_tables(bits: int, radius: int, blocks: int) -> list[list[int]]:
    """Bit positions to equal, so that no pair within the radius is missed.

    Of ``blocks`` runs of bits at most ``radius`` can differ, so the others
    equal: one table for each choice of as many runs.
    """
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    edges = [round(bits * k / blocks) for k in range(blocks + 1)]
    runs = [list(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen, []) for chosen in combinations(runs, blocks - radius)]


def sampled_tables(bits: int, tables: int, width: int) -> list[list[int]]:
    """Bit positions to equal, drawn at random with a fixed seed."""
    draw = np.random.default_rng(SEED)
    return [sorted(int(x) for x in draw.choice(bits, width, replace=False)) for _ in range(tables)]


def met(bits: int, width: int, tables: int, apart: float, radius: int) -> float:
    """The share of pairs that meet in a table and lie within the radius.

    Each of ``bits`` differs with probability ``apart``; a table holds
    ``width`` of them.
    """
    share = 0.0
    for d in range(radius + 1):
        ways = math.lgamma(bits + 1) - math.lgamma(d + 1) - math.lgamma(bits - d + 1)
        weight = math.exp(ways + d * math.log(apart) + (bits - d) * math.log(1 - apart))
        same = math.prod((bits - d - k) / (bits - k) for k in range(width))
        share += weight * (1 - (1 - same) ** tables)
    return share


def tables_for(rows: int, bits: int, similarity: float, radius: int, recall: float) -> list[list[int]]:
    """Sampled tables for so many fingerprints: the cheapest that bring pairs at the similarity together.

    Wider tables hold fewer rows in a bucket, but more of them are needed for
    the recall. A row that is dealt to a table costs as much as ``PER_DEAL``
    comparisons, so the best buckets hold a few dozen rows at any size: each
    row is compared with about as many others however many there are.
    """
    apart = math.acos(2 * similarity / (1 + similarity)) / math.pi
    best: tuple[float, int, int] | None = None
    for width in range(4, 41):
        low, high = 1, 1
        while met(bits, width, high, apart, radius) < recall and high < 1 << 14:
            low, high = high, 2 * high
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if met(bits, width, middle, apart, radius) >= recall else (middle + 1, high)
        cost = high * (1 + rows / 2**width / PER_DEAL)
        if best is None or cost < best[0]:
            best = cost, high, width
    return sampled_tables(bits, best[1], best[2])


def _majority(shingles: list[bytes], lanes: int) -> bytes:
    """The fingerprint of shingles; lane k takes the hash with seed 42 + k."""
    out = []
    for lane in range(lanes):
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(shingles), _HASHES):
            some = np.fromiter(
                (xxhash.xxh64_intdigest(s, SEED + lane) for s in shingles[at : at + _HASHES]), dtype=np.uint64
            )
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint32)
        out.append(np.packbits(2 * counts > len(shingles), bitorder="little").tobytes())
    return b"".join(out)


def _shingles(text: bytes | None, shingle: int) -> list[bytes]:
    """Runs of words; a text of fewer words is one.

    Bytes split on, and lower-case, ASCII characters only.
    """
    parts = (text or b"").lower().split()
    if len(parts) < shingle:
        return [b" ".join(parts)] if parts else []
    return [b" ".join(w) for w in zip(*[parts[k:] for k in range(shingle)], strict=False)]


def fingerprint(text: bytes | None, shingle: int, lanes: int = 1, repeats: bool = True) -> bytes:
    """``lanes`` times eight bytes, little-endian; zero for a text without words.

    Without ``repeats`` each distinct shingle votes once.
    """
    found = _shingles(text, shingle)
    found = found if repeats else list(set(found))
    return _majority(found, lanes) if found else bytes(8 * lanes)


def hashed(text: bytes | None, shingle: int) -> np.ndarray:
    """The hashes of the distinct shingles of a text, ascending."""
    found = set(_shingles(text, shingle))
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found)))


def mark_of(hashes: np.ndarray) -> bytes:
    """Sixteen bytes that name a set of shingles."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int, lanes: int = 1) -> DataFrame:
    """``id`` and ``fp`` (binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A view of the UTF-8 bytes: no Python strings are made.
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = pa.array([fingerprint(t, shingle, lanes) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["id", "fp"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, fp binary"
    )


def marked(docs: DataFrame, key: str, text: str, shingle: int, lanes: int) -> DataFrame:
    """``id``, ``fp``, and the name ``mark`` and size ``shingles`` of the set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, marks, sizes = [], [], []
            for t in batch.column(1).cast(pa.binary()).to_pylist():
                hashes = hashed(t, shingle)
                fps.append(fingerprint(t, shingle, lanes, repeats=False))
                marks.append(mark_of(hashes))
                sizes.append(len(hashes))
            found = [pa.array(fps, pa.binary()), pa.array(marks, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["id", "fp", "mark", "shingles"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, fp binary, mark binary, shingles long"
    )


def planes_of(blocks: np.ndarray) -> np.ndarray:
    """Bit planes (blocks, bits) of fingerprints given as (blocks, 64 lanes, bytes)."""
    bits = np.unpackbits(blocks, axis=2, bitorder="little")
    sliced = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(sliced).view(np.uint64)[:, :, 0]


def _full_add(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def within(planes: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (block, fingerprint): those with a lane within the radius, and these lanes.

    ``planes`` and ``query`` have a row for each pair: the block's planes, and
    for each bit all ones or zeros. Seven planes at a time go through a tree of
    carry-save adders; the three-bit sum is added to vertical counters. They
    start so high that a lane overflows as soon as it exceeds the radius.
    """
    pairs, bits = planes.shape
    width = max(3, (radius + 1).bit_length())
    start = (1 << width) - 1 - radius
    alive = np.arange(pairs)
    counter = [np.full(pairs, _ONES if start >> k & 1 else 0, dtype=np.uint64) for k in range(width)]
    over = np.zeros(pairs, dtype=np.uint64)
    for at in range(0, bits, 7):
        x = [planes[alive, k] ^ query[alive, k] for k in range(at, min(at + 7, bits))]
        x += [np.zeros(len(alive), dtype=np.uint64)] * (7 - len(x))
        s1, c1 = _full_add(x[0], x[1], x[2])
        s2, c2 = _full_add(x[3], x[4], x[5])
        one, c3 = _full_add(s1, s2, x[6])
        two, four = _full_add(c1, c2, c3)
        carry = np.uint64(0)
        for k in range(width):
            add = (one, two, four)[k] if k < 3 else np.uint64(0)
            counter[k], carry = _full_add(counter[k], add, carry)
        over |= carry
        keep = over != _ONES
        if not keep.all():
            alive, over = alive[keep], over[keep]
            counter = [c[keep] for c in counter]
            if not len(alive):
                break
    return alive, ~over


def _hook(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i] for all i: the least index of each component."""
    while len(a):
        la, lb = labels[a], labels[b]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while True:
            deeper = labels[labels]
            if np.array_equal(deeper, labels):
                break
            labels = deeper
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
    return labels


def confirming(codes: np.ndarray, edges: np.ndarray, similarity: float) -> Callable:
    """A ``_hook`` that joins only rows whose sets have this Jaccard similarity.

    Row r has the distinct codes ``codes[edges[r]:edges[r + 1]]``. Rows that
    are joined already are not compared. Equal ``a`` must be adjacent.
    """
    held = np.zeros(int(codes.max()) + 1 if len(codes) else 1, dtype=bool)
    sizes = np.diff(edges)

    def join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True]) if len(a) else []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            row, others = a[lo], b[lo:hi]
            others = others[(labels[others] != labels[row]) & (sizes[others] > 0)]
            small, large = np.minimum(sizes[row], sizes[others]), np.maximum(sizes[row], sizes[others])
            others = others[small / large >= similarity]
            if not len(others):
                continue
            mine = codes[edges[row] : edges[row + 1]]
            held[mine] = True
            theirs = np.concatenate([codes[edges[o] : edges[o + 1]] for o in others])
            shared = np.add.reduceat(held[theirs], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            held[mine] = False
            alike = others[shared / (sizes[row] + sizes[others] - shared) >= similarity]
            labels = _hook(labels, np.full(len(alike), row), alike)
        return labels

    return join


def forest(fps: np.ndarray, cells: np.ndarray, radius: int, join: Callable = _hook) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, least row of its component) over rows of the same cell within the radius.

    ``fps``: (rows, bytes); ``cells``: the cell of each row, equal ones adjacent;
    ``join`` gets the pairs within the radius.
    """
    n, width = fps.shape
    bounds = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1], True])
    sizes = np.diff(bounds)
    blocks_in = -(-sizes // _LANES)
    block_cell = np.repeat(np.arange(len(sizes)), blocks_in)
    order_in = np.arange(len(block_cell)) - np.repeat(np.cumsum(blocks_in) - blocks_in, blocks_in)
    first = bounds[block_cell] + order_in * _LANES
    last = np.minimum(first + _LANES, bounds[block_cell + 1])
    lanes = np.minimum(first[:, None] + np.arange(_LANES), last[:, None] - 1)
    planes = planes_of(fps[lanes])
    bits = np.unpackbits(fps, axis=1, bitorder="little").astype(bool)
    labels = np.arange(n)
    # Row r meets the blocks of its cell that end after it.
    cell_of = np.repeat(np.arange(len(sizes)), sizes)
    first_block = (np.cumsum(blocks_in) - blocks_in)[cell_of]
    own_block = first_block + (np.arange(n) - bounds[cell_of]) // _LANES
    meets = first_block + blocks_in[cell_of] - own_block
    ends = np.cumsum(meets)
    done = 0
    while done < n:
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _BATCH, "right")))
        rows = np.repeat(np.arange(done, upto), meets[done:upto])
        step = np.arange(len(rows)) - np.repeat(ends[done:upto] - meets[done:upto] - (ends[done - 1] if done else 0), meets[done:upto])
        block = own_block[rows] + step
        hit, found = within(planes[block], np.where(bits[rows], _ONES, np.uint64(0)), radius)
        if len(hit):
            lane = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, place = np.nonzero(lane)
            a, b = rows[hit][pair], first[block[hit]][pair] + place
            real = (b > a) & (b < last[block[hit]][pair])
            labels = join(labels, a[real], b[real])
        done = upto
    linked = np.flatnonzero(labels != np.arange(n))
    return linked, labels[linked]


def _keys(fps: np.ndarray, tables: list[list[int]]) -> np.ndarray:
    """The value of each table's bits, (rows, tables), with the table's number on top."""
    bits = np.unpackbits(fps, axis=1, bitorder="little").astype(np.int64)
    weights = [1 << np.arange(len(t), dtype=np.int64) for t in tables]
    return np.stack([(k << 48) | bits[:, t] @ w for k, (t, w) in enumerate(zip(tables, weights, strict=True))], axis=1)


def _by_cell(packed: DataFrame, first: str, compare: Callable) -> DataFrame:
    """Links ``u``, ``v`` that ``compare`` finds in rows sorted by cell: ``first``, ``p``, ``q``.

    ``compare`` takes a table of whole cells and the cell of each row, and gives
    the rows' names and the links (row, row).
    """
    keys = (first, "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            table = pa.Table.from_batches(rows).combine_chunks()
            same = np.ones(table.num_rows - 1, dtype=bool)
            for name in keys:
                value = table.column(name).to_numpy()
                same &= value[1:] == value[:-1]
            names, a, b = compare(table, np.cumsum(np.r_[False, ~same]))
            if not len(a):
                return None
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array(a)).combine_chunks(), names.take(pa.array(b)).combine_chunks()], ["u", "v"]
            )

        def last_cell(batch: pa.RecordBatch) -> int:
            """Where the last cell of a batch begins."""
            differs = np.zeros(batch.num_rows, dtype=bool)
            for name in keys:
                value = batch.column(name).to_numpy()
                differs |= value != value[-1]
            ends = np.flatnonzero(differs)
            return int(ends[-1]) + 1 if len(ends) else 0

        def cell(batch: pa.RecordBatch, row: int) -> tuple:
            return tuple(batch.column(name)[row].as_py() for name in keys)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and cell(held[-1], -1 % held[-1].num_rows) != cell(batch, 0):
                found = flush(held)
                held = []
                if found is not None:
                    yield found
            cut = last_cell(batch)
            if cut:
                found = flush([*held, batch.slice(0, cut)])
                held = []
                if found is not None:
                    yield found
            held.append(batch.slice(cut))
        if held:
            found = flush(held)
            if found is not None:
                yield found

    return packed.mapInArrow(run, "u binary, v binary")


def links(nodes: DataFrame, radius: int, tables: list[list[int]], part: int = PART) -> DataFrame:
    """Links ``u``, ``v`` whose components are those of all pairs within the radius.

    ``nodes`` has one row per fingerprint ``fp``. A bucket of more than ``part``
    rows is cut into parts, and each pair of parts is a cell of its own.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(0)
            fps = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            keys = _keys(fps, tables).ravel()
            at = pa.array(np.repeat(np.arange(batch.num_rows), len(tables)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), raw.take(at)], ["bucket", "fp"])

    dealt = nodes.select("fp").mapInArrow(deal, "bucket long, fp binary")
    crowded = (
        nodes.select("fp")
        .mapInArrow(deal, "bucket long, fp binary")
        .groupBy("bucket")
        .agg(F.count("*").alias("size"))
        .where(F.col("size") > part)
        .select("bucket", F.ceil(F.col("size") / part).cast("int").alias("parts"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = (
        dealt.join(written(crowded, "simhash-crowded"), "bucket", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("bucket", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "fp")
    )
    packed = cells.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "fp")

    def compare(table: pa.Table, cells: np.ndarray) -> tuple:
        fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        return table.column("fp"), *forest(fps, cells, radius)

    return _by_cell(packed, "bucket", compare).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node ``root`` of its component, for nodes with a link.

    Alternating steps: every node links its larger neighbours, then its smaller
    ones, to the least node it knows. Ends when a round changes nothing: each
    node then has one link, to its root.
    """

    def state(table: DataFrame) -> tuple:
        row = table.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    seen = state(now)
    while seen[0]:
        # What a node is linked to: its least neighbour if that is smaller, else itself.
        lower = written(now.groupBy("u").agg(F.min("v").alias("m")), "star-lower").withColumnRenamed("u", "v")
        # Most links hang on few nodes. Their one row each goes to the links, so that no task gets all
        # links of a node; every other node has fewer links than the share that makes one heavy.
        heavy = now.groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") * HEAVY_SHARE > seen[0]).select("v")
        heavy = written(heavy.join(lower, "v", "left").select("v", F.coalesce("m", "v").alias("m")), "star-heavy")
        told = now.join(F.broadcast(heavy), "v", "left")
        rest = told.where("m IS NULL").drop("m").join(lower.hint("merge"), "v", "left")
        large = told.where("m IS NOT NULL").select("u", F.col("m").alias("v"))
        large = large.unionByName(rest.select("u", F.coalesce("m", "v").alias("v"))).distinct()
        large = written(large, "star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "star")
        before, seen = seen, state(now)
        if before == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(docs: DataFrame, key: str, text: str, shingle: int, radius: int, lanes: int, tables) -> tuple:
    """Fingerprints of the rows; and for each one its least id and its component's root."""
    tables = tables or exact_tables(64 * lanes, radius, radius + 2)
    prints = written(fingerprints(docs, key, text, shingle, lanes), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    tables = tables(nodes.count()) if callable(tables) else tables
    stars = components(written(links(nodes, radius, tables), "simhash-links"))
    root = F.coalesce("root", "fp").alias("root")
    return prints, nodes.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", root)


def groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    lanes: int = 1,
    tables: list[list[int]] | None = None,
) -> DataFrame:
    """``id``, ``fp`` and ``component`` (least id reachable) of every row.

    With ``lanes`` over 1 the fingerprint has 64 bits for each. Without
    ``tables`` every pair within the radius is found; given tables may trade
    that for less work.
    """
    prints, rooted = _rooted(docs, key, text, shingle, radius, lanes, tables)
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    by_print = written(rooted.join(named, "root").select("fp", "component"), "simhash-names")
    return prints.join(by_print, "fp").select("id", "fp", "component")


def _wanted_rows(docs: DataFrame, key: str, text: str, wanted: DataFrame, often: DataFrame, mark: Callable) -> DataFrame:
    """The columns of ``wanted``, and a row of ``docs`` as ``row``, for each of its ids and marks.

    An id of one row alone names its row, so texts are joined by id. Rows that
    share an id, or have none (``often``), are told apart by ``mark`` of their
    text, made again for them alone; of rows that agree in both, any one stays.
    """
    alone = wanted.join(often, wanted["id"].eqNullSafe(often["id"]), "left_anti")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"))
    # There are as many ids as groups, which nothing bounds: they are never sent to every task.
    single = rows.join(alone.hint("merge"), "id").select(*wanted.columns, "row")
    shared = rows.withColumn("text", F.col(f"row.{text}")).alias("s")
    shared = shared.join(often.alias("o"), F.col("s.id").eqNullSafe(F.col("o.id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = pa.array([mark(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), found], ["row", "id", "mark"])

    schema = StructType([shared.schema["row"], StructField("id", LongType()), StructField("mark", BinaryType())])
    told = shared.mapInArrow(run, schema).alias("s")
    same = F.col("s.id").eqNullSafe(F.col("f.id")) & (F.col("s.mark") == F.col("f.mark"))
    kept = told.join(wanted.alias("f"), same).select("f.*", "row").groupBy(*wanted.columns).agg(F.first("row").alias("row"))
    return single.unionByName(kept)


def _repeated(prints: DataFrame) -> DataFrame:
    """The ids that do not name a row."""
    often = prints.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").select("id")
    return written(often, "simhash-repeated-ids")


def _confirmed(
    docs: DataFrame, key: str, text: str, shingle: int, radius: int, lanes: int, tables, similarity: float
) -> tuple:
    """Ids that do not name a row; and for each set of shingles its least id and its component's root."""
    tables = tables or exact_tables(64 * lanes, radius, radius + 2)
    prints = written(marked(docs, key, text, shingle, lanes), "simhash")
    often = _repeated(prints)
    least = [F.min("id").alias("least"), F.min("fp").alias("fp"), F.first("shingles").alias("shingles")]
    nodes = written(prints.groupBy("mark").agg(*least), "simhash-nodes")
    distinct = written(nodes.select("fp").distinct(), "simhash-prints")
    chosen = tables(distinct.count()) if callable(tables) else tables
    found = links(distinct, radius, chosen)
    stars = components(written(found, "simhash-links")).withColumnRenamed("node", "fp")
    # Two families of one hash are compared as one.
    family = F.xxhash64(F.coalesce("root", "fp")).alias("family")
    named = written(nodes.join(stars, "fp", "left").select("mark", "least", "fp", "shingles", family), "simhash-families")
    parts = F.greatest(F.ceil(F.count("*") / SET_ROWS), F.ceil(F.sum("shingles") / SET_SHINGLES)).cast("int")
    many = named.groupBy("family").agg(F.count("*").alias("n"), parts.alias("parts")).where("n > 1").drop("n")
    wanted = named.join(written(many, "simhash-many"), "family")
    wanted = written(wanted.select(F.col("least").alias("id"), "mark", "fp", "family", "parts"), "simhash-wanted")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = _wanted_rows(texts, "key", "text", wanted, often, lambda t: mark_of(hashed(t, shingle)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashed(t, shingle).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rest = ["mark", "fp", "family", "parts"]
            columns = [batch.column(name) for name in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], [*rest, "hashes"])

    sets = texts.select("mark", "fp", "family", "parts", "row.text").mapInArrow(
        run, "mark binary, fp binary, family long, parts int, hashes binary"
    )
    cells = (
        sets.withColumn("mine", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("family", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mark", "fp", "hashes")
    )
    packed = cells.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q", "mark")

    def compare(table: pa.Table, cells: np.ndarray) -> tuple:
        fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        raw = table.column("hashes").to_pylist()
        edges = np.cumsum([0, *(len(x) // 8 for x in raw)])
        codes = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)[1]
        return table.column("mark"), *forest(fps, cells, radius, confirming(codes, edges, similarity))

    near = components(written(_by_cell(packed, "family", compare).distinct(), "simhash-confirmed"))
    root = F.coalesce("root", "mark").alias("root")
    return often, named.join(near.withColumnRenamed("node", "mark"), "mark", "left").select("mark", "least", root)


def representatives(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    lanes: int = 1,
    tables: list[list[int]] | Callable[[int], list[list[int]]] | None = None,
    similarity: float | None = None,
) -> DataFrame:
    """One row of each group, with all its columns: one of the least id.

    ``tables`` may be a function of the number of fingerprints, as
    ``tables_for`` is.

    With ``similarity`` a pair is linked only if, besides its fingerprints, its
    sets of distinct shingles have that Jaccard similarity at least; repeats of a
    shingle then have no vote in the fingerprint either.
    """
    if similarity is None:
        prints, rooted = _rooted(docs, key, text, shingle, radius, lanes, tables)
        often, rooted = _repeated(prints), rooted.withColumnRenamed("fp", "mark")
    else:
        often, rooted = _confirmed(docs, key, text, shingle, radius, lanes, tables, similarity)
    least = F.min(F.struct(F.col("least").isNull(), F.col("least").alias("id"), F.col("mark"))).alias("first")
    firsts = written(rooted.groupBy("root").agg(least).select("first.id", "first.mark"), "simhash-firsts")

    def mark(t: bytes | None) -> bytes:
        return fingerprint(t, shingle, lanes) if similarity is None else mark_of(hashed(t, shingle))

    return _wanted_rows(docs, key, text, firsts, often, mark).select("row.*")
