"""N-gram Jaccard join by parity sketches.

A document is its set of word shingles. Two documents link when
``100 * |A n B| >= percent * |A u B|``, so their sets differ in at most
``d = (|A| + |B|) * (100 - percent) // (100 + percent)`` shingles.

*Sketches.* Every shingle flips one bit of a sketch, so equal shingles of two sets
cancel in the XOR of their sketches and its weight, their Hamming distance, never
exceeds the symmetric difference. A set keeps such a parity sketch of a power of two of
bits, four for each shingle at least; of two widths the wider sketch is folded on to the
narrower one.

*Blocks.* For the join, shingles are also dealt by hash to ``d + 1`` and some more
blocks, of each of which the fold (one 64-bit XOR of spread hashes) is kept. By the
pigeonhole principle at least ``blocks - d`` blocks of two linked sets are equal. Blocks
are put in an order that depends on their shingles alone, and a set uses its first
``d + 1``: the first equal block is among them on both sides. The order takes blocks with
a rare shingle first, so that passages that many documents share bring no strangers
together. What is frequent is learnt from ``SAMPLE`` distinct sets (those with the smallest
hashes) and decides speed only, never links.

*Bands.* ``d`` follows from the largest size of a band of sizes, in which the smallest
set could still link with the largest. A set joins its own band and the next one.

*Join.* Equal blocks form a bucket. Members are tied to the smallest one, first within
a task, then of all tasks, so a bucket of any size yields a star and at most one row
per task crosses the network. The connected stars hold every link, but loosely.

*Filter.* Within what is connected, sketches are compared: sets of fitting sizes whose
Hamming distance is at most the difference that a link allows stay tied. What that
connects is a family; no link leaves it.

*Verification.* Families are compared exactly, on whole shingle sets, as products of
membership matrices. Filter and verification cut a group over ``near`` or ``chunk`` members
into chunks by hash and compare pairs of chunks in different tasks; no row per pair is
made, and texts are moved for families only.

Components come from hooking every vertex on to its smallest neighbour and drawing the
edges anew; each round is written to the shared folder. Nothing is collected on the driver.

Identity of sets and shingles is that of 64-bit hashes. Defined cases: words are runs
of bytes other than ASCII white space, A-Z lower-cased; fewer words than a shingle
has are one shingle; without words a document is empty, links with nothing and is its own component; equal
sets link; rows of one id are one document with the smallest id of its sets; a row
without id keeps its size and has no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import Workspace

SLACK = 1.0
CHUNK, NEAR = 1000, 4000
SAMPLE, FREQUENT, LEAST = 8192, 1 << 18, 3
_ROWS_AT_ONCE = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


# --- shingles --------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(65536, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_STEP = _powers(0x9E3779B97F4A7C15)
_LEAP = _powers(pow(0x9E3779B97F4A7C15, 65536, 1 << 64))


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word."""
    b = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    inside = ~_SPACE[b]
    if not inside.any():
        return np.zeros(0, dtype=np.uint64)
    places = np.flatnonzero(inside)
    first = np.flatnonzero(np.diff(places, prepend=-2) > 1)
    sizes = np.diff(np.append(first, len(places)))
    offset = np.arange(len(places)) - np.repeat(first, sizes)
    factor = _STEP[offset & 65535]
    if len(sizes) and sizes.max() > 65536:
        factor = factor * _LEAP[(offset >> 16) & 65535]
    sums = np.add.reduceat((b[places].astype(np.uint64) + np.uint64(1)) * factor, first)
    return _mix(sums + _mix(sizes.astype(np.uint64)))


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles of a text."""
    w = word_hashes(data)
    if not len(w):
        return w
    n = min(words, len(w))
    out = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + w[k : len(w) - n + 1 + k])
    return np.unique(out)


# --- sketches --------------------------------------------------------------------

def band_of(size: int, percent: int) -> tuple[int, int, int]:
    """(number, smallest size, largest size) of the band of a size."""
    number, low = 0, 1
    while True:
        high = 100 * low // percent
        if size <= high:
            return number, low, high
        number, low = number + 1, high + 1


_BANDS: dict[tuple[int, int], list[tuple[int, int]]] = {}


def _bands_joined(size: int, percent: int) -> list[tuple[int, int]]:
    """(band, most shingles two sets of it may differ in) of a size's own band and the next one."""
    if (size, percent) not in _BANDS:
        number, _, high = band_of(size, percent)
        above = 100 * (high + 1) // percent
        _BANDS[size, percent] = [(number, 2 * high * (100 - percent) // (100 + percent)), (number + 1, 2 * above * (100 - percent) // (100 + percent))]
    return _BANDS[size, percent]


class Levels:
    """How frequent shingles are: 0 for those not known as frequent, else the logarithm of their count in a sample."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.levels = hashes[order], np.log2(counts[order]).astype(np.int64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(shingles), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
        return np.where(self.hashes[at] == shingles, self.levels[at], 0)


NO_LEVELS = Levels(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))


def block_keys(shingles: np.ndarray, percent: int, slack: float = SLACK, levels: Levels = NO_LEVELS) -> np.ndarray:
    """Bucket keys of a set: per band, its first ``d + 1`` blocks, those with the rarest shingle and of the most shingles first."""
    out, spread, level = [], _mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), levels.of(shingles)
    for band, d in _bands_joined(len(shingles), percent):
        if not d:
            continue  # only equal sets could link
        blocks = d + 1 + int(np.ceil(slack * (d + 1)))
        block = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[order].astype(np.int64), prepend=-1))
        fold, weight, rarest = np.zeros(blocks, dtype=np.uint64), np.zeros(blocks, dtype=np.int64), np.full(blocks, 64)
        at = block[order][first].astype(np.int64)
        fold[at] = np.bitwise_xor.reduceat(spread[order], first)
        weight[at] = np.diff(np.append(first, len(order)))
        rarest[at] = np.minimum.reduceat(level[order], first)
        number = np.arange(blocks, dtype=np.uint64)
        used = np.lexsort((number, fold, -weight, rarest))[: d + 1]
        out.append(_mix(fold[used] + _mix(number[used] * np.uint64(1 << 20) + np.uint64(band))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """One bit for each place, the parity of the shingles that fall on it; a power of two of places, four per shingle at least."""
    width = max(64, 1 << int(4 * len(shingles) - 1).bit_length())
    place = (_mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=width).astype(np.uint8) & 1).tobytes()


def close_pairs(left: list[tuple[int, bytes]], right: list[tuple[int, bytes]] | None, percent: int, at_once: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of (size, sketch), between two lists or within one, that fit in size and whose sketches differ in no more bits than a link allows."""
    one, others = right is None, left if right is None else right
    by_width: list[dict[int, np.ndarray]] = []
    for rows in (left, others):
        widths = np.array([len(x) for _, x in rows])
        by_width.append({int(w): np.flatnonzero(widths == w) for w in np.unique(widths)})
    found = []
    for w, mine in by_width[0].items():
        for v in (w // 2, w, 2 * w):
            theirs = by_width[1].get(v)
            if theirs is None:
                continue
            a, b = _folded([left[i] for i in mine], min(v, w)), _folded([others[j] for j in theirs], min(v, w))
            size_a, size_b = (np.array([rows[i][0] for i in at], dtype=np.int64) for rows, at in ((left, mine), (others, theirs)))
            step = max(1, at_once // (len(b) * b.shape[1]))
            for k in range(0, len(a), step):
                distance = np.bitwise_count(a[k : k + step, None] ^ b).sum(axis=2, dtype=np.int64)
                sizes = size_a[k : k + step, None]
                ok = (distance * (100 + percent) <= (sizes + size_b) * (100 - percent)) & (100 * np.minimum(sizes, size_b) >= percent * np.maximum(sizes, size_b))
                i, j = np.nonzero(ok)
                i, j = mine[k + i], theirs[j]
                found.append((i[i < j], j[i < j]) if one else (i, j))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 2
    return i, j


def _folded(rows: list[tuple[int, bytes]], width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to a width in bytes."""
    bits = np.frombuffer(b"".join(x for _, x in rows), dtype=np.uint64).reshape(len(rows), -1)
    while bits.shape[1] * 8 > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, smallest member of each, and the ties (smallest, other)) of the buckets in a part of the rows."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    anchor = np.repeat(nodes[first], np.diff(np.append(np.flatnonzero(first), len(keys))))
    other = anchor != nodes
    ties = np.unique(np.stack([anchor[other], nodes[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), dtype=np.int64)
    return keys[first], nodes[first], ties[:, 0], ties[:, 1]


def _rows(key: np.ndarray, node: np.ndarray, tied: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    """Bucket rows (key, member) and ties (smallest, other), told apart by ``tie``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key.view(np.int64), tied])), pa.array(np.concatenate([node, to])), pa.array(np.repeat([False, True], [len(key), len(tied)]))], names=["key", "node", "tie"])


def shingle_levels(texts: DataFrame, firsts: DataFrame, words: int, sample: int = SAMPLE, frequent: int = FREQUENT, least: int = LEAST) -> Levels:
    """Shingles in ``least`` or more of the ``sample`` sets with the smallest hashes: at most ``frequent`` of them, the most frequent ones."""
    chosen = firsts.orderBy(F.xxhash64("node"), "node").limit(sample).select(F.col("v").alias("id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                held.append(shingle_set(x.as_py(), words))
                size += len(held[-1])
                if size >= _ROWS_AT_ONCE:
                    yield summed(held)
                    held, size = [], 0
        if held:
            yield summed(held)

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    counts = texts.join(F.broadcast(chosen), "id").select("data").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(frequent).toArrow()
    return Levels(top.column("h").to_numpy().astype(np.int64).view(np.uint64), top.column("n").to_numpy())


def _ties(sets: DataFrame, words: int, percent: int, levels: Levels) -> DataFrame:
    """Distinct ties (a, b) between the members of all buckets."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, size = [], [], 0
        for batch in batches:
            for x in batch.column(0):
                s = shingle_set(x.as_py(), words)
                if len(s):
                    k = block_keys(s, percent, levels=levels)
                    keys.append(k)
                    nodes.append(np.full(len(k), node_of(s), dtype=np.int64))
                    size += len(k)
                if size >= _ROWS_AT_ONCE:
                    yield _rows(*_stars(np.concatenate(keys), np.concatenate(nodes)))
                    keys, nodes, size = [], [], 0
        if size:
            yield _rows(*_stars(np.concatenate(keys), np.concatenate(nodes)))

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(k).to_numpy(zero_copy_only=False) for k in range(3)] for b in batches if b.num_rows]
        if not parts:
            return
        key, node, ties = (np.concatenate(c) for c in zip(*parts))
        _, _, a, b = _stars(key[~ties], node[~ties])
        a, b = _forest(np.concatenate([key[ties], a]), np.concatenate([node[ties], b]))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    kind = "key bigint, node bigint, tie boolean"
    return sets.mapInArrow(sketch, kind).repartition("key").mapInArrow(tie, "a bigint, b bigint").distinct()


def node_of(shingles: np.ndarray) -> int:
    """Identity of a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


# --- components ------------------------------------------------------------------

def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few ties (smallest, other) as connect what the ties (a, b) connect."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = _roots(i, j, len(names))
    tied = np.flatnonzero(root != np.arange(len(names)))
    return names[root[tied]], names[tied]


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of n positions by the ties (i, j)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def components(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """(v, label): the smallest vertex reachable from every vertex of the edges (a, b).

    In every round each vertex hooks on to its smallest neighbour, if that is smaller,
    and the edges are drawn anew between what their ends hooked on to; a star is
    gone after one round. The rounds' hooks, resolved from the last one back, are the labels.
    """
    def ordered(a: str, b: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()

    rest, hooks, written = space.write(ordered("a", "b", edges), f"{name}-edges-0"), [], []
    while True:
        k = len(hooks)
        written.append(f"{name}-hooks-{k}-0")
        up = space.write(rest.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), written[-1])
        for jump in range(1, 64):  # chains of hooks are cut to their ends in a logarithmic number of jumps
            further = up.select(F.col("v").alias("p"), F.col("p").alias("q"))
            if up.join(further, "p", "left_semi").isEmpty():
                break
            written.append(f"{name}-hooks-{k}-{jump}")
            up = space.write(up.join(further, "p", "left").select("v", F.coalesce("q", "p").alias("p")), written[-1])
        hooks.append(up)
        drawn = rest.join(up.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a", "left").join(up.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        rest = space.write(ordered("na", "pb", drawn.select(F.coalesce("pa", "a").alias("na"), "pb")), f"{name}-edges-{k + 1}")
        space.drop(f"{name}-edges-{k}")
        if rest.isEmpty():
            break
    labels = hooks[-1].select("v", F.col("p").alias("label"))
    for up in reversed(hooks[:-1]):
        above = labels.select(F.col("v").alias("p"), "label")
        labels = up.join(above, "p", "left").select("v", F.coalesce("label", "p").alias("label")).unionAll(labels)
        # a vertex that others hook on to while it hooks itself is met again in the next round
        labels = labels.groupBy("v").agg(F.min("label").alias("label"))
    labels = space.write(labels, f"{name}-hooked")
    space.drop(f"{name}-edges-{len(hooks)}", *written)
    return labels.unionAll(labels.select(F.col("label").alias("v"), "label").distinct())


# --- verification ----------------------------------------------------------------

def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int, columns: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that link, between two lists of sets, or within one; by products of membership matrices."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    names, member = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(member, kind="stable")
    member, owner = member[order], owner[order]
    common = np.zeros((len(left), len(right) if right else len(left)), dtype=np.float32)
    for at in range(0, len(names), columns):
        a, b = np.searchsorted(member, [at, at + columns])
        grid = np.zeros((len(sets), min(columns, len(names) - at)), dtype=np.float32)
        grid[owner[a:b], member[a:b] - at] = 1
        common += grid[: len(left)] @ (grid[len(left) :] if right else grid).T
    shared = np.rint(common).astype(np.int64)
    union = sizes[: len(left), None] + (sizes[None, len(left) :] if right else sizes[None, :]) - shared
    ok = 100 * shared >= percent * union
    if not right:
        ok = np.triu(ok, 1)
    return np.nonzero(ok)


def _chunked(placed: DataFrame, chunk: int) -> DataFrame:
    """``placed`` (family, node, ...) with the number of chunks of its family and its own chunk."""
    chunks = placed.groupBy("family").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks"))
    return placed.join(chunks, "family").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def _compared(members: DataFrame, load, pairs) -> DataFrame:
    """Rows (a, b, links): ties that span the pairs found by each task, and the number of pairs of every vertex in it.

    ``members`` has family, chunks, mine (its chunk), v, node and the columns that
    ``load(node, ...)`` turns into what ``pairs`` compares (or None). A row stands in the
    tasks of all chunk pairs of its chunk.
    """
    data = [c for c in members.columns if c not in ("family", "chunks", "mine", "v")]
    every = members.select("family", "mine", "v", *data, F.explode_outer(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
    dealt = every.select(
        "family", F.least("mine", "with").alias("low"), F.greatest("mine", "with").alias("high"),
        F.when(F.col("mine") == F.col("with"), 2).when(F.col("mine") < F.col("with"), 0).otherwise(1).alias("side"), "v", *data)

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        left = [(v, s) for side, v, s in rows if side != 1]
        right = [(v, s) for side, v, s in rows if side == 1]
        one = all(side == 2 for side, *_ in rows)
        if not left or not (one or right):
            return None
        i, j = pairs([s for _, s in left], None if one else [s for _, s in right])
        if not len(i):
            return None
        names = np.array([v for v, _ in left + right], dtype=np.int64)
        j = j if one else j + len(left)
        count = np.bincount(i, minlength=len(names)) + np.bincount(j, minlength=len(names))
        root = _roots(i, j, len(names))
        has = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(names[root[has]]), pa.array(names[has]), pa.array(count[has].astype(np.int64))], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, last = [], set(), None
        for batch in batches:
            for family, low, high, side, v, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, low, high) != last and held:
                    if (out := solve(held)) is not None:
                        yield out
                    held, seen = [], set()
                last = (family, low, high)
                loaded = None if v in seen else load(*values)
                if loaded is not None:
                    seen.add(v)
                    held.append((side, v, loaded))
        if held and (out := solve(held)) is not None:
            yield out

    sorted_ = dealt.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high")
    return sorted_.select("family", "low", "high", "side", "v", *data).mapInArrow(run, "a bigint, b bigint, links bigint")


def link_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, chunk: int = CHUNK, near: int = NEAR) -> DataFrame:
    """One row per document: id, n_shingles, component_id, n_links (other shingle sets it links with)."""
    return _linked(docs, Workspace(docs.sparkSession, "jaccard"), id_col, text_col, words, percent, chunk, near)


def _linked(docs: DataFrame, space: Workspace, id_col: str, text_col: str, words: int, percent: int, chunk: int, near: int) -> DataFrame:
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("data"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x.as_py(), words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([node_of(s) if len(s) else None for s in found], pa.int64()),
                pa.array([parity_sketch(s) if len(s) else None for s in found], pa.binary())], names=["id", "n_shingles", "node", "sketch"])

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType()), T.StructField("sketch", T.BinaryType())])
    described = space.write(texts.mapInArrow(describe, schema), "described")
    known = texts.where("id is not null")
    # one text stands for all with its set
    firsts = space.write(described.where("id is not null and node is not null").groupBy("node").agg(F.min("id").alias("v")), "firsts")
    ties = space.write(_ties(known.select("data"), words, percent, shingle_levels(known, firsts, words)), "ties")
    loose = components(ties, space, "loose").select(F.col("v").alias("node"), F.col("label").alias("family"))
    met = _chunked(loose.join(firsts, "node"), near).join(described.select(F.col("id").alias("v"), "node", "n_shingles", "sketch"), ["v", "node"])
    fitting = _compared(met.withColumn("v", F.col("node")), lambda node, size, sketch: (size, sketch), lambda x, y: close_pairs(x, y, percent))
    close = space.write(fitting.select("a", "b").distinct(), "close")
    sized = space.write(described.drop("sketch"), "sized")
    space.drop("described", "ties", "loose-hooked")
    families = components(close, space, "family").select(F.col("v").alias("node"), F.col("label").alias("family"))
    placed = space.write(_chunked(families.join(firsts, "node"), chunk), "placed")

    def load(node: int, data: bytes) -> np.ndarray | None:
        found = shingle_set(data, words)
        return found if len(found) and node_of(found) == node else None  # another text of the same id

    held = placed.hint("shuffle_merge").join(known.withColumnRenamed("id", "v"), "v").select("family", "chunks", "mine", "v", "node", "data")
    links = space.write(_compared(held, load, lambda x, y: linked_pairs(x, y, percent)), "links")
    labels = components(links.select("a", "b"), space, "link").select("v", F.col("label").alias("component"))
    counts = links.groupBy(F.col("b").alias("v")).agg(F.sum("links").alias("n_links"))
    reached = space.write(labels.join(counts, "v", "left"), "reached")
    space.drop("close", "family-hooked", "placed", "links", "link-hooked")
    nodes = firsts.join(reached, "v", "left").select("node", F.coalesce("component", "v").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = sized.join(nodes, "node", "left")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, chunk: int = CHUNK, near: int = NEAR) -> DataFrame:
    """The documents, with all their columns, that are the smallest id of their component; rows without id stay."""
    space = Workspace(docs.sparkSession, "near-duplicates")
    linked = _linked(docs, space, id_col, text_col, words, percent, chunk, near).where(F.col("component_id") != F.col(id_col))
    copies = space.write(linked.select(F.col(id_col).alias("id")).distinct(), "copies")
    space.drop("sized", "firsts", "reached")
    dropped = "_dropped"
    while dropped in docs.columns:
        dropped += "_"
    return docs.join(copies.withColumnRenamed("id", dropped), docs[id_col] == F.col(dropped), "left_anti")
