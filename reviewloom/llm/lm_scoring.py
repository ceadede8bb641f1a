"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions, each made in the context of up to ``DEPTH``
bytes before it. A context node holds the counts of zeros and ones of a decision and
their Krichevsky-Trofimov estimate; a node's weighted probability is half its own
estimate and half the product of its children's, so the prediction mixes the
estimates of all depths with weights that the training counts fix. The model is
trained once and then frozen.

No context is left out, at any size of the corpus. Texts are taken in batches of about
``_CHUNK`` bytes; the different byte strings of ``DEPTH + 1`` bytes of a batch, and how
often training texts have them, are dealt out by the last ``SPLIT`` bytes of their
context. All nodes of ``SPLIT`` bytes and more are so worked out inside tasks, each
task with whole subtrees. The nodes above are those of contexts of fewer than ``SPLIT``
bytes, at most 1 + 256 + 65,536 whatever the corpus; they meet on the driver. A second
pass over the same strings finds the probability of each string of each batch, and the
batches get them back by a join. Only decisions that were met have an entry; any other
one takes the estimate of the longest suffix that has met it.

The unigram word model beside it (``base_score``) needs the count of every word. Its
vocabulary grows with the corpus and is never broadcast: words counted at least
``2**k`` times, with the smallest ``k`` that leaves no more than ``FREQUENT`` of them,
are looked up in the task, the others meet their counts in a join.

Defined cases: a null text is an empty one and has the end alone; a null id belongs
to the training part; repeated rows are scored, and learnt from, one by one; without
training text all bytes are equally likely and the base score is that of no counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import Workspace

DEPTH = 5
#: Contexts that share so many last bytes are worked out in one task.
SPLIT = 3
BUCKETS = 1024
FREQUENT = 65_536
LONGEST_FREQUENT = 64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CHUNK = 8_000_000
_POSITIONS_AT_ONCE = 1 << 18
_WORDS_AT_ONCE = 300_000


# --- the byte model --------------------------------------------------------------

def grams_of(data: bytes, depth: int) -> np.ndarray:
    """Numbers made of each byte and the ``depth`` bytes before it (older ones higher); zero bytes stand before the text, and one ends it."""
    b = np.zeros(len(data) + depth + 1, dtype=np.int64)
    b[depth:-1] = np.frombuffer(data, dtype=np.uint8)
    out = b[depth:].copy()
    for d in range(1, depth + 1):
        out |= b[depth - d : len(b) - d] << (8 * d)
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, moved up by eight where it converges fast."""
    y, shift = x + 8.0, np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - shift


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of the 255 binary decisions of every row of byte counts; decision 2**l - 1 + p has prefix p of l bits."""
    zeros, ones, level = [], [], counts.astype(np.float64)
    for _ in range(8):
        zeros.append(level[:, 0::2])
        ones.append(level[:, 1::2])
        level = level[:, 0::2] + level[:, 1::2]
    return np.concatenate(zeros[::-1], axis=1), np.concatenate(ones[::-1], axis=1)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1.0)


def _own_share(log_own: np.ndarray, log_children: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against its children's."""
    return 1.0 / (1.0 + np.exp(np.clip(log_children - log_own, -700, 700)))


def _log_weighted(log_own: np.ndarray, log_children: np.ndarray) -> np.ndarray:
    return np.logaddexp(log_own, log_children) - math.log(2)


_PATHS = [[(2**level - 1 + (byte >> (8 - level)), (byte >> (7 - level)) & 1) for level in range(8)] for byte in range(256)]


def _byte_log10(one: np.ndarray) -> np.ndarray:
    """log10 probability of each byte from the probability of a one in each decision."""
    out = np.zeros((len(one), 256))
    nodes = np.array([[n for n, _ in p] for p in _PATHS])
    bits = np.array([[b for _, b in p] for p in _PATHS], dtype=bool)
    for level in range(8):
        p = one[:, nodes[:, level]]
        out += np.log10(np.where(bits[:, level], p, 1.0 - p))
    return out


class ContextTree:
    """The model in memory, the dense form that the tests hold the tasks against: contexts and, per context, the log10 probability of each byte where no longer context is kept.

    ``keys[d]`` are the sorted contexts of ``d`` bytes, ``rows[d]`` their rows in ``table``.
    """

    def __init__(self, keys: list[np.ndarray], table: np.ndarray):
        self.keys, self.table = keys, table
        self.rows = np.cumsum([0, *[len(k) for k in keys]])
        self.direct = np.full(65536, -1, dtype=np.int64)  # of contexts of two bytes
        if len(keys) > 2:
            self.direct[keys[2]] = self.rows[2] + np.arange(len(keys[2]))

    def log10(self, data: bytes) -> float:
        """Log probability of a text and its end."""
        depth = len(self.keys) - 1
        grams = grams_of(data, depth)
        row, live = np.zeros(len(grams), dtype=np.int64), np.arange(len(grams))
        for d in range(1, depth + 1):
            context = (grams[live] >> 8) & ((1 << (8 * d)) - 1)
            if d == 2:
                found = self.direct[context]
                ok = found >= 0
            else:
                at = np.minimum(np.searchsorted(self.keys[d], context), max(len(self.keys[d]) - 1, 0))
                ok = self.keys[d][at] == context if len(self.keys[d]) else np.zeros(len(context), dtype=bool)
                found = self.rows[d] + at
            live = live[ok]
            row[live] = found[ok]
        return float(np.add.reduce(self.table[row, grams & 255], dtype=np.float64))


def build_tree(counts: list[tuple[np.ndarray, np.ndarray]]) -> ContextTree:
    """Tree from the counts of the kept contexts: per depth the strings (context and next byte) and how often each was met."""
    depth = len(counts) - 1
    sorted_counts = [(g[o], n[o]) for g, n in counts for o in [np.argsort(g)]]
    keys = [np.unique(g >> 8) for g, _ in sorted_counts]
    keys[0] = np.zeros(1, dtype=np.int64)
    first_row = np.cumsum([0, *[len(k) for k in keys]])

    def blocks(d: int, size: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of some contexts of a depth, and their byte counts."""
        grams, n = sorted_counts[d]
        edges = np.searchsorted(grams >> 8, keys[d])
        edges = np.append(edges, len(grams))
        for at in range(0, len(keys[d]), size):
            where = np.arange(at, min(at + size, len(keys[d])))
            part = slice(edges[where[0]], edges[where[-1] + 1])
            dense = np.zeros((len(where), 256))
            dense[np.searchsorted(keys[d][where], grams[part] >> 8), grams[part] & 255] = n[part]
            yield where, dense

    def parents(d: int, where: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys[d - 1], keys[d][where] & ((1 << (8 * (d - 1))) - 1))

    # weighted probabilities from the leaves up; what no kept child accounts for is one more child
    shares: list[np.ndarray] = [np.zeros((len(k), 255), dtype=np.float32) for k in keys]
    rests: list[np.ndarray] = [np.zeros((len(k), 256), dtype=np.float32) for k in keys]
    below = np.zeros((len(keys[depth]), 255))
    for d in range(depth, -1, -1):
        above = np.zeros((len(keys[d - 1]), 255)) if d else None
        for where, dense in blocks(d):
            own = _log_kt(*_decisions(dense))
            if d < depth:
                rest = np.maximum(dense - rests[d][where], 0.0)  # rests[d] holds the children's counts so far
                rests[d][where] = rest
                children = below[where] + _log_kt(*_decisions(rest))
                shares[d][where] = _own_share(own, children)
                own = _log_weighted(own, children)
            else:
                rests[d][where] = dense
            if d:
                up = parents(d, where)
                np.add.at(above, up, own)
                np.add.at(rests[d - 1], up, dense.astype(np.float32))
        below = above

    def estimate(zeros: np.ndarray, ones: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """Of a one; decisions that were never met take the estimate of the node above."""
        return np.where(zeros + ones > 0, (ones + 0.5) / (zeros + ones + 1.0), otherwise)

    # from the root down: what the nodes above contribute to a decision, and the weight left for those below
    table = np.empty((first_row[-1], 256), dtype=np.float32)
    given, weight = [np.zeros((1, 255), dtype=np.float32)], [np.ones((1, 255), dtype=np.float32)]
    last = [np.full((1, 255), 0.5, dtype=np.float32)]
    for d in range(depth + 1):
        new = [np.empty((len(keys[d]), 255), dtype=np.float32) for _ in range(3)]
        for where, dense in blocks(d):
            up = parents(d, where) if d else where
            one = estimate(*_decisions(dense), last[0][up])
            share = shares[d][where] if d < depth else np.ones((len(where), 255), dtype=np.float32)
            mass = given[0][up] + weight[0][up] * share * one
            left = weight[0][up] * (1 - share)
            new[0][where], new[1][where], new[2][where] = mass, left, one
            stop = mass + left * estimate(*_decisions(rests[d][where]), one)
            table[first_row[d] + where] = _byte_log10(np.clip(stop, 1e-9, 1 - 1e-9))
        given, weight, last = [new[0]], [new[1]], [new[2]]
    return ContextTree(keys, table)


def _smallest_power(sizes: dict[int, int], most: int) -> int:
    """Smallest k so that the entries with log2 of at least k are no more than ``most``."""
    k, total = 64, 0
    while k > 0 and total + sizes.get(k - 1, 0) <= most:
        k, total = k - 1, total + sizes.get(k - 1, 0)
    return k


# --- the byte model in parts -----------------------------------------------------

Levels = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
Above = tuple[np.ndarray, np.ndarray]
Found = dict[int, tuple[np.ndarray, np.ndarray]]


def _mask(depth: int, level: int) -> int:
    """Of a key: a context of ``depth`` bytes and ``level`` bits of the next byte."""
    return (1 << (8 * depth + level)) - 1


def climb(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_children: np.ndarray | None, depth: int, low: int, level: int) -> tuple[Levels, tuple]:
    """Nodes from contexts of ``depth`` bytes up to those of ``low``: per depth keys, estimates, own shares and places of the parents; and keys, zeros, ones and children of the parents of the last."""
    levels: Levels = {}
    for d in range(depth, low - 1, -1):
        own = _log_kt(zeros, ones)
        share = np.ones(len(keys)) if log_children is None else _own_share(own, log_children)
        weighted = own if log_children is None else _log_weighted(own, log_children)
        up, parent = np.unique(keys & _mask(d - 1, level), return_inverse=True) if d else (np.zeros(1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64))
        levels[d] = (keys, (ones + 0.5) / (zeros + ones + 1.0), share, parent)
        zeros, ones, log_children = (np.bincount(parent, x, len(up)) for x in (zeros, ones, weighted))
        keys = up
    return levels, (keys, zeros, ones, log_children)


def descend(levels: Levels, above: Above) -> tuple[Found, Above]:
    """Per depth keys and probabilities of a one where no longer context met the decision; what the last nodes hand down."""
    found: Found = {}
    for d in sorted(levels):
        keys, one, share, parent = levels[d]
        given, weight = above[0][parent], above[1][parent]
        above = (given + weight * share * one, weight * (1 - share))
        found[d] = (keys, above[0] + above[1] * one)
    return found, above


def _decisions_of(grams: np.ndarray, n: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, zeros and ones of sorted strings."""
    key, ones = grams >> (8 - level), n * ((grams >> (7 - level)) & 1)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ones, total = np.add.reduceat(ones, starts), np.add.reduceat(n, starts)
    return key[starts], (total - ones).astype(np.float64), ones.astype(np.float64)


def _probability(found: Found, keys: np.ndarray, level: int) -> np.ndarray:
    """Of a one, from the longest suffix that met the decision."""
    out, open_ = np.full(len(keys), 0.5), np.arange(len(keys))
    for d in sorted(found, reverse=True):
        known, p = found[d]
        if not len(known) or not len(open_):
            continue
        wanted = keys[open_] & _mask(d, level)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        ok = known[at] == wanted
        out[open_[ok]] = p[at[ok]]
        open_ = open_[~ok]
    return out


def _bucket(grams: np.ndarray, split: int) -> np.ndarray:
    """Of the last ``split`` bytes of the context."""
    mixed = (((grams >> 8) & _mask(split, 0)) * 0x9E3779B1) & 0xFFFFFFFF
    return (mixed >> 12) % BUCKETS


def _strings_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different strings of a batch by bucket and number, the place of each position's string among them, and the first position of each text."""
    starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    whole = np.empty(starts[-1], dtype=np.int64)
    for x, i, j in zip(texts, starts, starts[1:]):
        whole[i:j] = grams_of(x, depth)
    # piece by piece: numbers and places of the whole batch at once would take several times its memory
    place, found = np.empty(len(whole), dtype=np.int32), []
    for i in range(0, len(whole), _POSITIONS_AT_ONCE):
        some, place[i : i + _POSITIONS_AT_ONCE] = np.unique(whole[i : i + _POSITIONS_AT_ONCE], return_inverse=True)
        found.append(some)
    del whole
    grams = np.unique(np.concatenate(found))
    order = np.argsort(_bucket(grams, min(SPLIT, depth)), kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    for i, some in zip(range(0, len(place), _POSITIONS_AT_ONCE), found):
        place[i : i + _POSITIONS_AT_ONCE] = rank[np.searchsorted(grams, some)][place[i : i + _POSITIONS_AT_ONCE]]
    return grams[order], place, starts[:-1]


def _packed(numbers: np.ndarray) -> bytes:
    """Byte planes of 64-bit numbers, compressed: few differ between the strings of a bucket."""
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 8 * size, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()


def _squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", 1).compress(data, asbytes=True) if data else b""


def _texts_of(sizes: list[int], together: list[bytes | None]) -> list[bytes]:
    """Texts in the order of their keys: the first row of some holds them all, compressed, and every row its length."""
    starts, out = [i for i, x in enumerate(together) if x is not None], []
    for i, j in zip(starts, [*starts[1:], len(sizes)]):
        total, at = sum(sizes[i:j]), 0
        data = pa.Codec("zstd").decompress(together[i], total, asbytes=True) if total else b""
        for size in sizes[i:j]:
            out.append(data[at : at + size])
            at += size
    return out


def _batches(texts: DataFrame, depth: int) -> DataFrame:
    """Rows of two kinds: texts (key, id, size; text: those of up to 256 rows, compressed, in the first of them) and the strings of a batch by bucket (bucket, size, grams, n: how often training texts have each)."""
    schema = T.StructType([
        T.StructField("batch", T.LongType()), T.StructField("key", T.LongType()), T.StructField("id", texts.schema["id"].dataType), T.StructField("text", T.BinaryType()),
        T.StructField("bucket", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("grams", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = key = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        size = 0

        def rows(*columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(columns), names=[f.name for f in schema.fields])

        def flush() -> Iterator[pa.RecordBatch]:
            data = [x.as_py() or b"" for part in held for x in part.column(1)]
            learnt = np.array([x.as_py() for part in held for x in part.column(2)], dtype=bool)
            ids, at = pa.concat_arrays([part.column(0) for part in held]), key - len(data)
            for k in range(0, len(data), 256):
                some = data[k : k + 256]
                none, together = pa.nulls(len(some), pa.binary()), pa.array([_squeezed(b"".join(some)), *[None] * (len(some) - 1)], pa.binary())
                yield rows(pa.array([batch] * len(some), pa.int64()), pa.array(range(at + k, at + k + len(some)), pa.int64()), ids.slice(k, len(some)), together, pa.nulls(len(some), pa.int32()), pa.array([len(x) for x in some], pa.int32()), none, none)
            grams, place, starts = _strings_of(data, depth)
            n = np.bincount(place, np.repeat(learnt, np.diff(np.append(starts, len(place)))), len(grams)).astype(np.int64)
            bucket = _bucket(grams, min(SPLIT, depth))
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            edges = np.append(first, len(grams))
            m = len(first)
            yield rows(
                pa.array([batch] * m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, ids.type), pa.nulls(m, pa.binary()), pa.array(bucket[first].astype(np.int32)), pa.array(np.diff(edges).astype(np.int32)),
                *(pa.array([_packed(x[i:j]) for i, j in zip(edges, edges[1:])], pa.binary()) for x in (grams, n)))

        for whole in batches:
            start = 0
            for i, length in enumerate(pc.binary_length(whole.column(1)).to_pylist()):
                size += (length or 0) + 1
                key += 1
                if size >= _CHUNK:
                    held.append(whole.slice(start, i + 1 - start))
                    yield from flush()
                    held, size, start, batch = [], 0, i + 1, batch + 1
            if start < whole.num_rows:
                held.append(whole.slice(start))
        if held:
            yield from flush()

    return texts.select("id", F.col("text").cast("binary"), "learnt").mapInArrow(run, schema)


def _read_strings(batches: Iterator[pa.RecordBatch]) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Batch, bucket and length of each row of a task; all different strings, their counts, and the place of each row's strings."""
    rows, grams, n = [], [], []
    for b in batches:
        for batch, bucket, size, g, m in zip(*(b.column(k).to_pylist() for k in range(5))):
            grams.append(_unpacked(g, size))
            n.append(_unpacked(m, size))
            rows.append((batch, bucket, size))
    if not rows:
        return [], *[np.zeros(0, dtype=np.int64)] * 3
    different, place = np.unique(np.concatenate(grams), return_inverse=True)
    return rows, different, np.bincount(place, np.concatenate(n), len(different)).astype(np.int64), place


#: Log probabilities that meet in a sum over tasks are whole multiples of this part of a nat, so the sum has no order.
_PART = 2.0**20


def train_upper(strings: DataFrame, depth: int) -> list[tuple[Found, np.ndarray, Above]]:
    """Per bit level the nodes of fewer than ``SPLIT`` bytes: their probabilities, and keys and what they hand down for those of the most bytes."""
    split = min(SPLIT, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, grams, n, _ = _read_strings(batches)
        grams, n = grams[n > 0], n[n > 0]
        for level in range(8 if len(grams) else 0):
            _, (keys, zeros, ones, kids) = climb(*_decisions_of(grams, n, level), None, depth, split, level)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), level, dtype=np.int32)), pa.array(keys), *[pa.array(np.rint(x).astype(np.int64)) for x in (zeros, ones, kids * _PART)]],
                names=["level", "key", "zeros", "ones", "kids"])

    parts = strings.repartition("bucket").mapInArrow(run, "level int, key bigint, zeros bigint, ones bigint, kids bigint")
    rows = parts.groupBy("level", "key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "kids")]).toArrow()  # at most 255 a context of two bytes
    level, keys, *sums = (rows.column(c).to_numpy() for c in ("level", "key", "zeros", "ones", "kids"))
    out = []
    for k in range(8):
        mine = np.flatnonzero(level == k)
        mine = mine[np.argsort(keys[mine])]
        zeros, ones, kids = (x[mine].astype(np.float64) for x in sums)
        levels, _ = climb(keys[mine].astype(np.int64), zeros, ones, kids / _PART, split - 1, 0, k)
        found, above = descend(levels, (np.zeros(1), np.ones(1)))
        out.append((found, found[split - 1][0], above))
    return out


def string_logs(strings: DataFrame, upper: list[tuple[Found, np.ndarray, Above]], depth: int) -> DataFrame:
    """Log10 probabilities (float32) of the strings of each batch and bucket, in their order."""
    split = min(SPLIT, depth)
    shared = strings.sparkSession.sparkContext.broadcast(upper)  # contexts of fewer than ``SPLIT`` bytes only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, grams, n, place = _read_strings(batches)
        logs = np.zeros(len(grams))
        for level in range(8 if len(grams) else 0):
            found, keys, above = shared.value[level]
            if (n > 0).any():
                levels, (up, *_) = climb(*_decisions_of(grams[n > 0], n[n > 0], level), None, depth, split, level)
                at = np.searchsorted(keys, up)
                found = found | descend(levels, (above[0][at], above[1][at]))[0]
            one = np.clip(_probability(found, grams >> (8 - level), level), 1e-9, 1 - 1e-9)
            logs += np.log10(np.where((grams >> (7 - level)) & 1, one, 1.0 - one))
        logs, at = logs.astype(np.float32), 0
        for k in range(0, len(rows), 1024):
            some, values = rows[k : k + 1024], []
            for *_, m in some:
                values.append(logs[place[at : at + m]].tobytes())
                at += m
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int32()), pa.array(values, pa.binary())], names=["batch", "bucket", "logs"])

    return strings.repartition("bucket").mapInArrow(run, "batch bigint, bucket int, logs binary")


# --- words -----------------------------------------------------------------------

def words_of(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of bytes other than ASCII white space."""
    return data.translate(_LOWER).split()


def _count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for x in batch.column(0):
                held.update(words_of(x.as_py() or b""))
                if len(held) >= _WORDS_AT_ONCE:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(vocabulary: DataFrame, most: int) -> dict[bytes, int]:
    short = vocabulary.where(F.octet_length("word") <= LONGEST_FREQUENT)
    sizes = {r["k"]: r["words"] for r in short.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("words")).collect()}  # at most 64 rows
    return {bytes(r["word"]): r["n"] for r in short.where(F.floor(F.log2("n")) >= _smallest_power(sizes, most)).collect()}  # at most ``most`` rows


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether the checksum of an id falls into the part that is never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 5, part: int = 1, depth: int = DEPTH, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    space = Workspace(spark, "lm")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    learnt = texts.where(~held_out(F.col("id"), parts, part))
    dealt = space.write(_batches(texts.withColumn("learnt", ~held_out(F.col("id"), parts, part)), depth), "batches")
    strings = dealt.where("bucket is not null").select("batch", "bucket", "size", "grams", "n")
    upper = train_upper(strings, depth)
    logs = string_logs(strings, upper, depth)
    space.drop()

    vocabulary = space.write(_count_words(learnt), "vocabulary")
    space.drop()
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = learnt.count()  # each text has one end, itself a token
    train_tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    known = {w: math.log10(n + 0.5) for w, n in _frequent(vocabulary, frequent).items()}
    end_log, below = math.log10(ends + 0.5), math.log10(train_tokens + 0.5 * (distinct + 1))

    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("id", texts.schema["id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("known", T.LongType()), T.StructField("logs", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("rare_n", T.ArrayType(T.IntegerType()))])

    def run(texts: pa.Table, logs: pa.Table) -> pa.Table:
        texts = texts.sort_by("key")
        data = _texts_of(texts.column("size").to_pylist(), texts.column("text").to_pylist())
        _, place, starts = _strings_of(data, depth)
        order = np.argsort(logs.column("bucket").to_numpy())
        values = [x.as_py() for x in logs.column("logs")]
        byte_logs = np.frombuffer(b"".join(values[i] for i in order), dtype=np.float32).astype(np.float64)
        scores = np.add.reduceat(byte_logs[place], starts)
        out: list[list] = [[] for _ in range(7)]
        for x, score in zip(data, scores.tolist()):
            words = Counter(words_of(x))
            rare = [(w, n) for w, n in words.items() if w not in known]
            total = sum(words.values())
            sums = math.fsum(n * known[w] for w, n in words.items() if w in known) + end_log
            row = (total + 1, len(x), total - sum(n for _, n in rare) + (ends > 0), sums, score, [w for w, _ in rare], [n for _, n in rare])
            for column, value in zip(out, row):
                column.append(value)
        return pa.Table.from_arrays(
            [texts.column("key"), texts.column("id"), *[pa.array(c, pa.int64()) for c in out[:3]], *[pa.array(c, pa.float64()) for c in out[3:5]],
             pa.array(out[5], pa.list_(pa.binary())), pa.array(out[6], pa.list_(pa.int32()))], names=[f.name for f in schema.fields])

    whole = dealt.where("bucket is null").select("batch", "key", "id", "size", "text")
    scored = space.write(whole.groupBy("batch").cogroup(logs.groupBy("batch")).applyInArrow(run, schema), "scored")
    space.drop("batches")
    rare = scored.select("key", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("key", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("m"))
    met = rare.join(vocabulary, "word", "left").groupBy("key").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("more"), F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest"))
    out = scored.drop("rare", "rare_n").join(met, "key", "left")
    return out.select(
        F.col("id").alias(id_col), held_out(F.col("id"), parts, part).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * below).alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
