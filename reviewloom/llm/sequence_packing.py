"""Best-fit packing of token sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The linear
program asks for the fewest configurations that cover the length histogram. It is
solved by multiplicative weights: every length has a price that falls as it gets
covered, a knapsack dynamic program finds the configuration of highest price, and
the configuration is used until one of its lengths is covered once more. The
averaged solution is rounded down to a share of its configurations without a gap
(the others would use up the short pieces that fill gaps at the end), and what is
left over goes best-fit decreasing. Of the plans for the shares in ``SHARES`` the one
with the fewest sequences is taken; share 0 is best fit alone, so the result is never
worse than that.

Only the histogram (at most ``capacity`` rows) is on the driver, and the plan it
yields is bounded by the capacity and the number of rounds, not by the data. Pieces
find their place from their rank among the pieces of their length: ranks are
counted per (length, hash salt), so a length that a third of all pieces have is
spread over ``SALTS`` groups.

Defined cases: a null text is an empty one and yields the end token alone; repeated
rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewloom.session import Workspace

SALTS = 256
#: Shares of the configurations that are rounded to sequences; of equally good plans that of the earlier share is taken.
SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0)
#: Pieces between spaces, and pre-tokens, that a worker keeps with their ids: up to these numbers, twice (see ``_Kept``).
_CACHE_PIECES, _CACHE_WORDS = 640_000, 240_000
#: The signs that every Unicode version and regular-expression engine splits alike; other texts are encoded whole.
_PLAIN = r"[^\x00-\x1b\x20-\x84\x86-ȳ‐-‧]|<\|endoftext\|>"


# --- token ids -------------------------------------------------------------------

class _Kept(dict):
    """Results of ``find`` by text. When ``most`` are held they become the older ones, of which those met again move up and the rest is dropped."""

    def __init__(self, find: Callable[[str], bytes], most: int):
        super().__init__()
        self.find, self.most, self.older = find, most, {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.find(text)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found


class _Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    No pre-token reaches over a space before another sign, and what stands on one side
    of such a space does not change the pre-tokens of the other. So a text is taken
    apart at its spaces, and the ids of each part (with its space) are kept; texts with
    a space before white space or at the end are split by the pre-tokenizer's pattern.
    """

    def __init__(self, tokenizer_path: str):
        import re

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenize = self.tokenizer.model.tokenize
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.unusual, self.spaced = re.compile(_PLAIN).search, re.compile(r" (?:\s|$)").search
        self.words = _Kept(self._word, _CACHE_WORDS)
        self.pieces = _Kept(lambda x: self._part(" " + x), _CACHE_PIECES)

    def _word(self, word: str) -> bytes:
        return np.array([t.id for t in self.tokenize("".join([_BYTE_SIGNS[b] for b in word.encode()]))], dtype="<u4").tobytes()

    def _part(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        if self.unusual(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self.spaced(text):
            return self._part(text)
        first, *rest = text.split(" ")
        return self._part(first) + b"".join(map(self.pieces.__getitem__, rest))


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()
_ENCODERS: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: only the first may be shorter than the capacity."""
    if n <= capacity:
        return [n]
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, *, id_col: str, text_col: str, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Rows (id, piece, start, length, ids): token ids of every text as little-endian 32-bit blobs, cut at the capacity."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounds what is held at once
                part = batch.slice(at, 512)
                rows, numbers, starts, lengths, blobs = [], [], [], [], []
                for i, blob in enumerate(encoder.encode(x or "") for x in part.column(1).to_pylist()):
                    blob, start = blob + end, 0
                    for k, n in enumerate(cut_lengths(len(blob) // 4, capacity)):
                        rows.append(i)
                        numbers.append(k)
                        starts.append(start)
                        lengths.append(n)
                        blobs.append(blob[4 * start : 4 * (start + n)])
                        start += n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(blobs, pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"])

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text" if id_col != "text" else "text_")).mapInArrow(run, schema)


# --- the plan --------------------------------------------------------------------

def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size of the knapsack of highest price (unbounded knapsack by dynamic programming)."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fitting[c]
        value[c] = value[c - 1]
        if k:
            gains = value[c - sizes[:k]] + prices[:k]
            j = int(gains.argmax())
            if gains[j] > value[c]:
                value[c], choice[c] = gains[j], j
    counts, c = np.zeros(len(sizes), dtype=np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return counts


def fractional_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: float = 2.0, rate: float = 0.5) -> dict[bytes, float]:
    """Configurations and how often each is used, covering every length ``1.0`` times on average."""
    covered, used = np.zeros(len(sizes)), {}
    while covered.min() < rounds:
        prices = np.where(covered < rounds, (1 - rate) ** covered, 0.0) * sizes / capacity
        # lengths covered to the full still fill gaps, at a price below any that is wanted
        prices += 1e-6 * sizes / capacity
        counts = _best_configuration(sizes, prices, capacity)
        has = counts > 0
        step = float((demand[has] / counts[has]).min())
        covered[has] += step * counts[has] / demand[has]
        used[counts.tobytes()] = used.get(counts.tobytes(), 0.0) + step
    return {k: v / rounds for k, v in used.items()}


def best_fit_decreasing(left: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins for a histogram of lengths: longest first, each into the fullest bin that takes it. Equal bins are counted."""
    room: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]  # by room left: contents -> bins
    for size in sorted(left, reverse=True):
        n = left[size]
        while n > 0:
            space = next((r for r in range(size, capacity) if room[r]), None)
            contents, bins = room[space].popitem() if space is not None else ((), None)
            space = capacity if space is None else space
            fits = space // size
            if bins is None:
                bins = max(1, n // fits)
            full = min(bins, n // fits)
            if full:
                new = contents + (size,) * fits
                room[space - size * fits][new] = room[space - size * fits].get(new, 0) + full
                n, bins = n - full * fits, bins - full
            if bins and 0 < n < fits:
                new = contents + (size,) * n
                room[space - size * n][new] = room[space - size * n].get(new, 0) + 1
                n, bins = 0, bins - 1
            if bins and contents:
                room[space][contents] = room[space].get(contents, 0) + bins
    return [(list(c), n) for r in room for c, n in r.items()]


def plan_sequences(histogram: dict[int, int], capacity: int, rounds: float = 2.0, shares: tuple[float, ...] = SHARES) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, number of such sequences), using every piece of the histogram once."""
    left = {int(k): int(v) for k, v in histogram.items() if v > 0 and k < capacity}
    plan = [([capacity], int(histogram[capacity]))] if histogram.get(capacity) else []
    if not left:
        return plan
    sizes = np.array(sorted(left), dtype=np.int64)
    demand = np.array([left[int(s)] for s in sizes], dtype=np.float64)
    uses = [(np.frombuffer(k, dtype=np.int64), v) for k, v in fractional_configurations(sizes, demand, capacity, rounds).items()]
    # only configurations without a gap are rounded to sequences; the rest is left over for best fit
    uses = sorted((u for u in uses if int(u[0] @ sizes) == capacity), key=lambda x: (-x[1], x[0].tobytes()))
    return plan + min((_rounded(sizes, demand, uses, share, capacity) for share in shares), key=lambda bins: sum(n for _, n in bins))


def _rounded(sizes: np.ndarray, demand: np.ndarray, uses: list[tuple[np.ndarray, float]], share: float, capacity: int) -> list[tuple[list[int], int]]:
    """Sequences for all pieces: ``share`` of each configuration's use, then best fit for what is left."""
    rest, plan = demand.astype(np.int64), []
    for counts, much in uses:
        has = counts > 0
        n = int(min(np.floor(share * much), (rest[has] // counts[has]).min()))
        if n > 0:
            rest[has] -= n * counts[has]
            plan.append((np.repeat(sizes, counts)[::-1].tolist(), n))
    return plan + best_fit_decreasing({int(s): int(r) for s, r in zip(sizes, rest) if r}, capacity)


def _places(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, last rank, pieces per sequence, first sequence, offset): where the pieces of these ranks go."""
    rows, taken, base = [], {}, 0
    for lengths, n in plan:
        offset = 0
        for size in dict.fromkeys(lengths):
            per = lengths.count(size)
            first = taken.get(size, 0)
            taken[size] = first + per * n
            rows.append((size, first, taken[size] - 1, per, base, offset))
            offset += per * size
        base += n
    return rows


# --- pieces to places ------------------------------------------------------------

def pack_documents(
    docs: DataFrame, *, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024,
    content: Callable[[Column], Column] | None = None, rounds: float = 2.0,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ``content``, sequence_id, offset.

    ``content`` is made of the token blob before anything is moved; by default it is the blob itself.
    """
    space = Workspace(docs.sparkSession, "packing")
    pieces = token_pieces(docs, id_col=id_col, text_col=text_col, tokenizer_path=tokenizer_path, end_id=end_id, capacity=capacity)
    pieces = pieces.withColumn("ids", content(F.col("ids")) if content else F.col("ids")).withColumnRenamed("ids", "content")
    pieces = space.write(pieces, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = docs.sparkSession.createDataFrame(_places(plan_sequences(histogram, capacity, rounds)), "length bigint, _first bigint, _last bigint, _per bigint, _base bigint, _offset bigint")

    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(SALTS)))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy(id_col, "piece")
    ranked = salted.withColumn("_rank", F.row_number().over(within)).join(sizes, ["length", "_salt"]).select(
        id_col, "piece", "start", "length", "content", (F.col("_before") + F.col("_rank") - 1).alias("_rank"))

    # the plan's size is bounded by the capacity and the rounds
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & F.col("_rank").between(F.col("_first"), F.col("_last"))).drop(plan["length"])
    since = F.col("_rank") - F.col("_first")
    return placed.select(
        id_col, "piece", "start", "length", "content", (F.col("_base") + F.floor(since / F.col("_per"))).cast("bigint").alias("sequence_id"),
        (F.col("_offset") + since % F.col("_per") * F.col("length")).alias("offset"))
