"""Hard-negative mining by angular triangle filtering.

A vector is rounded down to whole numbers and stored with its norm and its angles to
``REFERENCES`` reference directions. For an anchor at angle ``a`` and a row at angle ``b``
to one direction, the angle between the two lies in ``[|a - b|, min(a + b, 2 pi - a - b)]``;
over all directions the largest lower and the smallest upper end count. Cosines of the
ends, multiplied by both norms and widened by more than any rounding error, bound the
inner product from both sides. Stored rows are sorted by their nearest direction and the
angle to it, so a run of ``CHUNK`` rows has a narrow range of angles and norms, and the
same bounds hold for a run as a whole.

Two passes over the stored rows follow for each block of anchors. The first looks for the
nearest rows of the anchor's label, the second for the best rows of other labels inside
the score window of each positive found. A run, then a row, is left out where its bounds
do not meet the scores still wanted: above the k-th best so far, inside a window. Only
what is left is scored, in whole numbers. Every row is indexed and searched: the answer
is exact. Directions are ``REFERENCES`` rows picked far apart from a documented sample of
``SAMPLE`` rows (those with the smallest hash of the id); they decide speed, never results.

Anchors reach the tasks as broadcast blocks of at most ``ANCHORS`` rows, a checked bound,
and a block's positives likewise. A task holds one Arrow batch of rows, and a best list of
k entries for each anchor and positive. It hands these on, and a window picks the best
over all tasks.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; rows of one id count once, that with the smallest label, then
the smallest vector; missing components of a shorter vector are zeros; an empty vector
scores 0 with everything; ties go to the smaller id; an anchor without positives, or a
positive whose score is negative (its window is empty), gives no row; an empty table gives
no row; other columns, whatever their names, are ignored. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import Workspace

REFERENCES, SAMPLE, CHUNK, ANCHORS, SCALE = 16, 2048, 128, 32_768, 256
_AT_ONCE = 512
#: Wider than the error of an angle from its cosine, and than that of a product of norms and a cosine.
_ANGLE, _RELATIVE, _ABSOLUTE = 1e-6, 1e-9, 1e-6


def matrix_of(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; components that one side lacks are zeros."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if largest < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if largest < 2.0**63:
        return a @ b.T
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def angles_to(rows: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of rows to unit references, and norms; a zero row has angle 0."""
    width = min(rows.shape[1], references.shape[1])
    rows = rows.astype(np.float64)
    norms = np.sqrt((rows * rows).sum(axis=1))
    cosines = rows[:, :width] @ references[:, :width].T / np.maximum(norms, 1e-300)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0.0), norms


def score_bounds(angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the whole-number scores of anchors (rows) with rows or runs of rows (columns).

    ``low`` and ``high`` are a run's smallest and largest angle to each direction,
    ``least`` and ``most`` its norms; for a single row both are the same.
    """
    near = np.zeros((len(angles), len(low)))
    far = np.full(near.shape, np.pi)
    for r in range(angles.shape[1]):
        a = angles[:, r, None]
        np.maximum(near, a - high[:, r], out=near)
        np.maximum(near, low[:, r] - a, out=near)
        np.minimum(far, a + high[:, r], out=far)
        np.minimum(far, 2 * np.pi - a - low[:, r], out=far)
    top, bottom = np.cos(np.maximum(near - _ANGLE, 0)), np.cos(np.minimum(far + _ANGLE, np.pi))
    top = norms[:, None] * np.where(top > 0, most, least) * top
    bottom = norms[:, None] * np.where(bottom > 0, least, most) * bottom
    slack = norms[:, None] * most * _RELATIVE + _ABSOLUTE
    return np.ceil(bottom - slack), np.floor(top + slack)


class BestLists:
    """The k best (score, smaller id first) of each slot, over candidates that come in batches."""

    def __init__(self, slots: int, k: int):
        self.k, self.waiting = k, 0
        self.least = np.full(slots, np.iinfo(np.int64).min)  # a score under this cannot get in
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((slot, score, ids))
        self.waiting += len(slot)
        if self.waiting > 100_000 + 4 * self.k * len(self.least):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.empty(0, dtype=np.int64),) * 3
        slot, score, ids = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        best = rank < self.k
        last = rank == self.k - 1
        self.least[slot[last]] = score[last]
        out = slot[best], score[best], ids[best]
        self.parts, self.waiting = [out], int(best.sum())
        return out


class Anchors:
    """A block of anchors as arrays."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels, self.norms = (table.column(c).to_numpy() for c in ("id", "label", "norm"))
        self.rows = matrix_of(table.column("vector"))
        self.angles = np.array(table.column("angles").to_pylist(), dtype=np.float64).reshape(len(self.ids), -1)


class _Runs:
    """Stored rows of one Arrow batch, in runs of ``CHUNK``."""

    def __init__(self, batch: pa.RecordBatch):
        part = Anchors(pa.Table.from_batches([batch]))
        self.ids, self.labels, self.norms, self.rows, self.angles = part.ids, part.labels, part.norms, part.rows, part.angles
        self.starts = np.arange(0, len(self.ids), CHUNK)
        self.low, self.high = np.minimum.reduceat(self.angles, self.starts), np.maximum.reduceat(self.angles, self.starts)
        self.least, self.most = np.minimum.reduceat(self.norms, self.starts), np.maximum.reduceat(self.norms, self.starts)


def _survivors(anchors: Anchors, part: slice, runs: _Runs, wanted) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor places, row places, mask, scores) of what the bounds leave, run by run.

    ``wanted(anchor places, lower, upper)`` tells where bounds meet the scores wanted.
    """
    angles, norms = anchors.angles[part], anchors.norms[part]
    places = np.arange(len(anchors.ids))[part]
    meets = wanted(places, *score_bounds(angles, norms, runs.low, runs.high, runs.least, runs.most))
    for k in np.flatnonzero(meets.any(axis=0)):
        at = places[meets[:, k]]
        rows = np.arange(runs.starts[k], min(runs.starts[k] + CHUNK, len(runs.ids)))
        a, n = runs.angles[rows], runs.norms[rows]
        mask = wanted(at, *score_bounds(anchors.angles[at], anchors.norms[at], a, a, n, n))
        some, any_row = mask.any(axis=1), mask.any(axis=0)
        if some.any():
            at, rows, mask = at[some], rows[any_row], mask[some][:, any_row]
            yield at, rows, mask, inner_products(anchors.rows[at], runs.rows[rows])


def _parts(n: int) -> Iterator[slice]:
    return (slice(at, at + _AT_ONCE) for at in range(0, n, _AT_ONCE))


def _positives(anchors: Anchors, k: int):
    """Rows -> the k best rows of the same label, for each anchor: anchor_id, id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestLists(len(anchors.ids), k)
        for batch in filter(len, batches):
            runs = _Runs(batch)
            for part in _parts(len(anchors.ids)):
                for at, rows, mask, scores in _survivors(anchors, part, runs, lambda at, lower, upper: upper >= best.least[at][:, None]):
                    i, j = np.nonzero(mask & (scores >= best.least[at][:, None]) & (anchors.labels[at][:, None] == runs.labels[rows]) & (anchors.ids[at][:, None] != runs.ids[rows]))
                    best.add(at[i], scores[i, j], runs.ids[rows[j]])
            best.settle()
        slot, score, ids = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[slot]), pa.array(ids), pa.array(score)], names=["anchor_id", "id", "score"])

    return run


def _negatives(anchors: Anchors, positive: np.ndarray, low: int, high: int, k: int):
    """Rows -> the k best rows of other labels in the window of each positive: slot, id, score.

    ``positive`` (anchors, positives) holds their scores, -1 where there is none.
    """
    width = positive.shape[1]
    hundreds, rest = positive // 100, positive % 100  # percentages without overflow
    floor_, ceiling = hundreds * low - (-low * rest // 100), hundreds * high + high * rest // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestLists(positive.size, k)

        def from_(at: np.ndarray) -> np.ndarray:
            return np.maximum(floor_[at], best.least.reshape(-1, width)[at])

        def wanted(at: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            out, start = np.zeros(lower.shape, dtype=bool), from_(at)
            for s in range(width):
                out |= (positive[at, s, None] >= 0) & (upper >= start[:, s, None]) & (lower <= ceiling[at, s, None])
            return out

        for batch in filter(len, batches):
            runs = _Runs(batch)
            for part in _parts(len(anchors.ids)):
                for at, rows, mask, scores in _survivors(anchors, part, runs, wanted):
                    mask = mask & (anchors.labels[at][:, None] != runs.labels[rows])
                    start = from_(at)
                    for s in range(width):
                        i, j = np.nonzero(mask & (positive[at, s, None] >= 0) & (scores >= start[:, s, None]) & (scores <= ceiling[at, s, None]))
                        best.add(at[i] * width + s, scores[i, j], runs.ids[rows[j]])
            best.settle()
        slot, score, ids = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(ids), pa.array(score)], names=["slot", "id", "score"])

    return run


def reference_directions(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors of sampled rows, each far from those before it."""
    found = matrix_of(rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow().column(0)).astype(np.float64)
    norms = np.sqrt((found * found).sum(axis=1))
    found = found[norms > 0] / norms[norms > 0, None]
    if not len(found):
        return np.zeros((1, max(found.shape[1], 1)))
    picked, nearest = [0], found @ found[0]
    while len(picked) < min(count, len(found)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, found @ found[picked[-1]])
    return found[picked]


def indexed_rows(vectors: DataFrame, is_anchor: Column, *, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """One row per id that takes part: id, label, vector (whole numbers), anchor."""
    x = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"), vectors[vector_col].alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    x = x.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    x = x.withColumn("vector", F.transform("vector", lambda v: F.floor(v.cast("double") * scale)))
    first = F.row_number().over(Window.partitionBy("id").orderBy("label", "vector"))
    return x.withColumn("nth", first).where("nth = 1").drop("nth")


def _with_angles(references: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            angles, norms = angles_to(matrix_of(batch.column(2)), references)
            nearest = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(norms), pa.array(list(angles), pa.list_(pa.float64())), pa.array(nearest.astype(np.int32)), pa.array(angles[np.arange(len(nearest)), nearest]),
            ], names=["id", "label", "vector", "anchor", "norm", "angles", "nearest", "angle"])

    return run


def _blocks(anchors: DataFrame, most: int) -> list[Column]:
    """Conditions that cut anchors by a hash of the id into blocks of at most ``most`` rows each."""
    total = anchors.count()
    n = -(-total // most)
    while n:
        block = F.pmod(F.xxhash64("id"), F.lit(n))
        if anchors.groupBy(block.alias("b")).count().agg(F.max("count")).first()[0] <= most:
            return [block == k for k in range(n)]
        n *= 2
    return []


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, anchor_rows: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each anchor the ``positives`` best other rows of its label, and for each of them the
    ``negatives`` best rows of other labels scoring ``low`` to ``high`` percent of the positive.
    """
    spark, space = vectors.sparkSession, Workspace(vectors.sparkSession, "hard-negatives")
    rows = space.write(indexed_rows(vectors, is_anchor, id_col=id_col, vector_col=vector_col, label_col=label_col), "rows")
    stored = rows.mapInArrow(_with_angles(reference_directions(rows)), "id bigint, label bigint, vector array<bigint>, anchor boolean, norm double, angles array<double>, nearest int, angle double")
    # the id parts equal vectors, so many copies of one spread over several tasks
    stored = space.write(stored.repartitionByRange("nearest", "angle", "id").sortWithinPartitions("nearest", "angle", "id"), "stored")
    columns = ["id", "label", "vector", "norm", "angles"]
    found = []
    for n, block in enumerate(_blocks(stored.where("anchor"), anchor_rows)):
        anchors = Anchors(stored.where("anchor").where(block).select(columns).orderBy("id").toArrow())
        top = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
        near = stored.select(columns).mapInArrow(_positives(anchors, positives), "anchor_id bigint, id bigint, score bigint")
        near = space.write(near.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= positives), f"positives-{n}")
        # at most ``positives`` rows for each anchor of the block
        best = near.toArrow()
        score = np.full((len(anchors.ids), positives), -1, dtype=np.int64)
        score[np.searchsorted(anchors.ids, best.column("anchor_id").to_numpy()), best.column("rank").to_numpy() - 1] = best.column("score").to_numpy()
        hits = stored.select(columns).mapInArrow(_negatives(anchors, score, low, high, negatives), "slot bigint, id bigint, score bigint")
        places = spark.createDataFrame(pa.table({"place": np.arange(len(anchors.ids)), "anchor_id": anchors.ids}))
        named = near.join(places, "anchor_id").select((F.col("place") * positives + F.col("rank") - 1).alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        of_slot = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
        ranked = hits.withColumn("rank", F.row_number().over(of_slot)).where(F.col("rank") <= negatives)
        found.append(space.write(named.join(ranked, "slot").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), f"negatives-{n}"))
        space.drop(f"positives-{n}")
    space.drop("rows", "stored")
    if not found:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return spark.read.schema(found[0].schema).parquet(*[space.path(f"negatives-{n}") for n in range(len(found))])


#: DuckDB SQL for the query over ``embeddings``.
CHECK_SQL = """
WITH rows AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM (
    SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
WHERE rank <= 5
"""
