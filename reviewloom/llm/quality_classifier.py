"""Quality classifier: a convolutional network over bytes, in numpy.

Learned filters of ``WIDTH`` bytes run over every position of a document. The
document is read in overlapping chunks (half a chunk apart) that cover all of it; the
filters are max-pooled per chunk, and the chunks are combined by their maximum and
their mean into one vector, which a logistic layer turns into one probability.

A filter over one-hot bytes is a table look-up per offset, so the forward pass is
``WIDTH`` gathers and adds, one chunk at a time: memory does not depend on the length
of a text. Training uses a bounded sample of the labelled documents:
``SAMPLE`` per label, those with the smallest hash of their id, of each at most
``CHUNKS`` chunks spread evenly over the whole text. Scoring reads all bytes of all
documents. Only the text enters a score.

Defined cases: a null or empty text is one chunk of padding; repeated rows get the
same score; without labels of both kinds every score is the share of label 1
(0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH, FILTERS, CHUNK = 6, 24, 512
SAMPLE, CHUNKS = 1500, 8
_PAD = 256


def chunks_of(data: bytes, chunk: int = CHUNK, width: int = WIDTH) -> np.ndarray:
    """Overlapping chunks, each followed by the bytes its last filters reach into; rows of byte values, 256 for padding."""
    half = chunk // 2
    n = max(1, -(-max(len(data) - half, 1) // half))
    b = np.full((n + 1) * half + width - 1, _PAD, dtype=np.int16)
    b[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(b, chunk + width - 1)[::half][:n]


class ByteNetwork:
    """``filters`` (width, 257, filters), ``bias`` (filters,), ``out`` (2 * filters,), ``offset``."""

    def __init__(self, filters: np.ndarray, bias: np.ndarray, out: np.ndarray, offset: float):
        self.filters, self.bias, self.out, self.offset = filters, bias, out, offset

    @classmethod
    def fresh(cls, seed: int = 7, width: int = WIDTH, count: int = FILTERS) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        filters = rng.normal(0, 0.3, (width, 257, count)).astype(np.float32)
        filters[:, _PAD] = 0
        return cls(filters, np.zeros(count, dtype=np.float32), rng.normal(0, 0.3, 2 * count).astype(np.float32), 0.0)

    def pooled(self, chunk_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter in each chunk, and where it is."""
        reach = chunk_rows.shape[1] - len(self.filters) + 1
        best = np.empty((len(chunk_rows), self.filters.shape[2]), dtype=np.float32)
        where = np.empty(best.shape, dtype=np.int64)
        for k, row in enumerate(chunk_rows):
            sums = self.filters[0][row[:reach]]
            for t in range(1, len(self.filters)):
                sums += self.filters[t][row[t : t + reach]]
            where[k] = sums.argmax(axis=0)
            best[k] = sums[where[k], np.arange(sums.shape[1])]
        return best, where

    def combine(self, best: np.ndarray) -> np.ndarray:
        active = np.tanh(best + self.bias)
        return np.concatenate([active.max(axis=0), active.mean(axis=0)])

    def probability(self, data: bytes) -> float:
        rows = chunks_of(data)
        best = np.concatenate([self.pooled(rows[at : at + 64])[0] for at in range(0, len(rows), 64)])
        return float(1 / (1 + np.exp(-np.clip(self.combine(best) @ self.out + self.offset, -30, 30))))


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, dtype=np.float32), np.zeros(shape, dtype=np.float32), 0, rate

    def step(self, g):
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def train_network(samples: list[tuple[np.ndarray, int]], epochs: int = 4, batch: int = 16, rate: float = 0.01, seed: int = 7) -> ByteNetwork:
    """Gradient descent over (chunks, label); labels weigh alike in sum, whatever their numbers."""
    net = ByteNetwork.fresh(seed)
    width, _, count = net.filters.shape
    share = sum(y for _, y in samples) / max(len(samples), 1)
    weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    steps = [_Adam(x, rate) for x in (net.filters.shape, count, 2 * count, 1)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), batch):
            grads = [np.zeros_like(net.filters), np.zeros_like(net.bias), np.zeros_like(net.out), np.zeros(1, dtype=np.float32)]
            for i in order[at : at + batch]:
                rows, y = samples[i]
                best, where = net.pooled(rows)
                active = np.tanh(best + net.bias)
                top = active.argmax(axis=0)
                vector = np.concatenate([active.max(axis=0), active.mean(axis=0)])
                p = 1 / (1 + np.exp(-np.clip(vector @ net.out + net.offset, -30, 30)))
                d = weight[y] * (p - y) / batch
                grads[2] += d * vector
                grads[3] += d
                into = np.repeat(net.out[count:][None] / len(rows), len(rows), axis=0)
                into[top, np.arange(count)] += net.out[:count]
                into *= d * (1 - active**2)
                grads[1] += into.sum(axis=0)
                which = np.broadcast_to(np.arange(count), where.shape)
                for t in range(width):
                    np.add.at(grads[0][t], (rows[np.arange(len(rows))[:, None], where + t], which), into)
            grads[0][:, _PAD] = 0
            net.filters -= steps[0].step(grads[0] + 1e-5 * net.filters)
            net.bias -= steps[1].step(grads[1])
            net.out -= steps[2].step(grads[2] + 1e-3 * net.out)
            net.offset -= float(steps[3].step(grads[3])[0])
    return net


def held_out(id_col, parts: int = 4, part: int = 2):
    """Whether the checksum of an id falls into the part that is never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, per_label: int = SAMPLE, chunks: int = CHUNKS) -> list[tuple[np.ndarray, int]]:
    """(chunks, label) of at most ``per_label`` documents per label outside the held-out part: at most 2 * per_label * chunks * 0.5 KiB."""
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).dropDuplicates(["id"])
    chosen = wanted.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(per_label).unionAll(wanted.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(per_label))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(0):
                rows = chunks_of(x.as_py() or b"")
                out.append(rows[np.unique(np.linspace(0, len(rows) - 1, min(chunks, len(rows))).astype(int))].astype("<i2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1)], names=["rows", "y"])

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text"))
    # at most 2 * per_label ids, a proven bound
    found = texts.join(F.broadcast(chosen), "id").orderBy("id").select("text", F.col("y").cast("int").alias("y")).mapInArrow(cut, "rows binary, y int").toArrow()
    return [(np.frombuffer(r, dtype="<i2").reshape(-1, CHUNK + WIDTH - 1), y) for r, y in zip(found.column("rows").to_pylist(), found.column("y").to_pylist())]


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7, per_label: int = SAMPLE) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    samples = training_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_label=per_label)
    kinds = {y for _, y in samples}
    net = train_network(samples) if len(kinds) == 2 else None
    constant = 0.5 if not kinds else float(sum(kinds))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [net.probability(x.as_py() or b"") if net else constant for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    scored = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text")).mapInArrow(run, schema)
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
