"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. Each is a logistic model over hashed
word features, and every later model also sees the probabilities that the earlier
ones gave. Those are out-of-fold in training: the sample is cut into folds by a hash
of the id, and a document's probability comes from a model that never saw it, so a
later model learns how far an earlier one can be trusted on new text. The last link
of the chain is toxicity itself.

The earlier categories are learnt too, in any language: the features that go with the
label most are clustered by the toxic texts they stand in (``KINDS`` clusters), and a
toxic text has a kind if it has a feature of that cluster; it is severe if it has more
of all these features than half of the toxic texts. Features are words and their first
4 to 7 letters, each met once, twice, 4 or 8 times at least, since an abusive stem that
a long clean text has by chance comes once. Kept are the ``FEATURES`` that tell most
about toxicity in the sample (chi-square); they are counted by Spark.

Fitting uses a bounded sample of labelled documents (``SAMPLE`` per label, smallest
hash of the id); the driver gets one bit per feature and document of it, whatever the
length of its text. All texts are scored whole, word by word with counts, so a long
text takes the memory of its distinct words. A document's score does not depend on
other documents, so nothing is shuffled but the sample.

Defined cases: a null or empty text has no feature and gets the base rates; repeated
rows get the same scores; an id with labels of both kinds counts as toxic; an id of the
sample with several texts gives one of them (that of the smallest bits); without labels
of both kinds nothing is toxic; other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import Workspace

SAMPLE, FEATURES, FOLDS = 3000, 1024, 4
#: Learnt categories, and the features (of the first columns) they are learnt from.
KINDS, TELLING = 3, 96
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), "severe", "toxic")
#: Occurrences from which on a word or stem gives a further feature.
LEVELS = (1, 2, 4, 8)
STEMS = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 100_000


# --- features --------------------------------------------------------------------

def units_of(word: str) -> list[int]:
    """64-bit hashes of a word and of its first letters, the two low bits free for the level."""
    hashed = xxhash.xxh3_64_intdigest
    return [hashed(word) & ~3, *(hashed("^" + word[:n]) & ~3 for n in STEMS if len(word) >= n)]


class Features:
    """Features of texts; with ``wanted``, only those, and words without any are passed over."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted, self.units = wanted, None if wanted is None else {f & ~3 for f in wanted}
        self.known: dict[str, list[int]] = {}

    def __call__(self, text: str) -> set[int]:
        seen: dict[int, int] = {}
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        for word, n in Counter(_WORD.findall(text.lower())).items():
            units = self.known.get(word)
            if units is None:
                units = self.known[word] = [u for u in units_of(word) if self.units is None or u in self.units]
            for u in units:
                seen[u] = seen.get(u, 0) + n
        found = {u | k for u, n in seen.items() for k, least in enumerate(LEVELS) if n >= least}
        return found if self.wanted is None else found & self.wanted


def _signed(feature: int) -> int:
    return feature - (1 << 64) if feature >> 63 else feature


# --- the chain -------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 250, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by full-batch gradient descent with momentum; the last weight is the offset."""
    x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    w, v = np.zeros(x.shape[1], dtype=np.float32), np.zeros(x.shape[1], dtype=np.float32)
    for _ in range(steps):
        v = 0.9 * v - rate * (x.T @ (_sigmoid(x @ w) - y) / len(x) * 10 + decay * w)
        w = w + 0.1 * v
    return w


def _apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _sigmoid(x @ w[:-1] + w[-1])


def out_of_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Probability of every row from a model fitted on the other folds."""
    out = np.full(len(x), y.mean() if len(y) else 0, dtype=np.float32)
    for f in np.unique(fold):
        if (fold != f).any():
            out[fold == f] = _apply(fit_linear(x[fold != f], y[fold != f]), x[fold == f])
    return out


def learn_kinds(x: np.ndarray, toxic: np.ndarray, kinds: int = KINDS, telling: int = TELLING, rounds: int = 10) -> np.ndarray:
    """Labels (rows, kinds + 1) of the categories before toxicity; columns of ``x`` are ordered by what they tell."""
    bad, labels = toxic == 1, np.zeros((len(x), kinds + 1), dtype=np.float32)
    share, other = x[bad].mean(axis=0), x[~bad].mean(axis=0) if (~bad).any() else 0
    columns = np.flatnonzero(share > other)[:telling]
    if not len(columns):
        return labels
    # where a feature stands among the toxic texts, as a direction; clusters of these, the first centres far apart
    lines = x[bad][:, columns].T.astype(np.float64)
    lines /= np.linalg.norm(lines, axis=1, keepdims=True)
    centres = lines[:1]
    while len(centres) < min(kinds, len(columns)):
        centres = np.concatenate([centres, lines[[(lines @ centres.T).max(axis=1).argmin()]]])
    for _ in range(rounds):
        near = (lines @ centres.T).argmax(axis=1)
        sums = np.stack([lines[near == k].sum(axis=0) if (near == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    for k in range(len(centres)):
        labels[bad, k] = x[bad][:, columns[near == k]].any(axis=1)
    many = x[bad][:, columns].sum(axis=1)
    labels[bad, kinds] = many > np.median(many)
    return labels


class Chain:
    """``columns``: feature -> column; ``weights``: one vector per category, earlier probabilities behind the features."""

    def __init__(self, columns: dict[int, int], weights: list[np.ndarray]):
        self.columns, self.weights = columns, weights

    def matrix(self, features: list[set[int]]) -> np.ndarray:
        x = np.zeros((len(features), len(self.columns)), dtype=np.float32)
        for i, f in enumerate(features):
            x[i, [self.columns[h] for h in f if h in self.columns]] = 1
        return x

    def probabilities(self, features: list[set[int]]) -> np.ndarray:
        x, done = self.matrix(features), np.zeros((len(features), 0), dtype=np.float32)
        for w in self.weights:
            p = _apply(w, np.concatenate([x, done], axis=1))
            done = np.concatenate([done, p[:, None].astype(np.float32)], axis=1)
        return done


def train_chain(columns: dict[int, int], x: np.ndarray, toxic: np.ndarray, fold: np.ndarray) -> Chain:
    """Chain from the feature bits, labels and folds of the sample."""
    labels = np.concatenate([learn_kinds(x, toxic), toxic[:, None].astype(np.float32)], axis=1)
    chain, inputs = Chain(columns, []), x
    for k in range(labels.shape[1]):
        chain.weights.append(fit_linear(inputs, labels[:, k]))
        if k + 1 < labels.shape[1]:
            inputs = np.concatenate([inputs, out_of_fold(inputs, labels[:, k], fold)[:, None]], axis=1)
    return chain


# --- sample and documents --------------------------------------------------------

def telling_features(sample: DataFrame, most: int = FEATURES) -> list[int]:
    """Features of rows (y, features) with the largest chi-square against y, seen in two rows at least."""
    sizes = sample.agg(F.count("*").alias("_all"), F.coalesce(F.sum("y"), F.lit(0)).alias("_bad")).first()
    met = sample.select("y", F.explode("features").alias("h")).groupBy("h").agg(F.count("*").alias("k"), F.sum("y").alias("bad")).where("k > 1")
    n, expected = F.lit(float(sizes["_all"])), F.col("k") * (float(sizes["_bad"]) / max(sizes["_all"], 1))
    chi = (F.col("bad") - expected) * (F.col("bad") - expected) * n / (expected * (n - F.col("k")) + F.lit(1e-9))
    # at most ``most`` rows
    return [r["h"] % (1 << 64) for r in met.select("h", chi.alias("chi")).orderBy(F.desc("chi"), "h").limit(most).collect()]


def fit_chain(docs: DataFrame, labels: DataFrame, space: Workspace, *, id_col: str, text_col: str, label_col: str, per_label: int, features: int, folds: int = FOLDS) -> Chain | None:
    """Chain from the labelled sample; none without labels of both kinds."""
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").cast("int").alias("y"))
    chosen = wanted.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(per_label).unionAll(wanted.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(per_label))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Features()
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                found = [sorted(map(_signed, read(x.as_py() or ""))) for x in batch.column(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "y", "features"])

    kind = T.StructField("id", docs.schema[id_col].dataType)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # at most 2 * per_label ids, a proven bound
    found = texts.join(F.broadcast(chosen), "id").select("id", "y", "text").mapInArrow(extract, T.StructType([kind, T.StructField("y", T.IntegerType()), T.StructField("features", T.ArrayType(T.LongType()))]))
    sample = space.write(found, "sample")
    columns = {h: i for i, h in enumerate(telling_features(sample, features))}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(columns, [])
        for batch in batches:
            bits = [np.packbits(chain.matrix([{h % (1 << 64) for h in x.as_py()}])[0].astype(bool)).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["id", "y", "bits"])

    marked = sample.mapInArrow(mark, T.StructType([kind, T.StructField("y", T.IntegerType()), T.StructField("bits", T.BinaryType())]))
    rows = marked.groupBy("id", "y").agg(F.min("bits").alias("bits")).orderBy("id").collect()  # one row per id of the sample, features / 8 bytes each
    space.drop("sample")
    toxic = np.array([r["y"] for r in rows])
    if len(np.unique(toxic)) < 2:
        return None
    x = np.stack([np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), count=len(columns)) for r in rows]).astype(np.float32)
    return train_chain(columns, x, toxic, np.array([xxhash.xxh3_64_intdigest(str(r["id"])) % folds for r in rows]))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, per_label: int = SAMPLE, features: int = FEATURES) -> DataFrame:
    """One row per document: id, a probability per category, and whether it is toxic."""
    chain = fit_chain(docs, labels, Workspace(docs.sparkSession, "toxicity"), id_col=id_col, text_col=text_col, label_col=label_col, per_label=per_label, features=features)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Features(set(chain.columns)) if chain else None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                p = chain.probabilities([read(x.as_py() or "") for x in batch.column(1)]) if chain else np.zeros((batch.num_rows, len(CATEGORIES)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k].astype(np.float64)) for k in range(len(CATEGORIES))]], names=[f.name for f in schema.fields])

    scored = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    return scored.select(F.col("id").alias(id_col), *[f"p_{c}" for c in CATEGORIES], (F.col("p_toxic") >= threshold).alias("toxic"))
