"""Language identification by hyperdimensional profiles.

Every letter has a fixed pseudo-random vector of ``DIMENSIONS`` signs, drawn from a
hash of its code point. An n-gram of letters is bound to one vector: the letters'
vectors, each rotated once for every letter that follows it, are multiplied
component by component. A text is the bundle (the sum) of the vectors of all its
n-grams, a language prototype the bundle of all its training texts, and a document
gets the language whose prototype has the largest cosine with it.

Texts are lower-cased; a run of anything but letters counts as one blank, also before
the first and after the last letter. Whole texts are read, in pieces that overlap, so
memory does not depend on their length. Components are whole numbers, and prototypes
therefore do not depend on how rows are dealt over tasks: a task adds up one vector a
language, and Spark sums these by component. Documents are scored by a projection;
prototypes reach the tasks in blocks of at most ``BLOCK`` languages, each block taking
up the best match of those before it.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text when no training text has a letter; null languages are not learnt from; a
null id is held out; of equal cosines the smaller language name wins; a negative
cosine scores 0; repeated rows get the same answer; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import Workspace

DIMENSIONS, N, BLOCK = 2048, 3, 2048
UNKNOWN = "und"
_PIECE, _ROWS, _COLUMNS = 1 << 17, 256, 2048
_BLANK, _BITS = 32, 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=4096)
def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The signs of a letter."""
    bits = hashlib.shake_256(b"letter %d" % code).digest(dimensions // 8)
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).astype(np.int8) * 2 - 1


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, in order; none if it has no letter."""
    out, tail, found = [], np.array([_BLANK], dtype=np.int64), False
    for at in range(0, len(text) + _PIECE, _PIECE):
        last = at >= len(text)
        piece = " " if last else text[at : at + _PIECE].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        letter = _letters()[codes]
        found = found or bool(letter.any())
        codes = np.concatenate([tail, np.where(letter, codes, _BLANK)])
        blank = codes == _BLANK
        codes = codes[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        if len(codes) >= N:
            whole = codes[: len(codes) - N + 1]
            for k in range(1, N):
                whole = whole << _BITS | codes[k : len(codes) - N + 1 + k]
            out.append(whole)
        tail = codes[-(N - 1) :]
        if last:
            break
    return np.concatenate(out) if found and out else np.empty(0, dtype=np.int64)


def ngram_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row of signs per n-gram: rotated letter vectors, multiplied."""
    out = None
    for k in range(N):
        letters = codes >> _BITS * (N - 1 - k) & (1 << _BITS) - 1
        distinct, place = np.unique(letters, return_inverse=True)
        signs = np.stack([np.roll(letter_vector(int(c), dimensions), N - 1 - k) for c in distinct])[place]
        out = signs if out is None else out * signs
    return out


def bundle(counts: np.ndarray, codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bundles of n-grams: ``counts`` (texts, n-grams) times the vectors of the n-grams."""
    out = np.zeros((len(counts), dimensions))
    for at in range(0, len(codes), _COLUMNS):
        part = counts[:, at : at + _COLUMNS]
        exact = np.float32 if part.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
        out += part.astype(exact) @ ngram_vectors(codes[at : at + _COLUMNS], dimensions).astype(exact)
    return out


def bundle_texts(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One bundle per text."""
    each = [np.unique(ngram_codes(x), return_counts=True) for x in texts]
    codes, place = np.unique(np.concatenate([c for c, _ in each]), return_inverse=True)
    counts, at = np.zeros((len(texts), len(codes))), 0
    for i, (c, n) in enumerate(each):
        counts[i, place[at : at + len(c)]] = n
        at += len(c)
    return bundle(counts, codes, dimensions)


class _Sums:
    """Bundles of languages. N-gram counts are kept until they are many, then bound and added."""

    def __init__(self, dimensions: int):
        self.dimensions, self.codes, self.size = dimensions, {}, 0
        self.vectors: dict[str, np.ndarray] = {}

    def add(self, lang: str, codes: np.ndarray) -> None:
        self.codes.setdefault(lang, []).append(codes)
        self.size += len(codes)
        if self.size > 1 << 21:
            self.settle()

    def settle(self) -> None:
        for lang, parts in self.codes.items():
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            if len(codes):
                new = bundle(counts[None].astype(np.float64), codes, self.dimensions)[0].astype(np.int64)
                self.vectors[lang] = self.vectors.get(lang, 0) + new
        self.codes, self.size = {}, 0


def language_prototypes(docs: DataFrame, *, text_col: str, lang_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per language: lang, vector (whole numbers), from all given documents that have a letter and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(dimensions)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                sums.add(lang.as_py(), ngram_codes(text.as_py()))
            # a task with very many languages hands them on, so that it never holds more than some thousands
            if len(sums.vectors) > BLOCK:
                sums.settle()
                yield out(sums.vectors)
                sums.vectors = {}
        sums.settle()
        yield out(sums.vectors)

    def out(vectors: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(vectors), pa.string()), pa.array([v.tolist() for v in vectors.values()], pa.list_(pa.int64()))], names=["lang", "vector"])

    known = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    parts = known.mapInArrow(run, "lang string, vector array<bigint>")
    summed = parts.select("lang", F.posexplode("vector").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    return summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("vector"))


def best_match(bundles: np.ndarray, names: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """For each bundle the name of the prototype (unit rows, names ascending) with the largest cosine, and that cosine."""
    length = np.linalg.norm(bundles, axis=1)
    cosines = bundles @ prototypes.T / np.maximum(length, 1e-300)[:, None]
    best = cosines.argmax(axis=1)
    return [names[k] for k in best], cosines[np.arange(len(best)), best]


def identify_languages(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score. Rows for which ``held_out`` is true are not learnt from."""
    space = Workspace(docs.sparkSession, "language-profiles")
    flagged = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    learnt = space.write(language_prototypes(flagged.where(~F.col("held_out")), text_col="text", lang_col="lang", dimensions=dimensions), "prototypes")
    blocks = -(-learnt.count() // block)
    # a hash of the name deals languages into blocks: about ``block`` rows of ``dimensions`` numbers each
    learnt = learnt.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(max(blocks, 1))))
    best = flagged.select("id", "held_out", "text", F.lit(None).cast("string").alias("pred"), F.lit(0.0).alias("cosine"))
    for k in range(blocks):
        rows = learnt.where(F.col("block") == k).orderBy("lang").toArrow()
        names, vectors = rows.column("lang").to_pylist(), np.array(rows.column("vector").to_pylist(), dtype=np.float64).reshape(-1, dimensions)
        best = best.mapInArrow(_scorer(names, vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None], dimensions), _schema(docs, id_col, text_col))
    space.close()
    return best.select(
        F.col("id").alias(id_col), "held_out", F.coalesce("pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("pred").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), "cosine"))).alias("score"),
    )


def _schema(docs: DataFrame, id_col: str, text_col: str) -> T.StructType:
    return T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("text", docs.schema[text_col].dataType),
        T.StructField("pred", T.StringType()), T.StructField("cosine", T.DoubleType()),
    ])


def _scorer(names: list[str], prototypes: np.ndarray, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                texts = [x.as_py() or "" for x in batch.column(2)]
                bundles = bundle_texts(texts, dimensions)
                found, cosine = best_match(bundles, names, prototypes) if names else ([], [])
                pred, score = batch.column(3).to_pylist(), batch.column(4).to_pylist()
                some = bundles.any(axis=1)
                for i, (name, c) in enumerate(zip(found, cosine)):
                    if some[i] and (pred[i] is None or (-c, name) < (-score[i], pred[i])):
                        pred[i], score[i] = name, float(c)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["id", "held_out", "text", "pred", "cosine"])

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``_ROWS`` rows and, but for single long texts, about ``_ROWS`` * 4 KiB of text."""
    at, size = 0, 0
    for i, text in enumerate(batch.column(2)):
        length = len(text.as_buffer() or b"")
        if i > at and (i - at >= _ROWS or size + length > _ROWS << 12):
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += length
    if batch.num_rows > at:
        yield batch.slice(at)
