"""Suffix-array deduplication of byte strings, built column by column.

Removed is every byte that a string of ``length`` bytes covers which also starts
anywhere else, in the same document or another one.

*Dealing.* A corpus-wide suffix array is cut into independent collections first. Each
string of ``length`` bytes contains the ``gram``-byte string of smallest hash (its
anchor), and equal strings have their anchor at the same offset. Anchors are counted
over the whole corpus; only those met at least twice can lie in repeated strings.
Around each of these the text is cut out, ``length - gram`` bytes to either side: all
strings with that anchor lie inside. Equal cuts are counted as one with a number,
combined before the shuffle, so copies and popular passages do not pile up.

*Construction.* The cuts of a partition form a collection of texts that are aligned at
their anchors. It is read from right to left, one symbol of every text a round: the
Burrows-Wheeler column of a round is the next symbol in the order of the suffixes met
so far; a stable sort by it gives the next order, and the common prefixes of
neighbours follow from range minima of the previous ones. Aligned texts need only be
compared column with column, so a round is linear in the number of texts. Columns are
kept in a file of the task that is written once and read sequentially. A string is
repeated where the common prefix with a neighbour reaches ``length``.

An anchor with more than ``most`` different cuts (a popular phrase in as many
surroundings) would be a group without bound in one task. Its strings are counted by
hash instead, combined before the shuffle: more rows, same result.

Texts are shuffled once, to be met by their repeated anchors; what is carried from then
on are the cuts and the texts that have any.

Defined cases: a null text is an empty one; texts under ``length`` bytes lose nothing;
repeated rows remove each other; results belong to texts, so ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.session import Workspace

LENGTH, GRAM = 200, 80
MOST = 20_000
_SEGMENT = 1 << 20
_BATCH = 20_000
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


# --- anchors ---------------------------------------------------------------------

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_TABLES: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _TABLES:
        n = _SEGMENT + 1024
        _TABLES.extend([_powers(_PRIME, n), _powers(pow(_PRIME, -1, 1 << 64), n)])
    return _TABLES


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position on (a polynomial modulo 2**64, mixed)."""
    up, down = _power_tables()
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(b) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Smallest or largest of every ``width`` neighbours, from block-wise running ones."""
    fill = np.uint64(_MASK) if best is np.minimum else np.uint64(0)
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, fill, dtype=np.uint64)
    padded[: len(x)] = x
    square = padded.reshape(blocks, width)
    ahead = best.accumulate(square, axis=1).ravel()
    back = best.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are smallest in some string of ``length`` bytes (all of them if several are)."""
    whole, places, values = np.frombuffer(data, dtype=np.uint8), [], []
    width = length - gram + 1
    for at in range(0, max(1, len(whole) - length + 1), _SEGMENT - length + 1):
        b = whole[at : at + _SEGMENT]
        if len(b) < length:
            break
        h = gram_hashes(b, gram)
        least = _sliding(h, width, np.minimum)
        edge = np.zeros(width - 1, dtype=np.uint64)
        chosen = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h)
        places.append(chosen + at)
        values.append(h[chosen])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(values)[first]


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = [anchors_of(x.as_py(), length, gram) for x in batch.column(1)]
                rows = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array(np.concatenate([p for p, _ in found]).astype(np.int64)), pa.array(np.concatenate([v for _, v in found]).view(np.int64))],
                        names=["h", "pos", "anchor"])

    return texts.where(F.octet_length("data") >= length).select("h", "data").mapInArrow(run, "h binary, pos bigint, anchor bigint")


def _cuts(found: DataFrame, length: int, gram: int, whole: bool) -> DataFrame:
    """The text around each repeated anchor: rows (h, at, anchor, cut), or with ``whole`` (anchor, cut, shift, bytes).

    ``shift`` is the column of the collection in which the cut begins. The two forms are
    made separately: the places stay small, and the bytes are combined before they are moved.
    """
    side = length - gram
    kinds = [("anchor", pa.int64()), ("cut", pa.binary())] + ([("shift", pa.int32()), ("bytes", pa.binary())] if whole else [("h", pa.binary()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for start in range(0, all_rows.num_rows, 64):
                batch = all_rows.slice(start, 64)
                out: list[list] = [[] for _ in kinds]
                for h, data, places in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    for p in places:
                        low = max(0, p["pos"] - side)
                        cut = data[low : p["pos"] + gram + side]
                        row = (p["anchor"], xxhash.xxh3_128_digest(cut), *((side - (p["pos"] - low), cut) if whole else (h, low)))
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, kinds)], names=[k for k, _ in kinds])

    schema = "anchor bigint, cut binary, " + ("shift int, bytes binary" if whole else "h binary, at bigint")
    return found.select("h", "data", "places").mapInArrow(run, schema)


# --- the collection --------------------------------------------------------------

def repeated_starts(cuts: list[bytes], shifts: list[int], length: int, gram: int) -> np.ndarray:
    """Whether the string that starts in column c of cut i also starts in column c of another cut; (cuts, length - gram + 1)."""
    width, starts, m = 2 * length - gram, length - gram + 1, len(cuts)
    grid = np.full((m, width), 256, dtype=np.int16)
    for i, (cut, shift) in enumerate(zip(cuts, shifts)):
        grid[i, shift : shift + len(cut)] = np.frombuffer(cut, dtype=np.uint8)
    out = np.zeros((m, starts), dtype=bool)
    with tempfile.SpooledTemporaryFile(max_size=32 << 20) as columns:  # in the order of the rounds
        columns.write(np.ascontiguousarray(grid.T[::-1]).tobytes())
        inside = (grid != 256).cumsum(axis=1, dtype=np.int32)
        whole = np.empty((m, starts), dtype=bool)
        for c in range(starts):
            whole[:, c] = inside[:, c + length - 1] - (inside[:, c - 1] if c else 0) == length
        del grid, inside
        columns.seek(0)
        order, common = np.arange(m), np.zeros(m, dtype=np.int32)  # common[j]: with the one before in the order
        for c in range(width - 1, -1, -1):
            column = np.frombuffer(columns.read(2 * m), dtype=np.int16)
            bwt = column[order]
            step = np.argsort(bwt, kind="stable")
            grown = np.zeros(m, dtype=np.int32)
            same = np.flatnonzero(bwt[step[1:]] == bwt[step[:-1]]) + 1
            if len(same):
                # minimum over (previous, this] of the old order, as pairs of bounds
                bounds = np.empty(2 * len(same), dtype=np.int64)
                bounds[0::2] = step[same - 1] + 1
                bounds[1::2] = step[same] + 1
                grown[same] = np.minimum.reduceat(np.append(common, 0), bounds)[0::2] + 1
            order, common = order[step], np.minimum(grown, length)
            if c < starts:
                far = common >= length
                far[:-1] |= far[1:]
                out[order, c] = far
    return out & whole


def _spans(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows (cut, first, last): the bytes of a cut that repeated strings cover. They overlap, so they are one span."""
    starts = length - gram + 1

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        ids, shifts, texts, many = zip(*rows)
        hit = repeated_starts(list(texts), list(shifts), length, gram)
        for i, (shift, text, n) in enumerate(zip(shifts, texts, many)):
            if n > 1:
                hit[i, shift : max(shift, min(starts, shift + len(text) - length + 1))] = True
        any_hit = np.flatnonzero(hit.any(axis=1))
        if not len(any_hit):
            return None
        shift = np.array(shifts)[any_hit]
        first = hit[any_hit].argmax(axis=1) - shift
        last = starts - 1 - hit[any_hit][:, ::-1].argmax(axis=1) - shift + length
        return pa.RecordBatch.from_arrays([pa.array([ids[i] for i in any_hit], pa.binary()), pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64))], names=["cut", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for anchor, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if len(held) >= _BATCH and anchor != last:
                    if (out := solve(held)) is not None:
                        yield out
                    held = []
                held.append(tuple(row))
                last = anchor
        if held and (out := solve(held)) is not None:
            yield out

    dealt = cuts.select("anchor", "cut", "shift", "bytes", "n").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "cut binary, first bigint, last bigint")


def _spans_by_hash(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same rows for anchors with too many cuts: every string by its hash."""
    starts = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, offsets, hashes = [], [], []
                for cut, text, shift, anchor in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    for c in range(min(starts - shift, len(text) - length + 1)):
                        ids.append(cut)
                        offsets.append(c)
                        # strings are compared with those that have the same anchor at the same place
                        hashes.append(xxhash.xxh3_128_digest(b"%d,%d," % (anchor, shift + c) + text[c : c + length]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(offsets, pa.int64()), pa.array(hashes, pa.binary())], names=["cut", "c", "string"])

    strings = cuts.select("cut", "bytes", "shift", "anchor").mapInArrow(run, "cut binary, c bigint, string binary")
    repeated = strings.groupBy("string").agg(F.count("*").alias("k")).where("k > 1")
    alone = strings.join(repeated, "string").groupBy("cut").agg(F.min("c").alias("first"), (F.max("c") + length).alias("last"))
    many = cuts.where((F.col("n") > 1) & (F.octet_length("bytes") >= length)).select("cut", F.lit(0).cast("bigint").alias("first"), F.octet_length("bytes").cast("bigint").alias("last"))
    return alone.unionByName(many).groupBy("cut").agg(F.min("first").alias("first"), F.max("last").alias("last"))


# --- documents -------------------------------------------------------------------

def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    data = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    return docs.select(F.substring(F.unhex(F.sha2(data, 256)), 1, 16).alias("h"), data.alias("data"))


def repeated_spans(docs: DataFrame, space: Workspace, *, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(spans, texts): rows (h, spans) with the removed runs of each text that has any, and rows (h, data) that hold the texts that repeat in part.

    ``h`` is the first half of the text's SHA-256. A text that several rows have loses
    everything; it takes part once, for what it shares with other texts.
    """
    texts = _hashed(docs, text_col).where(F.octet_length("data") >= length)
    anchors = space.write(_anchor_rows(texts, length, gram), "anchors")
    # met in two places, where the same place of equal texts is one
    place = F.xxhash64("h", "pos")
    repeated = space.write(anchors.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("anchor"), "repeated")
    # a table each, so that the shuffles of the anchors are gone before that of the texts
    places = space.write(anchors.join(repeated.hint("shuffle_merge"), "anchor").groupBy("h").agg(F.collect_set(F.struct("pos", "anchor")).alias("places")), "places")
    space.drop("anchors", "repeated")
    met = places.hint("shuffle_merge").join(texts, "h").select("h", "data", "places").dropDuplicates(["h"])
    found = space.write(met, "found")
    space.drop("places")
    cuts = space.write(_cuts(found, length, gram, whole=False), "cuts")
    distinct = _cuts(found, length, gram, whole=True).groupBy("anchor", "cut", "shift", "bytes").agg(F.count("*").alias("n"))
    crowded = space.write(cuts.groupBy("anchor", "cut").agg(F.count("*").alias("k")).groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > most).select("anchor"), "crowded")
    if crowded.isEmpty():
        spans = _spans(distinct, length, gram)
    else:
        distinct = space.write(distinct, "distinct")
        few, many = distinct.join(crowded, "anchor", "left_anti"), distinct.join(crowded, "anchor", "left_semi")
        spans = _spans(few, length, gram).unionByName(_spans_by_hash(many, length, gram))
    spans = space.write(spans, "spans")
    runs = cuts.select("h", "at", "cut").join(spans, "cut").groupBy("h").agg(F.collect_set(F.struct((F.col("at") + F.col("first")).alias("a"), (F.col("at") + F.col("last")).alias("b"))).alias("spans"))
    copies = _hashed(docs, text_col).select("h", F.octet_length("data").cast("bigint").alias("size")).where(F.col("size") >= length).groupBy("h", "size").agg(F.count("*").alias("k")).where("k > 1")
    everything = copies.select("h", F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.col("size").alias("b"))).alias("whole"))
    runs = space.write(runs.join(everything, "h", "full").select("h", F.coalesce("whole", "spans").alias("spans"), F.col("whole").isNotNull().alias("all")), "runs")
    space.drop("distinct", "spans", "cuts", "crowded")
    return runs, found.select("h", "data")


def removal(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte runs as (a, b))."""
    space = Workspace(docs.sparkSession, "suffix")
    runs, texts = repeated_spans(docs, space, text_col=text_col, length=length, gram=gram, most=most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = []
                for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    merged = merge_spans([(s["a"], s["b"]) for s in found])
                    kept, end = hashlib.sha256(), 0
                    for a, b in merged:
                        kept.update(data[end:a])
                        end = b
                    kept.update(data[end:])
                    rows.append((sum(b - a for a, b in merged), len(merged), kept.hexdigest(), [{"a": a, "b": b} for a, b in merged]))
                removed, n, digests, merged = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(digests), pa.array(merged, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                    names=["h", "n_removed", "n_spans", "kept_sha256", "spans"])

    joined = runs.where("not all").hint("shuffle_merge").join(texts, "h").select("h", "data", "spans")
    cleaned = joined.mapInArrow(run, "h binary, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<a:bigint,b:bigint>>")
    nothing = hashlib.sha256(b"").hexdigest()
    gone = runs.where("all").select("h", F.get("spans", F.lit(0))["b"].alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"), F.lit(nothing).alias("kept_sha256"), "spans")
    cleaned = space.write(cleaned.unionByName(gone), "cleaned")
    space.drop("found", "runs")
    data = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    rows = docs.select(docs[id_col].alias("id"), F.sha2(data, 256).alias("whole"), F.octet_length(data).cast("bigint").alias("n_bytes"))
    out = rows.withColumn("h", F.substring(F.unhex("whole"), 1, 16)).join(cleaned, "h", "left")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("spans"))


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the parts of characters at their ends."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def clean_texts(docs: DataFrame, *, text_col: str = "text", chars_col: str | None = "n_chars", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """All documents, with all their columns, without the repeated strings; ``chars_col`` gets the new number of characters.

    Characters that a run covers in part stay, so the text stays valid.
    """
    space = Workspace(docs.sparkSession, "suffix")
    runs, _ = repeated_spans(docs, space, text_col=text_col, length=length, gram=gram, most=most)
    names = docs.columns
    at, chars = names.index(text_col), names.index(chars_col) if chars_col in names else None
    data = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    keyed = docs.withColumn("_suffix_h", F.substring(F.unhex(F.sha2(data, 256)), 1, 16))
    met = keyed.join(runs.select(F.col("h").alias("_suffix_h"), F.col("spans").alias("_suffix_spans")).hint("shuffle_merge"), "_suffix_h", "left").select(*[keyed[c] for c in names], "_suffix_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                columns = list(batch.columns[:-1])
                texts, spans = columns[at].to_pylist(), batch.columns[-1].to_pylist()
                sizes = columns[chars].to_pylist() if chars is not None else []
                for i, found in enumerate(spans):
                    if found:
                        data, kept, end = texts[i].encode(), [], 0
                        for a, b in _whole_characters(data, merge_spans([(x["a"], x["b"]) for x in found])):
                            kept.append(data[end:a])
                            end = b
                        texts[i] = b"".join([*kept, data[end:]]).decode()
                        if chars is not None:
                            sizes[i] = len(texts[i])
                columns[at] = pa.array(texts, columns[at].type)
                if chars is not None:
                    columns[chars] = pa.array(sizes, columns[chars].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return met.mapInArrow(run, docs.schema)
