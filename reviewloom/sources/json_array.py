"""Large JSON array files, read by many tasks.

A file that is one JSON array is a single document to Spark's JSON reader, so one task
reads it. Here it is read as text cut at every closing brace, which Spark splits by byte
ranges, in two passes. Whether a split begins inside a string, and how deep, depends on
all bytes before it, so the first pass works out for each split what it does to either
state; these are chained on the driver, a few numbers per split. The second pass knows
where it stands: it puts the pieces of each record together and hands on its text. Only
what a split border cuts, at most two fragments per split, is joined over splits.

The elements have to be objects; texts and numbers between them are left out. Files are read through Spark, from
any store it knows. What follows the array's end is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"?', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]|\\.)*"?', re.DOTALL)  # from inside a string
_BRACKETS = re.compile(r"[\[\]{}]")


def _after(piece: str, inside: bool) -> tuple[int, bool]:
    """(change of depth, whether the end is inside a string) of a piece that starts outside or inside one."""
    at, depth = 0, 0
    if inside:
        at = _REST.match(piece).end()
        if not _closed(piece, 0, at, True):
            return 0, True
    while True:
        quote = piece.find('"', at)
        for bracket in _BRACKETS.findall(piece, at, len(piece) if quote < 0 else quote):
            depth += 1 if bracket in "[{" else -1
        if quote < 0:
            return depth, False
        at = _STRING.match(piece, quote).end()
        if not _closed(piece, quote, at, False):
            return depth, True


def _first_object(piece: str, inside: bool) -> int:
    """Where the first object of a piece begins, outside of strings; -1 without one."""
    at = _REST.match(piece).end() if inside else 0
    if inside and not _closed(piece, 0, at, True):
        return -1
    while True:
        brace, quote = piece.find("{", at), piece.find('"', at)
        if brace < 0 or quote < 0 or brace < quote:
            return brace
        at = _STRING.match(piece, quote).end()


def _closed(piece: str, start: int, end: int, inside: bool) -> bool:
    """Whether the string that a match covers has its closing quote."""
    return end - start > (0 if inside else 1) and piece[end - 1] == '"' and not _escaped(piece, start if inside else start + 1, end - 1)


def _escaped(piece: str, start: int, at: int) -> bool:
    n = 0
    while at - n - 1 >= start and piece[at - n - 1] == "\\":
        n += 1
    return n % 2 == 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does: for a start outside and inside a string, the change of depth and the state at its end."""
    found: dict[tuple[str, int], list] = {}
    for path, start, piece in _rows(batches):
        states = found.setdefault((path, start), [[0, False], [0, True]])
        for state in states:
            change, state[1] = _after(piece, state[1])
            # the brace that ended the piece; the last piece of a file has none, and nothing follows it
            state[0] += change - (not state[1])
    yield pa.RecordBatch.from_pylist(
        [{"path": p, "start": s, "out_depth": a[0], "out_inside": a[1], "in_depth": b[0], "in_inside": b[1]} for (p, s), (a, b) in found.items()],
        pa.schema([("path", pa.string()), ("start", pa.int64()), ("out_depth", pa.int64()), ("out_inside", pa.bool_()), ("in_depth", pa.int64()), ("in_inside", pa.bool_())]))


def _records(starts: dict[tuple[str, int], tuple[int, bool]]):
    """Pieces to records (kind ``whole``) and to the fragments at the ends of a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, str, str]] = []
        here, n, depth, inside, parts, kind = None, 0, 0, False, [], "whole"

        def tail() -> None:
            """What is left when a split ends: a record begun here, or one that neither began nor ended here."""
            if here and parts and depth > 1:
                out.append((*here, n, "middle" if kind == "head" else "tail", "".join(parts)))

        for path, start, piece in _rows(batches):
            if here != (path, start):
                tail()
                here, n, parts = (path, start), 0, []
                depth, inside = starts[here]
                kind = "head" if depth > 1 else "whole"
            begin = 0 if parts or kind == "head" else _first_object(piece, inside)
            change, inside = _after(piece, inside)
            depth += change
            if begin >= 0:
                parts.append(piece[begin:] + "}")
            if not inside:
                depth -= 1
                if depth == 1 and parts:
                    out.append((*here, n, kind, "".join(parts)))
                    n, parts, kind = n + 1, [], "whole"
            if len(out) >= 1000:
                yield batch(out)
                out = []
        tail()
        yield batch(out)

    def batch(rows: list) -> pa.RecordBatch:
        names = ["path", "start", "n", "kind", "value"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=names)

    return run


def array_records(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, start, n, value): the text of every object of JSON array files, ``start`` and ``n`` in file order."""
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", "}").text(pattern).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), "value")
    effects = pieces.mapInArrow(_effects, "path string, start bigint, out_depth bigint, out_inside boolean, in_depth bigint, in_inside boolean")
    starts, last, depth, inside = {}, None, 0, False
    for e in effects.orderBy("path", "start").toLocalIterator():  # a row per split
        if e["path"] != last:
            last, depth, inside = e["path"], 0, False
        starts[e["path"], e["start"]] = (depth, inside)
        change, inside = (e["in_depth"], e["in_inside"]) if inside else (e["out_depth"], e["out_inside"])
        depth += change
    found = pieces.mapInArrow(_records(starts), "path string, start bigint, n bigint, kind string, value string")
    whole = found.where("kind = 'whole'").drop("kind")
    order = Window.partitionBy("path").orderBy("start", "n")
    cut = found.where("kind <> 'whole'").withColumn("record", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "n", "value")))
    joined = cut.groupBy("path", "record").agg(parts.alias("parts")).select(
        "path", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["n"].alias("n"), F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("value"))
    return whole.unionByName(joined)


def read_array(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Objects of JSON array files in a schema, as the multi-line JSON reader gives them, but read by many tasks."""
    return array_records(spark, pattern).select(F.from_json("value", schema).alias("r")).select("r.*")
