"""Deterministic deduplication and set operations.

``first_by_key`` filters on ``row_number() = 1``. Spark plans a group limit in
front of the shuffle for that shape, so every map task sends at most one row per
key and a key that holds a third of the table never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.scalars import col_of, price_key


def first_by_key(df: DataFrame, key: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """Keep one row per key, the first in the given order."""
    w = Window.partitionBy(*[col_of(k) for k in key]).orderBy(*[col_of(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top_by_key(
    df: DataFrame, key: Sequence[Column | str], order: Sequence[Column | str], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every group; the order needs a unique last column."""
    name = rank or "_rn"
    w = Window.partitionBy(*[col_of(k) for k in key]).orderBy(*[col_of(o) for o in order])
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_by_name(df: DataFrame, name: str, order: Sequence[Column | str], min_length: int = 3) -> DataFrame:
    """Dedup on the trimmed lower-case name; shorter names are dropped."""
    key = F.trim(F.lower(F.col(name)))
    return first_by_key(df.filter(F.length(key) >= min_length), [key], order)


def first_review(df: DataFrame, reviewer: str, body: str, order: Sequence[Column | str], prefix: int = 100) -> DataFrame:
    """Near-duplicate reviews: same reviewer and same opening of the body."""
    return first_by_key(df, [reviewer, F.left(F.col(body), F.lit(prefix))], order)


def first_block(
    df: DataFrame, group: Sequence[Column | str], block: str, order: Sequence[Column | str], prefix: int = 100
) -> DataFrame:
    """Near-duplicate text blocks of one page or vendor: same opening."""
    return first_by_key(df, [*group, F.left(F.col(block), F.lit(prefix))], order)


def distinct_prices(prices: Column | str) -> Column:
    """Drop repeated prices inside a row's list, keeping the first spelling."""
    p = col_of(prices)
    keys = F.transform(p, price_key)
    return F.filter(p, lambda v, i: F.array_position(keys, price_key(v)) == i + 1)


def distinct_prefix(df: DataFrame, column: str, order: Sequence[Column | str], prefix: int = 120) -> DataFrame:
    """One row per opening of a text such as a request url."""
    return first_by_key(df, [F.left(F.col(column), F.lit(prefix))], order)


def unify(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack differently shaped sources into one table, missing columns as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def positional_id(owner: Column | str, position: Column | str, label: str = "") -> Column:
    """``owner-3`` or ``owner-label-3``; unstable when the page order changes."""
    parts = [col_of(owner).cast("string")] + ([F.lit(label)] if label else []) + [col_of(position).cast("string")]
    return F.concat_ws("-", *parts)


def content_id(*cols: Column | str) -> Column:
    """Order-independent id from the content itself."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols]), 256)
