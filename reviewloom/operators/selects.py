"""Filters, joins and work lists over vendors and reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.scalars import col_of, display_category


def text_longer(c: Column | str, n: int) -> Column:
    return F.length(col_of(c)) > n


def text_chars(df: DataFrame) -> Column:
    """Review text length: the stored ``text_chars`` where a table has it, so the text itself is not read."""
    return F.col("text_chars") if "text_chars" in df.columns else F.length("review_text")


def text_between(c: Column | str, low: int, high: int, banned: Sequence[str] = ()) -> Column:
    """Review-like block: length strictly inside the bounds and no banned word."""
    t = col_of(c)
    keep = (F.length(t) > low) & (F.length(t) < high)
    for word in banned:
        keep = keep & ~F.contains(t, F.lit(word))
    return keep


def filled(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit("")).isNotNull()


def ilike_any(c: Column | str, patterns: Sequence[str]) -> Column:
    """Case-insensitive containment of any pattern."""
    return reduce(lambda a, b: a | b, [F.ilike(col_of(c), F.lit(f"%{p}%")) for p in patterns])


def reachable_pages(pages: DataFrame, status: str = "status") -> DataFrame:
    """Pages that may be read for prices; failed ones stay in the page list."""
    return pages.filter(F.col(status) < 400)


def with_vendor(reviews: DataFrame, vendors: DataFrame, *columns: str) -> DataFrame:
    """Reviews with columns of their vendor.

    The shuffle is on vendor_id; when one vendor holds a large share of the
    reviews the skew join splits that partition on the review side.
    """
    side = vendors.select(F.col("id").alias("vendor_id"), *columns)
    return reviews.join(side, "vendor_id")


def review_totals(reviews: DataFrame, where: Column | None = None) -> DataFrame:
    """Per vendor: reviews, rating sum and rated count, summed before the shuffle.

    Ratings are added as decimals, so totals do not depend on the order of addition.
    """
    src = reviews if where is None else reviews.filter(where)
    return src.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum(F.col("rating").cast("decimal(12,2)")).alias("rating_sum"),
        F.count("rating").alias("n_rated"),
    )


def vendors_with_totals(vendors: DataFrame, reviews: DataFrame, where: Column | None = None) -> DataFrame:
    """Every vendor with the totals of its qualifying reviews; vendors without any stay."""
    totals = review_totals(reviews, where).withColumnRenamed("vendor_id", "_vid")
    return (
        vendors.join(totals, F.col("id") == F.col("_vid"), "left")
        .withColumn("has_reviews", F.col("_vid").isNotNull())
        .withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0)))
        .withColumn("n_rated", F.coalesce("n_rated", F.lit(0)))
        .drop("_vid")
    )


def backfill(vendors: DataFrame, reviews: DataFrame, claimed: str = "review_count") -> DataFrame:
    """Vendors whose stored reviews fall short of the claimed number."""
    counted = vendors_with_totals(vendors, reviews)
    claim = F.coalesce(F.col(claimed), F.lit(0)).cast("bigint")
    return counted.withColumn("needed", claim - F.col("n_reviews")).filter(F.col("needed") > 0)


def split_known(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(already stored, new) rows of a batch."""
    keys = existing.select(*key)
    return incoming.join(keys, list(key), "left_semi"), incoming.join(keys, list(key), "left_anti")


def attach_vendor_id(incoming: DataFrame, vendors: DataFrame, storefront: str = "source_vendor_id") -> DataFrame:
    """Surrogate vendor id for incoming reviews by (source, storefront id)."""
    # one id per storefront, so that a vendor stored twice does not double its reviews
    ids = vendors.groupBy("source", F.col("source_vendor_id").alias(storefront)).agg(F.min("id").alias("vendor_id"))
    return incoming.join(ids, ["source", storefront])


def observed_totals(vendors: DataFrame, observed: DataFrame, total: str = "total", order: str | None = None) -> DataFrame:
    """Vendors with review_count replaced where a different total was observed.

    Of several observations of a vendor the last one by ``order`` counts, else the largest.
    """
    n = F.col(total).cast("bigint")
    best = F.max(F.struct(F.col(order).alias("o"), n.alias("n")))["n"] if order else F.max(n)
    seen = observed.groupBy(F.col("vendor_id").alias("id")).agg(best.alias("_total"))
    changed = F.col("_total").isNotNull() & ~F.col("_total").eqNullSafe(F.col("review_count").cast("bigint"))
    return (
        vendors.join(seen, "id", "left")
        .withColumn("count_changed", changed)
        .withColumn(
            "review_count", F.when(changed, F.col("_total")).otherwise(F.col("review_count").cast("bigint"))
        )
        .drop("_total")
    )


def vendor_card(name_width: int = 40) -> list[Column]:
    """Display columns of a vendor listing."""
    rating = F.nullif(F.col("star_rating").cast("double"), F.lit(0.0))
    return [
        F.left(F.col("name"), F.lit(name_width)).alias("name"),
        F.coalesce("city", F.lit("")).alias("city"),
        F.coalesce("state", F.lit("")).alias("state"),
        display_category("category").alias("category"),
        F.col("review_count").cast("bigint").alias("review_count"),
        F.coalesce(rating.cast("string"), F.lit("-")).alias("star_rating"),
    ]


def _matches(vendors: DataFrame, text: str | None, equals: dict[str, str] | None, min_rating: float | None) -> DataFrame:
    found = vendors
    if text:
        found = found.filter(F.contains(F.lower("name"), F.lit(text.lower())))
    for column, value in (equals or {}).items():
        found = found.filter(F.col(column) == value)
    if min_rating is not None:
        found = found.filter(F.col("star_rating") >= min_rating)
    return found


def search_vendors(
    vendors: DataFrame,
    text: str | None = None,
    equals: dict[str, str] | None = None,
    min_rating: float | None = None,
    order: Sequence[Column | str] = ("name", "id"),
    page: int = 1,
    page_size: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """(one page of matching vendors, frame with the total number of matches)."""
    found = _matches(vendors, text, equals, min_rating)
    total = found.agg(F.count(F.lit(1)).alias("total"))
    return found.orderBy(*[col_of(o) for o in order]).offset((page - 1) * page_size).limit(page_size), total


class Page(NamedTuple):
    """Rows of one page, the number of matches on all pages, and where the next page starts (nothing after the last one)."""

    rows: list[Row]
    total: int
    after: tuple | None


def _after(order: Sequence[tuple[str, bool]], last: Sequence) -> Column:
    """Rows behind a given one in an order of (column, descending), nulls last."""
    behind, same = F.lit(False), F.lit(True)
    for (name, down), value in zip(order, last):
        c = F.col(name)
        if value is None:  # nothing is behind a null but a later column
            same = same & c.isNull()
            continue
        further = (c < F.lit(value)) if down else (c > F.lit(value))
        behind = behind | (same & F.coalesce(further, F.lit(True)))
        same = same & F.coalesce(c == F.lit(value), F.lit(False))
    return behind


def search_page(
    vendors: DataFrame, text: str | None = None, equals: dict[str, str] | None = None, min_rating: float | None = None,
    order: Sequence[tuple[str, bool]] = (("name", False), ("id", False)), after: Sequence | None = None, page_size: int = 20,
) -> Page:
    """One page of matching vendors, in an order of (column, descending) whose last column is unique.

    A page starts after the last row of the one before, so a late page is a filter and a
    top-k like the first; the total is observed while the same rows go by.
    """
    found = _matches(vendors, text, equals, min_rating)
    seen = Observation()
    rest = found.observe(seen, F.count(F.lit(1)).alias("total"))
    if after is not None:
        rest = rest.filter(_after(order, after))
    rows = rest.orderBy(*[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]).limit(page_size).collect()
    more = len(rows) == page_size
    return Page(rows, seen.get["total"], tuple(rows[-1][c] for c, _ in order) if more else None)


def seeded_sample(df: DataFrame, key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` rows by the smallest seeded hash of their key: the same rows at any partitioning, each task keeps at most ``k``."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    return df.orderBy(mark, *key).limit(k)


def suspicious_positives(reviews: DataFrame, words: Sequence[str] = tuple(lx.SUSPICIOUS_POSITIVE_WORDS)) -> DataFrame:
    """Positive-tagged reviews that contain complaint words."""
    return reviews.filter((F.col("sentiment") == "positive") & ilike_any("review_text", words))


def likely_replies(reviews: DataFrame, phrases: Sequence[str] = tuple(lx.AUDIT_REPLY_PHRASES)) -> DataFrame:
    """Reviews that read like a vendor's reply."""
    return reviews.filter(F.ilike(F.col("review_text"), F.lit("Hi %")) & ilike_any("review_text", phrases))
