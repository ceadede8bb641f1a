"""Aggregations of the dashboard family.

Reviews are reduced to one row per vendor before they meet the vendor table, so
the join is one-to-one and a vendor or category with a third of all reviews
costs one partial sum per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.scalars import col_of, star_label
from reviewloom.functions.tagging import blank
from reviewloom.operators.selects import filled, text_chars, vendors_with_totals


def share(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Percentage with a zero-safe denominator."""
    pct = part * F.lit(100.0) / F.greatest(whole, F.lit(1))
    return pct if digits is None else F.round(pct, digits)


def mean_of(total: Column, n: Column, digits: int = 2, ties_to_even: bool = False) -> Column:
    """Rounded mean from an exact sum and its count; null without values.

    Division and rounding are decimal: a mean of exactly x.xx5 rounds the same way
    on every run and in every engine.
    """
    mean = F.try_divide(total.cast("decimal(28,6)"), n.cast("decimal(18,0)"))
    return (F.bround(mean, digits) if ties_to_even else F.round(mean, digits)).cast("double")


def count_by(df: DataFrame, key: str, missing: str = "?") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(key), F.lit(missing)).alias(key)).agg(F.count(F.lit(1)).alias("n"))


def review_kpis(reviews: DataFrame, min_text: int = 50) -> DataFrame:
    """Headline numbers of the review table in one pass."""
    r = F.col("rating").cast("decimal(12,2)")
    return reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(text_chars(reviews) > min_text).alias("with_text"),
        F.count_distinct("vendor_id").alias("vendors_with_reviews"),
        mean_of(F.sum(r), F.count("rating")).alias("avg_rating"),
        F.min("rating").cast("double").alias("min_rating"),
        F.max("rating").cast("double").alias("max_rating"),
    )


def vendor_kpis(vendors: DataFrame) -> DataFrame:
    return vendors.agg(
        F.count(F.lit(1)).alias("total_vendors"),
        F.count_distinct(F.nullif(F.col("state"), F.lit(""))).alias("states_covered"),
        F.count_distinct("source").alias("sources"),
    )


def contact_by_source(vendors: DataFrame) -> DataFrame:
    """Vendors with phone, email and pricing per source: one pass instead of three queries."""
    return vendors.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(filled("phone")).alias("with_phone"),
        F.count_if(filled("email")).alias("with_email"),
        F.count_if(F.col("starting_price_min").isNotNull()).alias("with_pricing"),
    )


def coverage_rollup(vendors: DataFrame, reviews: DataFrame, by: str = "category", min_text: int = 20) -> DataFrame:
    """Per group: vendors, reviews, mean rating and the share of vendors with a review."""
    counted = vendors_with_totals(
        vendors.filter(filled(by)).select("id", by), reviews, text_chars(reviews) > min_text
    )
    return (
        counted.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("vendors"),
            F.sum("n_reviews").alias("reviews"),
            F.coalesce(mean_of(F.sum("rating_sum"), F.sum("n_rated")), F.lit(0.0)).alias("avg_rating"),
            F.count_if("has_reviews").alias("_covered"),
        )
        .withColumn("coverage_pct", F.round(F.col("_covered") * 100.0 / F.col("vendors"), 0).cast("bigint"))
        .drop("_covered")
    )


def top_groups(rollup: DataFrame, by: str, k: int = 15) -> DataFrame:
    return rollup.orderBy(F.col("reviews").desc(), by).limit(k)


def sentiment_split(reviews: DataFrame, labels: Sequence[str] = tuple(lx.SENTIMENTS)) -> DataFrame:
    """Count and percentage per label, absent labels as zero; blanks are not counted."""
    s = F.col("sentiment")
    totals = reviews.filter(~blank("sentiment")).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(s == label).alias(label) for label in labels]
    )
    rows = F.array(*[F.struct(F.lit(label).alias("sentiment"), F.col(label).alias("n")) for label in labels])
    return totals.select("total", F.inline(rows)).select(
        "sentiment", "n", "total", share(F.col("n"), F.col("total")).alias("pct")
    )


def tag_frequency(df: DataFrame, tags: str, where: Column | None = None, k: int | None = 15) -> DataFrame:
    """How often each tag occurs, most frequent first."""
    src = df if where is None else df.filter(where)
    counts = src.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.col("n").desc(), "tag").limit(k)


def complaint_filter() -> Column:
    """Negative reviews that are not vendor replies."""
    return (F.col("sentiment") == "negative") & ~F.coalesce("is_vendor_reply", F.lit(False))


def negative_by_category(vendors: DataFrame, reviews: DataFrame) -> DataFrame:
    """Vendors and reviews behind the complaints of each category."""
    per_vendor = (
        reviews.filter(complaint_filter()).groupBy("vendor_id").agg(F.count(F.lit(1)).alias("n_negative"))
    )
    side = vendors.filter(filled("category")).select(F.col("id").alias("vendor_id"), "category")
    return (
        per_vendor.join(side, "vendor_id")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("vendor_count"), F.sum("n_negative").alias("negative_count"))
    )


def star_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per rounded star, always five rows; halves round away from zero."""
    r = F.col("rating").cast("double")
    star = F.round(r, 0)
    counts = reviews.filter(r.between(1, 5)).agg(*[F.count_if(star == i).alias(f"s{i}") for i in range(1, 6)])
    rows = F.array(*[F.struct(F.lit(i).alias("star"), F.col(f"s{i}").alias("n")) for i in range(1, 6)])
    return counts.select(F.inline(rows)).select("star", star_label("star").alias("label"), "n")


def rating_bands(reviews: DataFrame) -> DataFrame:
    r = F.col("rating").cast("double")
    return reviews.filter(r.isNotNull()).agg(
        F.count_if(r >= 4.5).alias("high"),
        F.count_if((r >= 3.5) & (r < 4.5)).alias("mid"),
        F.count_if((r >= 1) & (r < 3.5)).alias("low"),
    )


def rating_by_sentiment(reviews: DataFrame) -> DataFrame:
    r = F.col("rating")
    return reviews.filter(r.isNotNull()).groupBy("sentiment").agg(
        mean_of(F.sum(r.cast("decimal(12,2)")), F.count("rating")).alias("avg_rating"),
        F.count_if(r >= 4).alias("high_rated"),
        F.count_if(r <= 2).alias("low_rated"),
        F.count(F.lit(1)).alias("total"),
    )


def price_by_source(vendors: DataFrame) -> DataFrame:
    """Mean of lowest and average prices with the extremes, per source."""
    lo, avg = F.col("starting_price_min"), F.col("starting_price_avg")
    return vendors.filter(lo.isNotNull()).groupBy("source").agg(
        mean_of(F.sum(lo.cast("decimal(18,2)")), F.count(lo), 0).alias("avg_min"),
        mean_of(F.sum(avg.cast("decimal(18,2)")), F.count(avg), 0).alias("avg_avg"),
        F.min(lo).cast("double").alias("lowest"),
        F.max(avg).cast("double").alias("highest"),
    )


def reviews_per_vendor(vendors: DataFrame, reviews: DataFrame, k: int | None = 10) -> DataFrame:
    """Stored reviews per (name, source), the most reviewed first."""
    per_vendor = reviews.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_vendor.join(vendors.select(F.col("id").alias("vendor_id"), "name", "source"), "vendor_id")
    counts = named.groupBy("name", "source").agg(F.sum("n").alias("reviews"))
    return counts if k is None else counts.orderBy(F.col("reviews").desc(), "name", "source").limit(k)


def best_rated(
    vendors: DataFrame, reviews: DataFrame, min_rating: float = 4.8, min_stored: int = 50, min_text: int = 50,
    k: int | None = 10,
) -> DataFrame:
    """Highly rated vendors with enough stored reviews of substance."""
    stored = (
        reviews.filter(text_chars(reviews) > min_text)
        .groupBy("vendor_id")
        .agg(F.count(F.lit(1)).alias("stored"))
        .filter(F.col("stored") >= min_stored)
    )
    top = vendors.filter(F.col("star_rating") >= min_rating).join(stored, F.col("id") == F.col("vendor_id"))
    out = top.select(
        "id", F.left(F.col("name"), F.lit(40)).alias("name"), F.coalesce("city", F.lit("")).alias("city"),
        F.col("star_rating").cast("double").alias("star_rating"), "stored",
    )
    return out if k is None else out.orderBy(F.col("star_rating").desc(), F.col("stored").desc(), "id").limit(k)


def claimed_vs_stored(vendors: DataFrame, reviews: DataFrame, min_claimed: int = 100) -> DataFrame:
    """Claimed review numbers of big vendors next to what is stored."""
    big = vendors.filter(F.col("review_count") > min_claimed).select("id", "name", "source", "review_count")
    return vendors_with_totals(big, reviews).select(
        "id", "name", F.col("review_count").cast("bigint").alias("claimed"), F.col("n_reviews").alias("stored")
    )


def review_metrics_by_source(vendors: DataFrame) -> DataFrame:
    rc = F.col("review_count").cast("bigint")
    star = F.col("star_rating").cast("decimal(12,2)")
    return vendors.filter(F.col("review_count") > 0).groupBy("source").agg(
        F.count(F.lit(1)).alias("vendors"),
        F.sum(rc).alias("total_reviews"),
        mean_of(F.sum(star), F.count("star_rating")).alias("avg_rating"),
        mean_of(F.sum(rc), F.count(rc), 0).alias("avg_reviews"),
    )


def claimed_total(vendors: DataFrame) -> DataFrame:
    return vendors.agg(F.coalesce(F.sum(F.col("review_count").cast("bigint")), F.lit(0)).alias("claimed_reviews"))


def text_by_source(reviews: DataFrame, min_text: int = 50) -> DataFrame:
    return reviews.groupBy("source").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(text_chars(reviews) > min_text).alias("with_text"),
        F.count_distinct("vendor_id").alias("vendors"),
    )


def review_presence(vendors: DataFrame, reviews: DataFrame) -> DataFrame:
    """How many vendors have stored reviews and how many have none."""
    return vendors_with_totals(vendors.select("id"), reviews).agg(
        F.count(F.lit(1)).alias("vendors"),
        F.count_if("has_reviews").alias("with_reviews"),
        F.count_if(~F.col("has_reviews")).alias("without_reviews"),
    )


def source_list(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce("source", F.lit("?")).alias("source")).distinct()


def bar_width(df: DataFrame, value: str, floor: float = 1.0, out: str = "width") -> DataFrame:
    """Bar length relative to the largest value, never below the floor."""
    top = df.agg(F.max(value)).scalar()
    return df.withColumn(
        out, F.greatest(F.coalesce(F.try_divide(F.col(value) * 100.0, top), F.lit(0.0)), F.lit(float(floor)))
    )


def extraction_summary(records: DataFrame, success: str = "scrape_success") -> DataFrame:
    """Per source: found, successful and how many carry each important field."""
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.coalesce(F.col(success), F.lit(False))).alias("successful"),
        F.count_if(~F.coalesce(F.col(success), F.lit(False))).alias("failed"),
        F.count_if(filled("phone")).alias("with_phone"),
        F.count_if(filled("email")).alias("with_email"),
        F.count_if(F.coalesce(F.col("star_rating"), F.lit(0)) > 0).alias("with_rating"),
        F.count_if(F.col("starting_price_min").isNotNull()).alias("with_pricing"),
    )


def tagging_report(reviews: DataFrame, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """(sentiment counts with whole percentages, most frequent topics) of a tagging run.

    Expects reviews tagged with ``keep_topics=True``: topics count for every sentiment.
    """
    split = sentiment_split(reviews).withColumn(
        "pct", F.floor(F.col("n") * 100 / F.greatest("total", F.lit(1)))
    )
    return split, tag_frequency(reviews, "topics", k=k)


def any_tag(complaints: Column | str = "complaint_categories", praises: Column | str = "praise_categories") -> Column:
    return (F.coalesce(F.size(col_of(complaints)), F.lit(0)) > 0) | (F.coalesce(F.size(col_of(praises)), F.lit(0)) > 0)
