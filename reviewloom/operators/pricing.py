"""Market benchmarks per category: median, tiers, histogram, position of a price.

Each of these needs a small fact per category (a rank, a range, a mean) next to
every listing. The fact is aggregated with map-side partial sums, written, and
joined back: its real size is then known, so Spark broadcasts it when it is small
and listings are never shuffled by a category that may hold a third of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.scalars import col_of, market_position, percent_of_range
from reviewloom.operators.dedup import top_by_key
from reviewloom.operators.rollups import mean_of
from reviewloom.session import materialize

TIERS = ["budget", "mid", "premium", "unknown"]
_STEP = 1000.0
NO_GROUP = "OTHER"


def grouped(df: DataFrame, by: str) -> DataFrame:
    """Rows without a group belong to the group of the others."""
    return df.withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit(NO_GROUP)))


def priced(df: DataFrame, by: str, price: str) -> DataFrame:
    """(group, price) of the priced rows."""
    return grouped(df, by).filter(F.col(price).isNotNull()).select(by, F.col(price).cast("double").alias("price"))


def upper_median(df: DataFrame, by: str, price: str) -> DataFrame:
    """(group, median_price): element ``n // 2`` of the sorted prices, exact.

    Ranks are found in two steps, thousands and then the exact price inside the one
    thousand that holds the rank. A window holds one row per distinct value of its
    step: at most 100,000 for prices below one hundred million with two decimals.
    """
    rows = priced(df, by, price).withColumn("_hi", F.floor(F.col("price") / _STEP))
    steps = rows.groupBy(by, "_hi").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy(by).orderBy("_hi")
    ranked = steps.select(
        by, "_hi",
        (F.sum("n").over(run) - F.col("n")).alias("_before"),
        F.col("n").alias("_n"),
        F.floor(F.sum("n").over(Window.partitionBy(by)) / 2).alias("_rank"),
    )
    holds_rank = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    chosen = materialize(ranked.filter(holds_rank).select(by, "_hi", "_before", "_rank"), "median_step")
    inside = rows.join(chosen, [by, "_hi"]).groupBy(by, "price", "_before", "_rank").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(by).orderBy("price")) + F.col("_before")
    return (
        inside.select(by, "price", "_rank", upto.alias("_upto"))
        .filter(F.col("_rank") < F.col("_upto"))
        .groupBy(by)
        .agg(F.min("price").alias("median_price"))
    )


def market_stats(
    listings: DataFrame, by: str = "category", price_min: str = "starting_price_min",
    price_avg: str = "starting_price_avg", rating: str = "star_rating", reviews: str = "review_count",
    tier: str = "price_tier",
) -> DataFrame:
    """Counts, price range, median, means and tier counts per category, zeros when empty."""
    listings = grouped(listings, by)
    lo, avg = F.col(price_min), F.col(price_avg)
    stars = F.nullif(F.col(rating).cast("double"), F.lit(0.0))
    t = F.coalesce(F.col(tier), F.lit("unknown"))
    main = listings.groupBy(by).agg(
        F.count(F.lit(1)).alias("count"),
        F.count(lo).alias("with_price"),
        F.coalesce(F.min(lo).cast("double"), F.lit(0.0)).alias("min_price"),
        F.coalesce(F.max(lo).cast("double"), F.lit(0.0)).alias("max_price"),
        F.coalesce(F.try_divide(F.sum(avg.cast("decimal(28,6)")).cast("double"), F.count(avg)), F.lit(0.0)).alias("avg_price"),
        F.coalesce(
            mean_of(F.sum(stars.cast("decimal(28,6)")), F.count(stars), 2, ties_to_even=True), F.lit(0.0)
        ).alias("avg_rating"),
        F.coalesce(F.sum(F.col(reviews).cast("bigint")), F.lit(0)).alias("total_reviews"),
        *[F.count_if(t == name).alias(f"tier_{name}") for name in TIERS],
        F.count_if(~t.isin(TIERS)).alias("tier_other"),
    )
    median = upper_median(listings, by, price_min)
    return main.join(median, by, "left").withColumn("median_price", F.coalesce("median_price", F.lit(0.0)))


def tier_counts(listings: DataFrame, by: str = "category", tier: str = "price_tier") -> DataFrame:
    """One column per price tier: a missing tier is ``unknown``, one that is not listed counts as ``tier_other``."""
    t = F.coalesce(F.col(tier), F.lit("unknown"))
    return grouped(listings, by).groupBy(by).agg(*[F.count_if(t == name).alias(name) for name in TIERS], F.count_if(~t.isin(TIERS)).alias("tier_other"))


def price_histogram(listings: DataFrame, by: str = "category", price: str = "starting_price_min") -> DataFrame:
    """Non-empty price bins of a fifth of the range; the highest price opens a sixth bin.

    Groups need two priced rows.
    """
    rows = priced(listings, by, price)
    bounds = materialize(
        rows.groupBy(by)
        .agg(F.min("price").alias("_lo"), F.max("price").alias("_hi"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(by, "_lo", F.greatest(F.lit(1.0), (F.col("_hi") - F.col("_lo")) / 5).alias("_step")),
        "price_bounds",
    )
    binned = rows.join(bounds, by).withColumn("bin", F.floor((F.col("price") - F.col("_lo")) / F.col("_step")))
    return binned.groupBy(by, "bin").agg(
        F.min(F.col("_lo") + F.col("bin") * F.col("_step")).alias("bin_start"), F.count(F.lit(1)).alias("n")
    )


def with_market_position(
    listings: DataFrame, stats: DataFrame, by: str = "category", price: str = "starting_price_min"
) -> DataFrame:
    """Each listing's place in its market."""
    side = materialize(
        stats.select(
            by, F.col("avg_price").alias("_avg"), F.col("min_price").alias("_min"), F.col("max_price").alias("_max")
        ),
        "market_stats",
    )
    return (
        grouped(listings, by).join(side, by, "left")
        .withColumn("market_position", market_position(price, "_avg"))
        .withColumn("pct_of_range", percent_of_range(F.col(price).cast("double"), "_min", "_max"))
        .drop("_avg", "_min", "_max")
    )


def top_per_category(
    listings: DataFrame, by: str = "category", k: int = 5, count: str = "review_count",
    tiebreak: Sequence[Column | str] = ("name", "id"),
) -> DataFrame:
    """The most reviewed listings of every category."""
    order = [F.coalesce(F.col(count), F.lit(0)).desc(), *[col_of(t) for t in tiebreak]]
    return top_by_key(listings, [by], order, k, rank="rank")


def catalogue_order(catalogue: DataFrame, place: str | None = None, tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """Package catalogue by category, then market average with unknown last, then name; ``place`` names a column for the place in the category."""
    avg = F.coalesce(F.nullif(F.col("market_avg").cast("double"), F.lit(0.0)), F.lit(99999.0))
    order = [avg, F.col("name"), *[col_of(t) for t in tiebreak]]
    if place:
        catalogue = catalogue.withColumn(place, F.row_number().over(Window.partitionBy("category").orderBy(*order)))
    return catalogue.orderBy("category", *order)
