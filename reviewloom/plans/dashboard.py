"""Dashboard export: every section as its own small frame, and the JSON document.

Reviews and vendors are each read once. ``review_facts`` adds up all a dashboard needs
of the reviews in one grouped pass, a row per vendor and a row per tag; the vendor
rows are joined to the vendors, and one aggregate over grouping sets gives the figures
of every category, state and source and the total. These three results are written;
sections are read off them, and none of them touches reviews again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.scalars import star_label
from reviewloom.functions.tagging import blank
from reviewloom.operators import insights
from reviewloom.operators import rollups as ru
from reviewloom.operators.selects import filled, text_chars, vendor_card
from reviewloom.session import Workspace
from reviewloom.sources.sinks import document_of, section_rows

STARS = range(1, 6)
_TAGS = (("complaint", "complaint_categories"), ("praise", "praise_categories"))


class Facts(NamedTuple):
    """Stored results of the passes: reviews by vendor and tag, vendors with their figures, groups of vendors."""

    reviews: DataFrame
    vendors: DataFrame
    groups: DataFrame


def review_facts(reviews: DataFrame) -> DataFrame:
    """One row per vendor with all figures of its reviews, and one per tag with its count: one pass, one exchange.

    A review is a row for its vendor and a row for each of its tags; both kinds are
    summed before the shuffle, by kind and key.
    """
    rating, chars = F.col("rating"), text_chars(reviews)
    r = rating.cast("double")
    measures = {
        "n": F.lit(1), "n20": chars > 20, "n50": chars > 50, "labelled": ~blank("sentiment"), "rated": rating.isNotNull(), "rated20": (chars > 20) & rating.isNotNull(),
        "open_negative": ru.complaint_filter(), **{label: F.col("sentiment") == label for label in lx.SENTIMENTS},
        **{f"star{i}": r.between(1, 5) & (F.round(r, 0) == i) for i in STARS},
    }
    counts = {name: F.coalesce(c.cast("int"), F.lit(0)).alias(name) for name, c in measures.items()}
    money = rating.cast("decimal(12,2)")
    own = F.struct(F.lit("vendor").alias("kind"), F.lit(None).cast("string").alias("tag"), *counts.values(), money.alias("rating"), F.when(chars > 20, money).alias("rating20"))
    nothing = [F.lit(0).alias(name) for name in counts]

    def tagged(kind: str, column: str) -> Column:
        where = ru.complaint_filter() if kind == "complaint" else F.lit(True)
        none = F.lit(None).cast("decimal(12,2)")
        rows = F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda t: F.struct(
            F.lit(kind).alias("kind"), t.alias("tag"), F.lit(1).alias("n"), *nothing[1:], none.alias("rating"), none.alias("rating20")))
        return F.when(where, rows).otherwise(F.slice(rows, 1, 0))

    every = reviews.select("vendor_id", F.explode(F.concat(F.array(own), *[tagged(k, c) for k, c in _TAGS])).alias("f")).select("vendor_id", "f.*")
    key = F.when(F.col("kind") == "vendor", F.col("vendor_id")).alias("vendor_id")
    return every.groupBy("kind", key, "tag").agg(
        *[F.sum(c).alias(c) for c in counts], F.sum("rating").alias("rating_sum"), F.sum("rating20").alias("rating_sum20"), F.min("rating").alias("rating_min"), F.max("rating").alias("rating_max"))


def group_rows(vendors: DataFrame) -> DataFrame:
    """Figures of every category, state and source, and of all vendors, in one aggregate: (by, key, vendors, ...)."""
    sets = ["category", "state", "source"]
    level = F.grouping_id()
    grouped = vendors.groupingSets([[F.col(c)] for c in sets] + [[]], *[F.col(c) for c in sets]).agg(
        level.alias("_level"), F.count(F.lit(1)).alias("vendors"), F.coalesce(F.sum("n20"), F.lit(0)).alias("reviews"), F.sum("rating_sum20").alias("rating_sum"), F.sum("rated20").alias("rated"),
        F.count_if(F.col("n20") > 0).alias("covered"), F.count_if(F.col("open_negative") > 0).alias("negative_vendors"), F.coalesce(F.sum("open_negative"), F.lit(0)).alias("negatives"))
    # the identifier has a bit for each column left out, the first column's being the highest
    by = F.when(F.col("_level") == 3, "category").when(F.col("_level") == 5, "state").when(F.col("_level") == 6, "source").otherwise("all")
    return grouped.select(by.alias("by"), F.coalesce(*sets).alias("key"), *[c for c in grouped.columns if c not in (*sets, "_level")])


def gather(vendors: DataFrame, reviews: DataFrame, space: Workspace) -> Facts:
    """Run the passes and store their results."""
    facts = space.write(review_facts(reviews), "facts")
    totals = facts.where("kind = 'vendor' and vendor_id is not null").drop("kind", "tag").withColumnRenamed("vendor_id", "_vid")
    joined = space.write(vendors.join(totals, F.col("id") == F.col("_vid"), "left").drop("_vid"), "vendors")
    return Facts(facts, joined, space.write(group_rows(joined), "groups"))


# ---- sections -------------------------------------------------------------


def group_coverage(facts: Facts, by: str) -> DataFrame:
    """Per group: vendors, reviews, mean rating and the share of vendors with a review."""
    rows = facts.groups.where((F.col("by") == by) & filled("key"))
    return rows.select(
        F.col("key").alias(by), "vendors", "reviews", F.coalesce(ru.mean_of(F.col("rating_sum"), F.col("rated")), F.lit(0.0)).alias("avg_rating"),
        F.round(F.col("covered") * 100.0 / F.col("vendors"), 0).cast("bigint").alias("coverage_pct"))


def top_tags(facts: Facts, kind: str, k: int | None = 15) -> DataFrame:
    """How often each tag occurs, most frequent first."""
    rows = facts.reviews.where(F.col("kind") == kind).select("tag", "n")
    return rows if k is None else rows.orderBy(F.col("n").desc(), "tag").limit(k)


def _labels(facts: Facts) -> DataFrame:
    """(sentiment, n, total, pct) of every label."""
    row = facts.reviews.where("kind = 'vendor'").agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("total"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in lx.SENTIMENTS])
    rows = F.array(*[F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("n")) for s in lx.SENTIMENTS])
    return row.select("total", F.inline(rows)).select("sentiment", "n", "total", ru.share(F.col("n"), F.col("total")).alias("pct"))


def _stars(facts: Facts) -> DataFrame:
    row = facts.reviews.where("kind = 'vendor'").agg(*[F.coalesce(F.sum(f"star{i}"), F.lit(0)).alias(f"s{i}") for i in STARS])
    return row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("star"), F.col(f"s{i}").alias("n")) for i in STARS]))).select("star", star_label("star").alias("label"), "n")


def _review_kpis(facts: Facts) -> DataFrame:
    return facts.reviews.where("kind = 'vendor'").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_reviews"), F.coalesce(F.sum("n50"), F.lit(0)).alias("with_text"), F.count("vendor_id").alias("vendors_with_reviews"),
        ru.mean_of(F.sum("rating_sum"), F.sum("rated")).alias("avg_rating"), F.min("rating_min").cast("double").alias("min_rating"), F.max("rating_max").cast("double").alias("max_rating"))


def _vendor_kpis(facts: Facts) -> DataFrame:
    by = F.col("by")
    return facts.groups.agg(
        F.coalesce(F.max(F.when(by == "all", F.col("vendors"))), F.lit(0)).alias("total_vendors"), F.count_if((by == "state") & filled("key")).alias("states_covered"),
        F.count_if((by == "source") & F.col("key").isNotNull()).alias("sources"))


def _place(*numbers: Column, text: Column | None = None) -> Column:
    """Where a row stands in its section: by numbers, then by a text."""
    zero = F.lit(0.0)
    n = [x.cast("double") for x in numbers] + [zero] * (3 - len(numbers))
    return F.struct(*[x.alias(f"n{i}") for i, x in enumerate(n)], (F.lit("") if text is None else text).alias("text")).alias("_place")


def _most_reviewed(listed: DataFrame, k: int = 10) -> DataFrame:
    first = F.coalesce(-F.col("review_count").cast("double"), F.lit(float("-inf")))
    return listed.orderBy(F.col("review_count").desc_nulls_first(), "id").limit(k).select(*vendor_card(), _place(first, F.col("id")))


def _best(listed: DataFrame, min_rating: float = 4.8, min_stored: int = 50, k: int = 10) -> DataFrame:
    top = listed.where((F.col("star_rating") >= min_rating) & (F.col("n50") >= min_stored))
    out = top.select(
        "id", F.left(F.col("name"), F.lit(40)).alias("name"), F.coalesce("city", F.lit("")).alias("city"), F.col("star_rating").cast("double").alias("star_rating"), F.col("n50").alias("stored"))
    return out.orderBy(F.col("star_rating").desc(), F.col("stored").desc(), "id").limit(k).select("*", _place(-F.col("star_rating"), -F.col("stored"), F.col("id")))


def insight_rows(facts: Facts) -> DataFrame:
    """Every insight that applies."""
    return insights.all_insights(top_tags(facts, "complaint"), top_tags(facts, "praise"), _labels(facts), group_coverage(facts, "category"), group_coverage(facts, "state"))


def placed_sections(facts: Facts, source: str | None = None) -> dict[str, DataFrame]:
    """All sections with the place of their rows. ``source`` limits the two vendor lists to one marketplace."""
    listed = facts.vendors if source is None else facts.vendors.filter(F.col("source") == source)
    categories, states = group_coverage(facts, "category"), group_coverage(facts, "state")
    negative = facts.groups.where((F.col("by") == "category") & filled("key") & (F.col("negative_vendors") > 0))
    label = F.array_position(F.array(*[F.lit(s) for s in lx.SENTIMENTS]), F.col("sentiment"))
    frequent = _place(-F.col("n"), text=F.col("tag"))
    return {
        "vendor_kpis": _vendor_kpis(facts).select("*", _place()),
        "review_kpis": _review_kpis(facts).select("*", _place()),
        "sentiment": _labels(facts).select("*", _place(label)),
        "rating_dist": _stars(facts).select("*", _place(F.col("star"))),
        "categories": categories.select("*", _place(text=F.col("category"))),
        "top_states": ru.top_groups(states, "state").select("*", _place(-F.col("reviews"), text=F.col("state"))),
        "all_states": states.select("*", _place(text=F.col("state"))),
        "complaints": top_tags(facts, "complaint").select("*", frequent),
        "negative_by_category": negative.select(
            F.col("key").alias("category"), F.col("negative_vendors").alias("vendor_count"), F.col("negatives").alias("negative_count"), _place(text=F.col("key"))),
        "praise": top_tags(facts, "praise").select("*", frequent),
        "top_vendors": _most_reviewed(listed),
        "best_vendors": _best(listed),
        "insights": insight_rows(facts).select("*", _place(F.col("rule_no"))),
    }


def sections(vendors: DataFrame, reviews: DataFrame, source: str | None = None) -> dict[str, DataFrame]:
    """All sections as frames."""
    facts = gather(vendors, reviews, Workspace(vendors.sparkSession, "dashboard"))
    return {name: df.drop("_place") for name, df in placed_sections(facts, source).items()}


def slim(reviews: DataFrame) -> DataFrame:
    """The columns the dashboard needs, with the text reduced to its length."""
    return reviews.select(
        "id", "vendor_id", "source", F.length("review_text").alias("text_chars"), "rating", "sentiment",
        "complaint_categories", "praise_categories", "is_vendor_reply",
    )


def document(vendors: DataFrame, reviews: DataFrame, source: str | None = None) -> DataFrame:
    """The dashboard as one JSON object."""
    space = Workspace(vendors.sparkSession, "dashboard")
    facts = gather(vendors, slim(reviews), space)
    rows = space.write(section_rows(placed_sections(facts, source)), "sections")
    space.drop("facts", "vendors", "groups")
    return document_of(rows, single=("vendor_kpis", "review_kpis"))
