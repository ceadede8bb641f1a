"""Insight rows derived from the aggregated dashboard frames.

Inputs are the small results of the roll-ups, never reviews or vendors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.scalars import display_category, percent_text
from reviewloom.operators.dedup import unify

# Insight wording; {n} placeholders are filled in order.
TOP_COMPLAINT = (
    "<b>%s</b> is the #1 complaint category — mentioned in <b>%s</b> of negative reviews. Addressing this single "
    "pain point could improve satisfaction across %s dissatisfied couples."
)
COVERAGE_GAP = (
    "<b>Coverage gap:</b> Categories with zero reviews scraped: <b>%s</b>. These represent untapped competitive "
    "intelligence."
)
STATE_GAP = (
    "<b>Geographic expansion:</b> <b>%s states</b> have %s+ vendors but no reviews pulled yet. Top opportunities: %s. "
    "Running a targeted review extraction for these would add significant depth."
)
POSITIVE_SKEW = (
    "<b>Review bias:</b> %s of reviews are positive. This is typical of self-selected marketplace reviews but means "
    "negative signals are high-value — each one represents genuine dissatisfaction worth analyzing individually."
)
PRAISED_QUALITY = (
    "<b>Pricing transparency wins business:</b> Transparency is the #%s most-praised quality (%s mentions). Vendors "
    "who list starting prices publicly get measurably more positive mentions than those requiring inquiry."
)
CATEGORY_SPOTLIGHTS = {
    "djs": "<b>DJ market:</b> %s DJs tracked with %s reviews across all metros. Average rating: %s★. This is our "
           "deepest dataset for competitive analysis.",
    "planners": "<b>Planner market:</b> %s planners tracked with %s reviews. Coverage: %s%%.",
}


def _text(template: str, *cols: Column) -> Column:
    return F.format_string(template, *[c.cast("string") for c in cols])


def _row(df: DataFrame, rule_no: int, kind: str, text: Column) -> DataFrame:
    return df.select(F.lit(rule_no).alias("rule_no"), F.lit(kind).alias("type"), text.alias("text"))


def top_complaint(complaints: DataFrame, split: DataFrame) -> DataFrame:
    """Leading complaint and its share of negative reviews.

    Replies are excluded from the complaint counts but not from the negative total.
    """
    negatives = split.filter(F.col("sentiment") == "negative").select("n").scalar()
    top = complaints.orderBy(F.col("n").desc(), "tag").limit(1).withColumn("negatives", negatives)
    share = F.col("n") * 100.0 / F.greatest(F.col("negatives"), F.lit(1))
    return _row(top, 1, "warning", _text(TOP_COMPLAINT, F.col("tag"), percent_text(share), F.col("negatives")))


def _ordered_names(df: DataFrame, name: Column, *order: Column) -> Column:
    """Comma list in display order. The rows are categories or states of a roll-up."""
    rows = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], name.alias("name"))))
    return F.transform(rows, lambda r: r["name"])


def coverage_gap(categories: DataFrame) -> DataFrame:
    """Categories without any review."""
    empty = categories.filter(F.col("coverage_pct") == 0)
    names = _ordered_names(empty, display_category("category"), F.col("category"))
    listed = empty.agg(names.alias("names")).filter(F.size("names") > 0)
    return _row(listed, 2, "warning", _text(COVERAGE_GAP, F.concat_ws(", ", "names")))


def state_gap(states: DataFrame, min_vendors: int = 20, listed: int = 5) -> DataFrame:
    """States with many vendors and no reviews."""
    empty = states.filter((F.col("reviews") == 0) & (F.col("vendors") > min_vendors))
    names = _ordered_names(empty, F.col("state"), F.col("state"))
    agg = empty.agg(
        F.count(F.lit(1)).alias("n"), F.sum("vendors").alias("vendors"), F.slice(names, 1, listed).alias("names")
    ).filter(F.col("n") > 0)
    return _row(agg, 3, "info", _text(STATE_GAP, F.col("n"), F.col("vendors"), F.concat_ws(", ", "names")))


def positive_skew(split: DataFrame, above: float = 90.0) -> DataFrame:
    hit = split.filter((F.col("sentiment") == "positive") & (F.col("pct") > above))
    return _row(hit, 4, "info", _text(POSITIVE_SKEW, percent_text("pct")))


def praised_quality(praise: DataFrame, tag: str = "transparency") -> DataFrame:
    """Rank and count of one quality among the top praise tags (at most the k rows of the top list)."""
    ranked = praise.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("tag"))))
    return _row(ranked.filter(F.col("tag") == tag), 5, "success", _text(PRAISED_QUALITY, F.col("rank"), F.col("n")))


def category_spotlight(categories: DataFrame, marker: str, rule_no: int, metric: str) -> DataFrame:
    """Numbers of the most reviewed category whose name holds the marker."""
    hit = (
        categories.filter(F.contains(F.col("category"), F.lit(marker)))
        .orderBy(F.col("reviews").desc(), "category")
        .limit(1)
    )
    value = F.col(metric)
    if metric == "avg_rating":
        value = F.coalesce(F.nullif(value, F.lit(0.0)).cast("string"), F.lit("N/A"))
    return _row(hit, rule_no, "success", _text(CATEGORY_SPOTLIGHTS[marker], F.col("vendors"), F.col("reviews"), value))


def all_insights(
    complaints: DataFrame, praise: DataFrame, split: DataFrame, categories: DataFrame, states: DataFrame
) -> DataFrame:
    """Every insight that applies, in rule order."""
    return unify(
        [
            top_complaint(complaints, split),
            coverage_gap(categories),
            state_gap(states),
            positive_skew(split),
            praised_quality(praise),
            category_spotlight(categories, "djs", 6, "avg_rating"),
            category_spotlight(categories, "planners", 7, "coverage_pct"),
        ]
    ).orderBy("rule_no")
