"""Data-quality audits: fill rates, contradictions and constraint violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom import lexicons as lx
from reviewloom.functions.tagging import blank
from reviewloom.operators.selects import filled


def _stack(row: DataFrame, names: Sequence[str], total: str = "total") -> DataFrame:
    """One wide row of counts to (field, n, total) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("n")) for n in names])
    return row.select(total, F.inline(pairs)).select("field", "n", total)


def is_present(df: DataFrame, column: str) -> Column:
    """Not null, not blank, not zero, not an empty list."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return filled(column)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if isinstance(kind, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def fill_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, n, total, pct) of the filled values of each column; one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(is_present(df, c)).alias(c) for c in columns])
    return _stack(counts, columns).withColumn("pct", F.try_divide(F.col("n") * 100.0, "total"))


def vendor_coverage(vendors: DataFrame) -> DataFrame:
    """Share of vendors with each contact, price and reputation field, whole percent."""
    checks: Mapping[str, Column] = {
        "phone": filled("phone"),
        "email": filled("email"),
        "website": filled("website_url"),
        "pricing": F.col("starting_price_min").isNotNull() | F.col("starting_price_avg").isNotNull(),
        "rating": F.col("star_rating") > 0,
        "reviews": F.col("review_count") > 0,
        "city": filled("city"),
    }
    counts = vendors.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in checks.items()])
    return _stack(counts, list(checks)).withColumn("pct", F.floor(F.try_divide(F.col("n") * 100, F.col("total"))))


def rating_range(records: DataFrame, rating: str = "star_rating") -> DataFrame:
    r = F.nullif(F.col(rating).cast("double"), F.lit(0.0))
    return records.agg(F.count(r).alias("rated"), F.min(r).alias("lowest"), F.max(r).alias("highest"))


def tag_audit(reviews: DataFrame) -> DataFrame:
    """Counts of contradicting tags, short texts and reviews with any tag."""
    s, r = F.col("sentiment"), F.col("rating")
    tagged = (F.size("complaint_categories") > 0) | (F.size("praise_categories") > 0)
    return reviews.agg(
        F.count_if((s == "negative") & (r >= 5)).alias("five_star_negative"),
        F.count_if((s == "positive") & (r <= 2)).alias("low_star_positive"),
        F.count_if(F.length(F.trim("review_text")) < 20).alias("short_texts"),
        F.count_if(tagged).alias("with_any_topic"),
    )


def contradictions(reviews: DataFrame) -> DataFrame:
    s, r = F.col("sentiment"), F.col("rating")
    return reviews.agg(
        F.count_if((s == "negative") & (r >= 5)).alias("five_star_negative"),
        F.count_if((s == "positive") & (r <= 2)).alias("low_star_positive"),
    )


def sentiment_distribution(reviews: DataFrame) -> DataFrame:
    """Rows per label after repair, blanks shown as ``(empty)``, with the replies in each."""
    label = F.when(blank("sentiment"), "(empty)").otherwise(F.col("sentiment"))
    return reviews.groupBy(label.alias("sentiment")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_vendor_reply").alias("vendor_replies")
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent does not exist."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def outside_vocabulary(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def unknown_tags(df: DataFrame, tags: str, allowed: Sequence[str]) -> DataFrame:
    """Rows that carry a tag outside the closed vocabulary."""
    return df.filter(F.size(F.array_except(F.col(tags), F.array(*[F.lit(a) for a in allowed]))) > 0)


def missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a required column and the names of those columns."""
    holes = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("missing", holes).filter(F.size("missing") > 0)


def review_violations(reviews: DataFrame, vendors: DataFrame) -> DataFrame:
    """(check, violations) of every constraint of the review table, from one pass over it.

    A review is a row for its key and a row for its vendor; both kinds are counted in
    one aggregate, combined before the shuffle, together with what can be seen in the
    review alone. Only vendor rows then meet the vendor table, one per vendor.
    """
    wrong = F.col("sentiment").isNotNull() & ~F.col("sentiment").isin("", *lx.SENTIMENTS)
    missing = F.col("review_text").isNull()
    text = lambda c: F.col(c).cast("string")
    own = F.struct(F.lit("key").alias("kind"), text("source").alias("a"), text("source_review_id").alias("b"), wrong.cast("int").alias("wrong"), missing.cast("int").alias("missing"))
    owner = F.struct(F.lit("vendor").alias("kind"), text("vendor_id").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(0).alias("wrong"), F.lit(0).alias("missing"))
    rows = reviews.select(F.explode(F.array(own, owner)).alias("r")).select("r.*")
    seen = rows.groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("wrong").alias("wrong"), F.sum("missing").alias("missing"))
    known = vendors.select(F.lit("vendor").alias("kind"), text("id").alias("a")).distinct().withColumn("known", F.lit(True))
    checked = seen.join(known, ["kind", "a"], "left")
    is_key, total = F.col("kind") == "key", lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = {
        "unique_review_key": F.count_if(is_key & (F.col("n") > 1)),
        "vendor_exists": total(F.when(~is_key & F.col("known").isNull(), F.col("n"))),
        "sentiment_label": total("wrong"),
        "text_present": total("missing"),
    }
    row = checked.agg(*[c.alias(name) for name, c in counts.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("violations")) for name in counts])))
