"""The review tagging plan: topics, polarity, reply flag and rating repair in one pass.

Every step is a projection over the row itself. The plan has no shuffle, so it
scales with the number of input splits, and a hot vendor or source costs nothing.
An input that is one split is one task: spread it before tagging where cores are idle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions import tagging as tg


def tag_reviews(
    reviews: DataFrame,
    text: str = "review_text",
    rating: str = "rating",
    topics: Mapping[str, Sequence[str]] | None = None,
    positive: Sequence[str] | None = None,
    negative: Sequence[str] | None = None,
    version: str = "v2",
    keep_topics: bool = False,
    engine: str = "arrow",
) -> DataFrame:
    """Add sentiment, sentiment_confidence, complaint/praise categories and the model label."""
    if version not in ("v1", "v2"):
        raise ValueError("version is v1 or v2")
    topics = topics or (lx.REVIEW_TOPICS_V1 if version == "v1" else lx.REVIEW_TOPICS)
    if version == "v1":
        pos_words = list(positive or lx.POSITIVE_WORDS_V1)
        neg_words = list(negative or lx.NEGATIVE_WORDS_V1)
        signal, confidence = tg.rating_signal_v1(rating), tg.confidence_v1
    else:
        pos_words = list(dict.fromkeys(positive or lx.POSITIVE_WORDS))
        neg_words = list(dict.fromkeys(negative or lx.NEGATIVE_WORDS))
        signal, confidence = tg.rating_signal_v2(rating), tg.confidence_v2

    base = reviews.columns
    found = reviews.withColumn("_low", tg.lowered(text)).select(
        *base, tg.lexicon_evidence("_low", topics, pos_words, neg_words, engine).alias("_found")
    )
    topic_names = F.col("_found.topics")
    evidence = found.select(
        *base,
        (F.array_sort(topic_names) if version == "v1" else topic_names).alias("_topics"),
        F.col("_found.pos").alias("_pos"),
        F.col("_found.neg").alias("_neg"),
        signal.alias("_signal"),
    )
    scored = evidence.withColumn("_score", F.col("_signal") + F.col("_pos") - F.col("_neg"))
    labelled = scored.withColumn("sentiment", tg.sentiment_of("_score"))
    drop = {"sentiment", "sentiment_confidence", "complaint_categories", "praise_categories", "analysis_model"}
    return labelled.select(
        *[c for c in base if c not in drop],
        "sentiment",
        confidence(F.col("_score"), F.col("_pos"), F.col("_neg"), F.col("_signal")).alias("sentiment_confidence"),
        tg.route_complaints(F.col("sentiment"), F.col("_topics"), version).alias("complaint_categories"),
        tg.route_praises(F.col("sentiment"), F.col("_topics"), version).alias("praise_categories"),
        F.lit(lx.MODEL_TAGGED).alias("analysis_model"),
        *([F.col("_topics").alias("topics")] if keep_topics else []),
    )


def flag_vendor_replies(reviews: DataFrame, text: str = "review_text") -> DataFrame:
    """Mark vendor replies and note it once in the model label."""
    headed = reviews.withColumn("_head", tg.reply_head(text))
    flagged = headed.withColumn("is_vendor_reply", tg.reply_opening("_head")).drop("_head")
    model = F.col("analysis_model")
    already = F.contains(model, F.lit(lx.MODEL_SUFFIX_REPLY))
    return flagged.withColumn(
        "analysis_model",
        F.when(F.col("is_vendor_reply") & ~F.coalesce(already, F.lit(False)),
               F.concat(model, F.lit(lx.MODEL_SUFFIX_REPLY))).otherwise(model),
    )


def correct_contradictions(reviews: DataFrame, rating: str = "rating") -> DataFrame:
    """Let a clear rating win over a contradicting tag."""
    marked = reviews.withColumn("_wrong", tg.rating_contradicts("sentiment", rating))
    return (
        marked.withColumn(
            "sentiment", F.when(F.col("_wrong"), tg.sentiment_from_rating(rating)).otherwise(F.col("sentiment"))
        )
        .withColumn(
            "sentiment_confidence", F.when(F.col("_wrong"), F.lit(0.9)).otherwise(F.col("sentiment_confidence"))
        )
        .withColumn(
            "analysis_model",
            F.when(F.col("_wrong"), F.lit(lx.MODEL_RATING_DOMINANT)).otherwise(F.col("analysis_model")),
        )
        .drop("_wrong")
    )


def fill_blank_sentiment(reviews: DataFrame, rating: str = "rating") -> DataFrame:
    """Give untagged reviews the sentiment of their rating."""
    marked = reviews.withColumn("_blank", tg.blank("sentiment"))
    return (
        marked.withColumn(
            "sentiment", F.when(F.col("_blank"), tg.sentiment_from_rating(rating)).otherwise(F.col("sentiment"))
        )
        .withColumn(
            "analysis_model",
            F.when(
                F.col("_blank"), F.concat(F.coalesce("analysis_model", F.lit("")), F.lit(lx.MODEL_SUFFIX_FILL))
            ).otherwise(F.col("analysis_model")),
        )
        .drop("_blank")
    )


def repair(reviews: DataFrame, text: str = "review_text", rating: str = "rating") -> DataFrame:
    """Reply flag, then contradictions, then blanks: the order matters."""
    return fill_blank_sentiment(correct_contradictions(flag_vendor_replies(reviews, text), rating), rating)


def tag_and_repair(reviews: DataFrame, text: str = "review_text", rating: str = "rating", **lexicon) -> DataFrame:
    """The whole tagging plan over a review table."""
    return repair(tag_reviews(reviews, text, rating, **lexicon), text, rating)


def untagged(reviews: DataFrame) -> DataFrame:
    """Reviews without a sentiment yet."""
    return reviews.filter(tg.blank("sentiment"))


def untagged_by_id(reviews: DataFrame, after: object = None, limit: int | None = None, key: str = "id") -> DataFrame:
    """Work list of a bulk run: untagged reviews of any date in key order, all of them or the next ``limit`` ones after a key."""
    rows = untagged(reviews)
    rows = (rows if after is None else rows.filter(F.col(key) > F.lit(after))).orderBy(key)
    return rows if limit is None else rows.limit(limit)


def newest_untagged(
    reviews: DataFrame, vendors: DataFrame, limit: int | None = None, order: str = "scraped_at", key: str = "id"
) -> DataFrame:
    """Untagged reviews with their vendor's name: all of them, or the ``limit`` newest.

    A limit is applied before the join: each review has exactly one vendor, and
    reviews whose vendor is unknown are removed by the semi join first.
    """
    known = untagged(reviews).join(
        vendors.select(F.col("id").alias("vendor_id")), "vendor_id", "left_semi"
    )
    chosen = known if limit is None else known.orderBy(F.col(order).desc_nulls_first(), key).limit(limit)
    names = vendors.select(F.col("id").alias("vendor_id"), F.col("name").alias("vendor_name"))
    return chosen.join(names, "vendor_id")
