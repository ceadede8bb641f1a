"""Queries of the tagging family, over every document and every turn of a conversation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query
from reviewloom.functions import tagging as tg
from reviewloom.operators import rollups as ru
from reviewloom.plans import tagging as plan

_TAG_COLUMNS = """id, sentiment, sentiment_confidence, array_to_string(complaints, ',') AS complaints,
  array_to_string(praises, ',') AS praises, analysis_model"""


def _show(df, *extra):
    return df.select(
        "id", "sentiment", "sentiment_confidence", b.joined_text("complaint_categories").alias("complaints"),
        b.joined_text("praise_categories").alias("praises"), "analysis_model", *extra,
    )


def _tag_sql(topics, pos, neg, version="v2", select=_TAG_COLUMNS):
    return b.with_ctes(f"SELECT {select} FROM tagged", texts=b.TEXTS, tagged=b.tagged("texts", topics, pos, neg, version))


@query("d01_topics_sorted", b.with_ctes(
    f"SELECT id, array_to_string(list_sort({b.topic_list('lower(review_text)', b.CORPUS_TOPICS)}), ',') AS topics FROM texts",
    texts=b.TEXTS))
def d01(spark, sf):
    found = tg.lexicon_evidence(tg.lowered("review_text"), b.CORPUS_TOPICS)
    return b.texts(spark, sf).select("id", b.joined_text(F.array_sort(found["topics"])).alias("topics"))


@query("d02_topics_lexicon_order", b.with_ctes(
    f"SELECT id, array_to_string({b.topic_list('lower(review_text)', {**lx.REVIEW_TOPICS, **b.CORPUS_TOPICS})}, ',') AS topics FROM texts",
    texts=b.TEXTS))
def d02(spark, sf):
    docs = b.texts(spark, sf)
    found = tg.lexicon_evidence(tg.lowered("review_text"), {**lx.REVIEW_TOPICS, **b.CORPUS_TOPICS})
    return docs.select("id", b.joined_text(found["topics"]).alias("topics"))


@query("d03_sentiment_first_tagger", _tag_sql(
    b.CORPUS_TOPICS, lx.POSITIVE_WORDS_V1 + b.CORPUS_POSITIVE, lx.NEGATIVE_WORDS_V1 + b.CORPUS_NEGATIVE, "v1",
    "id, sentiment, round(sentiment_confidence, 4) AS sentiment_confidence"))
def d03(spark, sf):
    tagged = plan.tag_reviews(
        b.texts(spark, sf), topics=b.CORPUS_TOPICS, positive=lx.POSITIVE_WORDS_V1 + b.CORPUS_POSITIVE,
        negative=lx.NEGATIVE_WORDS_V1 + b.CORPUS_NEGATIVE, version="v1",
    )
    return tagged.select("id", "sentiment", F.round("sentiment_confidence", 4).alias("sentiment_confidence"))


@query("d04_sentiment_production", _tag_sql(
    b.CORPUS_TOPICS, lx.POSITIVE_WORDS + b.CORPUS_POSITIVE, lx.NEGATIVE_WORDS + b.CORPUS_NEGATIVE, "v2",
    "id, sentiment, sentiment_confidence"))
def d04(spark, sf):
    tagged = plan.tag_reviews(
        b.texts(spark, sf), topics=b.CORPUS_TOPICS, positive=lx.POSITIVE_WORDS + b.CORPUS_POSITIVE,
        negative=lx.NEGATIVE_WORDS + b.CORPUS_NEGATIVE,
    )
    return tagged.select("id", "sentiment", "sentiment_confidence")


@query("d01_default_topics_first_tagger", b.with_ctes(
    f"SELECT id, array_to_string(list_sort({b.topic_list('lower(review_text)', lx.REVIEW_TOPICS_V1)}), ',') AS topics FROM (SELECT id, concat(review_text, CASE id % 3 WHEN 0 THEN ' never showed and a surprise fee' WHEN 1 THEN ' no-show, additional charge' ELSE '' END) AS review_text FROM texts)",
    texts=b.TEXTS))
def d01b(spark, sf):
    words = F.expr("CASE id % 3 WHEN 0 THEN ' never showed and a surprise fee' WHEN 1 THEN ' no-show, additional charge' ELSE '' END")
    rows = b.texts(spark, sf).withColumn("review_text", F.concat("review_text", words))
    return plan.tag_reviews(rows, version="v1", keep_topics=True).select("id", b.joined_text("topics").alias("topics"))


@query("d05_routing_first_tagger", _tag_sql(b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE, "v1",
       _TAG_COLUMNS.replace("sentiment_confidence", "round(sentiment_confidence, 4) AS sentiment_confidence")))
def d05(spark, sf):
    tagged = plan.tag_reviews(b.texts(spark, sf), version="v1", **b.CORPUS)
    return _show(tagged.withColumn("sentiment_confidence", F.round("sentiment_confidence", 4)))


@query("d06_routing_production", _tag_sql(b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE))
def d06(spark, sf):
    return _show(plan.tag_reviews(b.texts(spark, sf), **b.CORPUS))


@query("d06_tagging_native_engine", _tag_sql(b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE))
def d06_native(spark, sf):
    return _show(plan.tag_reviews(b.texts(spark, sf), engine="native", **b.CORPUS))


@query("d06_tagging_default_lexicon", _tag_sql(lx.REVIEW_TOPICS, lx.POSITIVE_WORDS, lx.NEGATIVE_WORDS))
def d06_default(spark, sf):
    return _show(plan.tag_reviews(b.texts(spark, sf)))


def _reply_sql(t, phrases, greetings, courtesies):
    start = " OR ".join(f"starts_with({t}, {b.q(g)})" for g in greetings)
    return f"({b.any_of(f'left({t}, 200)', phrases)} OR (({start}) AND {b.any_of(f'left({t}, 150)', courtesies)}))"


_CORPUS_REPLY = _reply_sql("lower(text)", b.CORPUS_REPLIES, b.CORPUS_GREETINGS, b.CORPUS_COURTESIES)
_DEFAULT_REPLY = _reply_sql("lower(text)", lx.REPLY_PHRASES, lx.REPLY_GREETINGS, lx.REPLY_COURTESIES)


@query("d07_vendor_reply_flag", f"""SELECT conv_id, turn, {_CORPUS_REPLY} AS is_reply, {_DEFAULT_REPLY} AS is_reply_default
  FROM conversations""")
def d07(spark, sf):
    return b.table(spark, sf, "conversations").select(
        "conv_id", "turn",
        tg.is_vendor_reply("text", b.CORPUS_REPLIES, b.CORPUS_GREETINGS, b.CORPUS_COURTESIES).alias("is_reply"),
        tg.is_vendor_reply("text").alias("is_reply_default"),
    )


_WRONG = "coalesce((rating <= 2 AND sentiment = 'positive') OR (rating >= 4.5 AND sentiment = 'negative'), false)"
_FROM_RATING = "CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2.5 THEN 'negative' ELSE 'neutral' END"


@query("d08_rating_dominant_correction", b.with_ctes(f"""SELECT id,
    CASE WHEN {_WRONG} THEN {_FROM_RATING} ELSE sentiment END AS sentiment,
    CASE WHEN {_WRONG} THEN 0.9e0 ELSE 0.5e0 END AS sentiment_confidence,
    CASE WHEN {_WRONG} THEN 'rating-dominant-v2' ELSE 'heuristic-rulebased-v1' END AS analysis_model FROM reviews""",
    reviews=b.REVIEWS))
def d08(spark, sf):
    base = b.reviews(spark, sf).withColumns(
        {"sentiment_confidence": F.lit(0.5), "analysis_model": F.lit(lx.MODEL_TAGGED)}
    )
    return plan.correct_contradictions(base).select("id", "sentiment", "sentiment_confidence", "analysis_model")


@query("d09_rating_fill", b.with_ctes(f"""SELECT id, CASE WHEN sentiment = '' THEN {_FROM_RATING} ELSE sentiment END AS sentiment,
    CASE WHEN sentiment = '' THEN '+rating-fill' ELSE NULL END AS analysis_model FROM reviews""", reviews=b.REVIEWS))
def d09(spark, sf):
    base = b.reviews(spark, sf).withColumn("analysis_model", F.lit(None).cast("string"))
    return plan.fill_blank_sentiment(base).select("id", "sentiment", "analysis_model")


@query("d10_reply_model_suffix", f"""SELECT conv_id, turn, CASE WHEN {_DEFAULT_REPLY} THEN 'm+vendor-reply-flag' ELSE 'm' END AS analysis_model
    FROM (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN concat('Hi Ann, thank you. ', text) ELSE text END AS text FROM conversations)""")
def d10(spark, sf):
    turns = b.table(spark, sf, "conversations")
    text = F.when(F.col("role") == "assistant", F.concat(F.lit("Hi Ann, thank you. "), "text")).otherwise(F.col("text"))
    base = turns.select("conv_id", "turn", text.alias("review_text"), F.lit("m").alias("analysis_model"))
    twice = plan.flag_vendor_replies(plan.flag_vendor_replies(base))
    return twice.select("conv_id", "turn", "analysis_model")


_CHAIN_SQL = b.with_ctes(
    f"""SELECT id, CASE WHEN {_WRONG} THEN {_FROM_RATING} ELSE sentiment END AS sentiment,
      CASE WHEN {_WRONG} THEN 0.9e0 ELSE sentiment_confidence END AS sentiment_confidence,
      array_to_string(complaints, ',') AS complaints, array_to_string(praises, ',') AS praises, is_vendor_reply,
      CASE WHEN {_WRONG} THEN 'rating-dominant-v2' WHEN is_vendor_reply THEN concat(analysis_model, '+vendor-reply-flag')
           ELSE analysis_model END AS analysis_model
      FROM (SELECT *, {_DEFAULT_REPLY.replace('lower(text)', 'lower(review_text)')} AS is_vendor_reply FROM tagged)""",
    texts=b.TEXTS, tagged=b.tagged("texts", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE))


@query("d_chain_tag_and_repair", _CHAIN_SQL)
def d_chain(spark, sf):
    return _show(plan.tag_and_repair(b.texts(spark, sf), **b.CORPUS), "is_vendor_reply")


@query("d11_untagged_newest", b.with_ctes("""SELECT r.id, v.name AS vendor_name FROM (SELECT * FROM reviews WHERE sentiment = ''
    ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 500) r JOIN vendors v ON v.id = r.vendor_id""", reviews=b.REVIEWS, vendors=b.VENDORS))
def d11(spark, sf):
    return plan.newest_untagged(b.reviews(spark, sf), b.vendors(spark, sf), limit=500).select("id", "vendor_name")


@query("d11_untagged_in_id_order", b.with_ctes("SELECT id, review_text FROM reviews WHERE sentiment = '' ORDER BY id", reviews=b.REVIEWS))
def d11b(spark, sf):
    """Every untagged review, whatever its date."""
    return plan.untagged_by_id(b.reviews(spark, sf)).select("id", "review_text")


@query("d12_tags_written_back", b.with_ctes("""SELECT r.id, coalesce(t.sentiment, r.sentiment) AS sentiment,
    t.sentiment_confidence AS sentiment_confidence, array_to_string(t.praises, ',') AS praises
    FROM reviews r LEFT JOIN tagged t ON r.id = t.id""", reviews=b.REVIEWS, texts=b.TEXTS,
    tagged=b.tagged("texts", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE)))
def d12(spark, sf):
    from reviewloom.operators.upsert import TAG_POLICY
    from reviewloom.session import shared_dir
    from reviewloom.sources.keyed_table import KeyedTable

    stored = b.reviews(spark, sf).select(
        "id", "sentiment", F.lit(None).cast("double").alias("sentiment_confidence"),
        F.lit(None).cast("array<string>").alias("praise_categories"),
    )
    tags = plan.tag_reviews(b.texts(spark, sf), **b.CORPUS).select(
        "id", "sentiment", "sentiment_confidence", "praise_categories", F.lit(1).alias("seq")
    )
    known = tags.join(stored.select("id"), "id", "left_semi")
    table = KeyedTable(spark, f"{shared_dir(spark)}/tags-{uuid.uuid4().hex}", ["id"], 16)
    table.create(stored)
    table.merge(known, TAG_POLICY, "seq")
    return table.read().select(
        "id", "sentiment", "sentiment_confidence", b.joined_text("praise_categories").alias("praises")
    )


_REPORT = dict(texts=b.TEXTS, tagged=b.tagged("texts", b.CORPUS_TOPICS, b.CORPUS_POSITIVE, b.CORPUS_NEGATIVE))


@query("d13_tagging_report_sentiment", b.with_ctes("""SELECT l.sentiment, count(t.id) AS n,
    (SELECT count(*) FROM tagged) AS total, CAST(count(t.id) * 100 // greatest((SELECT count(*) FROM tagged), 1) AS BIGINT) AS pct
    FROM (SELECT unnest(['positive', 'neutral', 'negative']) AS sentiment) l LEFT JOIN tagged t ON t.sentiment = l.sentiment
    GROUP BY 1""", **_REPORT))
def d13a(spark, sf):
    return ru.tagging_report(plan.tag_reviews(b.texts(spark, sf), keep_topics=True, **b.CORPUS))[0]


@query("d13_tagging_report_topics", b.with_ctes("""SELECT tag, count(*) AS n FROM (SELECT unnest(topics) AS tag FROM tagged)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", **_REPORT))
def d13b(spark, sf):
    return ru.tagging_report(plan.tag_reviews(b.texts(spark, sf), keep_topics=True, **b.CORPUS))[1]


@query("d14_complaints_outside_vocabulary", b.with_ctes(f"""SELECT id, array_to_string(complaints, ',') AS complaints FROM tagged
    WHERE len(list_filter(complaints, lambda x: x NOT IN ({', '.join(b.q(w) for w in lx.COMPLAINT_VOCABULARY)}))) > 0""", **_REPORT))
def d14b(spark, sf):
    from reviewloom.operators.audits import unknown_tags

    tagged = plan.tag_reviews(b.texts(spark, sf), **b.CORPUS)
    return unknown_tags(tagged, "complaint_categories", lx.COMPLAINT_VOCABULARY).select(
        "id", b.joined_text("complaint_categories").alias("complaints")
    )


@query("d14_tags_outside_vocabulary", b.with_ctes(f"""SELECT id, array_to_string(praises, ',') AS praises FROM tagged
    WHERE len(list_filter(praises, lambda x: x NOT IN ({', '.join(b.q(w) for w in lx.PRAISE_VOCABULARY)}))) > 0""", **_REPORT))
def d14(spark, sf):
    from reviewloom.operators.audits import unknown_tags

    tagged = plan.tag_reviews(b.texts(spark, sf), **b.CORPUS)
    return unknown_tags(tagged, "praise_categories", lx.PRAISE_VOCABULARY).select(
        "id", b.joined_text("praise_categories").alias("praises")
    )
