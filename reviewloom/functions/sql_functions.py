"""SQL-callable forms of the scalar operators, as temporary functions.

``review_evidence`` is the one-scan lexicon matcher; the others are plain SQL
expressions that Catalyst inlines. Each function of a text that needs the matcher
has it run anew, in workers of its own: a query that wants several facts takes the
evidence once, as a column, and ``polarity_sentiment`` of it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from reviewloom import lexicons as lx
from reviewloom.functions.tagging import lexicon_udf


def _lit(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {_lit(w)})" for w in words) + ")"


def definitions() -> dict[str, str]:
    """Function name to ``(arguments) RETURNS type RETURN expression``."""
    evidence = "review_evidence(lower(coalesce(t, '')))"
    dated = r"r'([A-Z][a-z]+)\s+(\d+),\s*(\d{4})'"
    month, day, year = (f"regexp_extract(t, {dated}, {i})" for i in (1, 2, 3))
    signal = "CASE WHEN r >= 4.5 THEN 3 WHEN r >= 4 THEN 2 WHEN r >= 3 THEN 0 WHEN r >= 2 THEN -2 WHEN r >= 1 THEN -3 ELSE 0 END"
    p = "coalesce(nullif(a, 0D), m)"
    tier = " ".join(
        f"WHEN c = {_lit(code)} THEN CASE WHEN {p} < {lo} THEN 'budget' WHEN {p} < {mid} THEN 'mid' ELSE 'premium' END"
        for code, (lo, mid) in lx.TIER_THRESHOLDS.items()
    )
    lo, mid = lx.TIER_THRESHOLDS[lx.DEFAULT_TIER_CATEGORY]
    return {
        "review_topics": f"(t STRING) RETURNS ARRAY<STRING> RETURN {evidence}.topics",
        "review_polarity": f"(t STRING) RETURNS INT RETURN {evidence}.pos - {evidence}.neg",
        "polarity_sentiment": "(p INT, r DOUBLE) RETURNS STRING RETURN "
                              f"CASE sign({signal} + p) WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END",
        "review_sentiment": "(t STRING, r DOUBLE) RETURNS STRING RETURN polarity_sentiment(review_polarity(t), r)",
        "vendor_reply_low": f"(t STRING) RETURNS BOOLEAN RETURN {_any('t', lx.REPLY_PHRASES)} OR "
                            f"(({' OR '.join(f'startswith(t, {_lit(g)})' for g in lx.REPLY_GREETINGS)}) AND "
                            f"{_any('left(t, 150)', lx.REPLY_COURTESIES)})",
        "vendor_reply": "(t STRING) RETURNS BOOLEAN RETURN vendor_reply_low(left(lower(left(coalesce(t, ''), 200)), 200))",
        "parse_price": "(t STRING) RETURNS DOUBLE RETURN try_cast(replace(regexp_extract("
                       "replace(replace(replace(lower(t), 'starting at', ''), 'from', ''), 'starting price', ''), "
                       r"r'\d+[,\d]*\.?\d*', 0), ',', '') AS DOUBLE)",
        "price_tier": f"(c STRING, a DOUBLE, m DOUBLE) RETURNS STRING RETURN CASE WHEN {p} IS NULL THEN 'unknown' "
                      f"{tier} WHEN {p} < {lo} THEN 'budget' WHEN {p} < {mid} THEN 'mid' ELSE 'premium' END",
        "parse_review_date": "(t STRING) RETURNS DATE RETURN coalesce("
                             f"CASE WHEN length({month}) = 3 THEN try_to_date(concat({month}, ' ', {day}, ', ', {year}), 'MMM d, yyyy') END, "
                             r"try_cast(regexp_extract(t, r'\d{4}-\d{2}-\d{2}', 0) AS DATE))",
    }


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    spark.udf.register("review_evidence", lexicon_udf(lx.REVIEW_TOPICS, lx.POSITIVE_WORDS, lx.NEGATIVE_WORDS))
    for name, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return ["review_evidence", *definitions()]
