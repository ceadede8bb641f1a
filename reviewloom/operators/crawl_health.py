"""Crawl-health reports over page bodies and request logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.scalars import col_of, contains_any, matched_words
from reviewloom.operators.rollups import mean_of

_MB = 1024.0 * 1024.0
STATUSES = ["ok", "blocked", "captcha", "error"]


def size_mb(html: Column | str) -> Column:
    return F.length(col_of(html)) / F.lit(_MB)


def with_page_status(
    pages: DataFrame, html: str = "html", text: str | None = None,
    block_words: Sequence[str] = tuple(lx.PAGE_BLOCK_WORDS), captcha_words: Sequence[str] = tuple(lx.PAGE_CAPTCHA_WORDS),
    min_size: int = 1000,
) -> DataFrame:
    """Add ``status`` (blocked, captcha, error, ok) and the words that decided it."""
    source = F.lower(F.coalesce(F.col(html), F.lit("")))
    if text:
        source = F.concat_ws("\n", F.lower(F.coalesce(F.col(text), F.lit(""))), source)
    prepared = pages.withColumn("_low", source)
    judged = prepared.withColumn("_blocks", matched_words("_low", block_words)).withColumn(
        "_captcha", F.slice(matched_words("_low", captcha_words), 1, 1)
    )
    blocked, captcha = F.size("_blocks") > 0, F.size("_captcha") > 0
    small = F.coalesce(F.length(html), F.lit(0)) < min_size
    return (
        judged.withColumn(
            "status", F.when(blocked, "blocked").when(captcha, "captcha").when(small, "error").otherwise("ok")
        )
        .withColumn(
            "evidence",
            F.when(blocked, F.col("_blocks"))
            .when(captcha, F.col("_captcha"))
            .when(small, F.array(F.lit("empty_content")))
            .otherwise(F.array().cast("array<string>")),
        )
        .drop("_low", "_blocks", "_captcha")
    )


def is_blocked(
    text: Column | str, title: Column | str,
    words: Sequence[str] = tuple(lx.BLOCK_TEXT_WORDS), titles: Sequence[str] = tuple(lx.BLOCK_TITLE_WORDS),
) -> Column:
    """Block page by wording in the source or in the title."""
    body, head = (F.lower(F.coalesce(col_of(c), F.lit(""))) for c in (text, title))
    return contains_any(body, words) | contains_any(head, titles)


def is_captcha(
    html: Column | str, markers: Sequence[str] = tuple(lx.CAPTCHA_MARKUP), frames: Sequence[str] = tuple(lx.CAPTCHA_FRAMES)
) -> Column:
    """Captcha by markup, or by the source of an embedded frame."""
    h = F.coalesce(col_of(html), F.lit(""))
    frame = r'(?i)<iframe[^>]*src="[^"]*(' + "|".join(frames) + ")"
    return contains_any(F.lower(h), markers) | h.rlike(frame)


def real_block_flags(
    pages: DataFrame, html: str = "html", body: str = "body", title: str = "title",
    words: Sequence[str] = tuple(lx.REAL_BLOCK_WORDS), titles: Sequence[str] = tuple(lx.CHALLENGE_TITLES),
    data_words: Sequence[str] = tuple(lx.VENDOR_DATA_WORDS), big_mb: float = 0.5,
) -> DataFrame:
    """Tell real block pages from full pages that merely mention blocking."""
    prepared = pages.withColumn("_body", F.lower(F.coalesce(F.col(body), F.lit(""))))
    size = F.coalesce(size_mb(html), F.lit(0.0))
    length = F.length("_body")
    worded = contains_any("_body", words)
    challenged = contains_any(F.lower(F.coalesce(F.col(title), F.lit(""))), titles)
    return prepared.select(
        *pages.columns,
        (worded & ((size < big_mb) | challenged | (length < 500))).alias("real_block"),
        ((size > big_mb) & (length > 1000)).alias("has_content"),
        contains_any("_body", data_words).alias("has_vendor_data"),
    )


def status_by_source(log: DataFrame, statuses: Sequence[str] = tuple(STATUSES)) -> DataFrame:
    """Requests per status and the whole ok percentage, per source."""
    s = F.col("status")
    return (
        log.groupBy("source")
        .agg(F.count(F.lit(1)).alias("total"), *[F.count_if(s == name).alias(name) for name in statuses])
        .withColumn("ok_pct", F.bround(F.col("ok") * 100.0 / F.col("total"), 0).cast("bigint"))
    )


def ok_by_phase(log: DataFrame) -> DataFrame:
    """Ok share per source and phase of the test."""
    return (
        log.groupBy("source", "phase")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("blocked")).alias("ok"))
        .withColumn("ok_pct", F.floor(F.col("ok") * 100 / F.col("total")))
    )


def first_block(log: DataFrame, details: Sequence[str] = ("phase", "delay", "reason")) -> DataFrame:
    """The earliest blocked request of every source."""
    blocked = log.filter("blocked")
    first = F.min_by(F.struct("idx", *details), F.col("idx"))
    return blocked.groupBy("source").agg(first.alias("f"), F.count(F.lit(1)).alias("blocked")).select(
        "source", "blocked", "f.*"
    )


def block_kinds(log: DataFrame, big_mb: float = 0.5) -> DataFrame:
    """Real blocks (small page) against false positives (full page)."""
    b, mb = F.col("blocked"), F.col("html_mb")
    return log.groupBy("source").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(b & (mb < big_mb)).alias("real_blocks"),
        F.count_if(b & (mb >= big_mb)).alias("false_positives"),
        F.count_if(~b).alias("successful"),
    )


def run_metrics(log: DataFrame, *by: str) -> DataFrame:
    """Attempts, success rate, blocks, captchas and mean duration."""
    micros = F.sum(F.col("elapsed").cast("decimal(18,6)"))
    return (
        log.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(F.col("status") == "ok").alias("successful"),
            F.count_if(F.col("status") == "blocked").alias("blocked"),
            F.count_if(F.col("status") == "captcha").alias("captcha"),
            mean_of(micros, F.count("elapsed"), 4).alias("avg_duration"),
        )
        .withColumn("success_rate", F.try_divide(F.col("successful") * 100.0, F.col("attempts")))
    )


def hourly(log: DataFrame, ts: str = "ts", every: str = "1 hour") -> DataFrame:
    """Success and total per hour; works on a batch and on a watermarked stream."""
    return (
        log.groupBy(F.window(ts, every))
        .agg(F.count_if(F.col("status") == "ok").alias("successful"), F.count(F.lit(1)).alias("total"))
        .select(F.col("window.start").alias("hour"), "successful", "total")
    )


def alerts(metrics: DataFrame, *by: str) -> DataFrame:
    """One row per broken threshold of a metrics frame."""
    n = F.greatest(F.col("attempts"), F.lit(1))
    fraction = lambda c: F.col(c) / n
    rule = lambda name, value: F.struct(F.lit(name).alias("alert"), F.round(value, 4).alias("value"))
    rules = F.array_compact(
        F.array(
            F.when((F.col("success_rate") < 50) & (F.col("attempts") >= 10), rule("low_success", F.col("success_rate"))),
            F.when(fraction("blocked") > 0.3, rule("high_block", fraction("blocked"))),
            F.when(fraction("captcha") > 0.5, rule("high_captcha", fraction("captcha"))),
        )
    )
    return metrics.select(*by, F.inline(rules))


def rule_health(attempts: DataFrame, healthy_from: float = 80.0, failing_below: float = 50.0) -> DataFrame:
    """Success rate of every extraction rule and whether its element is failing.

    The window runs over one row per rule, after aggregation.
    """
    rates = attempts.groupBy("element", "rule").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if("success").alias("successes")
    )
    rate = F.col("successes") * 100.0 / F.col("attempts")
    best = F.max("success_rate").over(Window.partitionBy("element"))
    return (
        rates.withColumn("success_rate", rate)
        .withColumn("healthy", (F.col("success_rate") >= healthy_from) & (F.col("successes") > 0))
        .withColumn("element_failing", best < failing_below)
    )
