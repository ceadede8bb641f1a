"""Queries of the crawl-health family, over pages and the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.catalog import bindings as b
from reviewloom.catalog.bindings import query, with_ctes
from reviewloom.functions import markup
from reviewloom.operators import crawl_health as ch

LOG = b.LOG
# Markers that occur in the synthetic pages stand in for the protection markers.
BLOCKS = lx.PAGE_BLOCK_WORDS + ["%%%", "###", "heit"]
CAPTCHAS = lx.PAGE_CAPTCHA_WORDS + ["que", "elle"]


def _matched(text, words):
    return "list_filter([" + ", ".join(f"CASE WHEN contains({text}, {b.q(w)}) THEN {b.q(w)} END" for w in words) + "], lambda x: x IS NOT NULL)"


@query("k01_page_status", f"""SELECT page_id, CASE WHEN len(bl) > 0 THEN 'blocked' WHEN len(ca) > 0 THEN 'captcha' WHEN length(html) < 1200 THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN len(bl) > 0 THEN array_to_string(bl, ',') WHEN len(ca) > 0 THEN ca[1] WHEN length(html) < 1200 THEN 'empty_content' ELSE '' END AS evidence
    FROM (SELECT page_id, html, {_matched('lower(html)', BLOCKS)} AS bl, {_matched('lower(html)', CAPTCHAS)} AS ca FROM pages)""")
def k01(spark, sf):
    pages = ch.with_page_status(b.table(spark, sf, "pages"), block_words=BLOCKS, captcha_words=CAPTCHAS, min_size=1200)
    return pages.select("page_id", "status", b.joined_text("evidence").alias("evidence"))


_TITLE = "lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))"


@query("k02_block_flag", f"""SELECT page_id, {b.any_of('lower(html)', lx.BLOCK_TEXT_WORDS + ['###'])} OR {b.any_of(_TITLE, lx.BLOCK_TITLE_WORDS + ['que'])} AS blocked FROM pages""")
def k02(spark, sf):
    flag = ch.is_blocked("html", markup.page_title("html"), lx.BLOCK_TEXT_WORDS + ["###"], lx.BLOCK_TITLE_WORDS + ["que"])
    return b.table(spark, sf, "pages").select("page_id", flag.alias("blocked"))


@query("k03_captcha_flag", f"""SELECT page_id, {b.any_of('lower(html)', lx.CAPTCHA_MARKUP + ['%%%'])} OR contains(url, '.org') AS captcha FROM pages""")
def k03(spark, sf):
    framed = F.when(F.contains("url", F.lit(".org")), F.concat("html", F.lit('<iframe id="x" src="https://hcaptcha.test/a"></iframe>'))).otherwise(F.col("html"))
    return b.table(spark, sf, "pages").select("page_id", ch.is_captcha(framed, lx.CAPTCHA_MARKUP + ["%%%"]).alias("captcha"))


_SMALL = 0.002


@query("k04_real_block", f"""SELECT page_id, worded AND (mb < {_SMALL} OR challenged OR length(body) < 500) AS real_block,
    mb > {_SMALL} AND length(body) > 1000 AS has_content, {b.any_of('body', lx.VENDOR_DATA_WORDS + ['heit'])} AS has_vendor_data FROM (
    SELECT page_id, {b.any_of('lower(html)', lx.REAL_BLOCK_WORDS + ['que'])} AS worded, {b.any_of(_TITLE, lx.CHALLENGE_TITLES + ['elle'])} AS challenged,
    length(html) / 1048576e0 AS mb, lower(html) AS body FROM pages)""")
def k04(spark, sf):
    pages = b.table(spark, sf, "pages").select("page_id", "html", F.col("html").alias("body"), markup.page_title("html").alias("title"))
    flags = ch.real_block_flags(
        pages, words=lx.REAL_BLOCK_WORDS + ["que"], titles=lx.CHALLENGE_TITLES + ["elle"],
        data_words=lx.VENDOR_DATA_WORDS + ["heit"], big_mb=_SMALL,
    )
    return flags.select("page_id", "real_block", "has_content", "has_vendor_data")


@query("k05_status_by_source", with_ctes("""SELECT source, count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'blocked') AS blocked,
    count(*) FILTER (status = 'captcha') AS captcha, count(*) FILTER (status = 'error') AS error,
    CAST(round_even(count(*) FILTER (status = 'ok') * 100e0 / count(*), 0) AS BIGINT) AS ok_pct FROM log GROUP BY 1""", log=LOG))
def k05(spark, sf):
    return ch.status_by_source(b.request_log(spark, sf))


@query("k06_ok_by_phase", with_ctes("""SELECT source, phase, count(*) AS total, count(*) FILTER (NOT blocked) AS ok,
    CAST(count(*) FILTER (NOT blocked) * 100 // count(*) AS BIGINT) AS ok_pct FROM log GROUP BY 1, 2""", log=LOG))
def k06(spark, sf):
    return ch.ok_by_phase(b.request_log(spark, sf))


@query("k06_first_block", with_ctes("""SELECT source, count(*) AS blocked, min(idx) AS idx, arg_min(phase, idx) AS phase, arg_min(reason, idx) AS reason
    FROM log WHERE blocked GROUP BY 1""", log=LOG))
def k06b(spark, sf):
    return ch.first_block(b.request_log(spark, sf), ("phase", "reason"))


@query("k07_block_kinds", with_ctes("""SELECT source, count(*) AS requests, count(*) FILTER (blocked AND html_mb < 0.5) AS real_blocks,
    count(*) FILTER (blocked AND html_mb >= 0.5) AS false_positives, count(*) FILTER (NOT blocked) AS successful FROM log GROUP BY 1""", log=LOG))
def k07(spark, sf):
    return ch.block_kinds(b.request_log(spark, sf))


_METRICS = f"""SELECT source, count(*) AS attempts, count(*) FILTER (status = 'ok') AS successful, count(*) FILTER (status = 'blocked') AS blocked,
    count(*) FILTER (status = 'captcha') AS captcha, {b.r('sum(CAST(elapsed AS DECIMAL(18,6))) / count(*)', 4)} AS avg_duration,
    count(*) FILTER (status = 'ok') * 100e0 / count(*) AS success_rate FROM log GROUP BY 1"""


@query("k08_run_metrics", with_ctes(_METRICS, log=LOG))
def k08(spark, sf):
    return ch.run_metrics(b.request_log(spark, sf), "source")


@query("k09_hourly", with_ctes("""SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (status = 'ok') AS successful, count(*) AS total
    FROM log GROUP BY 1""", log=LOG))
def k09(spark, sf):
    return ch.hourly(b.request_log(spark, sf))


@query("k10_alerts", with_ctes("""SELECT source, 'low_success' AS alert, round(success_rate, 4) AS value FROM m WHERE success_rate < 50 AND attempts >= 10
    UNION ALL SELECT source, 'high_block', round(blocked * 1e0 / attempts, 4) FROM m WHERE blocked * 1e0 / attempts > 0.3
    UNION ALL SELECT source, 'high_captcha', round(captcha * 1e0 / attempts, 4) FROM m WHERE captcha * 1e0 / attempts > 0.5""", log=LOG, m=_METRICS))
def k10(spark, sf):
    return ch.alerts(ch.run_metrics(b.request_log(spark, sf), "source"), "source")


@query("k11_rule_health", """SELECT *, max(success_rate) OVER (PARTITION BY element) < 50 AS element_failing FROM (
    SELECT p_brand AS element, p_type AS rule, count(*) AS attempts, count(*) FILTER (p_size > 12) AS successes,
    count(*) FILTER (p_size > 12) * 100e0 / count(*) AS success_rate,
    count(*) FILTER (p_size > 12) * 100e0 / count(*) >= 80 AND count(*) FILTER (p_size > 12) > 0 AS healthy FROM part GROUP BY 1, 2)""")
def k11(spark, sf):
    attempts = b.table(spark, sf, "part").select(
        F.col("p_brand").alias("element"), F.col("p_type").alias("rule"), (F.col("p_size") > 12).alias("success")
    )
    return ch.rule_health(attempts)
