"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm the JVM and the Python workers and is then
timed over its full result, which is written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reviewloom import build_session, catalog  # noqa: E402
from reviewloom.catalog import bindings  # noqa: E402
from reviewloom.operators.dedup import unify  # noqa: E402
from reviewloom.plans.tagging import tag_and_repair  # noqa: E402

HEADLINE = [
    "flagship_tagged_category_coverage",
    "d_chain_tag_and_repair",
    "d06_tagging_default_lexicon",
    "f04_category_rollup",
    "f05_state_rollup",
    "f07_praise_tags",
    "f08_negative_by_category",
    "f13_market_stats",
    "f15_price_histogram",
    "g02_top_per_category",
    "h01_vendor_upsert",
    "h04_insert_ignore_known",
    "i01_first_by_key",
    "j10_review_violations",
    "k08_run_metrics",
    "k09_hourly",
    "b05_detail_vendors",
    "b13_review_nodes",
    "b16_split_review_blobs",
    "b29_visible_text",
    "e12_package_scalars",
    "l07_all_insights",
    "dashboard_document",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        run(queries[name](spark, sf))
        start = time.perf_counter()
        run(queries[name](spark, sf))
        times[name] = round(time.perf_counter() - start, 3)
    # Tagging rate without the fixed cost of planning a small job: ten variants of every text in one plan.
    texts = bindings.texts(spark, sf)
    many = unify([texts.withColumn("review_text", F.concat("review_text", F.lit(f" {i}"))) for i in range(10)])
    rows = many.count()
    tagged = tag_and_repair(many)
    start = time.perf_counter()
    run(tagged)
    seconds = time.perf_counter() - start
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "tagging": {"reviews": rows, "seconds": round(seconds, 3), "reviews_per_sec": round(rows / seconds)},
    }))


if __name__ == "__main__":
    main()
