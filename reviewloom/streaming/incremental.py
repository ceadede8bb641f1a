"""Incremental work as Structured Streaming.

Reviews are stored in a table laid out by a hash of their key. Each micro-batch reads the
keys of its own buckets, appends what is unknown, tagged, and writes crowded buckets anew,
so the number of files stays bounded. A review counts whenever it arrives: no watermark
drops late rows, and repeats, within a batch, over batches or by a retry, are known keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reviewloom.operators.crawl_health import hourly
from reviewloom.operators.upsert import REVIEW_KEY
from reviewloom.plans.tagging import tag_and_repair
from reviewloom.session import Workspace
from reviewloom.sources.keyed_table import KeyedTable


def tag_stream(reviews: DataFrame, event_time: str = "scraped_at", late: str = "2 hours", **lexicon) -> DataFrame:
    """Tagged review stream without repeats, for sinks that cannot look up stored keys.

    Its state is bounded by the watermark: a review that comes later than ``late`` behind
    the newest one is left out. ``start_tagging`` has no such bound.
    """
    fresh = reviews.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(REVIEW_KEY))
    return tag_and_repair(fresh, **lexicon)


def append_new(table: KeyedTable, order: str = "scraped_at", tag: Callable[[DataFrame], DataFrame] | None = None, files: int = 8):
    """``foreachBatch`` function that appends the unknown reviews of a batch, tagged by ``tag``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        space = Workspace(table.spark, "stream")
        table.insert_new(space.write(batch), [order, "review_text"], tag, files)  # the batch is read several times, evaluated once
        space.close()

    return write


def start_tagging(
    spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, order: str = "scraped_at", buckets: int = 64, files: int = 8, **lexicon,
) -> StreamingQuery:
    """Run the tagging stream over everything available, then stop."""
    target = KeyedTable(spark, table, REVIEW_KEY, buckets)
    return (
        stream.writeStream.foreachBatch(append_new(target, order, lambda rows: tag_and_repair(rows, **lexicon), files))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_stream(log: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Crawl success per hour of a request log stream."""
    return hourly(log.withWatermark("ts", late))
