"""Dataset plans: source records to the vendor table, and priced listings to benchmarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import lexicons as lx
from reviewloom.functions.payloads import unified_vendor
from reviewloom.functions.scalars import first_filled, price_tier
from reviewloom.operators.dedup import first_by_key, unify
from reviewloom.operators.upsert import VENDOR_KEY, VENDOR_POLICY, upsert


def build_vendors(
    vendors: DataFrame,
    sources: Sequence[DataFrame],
    id_rules: Mapping[str, Sequence[str]],
    run_id: int,
    seen_at: datetime,
    seq: str = "seq",
    default_category: str = lx.DEFAULT_CATEGORY,
    policy: Mapping[str, str] = VENDOR_POLICY,
    blank_as_null: bool = False,
) -> DataFrame:
    """New version of the vendor table after one run over differently shaped sources.

    One plan: unify, normalise, fold repeated keys, join with the stored table. The
    only shuffles are the two sides of the keyed join.
    """
    records = unified_vendor(unify(sources), dict(id_rules), default_category, run_id, keep=[seq])
    stamped = records.withColumns({"first_seen": F.lit(seen_at), "last_seen": F.lit(seen_at)})
    return upsert(vendors, stamped, VENDOR_KEY, policy, seq, blank_as_null)


def priced_listings(
    sources: Sequence[DataFrame],
    thresholds: Mapping[str, tuple[float, float]] | None = None,
    order: Sequence[str] = ("source_rank", "position"),
) -> DataFrame:
    """Pricing records of all sources with their tier; the first record of a key wins.

    The key is the source with the vendor id, or with the url where a source has no id.
    """
    records = unify(sources)
    tiered = records.withColumn("price_tier", price_tier("category", "starting_price_avg", "starting_price_min", thresholds))
    name = first_filled("vendor_id", "source_url")
    # a record with neither keeps a row of its own
    own = F.when(name == "", F.struct(*order))
    return first_by_key(tiered, ["source", name, own], list(order))
