"""Keyed writes with a per-column policy.

``overwrite`` takes the incoming value, ``coalesce`` keeps the stored value when
the incoming one is null, ``insert_only`` never changes a stored value. A batch
may hold a key several times: the result is that of applying its rows one after
the other, folded to one row per key before the join. Both join sides then have
unique keys, so no key can make a partition large. ``sources.keyed_table`` applies
a batch to a stored table by writing the touched parts only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.dedup import first_by_key

OVERWRITE, COALESCE, INSERT_ONLY = "overwrite", "coalesce", "insert_only"

VENDOR_KEY = ("source", "source_vendor_id")
REVIEW_KEY = ("source", "source_review_id")

# Column policies of the vendor and review tables.
VENDOR_POLICY: dict[str, str] = {
    "name": OVERWRITE, "phone": COALESCE, "email": COALESCE, "website_url": COALESCE,
    "starting_price_min": COALESCE, "starting_price_avg": COALESCE, "star_rating": OVERWRITE,
    "review_count": OVERWRITE, "description": COALESCE, "awards": OVERWRITE, "deals": OVERWRITE,
    "last_seen": OVERWRITE, "scrape_run_id": OVERWRITE, "raw_data": OVERWRITE,
}
BULK_VENDOR_POLICY: dict[str, str] = {
    "name": OVERWRITE, "city": COALESCE, "state": COALESCE, "starting_price_range": COALESCE,
    "star_rating": OVERWRITE, "review_count": OVERWRITE, "service_area": COALESCE, "ad_tier": COALESCE,
    "vendor_tier": COALESCE, "claimed_status": COALESCE, "awards": OVERWRITE, "last_seen": OVERWRITE,
}
REVIEW_POLICY: dict[str, str] = {
    "review_text": OVERWRITE, "rating": OVERWRITE, "review_date": OVERWRITE, "reviewer_name": OVERWRITE,
}
TAG_POLICY: dict[str, str] = {
    "sentiment": OVERWRITE, "sentiment_confidence": OVERWRITE, "complaint_categories": OVERWRITE,
    "praise_categories": OVERWRITE, "analyzed_at": OVERWRITE, "analysis_model": OVERWRITE,
}


def _value(df: DataFrame, name: str, blank_as_null: bool) -> Column:
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    return F.nullif(F.col(name), F.lit("")) if blank_as_null and is_text else F.col(name)


def fold_batch(
    incoming: DataFrame, key: Sequence[str], policy: Mapping[str, str], seq: str, blank_as_null: bool = False
) -> DataFrame:
    """One row per key of a batch.

    ``f_<col>`` and ``l_<col>`` are the values of the first and of the last row,
    ``c_<col>`` the last non-null value. ``seq`` must be unique within a key.

    Where the last row is all that counts it is taken by ``row_number``, which Spark
    limits in every map task. Otherwise the places of the rows needed, at most one per
    kept column and two, are found as plain minima and maxima of ``seq``, combined
    before the shuffle; rows are then looked up by key and place, so that a key with a
    third of the batch is spread over tasks, and only those few meet in one row.
    """
    values = [c for c in incoming.columns if c not in key and c != seq]
    overwrite = [c for c in values if policy.get(c, INSERT_ONLY) == OVERWRITE]
    keep = [c for c in values if policy.get(c, INSERT_ONLY) == COALESCE]
    first = [c for c in values if c not in overwrite]
    if not first:
        last = first_by_key(incoming, key, [F.desc(seq)])
        return last.select(*key, F.lit(1).alias("_rows"), *[F.col(c).alias(f"l_{c}") for c in overwrite])
    filled = [F.max(F.when(_value(incoming, c, blank_as_null).isNotNull(), F.col(seq))) for c in keep]
    places = F.array_distinct(F.array_compact(F.array(F.min(seq), F.max(seq), *filled)))
    wanted = incoming.groupBy(*key).agg(places.alias("_at")).select(*[F.col(k).alias(f"_k_{k}") for k in key], F.explode("_at").alias("_at"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key] + [F.col(seq) == F.col("_at")]
    met = incoming.join(wanted, same).select(*key, F.struct(F.col(seq).alias("_at"), *values).alias("_row"))
    order = lambda a, b: F.when(a["_at"] < b["_at"], -1).when(a["_at"] > b["_at"], 1).otherwise(0)
    rows = met.groupBy(*key).agg(F.array_sort(F.collect_list("_row"), order).alias("_few"))
    text = {f.name for f in incoming.schema if isinstance(f.dataType, T.StringType)}
    known = lambda c: lambda r: (F.nullif(r[c], F.lit("")) if blank_as_null and c in text else r[c]).isNotNull()
    return rows.select(
        *key, F.lit(1).alias("_rows"),
        *[F.element_at("_few", 1)[c].alias(f"f_{c}") for c in first],
        *[F.element_at("_few", -1)[c].alias(f"l_{c}") for c in overwrite],
        *[F.try_element_at(F.filter("_few", known(c)), F.lit(-1))[c].alias(f"c_{c}") for c in keep],
    )


def _joined(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], policy: Mapping[str, str], seq: str,
    blank_as_null: bool,
) -> DataFrame:
    stored = existing.withColumn("_stored", F.lit(True))
    return stored.join(fold_batch(incoming, key, policy, seq, blank_as_null), list(key), "full")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    policy: Mapping[str, str],
    seq: str,
    blank_as_null: bool = False,
    action: str | None = None,
) -> DataFrame:
    """New version of ``existing`` after applying a batch in ``seq`` order.

    ``blank_as_null=False`` lets an empty text replace a stored value, because an
    empty text is not null; ``True`` keeps the stored value. ``action`` names an
    optional column that says inserted / updated / kept.
    """
    joined = _joined(existing, incoming, key, policy, seq, blank_as_null)
    stored = F.col("_stored").isNotNull()
    touched = F.col("_rows").isNotNull()
    have = set(incoming.columns)
    out: list[Column] = []
    for c in existing.columns:
        if c in key:
            out.append(F.col(c))
        elif c not in have:
            out.append(F.col(c))
        elif policy.get(c, INSERT_ONLY) == OVERWRITE:
            out.append(F.when(touched, F.col(f"l_{c}")).otherwise(F.col(c)).alias(c))
        elif policy.get(c, INSERT_ONLY) == COALESCE:
            out.append(F.coalesce(F.col(f"c_{c}"), F.when(stored, F.col(c)).otherwise(F.col(f"f_{c}"))).alias(c))
        else:
            out.append(F.when(stored, F.col(c)).otherwise(F.col(f"f_{c}")).alias(c))
    if action:
        out.append(
            F.when(~touched, "kept").when(stored, "updated").otherwise("inserted").alias(action)
        )
    return joined.select(*out)


def upsert_counts(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inserted and updated row counts of a batch; later rows of a new key are updates."""
    per_key = incoming.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    stored = existing.select(*key, F.lit(True).alias("_stored"))
    marked = per_key.join(stored, list(key), "left")
    new = F.col("_stored").isNull()
    return marked.agg(
        F.count_if(new).alias("inserted"),
        F.coalesce(F.sum(F.col("_rows") - F.when(new, 1).otherwise(0)), F.lit(0)).alias("updated"),
    )


def new_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows to append when stored keys and repeats inside the batch are ignored.

    The stored keys are first reduced to those of the batch, which Spark can do without
    moving the stored side where the batch is small enough to be broadcast.
    """
    first = first_by_key(incoming, list(key), order)
    seen = existing.select(*key).join(incoming.select(*key), list(key), "left_semi").distinct()
    return first.join(seen, list(key), "left_anti")


def validate_reviews(
    incoming: DataFrame, min_text: int = 30, required: Sequence[str] = ("source", "source_review_id")
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with a reason); nothing is dropped silently."""
    reason = F.when(F.coalesce(F.length("review_text"), F.lit(0)) < min_text, "text too short")
    for c in required:
        reason = reason.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", f"{c} missing")
    judged = incoming.withColumn("reject_reason", reason)
    valid = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, judged.filter(F.col("reject_reason").isNotNull())
