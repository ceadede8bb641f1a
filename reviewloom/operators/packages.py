"""Package data of several sources merged by vendor name.

The merge is kept in three normal-form frames: scalar facts per name, packages
one per row and distinct prices one per row. A name (or the blank name) that
holds a third of all records therefore never becomes one giant row. Names with
few packages can be nested by the caller for an export.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.dedup import first_by_key

SCALARS = ("phone", "description", "pages_ok", "website_url")


def merge_scalars(
    first: DataFrame, direct: DataFrame, websites: DataFrame, seq: str = "seq"
) -> DataFrame:
    """One row per name: the last direct record wins, the website source fills absent names only.

    Fields of a direct record replace earlier ones even when blank; the website
    source is used for a name without a direct record.
    """
    names = first.select("name").unionByName(direct.select("name")).unionByName(websites.select("name")).distinct()
    last = first_by_key(direct, ["name"], [F.desc(seq)]).select("name", F.struct(*SCALARS).alias("d"))
    fill = first_by_key(websites, ["name"], [seq]).select("name", F.struct("phone", "website_url").alias("w"))
    joined = names.join(last, "name", "left").join(fill, "name", "left")
    direct_known = F.col("d").isNotNull()
    return joined.select(
        "name",
        F.when(direct_known, F.col("d.phone")).otherwise(F.col("w.phone")).alias("phone"),
        F.col("d.description").alias("description"),
        F.col("d.pages_ok").alias("pages_ok"),
        F.when(direct_known, F.col("d.website_url")).otherwise(F.col("w.website_url")).alias("website_url"),
    )


def merge_packages(first: DataFrame, direct: DataFrame, seq: str = "seq") -> DataFrame:
    """Packages of both sources, one per row: the last first-source record's list, then every direct list."""
    newest = first_by_key(first, ["name"], [F.desc(seq)])
    parts = [
        newest.select("name", F.lit(0).alias("source_rank"), F.lit("").alias("record"),
                      F.posexplode("packages").alias("position", "package")),
        direct.select("name", F.lit(1).alias("source_rank"), F.col(seq).cast("string").alias("record"),
                      F.posexplode("packages").alias("position", "package")),
    ]
    return parts[0].unionByName(parts[1])


def merge_prices(first: DataFrame, direct: DataFrame, seq: str = "seq") -> DataFrame:
    """Distinct (name, price) over both sources."""
    newest = first_by_key(first, ["name"], [F.desc(seq)])
    union = newest.select("name", F.explode("prices_found").alias("price")).unionByName(
        direct.select("name", F.explode(F.concat("prices_clean", "prices")).alias("price"))
    )
    return union.distinct()


def child_rows(vendors: DataFrame, parents: Sequence[str] = ("business_name", "url"), packages: str = "packages") -> DataFrame:
    """One row per package with its parent's columns."""
    return vendors.select(*parents, F.inline(packages))


def vendor_summary(vendors: DataFrame, columns: Sequence[str], packages: str = "packages") -> DataFrame:
    """Vendor columns with the number of packages."""
    return vendors.select(*columns, F.coalesce(F.size(packages), F.lit(0)).alias("num_packages"))
